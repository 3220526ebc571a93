"""Column names that clash with none of the caller's."""

from __future__ import annotations


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores before it until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name
