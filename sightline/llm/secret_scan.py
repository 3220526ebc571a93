"""Secret scans with a trigram inverted index, in DataFrame expressions only.

1. Each rule's regular expression is analysed into a Boolean query over the trigrams that any match
   must hold in lower case; a rule without mandatory trigrams scans every text.
2. The index holds a posting (trigram, id) for every trigram of the queries that a text holds.
3. Postings of an id are brought together and each rule's query is evaluated on them.
4. Candidates are verified: the rule's expression runs over the whole text of its candidates.

Postings are pre-aggregated per task, so an id that many rows share sends one row per task. Work
grows in proportion to a text's length and its number of matches: positions come from prefix sums
in blocks of BLOCK values, and a masked text is joined once from pieces that are cut out of parts
of PART code points.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import fresh

try:
    from re import _constants as _c, _parser
except ImportError:  # before Python 3.11
    import sre_constants as _c
    import sre_parse as _parser

Query = bool | str | tuple  # True: any text; a trigram; ("and" or "or", queries)


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern whose group has at least least characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# The base rules, then the rules that the method adds (public token formats).
BASE = (
    Rule("assign", rf"({_either_case('password|passwd|secret|token|api_?key')})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z]{1,20}://[A-Za-z0-9._~-]+:[A-Za-z0-9._~!$&*+-]+@"),
)
_MOST = 16
BLOCK, PART = 256, 2048
_NONE = "array<struct<start:bigint,kind:int,end:bigint>>"


def _trigrams(word: str) -> Query:
    return ("and", tuple(sorted({word[k : k + 3] for k in range(len(word) - 2)}))) if len(word) >= 3 else True


def _all(queries: list[Query]) -> Query:
    kept = tuple(dict.fromkeys(q for q in queries if q is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _any(queries: list[Query]) -> Query:
    kept = tuple(dict.fromkeys(queries))
    return True if True in kept else kept[0] if len(kept) == 1 else ("or", kept)


def _analysed(nodes) -> tuple[set[str] | None, Query]:
    """The strings that the nodes match, if they are few, else None; and what any match must hold."""
    strings: set[str] | None = {""}
    exact, queries = True, []

    def flush() -> None:
        nonlocal strings
        queries.append(_any([_trigrams(s) for s in sorted(strings)]))
        strings = {""}

    for op, value in nodes:
        inner: set[str] | None = None
        query: Query = True
        if op is _c.LITERAL:
            inner = {chr(value).lower()}
        elif op is _c.IN:
            chars = [chr(v).lower() for o, v in value if o is _c.LITERAL]
            inner = set(chars) if len(chars) == len(value) and len(set(chars)) <= 6 else None
        elif op is _c.SUBPATTERN:
            inner, query = _analysed(value[-1])
        elif op is _c.BRANCH:
            parts = [_analysed(x) for x in value[1]]
            inner = set().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            query = _any([p[1] if p[0] is None else _any([_trigrams(s) for s in sorted(p[0])]) for p in parts])
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT):
            low, high, part = value
            found, query = _analysed(part)
            if (low, high) == (0, 1) and found is not None:
                inner = found | {""}
            query = query if low else True
        if inner is not None and len(strings) * len(inner) <= _MOST:
            strings = {a + b for a in strings for b in inner}
        else:
            flush()
            queries.append(query)
            exact = False
    if exact:
        return strings, True
    flush()
    return None, _all(queries)


def trigram_query(pattern: str) -> Query:
    """What the lower-case form of any text with a match must hold; True if nothing can be said."""
    strings, query = _analysed(_parser.parse(pattern))
    return query if strings is None else _any([_trigrams(s) for s in sorted(strings)])


def _leaves(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(_leaves, query[1]))


def _holds(query: Query, has: dict[str, Column]) -> Column:
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return has[query]
    parts = [_holds(q, has) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def candidates(docs: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(_id, _rules): for each id with a posting, bit r is set if rule r's query holds. Rules that scan fully have no bit."""
    query = {r.kind: trigram_query(r.pattern) for r in rules}
    terms = sorted(set().union(*map(_leaves, query.values())))
    text = docs.select(F.col(id_col).alias("_id"), F.lower(F.col(text_col).cast("string")).alias("_low"))
    held = F.array_compact(F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(k)) for k, t in enumerate(terms))))
    postings = text.select("_id", F.explode(held).alias("term"))
    words = range(-(-len(terms) // 63))
    bit = lambda w: F.when(F.floor(F.col("term") / 63) == w, F.expr(f"shiftleft(1L, cast(term - {63 * w} as int))")).otherwise(F.lit(0))
    met = postings.groupBy("_id").agg(*(F.bit_or(bit(w)).alias(f"w{w}") for w in words))
    has = {t: F.col(f"w{k // 63}").bitwiseAND(F.lit(1 << (k % 63))) != 0 for k, t in enumerate(terms)}
    bits = F.lit(0)
    for k, r in enumerate(rules):
        if query[r.kind] is not True:
            bits = bits.bitwiseOR(F.when(_holds(query[r.kind], has), F.lit(1 << k)).otherwise(F.lit(0)))
    return met.select("_id", bits.alias("_rules")).where("_rules != 0")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of the array's numbers, those before it combined (0 for none), block by block."""
    zero = F.lit(0).cast("bigint")

    def running(xs: Column) -> Column:
        begin = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(xs, begin, step, lambda acc: acc["out"])

    def joined(blocks: Column) -> Column:
        firsts = running(F.transform(blocks, lambda xs: F.aggregate(xs, zero, combine)))
        return F.flatten(F.zip_with(blocks, firsts, lambda xs, first: F.transform(running(xs), lambda x: combine(first, x))))

    count = F.ceil(F.size(values) / BLOCK).cast("int")
    cut = lambda all_, n: F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)))
    return F.when(count > 0, _let(values, lambda all_: _let(cut(all_, F.ceil(F.size(all_) / BLOCK).cast("int")), joined))).otherwise(F.array().cast("array<bigint>"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, kind's order, end) of the rule's matches in the text, in code points."""
    p = F.lit(rule.pattern)
    size = lambda x: F.coalesce(F.length(x), F.lit(0)).cast("bigint")
    rows = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, p, 0).alias("hit"), F.regexp_extract_all(text, p, rule.group).alias("part")),
        lambda x: F.struct(size(x["gap"]).alias("gap"), size(x["hit"]).alias("hit"), F.coalesce(F.length(x["part"]), F.lit(-1)).alias("part")),
    )

    def placed(found: Column) -> Column:
        begins = _before(F.transform(found, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)
        spans = F.zip_with(found, begins, lambda x, at: F.struct((at + x["gap"]).alias("start"), F.lit(order).alias("kind"), (at + x["gap"] + x["hit"]).alias("end"), x["part"].alias("part")))
        return F.transform(F.filter(spans, lambda s: s["part"] >= rule.least), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    return F.when(F.regexp_like(text, p), _let(rows, placed)).otherwise(F.array().cast(_NONE))


def _found(text: Column, bits: Column, rules: tuple[Rule, ...]) -> Column:
    """The sorted spans of all rules that scan fully or whose bit is set."""
    each = [_spans(text, r, k) if trigram_query(r.pattern) is True else F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, _spans(text, r, k)).otherwise(F.array().cast(_NONE)) for k, r in enumerate(rules)]
    return F.array_sort(F.concat(*each))


def _masked(text: Column, found: Column, mask: str) -> Column:
    """The text with the mask for each of the sorted spans; spans that overlap get one mask."""

    def cut(parts: Column, a: Column, b: Column) -> Column:
        x, y = F.floor(a / PART).cast("int"), F.floor((b - 1) / PART).cast("int")
        head = F.substring(F.element_at(parts, x + 1), (a - x * PART + 1).cast("int"), F.least(b - a, F.lit(PART).cast("bigint")).cast("int"))
        tail = F.substring(F.element_at(parts, y + 1), F.lit(1), (b - y * PART).cast("int"))
        return F.when(a >= b, F.lit("")).when(x == y, head).otherwise(F.concat(head, F.array_join(F.slice(parts, x + 2, y - x - 1), ""), tail))

    def joined(parts: Column, spans: Column) -> Column:
        reached = _before(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        apart = F.filter(F.zip_with(spans, reached, lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"))), lambda x: x["start"] >= x["at"])
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(apart, lambda x: F.concat(cut(parts, x["at"], x["start"]), F.lit(mask))), ""), cut(parts, last, F.length(text).cast("bigint")))

    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), 0), lambda parts: _let(found, lambda spans: joined(parts, spans)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """One row per row of docs: id, found: array of (start, kind, end) by start, then by the rules' order; is_base per span; text.

    Offsets count code points, end exclusive. Spans of different kinds may overlap. A null text
    counts as empty; rows of one id (or of null ids) are candidates together and verified each by
    its own text; other columns are ignored.
    """
    rules = (*base, *added)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    met = candidates(docs, id_col, text_col, rules).withColumnRenamed("_id", "_cid")
    told = rows.join(met, F.col("_id").eqNullSafe(F.col("_cid")), "left").select("_id", "_text", F.coalesce("_rules", F.lit(0).cast("bigint")).alias("_rules"))
    return told.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), _found(F.col("_text"), F.col("_rules"), rules).alias("found"))


def kind_names(rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> Column:
    return F.array(*(F.lit(r.kind) for r in rules))


def written(found: Column, rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = kind_names(rules)
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs with every found secret replaced by the mask; overlapping spans are masked as one. All columns and rows stay; a null text stays null."""
    rules = (*BASE, *ADDED)
    key, bits, found = (fresh(n, docs.columns) for n in ("_cid", "_rules", "_found"))
    met = candidates(docs, id_col, text_col, rules).withColumnsRenamed({"_id": key, "_rules": bits})
    told = docs.join(met, F.col(id_col).eqNullSafe(F.col(key)), "left")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    told = told.withColumn(found, _found(text, F.coalesce(F.col(bits), F.lit(0).cast("bigint")), rules))
    fixed = F.when(F.size(found) > 0, _masked(text, F.col(found), mask)).otherwise(F.col(text_col))
    return told.withColumn(text_col, fixed).select(*docs.columns)
