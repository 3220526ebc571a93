"""Data source "calib": the binary dataset format (versions 0 and 1), read as one of four tables and written from rows.

spark.dataSource.register(CalibDataSource)
spark.read.format("calib").option("table", "features").load(path)

The format, little-endian: magic "calib_data", u32 version, u32 cameras, (u32 width, u32 height) each;
u32 imagesets, each u32 length + name and per camera u32 n + n (f32 x, f32 y, i32 id); u32 geometries,
each f32 cell, u32 n + n (i32 id, i32 gx, i32 gy), from version 1 also u32 n + n (i32 id, f32 x, y, z).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader

MAGIC = b"calib_data"
TABLES = {
    "cameras": "camera_index int, width bigint, height bigint",
    "imagesets": "imageset_index int, filename string",
    "features": "imageset_index int, camera_index int, feature_pos int, x float, y float, feature_id int",
    "geometry": "geometry_index int, feature_id int, gx int, gy int, px float, py float, pz float, cell float",
}


class _Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, form: str) -> tuple:
        out = struct.unpack_from("<" + form, self.data, self.at)
        self.at += struct.calcsize("<" + form)
        return out

    def rows(self, form: str) -> list[tuple]:
        (n,) = self.take("I")
        size = struct.calcsize("<" + form)
        out = list(struct.iter_unpack("<" + form, self.data[self.at : self.at + n * size]))
        if len(out) != n:
            raise ValueError("the dataset ends early")
        self.at += n * size
        return out


def decode(data: bytes) -> dict[str, list[tuple]]:
    """All four tables; a wrong magic, an unknown version or trailing bytes are errors."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a calib dataset")
    c = _Cursor(data)
    c.at = len(MAGIC)
    (version,) = c.take("I")
    if version > 1:
        raise ValueError(f"unknown version {version}")
    out: dict[str, list[tuple]] = {k: [] for k in TABLES}
    out["cameras"] = [(k, w, h) for k, (w, h) in enumerate(c.rows("II"))]
    for i in range(c.take("I")[0]):
        (n,) = c.take("I")
        out["imagesets"].append((i, c.data[c.at : c.at + n].decode()))
        c.at += n
        for camera, *_ in out["cameras"]:
            out["features"] += [(i, camera, p, x, y, f) for p, (x, y, f) in enumerate(c.rows("ffi"))]
    for g in range(c.take("I")[0]):
        (cell,) = c.take("f")
        grid = {f: (gx, gy) for f, gx, gy in c.rows("iii")}
        space = {f: p for f, *p in c.rows("ifff")} if version >= 1 else {}
        for f in sorted(grid.keys() | space.keys()):
            out["geometry"].append((g, f, *grid.get(f, (None, None)), *space.get(f, (None, None, None)), cell))
    if c.at != len(data):
        raise ValueError("trailing bytes")
    return out


def encode(tables: dict[str, list[tuple]]) -> bytes:
    """The dataset in version 1."""
    cameras = sorted(tables["cameras"])
    parts = [MAGIC, struct.pack("<II", 1, len(cameras)), *(struct.pack("<II", w, h) for _, w, h in cameras)]
    per: dict[tuple, list] = {}
    for i, c, p, x, y, f in sorted(tables["features"], key=lambda r: r[:3]):
        per.setdefault((i, c), []).append((x, y, f))
    sets = sorted(tables["imagesets"])
    parts.append(struct.pack("<I", len(sets)))
    for i, name in sets:
        raw = name.encode()
        parts.append(struct.pack("<I", len(raw)) + raw)
        for c, *_ in cameras:
            rows = per.get((i, c), [])
            parts += [struct.pack("<I", len(rows)), *(struct.pack("<ffi", *r) for r in rows)]
    groups: dict[int, list] = {}
    for row in sorted(tables["geometry"], key=lambda r: r[:2]):
        groups.setdefault(row[0], []).append(row)
    parts.append(struct.pack("<I", len(groups)))
    for rows in groups.values():
        grid = [r for r in rows if r[2] is not None]
        space = [r for r in rows if r[4] is not None]
        parts += [struct.pack("<fI", rows[0][7], len(grid)), *(struct.pack("<iii", *r[1:4]) for r in grid)]
        parts += [struct.pack("<I", len(space)), *(struct.pack("<ifff", r[1], *r[4:7]) for r in space)]
    return b"".join(parts)


class CalibReader(DataSourceReader):
    def __init__(self, path: str, table: str):
        self.path, self.table = path, table

    def read(self, partition) -> Iterator[tuple]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)
        with system.open_input_stream(path, compression=None) as f:
            yield from decode(f.read())[self.table]


class CalibDataSource(DataSource):
    """Option table: cameras, imagesets, features (default) or geometry."""

    @classmethod
    def name(cls) -> str:
        return "calib"

    def schema(self) -> str:
        return TABLES[self.options.get("table", "features")]

    def reader(self, schema) -> DataSourceReader:
        return CalibReader(self.options["path"], self.options.get("table", "features"))


def save(path: str, **tables) -> None:
    """Write DataFrames cameras, imagesets, features and geometry as one file: the format is one file, so its rows meet here."""
    from pyarrow import fs

    rows = {k: [tuple(r) for r in df.select(*(c.split()[0] for c in TABLES[k].split(", "))).toLocalIterator()] for k, df in tables.items()}
    system, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    with system.open_output_stream(at, compression=None) as f:
        f.write(encode({k: rows.get(k, []) for k in TABLES}))
