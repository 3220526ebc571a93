"""Data source "messages": logs of time-stamped messages of several topics, in chunks.

spark.dataSource.register(MessageLog)
spark.read.format("messages").load(path)          # a file, a folder or several, comma-separated
spark.readStream.format("messages").load(folder)  # complete chunks of new and growing files
frame.write.format("messages").mode("append").save(folder)

The container is the public MCAP format: records of a one-byte kind and an eight-byte length between two
magic words. A chunk holds the messages of a span of log time, compressed; an index of the chunks at
the end says where each lies, from when to when it reaches and which topics it has. So a task reads
its chunks only, and filters on topic and log_time drop chunks before they are read. A file that was cut off
has no index; its chunks are then found by stepping over the records.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

SCHEMA = "topic string, schema_name string, encoding string, sequence bigint, log_time bigint, publish_time bigint, data binary, file string"

# Fixed values of the format: the magic word and the kinds of records.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA_RECORD, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX, DATA_END = 1, 2, 3, 4, 5, 6, 7, 8, 15
_FOOTER_SIZE = 9 + 20 + len(MAGIC)

#: Bytes of a chunk before compression when writing; compressed bytes that one task reads at least.
CHUNK_BYTES, TASK_BYTES = 1 << 20, 8 << 20


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """The log files that path names, sorted: files themselves, and those below folders."""
    from pyarrow import fs

    out = set()
    for one in path.split(","):
        system, at = _open(one.strip())
        info = system.get_file_info(at)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no such log: {one}")
        found = [info] if info.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(at, recursive=True)) if x.type == fs.FileType.File and x.path.endswith(".mcap")]
        prefix = one.strip()[: len(one.strip()) - len(at.lstrip("/"))] if ":" in one else ""
        out |= {prefix + x.path.lstrip("/") if prefix else x.path for x in found}
    return sorted(out)


class _Bytes:
    """Reads fields one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, form: str) -> tuple:
        out = struct.unpack_from("<" + form, self.data, self.at)
        self.at += struct.calcsize("<" + form)
        return out

    def raw(self, size: int) -> bytes:
        if self.at + size > len(self.data):
            raise ValueError("a record ends early")
        self.at += size
        return self.data[self.at - size : self.at]

    def text(self) -> str:
        return self.raw(self.take("I")[0]).decode()

    def records(self) -> Iterator[tuple[int, bytes]]:
        while self.at < len(self.data):
            kind, size = self.take("BQ")
            yield kind, self.raw(size)


@dataclass
class Chunk(InputPartition):
    """Chunks of one file that a task reads: (position, length) each; with the file's topics and the filters."""

    file: str
    spans: list[tuple[int, int]]
    wanted: Wanted


@dataclass
class Wanted:
    """What filters ask for; None is everything. Bounds are inclusive."""

    topics: frozenset | None = None
    low: int | None = None
    high: int | None = None

    def takes(self, filters: list[Filter]) -> Iterator[Filter]:
        """Notes the filters on topic and log_time, which chunks are chosen by; all are yielded back, as rows are filtered by Spark too."""
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name == ("topic",) and isinstance(f, EqualTo | In):
                these = frozenset([value] if isinstance(f, EqualTo) else value)
                self.topics = these if self.topics is None else self.topics & these
            elif name == ("log_time",) and isinstance(value, int):
                if isinstance(f, EqualTo | GreaterThanOrEqual | GreaterThan):
                    least = value + isinstance(f, GreaterThan)
                    self.low = least if self.low is None else max(self.low, least)
                if isinstance(f, EqualTo | LessThanOrEqual | LessThan):
                    most = value - isinstance(f, LessThan)
                    self.high = most if self.high is None else min(self.high, most)
            yield f

    def time(self, first: int, last: int) -> bool:
        return (self.low is None or last >= self.low) and (self.high is None or first <= self.high)


def chunk_index(f, size: int) -> list[tuple[int, int, int, int, list[int] | None]]:
    """(position, length, first time, last time, channel ids or None if unknown) of the file's chunks and the channels' topics."""
    f.seek(size - _FOOTER_SIZE)
    tail = f.read(_FOOTER_SIZE)
    summary = struct.unpack_from("<Q", tail, 9)[0] if tail.endswith(MAGIC) and tail[0] == FOOTER else 0
    if not summary:
        return [(at, n, first, last, None) for at, n, first, last in steps(f, len(MAGIC), size)]
    f.seek(summary)
    out, topics = [], {}
    for kind, body in _Bytes(f.read(size - _FOOTER_SIZE - summary)).records():
        b = _Bytes(body)
        if kind == CHUNK_INDEX:
            first, last, at, n = b.take("QQQQ")
            channels = [c for c, _ in struct.iter_unpack("<HQ", b.raw(b.take("I")[0]))]
            out.append((at, n, first, last, channels))
        elif kind == CHANNEL:
            (n, _), topic = b.take("HH"), b.text()
            topics[n] = topic
    return [(at, n, first, last, [topics[c] for c in channels] if all(c in topics for c in channels) and channels else None) for at, n, first, last, channels in out]


def steps(f, at: int, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Position, length and time span of the complete chunks from a record's position on, stepping from record to record."""
    while at + 9 <= size:
        f.seek(at)
        kind, n = struct.unpack("<BQ", f.read(9))
        if at + 9 + n > size or kind in (FOOTER, DATA_END):
            return
        if kind == CHUNK:
            first, last = struct.unpack("<QQ", f.read(16))
            yield at, 9 + n, first, last
        at += 9 + n


def _unpacked(body: bytes) -> bytes:
    """A chunk's records; a wrong checksum is an error."""
    b = _Bytes(body)
    _, _, size, crc = b.take("QQQI")
    how, data = b.text(), b.raw(b.take("Q")[0])
    if how == "zstd":
        import zstandard

        data = zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
    elif how == "lz4":
        data = pa.decompress(data, decompressed_size=size, codec="lz4", asbytes=True)
    elif how:
        raise ValueError(f"unknown compression {how}")
    if len(data) != size or crc and zlib.crc32(data) != crc:
        raise ValueError("a chunk is damaged")
    return data


def messages(body: bytes, wanted: Wanted, schemas: dict, channels: dict, file: str) -> Iterator[tuple]:
    """Rows of a chunk. Schemas and channels that it states are kept in the dictionaries."""
    for kind, record in _Bytes(_unpacked(body)).records():
        b = _Bytes(record)
        if kind == SCHEMA_RECORD:
            (n,), name = b.take("H"), b.text()
            schemas[n] = name
        elif kind == CHANNEL:
            n, schema = b.take("HH")
            channels[n] = (b.text(), schemas.get(schema), b.text())
        elif kind == MESSAGE:
            n, sequence, log_time, publish_time = b.take("HIQQ")
            if wanted.time(log_time, log_time) and n in channels and (wanted.topics is None or channels[n][0] in wanted.topics):
                yield (*channels[n], sequence, log_time, publish_time, record[b.at :], file)


def _channels(f, size: int) -> tuple[dict, dict]:
    """Schemas and channels of the summary, for chunks that don't repeat them."""
    f.seek(size - _FOOTER_SIZE)
    tail = f.read(_FOOTER_SIZE)
    schemas, channels = {}, {}
    summary = struct.unpack_from("<Q", tail, 9)[0] if tail.endswith(MAGIC) and tail[0] == FOOTER else 0
    if summary:
        f.seek(summary)
        for kind, body in _Bytes(f.read(size - _FOOTER_SIZE - summary)).records():
            b = _Bytes(body)
            if kind == SCHEMA_RECORD:
                (n,), name = b.take("H"), b.text()
                schemas[n] = name
            elif kind == CHANNEL:
                n, schema = b.take("HH")
                channels[n] = (b.text(), schemas.get(schema), b.text())
    return schemas, channels


class _Chunks:
    """Reading of a task's chunks, shared by batch and stream."""

    def read(self, part: Chunk) -> Iterator[tuple]:
        system, at = _open(part.file)
        with system.open_input_file(at) as f:
            schemas, channels = _channels(f, f.size())
            for position, n in part.spans:
                f.seek(position + 9)
                yield from messages(f.read(n - 9), part.wanted, schemas, channels, part.file)


class MessageReader(_Chunks, DataSourceReader):
    def __init__(self, path: str, task_bytes: int):
        self.path, self.task_bytes, self.wanted = path, task_bytes, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        return self.wanted.takes(filters)

    def partitions(self) -> list[Chunk]:
        out = []
        for file in _files(self.path):
            system, at = _open(file)
            with system.open_input_file(at) as f:
                f.seek(0)
                if f.read(len(MAGIC)) != MAGIC:
                    raise ValueError(f"not a message log: {file}")
                group, size = [], 0
                for position, n, first, last, topics in chunk_index(f, f.size()):
                    if self.wanted.time(first, last) and (topics is None or self.wanted.topics is None or self.wanted.topics & set(topics)):
                        group.append((position, n))
                        size += n
                        if size >= self.task_bytes:
                            out.append(Chunk(file, group, self.wanted))
                            group, size = [], 0
                if group:
                    out.append(Chunk(file, group, self.wanted))
        return out or [Chunk("", [], self.wanted)]

    def read(self, part: Chunk) -> Iterator[tuple]:
        return super().read(part) if part.spans else iter(())


class MessageStream(_Chunks, DataSourceStreamReader):
    """Offsets are, per file, the position after the last chunk that was taken."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for file in _files(self.path):
            system, at = _open(file)
            with system.open_input_file(at) as f:
                known = getattr(self, "_known", {}).get(file, len(MAGIC))
                out[file] = max([known, *(a + n for a, n, *_ in steps(f, known, f.size()))])
        self._known = out
        return out

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        out = []
        for file, to in end.items():
            system, at = _open(file)
            with system.open_input_file(at) as f:
                out += [Chunk(file, [(a, n)], Wanted()) for a, n, *_ in steps(f, start.get(file, len(MAGIC)), min(to, f.size()))]
        return out


def _record(kind: int, body: bytes) -> bytes:
    return struct.pack("<BQ", kind, len(body)) + body


def _text(x: str) -> bytes:
    return struct.pack("<I", len(x.encode())) + x.encode()


def write_file(rows: Iterator[tuple], out: io.RawIOBase, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Rows (topic, schema_name, encoding, sequence, log_time, publish_time, data) as one file, in their order; how many. Holds one chunk and the index."""
    import zstandard

    at = 0

    def put(data: bytes) -> int:
        nonlocal at
        out.write(data)
        at += len(data)
        return at - len(data)

    put(MAGIC + _record(HEADER, _text("") + _text("sightline")))
    schemas: dict[str, int] = {}
    channels: dict[tuple, int] = {}
    index, chunk, first, last, places, count = [], bytearray(), None, None, {}, 0
    said: set = set()

    def schema_record(name: str) -> bytes:
        return _record(SCHEMA_RECORD, struct.pack("<H", schemas[name]) + _text(name) + _text("") + struct.pack("<I", 0))

    def channel_record(key: tuple) -> bytes:
        topic, schema, encoding = key
        return _record(CHANNEL, struct.pack("<HH", channels[key], schemas.get(schema, 0)) + _text(topic) + _text(encoding or "") + struct.pack("<I", 0))

    def close() -> None:
        nonlocal chunk, first, last, places, said
        if not chunk:
            return
        packed = zstandard.ZstdCompressor().compress(bytes(chunk))
        head = struct.pack("<QQQI", first, last, len(chunk), zlib.crc32(chunk)) + _text("zstd") + struct.pack("<Q", len(packed))
        position = put(_record(CHUNK, head + packed))
        length, spots = at - position, {}
        for c, found in places.items():
            body = b"".join(struct.pack("<QQ", *x) for x in found)
            spots[c] = put(_record(MESSAGE_INDEX, struct.pack("<HI", c, len(body)) + body))
        body = b"".join(struct.pack("<HQ", c, x) for c, x in spots.items())
        index.append(struct.pack("<QQQQ", first, last, position, length) + struct.pack("<I", len(body)) + body + struct.pack("<Q", at - position - length) + _text("zstd") + struct.pack("<QQ", len(packed), len(chunk)))
        chunk, first, last, places, said = bytearray(), None, None, {}, set()

    for topic, schema, encoding, sequence, log_time, publish_time, data in rows:
        if schema and schema not in schemas:
            schemas[schema] = len(schemas) + 1
        key = (topic, schema, encoding)
        c = channels.setdefault(key, len(channels))
        if c not in said:  # a chunk says its schemas and channels itself, so that it can be read alone
            chunk += schema_record(schema) if schema else b""
            chunk += channel_record(key)
            said.add(c)
        first, last = (log_time, log_time) if first is None else (min(first, log_time), max(last, log_time))
        places.setdefault(c, []).append((log_time, len(chunk)))
        chunk += _record(MESSAGE, struct.pack("<HIQQ", c, (sequence or 0) & 0xFFFFFFFF, log_time, publish_time if publish_time is not None else log_time) + (data or b""))
        count += 1
        if len(chunk) >= chunk_bytes:
            close()
    close()
    put(_record(DATA_END, struct.pack("<I", 0)))
    summary = put(b"".join(map(schema_record, schemas)) + b"".join(map(channel_record, channels)) + b"".join(_record(CHUNK_INDEX, x) for x in index))
    put(_record(FOOTER, struct.pack("<QQI", summary if at > summary else 0, 0, 0)) + MAGIC)
    return count


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


class MessageWriter(DataSourceWriter):
    """Each task writes one file under a name of its own; files of failed tasks are removed or stay without the right ending."""

    def __init__(self, path: str, chunk_bytes: int, columns: list[str], overwrite: bool):
        self.path, self.chunk_bytes, self.columns, self.overwrite = path, chunk_bytes, columns, overwrite
        names = [c.split()[0] for c in SCHEMA.split(", ")][:7]
        self.order = [columns.index(n) if n in columns else None for n in names]
        if None in (self.order[0], self.order[4]):
            raise ValueError("topic and log_time are needed")

    def write(self, rows: Iterator) -> Written:
        system, at = _open(self.path)
        system.create_dir(at, recursive=True)
        name = f"{at.rstrip('/')}/{uuid.uuid4().hex}"
        with system.open_output_stream(f"{name}.part", compression=None) as f:
            n = write_file((tuple(None if k is None else r[k] for k in self.order) for r in rows), f, self.chunk_bytes)
        return Written(name, n)

    def commit(self, messages: list[Written]) -> None:
        from pyarrow import fs

        system, at = _open(self.path)
        system.create_dir(at, recursive=True)
        if self.overwrite:
            for x in system.get_file_info(fs.FileSelector(at)):
                if x.path.endswith(".mcap"):
                    system.delete_file(x.path)
        for m in messages:
            if m is not None and m.rows:
                system.move(f"{m.path}.part", f"{m.path}.mcap")
            elif m is not None:
                system.delete_file(f"{m.path}.part")

    def abort(self, messages: list[Written]) -> None:
        system, _ = _open(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{m.path}.part")


class MessageLog(DataSource):
    """Options: task_bytes (compressed bytes that a task reads at least), chunk_bytes (of the writer). Filters reach the reader if spark.sql.python.filterPushdown.enabled is true."""

    @classmethod
    def name(cls) -> str:
        return "messages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return MessageReader(self.options["path"], int(self.options.get("task_bytes", TASK_BYTES)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return MessageStream(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return MessageWriter(self.options["path"], int(self.options.get("chunk_bytes", CHUNK_BYTES)), schema.names, overwrite)


# payloads

_IMU = (("orientation", 4), ("orientation_covariance", 9), ("angular_velocity", 3), ("angular_velocity_covariance", 9), ("linear_acceleration", 3), ("linear_acceleration_covariance", 9))


class _Cdr:
    """Aligned little- or big-endian fields after a four-byte head."""

    def __init__(self, data: bytes):
        self.data, self.at, self.end = data, 4, "<" if data[1] & 1 else ">"

    def take(self, form: str, size: int, n: int = 1) -> tuple:
        self.at += (4 - self.at) % size
        out = struct.unpack_from(f"{self.end}{n}{form}", self.data, self.at)
        self.at += size * n
        return out

    def text(self) -> str:
        (n,) = self.take("I", 4)
        self.at += n
        return self.data[self.at - n : self.at].rstrip(b"\0").decode()


def _imu(data: bytes) -> dict:
    c = _Cdr(data)
    out = {"sec": c.take("i", 4)[0], "nsec": c.take("I", 4)[0], "frame_id": c.text()}
    return out | {k: list(c.take("d", 8, n)) for k, n in _IMU}


def _image(data: bytes) -> dict:
    c = _Cdr(data)
    out = {"sec": c.take("i", 4)[0], "nsec": c.take("I", 4)[0], "frame_id": c.text(), "format": c.text()}
    (n,) = c.take("I", 4)
    return out | {"image": c.data[c.at : c.at + n]}


_HEAD = "sec int, nsec bigint, frame_id string"
PAYLOADS = {"imu": (_imu, f"{_HEAD}, " + ", ".join(f"{k} array<double>" for k, _ in _IMU)), "compressed_image": (_image, f"{_HEAD}, format string, image binary")}


def decoded(rows: DataFrame, kind: str, data: str = "data") -> DataFrame:
    """rows with the fields of their payload in place of it (kind: imu or compressed_image); a null, cut or foreign payload has null fields."""
    parse, schema = PAYLOADS[kind]
    names = [x.split()[0] for x in schema.split(", ")]
    kept = [f for f in rows.schema if f.name != data and f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(data).to_pylist():
                try:
                    out.append(parse(x) if x else {})
                except (struct.error, UnicodeDecodeError, IndexError):
                    out.append({})
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), *(pa.array([r.get(n) for r in out], t) for n, t in zip(names, kinds, strict=True))], [*(f.name for f in kept), *names])

    of = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    kinds = [of[x.split(" ", 1)[1]] for x in schema.split(", ")]
    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), schema]))


def log_order(rows: DataFrame) -> DataFrame:
    """All topics merged by log time; ties by topic and sequence. A total sort, in ranges of time."""
    return rows.orderBy("log_time", "topic", F.col("sequence"))
