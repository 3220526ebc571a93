"""Dictionary-compressed WARC archives: writing web pages, and reading the archives back.

An archive starts with a skippable frame (magic 0x184D2A5D) that embeds a Zstandard dictionary;
each record follows as a frame of its own, compressed with it. The dictionary is built once from a
bounded sample of the records (SAMPLE_RECORDS, those whose ids have the smallest hashes).

Of pages with equal payloads of at least REVISIT_BYTES, that with the largest id is a response and
the others are revisits that refer to it.

Tasks write into the shared folder under names that no other attempt uses, and report a file only
when it is complete. The reader takes the reported files alone, so a task that is run again after
an executor was lost leaves at most a file that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import bounded_batches, cut, shared_dir

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000
SAMPLE_RECORDS, DICTIONARY_BYTES, LEVEL = 400, 32768, 3
#: Keys that equal payloads spread over; bytes after which an archive is closed; payload bytes of a batch read back.
SALTS, FILE_BYTES, BATCH_BYTES = 16, 64 << 20, 8 << 20
DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str = DATE) -> bytes:
    """One WARC record; a revisit carries the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    urn = lambda x: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {x}')}>"
    fields = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": urn(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe="%:/?#[]@!$&'()*+,;=-._~"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "WARC-Profile": REVISIT_PROFILE if is_revisit else None,
        "WARC-Refers-To": urn(refers_to) if is_revisit else None,
        "X-Page-ID": page_id,
        "X-Refers-To-Page-ID": refers_to if is_revisit else None,
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary; empty if the samples are too few or too small for one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


class Squeezer:
    """Head and frames of an archive."""

    def __init__(self, dictionary: bytes):
        self.head = struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary
        with_dict = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.frame = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True, **with_dict).compress


def archive(records: Iterator[bytes], dictionary: bytes) -> bytes:
    squeezer = Squeezer(dictionary)
    return b"".join([squeezer.head, *map(squeezer.frame, records)])


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at at ends: its blocks' headers give their sizes."""
    end = at + zstandard.frame_header_size(data[at : at + 18])
    while True:
        head = int.from_bytes(data[end : end + 3], "little")
        end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return end + (4 if zstandard.get_frame_parameters(data[at : at + 18]).has_checksum else 0)


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    view = memoryview(data)
    magic, size = struct.unpack("<II", view[:8])
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    dictionary = bytes(view[8 : 8 + size])
    expand = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))
    at = 8 + size
    while at < len(data):
        end = _frame_end(view, at)
        yield expand.decompress(view[at:end])
        at = end


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record; a revisit has no payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _told(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """_id, _url, _payload, _keep: what each page becomes. _keep is null, or the id of its payload's response.

    Responses are found on digests and ids alone. Pages then meet them under one of SALTS keys of
    their digest, so that copies of one payload spread over as many tasks, and pages too small for
    a revisit under keys of their own.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("_payload"))
    rows = rows.withColumn("_same", F.when(F.octet_length("_payload") >= REVISIT_BYTES, F.struct(F.sha1("_payload").alias("h"), F.octet_length("_payload").alias("n"), F.xxhash64("_payload").alias("x"))))
    largest = rows.where(F.col("_same").isNotNull()).groupBy("_same").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("_same", "_keep")
    spread = largest.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.when(F.col("_same").isNull(), F.lit(SALTS) + F.pmod(F.xxhash64("_id", "_url"), F.lit(1 << 30))).otherwise(F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS))).cast("int")
    return rows.withColumn("_salt", salt).join(spread, ["_same", "_salt"], "left").select("_id", "_url", "_payload", "_keep")


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives in the folder (a URI that all executors reach): one row per file, (file, n_records, n_bytes).

    A task writes its records one by one and starts a new file after FILE_BYTES.
    A null html is an empty payload, a null url has no target field, a null id no id field; copies
    of the row with the largest id are all responses; other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    told = _told(pages, id_col, url_col, html_col)
    chosen = pages.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_RECORDS)  # ids first: each task sends its smallest ones
    sample = pages.select(id_col, url_col, html_col).join(F.broadcast(chosen), id_col).limit(SAMPLE_RECORDS).collect()
    dictionary = train([record(r[0], r[1], (r[2] or "").encode(), None, False) for r in sample])

    def run(batches):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        squeezer = Squeezer(dictionary)
        rows = (row for batch in batches for row in zip(*(batch.column(c) for c in ("_id", "_url", "_payload", "_keep")), strict=True))
        for first in rows:
            name, n, size = f"{uuid.uuid4().hex}.warc.zst", 0, len(squeezer.head)
            with system.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(squeezer.head)
                for row in chain([first], rows):
                    i, u, p, k = (x.as_py() for x in row)
                    frame = squeezer.frame(record(i, u, p, k, k is not None and k != i))
                    out.write(frame)
                    n, size = n + 1, size + len(frame)
                    if size >= FILE_BYTES:
                        break
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n], "n_bytes": [size]})

    return cut(told.mapInArrow(run, "file string, n_records long, n_bytes long"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    types = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """One row per record of the files: page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to.

    A response's length and digest are computed from its payload, a revisit's are those it states.
    A response that doesn't match its stated digest is an error.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    raw = raw.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content").join(files.select("file"), "file", "left_semi")

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for r in records_of(content.as_py()):
                    fields, payload = parse(r)
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    response = fields["WARC-Type"] == "response"
                    if response and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't match its digest")
                    number = lambda k, f=fields: int(f[k]) if k in f else None
                    rows.append((number("X-Page-ID"), fields.get("WARC-Target-URI"), payload if response else None, len(payload) if response else number("X-Payload-Length"), digest, fields["WARC-Type"], number("X-Refers-To-Page-ID")))
                    size += len(payload) + 200
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return raw.select("content").mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def new_folder(spark: SparkSession, name: str = "warc") -> str:
    """A fresh folder below the shared one, as a URI."""
    from pyarrow import fs

    base = shared_dir(spark)
    base = base if re.match(r"\w+:", base) else f"file://{base}"
    folder = f"{re.sub(r'^file:/+', 'file:///', base)}/{name}-{uuid.uuid4().hex}"
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return folder
