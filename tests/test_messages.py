"""Message logs: round trips, pruning by index, damaged and cut files, streams in order."""

import io
import random
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sightline.operators import relational as R
from sightline.sources import messages as M
from sightline.streaming import ordered


@pytest.fixture
def log(spark, tmp_path):
    spark.dataSource.register(M.MessageLog)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    r = random.Random(1)
    rows = [(r.choice(["/imu", "/image", "/tf"]), r.choice(["a/Imu", None]), "cdr", k, 1000 + (k * 7919) % 3000, 5000 + k, bytes([k % 256]) * (k % 50)) for k in range(3000)]
    df = spark.createDataFrame(rows, "topic string, schema_name string, encoding string, sequence long, log_time long, publish_time long, data binary")
    df.repartition(2, "sequence").write.format("messages").mode("append").option("chunk_bytes", 6000).save(str(tmp_path / "log"))
    return rows, str(tmp_path / "log")


def test_round_trip_order_and_tasks(spark, log):
    rows, path = log
    got = spark.read.format("messages").option("task_bytes", 2000).load(path)
    assert got.rdd.getNumPartitions() >= 4
    ordered_rows = [tuple(x[:7]) for x in M.log_order(got).collect()]
    assert ordered_rows == [(*x[:6], bytearray(x[6])) for x in sorted(rows, key=lambda x: (x[4], x[0], x[3]))]
    files = M._files(path)
    assert len(files) == 2 and M._files(",".join(files)) == files
    assert spark.read.format("messages").load(f"file://{files[0]}").count() + spark.read.format("messages").load(files[1]).count() == 3000


def test_filters_reach_the_chunks(spark, log):
    rows, path = log
    got = spark.read.format("messages").load(path).where("topic = '/imu' and log_time >= 1200 and log_time < 1400")
    want = [x for x in rows if x[0] == "/imu" and 1200 <= x[4] < 1400]
    assert sorted(x.sequence for x in got.collect()) == sorted(x[3] for x in want)
    # sorted by time, most chunks are not read
    file = io.BytesIO()
    assert M.write_file(iter(sorted(rows, key=lambda x: x[4])), file, 4000) == 3000
    index = M.chunk_index(file, len(file.getvalue()))
    wanted = M.Wanted(frozenset(["/imu"]), 1200, 1399)
    kept = [x for x in index if wanted.time(x[2], x[3])]
    assert 0 < len(kept) < len(index) / 5 and all(set(x[4]) <= {"/imu", "/image", "/tf"} for x in index)


def test_cut_damaged_and_foreign_files(spark, log, tmp_path):
    rows, path = log
    file = M._files(path)[0]
    data = open(file, "rb").read()
    whole = [r.sequence for r in spark.read.format("messages").load(file).collect()]
    (tmp_path / "cut.mcap").write_bytes(data[: len(data) * 2 // 3])
    cut = [r.sequence for r in spark.read.format("messages").load(str(tmp_path / "cut.mcap")).collect()]
    assert 0 < len(cut) < len(whole) and cut == whole[: len(cut)]
    spoiled = bytearray(data)
    at = M.chunk_index(io.BytesIO(data), len(data))[0][0]
    spoiled[at + 9 + 24] ^= 0xFF  # the checksum
    (tmp_path / "bad.mcap").write_bytes(spoiled)
    with pytest.raises(Exception, match="damaged"):
        spark.read.format("messages").load(str(tmp_path / "bad.mcap")).collect()
    (tmp_path / "other.mcap").write_bytes(b"text")
    with pytest.raises(Exception, match="not a message log"):
        spark.read.format("messages").load(str(tmp_path / "other.mcap")).count()
    with pytest.raises(Exception, match="no such log"):
        spark.read.format("messages").load(str(tmp_path / "absent.mcap")).count()
    empty = io.BytesIO()
    assert M.write_file(iter(()), empty) == 0
    (tmp_path / "empty.mcap").write_bytes(empty.getvalue())
    assert spark.read.format("messages").load(str(tmp_path / "empty.mcap")).count() == 0


def test_stream_of_growing_files(spark, log, tmp_path):
    rows, path = log
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    first, second = M._files(path)
    data = open(first, "rb").read()
    (folder / "a.mcap").write_bytes(data[: len(data) // 2])

    def take():
        stream = spark.readStream.format("messages").load(str(folder)).select("sequence")
        stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
        return [r.sequence for r in spark.read.parquet(str(out)).collect()]

    half = take()
    assert 0 < len(half) < 3000
    (folder / "a.mcap").write_bytes(data)
    (folder / "b.mcap").write_bytes(open(second, "rb").read())
    assert sorted(take()) == list(range(3000))


def test_payloads(spark):
    def pad(b, n):
        return b + b"\0" * (-(len(b) - 4) % n)

    imu = pad(struct.pack("<BBHiI", 0, 1, 0, 12, 345) + struct.pack("<I", 4) + b"cam\0", 8) + struct.pack("<37d", *range(37))
    image = pad(struct.pack("<BBHiI", 0, 1, 0, 1, 2) + struct.pack("<I", 2) + b"c\0", 4) + struct.pack("<I", 5) + b"jpeg\0"
    image = pad(image, 4) + struct.pack("<I", 3) + b"abc"
    df = spark.createDataFrame([(1, imu), (2, b""), (3, None), (4, imu[:40])], "id long, data binary")
    got = {r.id: r for r in M.decoded(df, "imu").collect()}
    assert got[1].sec == 12 and got[1].nsec == 345 and got[1].frame_id == "cam" and got[1].angular_velocity == [13.0, 14.0, 15.0] and got[1].linear_acceleration == [25.0, 26.0, 27.0]
    assert all(got[k].sec is None and got[k].orientation is None for k in (2, 3, 4))
    got = M.decoded(spark.createDataFrame([(image,)], "data binary"), "compressed_image").first()
    assert (got.sec, got.frame_id, got.format, bytes(got.image)) == (1, "c", "jpeg", b"abc")


def shuffled_files(spark, folder, rows, schema, batches=6, seed=3):
    """Files of rows a little out of order, one a micro-batch."""
    r = random.Random(seed)
    rows = sorted(rows, key=lambda x: x[1].timestamp() + r.uniform(0, 50))
    n = -(-len(rows) // batches)
    for k in range(batches):
        spark.createDataFrame(rows[k * n : (k + 1) * n], schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run(spark, frame, tmp_path, name):
    frame.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"at-{name}")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


SCHEMA = "who string, at timestamp, id long, value double"


def events(n=600):
    r = random.Random(7)
    t0 = pd.Timestamp("2026-01-01")
    return [(r.choice("ab"), (t0 + pd.Timedelta(seconds=k // 2)).to_pydatetime(), k, r.uniform(0, 100)) for k in range(n)]


def test_rows_leave_in_order(spark, tmp_path):
    rows = events()
    got = run(spark, ordered.in_order(shuffled_files(spark, tmp_path / "in", rows, SCHEMA), "who", "at", "60 seconds", ["id"]), tmp_path, "released").collect()
    for who in "ab":
        mine = sorted((x for x in got if x.who == who), key=lambda x: x.place)
        want = [x[2] for x in sorted((x for x in rows if x[0] == who), key=lambda x: (x[1], x[2]))]
        assert [x.place for x in mine] == list(range(len(mine))) and [x.id for x in mine] == want[: len(mine)] and len(mine) > 0.6 * len(want)


def test_topics_merge_in_order(spark, tmp_path):
    rows = events()
    streams = {name: shuffled_files(spark, tmp_path / name, [x for x in rows if x[2] % 2 == odd], SCHEMA, seed=odd) for name, odd in (("imu", 1), ("image", 0))}
    streams["image"] = streams["image"].withColumn("width", F.lit(640))
    got = run(spark, ordered.merged_in_order(streams, "at", "who", "80 seconds"), tmp_path, "topics").collect()
    for who in "ab":
        mine = sorted((x for x in got if x.who == who), key=lambda x: x.place)
        want = sorted(((x[1], "imu" if x[2] % 2 else "image") for x in rows if x[0] == who))
        assert [(x.at, x.topic) for x in mine] == want[: len(mine)] and len(mine) > 0.5 * len(want)
        assert all((x.width == 640) == (x.topic == "image") for x in mine)


def test_selection_on_a_stream_equals_batch(spark, tmp_path):
    rows = events()
    end = ("a", pd.Timestamp("2026-01-02").to_pydatetime(), 10_000, 0.0)
    stream = shuffled_files(spark, tmp_path / "in", rows, SCHEMA)
    spark.createDataFrame([end], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = run(spark, ordered.selected_in_order(stream, "who", "at", "id", "value", 20.0, 30, "60 seconds"), tmp_path, "selection")
    counts = {(r.who, r.reason): r["count"] for r in got.groupBy("who", "reason").count().collect()}
    batch = R.greedy_selection(spark.createDataFrame(rows, SCHEMA), "who", ["at", "id"], "value", 20.0, 30).collect()
    assert len(batch) == 2
    for b in batch:
        assert all(counts.get((b.who, k), 0) == b[k] for k in ("selected", "near_duplicate", "max_selected"))


def test_a_long_key_is_folded_in_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        df = spark.range(200_000).select((F.col("id") % 20 == 0).cast("string").alias("k"), "id", (F.col("id") % 97).cast("double").alias("v"))
        got = {r.k: r for r in R.greedy_selection(df, "k", ["id"], "v", 10.0, 50_000).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in ("true", "false"):
        last, n, near, full = None, 0, 0, 0
        for i in range(200_000):
            if (i % 20 == 0) == (k == "true"):
                v = i % 97
                if n >= 50_000:
                    full += 1
                elif last is not None and abs(v - last) < 10:
                    near += 1
                else:
                    last, n = v, n + 1
        assert (got[k].selected, got[k].near_duplicate, got[k].max_selected) == (n, near, full)
