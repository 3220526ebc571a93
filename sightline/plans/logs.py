"""Queries over message logs: events written as a log of several topics and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.plans.catalog import n_rows, query, t
from sightline.plans.files import folder
from sightline.sources import messages


def _log(spark, sf, order: str):
    """events as a log: a topic for each type, dealt to files in an order that isn't that of time."""
    spark.dataSource.register(messages.MessageLog)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    e = t(spark, sf, "events").select(
        F.col("event_type").alias("topic"), F.lit("event").alias("schema_name"), F.lit("json").alias("encoding"), F.col("event_id").alias("sequence"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("log_time"), (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + F.col("user_id")).alias("publish_time"), F.encode(F.coalesce("props", F.lit("")), "utf-8").alias("data"),
    )
    at = folder(spark, "log")
    e.repartition(4, order).write.format("messages").mode("append").option("chunk_bytes", 20000).save(at)
    return spark.read.format("messages").option("task_bytes", 40000).load(at)


@query("""WITH e AS (SELECT event_type AS topic, event_id AS sequence, epoch_us(ts) * 1000 AS log_time, user_id, coalesce(props, '') AS payload FROM events), b AS (SELECT CAST(min(log_time) + (max(log_time) - min(log_time)) // 4 AS BIGINT) AS low, CAST(max(log_time) AS BIGINT) AS high FROM e)
SELECT topic, sequence, log_time, log_time + user_id AS publish_time, payload FROM e, b WHERE topic IN ('click', 'purchase') AND log_time >= low AND log_time < high""")
def message_log(spark, sf):
    """Two topics of a log from a time on; chunks without them are not read."""
    log = _log(spark, sf, "log_time")
    low, high = t(spark, sf, "events").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))) * 1000, F.max(F.unix_micros(F.col("ts").cast("timestamp"))) * 1000).first()
    got = log.where(F.col("topic").isin("click", "purchase") & (F.col("log_time") >= low + (high - low) // 4) & (F.col("log_time") < high))
    return got.select("topic", "sequence", "log_time", "publish_time", F.decode("data", "utf-8").alias("payload"))


@query("""WITH e AS (SELECT event_type AS topic, event_id AS sequence, epoch_us(ts) * 1000 AS log_time, user_id FROM events), m AS (SELECT *, lag(topic) OVER (PARTITION BY user_id ORDER BY log_time, topic, sequence) AS before FROM e)
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE before IS NOT NULL AND before <> topic) AS changes, CAST(min(log_time) AS BIGINT) AS first, CAST(max(log_time) AS BIGINT) AS last FROM m GROUP BY user_id""")
def message_order(spark, sf):
    """All topics of a log merged by log time, per sender: how often the topic changes."""
    log = _log(spark, sf, "sequence").withColumn("user_id", F.col("publish_time") - F.col("log_time"))
    w = W.partitionBy("user_id").orderBy("log_time", "topic", "sequence")
    m = log.withColumn("before", F.lag("topic").over(w))
    return m.groupBy("user_id").agg(n_rows("n"), F.count_if(F.col("before") != F.col("topic")).alias("changes"), F.min("log_time").alias("first"), F.max("log_time").alias("last"))
