"""Joins and look-ups of the studio's tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_last(rows: DataFrame, selected: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows whose key is selected, with the fields of the key's last selected row by order."""
    fields = [c for c in selected.columns if c not in keys]
    last = selected.groupBy(*keys).agg(F.max_by(F.struct(*fields), order).alias("_last"))
    return rows.join(last, keys).select(*rows.columns, *(F.col(f"_last.{f}").alias(f) for f in fields))


def flag_members(rows: DataFrame, members: DataFrame, keys: list[str], coordinates: list[str], name: str, digits: int = 9) -> DataFrame:
    """rows with a column name, yes or no: does members have a row of the same keys and coordinates, to so many digits."""
    exact = lambda c: F.round(F.col(c), digits).cast(f"decimal(28,{digits})").alias(f"_{c}")
    known = members.select(*keys, *(exact(c) for c in coordinates)).distinct().withColumn("_member", F.lit(True))
    marked = rows.select("*", *(exact(c) for c in coordinates)).join(known, [*keys, *(f"_{c}" for c in coordinates)], "left")
    return marked.withColumn(name, F.when(F.col("_member"), "yes").otherwise("no")).select(*rows.columns, name)


def first_existing(rows: DataFrame, listing: DataFrame, key: str, candidates: str, path: str) -> DataFrame:
    """rows with found, the first of the candidate paths (an array column) that the listing has, null if none; and unchecked, the first at all."""
    each = rows.select(key, F.posexplode(candidates).alias("_n", path)).join(listing.select(path).distinct(), path)
    found = each.groupBy(key).agg(F.min_by(path, "_n").alias("found"))
    return rows.withColumn("unchecked", F.get(F.col(candidates), F.lit(0))).join(found, key, "left")


def trimmed_pair(a: DataFrame, b: DataFrame, keys: list[str], at: Column, first: int, last: int) -> DataFrame:
    """Both logs' rows of common keys with first <= at <= last; a bound of 0 is none."""
    both = a.join(b, keys)
    both = both.where(at >= first) if first else both
    return both.where(at <= last) if last else both


def prefixed_lookup(rows: DataFrame, label: str, tables: dict[str, DataFrame], key: str, payload: str, default: str) -> DataFrame:
    """rows with payload from the table that the label's prefix names, by the rest of the label; the default where it has none."""
    union = reduce(DataFrame.unionByName, [d.select(F.concat(F.lit(prefix), F.col(key)).alias(label), payload) for prefix, d in tables.items()])
    return rows.join(union.dropDuplicates([label]), label, "left").withColumn(payload, F.coalesce(payload, F.lit(default)))


def checked_join(rows: DataFrame, reference: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rows, each checked against the reference row of its keys: none, or another name, is an error."""
    known = reference.select(*keys, F.col(name).alias("_name"), F.lit(True).alias("_known"))
    both = rows.join(known, keys, "left")
    at = F.concat_ws(",", *(F.col(k).cast("string") for k in keys))
    wrong = F.when(F.col("_known").isNull(), F.concat(F.lit("index out of range: "), at)).when(~F.col(name).eqNullSafe(F.col("_name")), F.concat(F.lit("file name mismatch: "), at))
    return both.where(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(True)).select(*rows.columns)


def frame_image(files: DataFrame, group: str, name: str, patterns: list[str], index: int) -> DataFrame:
    """Per group the image of a frame: the first name by the earliest pattern that any matches, else the name at the index, clamped, in sorted order.

    A group's names are one directory's listing, which a task can sort.
    """
    rank = reduce(lambda acc, k: F.when(F.regexp_like(name, F.lit(patterns[k])), k).otherwise(acc), reversed(range(len(patterns))), F.lit(None).cast("int"))
    n = F.count(F.lit(1)).cast("int")
    at = F.greatest(F.lit(0), F.least(F.lit(index), n - 1))
    ranked = files.withColumn("_rank", rank)
    hit = F.min_by(F.when(F.col("_rank").isNotNull(), F.col(name)), F.when(F.col("_rank").isNotNull(), F.struct("_rank", name)))
    return ranked.groupBy(group).agg(F.coalesce(hit, F.get(F.sort_array(F.collect_list(name)), at)).alias("image"))


def unique_append(lists: list[DataFrame], value: str, order: str) -> DataFrame:
    """value, part and order of the first place of each value in the appended lists."""
    every = reduce(DataFrame.unionByName, [d.select(value, F.lit(k).alias("part"), order) for k, d in enumerate(lists)])
    first = every.groupBy(value).agg(F.min(F.struct("part", order)).alias("_first"))
    return first.select(value, "_first.part", f"_first.{order}")


def assert_bounds(rows: DataFrame, key: str, value: str, low: float, high: float, shown: int = 20) -> DataFrame:
    """One row (n, verdict); values outside [low, high], null or NaN stop the query with an error that lists the smallest offending keys (shown at most, per task merged)."""
    v = F.col(value).cast("double")
    bad = v.isNull() | F.isnan(v) | (v < low) | (v > high)
    worst = rows.where(bad).select(F.col(key).cast("string").alias("_k")).orderBy("_k").limit(shown).agg(F.sort_array(F.collect_list("_k")).alias("_offenders"))
    counts = rows.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(worst))
    error = F.raise_error(F.concat(F.lit(f"{value} out of bounds: "), F.array_join("_offenders", ","))).cast("string")
    return counts.select("n", F.when(F.size("_offenders") > 0, error).otherwise("within bounds").alias("verdict"))


def target_points(spark: SparkSession, faces: int, rows: int, columns: int, tag_size: float, spacing: float, face_width: float, first_tag: int = 0, stride: int = 0, start: float = 0.0) -> DataFrame:
    """feature, face, x, y, z of every tag corner of a faceted target: feature is 4 tag + corner, tags count along rows, corners from the lower left on."""
    seq = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = spark.range(1).select(seq(faces).alias("face")).select("face", seq(rows).alias("row")).select("face", "row", seq(columns).alias("column"))
    corners = F.inline(F.array(*(F.struct(F.lit(k).alias("corner"), F.lit(a).alias("du"), F.lit(b).alias("dz")) for k, (a, b) in enumerate(((-1, -1), (1, -1), (1, 1), (-1, 1))))))
    c = grid.select("*", corners)
    pitch, half = tag_size + spacing, tag_size / 2
    theta = F.lit(start) + F.col("face") * 2 * F.pi() / faces
    u = (F.col("column") - 0.5 * (columns - 1)) * pitch + F.col("du") * half
    z = (F.col("row") - 0.5 * (rows - 1)) * pitch + F.col("dz") * half
    away = F.lit(face_width) / (2 * F.tan(F.pi() / faces))
    feature = (F.lit(first_tag) + F.col("face") * (stride or rows * columns) + F.col("row") * columns + F.col("column")) * 4 + F.col("corner")
    return c.select(feature.cast("bigint").alias("feature"), F.col("face").cast("bigint").alias("face"), (F.cos(theta) * away - F.sin(theta) * u).alias("x"), (F.sin(theta) * away + F.cos(theta) * u).alias("y"), z.alias("z"))


def candidate_residual_files(paths: DataFrame, path: str, known: set[str]) -> DataFrame:
    """The paths whose file name marks a residual table: a TSV or JSON file with a residual and a scope term that isn't a known camera table."""
    name = F.lower(F.regexp_extract(F.col(path), r"([^/\\]*)$", 1))
    ok = name.rlike(r"\.(tsv|json)$") & name.rlike("residual|reprojection|error") & name.rlike("observation|frame|tag|corner|face")
    return paths.where(ok & ~F.regexp_extract(F.col(path), r"([^/\\]*)$", 1).isin(sorted(known)) if known else ok)


def glob_pattern(glob: str) -> str:
    """The regular expression of a file name glob."""
    return "^" + "".join({"*": "[^/]*", "?": "[^/]"}.get(ch, re.escape(ch)) for ch in glob) + "$"
