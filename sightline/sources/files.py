"""Text sources and sinks with the studio's conventions: TSV, JSON lines, logs, trajectories, SfM text models."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window as W

LINEAGE = ("source_file", "source_offset")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and their number in it (from 0).

    Long files stay split: lines are numbered within their split, and the splits' line counts, one
    row each, give each split its first number.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("_file").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy(F.col("source_file").alias("_file"), F.col("_block").alias("_at")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", before)
    numbered = rows.withColumn("_nth", F.row_number().over(W.partitionBy("source_file", "_block").orderBy("_id")) - 1)
    both = numbered.join(sizes, (F.col("source_file") == F.col("_file")) & (F.col("_block") == F.col("_at")))
    return both.select("source_file", (F.col("_nth") + F.col("_before")).cast("int").alias("source_offset"), "line")


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """TSV with a header: the named columns as strings, empty as null, others ignored; adds source_file."""
    header = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    kept = [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if c in header.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return header.select(*kept, F.col("_metadata.file_path").alias("source_file"))


def read_tsv_or_empty(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """read_tsv, or no rows where the path doesn't exist. Asked through Spark's file system, whatever the store."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return read_tsv(spark, path, columns)
    schema = StructType()
    for c in (*columns, "source_file"):
        schema = schema.add(c, StringType())
    return spark.createDataFrame([], schema)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines with source_file and source_line (from 1); blank lines are skipped. A bad line is fatal if strict, with its place in the error, else it is dropped."""
    lines = _lines(spark, path).where(F.trim("line") != "")
    parsed = lines.withColumn("_r", F.from_json("line", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"}))
    bad = F.col("_r._corrupt_record").isNotNull()
    place = F.concat(F.col("source_file"), F.lit(" line "), (F.col("source_offset") + 1).cast("string"), F.lit(" is no JSON object"))
    rows = parsed.where(F.when(bad, F.raise_error(place).cast("boolean")).otherwise(True) if strict else ~bad)
    fields = [f for f in rows.schema["_r"].dataType.names if f != "_corrupt_record"]
    return rows.select(*(F.col("_r")[f].alias(f) for f in fields), "source_file", (F.col("source_offset") + 1).alias("source_line"))


def count_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One row: scanned (all lines but blank ones), malformed."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(F.try_parse_json("value").isNull()).alias("malformed"))


def read_json_records(spark: SparkSession, path: str, keys: tuple[str, ...], suffixes: tuple[str, ...]) -> DataFrame:
    """Records of JSON documents by descent: an object with a number under a residual-like key is a record, others are searched.

    One row per record in document order: source_file, place (from 0) and record, the object's
    scalar fields as text. A file is one document, so it is parsed whole.
    """

    def numeric(v) -> bool:
        try:
            return v is not None and not isinstance(v, bool | list | dict) and math.isfinite(float(v))
        except ValueError:
            return False

    def records(x):
        if isinstance(x, list):
            for item in x:
                yield from records(item)
        elif isinstance(x, dict):
            if any(numeric(v) for k, v in x.items() if k in keys or k.lower().endswith(suffixes)):
                yield x
            else:
                for v in x.values():
                    yield from records(v)

    def run(batches):
        for pdf in batches:
            out = []
            for file, text in zip(pdf["source_file"], pdf["value"], strict=True):
                for n, r in enumerate(records(json.loads(text))):
                    out.append((file, n, {k: v if isinstance(v, str) else json.dumps(v) for k, v in r.items() if v is not None and not isinstance(v, list | dict)}))
            yield pd.DataFrame(out, columns=["source_file", "place", "record"])

    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    return texts.mapInPandas(run, "source_file string, place int, record map<string,string>")


def read_manifest(spark: SparkSession, path: str, columns: list[str], index: str = "camera_index") -> DataFrame:
    """A camera manifest with its order from 0: by index where all rows have one (ties by row), else by row."""
    lines = _lines(spark, path)
    header = lines.where("source_offset = 0").select("source_file", F.split("line", "\t").alias("_h"))
    named = lines.where("source_offset > 0 and line <> ''").join(F.broadcast(header), "source_file").withColumn("_m", F.map_from_arrays("_h", F.transform(F.split("line", "\t", -1), lambda v: F.nullif(v, F.lit("")))))
    rows = named.select(*(F.col("_m")[c].alias(c) for c in columns), F.col("source_offset").alias("_row"))
    whole = W.partitionBy()  # a manifest has one row per camera
    at = F.when(F.count_if(F.col(index).try_cast("int").isNull()).over(whole) == 0, F.col(index).try_cast("int")).otherwise(0)
    return rows.withColumn("_at", at).withColumn("place", F.row_number().over(W.orderBy("_at", "_row")) - 1).select("place", *columns)


def write_tsv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """The columns (default: all, sorted by name) with a header."""
    df.select(*(columns or sorted(df.columns))).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="")


def write_jsonl(df: DataFrame, path: str, lineage: dict[str, str] | None = None) -> None:
    """One JSON object per row; lineage columns go into a sub-object _selected."""
    lineage = lineage or {}
    own = [c for c in df.columns if c not in lineage]
    parts = [*own, F.struct(*(F.col(c).alias(n) for c, n in lineage.items())).alias("_selected")] if lineage else own
    df.select(F.to_json(F.struct(*parts)).alias("value")).write.mode("overwrite").text(path)


def write_summary(df: DataFrame, path: str) -> None:
    """One JSON object per row with its keys sorted, nulls kept."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_sfm_images(df: DataFrame, path: str) -> None:
    """The text model that read_sfm_images reads, from its pose columns, name and points (array of struct x, y, id)."""
    head = F.concat_ws(" ", *(F.col(c).cast("string") for c in ("image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id", "name")))
    points = F.array_join(F.transform("points", lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"), p["id"].cast("string"))), " ")
    df.select(F.concat_ws("\n", head, points).alias("value")).write.mode("overwrite").text(path)


def read_feature_log(spark: SparkSession, path: str) -> DataFrame:
    """(src, features) of lines like '..._src12_...: 345 features'; the last line of a src wins."""
    got = _lines(spark, path).select("source_file", "source_offset", F.nullif(F.regexp_extract("line", r"_src(\d+)_.*?: (\d+) features", 1), F.lit("")).cast("bigint").alias("src"), F.nullif(F.regexp_extract("line", r"_src(\d+)_.*?: (\d+) features", 2), F.lit("")).cast("bigint").alias("features"))
    return got.where("src is not null").groupBy("src").agg(F.max_by("features", F.struct("source_file", "source_offset")).alias("features"))


def read_trajectory(spark: SparkSession, path: str) -> DataFrame:
    """Lines 'stamp tx ty tz qx qy qz qw'; comments (#) and blank lines are skipped."""
    parts = F.split(F.trim("value"), r"\s+")
    names = ("stamp", "tx", "ty", "tz", "qx", "qy", "qz", "qw")
    rows = spark.read.text(path).where("trim(value) <> '' and not startswith(trim(value), '#')")
    return rows.select(*(F.get(parts, F.lit(k)).cast("double").alias(n) for k, n in enumerate(names)))


def read_sfm_images(spark: SparkSession, path: str) -> DataFrame:
    """Pose, name and point counts of a text model's images: a header line, then a line of point triplets."""
    lines = _lines(spark, path).where("not startswith(line, '#')")
    w = W.partitionBy("source_file").orderBy("source_offset")
    paired = lines.withColumns({"n": F.row_number().over(w) - 1, "points": F.lead("line").over(w)}).where("n % 2 = 0 and trim(line) <> ''")
    head = F.split(F.trim("line"), r"\s+")
    ids = F.filter(F.filter(F.split(F.trim("points"), r"\s+"), lambda v: v != ""), lambda _, k: k % 3 == 2)
    pose = [F.get(head, F.lit(k + 1)).cast("double").alias(n) for k, n in enumerate(("qw", "qx", "qy", "qz", "tx", "ty", "tz"))]
    return paired.select(F.get(head, F.lit(0)).cast("bigint").alias("image_id"), *pose, F.get(head, F.lit(8)).cast("bigint").alias("camera_id"), F.get(head, F.lit(9)).alias("name"), F.size(ids).alias("point2d_count"), F.size(F.filter(ids, lambda v: v != "-1")).alias("triangulated_point_count"))


def count_entries(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments."""
    return spark.read.text(path).where("trim(value) <> '' and not startswith(value, '#')").agg(F.count(F.lit(1)).alias("n"))


def discover(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files below path whose name matches the pattern, once each, with time and camera taken from the last two folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    named = files.withColumn("name", F.regexp_extract("path", "([^/]*)$", 1)).where(F.col("name").rlike(pattern)).dropDuplicates(["path"])
    return named.select("path", "name", "length", F.regexp_extract("path", "([^/]+)/([^/]+)/[^/]*$", 1).alias("time"), F.regexp_extract("path", "([^/]+)/([^/]+)/[^/]*$", 2).alias("camera"))


def simple_yaml(text: str) -> dict:
    """'key: value' lines; values become bool, int, float or text, in that order of trial. Comments and blank lines are skipped."""
    out = {}
    for line in text.splitlines():
        line = line.split("#", 1)[0].strip()
        if ":" not in line:
            continue
        key, value = (p.strip() for p in line.split(":", 1))
        if value.lower() in ("true", "false"):
            out[key] = value.lower() == "true"
            continue
        for kind in (int, float, str):
            try:
                out[key] = kind(value.strip("'\""))
                break
            except ValueError:
                continue
    return out


def yaml_numbers(text: Column, key: str) -> Column:
    """The numbers of a YAML list, in brackets or one per line, as an array; null without the key."""
    body = F.regexp_extract(text, rf"(?m)^{key}[ \t]*:[ \t]*((?:\[[^\]]*\])|(?:\s*\n[ \t]*-[ \t]+[-+0-9.eE]+)+)", 1)
    found = F.regexp_extract_all(F.regexp_replace(body, r"(?m)^[ \t]*-[ \t]+", ""), F.lit(r"([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)"), 1)
    return F.when(body != "", F.transform(found, lambda x: x.cast("double")))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """feature_id, x, y, z of points files: a flat list points and a map from feature_id to point_index. A length that three doesn't divide is an error."""
    text = spark.read.text(path, wholetext=True)
    flat = yaml_numbers(F.col("value"), "points")
    pair = lambda k: F.transform(F.regexp_extract_all("value", F.lit(rf"{k}[ \t]*:[ \t]*(\d+)"), 1), lambda x: x.cast("int"))
    checked = F.when(F.size("flat") % 3 != 0, F.raise_error(F.lit("points: size is not divisible by 3")).cast("array<double>")).otherwise(F.col("flat"))
    rows = text.select(flat.alias("flat"), F.explode(F.arrays_zip(pair("feature_id").alias("f"), pair("point_index").alias("i"))).alias("m")).withColumn("flat", checked)
    return rows.select(F.col("m.f").alias("feature_id"), *(F.get("flat", F.col("m.i") * 3 + k).alias(n) for k, n in enumerate("xyz")))


def read_camera_models(spark: SparkSession, path: str) -> DataFrame:
    """source_file, type, width, height and parameters of camera model files. A size below 1 is an error."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    field = lambda k: F.nullif(F.regexp_extract("value", rf"(?m)^{k}[ \t]*:[ \t]*[\"']?([^\s\"']+)", 1), F.lit(""))
    size = lambda k: F.when(field(k).try_cast("int") >= 1, field(k).try_cast("int")).otherwise(F.raise_error(F.concat(F.lit(f"invalid {k}: "), F.col("source_file"))).cast("int"))
    return text.select("source_file", field("type").alias("type"), size("width").alias("width"), size("height").alias("height"), yaml_numbers(F.col("value"), "parameters").alias("parameters"))


def intrinsics_paths(listing: DataFrame, cameras: DataFrame, path: str = "path", camera: str = "camera_index") -> DataFrame:
    """Each camera's file: intrinsics<camera>.yaml, else the first of those that start with intrinsics<camera>_, else null."""
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    of = F.regexp_extract(name, r"^intrinsics(\d+)(?:_.*)?\.yaml$", 1)
    files = listing.select(F.col(path), of.try_cast("int").alias(camera), name.rlike(r"_").alias("_long")).where(F.col(camera).isNotNull())
    best = files.groupBy(camera).agg(F.min_by(path, F.struct("_long", path)).alias("intrinsics"))
    return cameras.join(best, camera, "left")


POSE = ("index", "tx", "ty", "tz", "qx", "qy", "qz", "qw")


def read_poses(spark: SparkSession, path: str, count: int | None = None) -> DataFrame:
    """Poses of a YAML list of mappings (index, tx .. qw), one key per line; with count, absent indices come with used = false."""
    pairs = _lines(spark, path).select("source_file", "source_offset", F.regexp_extract("line", r"^\s*(-?)\s*(\w+)\s*:\s*(\S+)\s*$", 1).alias("dash"), F.regexp_extract("line", r"^\s*(-?)\s*(\w+)\s*:\s*(\S+)\s*$", 2).alias("k"), F.regexp_extract("line", r"^\s*(-?)\s*(\w+)\s*:\s*(\S+)\s*$", 3).alias("v"))
    w = W.partitionBy("source_file").orderBy("source_offset")
    items = pairs.where(F.col("k").isin(*POSE)).withColumn("item", F.sum((F.col("dash") == "-").cast("int")).over(w))
    poses = items.groupBy("source_file", "item").agg(*(F.max(F.when(F.col("k") == k, F.col("v"))).cast("int" if k == "index" else "double").alias(k) for k in POSE)).select(*POSE)
    if count is None:
        return poses.withColumn("used", F.lit(True))
    return spark.range(count).select(F.col("id").cast("int").alias("index")).join(poses, "index", "left").withColumn("used", F.col("qw").isNotNull())


def write_poses(df: DataFrame, path: str) -> None:
    """The list that read_poses reads, one item per row."""
    lines = F.concat_ws("\n", *(F.concat(F.lit("- " if k == "index" else "  "), F.lit(f"{k}: "), F.col(k).cast("string")) for k in POSE))
    df.select(lines.alias("value")).write.mode("overwrite").text(path)


def write_obj(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Points (x, y, z) as vertices; with by, a folder for each value of these columns, nested in their order."""
    rows = df.select(*(by or []), F.format_string("v %s %s %s", *(F.col(c).cast("string") for c in "xyz")).alias("value"))
    (rows.repartition(*by) if by else rows).write.mode("overwrite").partitionBy(*(by or [])).text(path)


def ply(points: list[tuple], names: tuple[str, ...] = ("x", "y", "z")) -> str:
    """An ASCII PLY cloud."""
    head = ["ply", "format ascii 1.0", f"element vertex {len(points)}", *(f"property float {n}" for n in names), "end_header"]
    return "\n".join([*head, *(" ".join(map(repr, p)) for p in points)]) + "\n"


def read_ply(spark: SparkSession, path: str) -> DataFrame:
    """Vertices of an ASCII PLY cloud, with all their properties as columns."""
    first = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", r"(?s)^(.*?end_header)\r?\n", 1)).first()[0]
    names = [line.split()[-1] for line in first.splitlines() if line.startswith("property ") and " list " not in line]
    rows = _lines(spark, path).withColumn("body", F.max(F.when(F.col("line") == "end_header", F.col("source_offset"))).over(W.partitionBy("source_file")))
    parts = F.split(F.trim("line"), r"\s+")
    return rows.where("source_offset > body and trim(line) <> ''").select(*(F.get(parts, F.lit(k)).cast("double").alias(n) for k, n in enumerate(names)))


def read_mesh_project(spark: SparkSession, path: str) -> DataFrame:
    """Meshes of a mesh-project XML: label, filename, matrix text."""
    df = spark.read.option("rowTag", "MLMesh").option("attributePrefix", "_").format("xml").load(path)
    return df.select(F.col("_label").alias("label"), F.col("_filename").alias("filename"), F.trim(F.col("MLMatrix44").cast("string")).alias("matrix"))
