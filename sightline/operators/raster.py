"""Raster operators on tables of pixels (image, x, y, v), worked on in square tiles.

A pixel that isn't there, and one with the value to ignore, takes no part. A tile is one task's unit of
bounded size; filters give it a rim of its neighbours' pixels, components are merged over tile borders only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.shared import checkpoint_dir
from sightline.functions.ship import ship
from sightline.operators.quantiles import grouped_quantiles
from sightline.operators.relational import component_labels

TILE = 256


def _tiled(pixels: DataFrame, tile: int, rim: int) -> DataFrame:
    """Each pixel with its tile (tx, ty) and own = true, and for tiles whose rim it is in once more with own = false."""
    at = lambda c: F.floor(F.col(c) / tile).cast("long")
    near = lambda c: F.array_distinct(F.array(*(F.floor((F.col(c) + d) / tile).cast("long") for d in (-rim, 0, rim))))
    return pixels.select("*", F.explode(near("x")).alias("tx")).select("*", F.explode(near("y")).alias("ty")).withColumn("own", (F.col("tx") == at("x")) & (F.col("ty") == at("y")))


def _grid(table: pa.Table, tile: int, rim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A tile's values with its rim (nan where no pixel is), and row, column and ownership of the table's rows in it."""
    x, y = np.asarray(table.column("x")), np.asarray(table.column("y"))
    j, i = x - table.column("tx")[0].as_py() * tile + rim, y - table.column("ty")[0].as_py() * tile + rim
    out = np.full((tile + 2 * rim, tile + 2 * rim), np.nan)
    out[i, j] = np.asarray(table.column("v"), np.float64)
    return out, i, j, np.asarray(table.column("own"))


def bilateral(pixels: DataFrame, sigma_xy: float, sigma_value: float, ignore: float = 0.0, radius_factor: float = 2.0, tile: int = TILE) -> DataFrame:
    """Every pixel as the mean of those within radius_factor * sigma_xy (rounded), weighted by nearness in place and value. Ignored and null pixels stay as they are."""
    ship(pixels.sparkSession)
    rim = int(radius_factor * sigma_xy + 0.5)
    steps = [(a, b) for a in range(-rim, rim + 1) for b in range(-rim, rim + 1) if a * a + b * b <= rim * rim]

    def run(table: pa.Table) -> pa.Table:
        v, i, j, own = _grid(table, tile, rim)
        v[v == ignore] = np.nan
        core = v[rim : rim + tile, rim : rim + tile]
        total, weight = np.zeros_like(core), np.zeros_like(core)
        for a, b in steps:
            other = v[rim + a : rim + a + tile, rim + b : rim + b + tile]
            w = np.exp(-(a * a + b * b) / (2 * sigma_xy**2)) * np.exp(-((core - other) ** 2) / (2 * sigma_value**2))
            w = np.where(np.isnan(w), 0.0, w)
            total += w * np.where(np.isnan(other), 0.0, other)
            weight += w
        out = np.divide(total, weight, out=np.full_like(total, np.nan), where=weight > 0)
        kept = table.filter(pa.array(own))
        new, old = out[i[own] - rim, j[own] - rim], kept.column("v")
        value = pa.array([o if np.isnan(n) else n for n, o in zip(new, old.to_pylist(), strict=True)], pa.float64())
        return pa.table({"image": kept.column("image"), "x": kept.column("x"), "y": kept.column("y"), "v": value})

    rows = pixels.select("image", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.col("v").cast("double").alias("v"))
    return _tiled(rows, tile, rim).groupBy("image", "tx", "ty").applyInArrow(run, f"image {pixels.schema['image'].dataType.simpleString()}, x long, y long, v double")


def median_scaled(pixels: DataFrame, size: tuple[int, int], new_size: tuple[int, int], ignore: float | None = None) -> DataFrame:
    """The image scaled down to new_size (width, height): each new pixel is the median of its old ones; of the two middle ones of an even number, that nearer to their mean, the greater if both are. New pixels without old ones are left out."""
    to = lambda c, n, m: F.floor(((F.col(c) + 1) * m - 1) / n).cast("long")
    rows = pixels.where(F.col("v").isNotNull() & (F.lit(True) if ignore is None else F.col("v") != ignore))
    rows = rows.select("image", to("x", size[0], new_size[0]).alias("x"), to("y", size[1], new_size[1]).alias("y"), F.col("v").cast("double").alias("v"))
    middle = grouped_quantiles(rows, ["image", "x", "y"], {"low": ("v", 0.5, "lower"), "high": ("v", 0.5, "upper")})
    mean = rows.groupBy("image", "x", "y").agg(F.avg("v").alias("mean"))
    nearer = F.when(F.abs(F.col("mean") - F.col("low")) < F.abs(F.col("mean") - F.col("high")), F.col("low")).otherwise(F.col("high"))
    return middle.join(mean, ["image", "x", "y"]).select("image", "x", "y", nearer.alias("v"))


def joined_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component in a graph of n nodes: hooks of roots and jumps to grandparents until nothing changes."""
    f = np.arange(n)
    while True:
        g = f[f]
        before = g.copy()
        low = np.minimum(g[a], g[b])
        for end in (a, b):
            np.minimum.at(f, f[end], low)
            np.minimum.at(f, end, low)
        f = np.minimum(f, g)
        f = f[f]
        if (f[f] == before).all() and (f == f[f]).all() and (f[a] == f[b]).all():
            return f


def _similar(a, b, ratio: float | None):
    """Neighbours belong together if their values' ratio is below the given one; always if it is None."""
    return None if ratio is None else ((a / b < ratio) & (b / a < ratio))


def components(pixels: DataFrame, separator: float = 0.0, ratio: float | None = None, tile: int = TILE) -> DataFrame:
    """Each pixel that isn't the separator with label (struct y, x: its component's first pixel by rows) and size.

    Neighbours left, right, above and below belong together, if ratio is given only where neither value is
    ratio times the other or more. Tiles are labelled by themselves; labels that meet over a border are
    merged as a graph of labels, so the rounds depend on tiles, not pixels. A null value is a separator.
    """
    spark = pixels.sparkSession
    ship(spark)
    kind = pixels.schema["image"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        v, i, j, _ = _grid(table, tile, 0)
        there = ~np.isnan(v)
        number = np.cumsum(there.ravel()).reshape(v.shape) - 1
        pairs = []
        for a, b in ((np.s_[:, :-1], np.s_[:, 1:]), (np.s_[:-1], np.s_[1:])):
            both = there[a] & there[b]
            alike = _similar(v[a][both], v[b][both], ratio)
            x, y = number[a][both], number[b][both]
            pairs.append((x, y) if alike is None else (x[alike], y[alike]))
        left, right = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        label = joined_labels(int(there.sum()), left, right)
        first = np.flatnonzero(there.ravel())[label[number[i, j]]]
        y0, x0 = table.column("ty")[0].as_py() * tile, table.column("tx")[0].as_py() * tile
        return pa.table({"image": table.column("image"), "x": table.column("x"), "y": table.column("y"), "v": table.column("v"), "ly": pa.array(first // tile + y0), "lx": pa.array(first % tile + x0)})

    rows = pixels.select("image", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.col("v").cast("double").alias("v")).where(F.coalesce(F.col("v") != separator, F.lit(False)))
    checkpoint_dir(spark)
    own = rows.withColumns({"tx": F.floor(F.col("x") / tile).cast("long"), "ty": F.floor(F.col("y") / tile).cast("long"), "own": F.lit(True)})
    labelled = own.groupBy("image", "tx", "ty").applyInArrow(run, f"image {kind}, x long, y long, v double, ly long, lx long").checkpoint()
    node = F.struct("image", "ly", "lx")
    ends = labelled.select("image", "x", "y", "v", node.alias("node"))
    edges = None
    for dx, dy, c in ((1, 0, "x"), (0, 1, "y")):
        before = ends.where(F.pmod(F.col(c), F.lit(tile)) == tile - 1).select("image", (F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), F.col("v").alias("w"), F.col("node").alias("a"))
        met = before.join(ends.where(F.pmod(F.col(c), F.lit(tile)) == 0).withColumnRenamed("node", "b"), ["image", "x", "y"])
        alike = _similar(F.col("v"), F.col("w"), ratio)
        met = (met if alike is None else met.where(alike)).select("a", "b").distinct()
        edges = met if edges is None else edges.unionByName(met)
    merged = component_labels(edges.checkpoint(), "a", "b").select(F.col("node.image").alias("image"), F.col("node.ly").alias("ly"), F.col("node.lx").alias("lx"), F.struct(F.col("component.ly").alias("y"), F.col("component.lx").alias("x")).alias("to"))
    local = labelled.groupBy("image", "ly", "lx").agg(F.count(F.lit(1)).alias("n")).join(merged, ["image", "ly", "lx"], "left")
    local = local.withColumn("label", F.coalesce("to", F.struct(F.col("ly").alias("y"), F.col("lx").alias("x")))).drop("to")
    sizes = local.groupBy("image", "label").agg(F.sum("n").alias("size"))
    told = local.join(sizes, ["image", "label"]).select("image", "ly", "lx", "label", "size")
    return labelled.join(told, ["image", "ly", "lx"]).select("image", "x", "y", "v", "label", "size")


def without_small(pixels: DataFrame, least: int, separator: float = 0.0, ratio: float | None = None, tile: int = TILE) -> DataFrame:
    """The pixels with those of components smaller than least set to 0."""
    small = components(pixels, separator, ratio, tile).where(F.col("size") < least).select("image", "x", "y", F.lit(True).alias("_small"))
    rows = pixels.select("image", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.col("v").cast("double").alias("v"))
    return rows.join(small, ["image", "x", "y"], "left").select("image", "x", "y", F.when(F.col("_small"), 0.0).otherwise(F.col("v")).alias("v"))


def cut_off(v: Column, most: float, replacement: float) -> Column:
    """v, or the replacement where it is above most."""
    return F.when(v <= most, v).otherwise(replacement)


def flipped(pixels: DataFrame, width: int | None = None, height: int | None = None) -> DataFrame:
    """Left and right swapped if a width is given, above and below if a height is."""
    out = pixels
    for c, n in (("x", width), ("y", height)):
        out = out if n is None else out.withColumn(c, n - 1 - F.col(c))
    return out
