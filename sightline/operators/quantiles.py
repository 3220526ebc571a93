"""Exact quantiles without arrays or maps of a group's values: values are counted, then a running count finds the places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Rows of the range in which one task finds a whole table's quantile; ranges per narrowing pass.
FEW, RANGES = 100_000, 256


def _place(q: float, n: Column, style: str) -> tuple[Column, Column]:
    """Index from 0, and the share of the next value, of a quantile among n values."""
    if style == "linear":
        at = F.lit(q) * (n - 1)
        return F.floor(at), at - F.floor(at)
    index = {"upper": F.floor(n * q), "lower": F.floor(F.lit(q) * (n - 1)), "fence": F.floor(F.lit(q) * n + 0.5)}[style]
    return F.least(index, n - 1), F.lit(0.0)


def grouped_quantiles(rows: DataFrame, keys: list[str], wanted: dict[str, tuple]) -> DataFrame:
    """Per group n (its rows) and the wanted quantiles: name -> (column, q) or (column, q, style), over the column's non-null values.

    linear (the default) interpolates at q (n - 1); lower takes element floor(q (n - 1)), upper
    floor(q n), fence floor(q n + 0.5). Equal values of a group are counted before the shuffle, so
    a task sorts distinct values, can spill, and holds no group. A null key is a group; a group
    without values has null quantiles.
    """
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    for column in dict.fromkeys(v[0] for v in wanted.values()):
        counts = rows.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_m"))
        w = W.partitionBy(*keys)
        placed = counts.withColumns({"_end": F.sum("_m").over(w.orderBy("_v")), "_all": F.sum("_m").over(w)})
        found = []
        for name, (_, q, *style) in ((k, v) for k, v in wanted.items() if v[0] == column):
            low, share = _place(q, F.col("_all"), *(style or ["linear"]))
            at = lambda k: F.max(F.when((F.col("_end") > k) & (F.col("_end") - F.col("_m") <= k), F.col("_v")))
            a, b = at(low), at(F.least(low + 1, F.col("_all") - 1))
            found.append((a if style and style[0] != "linear" else a + (b - a) * F.max(share)).alias(name))
        per = placed.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(*found)
        out = out.join(per, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left").drop(*(f"_k{i}" for i in range(len(keys))))
    return out


def counted_median(counts: DataFrame, key: str, value: str, count: str) -> DataFrame:
    """Per key the median (linear) and n of values that occur count times each; null values don't count."""
    w = W.partitionBy(key)
    placed = counts.where(F.col(value).isNotNull()).withColumns({"_end": F.sum(count).over(w.orderBy(value)), "_all": F.sum(count).over(w)})
    at = lambda k: F.max(F.when((F.col("_end") > k) & (F.col("_end") - F.col(count) <= k), F.col(value)))
    low, high = at(F.floor((F.col("_all") - 1) / 2)), at(F.floor(F.col("_all") / 2))
    return placed.groupBy(key).agg(((low + high) / 2).alias("median"), F.max("_all").alias("n"))


def table_quantile(rows: DataFrame, column: str, q: float, style: str = "linear") -> float | None:
    """The linear quantile of a whole table's column (upper: element floor(q n)), exactly: passes that each narrow the range of values by RANGES, until FEW rows are left to sort."""
    v = rows.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n, low, high = v.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    place = min(int(q * n), n - 1) if style == "upper" else q * (n - 1)

    def element(k: int) -> float:
        lo, hi, before, inside = low, high, 0, n
        while inside > FEW and lo < hi:
            bin_ = F.least(F.floor((F.col("v") - lo) / (hi - lo) * RANGES), F.lit(RANGES - 1))
            counts = sorted(tuple(r) for r in v.where(F.col("v").between(lo, hi)).groupBy(bin_.alias("b")).agg(F.count("v"), F.min("v"), F.max("v")).collect())
            for _, m, a, b in counts:  # at most RANGES rows
                if before + m > k:
                    lo, hi, inside = a, b, m
                    break
                before += m
        if lo == hi:
            return lo
        w = W.orderBy("v")
        each = v.where(F.col("v").between(lo, hi)).groupBy("v").agg(F.count(F.lit(1)).alias("m")).withColumn("end", F.sum("m").over(w))
        return each.where(F.col("end") > k - before).agg(F.min("v")).first()[0]

    a = element(int(place))
    b = element(int(place) + 1) if place > int(place) else a
    return a + (b - a) * (place - int(place))
