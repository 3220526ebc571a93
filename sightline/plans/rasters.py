"""Queries on rasters: each year's orders as an image of counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import raster as G
from sightline.plans.catalog import query, t

_PIXELS = "p AS (SELECT CAST(year(o_orderdate) AS INT) AS image, o_custkey % 60 AS x, o_orderkey // 4 % 60 AS y, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY ALL)"


def pixels(spark, sf):
    o = t(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("image"), (F.col("o_custkey") % 60).alias("x"), (F.floor(F.col("o_orderkey") / 4) % 60).alias("y")).agg(F.count(F.lit(1)).cast("double").alias("v"))


@query(f"""WITH RECURSIVE {_PIXELS}, e AS (SELECT a.image, a.x * 100 + a.y AS a, b.x * 100 + b.y AS b FROM p a JOIN p b ON a.image = b.image AND abs(a.x - b.x) + abs(a.y - b.y) = 1 AND greatest(a.v / b.v, b.v / a.v) < 2),
r(image, n, m) AS (SELECT image, x * 100 + y, x * 100 + y FROM p UNION SELECT r.image, r.n, e.b FROM r JOIN e ON e.image = r.image AND e.a = r.m),
c AS (SELECT image, n, min(m % 100 * 100 + m // 100) AS label, count(*) AS size FROM r GROUP BY image, n)
SELECT image, x, y, CAST(label // 100 AS BIGINT) AS label_y, CAST(label % 100 AS BIGINT) AS label_x, size FROM p JOIN c USING (image) WHERE c.n = x * 100 + y""")
def raster_components(spark, sf):
    """Components of neighbouring pixels whose counts differ by less than a factor of two, in tiles of 16."""
    c = G.components(pixels(spark, sf), ratio=2.0, tile=16)
    return c.select("image", "x", "y", F.col("label.y").alias("label_y"), F.col("label.x").alias("label_x"), "size")


@query(f"""WITH RECURSIVE {_PIXELS}, e AS (SELECT a.image, a.x * 100 + a.y AS a, b.x * 100 + b.y AS b FROM p a JOIN p b ON a.image = b.image AND abs(a.x - b.x) + abs(a.y - b.y) = 1),
r(image, n, m) AS (SELECT image, x * 100 + y, x * 100 + y FROM p UNION SELECT r.image, r.n, e.b FROM r JOIN e ON e.image = r.image AND e.a = r.m),
c AS (SELECT image, n, count(*) AS size FROM r GROUP BY image, n)
SELECT image, x, y, CASE WHEN size < 8 THEN 0.0 ELSE v END AS v FROM p JOIN c USING (image) WHERE c.n = x * 100 + y""")
def raster_without_small(spark, sf):
    """Pixels of components of fewer than eight are set to zero."""
    return G.without_small(pixels(spark, sf), 8, tile=16)


@query(f"""WITH {_PIXELS}, w AS (SELECT a.image, a.x, a.y, exp(-((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / 4.5) * exp(-((a.v - b.v) ** 2) / 8) AS w, b.v FROM p a JOIN p b ON a.image = b.image AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 9 WHERE a.v <> 1 AND b.v <> 1)
SELECT p.image, p.x, p.y, round(coalesce(m, v), 6) AS v FROM p LEFT JOIN (SELECT image, x, y, sum(w * v) / sum(w) AS m FROM w GROUP BY ALL) USING (image, x, y)""")
def raster_bilateral(spark, sf):
    """Smoothed over three pixels and by value, counts of one ignored."""
    return G.bilateral(pixels(spark, sf), 1.5, 2.0, ignore=1.0, tile=16).select("image", "x", "y", F.round("v", 6).alias("v"))


@query(f"""WITH {_PIXELS}, b AS (SELECT image, CAST(((x + 1) * 25 - 1) // 60 AS BIGINT) AS x, CAST(((y + 1) * 13 - 1) // 60 AS BIGINT) AS y, v FROM p), g AS (SELECT image, x, y, avg(v) AS mean, list_sort(list(v)) AS vs FROM b GROUP BY ALL),
m AS (SELECT *, vs[(len(vs) + 1) // 2] AS low, vs[len(vs) // 2 + 1] AS high FROM g)
SELECT image, x, y, CASE WHEN abs(mean - low) < abs(mean - high) THEN low ELSE high END AS v FROM m""")
def raster_median_scaled(spark, sf):
    """Scaled down from 60 by 60 to 25 by 13 by medians."""
    return G.median_scaled(pixels(spark, sf), (60, 60), (25, 13))
