"""Grouped statistics on rows that arrive in another order each time."""

import numpy as np

from sightline.operators import summary as Y


def test_trimmed_line_with_sums_in_any_order(spark):
    """Of 101 distances the 0.8-quantile is the 81st itself; its row stays however the sums of the two uses are rounded."""

    def mixed(batches):
        for pdf in batches:
            yield pdf.sample(frac=1, random_state=np.random.default_rng())

    rng = np.random.default_rng(3)
    x, y = rng.integers(1, 51, 30_300), np.round(rng.uniform(900, 105_000, 30_300), 2)
    rows = spark.createDataFrame([(k % 300, float(a), float(b)) for k, (a, b) in enumerate(zip(x, y, strict=True))], "k int, x double, y double").mapInPandas(mixed, "k int, x double, y double")
    reuse = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert {r.kept for r in Y.trimmed_line(rows, "k", "x", "y", 0.8).collect()} == {81}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
