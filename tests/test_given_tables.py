"""Queries whose rows come from the given tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from sightline.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, table", [("accuracy_trials", "orders"), ("camera_model_files", "customer"), ("missing_table", "customer"), ("model_difference", "lineitem"), ("residual_files", "orders"), ("target_geometry", "lineitem")])
def test_half_a_table_gives_another_result(spark, monkeypatch, name, table):
    def half(spark, sf, asked):
        rows = given(spark, sf, asked)
        return rows.where(F.col(rows.columns[0]) % 2 == 0) if asked == table else rows

    given = catalog.t
    whole = sorted(map(tuple, catalog.QUERIES[name](spark, SF).collect()), key=repr)
    monkeypatch.setitem(catalog.QUERIES[name].__globals__, "t", half)
    assert whole != sorted(map(tuple, catalog.QUERIES[name](spark, SF).collect()), key=repr)
