"""Distributed ranks against Spark's own windows and percentiles."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.functions.ranking import exact_percentiles, global_ntile, global_row_number, grouped_row_number


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one key and one value."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    value = F.when(F.col("id") % 3 == 1, 7.25).otherwise(F.pmod(F.hash("id"), F.lit(500)) / 4)
    return spark.range(3000).select("id", key.alias("key"), value.alias("value")).repartition(5, "id")


def test_global_row_number(values):
    ranked = global_row_number(values, [F.desc("value"), F.asc("id")], "found", "total")
    expected = F.row_number().over(Window.orderBy(F.desc("value"), "id"))
    assert ranked.withColumn("expected", expected).where("found <> expected OR total <> 3000").count() == 0
    assert ranked.count() == 3000


@pytest.mark.parametrize("rows", [0, 1, 3, 4, 5, 6, 1501])
def test_global_ntile(values, rows):
    part = values.where(F.col("id") < rows)
    tiles = global_ntile(part, 5, [F.asc("value"), F.asc("id")], "found")
    expected = F.ntile(5).over(Window.orderBy("value", "id"))
    assert tiles.withColumn("expected", expected).where("found <> expected").count() == 0
    sizes = [r["count"] for r in tiles.groupBy("found").count().collect()]
    assert tiles.count() == rows and (not sizes or max(sizes) - min(sizes) <= 1)


@pytest.mark.parametrize("spread_by", [None, "value"])
def test_grouped_row_number(values, spread_by):
    with_null = values.withColumn("key", F.when(F.col("id") % 3 != 2, F.col("key")))
    with_null = with_null.withColumn("value", F.when(F.col("id") % 11 != 0, F.col("value")))
    numbered = grouped_row_number(with_null, ["key"], ["value", "id"], "found", spread_by)
    expected = F.row_number().over(Window.partitionBy("key").orderBy("value", "id"))
    assert numbered.columns == ["id", "key", "value", "found"]
    assert numbered.count() == 3000
    assert numbered.withColumn("expected", expected).where("found <> expected").count() == 0


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.731, 0.75, 1.0])
def test_exact_percentiles(values, fraction):
    found = exact_percentiles(values, {"a": ("value", fraction), "b": ("id", 0.5)}).first()
    expected = values.agg(F.percentile("value", fraction)).first()[0]
    assert found["a"] == pytest.approx(expected, abs=1e-12)
    assert found["b"] == 1499.5


def test_percentile_of_nothing_is_null(spark):
    empty = spark.createDataFrame([(None,)], "value double")
    assert exact_percentiles(empty, {"a": ("value", 0.5)}).first()["a"] is None


def test_percentile_of_equal_values_is_that_value(spark):
    same = spark.createDataFrame([(0.1,)] * 7, "value double")
    assert exact_percentiles(same, {"a": ("value", 0.75)}).first()["a"] == 0.1
