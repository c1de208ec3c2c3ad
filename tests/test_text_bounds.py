"""Bounds of text columns."""

from pyspark.sql import functions as F

from bodega.operators import layout


def test_bounds_of_texts_read_no_other_column(spark):
    df = spark.range(90).select((F.col("id") % 3).cast("string").alias("s"), "id", F.raise_error(F.lit("read")).alias("other"))
    bounds = layout.range_bounds(df, ["s", "id"], bits=2)
    assert bounds["s"] == ["0", "1", "2"] and len(bounds["id"]) == 3
