"""Palettes as small tables ``(bin, r, g, b)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def gray_palette(spark: SparkSession, n_bins: int = 256) -> DataFrame:
    """Black to white."""
    level = (F.col("id") * 255 / max(n_bins - 1, 1)).cast("int")
    return spark.range(n_bins).select(
        F.col("id").cast("int").alias("bin"), level.alias("r"), level.alias("g"), level.alias("b"))


def ember_palette(spark: SparkSession, n_bins: int = 256) -> DataFrame:
    """Dark blue to bright yellow; every channel is a polynomial of the bin."""
    t = F.col("id") / max(n_bins - 1, 1)
    unit = spark.range(n_bins).select(
        F.col("id").cast("int").alias("bin"),
        t.alias("r"), (t * t).alias("g"), ((F.lit(1.0) - t) * 0.5).alias("b"))
    return palette_from_floats(unit)


def palette_from_floats(palette: DataFrame) -> DataFrame:
    """A palette given in [0, 1] as 8-bit values: times 255, truncated."""
    return palette.select("bin", *[(F.col(c) * 255).cast("int").alias(c) for c in "rgb"])
