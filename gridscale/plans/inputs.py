"""Views, points and cubes read off ordinary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscale.sources.grid import grid_from_table, points


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customer_views(spark, folder) -> DataFrame:
    """One view per customer; widths are exact halvings of 3.5."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("frame"),
        (F.lit(-2.0) + F.lit(0.1) * F.col("c_nationkey")).alias("center_re"),
        (F.lit(-0.375) + F.lit(0.125) * (F.col("c_custkey") % 7)).alias("center_im"),
        F.expr("3.5D / (1 << cast(c_custkey % 5 AS INT))").alias("width"))


def supplier_views(spark, folder) -> DataFrame:
    """One view per supplier; frames are numbered from 0 without gaps."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("frame"),
        (F.lit(-2.0) + F.lit(0.1) * F.col("s_nationkey")).alias("center_re"),
        F.lit(0.0).alias("center_im"),
        F.expr("3.5D / (1 << cast(s_suppkey % 5 AS INT))").alias("width"))


def deep_views(spark, folder) -> DataFrame:
    """One view per supplier close to i, -i or -2, where detail never ends; centres differ in the 21st digit and need strings."""
    key = F.col("s_suppkey")
    digits = F.concat(F.lit("000000000000000000"), F.lpad(key.cast("string"), 6, "0"))
    near = key % 3
    return table(spark, folder, "supplier").select(
        key.cast("int").alias("frame"),
        F.when(near == 2, F.concat(F.lit("-2."), digits)).otherwise(F.concat(F.lit("0."), digits)).alias("center_re"),
        F.when(near == 0, F.concat(F.lit("1."), digits)).when(near == 1, F.concat(F.lit("-1."), digits)).otherwise(F.lit("0")).alias("center_im"),
        F.expr("1e-20D / (1 << cast(s_suppkey % 5 AS INT))").alias("width"))


def requested_suppliers(spark, folder) -> DataFrame:
    """The frames somebody asked for: suppliers with a high account balance."""
    return (table(spark, folder, "supplier").filter(F.col("s_acctbal") > 5000)
            .select(F.col("s_suppkey").cast("int").alias("frame")))


def run_requests(spark, folder) -> DataFrame:
    """One zoom request per customer, of 1 to 20 frames."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("run_id"),
        (F.col("c_custkey") % 20 + 1).cast("int").alias("n_frames"))


def run_requests_with_overrides(spark, folder) -> DataFrame:
    """The same, where some market segments override parts of the default zoom."""
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("run_id"),
        (F.col("c_custkey") % 20 + 1).cast("int").alias("n_frames"),
        F.when(segment == "BUILDING", 10.0).alias("initial_width"),
        F.when(segment.isin("BUILDING", "MACHINERY"), 1e-5).alias("final_width"),
        F.when(segment == "AUTOMOBILE", -1.25066).alias("center_re"),
        F.when(segment.isin("AUTOMOBILE", "FURNITURE"), 0.0).alias("center_im"))


def lineitem_points(spark, folder) -> DataFrame:
    re = F.lit(-2.0) + F.lit(2.5) * (F.col("l_partkey") % 1009) / F.lit(1009.0)
    im = (F.lit(-1.25) + F.lit(2.5) * ((F.col("l_suppkey") * 7 + F.col("l_orderkey") % 997) % 997)
          / F.lit(997.0))
    return points(table(spark, folder, "lineitem"), re, im)


def orders_points(spark, folder) -> DataFrame:
    re = F.lit(-2.0) + F.lit(2.5) * (F.col("o_orderkey") % 1009) / F.lit(1009.0)
    im = F.lit(-1.25) + F.lit(2.5) * (F.col("o_custkey") % 997) / F.lit(997.0)
    return points(table(spark, folder, "orders"), re, im)


def embedding_points(spark, folder) -> DataFrame:
    """Each pair of neighbouring coordinates of every vector as one point."""
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.size("embedding") - 2, F.lit(2)), lambda i: F.struct(
        (i / 2).cast("int").alias("pair"),
        F.get("embedding", i).alias("a"), F.get("embedding", i + 1).alias("b"))))
    pairs = table(spark, folder, "embeddings").select("vec_id", pair.alias("p")).select("vec_id", "p.pair", "p.a", "p.b")
    return points(pairs, F.col("a").cast("double") * 2, F.col("b").cast("double") * 2)


EVENTS_HEIGHT = 24


def day(ts="ts"):
    return F.datediff(F.col(ts), F.lit("2024-01-01").cast("date"))


def event_cells(events: DataFrame) -> DataFrame:
    """Events per day (frame), hour (row) and user (column)."""
    return grid_from_table(events, day(), F.hour("ts"), "user_id", F.count("*"))


def event_cube(spark, folder) -> DataFrame:
    return event_cells(table(spark, folder, "events"))


def event_cube_without_errors(spark, folder) -> DataFrame:
    return event_cells(table(spark, folder, "events").filter(F.col("event_type") != "error"))


def event_cube_weekends_restated(spark, folder) -> DataFrame:
    """Only the weekend frames, recounted without errors."""
    events = table(spark, folder, "events")
    return event_cells(events.filter((F.col("event_type") != "error") & (F.weekday("ts") >= 5)))


def event_width(spark, folder) -> int:
    """Columns of the event cube: one per user number."""
    return table(spark, folder, "events").agg(F.max("user_id")).first()[0] + 1


def event_frames(spark, folder) -> int:
    """Frames of the event cube: one per day up to the last event."""
    return table(spark, folder, "events").agg(F.max(day())).first()[0] + 1


def event_views(spark, folder) -> DataFrame:
    """One view per day that has events."""
    days = table(spark, folder, "events").select(day().alias("frame")).distinct()
    return days.select(
        "frame", F.lit(-0.75).alias("center_re"), F.lit(0.0).alias("center_im"),
        F.expr("3.5D / (1 << (frame % 5))").alias("width"))


ORDERS_HEIGHT, ORDERS_WIDTH = 31, 25


def order_cube(spark, folder) -> DataFrame:
    """Orders per month (frame), day of month (row) and customer nation (column): odd sizes."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    when = F.col("o_orderdate")
    return grid_from_table(
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"]),
        (F.year(when) - 1990) * 12 + F.month(when) - 1, F.dayofmonth(when) - 1, "c_nationkey", F.count("*"))
