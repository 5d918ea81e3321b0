import numpy as np
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.operators.balance import balanced
from gridscale.operators.bands import band_cells, cells_of_bands, compute_bands
from gridscale.operators.compute import compute_frames
from gridscale.sources.schedule import zoom_schedule

CELL = ("frame", "y", "x", "iterations")


def test_tasks_of_a_zoom_into_the_set_cost_about_the_same(spark):
    """Steps of every task, counted over its cells: the longest is within 1.3 of the mean."""
    size, steps = 512, 400
    views = zoom_schedule(spark, 12, final_width=0.05, center_re=-1.26, center_im=0.05)
    bands = compute_bands(views, size, size, steps, "exact", 12, by_cost=True)
    cells = cells_of_bands(bands.withColumn("task", F.spark_partition_id()), size)
    work = np.array([r["w"] for r in cells.groupBy("task").agg(F.sum(F.col("iterations") + 4).alias("w")).collect()], float)
    assert len(work) >= 8 and work.max() < 1.3 * work.mean(), work / work.mean()
    ranges = cells_of_bands(compute_bands(views, size, size, steps, "exact", 12).withColumn("task", F.spark_partition_id()), size)
    plain = np.array([r["w"] for r in ranges.groupBy("task").agg(F.sum(F.col("iterations") + 4).alias("w")).collect()], float)
    assert plain.max() / plain.mean() > work.max() / work.mean()


def test_results_do_not_depend_on_the_dealing(spark, view):
    views = view((-0.75, 0, 3.5), (-0.1, 0.8, 0.5))
    for height, width in ((30, 41), (1, 70_000)):
        assert band_cells(width) <= 32_768
        got = cells_of_bands(compute_bands(views, height, width, 60, "early_exit", 2, by_cost=True), width)
        assert as_set(got, *CELL) == as_set(compute_frames(views, height, width, 60), *CELL)


def test_heavy_bands_are_placed_by_name(spark):
    rows = [(0, k, 100.0 if k < 8 else 0.01) for k in range(500)]
    dealt = balanced(spark.createDataFrame(rows, "frame INT, band INT, cost DOUBLE"), 8).withColumn("p", F.spark_partition_id())
    by_task = {r["p"]: r["heavy"] for r in dealt.groupBy("p").agg(F.count_if(F.col("cost") > 1).alias("heavy")).collect()}
    assert by_task == {k: 1 for k in range(8)} and dealt.count() == 500
    assert balanced(spark.createDataFrame([], "frame INT, band INT, cost DOUBLE"), 8).count() == 0
