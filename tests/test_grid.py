import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.sources.grid import (
    all_cells,
    fill_grid,
    frame_ranges,
    grid_from_table,
    grid_tasks,
    pixel_grid,
    split_frames,
    tile_grid,
)


@pytest.mark.parametrize("n", [1, 2, 5, 16])
def test_axes_equal_linspace(spark, view, n):
    cells = pixel_grid(view((-0.743643887037151, 0.131825904205330, 1e-3)), n, n).collect()
    x = np.linspace(-0.743643887037151 - 5e-4, -0.743643887037151 + 5e-4, n)
    y = np.linspace(0.131825904205330 - 5e-4, 0.131825904205330 + 5e-4, n)
    assert len(cells) == n * n
    assert all(c["re"] == x[c["x"]] and c["im"] == y[c["y"]] for c in cells)


@pytest.mark.parametrize("size,parts", [(8, 3), (10, 6), (7, 7), (3, 9), (1, 4)])
def test_tiles_cut_at_linspace_boundaries(spark, view, size, parts):
    tiles = tile_grid(view((0, 0, 1)), size, size, parts).collect()
    n = min(parts, size)
    edges = np.linspace(0, size, n + 1, dtype=int)
    assert len(tiles) == n * n
    for t in tiles:
        assert (t["y0"], t["y1"]) == (edges[t["tile_y"]], edges[t["tile_y"] + 1])
        assert (t["x0"], t["x1"]) == (edges[t["tile_x"]], edges[t["tile_x"] + 1])


def test_any_tile_split_gives_the_same_cells(spark, view):
    views = view((-0.75, 0, 3.5), (0.3, 0.1, 0.01))
    whole = as_set(pixel_grid(views, 9, 7, 1), "frame", "y", "x", "re", "im")
    assert len(whole) == 2 * 63
    for n_tiles in (2, 3, 20):
        assert as_set(pixel_grid(views, 9, 7, n_tiles), "frame", "y", "x", "re", "im") == whole


def test_frame_ranges_are_clamped(spark):
    ranges = sorted(tuple(r) for r in frame_ranges(spark, 10, 8).collect())
    assert ranges == [(0, 0, 2), (1, 2, 4), (2, 4, 6), (3, 6, 8), (4, 8, 10), (5, 10, 10), (6, 10, 10), (7, 10, 10)]
    split = split_frames(spark.range(10).select(F.col("id").cast("int").alias("frame")), 10, 8)
    placed = split.withColumn("p", F.spark_partition_id()).collect()
    assert all(r["p"] == r["task_index"] == r["frame"] // 2 for r in placed)
    assert split.rdd.getNumPartitions() == 8


def test_grid_from_a_table_and_its_filling(spark):
    table = spark.createDataFrame([(0, 0, 1), (0, 0, 1), (1, 1, 0)], "f INT, a INT, b INT")
    cells = grid_from_table(table, "f", "a", "b", F.count("*"))
    assert as_set(cells, "frame", "y", "x", "iterations") == {(0, 0, 1, 2), (1, 1, 0, 1)}
    full = fill_grid(cells, 2, 2, 2)
    assert full.count() == 8
    assert full.filter("iterations > 0").count() == 2
    assert as_set(all_cells(spark, 2, 2, 3), "frame", "y", "x") == {
        (f, y, x) for f in range(2) for y in range(2) for x in range(3)}


def test_task_count_scales_without_exploding(spark):
    assert grid_tasks(spark, 100) == 1
    cores = spark.sparkContext.defaultParallelism
    assert grid_tasks(spark, 64 * 1024 * 1024) <= 9 * cores
    assert grid_tasks(spark, 10 ** 13) < 200_000
