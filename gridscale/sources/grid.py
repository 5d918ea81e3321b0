"""Grids: tiles and pixels of a view, frame ranges, and grids read off ordinary tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscale.schema import CELLS_PER_TASK, CELLS_PER_TILE, STEPS_PER_TASK

_LARGEST_TASK = 256 * CELLS_PER_TASK
_SMALLEST_TILE = 4096
#: Positions of a line that are looked at together when gaps are filled.
SEGMENT = 65_536


def grid_tasks(spark: SparkSession, n_cells: int, steps: int = 1) -> int:
    """How many tasks to spread a grid over: about eight per core so that costly frames even
    out, each between a quarter and 67 million cells, so small runs are not shredded and
    huge ones stay schedulable. Cells that may take many ``steps`` are spread over more tasks, up to
    eight per core, so that one deep frame keeps all cores busy."""
    eight_per_core = 8 * max(spark.sparkContext.defaultParallelism, 1)
    per_task = min(max(n_cells // eight_per_core, CELLS_PER_TASK), _LARGEST_TASK)
    by_work = min(n_cells * steps // STEPS_PER_TASK, eight_per_core)
    return max(1, -(-n_cells // per_task), by_work)


def default_tiles(height: int, width_px: int, n_parts: int = 1) -> int:
    """Tiles per axis that keep one tile near ``CELLS_PER_TILE`` cells, and a frame in ``n_parts`` or more."""
    cells = height * width_px
    return max(1, math.ceil(math.sqrt(max(cells / CELLS_PER_TILE, min(n_parts, cells / _SMALLEST_TILE)))))


def axis_point(center, width, index, n: int) -> Column:
    """Coordinate of sample ``index`` of ``n`` across ``width`` around ``center``; the last
    sample is the right edge itself, a single sample sits on the left edge."""
    lo = F.col(center) - F.col(width) / 2.0 if isinstance(center, str) else center - width / 2.0
    hi = F.col(center) + F.col(width) / 2.0 if isinstance(center, str) else center + width / 2.0
    index = F.col(index) if isinstance(index, str) else index
    if n == 1:
        return lo
    return F.when(index == n - 1, hi).otherwise(lo + index * ((hi - lo) / float(n - 1)))


def tile_grid(views: DataFrame, height: int, width_px: int, n_tiles: int = 4) -> DataFrame:
    """Cut every view into ``n_tiles`` x ``n_tiles`` index blocks ``[y0,y1) x [x0,x1)``.

    Blocks index the global axes, so a cell has the same coordinates under any split.
    """
    if height < 1 or width_px < 1:
        raise ValueError(f"a grid needs at least one cell, got {height} x {width_px}")
    rows = max(1, min(n_tiles, height))
    cols = max(1, min(n_tiles, width_px))

    def edge(index, size, parts):
        return F.when(index == parts, size).otherwise((index * (size / parts)).cast("int"))

    ty, tx = F.col("tile_y"), F.col("tile_x")
    return (
        views
        .withColumn("tile_y", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
        .withColumn("tile_x", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
        .withColumns({
            "y0": edge(ty, height, rows), "y1": edge(ty + 1, height, rows),
            "x0": edge(tx, width_px, cols), "x1": edge(tx + 1, width_px, cols),
        })
    )


def pixel_grid(views: DataFrame, height: int, width_px: int, n_tiles: int | None = None) -> DataFrame:
    """Every cell of every view with its coordinates: the view's columns + ``y, x, re, im``.

    The tiles, not the views, are the unit that is spread over tasks. The partition count follows from the
    number of cells and is explicit because adaptive execution would fold the tiny tile rows into one task before
    they unfold into cells.
    """
    tiles = tile_grid(views, height, width_px, default_tiles(height, width_px) if n_tiles is None else n_tiles)
    spread = grid_tasks(views.sparkSession, views.count() * height * width_px)
    return (
        tiles.repartition(spread, "frame", "tile_y", "tile_x")
        .withColumn("y", F.explode(F.sequence(F.col("y0"), F.col("y1") - 1)))
        .withColumn("x", F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)))
        .withColumns({
            "re": axis_point("center_re", "width", "x", width_px),
            "im": axis_point("center_im", "width", "y", height),
        })
        .drop("tile_y", "tile_x", "y0", "y1", "x0", "x1")
    )


def frame_range_key(frame, n_frames: int, n_tasks: int) -> Column:
    """Which of ``n_tasks`` contiguous ranges of ``ceil(n_frames / n_tasks)`` a frame is in."""
    if n_frames < 1 or n_tasks < 1:
        raise ValueError(f"need at least one frame and one task, got {n_frames} and {n_tasks}")
    per_task = -(-n_frames // n_tasks)
    frame = F.col(frame) if isinstance(frame, str) else frame
    return F.floor(frame / per_task).cast("int")


def frame_ranges(spark: SparkSession, n_frames: int, n_tasks: int) -> DataFrame:
    """``(task_index, start, stop)`` per task; trailing ranges are clamped, hence may be empty."""
    per_task = -(-n_frames // n_tasks)
    task = F.col("id").cast("int")
    return spark.range(n_tasks).select(
        task.alias("task_index"),
        F.least(task * per_task, F.lit(n_frames)).alias("start"),
        F.least((task + 1) * per_task, F.lit(n_frames)).alias("stop"),
    )


def split_frames(df: DataFrame, n_frames: int, n_tasks: int) -> DataFrame:
    """Add ``task_index`` and place each frame range in the partition of that number.

    Meant for views and other one-row-per-frame tables; cells of a frame would all land in
    one partition."""
    keyed = df.withColumn("task_index", frame_range_key("frame", n_frames, n_tasks))
    return keyed.repartitionById(n_tasks, F.col("task_index"))


def points(df: DataFrame, re, im) -> DataFrame:
    """Use any table as a set of points: its columns plus ``re`` and ``im`` as doubles."""
    def col(c):
        return (F.col(c) if isinstance(c, str) else c).cast("double")

    return df.withColumns({"re": col(re), "im": col(im)})


def grid_from_table(df: DataFrame, frame, y, x, value) -> DataFrame:
    """Aggregate any table into cells: three integer keys and one aggregate expression.

    Partial aggregation before the shuffle leaves one row per cell and input partition,
    so a key that holds most of the table costs no more than any other.
    """
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    return (
        df.groupBy(col(frame).cast("int").alias("frame"),
                   col(y).cast("int").alias("y"),
                   col(x).cast("int").alias("x"))
        .agg(col(value).alias("iterations"))
    )


def all_cells(spark: SparkSession, n_frames: int, height: int, width_px: int) -> DataFrame:
    """Index space ``frame x y x x`` as one splittable range: no join, no hot row."""
    plane = height * width_px
    cell = F.col("id")
    total = n_frames * plane
    return spark.range(0, total, 1, grid_tasks(spark, total)).select(
        F.expr(f"int(id div {plane})").alias("frame"),
        F.expr(f"int((id % {plane}) div {width_px})").alias("y"),
        (cell % width_px).cast("int").alias("x"),
    )


def missing_cells(lines: DataFrame, cells: DataFrame, width_px: int, n_tasks: int) -> DataFrame:
    """The cells absent from the given ``(frame, y)`` lines: the lines' columns + ``x``.

    Lines are cut into segments of ``SEGMENT`` positions. A segment and the positions it has meet in one
    partition and the gaps unfold there, so only known cells and segments are shuffled, never the full
    grid, and no array grows with the width. The partition count is explicit because the
    rows multiply afterwards.
    """
    key = ["frame", "y", "segment"]
    known = (cells.select("frame", "y", "x", F.expr(f"int(x div {SEGMENT})").alias("segment")).repartition(n_tasks, *key)
             .groupBy(*key).agg(F.collect_set("x").alias("known")))
    first = F.col("segment") * SEGMENT
    gaps = F.array_except(F.sequence(first, F.least(first + (SEGMENT - 1), F.lit(width_px - 1))),
                          F.coalesce("known", F.array().cast("array<int>")))
    segments = lines.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit((width_px - 1) // SEGMENT))))
    return (segments.repartition(n_tasks, *key).join(known, key, "left")
            .withColumn("x", F.explode(gaps)).drop("known", "segment"))


def fill_grid(cells: DataFrame, n_frames: int, height: int, width_px: int, fill: int = 0) -> DataFrame:
    """Cells as a full ``n_frames x height x width_px`` grid; absent ones hold ``fill``."""
    spark = cells.sparkSession
    n_tasks = grid_tasks(spark, n_frames * height * width_px)
    lines = all_cells(spark, n_frames, height, 1).select("frame", "y")
    value = cells.schema["iterations"].dataType
    columns = ["frame", "y", "x", "iterations"]
    absent = missing_cells(lines, cells, width_px, n_tasks).withColumn("iterations", F.lit(fill).cast(value))
    return cells.select(*columns).unionByName(absent.select(*columns))
