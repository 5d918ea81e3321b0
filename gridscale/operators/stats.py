"""Aggregates over cells and checks on runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SECTION = 65_536


def frame_stats(cells: DataFrame, max_iter: int, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """Per frame: range, cell count, array shape and how many cells are in the set."""
    return cells.groupBy(*by).agg(
        F.min("iterations").alias("min_iter"),
        F.max("iterations").alias("max_seen"),
        F.count("*").alias("n_cells"),
        (F.max("y") + 1).alias("height"),
        (F.max("x") + 1).alias("width_px"),
        F.count_if(F.col("iterations") == max_iter).alias("in_set"),
    )


def largest_count() -> Column:
    """The largest cell, at least 1, so that it can always divide."""
    return F.greatest(F.coalesce(F.max("iterations"), F.lit(1)), F.lit(1))


def global_max(cells: DataFrame) -> DataFrame:
    """One row: the largest cell over all frames, at least 1."""
    return cells.agg(largest_count().alias("global_max"))


def mixed_frames(cells: DataFrame, max_iter: int) -> DataFrame:
    """Per frame: does it hold in-set cells, escaped cells, and both?"""
    inside = F.bool_or(F.col("iterations") == max_iter)
    escaped = F.bool_or(F.col("iterations") < max_iter)
    return cells.groupBy("frame").agg(
        inside.alias("has_in_set"), escaped.alias("has_escaped"), (inside & escaped).alias("mixed"))


def check_views(views: DataFrame) -> DataFrame:
    """Per run: are all views complete (neither NULL nor NaN), and is the centre the same throughout?"""
    absent = [F.col(c).isNull() | F.isnan(c) for c in ("center_re", "center_im", "width")]
    return _with_run(views).groupBy("run_id").agg(
        F.count("*").alias("n_frames"),
        F.count_if(absent[0] | absent[1] | absent[2]).alias("missing"),
        F.coalesce((F.min("center_re") == F.max("center_re")) & (F.min("center_im") == F.max("center_im"))
                   & (F.count_if(absent[0] | absent[1]) == 0), F.lit(False)).alias("center_constant"),
    )


def check_widths_decrease(views: DataFrame) -> DataFrame:
    """Per run: how many frames are not strictly narrower than the frame before them, in order of frame
    numbers whatever their gaps. A run of one frame has no steps and passes; a width that is NULL or NaN
    fails its steps."""
    steps = _with_next(views)
    wrong = F.count_if(F.col("next").isNotNull() & ~F.coalesce(F.col("next.width") < F.col("width"), F.lit(False)))
    return steps.groupBy("run_id").agg(
        F.count("next").alias("n_steps"), wrong.alias("not_decreasing"), (wrong == 0).alias("decreasing"))


def check_widths_log_uniform(views: DataFrame, rtol: float = 1e-10, atol: float = 1e-8) -> DataFrame:
    """Per run: is every step of ``ln(width)`` within tolerance of the mean step?

    Only the extreme steps can leave the tolerance, so one aggregate decides it. A run without steps passes;
    one with a step that has no logarithm does not."""
    known = F.col("next").isNotNull()
    step = F.ln(F.col("next.width")) - F.ln("width")
    steps = _with_next(views).select("run_id", known.alias("known"), F.when(known, step).alias("step"))
    mean = F.avg("step")
    furthest = F.greatest(F.max("step") - mean, mean - F.min("step"))
    odd = F.count_if(F.col("known") & (F.col("step").isNull() | F.isnan("step")))
    return steps.groupBy("run_id").agg(
        F.count_if("known").alias("n_steps"), mean.alias("mean_step"),
        ((odd == 0) & (F.coalesce(furthest, F.lit(0.0)) <= F.lit(atol) + F.lit(rtol) * F.abs(F.coalesce(mean, F.lit(0.0))))).alias("log_uniform"))


def _with_run(views):
    return views if "run_id" in views.columns else views.withColumn("run_id", F.lit("run"))


def _with_next(views):
    """Every frame with the width of the next one in order (``next``: NULL after the last).

    Neighbours are found within sections of frame numbers, and the sections, one row each, are chained by a second
    window, so that no task has to hold a whole run."""
    views = _with_run(views).select("run_id", "frame", "width", F.expr(f"frame div {_SECTION}").alias("section"))
    width = F.struct("width")
    inner = views.withColumn("next", F.lead(width).over(Window.partitionBy("run_id", "section").orderBy("frame")))
    heads = views.groupBy("run_id", "section").agg(F.min_by(width, "frame").alias("head"))
    heads = heads.select("run_id", "section", F.lead("head").over(Window.partitionBy("run_id").orderBy("section")).alias("following"))
    return inner.join(heads, ["run_id", "section"]).select("run_id", "frame", "width", F.coalesce("next", "following").alias("next"))
