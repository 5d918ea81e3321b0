"""Zoom schedules: one view per frame, widths evenly spaced on a log scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscale.schema import (
    DEFAULT_CENTER_IM,
    DEFAULT_CENTER_RE,
    DEFAULT_FINAL_WIDTH,
    DEFAULT_INITIAL_WIDTH,
)


_SECTION = 10_000


def _zoom_width(frame: Column, n_frames: Column, initial: Column, final: Column) -> Column:
    first, last = F.log10(initial), F.log10(final)
    return (
        F.when(n_frames == 1, initial)
        .when(frame == n_frames - 1, F.pow(F.lit(10.0), last))
        .otherwise(F.pow(F.lit(10.0), first + frame * ((last - first) / F.greatest(n_frames - 1, F.lit(1)))))
    )


def zoom_schedule(
    spark: SparkSession,
    n_frames: int,
    initial_width: float | None = None,
    final_width: float | None = None,
    center_re: float | None = None,
    center_im: float | None = None,
) -> DataFrame:
    """``(frame, center_re, center_im, width)``; any part left unset takes its default."""
    if n_frames < 1:
        raise ValueError(f"a zoom has at least one frame, not {n_frames}")
    initial = DEFAULT_INITIAL_WIDTH if initial_width is None else float(initial_width)
    final = DEFAULT_FINAL_WIDTH if final_width is None else float(final_width)
    re = DEFAULT_CENTER_RE if center_re is None else float(center_re)
    im = DEFAULT_CENTER_IM if center_im is None else float(center_im)
    frame = F.col("id").cast("int")
    return spark.range(n_frames).select(
        frame.alias("frame"),
        F.lit(re).alias("center_re"),
        F.lit(im).alias("center_im"),
        _zoom_width(frame, F.lit(n_frames), F.lit(initial), F.lit(final)).alias("width"),
    )


def schedules_from(params: DataFrame) -> DataFrame:
    """Unfold a table of run requests into views.

    ``params`` carries ``run_id`` and ``n_frames`` and may carry ``initial_width``,
    ``final_width``, ``center_re``, ``center_im``; an absent column or a NULL takes the
    default. ``n_frames < 1`` is an error.
    """
    def given(name, default):
        return F.coalesce(F.col(name).cast("double"), F.lit(default)) if name in params.columns else F.lit(default)

    n_frames = F.when(F.col("n_frames") >= 1, F.col("n_frames").cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("a zoom has at least one frame, not "), F.col("n_frames").cast("string")))
    )
    requests = params.select(
        "run_id",
        n_frames.alias("n_frames"),
        given("center_re", DEFAULT_CENTER_RE).alias("center_re"),
        given("center_im", DEFAULT_CENTER_IM).alias("center_im"),
        given("initial_width", DEFAULT_INITIAL_WIDTH).alias("initial_width"),
        given("final_width", DEFAULT_FINAL_WIDTH).alias("final_width"),
    )
    # Unfolded in two steps, dealt anew between them, so that a very long run becomes neither one array
    # nor one task.
    last = F.col("n_frames") - 1
    first = F.col("section") * _SECTION
    unfolded = (
        requests
        .withColumn("section", F.explode(F.sequence(F.lit(0), F.floor(last / _SECTION).cast("int"))))
        .repartition(int(params.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run_id", "section")
        .withColumn("frame", F.explode(F.sequence(first, F.least(first + (_SECTION - 1), last))))
    )
    return unfolded.select(
        "run_id", "frame", "center_re", "center_im",
        _zoom_width(F.col("frame"), F.col("n_frames"), F.col("initial_width"), F.col("final_width")).alias("width"),
    )
