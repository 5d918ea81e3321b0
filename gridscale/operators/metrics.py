"""Run metrics: record, read, compare, and time per frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridscale.schema import METRICS
from gridscale.sources.grid import frame_range_key


def record_metrics(metrics: DataFrame, path: str) -> None:
    """Append run metrics to a folder of JSON lines."""
    metrics.select(*METRICS.names).write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def compare_metrics(metrics: DataFrame, baseline_stage: str) -> DataFrame:
    """Mean wall time per stage, its speed-up over the baseline stage and its rank. Metrics without the
    baseline stage are an error.

    The ranking window runs over one row per stage, after the aggregation."""
    stages = metrics.groupBy("stage_id").agg(
        F.count("*").alias("n_runs"), F.avg("wall_time_seconds").alias("mean_seconds"))
    baseline = (metrics.filter(F.col("stage_id") == baseline_stage)
                .agg(F.coalesce(F.avg("wall_time_seconds"), F.raise_error(F.lit(f"no times of stage {baseline_stage!r}")))
                     .alias("s")).scalar())
    return stages.withColumns({
        "speedup": baseline / F.when(F.col("mean_seconds") > 0, F.col("mean_seconds")),
        "place": F.rank().over(Window.orderBy("mean_seconds")),
    })


def ms_per_frame(commit_frames: DataFrame, by: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Milliseconds per committed frame, by run or by any other column of the frame log."""
    return commit_frames.groupBy(*by).agg(
        F.count("*").alias("n_frames"),
        F.sum("elapsed_s").alias("total_s"),
        (F.sum("elapsed_s") * 1000.0 / F.greatest(F.count("*"), F.lit(1))).alias("ms_per_frame"))


def ms_per_frame_by_task(commit_frames: DataFrame, n_frames: int, n_tasks: int) -> DataFrame:
    """The same for the contiguous frame ranges of a fan-out."""
    return ms_per_frame(
        commit_frames.withColumn("task_index", frame_range_key("frame", n_frames, n_tasks)),
        ("run_id", "task_index"))
