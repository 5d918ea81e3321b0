"""Compare two runs cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paired(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Cells of both sides by position, with their difference; null where one side has none."""
    keys = ["frame", "y", "x"]
    a = actual.select(*keys, F.col("iterations").cast("long").alias("a"))
    b = expected.select(*keys, F.col("iterations").cast("long").alias("b"))
    return a.join(b, keys, "full_outer").withColumn("delta", F.abs(F.col("a") - F.col("b")))


def verdicts(max_pixel_diff_pct, max_iter_delta, times=None):
    """The columns of a comparison; a row stands for as many cells as ``times`` says, or for one."""
    def number(condition):
        return F.count_if(condition) if times is None else F.coalesce(F.sum(F.when(condition, F.col(times))), F.lit(0)).cast("long")

    unmatched = number(F.col("delta").isNull())
    differing = number(F.col("delta") > max_iter_delta)
    cells = number(F.lit(True))
    pct = F.when(cells > 0, F.lit(100.0) * differing / cells).otherwise(0.0)
    return [
        cells.alias("n_cells"),
        unmatched.alias("unmatched"),
        differing.alias("differing"),
        F.coalesce(F.max("delta"), F.lit(0)).alias("max_delta"),
        pct.alias("pct"),
        F.when(unmatched > 0, "shape mismatch")
        .when(pct > max_pixel_diff_pct, "too different")
        .otherwise("close").alias("verdict"),
    ]


def compare_runs(actual: DataFrame, expected: DataFrame,
                 max_pixel_diff_pct: float = 1.0, max_iter_delta: int = 1) -> DataFrame:
    """One row: how many cells differ by more than ``max_iter_delta``, in percent, and a
    verdict. A cell that only one side has makes it a shape mismatch. Cells are the join
    keys, so a frame that holds most of the data is spread like any other."""
    return paired(actual, expected).agg(*verdicts(max_pixel_diff_pct, max_iter_delta))


def compare_frames(actual: DataFrame, expected: DataFrame,
                   max_pixel_diff_pct: float = 1.0, max_iter_delta: int = 1) -> DataFrame:
    """The same by frame: where do two runs diverge?"""
    return paired(actual, expected).groupBy("frame").agg(*verdicts(max_pixel_diff_pct, max_iter_delta))


def assert_runs_close(actual: DataFrame, expected: DataFrame,
                      max_pixel_diff_pct: float = 1.0, max_iter_delta: int = 1) -> None:
    """Raise ``AssertionError`` unless the verdict is ``close``."""
    row = compare_runs(actual, expected, max_pixel_diff_pct, max_iter_delta).first()
    if row["verdict"] != "close":
        raise AssertionError(
            f"{row['verdict']}: {row['differing']} of {row['n_cells']} cells ({row['pct']:.2f}%) differ by more "
            f"than {max_iter_delta}, {row['unmatched']} are on one side only; "
            f"allowed are {max_pixel_diff_pct:.2f}%")
