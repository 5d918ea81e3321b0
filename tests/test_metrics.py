import pytest

from gridscale.operators.metrics import compare_metrics, ms_per_frame, ms_per_frame_by_task, read_metrics, record_metrics
from gridscale.schema import METRICS


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame([
        ("a", "loop", "loop", 512, "zoom", None, 20.0, None),
        ("b", "loop", "loop", 512, "zoom", "abc", 10.0, 64.0),
        ("c", "tiles", "tiles", 512, "zoom", None, 0.5, None),
    ], METRICS)


def test_record_appends_and_reads_back(spark, metrics, tmp_path):
    record_metrics(metrics.limit(1), f"{tmp_path}/m")
    record_metrics(metrics.subtract(metrics.limit(1)), f"{tmp_path}/m")
    assert sorted(read_metrics(spark, f"{tmp_path}/m").collect(), key=lambda r: r["run_id"]) == metrics.collect()


def test_speedup_over_the_baseline(metrics):
    got = {r["stage_id"]: (r["n_runs"], r["mean_seconds"], r["speedup"], r["place"]) for r in compare_metrics(metrics, "loop").collect()}
    assert got == {"loop": (2, 15.0, 1.0, 2), "tiles": (1, 0.5, 30.0, 1)}


def test_an_absent_baseline_is_an_error(metrics):
    with pytest.raises(Exception, match="no times of stage 'other'"):
        compare_metrics(metrics, "other").collect()


def test_ms_per_frame(spark):
    log = spark.createDataFrame([("r", 0, 1.0), ("r", 1, 3.0), ("r", 9, 2.0)], "run_id STRING, frame INT, elapsed_s DOUBLE")
    assert ms_per_frame(log).first()[:] == ("r", 3, 6.0, 2000.0)
    tasks = {r["task_index"]: r["ms_per_frame"] for r in ms_per_frame_by_task(log, 10, 8).collect()}
    assert tasks == {0: 2000.0, 4: 2000.0}
