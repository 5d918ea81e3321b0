import pytest
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.operators.materialise import fill_pending
from gridscale.operators.store import GridStore
from gridscale.sources.schedule import zoom_schedule
from gridscale.streaming import requests
from gridscale.streaming.requests import EVENTS, fill_orders, frame_events, frame_orders


@pytest.fixture
def desk(spark, store, tmp_path):
    for run in ("a", "b"):
        store.create_run(run, 6, 4, 4, 16, "exact")
    schedule = zoom_schedule(spark, n_frames=6, final_width=1e-2)
    schedule = schedule.drop("run_id") if "run_id" in schedule.columns else schedule
    views = schedule.crossJoin(spark.createDataFrame([("a",), ("b",)], "run_id STRING"))
    folder = f"file:{tmp_path}/events"

    def tell(*rows):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)

    def run(fill=fill_pending, retry_s=0.001, max_attempts=3):
        orders = frame_orders(frame_events(spark, folder), retry_s, max_attempts)
        fill_orders(orders, store, views, folder, f"file:{tmp_path}/checkpoint", fill=fill).awaitTermination()

    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield tell, run, lambda r: {x["frame"] for x in GridStore(spark, store.root).live_frames(r).collect()}, folder
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_asked_once_however_often(spark, store, desk):
    tell, run, live, folder = desk
    tell(("a", 1, "asked"), ("a", 1, "asked"), ("b", 2, "asked"), (None, 1, "asked"), ("a", None, "asked"), ("a", 3, "other"))
    run(retry_s=3600)
    assert live("a") == {1} and live("b") == {2}
    tell(("a", 1, "asked"), ("a", 4, "asked"))
    run(retry_s=3600)
    assert live("a") == {1, 4}
    assert [r["n_frames"] for r in store.history("a").collect()] == [0, 1, 1]
    assert as_set(spark.read.parquet(folder).filter("event = 'done'"), "run_id", "frame") == {("a", 1), ("b", 2), ("a", 4)}


def test_a_bad_frame_is_tried_again_and_holds_up_no_other(spark, desk):
    tell, run, live, folder = desk

    def broken(here, run_id, views, message=None):
        if views.filter("frame = 3").count():
            raise RuntimeError("frame 3 does not work today")
        return fill_pending(here, run_id, views, message)

    tell(*(("a", k, "asked") for k in range(6)))
    run(broken)
    assert live("a") == {0, 1, 2, 4, 5}
    assert as_set(spark.read.parquet(folder).filter("event = 'failed'"), "frame") == {(3,)}
    run()  # reads the outcome
    tell(("b", 0, "look at the clock"))
    run()
    assert live("a") == {0, 1, 2, 3, 4, 5}


def test_given_up_after_the_last_attempt(spark, desk):
    tell, run, live, folder = desk
    tell(("a", 99, "asked"), ("none", 1, "asked"))  # no such view, no such run
    for _ in range(4):
        run(max_attempts=2)
        tell(("b", 0, "look at the clock"))
    failed = spark.read.parquet(folder).filter("event = 'failed'").groupBy("run_id", "frame").count()
    assert as_set(failed, "run_id", "frame", "count") == {("a", 99, 2), ("none", 1, 2)}
    tell(("a", 99, "asked"))
    run(max_attempts=2)
    assert spark.read.parquet(folder).filter("event = 'failed' AND frame = 99").count() == 2
    assert live("a") == set()


def test_outcomes_are_told_by_as_many_tasks_as_there_are_files(spark, desk, monkeypatch):
    """One task used to look up and write the outcomes of all frames; now the files are dealt, and one holds no more than its share."""
    monkeypatch.setattr(requests, "OUTCOMES_PER_FILE", 2, raising=False)
    tell, run, live, folder = desk
    tell(*(("a", k, "asked") for k in range(6)))
    run(retry_s=3600)
    told = spark.read.parquet(folder).filter("event = 'done'")
    assert as_set(told, "run_id", "frame") == {("a", k) for k in range(6)} and told.count() == 6
    assert told.select(F.input_file_name()).distinct().count() > 1
