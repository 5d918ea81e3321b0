from concurrent.futures import ThreadPoolExecutor

import pytest

from conftest import as_set
from gridscale.operators.compute import compute_frames
from gridscale.operators.materialise import fan_out, fill_pending, materialise, pending, zoom_run
from gridscale.operators.stats import check_views, frame_stats, global_max, mixed_frames
from gridscale.operators.store import GridStore
from gridscale.plans.catalog import QUERIES
from gridscale.sources.schedule import zoom_schedule
from gridscale.streaming.fill import fill_from_stream, frame_requests

CELL = ("frame", "y", "x", "iterations")


def test_four_frame_zoom(spark, store):
    views = zoom_schedule(spark, 4)
    zoom_run(store, "zoom", views, 32, 32, 64)
    row = store.describe("zoom").first()
    assert (row["n_frames"], row["height"], row["width_px"], row["frames_written"], row["cells_written"]) == (4, 32, 32, 4, 4096)
    assert check_views(store.frames("zoom")).first()["missing"] == 0
    assert all(r["mixed"] for r in mixed_frames(store.read("zoom"), 64).filter("frame = 0").collect())
    stats = {r["frame"]: r for r in frame_stats(store.read("zoom"), 64).collect()}
    assert len(stats) == 4 and all(r["n_cells"] == 1024 and r["height"] == 32 for r in stats.values())
    assert global_max(store.read("zoom")).first()[0] == 64


def test_single_frame_run(spark, store, view):
    zoom_run(store, "one", view((-0.75, 0, 3.5)), 16, 16, 20)
    frame = store.read_frame("one", 0)
    assert frame.count() == 256 and as_set(store.frames("one"), "width") == {(3.5,)}
    assert mixed_frames(frame, 20).first()["mixed"]


def test_fan_out_equals_one_job(spark, store):
    views = zoom_schedule(spark, 10)
    store.create_run("fan", 10, 6, 6, 40)
    staged = [fan_out(store, "fan", views, 8, task) for task in range(8)]
    assert [s is None for s in staged] == [False] * 5 + [True] * 3
    assert store.read("fan").count() == 0
    store.commit("fan", [s for s in staged if s])
    assert as_set(store.read("fan"), *CELL) == as_set(compute_frames(views, 6, 6, 40), *CELL)
    assert store.commits("fan").count() == 6
    with pytest.raises(ValueError):
        fan_out(store, "fan", views, 8, 8)


def test_workers_stage_at_the_same_time_and_one_caller_commits(spark, store):
    views = zoom_schedule(spark, 8)
    store.create_run("fan", 8, 5, 5, 30)
    with ThreadPoolExecutor(4) as pool:
        workers = [GridStore(spark, store.root) for _ in range(4)]
        staged = list(pool.map(lambda t: fan_out(workers[t], "fan", views, 4, t), range(4)))
    store.commit("fan", staged)
    assert [(c["commit_seq"], c["message"]) for c in store.history("fan").collect()][1:] == [(k + 2, f"task {k} of 4") for k in range(4)]
    assert as_set(store.read("fan"), *CELL) == as_set(compute_frames(views, 5, 5, 30), *CELL)
    assert store.read("fan").count() == 200


def test_progress_survives_a_crash(spark, store, monkeypatch):
    views = zoom_schedule(spark, 7)
    store.create_run("r", 7, 5, 5, 30)
    before, calls = GridStore.commit, []

    def third_dies(self, *args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        before(self, *args)

    monkeypatch.setattr(GridStore, "commit", third_dies)
    with pytest.raises(RuntimeError):
        materialise(store, "r", views, frames_per_commit=2)
    monkeypatch.undo()
    assert as_set(pending(store, "r", views), "frame") == {(4,), (5,), (6,)}
    fill_pending(store, "r", views, frames_per_commit=2)
    assert [c["n_frames"] for c in store.history("r").collect()] == [0, 2, 2, 2, 1]
    assert as_set(store.read("r"), *CELL) == as_set(compute_frames(views, 5, 5, 30), *CELL)


def test_a_run_of_other_settings_is_refused(spark, store):
    views = zoom_schedule(spark, 2)
    zoom_run(store, "r", views, 4, 4, 50)
    for other in ((8, 4, 50, "early_exit"), (4, 4, 51, "early_exit"), (4, 4, 50, "exact")):
        with pytest.raises(ValueError, match="other settings"):
            zoom_run(store, "r", views, *other)
    zoom_run(store, "r", views, 4, 4, 50)
    assert store.describe("r").first()["cells_written"] == 32


def test_a_deep_frame_uses_many_tasks(spark, view):
    cells = compute_frames(view((-0.5, 0, 1)), 512, 512, 4000, "exact")
    assert cells.rdd.getNumPartitions() >= 7


def test_pending_and_fill(spark, store):
    views = zoom_schedule(spark, 6)
    store.create_run("r", 6, 5, 5, 30)
    assert pending(store, "r", views).count() == 6
    materialise(store, "r", views.filter("frame IN (1, 4)"))
    assert as_set(pending(store, "r", views), "frame") == {(0,), (2,), (3,), (5,)}
    assert fill_pending(store, "r", views) is not None
    assert fill_pending(store, "r", views) is None
    assert as_set(store.read("r"), *CELL) == as_set(compute_frames(views, 5, 5, 30), *CELL)


def test_fill_after_a_crash(spark, store, monkeypatch):
    views = zoom_schedule(spark, 3)
    store.create_run("r", 3, 5, 5, 30)

    def die(*args, **kwargs):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(GridStore, "_append", die)
    with pytest.raises(RuntimeError):
        fill_pending(store, "r", views)
    monkeypatch.undo()
    assert pending(store, "r", views).count() == 3
    fill_pending(store, "r", views)
    assert store.read("r").count() == 75


def test_a_frame_listed_twice_is_refused(spark, store):
    views = zoom_schedule(spark, 2)
    store.create_run("r", 2, 4, 4, 10)
    with pytest.raises(ValueError, match="more than once"):
        materialise(store, "r", views.union(views))
    with pytest.raises(ValueError, match="outside 0..1"):
        materialise(store, "r", zoom_schedule(spark, 3))
    assert store.commits("r").count() == 1


def test_stream_equals_batch(spark, store, tmp_path):
    views = zoom_schedule(spark, 8)
    store.create_run("s", 8, 5, 5, 30)
    inbox, checkpoint = f"{tmp_path}/inbox", f"{tmp_path}/checkpoint"

    def request(*frames):
        spark.createDataFrame([(f,) for f in frames], "frame INT").coalesce(1).write.mode("append").parquet(inbox)

    request(1, 2, 2)
    request(2, 5)
    fill_from_stream(frame_requests(spark, inbox, 1), store, "s", views, checkpoint).awaitTermination()
    assert as_set(store.frames("s").filter("n_cells > 0"), "frame") == {(1,), (2,), (5,)}
    commits = store.commits("s").count()
    request(5, 7, 99)
    fill_from_stream(frame_requests(spark, inbox, 1), store, "s", views, checkpoint).awaitTermination()
    wanted = views.filter("frame IN (1, 2, 5, 7)")
    assert as_set(store.read("s"), *CELL) == as_set(compute_frames(wanted, 5, 5, 30), *CELL)
    assert store.commits("s").count() == commits + 1
    messages = {r["message"] for r in store.commits("s").collect()}
    assert {"stream batch 0", "stream batch 2"} <= messages


def test_replayed_batch_commits_nothing(spark, store, tmp_path):
    views = zoom_schedule(spark, 3)
    store.create_run("s", 3, 4, 4, 20)
    spark.createDataFrame([(0,), (2,)], "frame INT").coalesce(1).write.parquet(f"{tmp_path}/inbox")
    for attempt in ("a", "b"):  # a lost checkpoint replays everything
        fill_from_stream(frame_requests(spark, f"{tmp_path}/inbox"), store, "s", views,
                         f"{tmp_path}/{attempt}").awaitTermination()
    assert store.commits("s").count() == 2 and store.read("s").count() == 32


def test_filled_cells_learn_their_commit_as_bands(spark, tmp_path):
    """A join of the cells with the frames' commits broadcast every cell of the run through the driver."""
    folder = f"file:{tmp_path}"
    suppliers = [(k, k % 25, 9000.0 if k % 3 else 100.0) for k in range(12)]
    spark.createDataFrame(suppliers, "s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE").write.parquet(f"{folder}/supplier.parquet")
    filled = QUERIES["m5_fill_pending"](spark, folder)
    commits = {(k, 2 if k % 3 else 3) for k in range(12)}
    assert as_set(filled, "frame", "commit_seq") == commits and filled.count() == 12 * 256
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Join")
