import threading

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.operators.store import CREATE_MESSAGE, GridStore
from gridscale.schema import LAYOUTS
from gridscale.sources.grid import missing_cells

CELL = ("frame", "y", "x", "iterations")


@pytest.fixture(params=LAYOUTS)
def store(spark, tmp_path, request):
    return GridStore(spark, f"file:{tmp_path}/store", request.param)


def plane(spark, frame, size, value):
    return spark.range(size * size).select(
        F.lit(frame).alias("frame"), F.expr(f"int(id div {size})").alias("y"),
        (F.col("id") % size).cast("int").alias("x"), F.lit(value).alias("iterations"))


def test_new_run_has_empty_frames(store):
    store.create_run("r", 4, 16, 16)
    frames = store.frames("r").collect()
    assert [f["frame"] for f in sorted(frames)] == [0, 1, 2, 3]
    assert all(f["center_re"] is None and f["width"] is None and f["n_cells"] == 0 for f in frames)
    assert store.read("r").count() == 0
    dense = store.dense("r")
    assert dense.count() == 4 * 256 and dense.filter("iterations <> 0 OR width IS NOT NULL").isEmpty()


def test_a_write_leaves_other_frames_alone(spark, store, view):
    store.create_run("r", 3, 8, 8)
    views = view((0, 0, 1), (-0.75, 0, 3.5))
    store.write_frames("r", plane(spark, 1, 8, 42), views)
    frames = {f["frame"]: f for f in store.frames("r").collect()}
    assert frames[0]["width"] is None and frames[2]["width"] is None
    assert (frames[1]["center_re"], frames[1]["center_im"], frames[1]["width"]) == (-0.75, 0.0, 3.5)
    dense = store.dense("r")
    assert dense.filter("frame = 1").agg(F.min("iterations"), F.max("iterations"), F.count("*")).first()[:] == (42, 42, 64)
    assert dense.filter("frame <> 1").agg(F.max("iterations"), F.count("*")).first()[:] == (0, 128)


def test_values_are_cast_or_refused(spark, store):
    store.create_run("r", 1, 4, 4)
    store.write_frames("r", plane(spark, 0, 4, 100).withColumn("iterations", F.col("iterations").cast("long")))
    assert as_set(store.read("r"), "iterations") == {(100,)}
    assert store.read("r").schema["iterations"].dataType.simpleString() == "int"
    for bad in (plane(spark, 0, 4, 65536), plane(spark, 0, 4, -1), plane(spark, 1, 4, 1), plane(spark, 0, 5, 1)):
        with pytest.raises(Exception, match="does not fit the run"):
            store.write_frames("r", bad)
    assert store.commits("r").count() == 2


def test_a_cell_given_twice_is_refused(spark, store):
    store.create_run("r", 1, 4, 4)
    twice = plane(spark, 0, 4, 1).union(plane(spark, 0, 4, 2).limit(1))
    with pytest.raises(ValueError, match="more than once"):
        store.write_frames("r", twice)
    assert store.read("r").count() == 0


def test_an_empty_write_changes_nothing(spark, store):
    store.create_run("r", 2, 2, 2)
    store.write_frames("r", plane(spark, 0, 2, 4))
    store.write_frames("r", plane(spark, 1, 2, 4).filter("iterations > 4"))
    assert as_set(store.read("r"), *CELL) == {(0, y, x, 4) for y in range(2) for x in range(2)}
    assert store.dense("r").filter("iterations = 4").count() == 4
    assert store.history("r").collect()[-1]["n_cells"] == 0


def test_history_latest_and_as_of(spark, store):
    store.create_run("r", 3, 2, 2)
    store.write_frames("r", plane(spark, 0, 2, 1).union(plane(spark, 1, 2, 1)))
    store.write_frames("r", plane(spark, 1, 2, 9), message="second look")
    store.write_frames("r", plane(spark, 2, 2, 5))
    log = [(c["commit_seq"], c["message"], c["n_frames"], c["n_cells"]) for c in store.history("r").collect()]
    assert log == [(1, CREATE_MESSAGE, 0, 0), (2, "wrote 2 frames", 2, 8), (3, "second look", 1, 4), (4, "wrote frame 2", 1, 4)]
    assert as_set(store.read("r"), "frame", "iterations") == {(0, 1), (1, 9), (2, 5)}
    assert as_set(store.read("r", as_of=2), "frame", "iterations") == {(0, 1), (1, 1)}
    assert as_set(store.read("r", as_of=3), "frame", "iterations") == {(0, 1), (1, 9)}
    assert store.read("r", as_of=1).count() == 0
    assert store.read("r").count() == 12
    assert as_set(store.read_frame("r", 1), *CELL) == {(1, y, x, 9) for y in range(2) for x in range(2)}
    assert as_set(store.read_frame("r", 1, as_of=2), "iterations") == {(1,)}
    with pytest.raises(ValueError):
        store.read_frame("r", 3)


def test_files_without_a_log_row_do_not_exist(spark, store, monkeypatch):
    """A driver that dies before the log row leaves the run as it was, and can try again."""
    store.create_run("r", 2, 2, 2)
    store.write_frames("r", plane(spark, 0, 2, 1))

    def die(*args, **kwargs):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(GridStore, "_append", die)
    with pytest.raises(RuntimeError):
        store.write_frames("r", plane(spark, 0, 2, 7).union(plane(spark, 1, 2, 7)))
    monkeypatch.undo()
    assert as_set(store.read("r"), "frame", "iterations") == {(0, 1)}
    assert store.frames("r").filter("n_cells > 0").count() == 1
    store.write_frames("r", plane(spark, 1, 2, 8))
    assert as_set(store.read("r"), "frame", "iterations") == {(0, 1), (1, 8)}


def test_create_if_absent_and_create_again(spark, store):
    assert store.create_run_if_absent("r", 2, 2, 2)
    store.write_frames("r", plane(spark, 0, 2, 3))
    assert not store.create_run_if_absent("r", 9, 9, 9)
    assert store.describe("r").first()["n_frames"] == 2
    store.create_run("r", 5, 2, 2)
    assert store.read("r").count() == 0 and store.describe("r").first()["n_frames"] == 5
    assert store.read("r", as_of=2).count() == 4
    runs = as_set(store.list_runs(), "run_id", "n_frames", "frames_done")
    assert runs == {("r", 5, 0)}


def test_select_by_label(spark, store, view):
    store.create_run("r", 3, 2, 2)
    cells = plane(spark, 0, 2, 1).union(plane(spark, 1, 2, 2)).union(plane(spark, 2, 2, 3))
    store.write_frames("r", cells, view((0, 0, 4), (0, 0, 2), (0, 0, 1)))
    assert as_set(store.select("r", frame=1), "iterations", "width") == {(2, 2.0)}
    assert as_set(store.select("r", width=1.0), "frame") == {(2,)}
    assert as_set(store.select("r", width_between=(2.0, 4.0)), "frame") == {(0,), (1,)}


def test_partly_written_frames_fill_up_in_the_dense_view(spark, store):
    store.create_run("r", 2, 3, 3)
    store.write_frames("r", plane(spark, 0, 3, 6).union(plane(spark, 1, 3, 6).filter("y = 1")))
    dense = store.dense("r")
    assert dense.count() == 18 and dense.filter("iterations = 6").count() == 12
    assert dense.select("frame", "y", "x").distinct().count() == 18


def lose(store, folder):
    """Delete one data folder of a store below a test's own temporary folder."""
    spark = store.spark
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store.root}/{folder}")
    assert path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def test_a_folder_that_is_gone_is_an_error(spark, store):
    store.create_run("r", 4, 2, 2)
    kept = store.write_frames("r", plane(spark, 0, 2, 1))
    gone = store.write_frames("r", plane(spark, 1, 2, 2))
    store.write_frames("r", plane(spark, 2, 2, 3))
    lose(store, f"pixels/run_id=r/snapshot_id={gone}")
    for read in (lambda: store.read("r"), lambda: store.read_frame("r", 1), lambda: store.dense("r"), lambda: store.select("r", frame=1)):
        with pytest.raises(FileNotFoundError, match=gone):
            read().count()
    assert as_set(store.read_frame("r", 2), "iterations") == {(3,)}  # needs another folder
    assert as_set(store.read("r", as_of=kept), "iterations") == {(1,)}
    lose(store, f"frames/run_id=r/snapshot_id={gone}")
    with pytest.raises(FileNotFoundError, match=gone):
        store.frames("r").count()


def test_a_lost_folder_among_very_many_commits(spark, store):
    """The outcome does not depend on how many commits the log has."""
    store.create_run("r", 2000, 1, 1)
    real = store.write_frames("r", spark.createDataFrame([(0, 0, 0, 5)], "frame INT, y INT, x INT, iterations INT"))
    store._append("r", [{"snapshot_id": f"s{k}", "message": "m", "n_frames": 1, "n_cells": 1, "elapsed_s": 0.0} for k in range(1200)])
    assert len(store.state("r").commits) == 1201
    with pytest.raises(FileNotFoundError):
        store.read("r").count()
    assert as_set(store.read("r", as_of=real), "iterations") == {(5,)}


def test_a_commit_between_state_and_read_changes_nothing(spark, store):
    store.create_run("r", 2, 2, 2)
    store.write_frames("r", plane(spark, 0, 2, 1))
    store.write_frames("r", plane(spark, 1, 2, 1))
    state = store.state("r")
    store.write_frames("r", plane(spark, 0, 2, 9))
    live = {r["frame"]: r["commit_seq"] for r in store.live_frames("r", state=state).collect()}
    assert live == {0: 2, 1: 3}
    assert {r["frame"]: r["commit_seq"] for r in store.live_frames("r").collect()} == {0: 4, 1: 3}


def test_a_second_committer_is_refused(spark, store, monkeypatch):
    store.create_run("r", 2, 2, 2)
    staged = [store.stage_frames("r", plane(spark, f, 2, f + 1)) for f in range(2)]
    assert store.read("r").count() == 0
    store.commit("r", staged)
    assert [c["commit_seq"] for c in store.history("r").collect()] == [1, 2, 3]
    other = GridStore(spark, store.root)
    monkeypatch.setattr(other, "_newest", lambda run_id: 1)  # it looked before the first one wrote
    with pytest.raises(RuntimeError, match="another committer"):
        other.create_run("r", 2, 2, 2)
    assert as_set(store.read("r"), "frame", "iterations") == {(0, 1), (1, 2)}


def test_of_two_committers_at_once_one_wins(spark, store):
    """Both start from the same version, again and again; every version is one of theirs, whole, and no entry is lost."""
    store.create_run("r", 100, 1, 1)
    done = []

    def commits(name):
        own = GridStore(spark, store.root)
        for k in range(30):
            try:
                own._append("r", [{"snapshot_id": f"{name}{k}", "message": name, "n_frames": 0, "n_cells": 0, "elapsed_s": 0.0}])
                done.append(f"{name}{k}")
            except RuntimeError:
                pass

    threads = [threading.Thread(target=commits, args=(name,)) for name in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = store.history("r").collect()
    assert sorted(c["snapshot_id"] for c in log[1:]) == sorted(done) and len(done) >= 30
    assert [c["commit_seq"] for c in log] == list(range(1, len(log) + 1))
    assert len(GridStore(spark, store.root)._chain("r")) <= 64 and store._log("r") == GridStore(spark, store.root)._log("r")


def test_a_committer_that_died_does_not_block_the_next(spark, store):
    """Drafts and folders that a killed driver leaves are no version of the log."""
    store.create_run("r", 2, 1, 1)
    spark.range(1).write.parquet(f"{store.root}/commits/run_id=r/version=2/_temporary/0")
    spark.range(1).write.json(f"{store.root}/commits/run_id=r/.draft-lost")
    store.write_frames("r", plane(spark, 1, 1, 7))
    assert store.history("r").count() == 2 and as_set(store.read("r"), "frame", "iterations") == {(1, 7)}
    assert {r["run_id"] for r in store.list_runs().collect()} == {"r"}


def test_as_of_a_snapshot_id(spark, store):
    store.create_run("r", 2, 2, 2)
    first = store.write_frames("r", plane(spark, 0, 2, 1))
    store.write_frames("r", plane(spark, 0, 2, 2))
    assert as_set(store.read("r", as_of=first), "iterations") == {(1,)}
    assert as_set(store.read_frame("r", 0, as_of=first), "iterations") == {(1,)}
    with pytest.raises(ValueError, match="no such snapshot"):
        store.read("r", as_of="nothing")


def test_reading_one_frame_opens_one_folder(spark, store, monkeypatch):
    import gridscale.operators.store as module
    monkeypatch.setattr(module, "CELLS_PER_BLOCK", 4)
    store.create_run("r", 3, 2, 2)
    snapshot = store.write_frames("r", plane(spark, 0, 2, 1).union(plane(spark, 1, 2, 2)).union(plane(spark, 2, 2, 3)))
    one = store.read_frame("r", 2)
    assert {f.split("/run_id=r/")[1].rsplit("/", 1)[0] for f in one.inputFiles()} == {f"snapshot_id={snapshot}/frame_block=2"}
    assert as_set(one, "iterations") == {(3,)}


def test_a_cell_repeated_in_a_split_frame_is_found(spark, store):
    store.create_run("r", 1, 300, 300)
    twice = plane(spark, 0, 300, 1).repartition(20).union(plane(spark, 0, 300, 2).filter("y = 299 AND x = 7"))
    with pytest.raises(ValueError, match="more than once"):
        store.write_frames("r", twice)


def test_one_very_long_line_is_filled_in_segments(spark):
    width = 3_000_000
    lines = spark.createDataFrame([(0, 0)], "frame INT, y INT")
    known = spark.range(0, width, 3).select(F.lit(0).alias("frame"), F.lit(0).alias("y"), F.col("id").cast("int").alias("x"))
    gaps = missing_cells(lines, known, width, 8)
    assert gaps.agg(F.count("*"), F.sum("x")).first()[:] == (2_000_000, sum(range(width)) - sum(range(0, width, 3)))


def test_a_frame_that_holds_most_cells_is_split(spark, tmp_path):
    """Adaptive execution cuts the hot frame into several files; every cell arrives once."""
    store = GridStore(spark, f"file:{tmp_path}/store", "cells")
    store.create_run("r", 40, 600, 600)
    hot = plane(spark, 3, 600, 7)
    rest = spark.range(40).select(F.col("id").cast("int").alias("frame"), F.lit(0).alias("y"), F.lit(0).alias("x"),
                                  F.lit(1).alias("iterations")).filter("frame <> 3")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        store.write_frames("r", hot.repartition(12).union(rest))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    cells = store.read("r")
    files = cells.filter("frame = 3").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1
    assert cells.count() == 360_000 + 39 and cells.select("frame", "y", "x").distinct().count() == 360_039


def test_unknown_run(store):
    with pytest.raises(ValueError, match="names a folder"):
        store.create_run("a/b", 1, 1, 1)
    with pytest.raises(ValueError, match="no run"):
        store.read("nothing")
