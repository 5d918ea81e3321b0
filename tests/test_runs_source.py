import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.operators.bands import bands_of_cells, compute_bands
from gridscale.operators.materialise import materialise
from gridscale.operators.store import GridStore
from gridscale.sources.runs import register, write_bands

COLUMNS = ["frame", "y", "x", "iterations", "width"]


@pytest.fixture
def filled(spark, store, view):
    register(spark)
    store.create_run("r", 10, 6, 5, 16, "exact")
    views = view(*((-0.5, 0.0, 3.5 / (1 << k)) for k in range(8)))
    materialise(store, "r", views.filter("frame < 6"))
    materialise(store, "r", views.filter("frame BETWEEN 4 AND 7").withColumn("center_re", F.lit(-1.0)))
    return store, views


def read(spark, store, run="r", **options):
    reader = spark.read.format("gridscale_run").option("path", store.root).option("run", run)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


def test_reads_what_the_store_reads(spark, filled):
    store, _ = filled
    for as_of in (None, 2):
        got = read(spark, store, **({} if as_of is None else {"as_of": as_of}))
        want = store.read("r", as_of=as_of, where=F.lit(True), with_view=True)
        assert as_set(got, *COLUMNS, "center_re") == as_set(want, *COLUMNS, "center_re") and got.count() == want.count()
    rows = GridStore(spark, store.root + "-rows", "cells")
    rows.create_run("r", 10, 6, 5, 16, "exact")
    rows.write_frames("r", store.read("r"))
    assert as_set(read(spark, rows), *COLUMNS[:4]) == as_set(store.read("r"), *COLUMNS[:4])
    empty = GridStore(spark, store.root + "-empty")
    empty.create_run("e", 3, 2, 2)
    assert read(spark, empty, "e").count() == 0


def test_filters_are_pushed(spark, filled):
    store, _ = filled
    whole = store.read("r", where=F.lit(True), with_view=True)
    for where in ("frame = 5", "frame IN (1, 6, 9)", "frame > 2 AND frame <= 4", "width < 0.5", "width >= 0.1 AND frame = 2 AND iterations > 3", "frame = 9", "frame = -1"):
        got = read(spark, store).filter(where)
        assert as_set(got, *COLUMNS) == as_set(whole.filter(where), *COLUMNS), where
    plan = read(spark, store).filter("frame = 5 AND width > 0.01 AND iterations > 3")._jdf.queryExecution().executedPlan().toString()
    after = plan[:plan.index("BatchScan")]
    assert "iterations" in after.split("Filter", 1)[1].split("\n")[0]
    assert "(frame" not in after and "(width" not in after  # what the source has taken is not asked again
    os.rename(*(f"{store.root.removeprefix('file:')}/pixels/run_id=r/snapshot_id={s}" + end
                for s in [store.history("r").collect()[1]["snapshot_id"]] for end in ("", "-gone")))
    assert read(spark, store).filter("frame = 7").count() == 30  # the other commit is not opened


def test_a_write_is_one_commit(spark, store, view):
    register(spark)
    views = view(*((-0.5, 0.0, 3.5 / (1 << k)) for k in range(5)))
    store.create_run("w", 9, 300, 300, 16, "exact")
    bands = compute_bands(views, 300, 300, 16, "exact", 5)
    write_bands(bands.join(views, "frame"), store.root, "w", "by the source")
    here = GridStore(spark, store.root)
    assert [(r["message"], r["n_frames"], r["n_cells"], r["first_frame"], r["last_frame"]) for r in here.history("w").collect()[1:]] == [("by the source", 5, 450_000, 0, 4)]
    other = GridStore(spark, store.root + "-other")
    other.create_run("w", 9, 300, 300, 16, "exact")
    materialise(other, "w", views)
    assert here.read("w").exceptAll(other.read("w")).count() == 0 and here.read("w").count() == 450_000
    assert as_set(here.live_frames("w"), "frame", "width", "n_cells") == as_set(other.live_frames("w"), "frame", "width", "n_cells")
    assert as_set(here.zones("w"), "frame", "band", "digest") == as_set(other.zones("w"), "frame", "band", "digest")
    write_bands(bands.limit(0), store.root, "w")
    assert len(GridStore(spark, store.root).history("w").collect()) == 2


def test_a_failed_task_commits_nothing(spark, filled):
    store, _ = filled
    root = store.root.removeprefix("file:")
    cells = spark.range(8).selectExpr("int(id) AS frame", "0 AS y", "0 AS x", "1 AS iterations")
    bands = bands_of_cells(cells, 5, 16)
    before = store.read("r").count()
    broken = bands.withColumn("n_cells", F.when(F.col("frame") == 7, F.raise_error("no")).otherwise(F.col("n_cells")).cast("bigint"))
    outside = bands.withColumn("frame", F.col("frame") + 5)
    twice = bands.unionByName(bands)
    for bad in (broken, outside, twice):
        with pytest.raises(PySparkException):
            write_bands(bad, store.root, "r")
        here = GridStore(spark, store.root)
        assert len(here.history("r").collect()) == 3 and here.read("r").count() == before
        assert not os.path.exists(f"{root}/staged") or not os.listdir(f"{root}/staged")
    with pytest.raises(PySparkException):
        bands.write.format("gridscale_run").mode("append").option("path", store.root).option("run", "none").save()
