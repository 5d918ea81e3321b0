import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.functions.bands import decode, encode, zone
from gridscale.operators import bands as bands_module
from gridscale.operators.compare import compare_frames
from gridscale.operators.compute import compute_frames
from gridscale.operators.materialise import fill_pending, materialise
from gridscale.operators.render import _level_tiles, build_pyramid, normalise_global, normalise_per_frame, read_pyramid, update_pyramid
from gridscale.operators.stats import frame_stats, global_max, mixed_frames
from gridscale.operators.store import GridStore
from gridscale.operators.zones import (
    cells_above,
    changed_bands,
    changed_rows,
    compare_commits,
    normalise_stored_global,
    normalise_stored_per_frame,
    stored_frame_stats,
    stored_global_max,
    stored_histogram,
    stored_mixed_frames,
)
from gridscale.schema import LAYOUTS

CELL = ("frame", "y", "x", "iterations")


@pytest.fixture(params=LAYOUTS)
def store(spark, tmp_path, request):
    return GridStore(spark, f"file:{tmp_path}/store", request.param)


@pytest.fixture
def small_bands(monkeypatch):
    monkeypatch.setattr(bands_module, "CELLS_PER_BAND", 64)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def sparse(spark, seed, n_frames=4, size=30, share=0.4, top=9):
    r = random.Random(seed)
    cells = [(f, y, x, r.choice([0, 1, 2, 5, 65535, r.randint(0, 10 ** (f + 1) % 60000)][:top]))
             for f in range(n_frames) for y in range(size) for x in range(size) if r.random() < share]
    return spark.createDataFrame(cells, "frame INT, y INT, x INT, iterations INT")


def test_bands_are_read_as_they_were_written():
    r = np.random.default_rng(1)
    for n, gap, top in [(1, 1, 1), (500, 1, 1), (500, 3, 65536), (32768, 1, 3), (20000, 50, 65536), (3, 1 << 40, 65536)]:
        at = np.cumsum(r.integers(1, gap + 1, n)) + int(r.integers(0, 1 << 33))
        counts = r.integers(0, top, n).astype(np.int32)
        got = decode(encode(at, counts))
        assert (got[0] == at).all() and (got[1] == counts).all() and got[1].dtype == np.int32
    flat = encode(np.arange(32768), np.full(32768, 65535))
    assert len(flat) < 100


def test_a_digest_depends_on_cells_and_not_on_their_order():
    at, counts = np.arange(1000, 2000), np.arange(1000) % 7
    mixed = np.random.default_rng(2).permutation(1000)
    first = zone(at, counts, 100, 6)
    assert zone(at[mixed], counts[mixed], 100, 6) == first
    assert (first.last_y, first.last_x, first.in_set, sum(first.histogram)) == (19, 99, (counts == 6).sum(), 1000)
    for k in (0, 500, 999):
        other = counts.copy()
        other[k] += 1
        assert zone(at, other, 100, 6).digest != first.digest
    assert zone(at[1:], counts[1:], 100, 6).digest != first.digest


def test_stored_answers_equal_those_from_cells_and_open_none(spark, store, small_bands):
    store.create_run("r", 4, 30, 30, 65535)
    store.write_frames("r", sparse(spark, 1))
    store.write_frames("r", sparse(spark, 2).filter("frame = 1"))
    for as_of in (None, 2):
        cells = store.read("r", as_of)
        asked = {
            "stats": (stored_frame_stats(store, "r", as_of), frame_stats(cells, 65535)),
            "max": (stored_global_max(store, "r", as_of), global_max(cells)),
            "mixed": (stored_mixed_frames(store, "r", as_of), mixed_frames(cells, 65535)),
            "histogram": (stored_histogram(store, "r", as_of), cells.groupBy(
                "frame", F.floor(F.log2(F.col("iterations") + 1)).cast("int").alias("bin")).agg(F.count("*").alias("n_cells"))),
        }
        for name, (stored, plain) in asked.items():
            assert rows(stored) == rows(plain), name
            assert not [f for f in stored.inputFiles() if "/pixels/" in f] and stored.inputFiles()


def test_normalising_a_stored_run_reads_cells_once(spark, store, small_bands):
    store.create_run("r", 4, 30, 30, 65535)
    store.write_frames("r", sparse(spark, 3))
    cells = store.read("r")
    for stored, plain in ((normalise_stored_global(store, "r"), normalise_global(cells)), (normalise_stored_per_frame(store, "r"), normalise_per_frame(cells))):
        assert rows(stored) == rows(plain)
        assert stored._jdf.queryExecution().executedPlan().toString().count("/pixels/") <= 1


def test_columns_by_frame_are_joined_before_bands_become_cells(spark, store, small_bands):
    """Joined afterwards, all cells of a run were broadcast: their size was taken for that of the packed bands."""
    store.create_run("r", 4, 30, 30, 65535)
    store.write_frames("r", sparse(spark, 5))
    store.write_frames("r", sparse(spark, 6).filter("frame = 1"))
    named = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "d"), (None, "e")], "frame INT, name STRING")
    for how in ({}, {"as_of": 2}, {"values": (1, 9)}, {"where": F.col("frame") < 1}, {"with_view": True}):
        found = store.read("r", by_frame=named, **how)
        assert rows(found) == rows(store.read("r", **how).join(named, "frame"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert store.layout == "cells" or plan.index("MapInArrow") < plan.index("Join")
    plan = normalise_stored_per_frame(store, "r")._jdf.queryExecution().executedPlan().toString()
    assert store.layout == "cells" or plan.index("MapInArrow") < plan.index("Join")


def test_cells_by_value_skip_bands(spark, store, small_bands):
    store.create_run("r", 3, 32, 32, 100)
    cells = spark.range(3 * 1024).select(
        F.expr("int(id div 1024)").alias("frame"), F.expr("int((id % 1024) div 32)").alias("y"), (F.col("id") % 32).cast("int").alias("x"),
        F.expr("int((id % 1024) div 64)").alias("iterations"))  # band k holds the value k
    store.write_frames("r", cells)
    found = store.read("r", values=(3, 4))
    assert as_set(found, *CELL) == as_set(cells.filter("iterations BETWEEN 3 AND 4"), *CELL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    column = "max_seen" if store.layout == "bands" else "iterations"
    assert f"GreaterThanOrEqual({column},3)" in plan
    top = cells_above(store, "r", 0.05)
    assert as_set(top, "iterations") == {(v,) for v in range(15, 16)} and top.count() == 3 * 64
    assert cells_above(store, "r", 1.0).count() == 3 * 1024


def test_a_comparison_of_commits_opens_what_changed(spark, store, small_bands):
    store.create_run("r", 5, 30, 30, 65535)
    first, later = sparse(spark, 5), sparse(spark, 6)
    store.write_frames("r", first)
    again = first.filter("frame = 0").unionByName(first.filter("frame = 2 AND NOT (y = 7 AND x < 20)")).unionByName(
        later.filter("frame = 1 AND y < 3").withColumn("frame", F.lit(4)))
    nudged = again.withColumn("iterations", F.when((F.col("frame") == 2) & (F.col("y") == 20), F.col("iterations") % 7 + 3).otherwise(F.col("iterations")))
    store.write_frames("r", nudged)
    changed = changed_bands(store, "r", 2, 3)
    got = {(r["frame"], r["band"]) for r in changed.collect()}
    # 64 cells are two whole rows of 30; frame 0 was written again as it was
    assert {f for f, _ in got} == {2, 4} and {b for f, b in got if f == 2} == {3, 10}
    assert not [f for f in changed.inputFiles() if "/pixels/" in f]
    for pct, delta in ((1.0, 0), (1.0, 1), (90.0, 2)):
        assert rows(compare_commits(store, "r", 2, 3, pct, delta)) == rows(compare_frames(store.read("r", 3), store.read("r", 2), pct, delta))
    assert compare_commits(store, "r", 3, 3).filter("differing > 0 OR unmatched > 0").isEmpty()
    store.create_run("r", 1, 2, 2)
    with pytest.raises(ValueError, match="anew"):
        changed_bands(store, "r", 2, 4)


def test_layouts_hold_the_same_run(spark, tmp_path, view):
    """Kernel runs and ragged sizes, rows longer than a band included; a run in the set takes a fraction of the bytes."""
    views = view((-0.75, 0, 3.5), (-0.1, 0.8, 0.5), (-0.2, 0, 0.01))
    for height, width in ((7, 5), (1, 40000), (300, 301)):
        stores = [GridStore(spark, f"file:{tmp_path}/{layout}{width}", layout) for layout in LAYOUTS]
        for s in stores:
            s.create_run("z", 3, height, width, 60)
            materialise(s, "z", views.filter("frame <> 1"))
            fill_pending(s, "z", views)
        want = compute_frames(views, height, width, 60)
        for s in stores:
            assert s.read("z").exceptAll(want).isEmpty() and s.read("z").count() == 3 * height * width
        assert rows(stored_frame_stats(stores[0], "z")) == rows(stored_frame_stats(stores[1], "z"))
        assert rows(stores[0].zones("z").drop("snapshot_id")) == rows(stores[1].zones("z").drop("snapshot_id"))
    sizes = [sum(p.stat().st_size for p in (tmp_path / f"{layout}301" / "pixels").rglob("*.parquet")) for layout in LAYOUTS]
    assert sizes[0] * 3 < sizes[1], sizes


def test_a_run_deep_in_the_set_takes_a_tenth_of_the_bytes(spark, tmp_path, view):
    sizes = []
    for layout in LAYOUTS:
        s = GridStore(spark, f"file:{tmp_path}/{layout}", layout)
        s.create_run("z", 1, 600, 600, 300)
        materialise(s, "z", view((-0.2, 0.0, 0.8)))
        sizes.append(sum(p.stat().st_size for p in (tmp_path / layout / "pixels").rglob("*.parquet")))
    assert sizes[0] * 10 <= sizes[1], sizes


def test_an_updated_pyramid_writes_what_changed(spark, store, small_bands, tmp_path):
    """Rows equal those of a full build; one changed band rewrites its tiles and their ancestors, and the rest is named."""
    height, width, size = 70, 90, 16
    store.create_run("r", 3, height, width)
    first = spark.range(3 * height * width).select(
        F.expr(f"int(id div {height * width})").alias("frame"), F.expr(f"int((id % {height * width}) div {width})").alias("y"),
        F.expr(f"int(id % {width})").alias("x"), F.expr("int((id * 2654435761) % 1000)").alias("iterations"))
    store.write_frames("r", first)
    path, whole = f"file:{tmp_path}/tiles", f"file:{tmp_path}/whole"
    build_pyramid(store.read("r"), path, "r", height, width, size)
    second = first.filter("frame = 1").withColumn("iterations", F.when(F.col("y") == 33, F.col("iterations") + 2000).otherwise(F.col("iterations")))
    store.write_frames("r", second)
    third = first.filter("frame = 2").filter("y <> 5")
    store.write_frames("r", third)
    for state, row in ((3, 33), (4, 5)):
        got = update_pyramid(store.read("r", state), changed_rows(store, "r", state - 1, state), path, "r", height, width, size)
        want = build_pyramid(store.read("r", state), whole, "r", height, width, size)
        assert rows(got) == rows(want)
        new = _level_tiles(spark, path, "r", state - 1)
        frames = {r["frame"] for r in new.collect()}
        assert frames == {1 if state == 3 else 2}
        tile_rows = {r["tile_y"] for r in new.filter("z = 3").collect()}
        assert (height - 1 - row) // size in tile_rows and len(tile_rows) <= 2  # a band may reach into the next row of tiles
        assert new.filter("z = 0").count() == 1
    assert rows(read_pyramid(spark, path)) == rows(read_pyramid(spark, whole))
    again = update_pyramid(store.read("r"), changed_rows(store, "r", 4, 4), path, "r", height, width, size)
    assert rows(again) == rows(read_pyramid(spark, whole))
