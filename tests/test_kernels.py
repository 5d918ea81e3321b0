import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import as_set, counts_by_loop
from gridscale.functions.kernels import (
    _iterate,
    escape_count,
    escape_count_native,
    escape_steps,
    is_cell,
    membership_class,
    to_cell,
)
from gridscale.operators.compare import assert_runs_close, compare_runs
from gridscale.operators.compute import compute_frames
from gridscale.schema import DECLARED_TOLERANCE, MODES

MODES_UNDER_TEST = pytest.mark.parametrize("mode", MODES)


def counts(cells):
    return {(r["y"], r["x"]): r["iterations"] for r in cells.collect()}


@MODES_UNDER_TEST
def test_shape_and_type(view, mode):
    cells = compute_frames(view((-0.5, 0, 2)), 8, 8, 32, mode)
    assert cells.schema["iterations"].dataType.simpleString() == "int"
    assert set(counts(cells)) == {(y, x) for y in range(8) for x in range(8)}


@MODES_UNDER_TEST
def test_point_in_the_set_holds_the_sentinel(view, mode):
    assert counts(compute_frames(view((0, 0, 1)), 1, 1, 100, mode)) == {(0, 0): 100}


@MODES_UNDER_TEST
def test_far_point_escapes_at_once(view, mode):
    assert counts(compute_frames(view((10, 0, 1)), 1, 1, 100, mode)) == {(0, 0): 0}


@MODES_UNDER_TEST
def test_whole_set_view_is_mixed(view, mode):
    values = set(counts(compute_frames(view((-0.75, 0, 3.5)), 16, 16, 50, mode)).values())
    assert 50 in values and min(values) < 50


@pytest.mark.parametrize("shape", [(-0.75, 0.0, 3.5, 48, 256), (-0.743643887037151, 0.131825904205330, 1e-3, 40, 512),
                                   (-0.743643887037151, 0.131825904205330, 1e-8, 16, 1500)])
def test_exact_mode_equals_the_loop(view, shape):
    re, im, width, n, steps = shape
    assert counts(compute_frames(view((re, im, width)), n, n, steps, "exact", n_tiles=3)) == counts_by_loop(*shape)


@MODES_UNDER_TEST
def test_declared_tolerance_holds_at_the_whole_set_view(view, mode):
    v = view((-0.75, 0, 3.5))
    exact = compute_frames(v, 32, 32, 64, "exact")
    assert_runs_close(compute_frames(v, 32, 32, 64, mode), exact, *DECLARED_TOLERANCE[mode])


def test_single_precision_holds_at_a_tenth(view):
    v = view((-0.743643887037151, 0.131825904205330, 0.1))
    assert_runs_close(compute_frames(v, 64, 64, 512, "float32"), compute_frames(v, 64, 64, 512, "exact"), 5.0, 1)


def test_single_precision_drifts_when_zoomed_in(view):
    """Recorded, not promised: the declared limit does not survive the default final width."""
    v = view((-0.743643887037151, 0.131825904205330, 1e-3))
    row = compare_runs(compute_frames(v, 64, 64, 512, "float32"), compute_frames(v, 64, 64, 512, "exact"), 5.0, 1).first()
    assert row["verdict"] == "too different" and 5.0 < row["pct"] < 30.0


@pytest.mark.parametrize("n_tiles", [1, 2, 5, 40])
def test_any_tile_split_gives_the_same_counts(view, n_tiles):
    views = view((-0.75, 0, 3.5), (-0.1, 0.8, 0.5))
    expected = as_set(compute_frames(views, 13, 11, 60), "frame", "y", "x", "iterations")
    assert as_set(compute_frames(views, 13, 11, 60, n_tiles=n_tiles), "frame", "y", "x", "iterations") == expected


def test_points_of_any_table(spark):
    rng = np.random.default_rng(7)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-2, 1, (500, 2)))]
    rows += [(500, None, 0.0), (501, 0.0, float("nan")), (502, float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "id INT, re DOUBLE, im DOUBLE")
    got = df.select("id", escape_count("re", "im", 40, "exact").alias("python"),
                    escape_count_native("re", "im", 40).alias("native")).collect()
    by_id = {r["id"]: r for r in got}
    assert by_id[500]["python"] is None and by_id[500]["native"] is None
    assert by_id[501]["python"] == 40 and by_id[502]["python"] == 0
    assert all(r["python"] == r["native"] for r in got if r["id"] < 500)


def test_counts_do_not_depend_on_the_batch_size(spark):
    df = spark.range(5000).select("id", (-2 + F.col("id") / 2000).alias("re"), (F.col("id") % 97 / 80).alias("im"))
    expected = {r["id"]: r["n"] for r in df.select("id", escape_count("re", "im", 90).alias("n")).collect()}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {r["id"]: r["n"] for r in df.select("id", escape_count("re", "im", 90).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == expected


def test_interval_lengths_do_not_matter():
    re, im = (a.ravel() for a in np.meshgrid(np.linspace(-2, 0.6, 60), np.linspace(-1.2, 1.2, 60)))
    deep = escape_steps(re, im, 700, "exact")
    for steps in (1, 2, 3, 17, 64, 65, 129, 300):
        assert (escape_steps(re, im, steps, "exact") == np.minimum(deep, steps)).all()


@pytest.mark.parametrize("view", [(-0.75, 0.0, 3.5, 70), (-0.12256116687665, 0.74486176661974, 0.4, 40), (-1.7548776662466927, 0.0, 0.05, 40),
                                  (-1.3, 0.0, 0.3, 40), (-0.743643887037151, 0.131825904205330, 1e-3, 24), (0.28, 0.53, 0.1, 30)])
@pytest.mark.parametrize("mode", ["early_exit", "float32"])
def test_cycles_change_no_count(view, mode):
    """Views with parts of many periods: leaving an orbit at its first repetition gives what all steps give."""
    re, im, width, n = view
    kind = np.float32 if mode == "float32" else np.float64
    re, im = (a.ravel().astype(kind) for a in np.meshgrid(np.linspace(re - width / 2, re + width / 2, n), np.linspace(im - width / 2, im + width / 2, n)))
    for steps in (130, 5000, 20001):
        with np.errstate(all="ignore"):
            assert (escape_steps(re, im, steps, mode) == _iterate(re, im, steps)).all()


def test_a_deep_frame_in_the_set_is_left_early():
    """A frame whose in-set points have period 3: most of 65,535 steps are spared."""
    re, im = (a.ravel() for a in np.meshgrid(np.linspace(-0.16, -0.09, 96), np.linspace(0.71, 0.78, 96)))
    start = time.perf_counter()
    whole = escape_steps(re, im, 65535, "exact")
    middle = time.perf_counter()
    assert (escape_steps(re, im, 65535) == whole).all() and (whole == 65535).all()
    assert time.perf_counter() - middle < (middle - start) / 5


def test_membership_is_strict_on_the_edge(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-1.0, 0.0), (-1.25, 0.0), (0.25, 0.0), (2.0, 2.0)], "re DOUBLE, im DOUBLE")
    got = [r[0] for r in df.select(membership_class("re", "im")).collect()]
    assert got == ["cardioid", "period2", "iterate", "iterate", "iterate"]


def test_cell_range(spark):
    df = spark.createDataFrame([(0,), (65535,), (65536,), (-1,)], "v INT")
    assert [r[0] for r in df.select(is_cell("v")).collect()] == [True, True, False, False]
    assert [r[0] for r in df.filter(is_cell("v")).select(to_cell("v")).collect()] == [0, 65535]
    with pytest.raises(Exception, match="cell value outside"):
        df.select(to_cell("v")).collect()


def test_limits_are_checked_up_front(view):
    with pytest.raises(ValueError):
        compute_frames(view((0, 0, 1)), 1, 1, 65536)
    with pytest.raises(ValueError):
        compute_frames(view((0, 0, 1)), 1, 1, 10, "gpu")
    assert counts(compute_frames(view((0, 0, 1)), 1, 1, 65535)) == {(0, 0): 65535}
