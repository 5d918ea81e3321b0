import pytest

from gridscale.operators.compare import assert_runs_close, compare_frames, compare_runs


@pytest.fixture
def cells(spark):
    def make(*values, frame=0):
        return spark.createDataFrame([(frame, 0, x, v) for x, v in enumerate(values)], "frame INT, y INT, x INT, iterations INT")
    return make


def test_within_tolerance(cells):
    row = compare_runs(cells(1, 2, 3, 9), cells(1, 3, 3, 5), 25.0, 1).first()
    assert (row["n_cells"], row["differing"], row["max_delta"], row["pct"], row["verdict"]) == (4, 1, 4, 25.0, "close")
    assert_runs_close(cells(1, 2), cells(2, 1))


def test_too_different(cells):
    row = compare_runs(cells(1, 2, 3, 9), cells(1, 3, 3, 5), 24.9, 1).first()
    assert row["verdict"] == "too different"
    with pytest.raises(AssertionError, match="1 of 4 cells"):
        assert_runs_close(cells(1, 2, 3, 9), cells(1, 3, 3, 5))


def test_shape_mismatch(cells):
    row = compare_runs(cells(1, 2, 3), cells(1, 2)).first()
    assert (row["unmatched"], row["verdict"]) == (1, "shape mismatch")
    with pytest.raises(AssertionError, match="shape mismatch"):
        assert_runs_close(cells(1, 2), cells(1, 2, 3))


def test_by_frame(cells):
    a = cells(1, 1).union(cells(5, 5, frame=1))
    b = cells(1, 1).union(cells(5, 9, frame=1))
    got = {r["frame"]: (r["differing"], r["verdict"]) for r in compare_frames(a, b).collect()}
    assert got == {0: (0, "close"), 1: (1, "too different")}


def test_empty_runs_are_close(spark, cells):
    nothing = cells(1).limit(0)
    assert compare_runs(nothing, nothing).first()["verdict"] == "close"
