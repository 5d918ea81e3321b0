import math

import pytest

from gridscale.operators.stats import check_views, check_widths_decrease, check_widths_log_uniform
from gridscale.sources.schedule import schedules_from, zoom_schedule


def rows(df):
    return sorted(df.collect(), key=lambda r: r["frame"])


def test_endpoints_and_constant_centre(spark):
    views = rows(zoom_schedule(spark, 200))
    assert len(views) == 200
    assert views[0]["width"] == pytest.approx(3.5)
    assert views[-1]["width"] == pytest.approx(1e-3)
    assert {(v["center_re"], v["center_im"]) for v in views} == {(-0.743643887037151, 0.131825904205330)}


def test_checks_accept_a_schedule(spark):
    views = zoom_schedule(spark, 100)
    assert check_widths_decrease(views).first()["decreasing"]
    assert check_widths_log_uniform(views).first()["log_uniform"]
    complete = check_views(views).first()
    assert (complete["missing"], complete["center_constant"]) == (0, True)


def test_checks_reject_bad_views(spark, view):
    rising = view((0, 0, 1.0), (0, 0, 2.0), (1, 0, 4.5))
    assert not check_widths_decrease(rising).first()["decreasing"]
    assert not check_widths_log_uniform(rising).first()["log_uniform"]
    assert not check_views(rising).first()["center_constant"]
    holes = rising.selectExpr("frame", "center_re", "center_im", "if(frame = 1, NULL, width) AS width")
    assert check_views(holes).first()["missing"] == 1


def test_neighbours_are_taken_in_order_whatever_the_gaps(spark):
    views = spark.createDataFrame(
        [("gap", 0, 1.0), ("gap", 2, 2.0), ("gap", 3, 1.5), ("one", 5, 1.0), ("far", 0, 4.0), ("far", 200_000, 2.0), ("far", 70_000, 3.0),
         ("nan", 0, 2.0), ("nan", 1, float("nan")), ("null", 0, 2.0), ("null", 1, None)], "run_id STRING, frame INT, width DOUBLE")
    got = {r["run_id"]: tuple(r)[1:] for r in check_widths_decrease(views).collect()}
    assert got == {"gap": (2, 1, False), "one": (0, 0, True), "far": (2, 0, True), "nan": (1, 1, False), "null": (1, 1, False)}
    got = {r["run_id"]: (r["n_steps"], r["log_uniform"]) for r in check_widths_log_uniform(views).collect()}
    assert got == {"gap": (2, False), "one": (0, True), "far": (2, False), "nan": (1, False), "null": (1, False)}


def test_nan_is_as_incomplete_as_null(spark):
    views = spark.createDataFrame([(0, float("nan"), 0.0, 1.0), (1, float("nan"), 0.0, 0.5)], "frame INT, center_re DOUBLE, center_im DOUBLE, width DOUBLE")
    row = check_views(views).first()
    assert (row["missing"], row["center_constant"]) == (2, False)


def test_widths_match_the_formula(spark):
    views = rows(zoom_schedule(spark, 50, 10.0, 1e-5))
    for i, v in enumerate(views):
        expected = 10 ** (1 + i * (-5 - 1) / 49)
        assert v["width"] == pytest.approx(expected, rel=1e-12)
    steps = [math.log(b["width"] / a["width"]) for a, b in zip(views, views[1:])]
    assert max(steps) - min(steps) < 1e-10


def test_single_frame_is_the_initial_width(spark):
    assert [v["width"] for v in rows(zoom_schedule(spark, 1))] == [3.5]


def test_no_frames_is_refused(spark):
    with pytest.raises(ValueError):
        zoom_schedule(spark, 0)
    bad = spark.createDataFrame([("a", 0)], "run_id STRING, n_frames INT")
    with pytest.raises(Exception, match="at least one frame"):
        schedules_from(bad).collect()


def test_overrides_fall_back_one_by_one(spark):
    views = rows(zoom_schedule(spark, 7, center_re=-1.25066))
    assert {(v["center_re"], v["center_im"]) for v in views} == {(-1.25066, 0.131825904205330)}
    params = spark.createDataFrame(
        [("a", 3, 10.0, None), ("b", 2, None, 0.0)], "run_id STRING, n_frames INT, initial_width DOUBLE, center_im DOUBLE")
    got = {(r["run_id"], r["frame"]): r for r in schedules_from(params).collect()}
    assert len(got) == 5
    assert got["a", 0]["width"] == pytest.approx(10.0) and got["a", 0]["center_im"] == 0.131825904205330
    assert got["b", 0]["width"] == pytest.approx(3.5) and got["b", 1]["center_im"] == 0.0


def test_long_runs_unfold_in_sections(spark):
    params = spark.createDataFrame([("a", 10_000), ("b", 10_001), ("c", 25_000)], "run_id STRING, n_frames INT")
    got = schedules_from(params).groupBy("run_id").agg({"frame": "max", "*": "count"})
    assert {tuple(r) for r in got.select("run_id", "max(frame)", "count(1)").collect()} == {
        ("a", 9_999, 10_000), ("b", 10_000, 10_001), ("c", 24_999, 25_000)}
    assert schedules_from(params).select("run_id", "frame").distinct().count() == 45_001
