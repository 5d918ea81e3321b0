from fractions import Fraction

import numpy as np
import pytest

from conftest import as_set
from gridscale.functions.orbits import deep_steps, reference_orbit
from gridscale.operators.compare import compare_runs
from gridscale.operators.compute import compute_frames
from gridscale.operators.deep import deep_frames

VIEWS = "frame INT, center_re STRING, center_im STRING, width DOUBLE"


def by_fixed_point(center_re, center_im, width, n, max_iter, bits=400):
    """The defining loop in whole numbers of 400 bits behind the point, without any orbit but the cell's own."""
    def offset(k):
        return -width / 2 if n == 1 else width / 2 if k == n - 1 else -width / 2 + k * (width / (n - 1))

    out, one = {}, 1 << bits
    for y in range(n):
        for x in range(n):
            cr, ci = (int((Fraction(c) + Fraction(offset(k))) * one // 1) for c, k in ((center_re, x), (center_im, y)))
            zr = zi = 0
            out[y, x] = max_iter
            for k in range(max_iter):
                zr, zi = ((zr * zr - zi * zi) >> bits) + cr, ((2 * zr * zi) >> bits) + ci
                if zr * zr + zi * zi > 4 << (2 * bits):
                    out[y, x] = k
                    break
    return out


@pytest.mark.parametrize("center", [("0", "1.0000000000000000000042"), ("-2", "0"), ("0.000000000000000000003", "-1"), ("-1.7548776662466927600495088963585286918946", "0.1e-20"),
                                    ("-0.7436438870371587047521915061147", "0.1318259042053119704931320385103")])
@pytest.mark.parametrize("width", [1e-20, 1e-30])
def test_equals_the_loop_in_fixed_point(spark, center, width):
    views = spark.createDataFrame([(3, *center, width)], VIEWS)
    got = {(r["y"], r["x"]): r["iterations"] for r in deep_frames(views, 9, 9, 700).collect()}
    assert got == by_fixed_point(*center, width, 9, 700)


def test_views_of_ordinary_depth_equal_the_exact_kernel(spark, view):
    plain = view((-0.75, 0, 3.5), (-0.743643887037151, 0.131825904205330, 1e-3), (2.5, 0, 1), (0, 0, 1e-9))
    deep = deep_frames(plain.selectExpr("frame", "string(center_re) AS center_re", "string(center_im) AS center_im", "width"), 24, 31, 300)
    row = compare_runs(deep, compute_frames(plain, 24, 31, 300, "exact"), 1.0, 1).first()
    assert row["verdict"] == "close" and row["n_cells"] == 4 * 24 * 31 and row["unmatched"] == 0


def test_pieces_and_runs_change_nothing(spark):
    views = spark.createDataFrame([(k, "0", f"1.00000000000000000000{k:02d}", 1e-20) for k in range(3)], VIEWS)
    whole = as_set(deep_frames(views, 40, 50, 120), "frame", "y", "x", "iterations")
    assert len(whole) == 3 * 2000 and len({r[3] for r in whole}) > 5
    assert as_set(deep_frames(views.repartition(3), 40, 50, 120, n_frames=1), "frame", "y", "x", "iterations") == whole
    assert deep_frames(views.limit(0), 4, 4, 10).count() == 0
    single = deep_frames(views, 1, 1, 120).collect()
    assert len(single) == 3


def test_an_orbit_that_escapes_at_once_serves_all_cells():
    """The centre is outside, its neighbours are not: cells start over when the orbit ends."""
    orbit = reference_orbit("2.1", "0", 5.0, 100)
    assert len(orbit[0]) == 2
    counts = deep_steps(*orbit, np.array([-2.1, 0.0, -1.8]), np.array([0.0, 0.0, 0.5]), 100)
    assert counts.tolist() == [100, 0, 100]
