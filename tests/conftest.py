import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridscale.operators.store import GridStore  # noqa: E402
from gridscale.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return GridStore(spark, f"file:{tmp_path}/store")


@pytest.fixture
def view(spark):
    """Make a table of one or more views: ``view((re, im, width), ...)``."""
    def make(*views):
        rows = [(i, float(re), float(im), float(w)) for i, (re, im, w) in enumerate(views)]
        return spark.createDataFrame(rows, "frame INT, center_re DOUBLE, center_im DOUBLE, width DOUBLE")
    return make


def as_set(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.select(*columns).collect()}


def counts_by_loop(center_re, center_im, width, n, max_iter):
    """The defining loop in plain Python complex numbers: {(y, x): count}."""
    def axis(c):
        lo, hi = c - width / 2, c + width / 2
        return [lo] if n == 1 else [lo + i * ((hi - lo) / (n - 1)) for i in range(n - 1)] + [hi]

    out = {}
    for y, im in enumerate(axis(center_im)):
        for x, re in enumerate(axis(center_re)):
            z, out[y, x] = 0j, max_iter
            for k in range(max_iter):
                z = z * z + complex(re, im)
                if abs(z) > 2:
                    out[y, x] = k
                    break
    return out
