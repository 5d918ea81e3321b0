"""Views deeper than double precision reaches: one orbit in fixed point per view, differences for its cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.functions.orbits import deep_steps, reference_orbit
from gridscale.schema import CELLS, check_max_iter
from gridscale.session import settled
from gridscale.sources.grid import grid_tasks

_CELL_ARROW = pa.schema([(f.name, pa.int32()) for f in CELLS.fields])
#: Cells that are followed together.
_PIECE = 16_384


def deep_orbits(views: DataFrame, max_iter: int) -> DataFrame:
    """``frame, width, re, im, over``: the centre's orbit of every view (``frame``, ``center_re`` and ``center_im`` as decimal strings, ``width``)."""
    check_max_iter(max_iter)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            for row in one.to_pylist():
                orbit = reference_orbit(row["center_re"], row["center_im"], row["width"], max_iter)
                yield pa.RecordBatch.from_pydict({
                    "frame": pa.array([row["frame"]], pa.int32()), "width": [row["width"]], **{n: [v] for n, v in zip(("re", "im", "over"), orbit)}})

    given = views.select(F.col("frame").cast("int"), F.col("center_re").cast("string"), F.col("center_im").cast("string"), F.col("width").cast("double"))
    return given.repartition("frame").mapInArrow(
        follow, "frame INT, width DOUBLE, re ARRAY<DOUBLE>, im ARRAY<DOUBLE>, over ARRAY<DOUBLE>")


def deep_frames(views: DataFrame, height: int, width_px: int, max_iter: int, n_frames: int | None = None) -> DataFrame:
    """Cells ``(frame, y, x, iterations)`` of views at any depth that a double's exponent holds.

    Centres are decimal strings, because a double holds 16 digits; widths are doubles. Orbits are computed once per view and written;
    then every view is cut into runs of positions, as many as spread all views over the tasks, and each run meets its view's orbit
    in one row. The cells of a run are followed in pieces, so memory does not grow with the frame.
    """
    orbits = settled(deep_orbits(views, max_iter))
    n_frames = orbits.count() if n_frames is None else n_frames
    plane = height * width_px
    n_tasks = grid_tasks(views.sparkSession, n_frames * plane, max_iter)
    n_runs = max(1, min(-(-n_tasks // max(n_frames, 1)), -(-plane // _PIECE)))
    size = -(-plane // n_runs)
    runs = orbits.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(plane - 1).cast("long"), F.lit(size).cast("long"))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            for k in range(one.num_rows):
                orbit = [one[c][k].values.to_numpy() for c in ("re", "im", "over")]
                frame, width, first = (one[c][k].as_py() for c in ("frame", "width", "first"))
                columns, rows = _away(width, width_px), _away(width, height)
                for low in range(first, min(first + size, plane), _PIECE):
                    at = np.arange(low, min(low + _PIECE, first + size, plane))
                    y, x = at // width_px, at % width_px
                    counts = deep_steps(*orbit, columns[x], rows[y], max_iter)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), frame, np.int32)), pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array(counts)],
                        schema=_CELL_ARROW)

    return runs.repartition(n_tasks, "frame", "first").mapInArrow(cells, CELLS)


def _away(width: float, n: int) -> np.ndarray:
    """Distances of ``n`` samples from the centre: the last one is the right edge itself, a single one the left edge."""
    if n == 1:
        return np.array([-width / 2])
    values = -width / 2 + np.arange(n) * (width / (n - 1))
    values[-1] = width / 2
    return values
