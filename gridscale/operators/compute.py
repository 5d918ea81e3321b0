"""Escape counts of whole views: tile rows in, cell rows out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridscale.functions.kernels import escape_steps
from gridscale.schema import CELLS, CELLS_PER_TILE, check_max_iter, check_mode
from gridscale.sources.grid import default_tiles, grid_tasks, tile_grid

_CELL_ARROW = pa.schema([(f.name, pa.int32()) for f in CELLS.fields])


def axis_slice(center, width, n, start, stop):
    lo, hi = center - width / 2.0, center + width / 2.0
    if n == 1:
        return np.array([lo])[start:stop]
    values = lo + np.arange(start, stop) * ((hi - lo) / (n - 1))
    if stop == n:
        values[-1] = hi
    return values


def compute_frames(
    views: DataFrame,
    height: int,
    width_px: int,
    max_iter: int,
    mode: str = "early_exit",
    n_tiles: int | None = None,
    n_frames: int | None = None,
) -> DataFrame:
    """Cells ``(frame, y, x, iterations)`` of every view.

    Only the tile rows are shuffled: each Python task derives the coordinates of its
    tiles, so no coordinate ever crosses the JVM boundary, and cells leave in frame
    order, ready to be written without another exchange. Filters on frames belong on
    ``views``; nothing is pushed through the kernel. The job passes over ``views`` up to
    three times (counting, range bounds, work), so settle views that are costly to make.
    """
    check_max_iter(max_iter)
    check_mode(mode)
    if n_frames is None:
        n_frames = views.count()
    n_tasks = grid_tasks(views.sparkSession, n_frames * height * width_px, max_iter)
    if n_tiles is None:
        n_tiles = default_tiles(height, width_px, -(-n_tasks // max(n_frames, 1)))

    tiles = tile_grid(views.select("frame", "center_re", "center_im", "width"), height, width_px, n_tiles)
    if n_tasks > 1 and n_frames > 1:
        tiles = tiles.repartitionByRange(n_tasks, "frame", "tile_y", "tile_x")
    else:  # one frame has no order of frames to keep, and one task needs no range bounds
        tiles = tiles.repartition(n_tasks)

    def cells(batches):
        gathered, points = [], 0
        for batch in batches:
            for tile in batch.to_pylist():
                for piece in _tile_bands(tile, height, width_px):
                    gathered.append(piece)
                    points += piece[1].size
                    if points >= CELLS_PER_TILE:
                        yield _count_pieces(gathered, max_iter, mode)
                        gathered, points = [], 0
        if gathered:
            yield _count_pieces(gathered, max_iter, mode)

    return tiles.mapInArrow(cells, CELLS)


def _tile_bands(tile, height, width_px):
    """A tile as bands of rows of at most ``CELLS_PER_TILE`` cells: frame, y, x, re, im."""
    re = axis_slice(tile["center_re"], tile["width"], width_px, tile["x0"], tile["x1"])
    x = np.arange(tile["x0"], tile["x1"], dtype=np.int32)
    band = max(1, CELLS_PER_TILE // x.size)
    for top in range(tile["y0"], tile["y1"], band):
        bottom = min(top + band, tile["y1"])
        im = axis_slice(tile["center_im"], tile["width"], height, top, bottom)
        y = np.arange(top, bottom, dtype=np.int32)
        yield tile["frame"], np.repeat(y, x.size), np.tile(x, y.size), np.tile(re, y.size), np.repeat(im, x.size)


def _count_pieces(pieces, max_iter, mode):
    """One kernel call for all gathered bands: small tiles would otherwise each pay for a
    full run of the iteration loop."""
    frames, y, x, re, im = zip(*pieces)
    counts = escape_steps(np.concatenate(re), np.concatenate(im), max_iter, mode)
    frame = np.repeat(np.array(frames, dtype=np.int32), [part.size for part in y])
    return pa.RecordBatch.from_arrays(
        [pa.array(frame), pa.array(np.concatenate(y)), pa.array(np.concatenate(x)), pa.array(counts)],
        schema=_CELL_ARROW)
