"""Frames as bands of cells: computed as such, made from cells, and turned back into cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscale.functions.bands import decode, encode, zone
from gridscale.functions.kernels import escape_steps
from gridscale.operators.balance import balanced, band_costs
from gridscale.operators.compute import axis_slice
from gridscale.schema import BANDS, CELLS_PER_BAND, CELLS_PER_TILE, ZONE_COLUMNS, check_max_iter, check_mode
from gridscale.sources.grid import grid_tasks

_BANDS = pa.schema([
    ("frame", pa.int32()), ("band", pa.int32()), ("n_cells", pa.int64()), ("again", pa.int64()), ("min_iter", pa.int32()), ("max_seen", pa.int32()),
    ("in_set", pa.int64()), ("last_y", pa.int32()), ("last_x", pa.int32()), ("digest", pa.int64()), ("histogram", pa.list_(pa.int64())),
    ("cells", pa.binary())])


def band_cells(width_px: int) -> int:
    """Cells of a band: as many whole rows as fit ``CELLS_PER_BAND``, or a part of a row that is longer."""
    return CELLS_PER_BAND if width_px > CELLS_PER_BAND else CELLS_PER_BAND // width_px * width_px


def band_of(width_px: int, y: str = "y", x: str = "x"):
    return F.expr(f"int((bigint({y}) * {width_px} + {x}) div {band_cells(width_px)})")


def _row(frame: int, band: int, positions: np.ndarray, counts: np.ndarray, again: int, width_px: int, max_iter: int, packed: bool) -> dict:
    seen = zone(positions, counts, width_px, max_iter)
    return {"frame": frame, "band": band, "again": again, "cells": encode(positions, counts) if packed else None, **seen._asdict()}


def compute_bands(views: DataFrame, height: int, width_px: int, max_iter: int, mode: str, n_frames: int, by_cost: bool = False) -> DataFrame:
    """Every view of a run as bands with their zones: cells never leave the task that computed them one by one.

    As in ``compute_frames`` only rows of views and bands are shuffled, and small bands share a kernel call. ``by_cost`` tries some
    cells of each band first and deals bands so that all tasks take about as long; that pays off where some frames lie deep in the set."""
    check_max_iter(max_iter)
    check_mode(mode)
    size, plane = band_cells(width_px), height * width_px
    n_tasks = grid_tasks(views.sparkSession, n_frames * plane, max_iter)
    bands = views.select("frame", "center_re", "center_im", "width").withColumn("band", F.explode(F.sequence(F.lit(0), F.lit((plane - 1) // size))))
    if by_cost:
        tried = band_costs(bands.repartition(n_tasks), lambda row, at: _coordinates(row, at, height, width_px),
                           lambda row: (row["band"] * size, min((row["band"] + 1) * size, plane)), max_iter, mode)
        bands = balanced(tried, n_tasks)
    elif n_tasks > 1 and n_frames * plane > size:
        bands = bands.repartitionByRange(n_tasks, "frame", "band")
    else:
        bands = bands.repartition(n_tasks)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, points = [], 0
        for one in batches:
            for row in one.to_pylist():
                at = np.arange(row["band"] * size, min((row["band"] + 1) * size, plane))
                waiting.append((row["frame"], row["band"], at, *_coordinates(row, at, height, width_px)))
                points += at.size
                if points >= CELLS_PER_TILE:
                    yield counted(waiting)
                    waiting, points = [], 0
        if waiting:
            yield counted(waiting)

    def counted(waiting: list) -> pa.RecordBatch:
        counts = escape_steps(np.concatenate([w[3] for w in waiting]), np.concatenate([w[4] for w in waiting]), max_iter, mode)
        rows, start = [], 0
        for frame, band, at, _, _ in waiting:
            rows.append(_row(frame, band, at, counts[start:start + at.size], 0, width_px, max_iter, True))
            start += at.size
        return pa.RecordBatch.from_pylist(rows, _BANDS)

    return bands.mapInArrow(compute, BANDS)


def _coordinates(view: dict, at: np.ndarray, height: int, width_px: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of rising positions of a view."""
    top, bottom = int(at[0]) // width_px, int(at[-1]) // width_px + 1
    re = axis_slice(view["center_re"], view["width"], width_px, 0, width_px)
    im = axis_slice(view["center_im"], view["width"], height, top, bottom)
    if at[-1] - at[0] + 1 > len(at):
        return re[at % width_px], im[at // width_px - top]
    first = int(at[0]) - top * width_px
    return np.tile(re, bottom - top)[first:first + at.size], np.repeat(im, width_px)[first:first + at.size]


def bands_of_cells(cells: DataFrame, width_px: int, max_iter: int, packed: bool = True) -> DataFrame:
    """Cells (frame, y, x, iterations) as bands with their zones, or as zones only.

    Cells are dealt by frame and band, so that a frame holding most of the data is spread; a cell given several times counts once, and
    ``again`` says how often it was given beyond that. A task holds one band at a time."""
    keyed = cells.select("frame", band_of(width_px).alias("band"), F.expr(f"bigint(y) * {width_px} + x").alias("at"), "iterations")
    once = (keyed.repartition("frame", "band").groupBy("frame", "band", "at")
            .agg(F.max("iterations").alias("iterations"), (F.count("*") - 1).alias("again")))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for one in batches:
            if not one.num_rows:
                continue
            whole = one if waiting is None else pa.concat_batches([waiting, one])
            frame, band = whole["frame"].to_numpy(), whole["band"].to_numpy()
            cuts = np.flatnonzero((frame[1:] != frame[:-1]) | (band[1:] != band[:-1])) + 1
            if len(cuts):
                yield packed_rows(whole.slice(0, int(cuts[-1])), np.concatenate([[0], cuts]))
            waiting = whole.slice(int(cuts[-1]) if len(cuts) else 0)
        if waiting is not None:
            yield packed_rows(waiting, np.array([0, waiting.num_rows]))

    def packed_rows(whole: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
        frame, band, at, counts, again = (whole[c].to_numpy() for c in ("frame", "band", "at", "iterations", "again"))
        rows = [_row(int(frame[a]), int(band[a]), at[a:b], counts[a:b], int(again[a:b].sum()), width_px, max_iter, packed)
                for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_pylist(rows, _BANDS)

    return once.sortWithinPartitions("frame", "band", "at").mapInArrow(gather, BANDS)


def cells_of_bands(bands: DataFrame, width_px: int) -> DataFrame:
    """``frame, y, x, iterations`` of every cell of the given bands, and the other columns of ``bands`` but for the zones."""
    more = [f for f in bands.schema.fields if f.name not in ("frame", "band", "cells", "again", *ZONE_COLUMNS)]
    integers = [T.StructField(n, T.IntegerType()) for n in ("frame", "y", "x", "iterations")]

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            frames = one["frame"].to_numpy()
            for row, data in enumerate(one["cells"].to_pylist()):
                at, counts = decode(data)
                y = at // width_px
                columns = [pa.array(np.full(len(at), frames[row], np.int32)), pa.array(y.astype(np.int32)),
                           pa.array((at - y * width_px).astype(np.int32)), pa.array(counts)]
                columns += [pa.repeat(one[f.name][row], len(at)) for f in more]
                yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in integers), *(f.name for f in more)])

    return bands.select("frame", "cells", *(f.name for f in more)).mapInArrow(unfold, T.StructType([*integers, *more]))
