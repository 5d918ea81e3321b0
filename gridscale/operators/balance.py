"""Bands dealt to tasks by what they are going to cost."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscale.functions.kernels import step_costs
from gridscale.session import settled

#: Cells of a band that are tried to tell its cost.
TRIED = 64
#: A band above this part of a task's fair share is placed by name; there are at most so many times as many of them as tasks.
HEAVY_PARTS = 16
#: What a cell costs besides its steps: coordinates, packing.
PER_CELL = 4.0


def band_costs(bands: DataFrame, coordinates, cells_in, max_iter: int, mode: str) -> DataFrame:
    """``bands`` with ``cost``: the steps of ``TRIED`` cells spread over each band, scaled to all its cells.

    ``coordinates(row, positions)`` gives points of a band, ``cells_in(row)`` its first position and the one behind its last."""
    schema = T.StructType([*bands.schema.fields, T.StructField("cost", T.DoubleType())])

    def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            rows = one.to_pylist()
            if not rows:
                continue
            spans = [cells_in(row) for row in rows]
            tried = [np.unique(np.linspace(a, b - 1, min(TRIED, b - a)).astype(np.int64)) for a, b in spans]
            points = [coordinates(row, at) for row, at in zip(rows, tried)]
            steps = step_costs(np.concatenate([p[0] for p in points]), np.concatenate([p[1] for p in points]), max_iter, mode)
            edges = np.cumsum([0, *map(len, tried)])
            means = np.add.reduceat(steps, edges[:-1]) / np.diff(edges)
            cost = [(m + PER_CELL) * (b - a) for m, (a, b) in zip(means, spans)]
            yield pa.RecordBatch.from_arrays([*one.columns, pa.array(cost, pa.float64())], names=[*one.schema.names, "cost"])

    return bands.mapInArrow(attempt, schema)


def balanced(costed: DataFrame, n_tasks: int) -> DataFrame:
    """``costed`` (frame, band, cost, ...) in ``n_tasks`` partitions of about equal cost, as ``task``.

    Heavy bands are few: each is above a sixteenth of a fair share, so there are at most sixteen for each task. They are placed one by
    one, the costliest first, on the task with the least so far. All others fill up what is left: a hash of a band's name picks its task, in proportion to
    the room that the tasks have. Nothing but the heavy bands' names comes to the driver.
    """
    costed = settled(costed)
    whole = costed.agg(F.coalesce(F.sum("cost"), F.lit(0.0))).first()[0]
    fair = max(whole / n_tasks, 1e-9)
    heavy = costed.where(F.col("cost") > fair / HEAVY_PARTS).select("frame", "band", "cost").collect()
    loads = [(0.0, t) for t in range(n_tasks)]
    placed = {}
    for row in sorted(heavy, key=lambda r: (-r["cost"], r["frame"], r["band"])):
        load, task = heapq.heappop(loads)
        placed[row["frame"], row["band"]] = task
        heapq.heappush(loads, (load + row["cost"], task))
    room = np.zeros(n_tasks)
    for load, task in loads:
        room[task] = max(fair - load, 0.0)
    edges = np.cumsum(room) if room.sum() > 0 else np.arange(1, n_tasks + 1.0)
    schema = T.StructType([*costed.schema.fields, T.StructField("at", T.LongType()), T.StructField("task", T.IntegerType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            spread = one["at"].to_numpy() / float(1 << 40) * edges[-1]
            task = np.minimum(np.searchsorted(edges, spread, side="right"), n_tasks - 1).astype(np.int32)
            names = zip(one["frame"].to_pylist(), one["band"].to_pylist())
            task = np.array([placed.get(name, t) for name, t in zip(names, task.tolist())], np.int32)
            yield pa.RecordBatch.from_arrays([*one.columns, pa.array(task)], names=[*one.schema.names, "task"])

    named = costed.withColumn("at", F.pmod(F.xxhash64("frame", "band"), F.lit(1 << 40)))
    return named.mapInArrow(deal, schema).drop("at").repartitionById(n_tasks, F.col("task"))
