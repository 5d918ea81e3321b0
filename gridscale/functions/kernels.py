"""Escape counts per cell: NumPy inside Arrow tasks, plus native column forms.

The arithmetic is real-valued on purpose: NumPy's complex multiply is not bit-equal
to the scalar loop that defines the count, real multiply/add is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gridscale.schema import CELL_MAX, CELL_MIN, CELLS_PER_TILE, check_max_iter, check_mode


_CACHE_POINTS = 8192
_LONGEST_INTERVAL = 120  # survived steps of an interval are counted in a byte; many cycle lengths divide it


def _closed_form_members(re, im):
    """True where the cardioid or period-2 disc already proves membership (strict edges)."""
    quarter = re - re.dtype.type(0.25)
    im2 = im * im
    q = quarter * quarter + im2
    cardioid = q * (q + quarter) < re.dtype.type(0.25) * im2
    left = re + re.dtype.type(1.0)
    return cardioid | (left * left + im2 < re.dtype.type(0.0625))


def _iterate(re, im, max_iter, find_cycles=False):
    """Steps survived by every point, at most ``max_iter``.

    The live set is compacted at growing intervals rather than at every step: between
    two compactions an escaped point keeps iterating, but its flag stays False (an
    escaped orbit only grows, and overflow to inf/NaN compares False too), so the
    number of True flags is the escape step. Within an interval the live set is walked
    in pieces that stay in the CPU cache.

    ``find_cycles`` looks for orbits that repeat (Brent): from the first interval of full length on, the orbit points of
    all live points are remembered after 1, 2, 4, ... intervals, and each later interval's points are held against them. Only
    points equal in every bit that counts are a cycle, and a cycle of these numbers never escapes, so no count changes.
    """
    out = np.full(re.shape[0], max_iter, dtype=np.int32)
    where = np.arange(re.shape[0])
    cr, ci = re, im
    zr, zi = re.copy(), im.copy()
    seen_r = seen_i = None
    waited, patience = 0, 1
    inside = np.empty(re.shape[0], dtype=bool)
    scratch = np.empty((3, _CACHE_POINTS), dtype=re.dtype)
    step, interval = 0, 1
    while step < max_iter and where.size:
        stop = min(step + interval, max_iter)
        survived = np.zeros(where.size, dtype=np.uint8)
        for start in range(0, where.size, _CACHE_POINTS):
            piece = slice(start, min(start + _CACHE_POINTS, where.size))
            _advance(zr[piece], zi[piece], cr[piece], ci[piece], inside[piece], survived[piece],
                     scratch[:, :piece.stop - piece.start], stop - step)
        inside = inside[:where.size]
        live = inside
        if not inside.all():
            gone = ~inside
            out[where[gone]] = survived[gone] + np.int32(step)
        if seen_r is not None:
            live = inside & ~((zr == seen_r) & (zi == seen_i))
        if not live.all():
            where, cr, ci = where[live], cr[live], ci[live]
            zr, zi = zr[live], zi[live]
            if seen_r is not None:
                seen_r, seen_i = seen_r[live], seen_i[live]
        if find_cycles and interval == _LONGEST_INTERVAL:
            waited += 1
            if waited == patience:
                seen_r, seen_i = zr.copy(), zi.copy()
                waited, patience = 0, 2 * patience
        step = stop
        interval = min(step // 4 + 1, _LONGEST_INTERVAL)
    return out


def _advance(zr, zi, cr, ci, inside, survived, scratch, steps):
    """Test and update one cache-sized piece ``steps`` times, in place."""
    zr2, zi2, norm = scratch
    flags = inside.view(np.uint8)
    four = zr.dtype.type(4.0)
    for _ in range(steps):
        np.square(zr, out=zr2)
        np.square(zi, out=zi2)
        np.add(zr2, zi2, out=norm)
        np.less_equal(norm, four, out=inside)
        np.add(survived, flags, out=survived)
        np.multiply(zr, zi, out=zi)
        np.add(zi, zi, out=zi)
        np.add(zi, ci, out=zi)
        np.subtract(zr2, zi2, out=zr)
        np.add(zr, cr, out=zr)


def escape_steps(re, im, max_iter: int, mode: str = "early_exit"):
    """Escape counts of the points ``re + i*im`` as int32; ``max_iter`` means "in the set"."""
    dtype = np.float32 if mode == "float32" else np.float64
    re = np.ascontiguousarray(re, dtype=dtype)
    im = np.ascontiguousarray(im, dtype=dtype)
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        if mode == "exact":
            out = _iterate(re, im, max_iter)
        else:
            todo = ~_closed_form_members(re, im)
            out = np.full(re.shape[0], max_iter, dtype=np.int32)
            out[todo] = _iterate(re[todo], im[todo], max_iter, find_cycles=True)
    undefined = np.isnan(re) | np.isnan(im)
    if undefined.any():  # a NaN orbit never tests as escaped
        out[undefined] = max_iter
    return out


#: About the step by which an orbit in the set has repeated and is left.
_CYCLE_STEPS = 1500


def step_costs(re, im, max_iter: int, mode: str = "early_exit"):
    """About how many steps the kernel takes for each point: none where a closed form decides, few where an orbit repeats."""
    counts = escape_steps(re, im, max_iter, mode).astype(np.float64)
    if mode == "exact":
        return counts
    inside = counts >= max_iter
    closed = _closed_form_members(np.asarray(re, np.float64), np.asarray(im, np.float64))
    return np.where(closed, 0.0, np.where(inside, min(max_iter, _CYCLE_STEPS), counts))


def escape_count(re, im, max_iter: int, mode: str = "early_exit") -> Column:
    """Escape count as a column over any two numeric columns; NULL in, NULL out.

    A scalar Arrow function ships only the two coordinates to Python, so column
    pruning and filters on other columns still reach the scan. Input batches are
    gathered up to ``CELLS_PER_TILE`` points, because the cost of an iteration over
    the few points that stay inside is one NumPy call, however many they are.
    """
    check_max_iter(max_iter)
    check_mode(mode)

    @F.arrow_udf("int")
    def _count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        waiting, points = [], 0
        for re, im in batches:
            waiting.append((re, im))
            points += len(re)
            if points >= CELLS_PER_TILE:
                yield from _count_together(waiting, max_iter, mode)
                waiting, points = [], 0
        if waiting:
            yield from _count_together(waiting, max_iter, mode)

    return _count(_as_double(re), _as_double(im))


def _count_together(batches, max_iter, mode):
    """One kernel call for several Arrow batches, handed back batch by batch."""
    re = np.concatenate([b[0].to_numpy(zero_copy_only=False) for b in batches])
    im = np.concatenate([b[1].to_numpy(zero_copy_only=False) for b in batches])
    missing = np.concatenate([np.asarray(b[0].is_null()) | np.asarray(b[1].is_null()) for b in batches])
    counts = pa.array(escape_steps(re, im, max_iter, mode), mask=missing)
    start = 0
    for b in batches:
        yield counts.slice(start, len(b[0]))
        start += len(b[0])


def escape_count_native(re, im, max_iter: int) -> Column:
    """The exact count without Python, as a higher-order fold. It cannot stop early and
    is evaluated interpreted, so it is a cross-check for ``escape_count``, not a fast path."""
    check_max_iter(max_iter)
    re, im = _as_double(re), _as_double(im)
    start = F.struct(F.lit(0.0).alias("zr"), F.lit(0.0).alias("zi"),
                     F.lit(None).cast("int").alias("k"))

    def advance(acc, step):
        zr, zi = acc["zr"], acc["zi"]
        nr = zr * zr - zi * zi + re
        ni = F.lit(2.0) * zr * zi + im
        hit = nr * nr + ni * ni > 4.0
        nk = F.when(acc["k"].isNotNull(), acc["k"]).when(hit, step)
        settled = acc["k"].isNotNull() | hit
        return F.struct(F.when(settled, zr).otherwise(nr).alias("zr"),
                        F.when(settled, zi).otherwise(ni).alias("zi"),
                        nk.alias("k"))

    steps = F.sequence(F.lit(0), F.lit(max_iter - 1))
    folded = F.aggregate(steps, start, advance, lambda acc: F.coalesce(acc["k"], F.lit(max_iter)))
    return F.when(re.isNotNull() & im.isNotNull(), folded)


def membership_class(re, im) -> Column:
    """``cardioid``, ``period2`` or ``iterate``: what the closed forms say about a point."""
    re, im = _as_double(re), _as_double(im)
    quarter = re - 0.25
    q = quarter * quarter + im * im
    left = re + 1.0
    return (F.when(q * (q + quarter) < F.lit(0.25) * im * im, "cardioid")
            .when(left * left + im * im < 0.0625, "period2")
            .otherwise("iterate"))


def to_cell(value) -> Column:
    """Cast a count to the cell type; a value outside 0..65535 is an error, never a wrap."""
    col = F.col(value) if isinstance(value, str) else value
    return (F.when(col.between(CELL_MIN, CELL_MAX), col.cast("int"))
            .when(col.isNotNull(),
                  F.raise_error(F.concat(F.lit("cell value outside 0..65535: "), col.cast("string")))))


def is_cell(value) -> Column:
    """Whether a value fits the cell type, for filtering instead of failing."""
    col = F.col(value) if isinstance(value, str) else value
    return F.coalesce(col.between(CELL_MIN, CELL_MAX), F.lit(False))


def _as_double(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")
