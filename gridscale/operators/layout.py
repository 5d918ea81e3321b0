"""Tiles along a space-filling curve: a window of tiles over many frames is a few ranges of one key."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscale.operators.render import TILES

#: Bits of a tile's row and column; a frame has all of its 31, those beyond these stand before all others.
TILE_BITS = 16
#: Ranges of keys that a window is read by. More ranges skip more tiles beside the window and make a longer filter.
MAX_RANGES = 24

_LAYOUT = T.StructType([*(f for f in TILES.fields if f.name not in ("run_id", "z")), T.StructField("key", T.LongType()),
                        T.StructField("run_id", T.StringType()), T.StructField("z", T.IntegerType())])

# Shifts and masks that put two empty bits between neighbouring bits of a number.
_SPREAD = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))


def _spread(value: Column) -> Column:
    value = value.cast("bigint")
    for shift, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def tile_key(frame: str = "frame", tile_y: str = "tile_y", tile_x: str = "tile_x") -> Column:
    """Morton key of a tile: the bits of frame, row and column in turn. A tile beyond the key's bits fails the job."""
    side = (1 << TILE_BITS) - 1
    inside = (F.col(frame) >= 0) & F.col(tile_y).between(0, side) & F.col(tile_x).between(0, side)
    high = F.shiftleft(F.shiftright(F.col(frame).cast("bigint"), TILE_BITS), 3 * TILE_BITS)
    low = (F.shiftleft(_spread(F.col(frame).bitwiseAND(F.lit(side))), 2)
           .bitwiseOR(F.shiftleft(_spread(F.col(tile_y)), 1)).bitwiseOR(_spread(F.col(tile_x))))
    return F.when(inside, high.bitwiseOR(low)).otherwise(F.raise_error(F.lit("tile outside the key's bits")).cast("bigint"))


def _key(corner: tuple[int, int, int]) -> int:
    frame, y, x = corner
    key = frame >> TILE_BITS << 3 * TILE_BITS
    for bit in range(TILE_BITS):
        key |= (x >> bit & 1) << 3 * bit | (y >> bit & 1) << 3 * bit + 1 | (frame >> bit & 1) << 3 * bit + 2
    return key


def key_ranges(frames: tuple[int, int], rows: tuple[int, int], columns: tuple[int, int], max_ranges: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``max_ranges`` ranges of keys, ends included, that together hold all keys of a window.

    Each range goes from the smallest to the largest key of a part of the window. The part whose range has most keys outside the
    window is halved at the highest bit in which its corners differ, until nothing is outside or the number is reached."""
    if any(a > b for a, b in (frames, rows, columns)):
        return []

    def part(low, high):
        first, last = _key(low), _key(high)
        inside = (high[0] - low[0] + 1) * (high[1] - low[1] + 1) * (high[2] - low[2] + 1)
        return inside - (last - first + 1), first, last, low, high

    parts = [part(*zip(frames, rows, columns))]
    while parts[0][0] < 0 and len(parts) < max_ranges:
        _, first, last, low, high = heapq.heappop(parts)
        top = (first ^ last).bit_length() - 1
        dimension, bit = (0, top - 2 * TILE_BITS) if top >= 3 * TILE_BITS else (2 - top % 3, top // 3)
        cut = high[dimension] >> bit << bit
        below, above = list(high), list(low)
        below[dimension], above[dimension] = cut - 1, cut
        heapq.heappush(parts, part(low, tuple(below)))
        heapq.heappush(parts, part(tuple(above), high))
    merged: list[tuple[int, int]] = []
    for first, last in sorted(p[1:3] for p in parts):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = merged[-1][0], max(last, merged[-1][1])
        else:
            merged.append((first, last))
    return merged


def write_tile_layout(tiles: DataFrame, path: str, row_group_bytes: int = 8 << 20) -> None:
    """Tiles of any runs and levels, in the order of the curve: dealt to tasks by ranges of it and sorted within files, so that
    each row group is a stretch of the curve. A tile holds at most ``tile_size`` squared cells, so no key outgrows a task."""
    keyed = tiles.withColumn("key", tile_key())
    (keyed.repartitionByRange("run_id", "z", "key").sortWithinPartitions("run_id", "z", "key", "y", "x")
     .select(*_LAYOUT.names).write.partitionBy("run_id", "z").option("parquet.block.size", row_group_bytes).mode("errorifexists").parquet(path))


def tile_window(spark: SparkSession, path: str, run_id: str, z: int, frames: tuple[int, int], rows: tuple[int, int],
                columns: tuple[int, int], max_ranges: int = MAX_RANGES) -> DataFrame:
    """Cells of the tiles of a level within ranges of frames, tile rows and tile columns, ends included.

    Ranges of keys reach the scan as filters, which opens the row groups that touch one of them: at most those of
    the ranges and one more at each end, however many frames and tiles the level has."""
    sides = [(max(a, 0), min(b, top)) for (a, b), top in zip((frames, rows, columns), ((1 << 31) - 1, *[(1 << TILE_BITS) - 1] * 2))]
    wanted = F.lit(False)
    for first, last in key_ranges(*sides, max_ranges):
        wanted = wanted | F.col("key").between(first, last)
    level = spark.read.schema(_LAYOUT).parquet(path).filter((F.col("run_id") == run_id) & (F.col("z") == z))
    for name, (a, b) in zip(("frame", "tile_y", "tile_x"), sides):
        wanted = wanted & F.col(name).between(a, b)
    return level.filter(wanted).select(*TILES.names)
