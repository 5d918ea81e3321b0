"""Texts of an Arrow batch as bytes, words and hashes in NumPy, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridscale.session import shared_folder

#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends, each row is computed once,
    and a lost executor costs nothing that was finished."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets between them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``size`` bytes."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    row = 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(offsets) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def byte_set(*ranges: tuple[int, int], complement: bool = False) -> np.ndarray:
    """A truth table over byte values from inclusive ranges."""
    member = np.zeros(256, bool)
    for low, high in ranges:
        member[low:high + 1] = True
    return ~member if complement else member


#: Bytes of words ``[^\x20\x09-\x0D]+``; every byte of a longer UTF-8 character belongs to a word.
WORD_BYTES = byte_set((0x20, 0x20), (0x09, 0x0D), complement=True)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of true bytes, cut at the borders of texts."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens, closes = member.copy(), member.copy()
    opens[1:] &= ~member[:-1]
    closes[:-1] &= ~member[1:]
    borders = offsets[(offsets > 0) & (offsets < len(member))]
    opens[borders] = member[borders]
    closes[borders - 1] = member[borders - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        if n <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


class Slices:
    """Hashes of any slices of a byte string from one running sum; equal slices hash equally."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _power(_MULTIPLIER, len(data) + 1)[:-1], out=self.sums[1:])
        self.back = _power(_INVERSE, len(data) + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total += hashes[k:len(hashes) - n + 1 + k] * np.uint64(pow(_MULTIPLIER, 2 * k + 1, 1 << 64))
    return mixed(total)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: What the worker keeps from task to task, and for which work.
_kept: dict = {}


def kept(make: Callable, *args):
    """``make(*args)``, made once in a worker and kept until it turns to other work: workers outlive stages, and what each
    stage left in them would add up."""
    if (make, args) not in _kept:
        _kept[make, args] = make(*args)
    return _kept[make, args]


def over_batches(work: Callable, *args) -> Callable:
    """``work(batch, *args) -> batches`` as the function of an Arrow map."""
    def run(batches):
        name = work.__module__, work.__qualname__
        if _kept.get("work", name) != name:
            _kept.clear()
        _kept["work"] = name
        for one in batches:
            if one.num_rows:
                yield from work(one, *args)
    return run
