"""Cells of a band of rows as one value, and what can be said of them without opening it.

A band is a run of positions ``y * width_px + x`` of one frame. Positions and counts are kept as differences between
neighbours; where many differences in a row are equal, as runs of them. Both are packed into the narrowest integers
that hold them and deflated.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

import numpy as np

#: Bins of a histogram: bin k counts cells of 2^k - 1 to 2^(k+1) - 2 steps; the last one holds 65,535.
HISTOGRAM_BINS = 17

_PACKED = "<BQ"  # kind and number of integers
_WIDTHS = (np.uint8, np.uint16, np.uint32, np.uint64)


class Zone(NamedTuple):
    """Range, number and sums of a band's cells."""

    n_cells: int
    min_iter: int
    max_seen: int
    in_set: int
    last_y: int
    last_x: int
    digest: int
    histogram: list[int]


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers: even ones stand for 0, 1, 2, ... and odd ones for -1, -2, ..."""
    values = values.astype(np.int64)
    folded = ((values << 1) ^ (values >> 63)).astype(np.uint64)
    top = int(folded.max(initial=0))
    kind = next(k for k, w in enumerate(_WIDTHS) if top <= np.iinfo(w).max)
    return struct.pack(_PACKED, kind, len(values)) + folded.astype(_WIDTHS[kind]).tobytes()


def _unpack(data: bytes, at: int) -> tuple[np.ndarray, int]:
    kind, n = struct.unpack_from(_PACKED, data, at)
    at += struct.calcsize(_PACKED)
    folded = np.frombuffer(data, _WIDTHS[kind], n, at).astype(np.uint64)
    return (folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64), at + n * np.dtype(_WIDTHS[kind]).itemsize


def _pack_differences(values: np.ndarray) -> bytes:
    steps = np.diff(values.astype(np.int64), prepend=0)
    heads = np.flatnonzero(np.concatenate([[True], steps[1:] != steps[:-1]])) if len(steps) else np.zeros(0, np.int64)
    if 2 * len(heads) > len(steps):  # hardly anything repeats
        return b"\0" + _pack(steps)
    return b"\1" + _pack(steps[heads]) + _pack(np.diff(np.append(heads, len(steps))))


def _unpack_differences(data: bytes, at: int) -> tuple[np.ndarray, int]:
    in_runs = data[at]
    steps, at = _unpack(data, at + 1)
    if in_runs:
        times, at = _unpack(data, at)
        steps = np.repeat(steps, times)
    return np.cumsum(steps), at


def encode(positions: np.ndarray, counts: np.ndarray) -> bytes:
    """Positions in rising order, each with its count, as one value."""
    return zlib.compress(_pack_differences(positions) + _pack_differences(counts), 1)


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions (64 bits) and counts (32 bits)."""
    whole = zlib.decompress(data)
    positions, at = _unpack_differences(whole, 0)
    counts, _ = _unpack_differences(whole, at)
    return positions, counts.astype(np.int32)


def zone(positions: np.ndarray, counts: np.ndarray, width_px: int, max_iter: int) -> Zone:
    """What is known of a band; ``digest`` depends on its cells and not on their order, and ``in_set`` counts cells at ``max_iter``."""
    counts = counts.astype(np.int64)
    mixed = (positions.astype(np.uint64) << np.uint64(16)) ^ counts.astype(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):  # the published mixing constants of SplitMix64
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    bins = np.frexp(counts + 1.0)[1] - 1
    return Zone(len(counts), int(counts.min()), int(counts.max()), int(np.count_nonzero(counts == max_iter)),
                int(positions.max()) // width_px, int((positions % width_px).max()),
                int(np.bitwise_xor.reduce(mixed).view(np.int64)), np.bincount(bins, minlength=HISTOGRAM_BINS).tolist())
