"""Vectors as short codes: each part of a vector is named by the nearest of at most 64 entries of a codebook.

The nearest entry is found by slices. For every dimension of a part the entries' coordinates are sorted, and each place in
that order holds the set of entries before it, as one 64-bit mask. A radius around a point selects a range of each dimension,
whose entries are the difference of two masks; all dimensions' masks ANDed leave the entries in the box. If the nearest of
them is no further than the radius, no entry outside the box is as near; otherwise the point is asked again with the distance found as its
radius, or with twice the radius if its box was empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscale.llm.text import stored

#: Entries of a codebook: the bits of a mask.
MOST_CODES = 64
#: Vectors that are coded at once.
_ROWS = 4096


class SlicedEntries:
    """The entries of one part's codebook, sorted along each dimension."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # (at most 64, dimensions), integers
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        self.before = np.zeros((entries.shape[1], len(entries) + 1), np.uint64)
        self.before[:, 1:] = np.bitwise_or.accumulate(np.uint64(1) << order.astype(np.uint64), axis=0).T
        # Half of the entries have a neighbour within this radius: a box of it holds few of them.
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        apart[np.diag_indices(len(entries))] = np.iinfo(np.int64).max
        self.radius = math.isqrt(int(np.median(apart.min(axis=1)))) // 2 + 1 if len(entries) > 1 else 1

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of entries whose every coordinate is within ``radius`` of the point's."""
        mask = np.full(len(points), ~np.uint64(0))
        for d, (line, before) in enumerate(zip(self.sorted, self.before, strict=True)):
            low = np.searchsorted(line, points[:, d] - radius, side="left")
            high = np.searchsorted(line, points[:, d] + radius, side="right")
            mask &= before[high] & ~before[low]
        return mask

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of each point, the lower of equals, and its squared distance."""
        index, distance = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        todo, radius = np.arange(len(points)), np.full(len(points), self.radius, np.int64)
        while todo.size:
            at, best = self._best(points[todo], self.candidates(points[todo], radius))
            sure = (at >= 0) & (best <= radius * radius)
            index[todo[sure]], distance[todo[sure]] = at[sure], best[sure]
            radius = np.where(at < 0, 2 * radius, _root(best))[~sure]
            todo = todo[~sure]
        return index, distance

    def _best(self, points: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point's mask, from its lowest bit on; -1 and no distance without any."""
        at, best = np.full(len(points), -1, np.int64), np.full(len(points), np.iinfo(np.int64).max)
        live = np.flatnonzero(mask)
        while live.size:
            left = mask[live]
            lowest = left & (~left + np.uint64(1))
            entry = np.frexp(lowest.astype(np.float64))[1].astype(np.int64) - 1  # exact for powers of two
            away = ((points[live] - self.entries[entry]) ** 2).sum(axis=1)
            nearer = away < best[live]
            at[live[nearer]], best[live[nearer]] = entry[nearer], away[nearer]
            mask[live] = left ^ lowest
            live = live[mask[live] != 0]
        return at, best


def _root(squares: np.ndarray) -> np.ndarray:
    """The least integers whose squares reach ``squares``."""
    root = np.sqrt(np.minimum(squares, 1 << 62).astype(np.float64)).astype(np.int64)
    root -= root * root >= squares
    root += root * root < squares
    return root + (root * root < squares)


class Codes(NamedTuple):
    """``codes`` (vec_id, label, code, error) of all kept vectors, and the codebooks (parts, entries, dimensions)."""

    codes: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def largest_component(dims: int) -> int:
    """Components are held within this bound, so that no sum of squares of a vector of ``dims`` leaves 64 bits."""
    return math.isqrt((1 << 62) // dims) // 2


def _integer_vectors(given: pa.RecordBatch, parts: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``floor(256 * x)`` of all components of the vectors that can be coded."""
    vectors = given["vector"]
    lengths = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int64)
    values = vectors.flatten() if not vectors.null_count else None
    if values is None:  # a null's slots are not part of the flattened values
        lengths = np.where(np.asarray(vectors.is_null()), 0, lengths)
        values = vectors.flatten()
    numbers = np.array(values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    good = np.isfinite(numbers)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    bad = np.concatenate([[0], np.cumsum(~good)])
    kept = np.flatnonzero((lengths > 0) & (lengths % parts == 0) & (bad[ends] == bad[starts]))
    for dims in np.unique(lengths[kept]):
        rows = kept[lengths[kept] == dims]
        bound = float(largest_component(int(dims)))
        whole = np.clip(np.floor(256 * numbers[starts[rows][:, None] + np.arange(dims)]), -bound, bound).astype(np.int32)
        at = pa.array(rows)
        cells = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * int(dims), pa.int32()), pa.array(whole.ravel()))
        yield pa.RecordBatch.from_arrays([given["vec_id"].take(at), given["label"].take(at), cells], schema=schema)


def _points(given: pa.RecordBatch) -> np.ndarray:
    cells = given["cells"]
    return cells.flatten().to_numpy().reshape(len(cells), -1).astype(np.int64)


def _part_sums(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One task's vectors as a count and a sum of components for every entry that is nearest to some."""
    parts, codes, width = codebooks.shape
    slices = [SlicedEntries(book) for book in codebooks]
    n, sums = np.zeros((parts, codes), np.int64), np.zeros((parts, codes, width), np.int64)
    for given in batches:
        for first in range(0, given.num_rows, _ROWS):
            points = _points(given.slice(first, _ROWS))
            for p, index in enumerate(slices):
                own = points[:, p * width:(p + 1) * width]
                at, _ = index.nearest(own)
                n[p] += np.bincount(at, minlength=codes)
                np.add.at(sums[p], at, own)
    p, e = np.nonzero(n)
    if len(p):
        yield pa.RecordBatch.from_pydict({
            "part": np.repeat(p, width), "entry": np.repeat(e, width), "place": np.tile(np.arange(width), len(p)),
            "n": np.repeat(n[p, e], width), "total": sums[p, e].ravel()})


def _codes(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = codebooks.shape[2]
    slices = [SlicedEntries(book) for book in codebooks]
    for whole in batches:
        for first in range(0, whole.num_rows, _ROWS):
            given = whole.slice(first, _ROWS)
            points = _points(given)
            code, error = np.zeros((len(points), len(slices)), np.uint8), np.zeros(len(points), np.int64)
            for p, index in enumerate(slices):
                code[:, p], away = index.nearest(points[:, p * width:(p + 1) * width])
                error += away
            hexed = [row.tobytes().hex() for row in code]
            yield pa.RecordBatch.from_pydict({
                "vec_id": given["vec_id"], "label": given["label"], "code": pa.array(hexed, pa.string()), "error": pa.array(error)})


def vector_codes(embeddings: DataFrame, parts: int = 16, n_codes: int = MOST_CODES, rounds: int = 2, vector: str = "embedding") -> Codes:
    """Codes of all vectors that can be coded, and the codebooks that ``rounds`` passes over all of them left.

    A component x counts as floor(256 * x); a vector is cut into ``parts`` equal parts. Codebooks start as the parts of the ``n_codes``
    vectors that come first by id (nulls last, equal ids by components). A round assigns every part to its nearest entry and
    moves each entry that has parts to the floor of their mean. Vectors that are null, empty, hold a null, NaN or infinity,
    or cannot be cut into equal parts are dropped, and so are those of another length than the first one's. Components beyond
    ``largest_component`` are held at that bound, so that no error leaves 64 bits. Repeated rows are coded
    each; columns other than vec_id, label and the vector are not looked at. An empty table has no codes and empty codebooks.
    """
    if not 1 <= n_codes <= MOST_CODES or parts < 1:
        raise ValueError(f"a codebook has 1 to {MOST_CODES} entries, and a vector at least one part")
    given = embeddings.select("vec_id", "label", F.col(vector).cast("array<double>").alias("vector"))
    cell_type = T.StructType([given.schema["vec_id"], given.schema["label"], T.StructField("cells", T.ArrayType(T.IntegerType()))])
    code_type = T.StructType([*cell_type.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def read(batches):
        for one in batches:
            if one.num_rows:
                ids = [one.schema.field("vec_id"), one.schema.field("label"), pa.field("cells", pa.list_(pa.int32()))]
                yield from _integer_vectors(one, parts, pa.schema(ids))

    cells = stored(given.mapInArrow(read, cell_type))
    order = [F.col("vec_id").asc_nulls_last(), F.col("cells").asc()]
    head = cells.orderBy(*order).select(F.size("cells").alias("dims")).first()
    if head is None:
        return Codes(cells.sparkSession.createDataFrame([], code_type), np.zeros((parts, 0, 0), np.int64))
    cells = cells.where(F.size("cells") == head["dims"])
    start = np.array([r["cells"] for r in cells.orderBy(*order).limit(n_codes).collect()], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = cells.select("cells").mapInArrow(lambda batches, books=books: _part_sums(batches, books),
                                                "part LONG, entry LONG, place LONG, n LONG, total LONG")
        books = books.copy()
        # As many rows as the codebooks have components, however many vectors there are.
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return Codes(cells.mapInArrow(lambda batches: _codes(batches, books), code_type), books)


def code_digests(embeddings: DataFrame, parts: int = 16, n_codes: int = MOST_CODES, rounds: int = 2) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector; null labels are one label."""
    coded = vector_codes(embeddings, parts, n_codes, rounds)
    codes = stored(coded.codes)
    # Written first, so that Spark sees their size: few labels are broadcast, many are joined by shuffle.
    totals = stored(codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")))
    return codes.join(totals, codes["label"].eqNullSafe(totals["of_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))
