"""Lines that many documents share: sorted hashes are streamed once, and what is left of a document is a bitmap.

Keys of lines are hashed where the text lies. The hashes are partitioned by range and sorted by hash, document and
position, so that a key's documents are read one after the other and a key that a third of all documents share is cut
into as many ranges as its size asks for. A task settles every key that it has whole. Of a key at the edge of its range it
reports the number of documents, at most two keys a task, and hands back fewer entries of it than ``least_documents``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscale.llm.text import LOWER, WORD_BYTES, Slices, batch, pieces, stored

KEEP = ("none", "first")


def _row(docs: DataFrame) -> DataFrame:
    """Id and text with ``uid``, which with the id tells rows apart; rows equal in both share it and what becomes of them."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("uid", F.xxhash64("doc_id", "text"))


def _line_entries(given: pa.RecordBatch, least_points: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per document and key the lines that have it, and per document, without a key, the number of its lines."""
    for row, end, data, offsets in pieces(given["text"]):
        ends_line = np.flatnonzero(data == 0x0A)
        filled = offsets[1:]  # the end of a text ends its last line
        stops = np.concatenate([ends_line, filled])
        doc = np.concatenate([np.searchsorted(offsets, ends_line, side="right") - 1, np.arange(end - row)])
        order = np.lexsort((np.concatenate([np.zeros(len(ends_line), bool), np.ones(end - row, bool)]), stops, doc))
        stops, doc = stops[order], doc[order]
        first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
        starts = np.where(first, offsets[doc], np.concatenate([[0], stops[:-1] + 1]))
        n_lines = np.bincount(doc, minlength=end - row)
        position = np.arange(len(doc)) - np.concatenate([[0], np.cumsum(n_lines)[:-1]])[doc]

        solid = np.flatnonzero(WORD_BYTES[data])
        low, high = np.searchsorted(solid, starts), np.searchsorted(solid, stops)
        some = high > low
        begin, stop = solid[low[some]], solid[high[some] - 1] + 1
        doc, position = doc[some], position[some]
        if least_points > 1:
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            long = points[stop] - points[begin] >= least_points
            begin, stop, doc, position = begin[long], stop[long], doc[long], position[long]
        hashes = Slices(LOWER[data]).hashes(begin, stop).view(np.int64)
        order = np.lexsort((position, hashes, doc))
        hashes, doc, position = hashes[order], doc[order], position[order]
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]) if len(doc) else np.zeros(0, bool)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([np.flatnonzero(new), [len(doc)]]), pa.int32()), pa.array(position, pa.int32()))
        at = pa.array(doc[new] + row)
        yield batch(schema, pa.array(hashes[new]), given["doc_id"].take(at), given["uid"].take(at), lists, pa.nulls(len(at), pa.int64()), at.cast(pa.int32()))
        whole = pa.array(np.arange(row, end))
        yield batch(schema, pa.nulls(end - row, pa.int64()), given["doc_id"].take(whole), given["uid"].take(whole),
                    pa.nulls(end - row, pa.list_(pa.int32())), pa.array(n_lines, pa.int64()), whole.cast(pa.int32()))


def _settled_runs(batches: Iterator[pa.RecordBatch], least: int, keep_first: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One sorted range of entries. Three kinds of rows leave: lines that go (no hash), entries whose key is at an edge of
    the range (hash, no n), and the keys at the edges themselves (hash and n, with the first document)."""
    waiting, seen, lead, opening = None, 0, None, True  # the last run: rows held back, rows let go, its first row

    def rows(some: pa.RecordBatch, lines: pa.Array, hashed: bool) -> pa.RecordBatch:
        n = some.num_rows
        return batch(schema, some["hash"] if hashed else pa.nulls(n, pa.int64()), some["doc_id"], some["uid"], lines, pa.nulls(n, pa.int64()))

    def edge(n: int) -> pa.RecordBatch:
        return batch(schema, lead["hash"], lead["doc_id"], lead["uid"], pa.nulls(1, pa.list_(pa.int32())), pa.array([n], pa.int64()))

    for given in batches:
        if not given.num_rows:
            continue
        if waiting is not None and waiting.num_rows:
            given = pa.concat_batches([waiting, given])
        hashes = given["hash"].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(hashes[1:] != hashes[:-1]) + 1])
        ends = np.append(starts[1:], len(hashes))
        n = ends - starts
        leads = given["uid"].to_numpy()[starts]
        if lead is not None and lead["hash"][0].as_py() == hashes[0]:
            n[0] += seen
            leads[0] = lead["uid"][0].as_py()
        elif lead is not None:  # the last run was let go whole, and ended with its batch
            if opening:
                yield edge(seen)
            opening, lead = False, None
        if lead is None:
            lead = given.slice(0, 1)
        run = np.repeat(np.arange(len(n)), ends - starts)
        common = n >= least
        gone = common[run]
        if keep_first:
            heads = given["uid"].to_numpy() == leads[run]
            rest = given.filter(pa.array(gone & ~heads))
            yield rows(rest, rest["lines"], False)
            unsure = gone & heads & (opening & (run == 0))  # a range before this one may have the first document
            some = given.filter(pa.array(unsure))
            yield rows(some, some["lines"], True)
            some = given.filter(pa.array(gone & heads & ~unsure))
            yield rows(some, pc.list_slice(some["lines"], 1), False)
        else:
            some = given.filter(pa.array(gone))
            yield rows(some, some["lines"], False)
        if len(n) > 1:
            if opening:
                if not common[0]:
                    some = given.slice(0, int(ends[0]))
                    yield rows(some, some["lines"], True)
                yield edge(int(n[0]))
            opening, lead = False, given.slice(int(starts[-1]), 1)
        waiting = given.slice(given.num_rows, 0) if common[-1] else given.slice(int(starts[-1]))
        seen = int(n[-1]) if common[-1] else 0
    if lead is not None:
        if waiting.num_rows:
            yield rows(waiting, waiting["lines"], True)
        yield edge(seen + waiting.num_rows)


@F.arrow_udf(T.BinaryType())
def _bitmap(n_lines: pa.Array, lines: pa.Array) -> pa.Array:
    """A bit for each line, set if it stays, the first line in the lowest bit of the first byte; deflated."""
    out = []
    for n, gone in zip(n_lines.to_pylist(), lines.to_pylist(), strict=True):
        keep = np.ones(n, bool)
        keep[gone] = False
        out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
    return pa.array(out, pa.binary())


def bitmap_lines(keep: bytes, n_lines: int) -> np.ndarray:
    """The bits of a bitmap as truth values, one for each line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines, bitorder="little").astype(bool)


def line_keeps(docs: DataFrame, least_documents: int = 10, least_points: int = 1, keep: str = "none") -> DataFrame:
    """(doc_id, uid, n_lines, n_dropped, keep): which lines of every document stay, as a deflated bitmap.

    A text is split at line feeds; null and empty texts have one empty line. A line's key is the line without white space at
    both ends, in lower case (ASCII). Keys of ``least_points`` code points or more that ``least_documents`` documents have lose
    all their lines (``keep="none"``), or all but the first one of the first document in order of id and uid (``"first"``).
    Every row is a document, so repeated rows count each; rows equal in id and text share one row of the result. Other columns of
    ``docs`` are not looked at; an empty table has an empty result.
    """
    if keep not in KEEP:
        raise ValueError(f"keep is one of {KEEP}")
    if least_documents < 1 or least_points < 1:
        raise ValueError("least_documents and least_points are at least 1")
    given = _row(docs)
    kind = given.schema["doc_id"]
    fields = [T.StructField("hash", T.LongType()), T.StructField("doc_id", kind.dataType), T.StructField("uid", T.LongType()),
              T.StructField("lines", T.ArrayType(T.IntegerType()))]
    entry_type = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("row", T.IntegerType())])
    found_type = T.StructType([*fields, T.StructField("n", T.LongType())])

    def read(batches):
        for one in batches:
            if one.num_rows:
                yield from _line_entries(one, least_points, _arrow(one, "n_lines", "row"))

    def settle(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is not None:
            yield from _settled_runs(chain([head], batches), least_documents, keep == "first", _arrow(head, "n"))

    entries = stored(given.mapInArrow(read, entry_type))
    # Repeated rows have equal keys; their place in a batch lets the ranges cut them apart too.
    sorted_entries = (entries.where("hash IS NOT NULL").select("hash", "doc_id", "uid", "lines", "row")
                      .repartitionByRange("hash", "doc_id", "uid", "row").sortWithinPartitions("hash", "doc_id", "uid"))
    found = stored(sorted_entries.drop("row").mapInArrow(settle, found_type))
    edges = found.where("n IS NOT NULL").groupBy("hash").agg(F.sum("n").alias("total"), F.min(F.struct("doc_id", "uid"))["uid"].alias("lead"))
    # Two keys a task at most, whatever the size of the input.
    unsure = found.where("n IS NULL AND hash IS NOT NULL").join(F.broadcast(edges), "hash").where(F.col("total") >= least_documents)
    rest = F.expr("slice(lines, 2, greatest(size(lines) - 1, 0))")
    gone = F.when(F.col("uid") == F.col("lead"), rest).otherwise(F.col("lines")) if keep == "first" else F.col("lines")
    dropped = found.where("hash IS NULL").select("doc_id", "uid", "lines").unionByName(unsure.select("doc_id", "uid", gone.alias("lines")))
    known = entries.where("hash IS NULL").select("doc_id", "uid", "n_lines", F.lit(None).cast("array<int>").alias("lines"))
    both = known.unionByName(dropped.withColumn("n_lines", F.lit(None).cast("long")))
    joined = both.groupBy("doc_id", "uid").agg(F.max("n_lines").alias("n_lines"), F.flatten(F.collect_set("lines")).alias("lines"))
    return joined.select("doc_id", "uid", "n_lines", F.size("lines").cast("long").alias("n_dropped"), _bitmap("n_lines", "lines").alias("keep"))


def _arrow(given: pa.RecordBatch, *more: str) -> pa.Schema:
    kinds = {"n_lines": pa.int64(), "n": pa.int64(), "row": pa.int32()}
    return pa.schema([("hash", pa.int64()), ("doc_id", given.schema.field("doc_id").type), ("uid", pa.int64()), ("lines", pa.list_(pa.int32())),
                      *((name, kinds[name]) for name in more)])


@F.arrow_udf(T.StringType())
def _kept_text(text: pa.Array, keep: pa.Array) -> pa.Array:
    out = []
    for whole, bits in zip(text.to_pylist(), keep.to_pylist(), strict=True):
        if bits is not None:
            lines = (whole or "").split("\n")
            whole = "\n".join(line for line, stays in zip(lines, bitmap_lines(bits, len(lines)), strict=True) if stays)
        out.append(whole or "")
    return pa.array(out, pa.string())


def without_lines(docs: DataFrame, keeps: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row of ``docs`` after the bitmaps of ``line_keeps``; null texts read as empty."""
    named = keeps.select(F.col("doc_id").alias("kept_id"), F.col("uid").alias("kept_uid"), "n_lines", "n_dropped", "keep")
    given = _row(docs)
    joined = given.join(named, given["doc_id"].eqNullSafe(named["kept_id"]) & (given["uid"] == named["kept_uid"]), "left")
    bits = F.when(F.col("n_dropped") > 0, F.col("keep"))
    return joined.select("doc_id", _kept_text("text", bits).alias("text"), "n_lines", "n_dropped")


def line_digests(docs: DataFrame, least_documents: int = 10, least_points: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    kept = without_lines(docs, line_keeps(docs, least_documents, least_points))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
