"""Words that one edit tells apart, and the common form that each rare one of them is likely a variant of.

Two words whose longer one has m characters differ by one edit exactly if their common prefix and their common suffix together reach
m - 1. Then they share the first m // 2 characters or the last m - m // 2, so words are dealt by these, and by m. A group of
words is a padded matrix of code points; blocks of it are compared with each other column by column, from the left for prefixes and
from the right for suffixes. Groups beyond ``TILE`` words are cut, and each pair of cuts is a group of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import LOWER, batch, byte_set, pieces, stored, text_bytes

#: Words of a group, or of each side of a pair of cuts, on average; and rows that are compared with all others at once.
TILE = 1024
_BLOCK = 256
#: Code points that are looked up at once.
_CELLS = 1 << 21
#: Bytes of a run up to which its checksum, and columns up to which its matrix, is made along with others.
_SHORT = 64

_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A))
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of every run, carried on from its seed (the checksum of what comes before it)."""
    sums, lengths = seeds.astype(np.uint32), ends - starts
    order = np.argsort(-np.where(lengths > _SHORT, 0, lengths), kind="stable")
    order = order[:np.count_nonzero(lengths <= _SHORT)]
    state, at, left = ~sums[order], starts[order], lengths[order]
    for k in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -k, side="left"))  # runs longer than k, which come first
        state[:live] = _CRC[(state[:live] ^ data[at[:live] + k]) & np.uint32(0xFF)] ^ (state[:live] >> np.uint32(8))
    sums[order] = ~state
    for k in np.flatnonzero(lengths > _SHORT):
        sums[k] = zlib.crc32(data[starts[k]:ends[k]].tobytes(), int(seeds[k]))
    return sums


def _batch_words(given: pa.RecordBatch, least_points: int, drop_every: int | None) -> pa.RecordBatch | None:
    """The words of a batch of texts with their number, those long enough."""
    found = []
    ids = given["doc_id"].to_pylist()
    for row, _, data, offsets in pieces(given["text"]):
        data = LOWER[data]
        # U+00C0 to U+00FF are the byte C3 and one more; a text never ends between the two.
        wide = data == 0xC3
        member = _LETTERS[data] | wide
        member[1:] |= wide[:-1]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        start = member & (edge[:-1] | ~np.concatenate([[False], member[:-1]]))
        stop = member & (edge[1:] | ~np.concatenate([member[1:], [False]]))
        starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
        head = (data & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(head)])
        points = before[ends] - before[starts]
        long = points >= least_points
        starts, ends, points = starts[long], ends[long], points[long]
        if not len(starts):
            continue
        use = np.zeros(len(data) + 1, np.int8)
        lengths = ends - starts
        if drop_every:
            doc = np.searchsorted(offsets, starts, side="right") - 1
            seeds = np.zeros(len(offsets) - 1, np.uint32)
            for k in np.unique(doc):
                seeds[k] = zlib.crc32(f"{'' if ids[row + k] is None else ids[row + k]}:".encode())
            sums = _checksums(data, starts, ends, seeds[doc]).astype(np.int64)
            chosen = np.flatnonzero(sums % drop_every == 0)
            heads = np.flatnonzero(head)
            at = heads[before[starts[chosen]] + sums[chosen] % points[chosen]]
            width = 1 + wide[at]
            points[chosen] -= 1
            lengths[chosen] -= width
            long = points >= least_points
            starts, ends, lengths = starts[long], ends[long], lengths[long]
        use[starts] += 1
        use[ends] -= 1
        use = np.cumsum(use[:-1]).astype(bool)
        if drop_every:
            use[at] = False
            use[at[width == 2] + 1] = False
        places = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        found.append(pa.StringArray.from_buffers(len(lengths), places.buffers()[1], pa.py_buffer(data[use].tobytes())))
    if not found:
        return None
    counted = pc.value_counts(pa.chunked_array(found))
    return batch(_WORDS, counted.field("values"), counted.field("counts"))


def word_counts(docs: DataFrame, least_points: int = 7, least_count: int = 2, drop_every: int | None = None) -> DataFrame:
    """(word, n): the words of all texts and how often they occur.

    A word is a maximal run of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, of ``least_points`` code points or more and
    ``least_count`` occurrences. With ``drop_every``, spelling errors are planted first: where the CRC-32 of ``<doc_id>:<run>``
    is divisible by it, the run loses the code point at checksum % length (a null id reads as empty). Null texts have no words.
    """
    def read(batches):
        for one in batches:
            words = _batch_words(one, least_points, drop_every) if one.num_rows else None
            if words is not None:
                yield words

    given = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(read, "word STRING, n LONG").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _columns(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as the columns of two padded matrices: code points from the left on, and from the right on; zero beyond a word."""
    left, right = np.zeros((2, width, len(starts)), points.dtype)
    ends, step = starts + lengths - 1, max(1, _CELLS // max(len(starts), 1))
    for low in range(0, width, step):
        row = np.arange(low, min(low + step, width))[:, None]
        inside, last = row < lengths, max(len(points) - 1, 0)
        left[low:low + step] = np.where(inside, points[np.minimum(starts + row, last)], 0)
        right[low:low + step] = np.where(inside, points[np.maximum(ends - row, 0)], 0)
    return left, right


def _agreeing(dense: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many columns of two words agree before one differs."""
    return np.logical_and.accumulate(dense[:, a] == dense[:, b], axis=0).sum(axis=0)


def _near_pairs(left: np.ndarray, right: np.ndarray, short: np.ndarray, by_prefix: bool,
                ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words of one group that differ by one edit; each is found in one group only. ``ours`` are compared with
    ``theirs``; if they are the same words, each pair counts once. ``short`` are words without a code point in the last column.

    Of the columns that the group does not share, an edit leaves the first ones as they are or, counted from the right,
    the last ones; whole blocks are compared in these, and what agrees there in all columns.
    """
    width = len(left)
    share = width // 2
    shared, free = (share, width - share) if by_prefix else (width - share, share)
    outer, inner = (left, right) if by_prefix else (right, left)  # the shared columns come first in ``outer``
    few = min(free // 2, 2)
    found_a, found_b = [], []
    for first in range(0, len(ours), _BLOCK):
        rows = ours[first:first + _BLOCK]
        near = np.ones((2, len(rows), len(theirs)), bool)
        for k in range(few):
            near[0] &= outer[shared + k][rows][:, None] == outer[shared + k][theirs]
            near[1] &= inner[k][rows][:, None] == inner[k][theirs]
        i, j = np.nonzero(near[0] | near[1])
        i, j = rows[i], theirs[j]
        asked = ((i < j) if ours is theirs else (i != j)) & ~(short[i] & short[j])
        i, j = i[asked], j[asked]
        step = max(1, _CELLS // width)
        for low in range(0, len(i), step):
            a, b = i[low:low + step], j[low:low + step]
            prefix = _agreeing(left, a, b)
            sure = (prefix + _agreeing(right, a, b) >= width - 1) & ((prefix >= share) == by_prefix)
            found_a.append(a[sure])
            found_b.append(b[sure])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([*found_a, *found_b]), np.concatenate([*found_b, *found_a])


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
_GROUP = ["gid", "m", "by_prefix", "one", "two"]


def _group_rows(given: pa.RecordBatch) -> np.ndarray:
    """Where groups start, and the end."""
    new = np.zeros(given.num_rows + 1, bool)
    new[[0, -1]] = True
    for name in _GROUP:
        values = given[name].to_numpy(zero_copy_only=False)
        new[1:-1] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _compared(given: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch | None:
    """For each word of whole groups that has near words in its group: their number and the first by count, then by spelling."""
    data, offsets = text_bytes(given["word"])
    points = np.frombuffer(data[offsets[0]:offsets[-1]].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if not len(points) or points.max() < 256:
        points = points.astype(np.uint8)
    lengths = pc.utf8_length(given["word"]).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    n = given["n"].to_numpy()
    m, side, one, two, cut = (given[c].to_numpy(zero_copy_only=False) for c in ("m", "by_prefix", "one", "two", "cut"))
    width = int(m.max(initial=0, where=m <= _SHORT))
    dense = _columns(points, starts, lengths, width)
    words, counts, best = [], [], []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if high - low < 2:
            continue
        if one[low] == two[low]:
            ours = theirs = np.arange(high - low)
        else:
            ours, theirs = (np.flatnonzero(cut[low:high] == k[low]) for k in (one, two))
        if not len(ours) or not len(theirs):
            continue
        columns = dense if m[low] <= width else _columns(points, starts[low:high], lengths[low:high], int(m[low]))
        left, right = (c[:m[low], low:high] if m[low] <= width else c for c in columns)
        a, b = _near_pairs(left, right, lengths[low:high] < m[low], bool(side[low]), ours, theirs)
        if len(a):
            rank = np.empty(high - low, np.int64)
            by_count = np.lexsort((np.arange(high - low), -n[low:high]))  # the words of a group come in order of spelling
            rank[by_count] = np.arange(high - low)
            first = np.full(high - low, high - low)
            np.minimum.at(first, a, rank[b])
            have = np.flatnonzero(first < high - low)
            words.append(have + low)
            counts.append(np.bincount(a, minlength=high - low)[have])
            best.append(by_count[first[have]] + low)
    if not words:
        return None
    best = np.concatenate(best)
    return batch(_NEAR, given["word"].take(pa.array(np.concatenate(words))), np.concatenate(counts), n[best], given["word"].take(pa.array(best)))


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted groups, one after the other; the last group of a batch waits for the next one."""
    waiting = None
    for given in batches:
        if not given.num_rows:
            continue
        if waiting is not None:
            given = pa.concat_batches([waiting, given])
        cuts = _group_rows(given)
        found = _compared(given, cuts[:-1])
        if found is not None:
            yield found
        waiting = given.slice(int(cuts[-2]))
    if waiting is not None:
        found = _compared(waiting, np.array([0, waiting.num_rows]))
        if found is not None:
            yield found


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): for each word of ``words`` (word, n; no word twice) with words one insertion, deletion or
    replacement of a code point away, their number and the one of largest n, of equals the first in code-point order."""
    m = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m")
    half = F.expr("m div 2").cast("int")
    sides = F.explode(F.array(
        F.struct(F.lit(True).alias("by_prefix"), F.col("word").substr(F.lit(1), half).alias("key")),
        F.struct(F.lit(False).alias("by_prefix"), F.expr("right(word, m - m div 2)").alias("key")))).alias("side")
    keyed = words.where("word IS NOT NULL AND n IS NOT NULL").select("word", "n", m).select("word", "n", "m", sides).select("word", "n", "m", "side.*")
    large = stored(keyed.groupBy("m", "by_prefix", "key").count().where(F.col("count") > TILE).select(
        "m", "by_prefix", "key", F.ceil(F.col("count") / TILE).cast("int").alias("n_cuts")))
    cut = keyed.join(large, ["m", "by_prefix", "key"], "left").withColumn("n_cuts", F.coalesce("n_cuts", F.lit(1)))
    cut = cut.withColumn("cut", F.pmod(F.xxhash64("word"), "n_cuts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_cuts") - 1))
    dealt = cut.withColumn("other", other).select(
        "word", "n", "m", "by_prefix", F.least("cut", "other").alias("one"), F.greatest("cut", "other").alias("two"), "cut", "key")
    dealt = dealt.withColumn("gid", F.xxhash64("m", "by_prefix", "key", "one", "two")).drop("key")
    grouped = dealt.repartition("gid").sortWithinPartitions(*_GROUP, "word")
    found = grouped.mapInArrow(_near_words, "word STRING, n_near LONG, best_n LONG, best STRING")
    first = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.rank")).alias("best_n"), F.col("first.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of ``forms`` (word, form; no word twice, no circle) lead in the end.

    Every round doubles the steps taken, and forms are ten times as frequent as their words, so that there are few."""
    ways = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(ways.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        ways = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return ways


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``words`` (word, n).

    ``form`` is the most frequent near word, the first in code-point order of equals, if it is ``ratio`` (2 or more) times as
    frequent as the word or more, else null; ``root`` is where forms lead from the word, or the word itself. Rows with a null word or n
    are left out, words given twice count as one with the sum of their n, other columns are not looked at.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    words = stored(words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")))
    near = stored(near_words(words))
    known = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.struct(F.col("best").alias("form"), F.col("best_n").alias("form_n"))).alias("to")))
    found = roots(known.where("to IS NOT NULL").select("word", "to.form"))
    return known.join(found, "word", "left").select("word", "n", "n_near", "to.form", "to.form_n", F.coalesce("root", "word").alias("root"))


def document_variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``docs``, with errors planted in one of 31 different runs of a text."""
    return spelling_variants(word_counts(docs, drop_every=31))
