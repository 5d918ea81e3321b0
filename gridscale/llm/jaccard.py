"""Exact n-gram Jaccard join that skips by the relations between sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.graphs import components
from gridscale.llm.text import LOWER, WORD_BYTES, Slices, batch, mixed, over_batches, pieces, runs, sequences, stored

#: Words of a shingle, and the least similarity of a link as a ratio of integers.
SHINGLE, LEAST, WHOLE = 5, 80, 100

#: Shingles are counted by this many bits of their hash. Shingles that share them only look more common than they are,
#: which weakens a filter and changes no result.
COUNT_BITS = 48
#: Sizes of the units of work: documents that are counted together, shingles of a bucket, sets of a chunk.
GROUP_DOCS, BUCKET_SHINGLES, CHUNK_SETS = 1024, 500_000, 512
#: Shingles that a task holds before it lists them.
LISTED_SHINGLES = 1_500_000


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes; differences of sorted numbers take few bytes each."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1) if len(values) else b""


def unpack(data: bytes, kind=np.uint64) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def shingle_sets(texts: pa.Array):
    """The sorted set of shingle hashes of each text, in order."""
    for _, end, data, offsets in pieces(texts):
        data = LOWER[data]
        start, stop = runs(WORD_BYTES[data], offsets)
        words = Slices(data).hashes(start, stop)
        bounds = np.searchsorted(start, offsets)
        whole = sequences(words, SHINGLE)
        for a, b in zip(bounds, bounds[1:]):
            if b - a >= SHINGLE:
                yield np.unique(whole[a:b - SHINGLE + 1])
            else:
                yield sequences(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _counted_part(values: np.ndarray) -> np.ndarray:
    return values >> np.uint64(64 - COUNT_BITS)


def class_name(values: np.ndarray) -> str:
    """128 bits that equal sets share."""
    return f"{int(values.sum(dtype=np.uint64)):016x}{int(mixed(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)):016x}"


# 1. How common each shingle is, told to the groups of documents that have it.

_LISTED = pa.schema([("bucket", pa.int32()), ("shingles", pa.binary()), ("groups", pa.binary())])


def _list_shingles(rows, buckets):
    values, groups, waiting = [], [], 0
    for own, group in zip(shingle_sets(rows["text"]), rows["grp"].to_numpy()):
        values.append(_counted_part(own))
        groups.append(np.full(len(own), group, np.uint32))
        waiting += len(own)
        if waiting > LISTED_SHINGLES:
            yield _listed(values, groups, buckets)
            values, groups, waiting = [], [], 0
    if waiting:
        yield _listed(values, groups, buckets)


def _listed(values, groups, buckets):
    values, groups = np.concatenate(values), np.concatenate(groups)
    order = np.argsort(values, kind="stable")
    values, groups = values[order], groups[order]
    edges = np.searchsorted(values, (np.arange(buckets + 1) * (1 << COUNT_BITS) // buckets).astype(np.uint64))
    full = np.flatnonzero(np.diff(edges))
    return batch(_LISTED, full.astype(np.int32), [_pack_sorted(values[edges[k]:edges[k + 1]]) for k in full],
                 [pack(groups[edges[k]:edges[k + 1]]) for k in full])


_TOLD = pa.schema([("grp", pa.int32()), ("shingles", pa.binary()), ("levels", pa.binary())])


def _tell_common(table: pa.Table) -> pa.Table:
    """For each group its shingles that occur twice or more anywhere, with the logarithm of their number."""
    values = np.concatenate([_unpack_sorted(x) for x in table["shingles"].to_pylist()])
    groups = np.concatenate([unpack(x, np.uint32) for x in table["groups"].to_pylist()])
    order = np.argsort(values, kind="stable")
    values, groups = values[order], groups[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.repeat(np.diff(np.append(first, len(values))), np.diff(np.append(first, len(values))))
    common = counts > 1
    values, groups, level = values[common], groups[common], np.log2(counts[common]).astype(np.uint8)
    order = np.lexsort([values, groups])
    values, groups, level = values[order], groups[order], level[order]
    new = np.concatenate([[True], (values[1:] != values[:-1]) | (groups[1:] != groups[:-1])]) if len(values) else np.zeros(0, bool)
    values, groups, level = values[new], groups[new], level[new]
    edges = np.append(np.flatnonzero(np.diff(groups.astype(np.int64), prepend=-1)), len(groups))
    out = [(int(groups[a]), _pack_sorted(values[a:b]), pack(level[a:b])) for a, b in zip(edges, edges[1:])]
    return pa.Table.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(_TOLD)], schema=_TOLD)


_SETS = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("n", pa.int64()), ("cid", pa.string()), ("common", pa.binary()),
                   ("n_common", pa.int64()), ("prefix", pa.list_(pa.int64())), ("key_a", pa.int64()), ("key_b", pa.int64())])
_SETS_SQL = "doc_id BIGINT, uid BIGINT, n BIGINT, cid STRING, common BINARY, n_common BIGINT, prefix ARRAY<BIGINT>, key_a BIGINT, key_b BIGINT"


def _prefix_length(n: int) -> int:
    """A set and any set it links with share one of so many first shingles of any common order."""
    return n - -(-LEAST * n // WHOLE) + 1


def _sets(docs: pa.Table, told: pa.Table) -> pa.Table:
    """All sets of a group of documents. A set most of whose shingles occur nowhere else links with nothing; the others keep
    their common shingles, rarest first."""
    known = [_unpack_sorted(x) for x in told["shingles"].to_pylist()]
    known = np.concatenate(known) if known else np.zeros(0, np.uint64)
    level = [unpack(x, np.uint8) for x in told["levels"].to_pylist()]
    level = np.concatenate(level) if level else np.zeros(0, np.uint8)
    order = np.argsort(known, kind="stable")
    known, level = known[order], level[order]
    out = [[] for _ in _SETS]
    if not docs.num_rows:
        return pa.Table.from_arrays([pa.array([], f.type) for f in _SETS], schema=_SETS)
    for doc, uid, own in zip(docs["doc_id"].to_pylist(), docs["uid"].to_pylist(), shingle_sets(docs["text"])):
        row = [doc, uid, len(own), class_name(own), None, 0, None, None, None]
        if len(own) and len(known):
            part = _counted_part(own)
            at = np.minimum(np.searchsorted(known, part), len(known) - 1)
            found = known[at] == part
            m = int(found.sum())
            if m * WHOLE >= LEAST * len(own):
                common = own[found]
                ranked = common[np.lexsort([common, level[at[found]]])]
                first = max(0, _prefix_length(len(own)) - (len(own) - m))  # shingles of its own come first
                row[4:] = (pack(ranked), m, ranked[:first].view(np.int64).tolist(), _least(common, 1), _least(common, 2))
        for column, value in zip(out, row):
            column.append(value)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SETS)], schema=_SETS)


def _least(values: np.ndarray, seed: int) -> int:
    return int(mixed(values * np.uint64(2 * seed + 1) + np.uint64(seed)).min().astype(np.int64))


def documents_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, uid, n, cid, ...) per row of ``docs``; sets that can have links keep their common shingles."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("uid"))
    size = named.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    groups = max(1, size[0] // GROUP_DOCS)
    buckets = max(1, (size[1] or 0) // 7 // BUCKET_SHINGLES)
    named = named.withColumn("grp", F.pmod("uid", F.lit(groups)).cast("int"))
    listed = named.select("text", "grp").mapInArrow(over_batches(_list_shingles, buckets), "bucket INT, shingles BINARY, groups BINARY")
    told = listed.groupBy("bucket").applyInArrow(_tell_common, "grp INT, shingles BINARY, levels BINARY")
    return named.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(_sets, _SETS_SQL)


# 2. Links.

def linked(shared: int, n: int, m: int) -> bool:
    return WHOLE * shared >= LEAST * (n + m - shared)


class Block:
    """Sets kept by their difference from a pivot that each of them is similar to.

    What a query shares with the pivot is counted once. For a member it can only differ by the member's
    difference, so most members are skipped by a bound, and for the others the count is corrected by what the
    query shares with the difference alone.
    """

    def __init__(self, pivot: np.ndarray, members: list[tuple[np.ndarray, int]]):
        self.pivot = np.sort(pivot)
        self.members = [(np.setdiff1d(own, self.pivot, True), np.setdiff1d(self.pivot, own, True), n) for own, n in members]
        self.members.sort(key=lambda m: len(m[0]) + len(m[1]))

    def links(self, query: np.ndarray, n: int) -> bool:
        """Whether a query (sorted common shingles, ``n`` in all) links with any member."""
        shared = _shared(query, self.pivot)
        for more, less, size in self.members:
            bound = min(shared + len(more), len(query))
            if linked(bound, n, size) and linked(shared + _shared(query, more) - _shared(query, less), n, size):
                return True
        return False


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _leaders(table: pa.Table) -> pa.Table:
    """(cid, leader): each set of a chunk joins the first leader that it links with, or leads."""
    rows = sorted({c: (c, n, x) for c, n, x in zip(table["cid"].to_pylist(), table["n"].to_pylist(), table["common"].to_pylist())}.values())
    leaders, out = [], []
    for cid, n, data in rows:
        own = np.sort(unpack(data))
        found = next((name for name, size, other in leaders if linked(min(len(own), len(other)), n, size) and linked(_shared(own, other), n, size)), None)
        if found is None:
            leaders.append((cid, n, own))
        out.append((cid, found or cid))
    return pa.table({"cid": pa.array([o[0] for o in out], pa.string()), "leader": pa.array([o[1] for o in out], pa.string())})


def _chunked_leaders(sets: DataFrame, key: str) -> DataFrame:
    """Sets with an equal least hash, which similar sets mostly have, in chunks of about ``CHUNK_SETS``."""
    counts = stored(sets.groupBy(key).agg(F.count("*").alias("in_key")).where("in_key > 1"))
    chunk = F.pmod(F.xxhash64("cid", F.lit(key)), F.ceil(F.col("in_key") / CHUNK_SETS))
    # One name for key and chunk: grouping by both would leave all chunks of a key in the task that the join put them in.
    return sets.select("cid", "n", "common", key).join(counts, key).select("cid", "n", "common", F.xxhash64(key, chunk).alias("unit")).groupBy(
        "unit").applyInArrow(_leaders, "cid STRING, leader STRING")


def _matched(block: pa.Table, queries: pa.Table) -> pa.Table:
    """(a, b) for queries that link with any member of the block."""
    out = []
    if block.num_rows and queries.num_rows:
        rows = list(zip(block["cid"].to_pylist(), block["n"].to_pylist(), block["common"].to_pylist()))
        name = block["blk"][0].as_py()
        sets = {c: (np.sort(unpack(x)), n) for c, n, x in rows}
        pivot = sets.get(name) or next(iter(sets.values()))
        own = Block(pivot[0], list(sets.values()))
        for cid, n, data in zip(queries["cid"].to_pylist(), queries["n"].to_pylist(), queries["common"].to_pylist()):
            if own.links(np.sort(unpack(data)), n):
                out.append((cid, name))
    return pa.table({"a": pa.array([o[0] for o in out], pa.string()), "b": pa.array([o[1] for o in out], pa.string())})


def _remaining_links(sets: DataFrame, blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): links between components that the leaders left apart, found by index lists over blocks.

    A list names each block once, with the range of its sizes and the best position of the shingle in its sets. A pair of
    blocks is skipped as a whole if they are in one component, if their sizes are too far apart, or if
    too few shingles are left behind the position.
    """
    named = sets.join(blocks, "cid").join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "blk"))
    named = stored(named.select("cid", "n", "common", "n_common", "prefix", "blk", "comp"))
    lists = named.select("n", "n_common", "blk", "comp", F.posexplode("prefix").alias("at", "shingle")).groupBy("shingle", "comp", "blk").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n_common") - F.col("at")).alias("behind"))
    mixed_lists = lists.groupBy("shingle").agg(F.min("comp").alias("one"), F.max("comp").alias("other")).where("one <> other").select("shingle")
    lists = stored(lists.join(mixed_lists, "shingle"))
    names = ["comp", "blk", "low", "high", "behind"]
    left, right = (lists.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in names)) for side in "ab")
    needed = F.ceil((F.col("low_a") + F.col("low_b")) * LEAST / (LEAST + WHOLE))
    pairs = left.join(right, "shingle").where((F.col("comp_a") != F.col("comp_b")) & (F.col("blk_a") < F.col("blk_b"))).where(
        (F.col("high_a") * WHOLE >= F.col("low_b") * LEAST) & (F.col("high_b") * WHOLE >= F.col("low_a") * LEAST)
        & (F.least("behind_a", "behind_b") >= needed)).select("blk_a", "blk_b").distinct()
    sizes = named.groupBy("blk").agg(F.count("*").alias("members"))
    sized = lambda side: sizes.select(F.col("blk").alias(f"blk_{side}"), F.col("members").alias(f"members_{side}"))
    swap = F.col("members_a") > F.col("members_b")  # the smaller block's sets travel
    pairs = stored(pairs.join(sized("a"), "blk_a").join(sized("b"), "blk_b").select(
        F.when(swap, F.col("blk_b")).otherwise(F.col("blk_a")).alias("from"), F.when(swap, F.col("blk_a")).otherwise(F.col("blk_b")).alias("blk"),
        F.least("members_a", "members_b").alias("sent")))
    # A block that many sets are sent to is copied, one copy for each CHUNK_SETS of them.
    copies = stored(pairs.groupBy("blk").agg(F.ceil(F.sum("sent") / CHUNK_SETS).cast("int").alias("copies")))
    queries = pairs.join(copies, "blk").join(named.select(F.col("blk").alias("from"), "cid", "n", "common"), "from").select(
        *(F.col(c).alias(c) for c in ("blk", "cid", "n", "common")), _unit(F.pmod(F.hash("cid"), F.col("copies"))))
    targets = named.select("blk", "cid", "n", "common").join(copies, "blk").select(
        "blk", "cid", "n", "common", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")).select("blk", "cid", "n", "common", _unit(F.col("copy")))
    return targets.groupBy("unit").cogroup(queries.groupBy("unit")).applyInArrow(_matched, "a STRING, b STRING")


def _unit(copy):
    """One name for a block and its copy, so that the copies are dealt to different tasks."""
    return F.concat_ws(":", "blk", copy.cast("string")).alias("unit")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs``.

    Rows link when their sets of word shingles have a Jaccard similarity of 0.8 or more; the component is the smallest
    ``doc_id`` that links lead to. All links count, however large their group:

    1. Equal sets form a class, and a set with too few shingles that occur elsewhere is done (exact counts of all shingles).
    2. Classes that share a least hash are joined to leaders in bounded chunks; these links connect most of a group of copies.
    3. Index lists over blocks of sets around one leader find every pair of blocks of different components that could link;
       these are compared by their differences from the leader.

    Null and empty texts have no shingles and link with nothing. Rows with a null id take part, but do not name a
    component; repeated rows are one class.
    """
    every = stored(documents_sets(docs))
    able = every.where("common IS NOT NULL")
    chosen = able.groupBy("cid").agg(F.min("uid").alias("uid"))
    sets = stored(able.join(chosen, ["cid", "uid"]).select("cid", "n", "common", "n_common", "prefix", "key_a", "key_b"))
    first = stored(_chunked_leaders(sets, "key_a"))
    second = stored(_chunked_leaders(sets, "key_b"))
    edges = first.unionByName(second).select(F.col("cid").alias("a"), F.col("leader").alias("b")).where("a <> b")
    labels = components(edges).select(F.col("node").alias("cid"), F.col("component").alias("comp"))
    blocks = sets.select("cid").join(first, "cid", "left").select("cid", F.coalesce("leader", "cid").alias("blk"))
    more = stored(_remaining_links(sets, blocks, labels))
    final = labels if more.isEmpty() else components(edges.unionByName(more)).select(F.col("node").alias("cid"), F.col("component").alias("comp"))
    classes = every.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least")).join(final, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    classes = stored(classes)
    least = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "comp").select("cid", "component_id")
    return every.select("doc_id", "n", "cid").join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
