"""Suffix arrays by linear grouping, and removal of long byte strings that occur twice."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscale.llm.text import Slices, batch, mixed, over_batches, pieces, stored

#: Bytes of a string that counts as repeated, of the grams that anchors are chosen by, and of a symbol of the suffix arrays.
LENGTH, GRAM, SYMBOL = 400, 64, 32
#: Grams in a string; contexts reach so far to the left of an anchor, and LENGTH to the right.
CHOICE = LENGTH - GRAM + 1
#: Symbols that lie whole within any repeated string.
SURE = LENGTH // SYMBOL - 1
#: Contexts of one anchor in one unit of work, and bytes of contexts in a unit.
CHUNK_CONTEXTS, UNIT_BYTES = 256, 1 << 20

_POSITION_BITS = 24
#: Longer texts are searched in overlapping parts of this size.
_PART = 1 << (_POSITION_BITS - 1)


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` (numbers of 1 and above) in order, in linear time but for sorting small lists.

    First all suffixes are put into groups of an equal Lyndon prefix. The groups, at first one per symbol, are
    processed in descending order: each suffix of a group looks for the nearest suffix before it that is in a lower group,
    by the pointers that are already known. Suffixes so pointed to by equally many of the group grow their Lyndon prefix by
    the same amount; they leave their group for a new one right above it. Then the order within the groups follows in one
    pass over the result, from the smallest suffix on: the suffix before one that is in place comes next in
    its own group, and so do those along its pointers until one is in place. Nothing is renamed or sorted again.
    """
    text = [*text, 0]
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for k, s in enumerate(order):
        if text[s] != text[order[start]]:
            start = k
        place[s], group[s] = k, start
        size[start] += 1
    before = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        children: dict[int, int] = {}
        for s in sorted(order[start:end]):
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[s] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
        if children:
            moves: dict[tuple[int, int], list[int]] = defaultdict(list)
            for p, count in children.items():
                moves[-count, group[p]].append(p)
            for key in sorted(moves) if len(moves) > 1 else moves:
                own, old = moves[key], key[1]
                to = old + size[old]
                if len(own) == size[old]:
                    continue
                size[old] -= len(own)
                for p in own:
                    to -= 1
                    other, here = order[to], place[p]
                    order[here], place[other] = other, here
                    order[to], place[p] = p, to
                for p in own:
                    group[p] = to
                size[to] = len(own)
        end = start
    result, free, done = [0] * n, list(range(n)), [False] * n
    result[0], done[n - 1] = n - 1, True
    for k in range(n):
        s = result[k] - 1
        while s >= 0 and not done[s]:
            done[s] = True
            at = free[group[s]]
            free[group[s]] = at + 1
            result[at] = s
            s = before[s]
    return result[1:]


# 1. Anchors: every string of LENGTH bytes chooses its least gram, so equal strings choose the same one at the same place.

def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of all texts of a piece."""
    if len(data) > _PART and len(offsets) == 2:
        found = [(a + at, h) for at in range(0, len(data), _PART - LENGTH)
                 for a, h in [anchors(data[at:at + _PART], np.array([0, min(_PART, len(data) - at)]))]]
        position, which = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
        return position, np.concatenate([f[1] for f in found])[which]
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    hashes = Slices(data).hashes(at, at + GRAM)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    least = _sliding_least(hashes & ~low | at.astype(np.uint64), CHOICE)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = owner[:len(least)] == owner[LENGTH - 1:LENGTH - 1 + len(least)]
    position = np.unique((least[whole] & low).astype(np.int64))
    return position, hashes[position]


_ANCHORS = pa.schema([("uid", pa.int64()), ("anchor", pa.int64()), ("positions", pa.list_(pa.int32()))])


def _anchor_rows(rows):
    uids = rows["uid"].to_numpy()
    for first, _, data, offsets in pieces(rows["text"]):
        position, hashes = anchors(data, offsets)
        owner = np.searchsorted(offsets, position, side="right") - 1
        order = np.lexsort([position, hashes, owner])
        position, hashes, owner = position[order], hashes[order], owner[order]
        new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])) if len(hashes) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(np.append(new, len(hashes)).astype(np.int32), pa.array((position - offsets[owner]).astype(np.int32)))
        yield batch(_ANCHORS, uids[first + owner[new]], hashes[new].view(np.int64), lists)


# 2. Contexts: the bytes around each anchor that occurs twice, once for all places with the same ones.

_CONTEXTS = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("lead", pa.int32()), ("body", pa.binary()), ("places", pa.int32()),
                       ("uid", pa.int64()), ("positions", pa.list_(pa.int32()))])
_CONTEXTS_SQL = "anchor BIGINT, ctx BIGINT, lead INT, body BINARY, places INT, uid BIGINT, positions ARRAY<INT>"


def _context_rows(rows):
    bodies: dict[tuple[int, int], list] = {}
    seen = []
    for uid, text, marks in zip(rows["uid"].to_pylist(), rows["text"].to_pylist(), rows["marks"].to_pylist()):
        data = text.encode()
        whole = np.frombuffer(data, np.uint8)
        slices = Slices(whole)
        at = np.array([p for m in marks for p in m["positions"]], np.int64)
        anchor = np.array([m["anchor"] for m in marks for _ in m["positions"]], np.int64)
        low, high = np.maximum(at - (CHOICE - 1), 0), np.minimum(at + LENGTH, len(data))
        name = mixed(slices.hashes(low, high) + (at - low).astype(np.uint64)).view(np.int64)
        own = defaultdict(list)
        for a, c, p, x, y in zip(anchor.tolist(), name.tolist(), at.tolist(), low.tolist(), high.tolist()):
            have = bodies.get((a, c))
            if have is None:
                bodies[a, c] = [p - x, data[x:y], 1]
            else:
                have[2] += 1
            own[a, c].append(p)
        seen += [(a, c, uid, ps) for (a, c), ps in own.items()]
        if len(bodies) > 50_000:
            yield from _context_batches(bodies, seen)
            bodies, seen = {}, []
    yield from _context_batches(bodies, seen)


def _context_batches(bodies, seen):
    keys = list(bodies)
    none = [None] * len(keys)
    yield batch(_CONTEXTS, [k[0] for k in keys], [k[1] for k in keys], *([bodies[k][j] for k in keys] for j in range(3)), none, none)
    none = [None] * len(seen)
    yield batch(_CONTEXTS, [s[0] for s in seen], [s[1] for s in seen], none, none, none, [s[2] for s in seen], [s[3] for s in seen])


# 3. Suffix arrays over the contexts of a unit tell which strings occur twice.

_REPEATS_SQL = ("anchor BIGINT, ctx BIGINT, spans ARRAY<STRUCT<start:INT,end:INT>>, chunk BIGINT, run BIGINT, "
                "starts ARRAY<INT>, strings ARRAY<BIGINT>, alone ARRAY<BOOLEAN>")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_REPEATS = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("spans", _SPANS), ("chunk", pa.int64()), ("run", pa.int64()),
                      ("starts", pa.list_(pa.int32())), ("strings", pa.list_(pa.int64())), ("alone", pa.list_(pa.bool_()))])


def _spans_of(starts: np.ndarray) -> list[dict]:
    """Bytes covered by the strings at sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH) + 1
    return [{"start": int(s[0]), "end": int(s[-1]) + LENGTH} for s in np.split(starts, cut)]


def _repeated(table: pa.Table) -> pa.Table:
    """Which strings of each context occur in another context of the same anchor, or in another place with the same context.

    Contexts are cut into symbols on both sides of the anchor. Within a repeated string ``SURE`` symbols in a row lie whole,
    so its places stand next to each other in the suffix array and share that many symbols; only there are
    the strings compared byte by byte (by hashes of all their bytes). Strings are equal only at the same distance from the
    anchor, so a place is never compared with itself.
    """
    merged: dict[tuple[int, int], list] = {}
    for a, c, lead, body, places, chunk, hot in zip(*(table[k].to_pylist() for k in ("anchor", "ctx", "lead", "body", "places", "chunk", "hot"))):
        have = merged.setdefault((a, c), [lead, body, 0, chunk, hot])
        have[2] += places
    keys = sorted(merged)
    rows = [merged[k] for k in keys]
    alone = defaultdict(int)
    for a, _ in keys:
        alone[a] += 1
    out = [[] for _ in _REPEATS]

    def add(*values):
        for column, value in zip(out, values):
            column.append(value)

    # One context of an anchor: repeated as a whole or not at all.
    work = []
    for key, (lead, body, places, chunk, hot) in zip(keys, rows):
        if alone[key[0]] == 1 and not hot:
            if places > 1 and len(body) >= LENGTH:
                add(*key, [{"start": -lead, "end": len(body) - lead}], *[None] * 5)
        elif len(body) >= LENGTH:
            work.append((key, lead, body, places, chunk, hot))
    if work:
        _compare(work, add)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _REPEATS)], schema=_REPEATS)


def _compare(work: list, add) -> None:
    data = np.frombuffer(b"".join(w[2] for w in work), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(w[2]) for w in work])])
    lead = np.array([w[1] for w in work])
    centre = begin[:-1] + lead
    slices = Slices(data)
    # Symbols: whole ones only, on both sides of the anchor; then one separator.
    left, right = lead // SYMBOL, (np.diff(begin) - lead) // SYMBOL
    count = left + right
    edge = np.concatenate([[0], np.cumsum(count + 1)])
    owner = np.repeat(np.arange(len(work)), count + 1)
    step = np.arange(edge[-1]) - edge[owner] - left[owner]  # symbols after the anchor
    real = np.arange(edge[-1]) - edge[owner] < count[owner]
    at = centre[owner] + SYMBOL * step
    hashes = np.zeros(edge[-1], np.uint64)
    hashes[real] = slices.hashes(at[real], at[real] + SYMBOL)
    _, symbol = np.unique(hashes[real], return_inverse=True)
    text = np.ones(edge[-1], np.int64)
    text[real] = symbol.ravel() + 2
    order = np.array(suffix_array(text.tolist()), np.int64)
    # Neighbours in the array that share SURE symbols belong together.
    full = real & (np.arange(edge[-1]) - edge[owner] + SURE <= count[owner])
    order = order[full[order]]
    run = slices.hashes(at[order], at[order] + SURE * SYMBOL)
    same = np.concatenate([[False], run[1:] == run[:-1]])
    hot = np.array([w[5] for w in work])
    places = np.array([w[3] for w in work])
    wanted = same | np.append(same[1:], False) | hot[owner[order]] | (places[owner[order]] > 1)
    order, run = order[wanted], run[wanted]
    # Strings that begin up to SYMBOL - 1 bytes before such a run, and hold it. Those that begin differently many
    # bytes before it are at other distances from the anchor, so each number of bytes is a case of its own.
    anchor = mixed(np.array([w[0][0] for w in work], np.int64).view(np.uint64))
    twice, firsts = [], []
    for ahead in range(SYMBOL):
        start = at[order] - ahead
        who = owner[order]
        fits = (start >= begin[who]) & (start + LENGTH <= begin[who + 1])
        suffix, who, start = np.flatnonzero(fits), who[fits], start[fits]
        apart = start - centre[who]
        string = mixed(slices.hashes(start, start + LENGTH) + apart.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + anchor[who])
        _, first, inverse, counts = np.unique(string, return_index=True, return_inverse=True, return_counts=True)
        again = (counts[inverse.ravel()] > 1) | (places[who] > 1)
        twice.append(np.column_stack([who[again], apart[again]]).astype(np.int32))
        first = first[hot[who[first]]]  # the anchor's other chunks may hold these strings too
        firsts.append((who[first], suffix[first], apart[first], string[first], ~again[first]))
    who, apart = np.concatenate(twice).T
    sorting = np.lexsort([apart, who])
    who, apart = who[sorting], apart[sorting]
    bounds = np.searchsorted(who, np.arange(len(work) + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        add(*work[k][0], _spans_of(apart[bounds[k]:bounds[k + 1]]), *[None] * 5)
    who, suffix, apart, string, alone = (np.concatenate(c) for c in zip(*firsts))
    sorting = np.argsort(suffix, kind="stable")
    who, suffix, apart, string, alone = (c[sorting] for c in (who, suffix, apart, string, alone))
    edges = np.append(np.flatnonzero(np.diff(suffix, prepend=-1)), len(suffix))
    name = mixed(run + step[order].astype(np.uint64) + anchor[owner[order]]).view(np.int64)
    for x, y in zip(edges, edges[1:]):
        k = who[x]
        add(*work[k][0], None, work[k][4], int(name[suffix[x]]), apart[x:y].tolist(), string[x:y].view(np.int64).tolist(), alone[x:y].tolist())


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(uid, spans) of the texts with bytes that belong to a string of 400 bytes found elsewhere too.

    1. Each string of 400 bytes chooses an anchor; only anchors with two places or more go on.
    2. Equal contexts of an anchor become one, with the number of its places; a group of copies costs one context.
    3. Units of a bounded number of contexts are compared by their suffix arrays. An anchor with more contexts than one
       unit takes is split; its units also report the strings that they saw first, and counts of these tell
       what units have in common.
    """
    named = _named(docs)
    found = stored(named.mapInArrow(over_batches(_anchor_rows), "uid BIGINT, anchor BIGINT, positions ARRAY<INT>"))
    # Counts are written before they are joined, so that adaptive execution can split an anchor that many texts have.
    twice = stored(found.groupBy("anchor").agg(F.sum(F.size("positions")).alias("n")).where("n > 1").select("anchor"))
    marks = found.join(twice, "anchor").groupBy("uid").agg(F.collect_set(F.struct("anchor", "positions")).alias("marks"))
    both = stored(named.join(marks, "uid").select("uid", "text", "marks").mapInArrow(over_batches(_context_rows), _CONTEXTS_SQL))
    contexts = both.where("body IS NOT NULL")
    size = contexts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    units = max(1, size // UNIT_BYTES)
    split = stored(contexts.groupBy("anchor").agg(F.ceil(F.count("*") / CHUNK_CONTEXTS).alias("chunks")).where("chunks > 1"))
    dealt = contexts.join(split, "anchor", "left").select(
        "anchor", "ctx", "lead", "body", "places", F.col("chunks").isNotNull().alias("hot"),
        F.pmod("ctx", F.coalesce("chunks", F.lit(1))).alias("chunk"))
    dealt = dealt.withColumn("unit", F.pmod(F.xxhash64("anchor", "chunk"), F.lit(units)))
    repeats = stored(dealt.groupBy("unit").applyInArrow(_repeated, _REPEATS_SQL))
    spans = repeats.where("spans IS NOT NULL").select("anchor", "ctx", "spans")
    firsts = repeats.where("run IS NOT NULL")
    several = firsts.groupBy("run").agg(F.min("chunk").alias("one"), F.max("chunk").alias("other")).where("one <> other").select("run")
    several = stored(several)
    strings = firsts.join(several, "run").select("anchor", "ctx", F.explode(F.arrays_zip("starts", "strings", "alone")).alias("x")).select(
        "anchor", "ctx", F.col("x.starts").alias("start"), F.col("x.strings").alias("string"), F.col("x.alone").alias("alone"))
    # A string that two chunks saw is repeated; where a chunk has it once only, that chunk could not know. Each row is told how
    # many chunks saw its string: one exchange, and no row meets another.
    seen = strings.withColumn("chunks", F.count(F.lit(1)).over(Window.partitionBy("string")))
    more = seen.where("alone AND chunks > 1").groupBy("anchor", "ctx").agg(
        _covered(F.array_sort(F.collect_set(F.col("start").cast("int")))).alias("spans"))
    places = both.where("uid IS NOT NULL").select("anchor", "ctx", "uid", "positions")
    moved = F.flatten(F.transform("positions", lambda p: F.transform("spans", lambda s: F.struct(
        (p + s["start"]).alias("start"), (p + s["end"]).alias("end")))))
    # Equal rows share a uid and have the same spans; the set holds them once, however many rows there are.
    return places.join(spans.unionByName(more), ["anchor", "ctx"]).select("uid", moved.alias("spans")).groupBy("uid").agg(
        F.flatten(F.collect_set("spans")).alias("spans"))


def _covered(starts: Column) -> Column:
    """Bytes covered by the strings at sorted starts, as spans that do not touch."""
    nothing = F.array().cast("array<struct<start:int,end:int>>")

    def step(done, start):
        last = F.try_element_at(done, F.lit(-1))
        span = lambda low: F.array(F.struct(low.alias("start"), (start + LENGTH).cast("int").alias("end")))
        return F.when(last.isNotNull() & (start <= last["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), span(last["start"]))).otherwise(
            F.concat(done, span(start)))

    return F.aggregate(starts, nothing, step)


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("uid"))


def joined_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap made one."""
    out: list[list[int]] = []
    for start, end in sorted({(s["start"], s["end"]) for s in spans}):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_REMOVED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _remove(rows):
    out = [[] for _ in list(_REMOVED)[1:]]
    for text, spans in zip(rows["text"].to_pylist(), rows["spans"].to_pylist()):
        data, spans = text.encode(), joined_spans(spans or [])
        kept = b"".join(data[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(data)]))
        for column, value in zip(out, (len(data), len(data) - len(kept), len(spans), kept)):
            column.append(value)
    yield batch(_REMOVED, rows["doc_id"], *out)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row of ``docs``: ``kept`` are the bytes of the text that belong to no
    string of 400 bytes that also starts anywhere else, in the same text or another. Null and empty texts have no bytes; equal
    rows are each other's repeats.
    """
    spans = repeated_spans(docs)
    return _named(docs).join(spans, "uid", "left").select("doc_id", "text", "spans").mapInArrow(
        over_batches(_remove), "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY")


def repeat_digests(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
