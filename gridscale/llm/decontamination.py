"""Benchmark decontamination over positional posting lists of the training documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import LOWER, Slices, byte_set, over_batches, pieces, runs

#: Bytes of words: 0-9, a-z (after lower-casing) and every byte of a longer UTF-8 character.
_WORD = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

#: Benchmark text that is shipped to the tasks at once. More text takes more rounds over the documents.
BLOCK_BYTES = 8 << 20
#: Rows of a piece of text whose candidate places are checked at once.
_AT_ONCE = 1 << 20


@dataclass
class Probes:
    """The distinct windows of a block of benchmark items, as rows of term numbers (-1: shorter)."""

    terms: np.ndarray    # sorted hashes of all words
    windows: np.ndarray  # window x offset
    length: np.ndarray
    items: list[str]
    owner_window: np.ndarray  # pairs of a window and an item that holds it
    owner_item: np.ndarray


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the text it is in."""
    data = LOWER[data]
    start, end = runs(_WORD[data], offsets)
    return Slices(data).hashes(start, end), np.searchsorted(offsets, start, side="right") - 1


def probes(texts: pa.Array, ids: list[str | None], window: int) -> Probes:
    found, held, lengths = [], [], []
    for first, _, data, offsets in pieces(texts):
        hashes, owner = _words(data, offsets)
        bounds = np.searchsorted(owner, np.arange(len(offsets)))
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            size = min(window, int(b - a))
            for at in range(a, b - size + 1) if size else ():
                found.append(np.pad(hashes[at:at + size], (0, window - size)))
                lengths.append(size)
                held.append(first + k)
    if not found:
        return Probes(np.zeros(0, np.uint64), np.zeros((0, window), np.int64), np.zeros(0, np.int64), [],
                      np.zeros(0, np.int64), np.zeros(0, np.int64))
    rows = np.column_stack([np.array(found), np.array(lengths, np.uint64)])
    rows, which = np.unique(rows, axis=0, return_inverse=True)
    length, rows = rows[:, window].astype(np.int64), rows[:, :window]
    present = np.arange(window) < length[:, None]
    terms, number = np.unique(rows[present], return_inverse=True)
    numbered = np.full(rows.shape, -1, np.int64)
    numbered[present] = number
    names = sorted({i for i in ids if i is not None})
    place = {name: k for k, name in enumerate(names)}
    pairs = {(int(w), place[ids[h]]) for w, h in zip(which.ravel(), held) if ids[h] is not None}
    pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return Probes(terms, numbered, length, names, pairs[:, 0], pairs[:, 1])


def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count)


def occurrences(hashes: np.ndarray, owner: np.ndarray, p: Probes, slack: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, position of its first word) of every occurrence among the words of some texts.

    The words that are test terms become posting lists: numbers ``term << 40 | position`` in order.
    Each window starts from its term with the shortest list, moved back by the term's offset, and
    keeps the places that the other terms' moved lists hold too, the next rarest first. With
    ``slack`` a term may stand up to so many words away from its place.
    """
    if not len(p.terms) or not len(hashes):
        return
    number = np.minimum(np.searchsorted(p.terms, hashes), len(p.terms) - 1)
    position = np.flatnonzero(p.terms[number] == hashes)
    postings = np.sort(number[position] << 40 | position)
    edges = np.searchsorted(postings >> 40, np.arange(len(p.terms) + 1))
    sizes = np.diff(edges)
    cost = np.where(p.windows >= 0, sizes[p.windows], np.iinfo(np.int64).max)
    order = np.argsort(cost, axis=1, kind="stable")
    rarest = order[:, 0]
    each = np.take_along_axis(cost, rarest[:, None], axis=1)[:, 0]
    live = np.flatnonzero(each)
    cuts = np.searchsorted(np.cumsum(each[live]), np.arange(_AT_ONCE, each.sum() + _AT_ONCE, _AT_ONCE), side="right")
    for some in np.split(live, np.unique(cuts)):
        if not len(some):
            continue
        term = p.windows[some, rarest[some]]
        window = np.repeat(some, each[some])
        place = (postings[_ragged(edges[term], each[some])] & ((1 << 40) - 1)) - rarest[window]
        last = place + p.length[window] - 1
        ok = (place >= 0) & (last < len(hashes))
        ok[ok] = owner[place[ok]] == owner[last[ok]]
        window, place = window[ok], place[ok]
        for rank in range(1, p.windows.shape[1]):
            offset = order[window, rank]
            want = p.windows[window, offset]
            at = place + offset
            low, high = at - slack, at + slack
            if slack:
                low, high = np.maximum(low, 0), np.minimum(high, len(hashes) - 1)
            key = np.maximum(want, 0) << 40
            found = np.searchsorted(postings, key | low)
            seen = np.minimum(found, len(postings) - 1)
            ok = (want < 0) | (found < len(postings)) & (postings[seen] <= (key | high))
            window, place = window[ok], place[ok]
            if not len(window):
                break
        yield window, place



def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def _scan(rows: pa.RecordBatch, p: Probes, slack: int):
    """Adds what this block of probes hits to each row's words and items."""
    n_words, hits, items = [], [], []
    before, listed = rows["hits"].to_pylist(), rows["items"].to_pylist()
    for first, end, data, offsets in pieces(rows["text"]):
        hashes, owner = _words(data, offsets)
        bounds = np.searchsorted(owner, np.arange(end - first + 1))
        hit = np.zeros(len(hashes), bool)
        seen = np.zeros(0, np.int64)  # row * items + item, of rows with a window of the item
        for window, place in occurrences(hashes, owner, p, slack):
            text = owner[place]
            low = np.maximum(place - slack, bounds[text])
            high = np.minimum(place + p.length[window] + slack, bounds[text + 1])
            hit |= _covered(len(hashes), low, high)
            if len(p.owner_window):
                a, b = np.searchsorted(p.owner_window, window), np.searchsorted(p.owner_window, window, side="right")
                pairs = np.unique(np.repeat(text, b - a) * len(p.items) + p.owner_item[_ragged(a, b - a)])
                seen = np.union1d(seen, pairs)
        row, item = np.divmod(seen, max(len(p.items), 1))
        edges = np.searchsorted(row, np.arange(end - first + 1))
        for k in range(end - first):
            own = np.flatnonzero(hit[bounds[k]:bounds[k + 1]])
            n_words.append(int(bounds[k + 1] - bounds[k]))
            old = before[first + k]
            hits.append(np.union1d(own, old).tolist() if old else own.tolist())
            old = listed[first + k]
            new = [p.items[i] for i in item[edges[k]:edges[k + 1]]]
            items.append(sorted({*old, *new}) if old else new)
    yield pa.RecordBatch.from_arrays(
        [*(rows[c] for c in rows.schema.names if c not in ("n_words", "hits", "items")), pa.array(n_words, pa.int64()),
         pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
        names=[*(c for c in rows.schema.names if c not in ("n_words", "hits", "items")), "n_words", "hits", "items"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, slack: int = 0) -> DataFrame:
    """(doc_id, text, n_words, hits, items) of each row of ``docs``.

    ``hits`` are the numbers of the words within an occurrence of a window of ``window`` consecutive
    words of an item (a shorter item is one window), ``items`` the ids of items with an occurring
    window, sorted as strings. ``slack = 0`` finds exact phrases; otherwise proximity matches, in which each
    term stands at most ``slack`` words from its place relative to the window's rarest one.

    The index is partitioned by document: a task lists the positions of the test terms in its own
    texts, so phrases need no exchange and a common passage costs each task its own share. The
    benchmark is a stated query set and is shipped in blocks of ``BLOCK_BYTES``; further blocks are
    further rounds. Null and empty texts have no words; items without words match nothing; items
    with a null id hit words but are not listed; repeated rows are judged each.
    """
    size = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")) + 16)).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES) or 1
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                     F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<int>").alias("hits"),
                     F.array().cast("array<string>").alias("items"))
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == k).toArrow()
        p = probes(rows["text"], rows["item_id"].to_pylist(), window)
        df = df.mapInArrow(over_batches(_scan, p, slack),
                           "doc_id BIGINT, text STRING, n_words BIGINT, hits ARRAY<INT>, items ARRAY<STRING>")
    return df


def contamination_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", F.size("hits").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))
