"""Quality verdicts: document statistics scored by gradient-boosted trees held as node arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import WORD_BYTES, Slices, batch, byte_set, over_batches, pieces, runs, sequences, stored

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT = byte_set((0x41, 0x5A)), byte_set((0x30, 0x39))
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_CHAR = byte_set((0x80, 0xBF), complement=True)  # first bytes of characters
_LINE = byte_set((0x0A, 0x0A), complement=True)
_MARK = np.zeros(256, bool)
_MARK[list(b"!?;:\"()[]{}=_~^/\\")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Features by name, and the direction in which the chance of good quality may move with them
#: (-1: never up, 0: free).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "digit_share": -1, "mark_share": -1, "letter_share": 0, "words_per_line": 0, "distinct_share": 0, "common_share": 0,
}


def _grouped(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, per element."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse.ravel()]


def _per(texts: int, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, minlength=texts)


def statistics(data: np.ndarray, offsets: np.ndarray, window: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Counts (texts x COUNTS) and features (texts x FEATURES) of the texts of a piece."""
    n = len(offsets) - 1

    def total(member: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(member[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    slices = Slices(data)
    start, end = runs(WORD_BYTES[data], offsets)
    owner = np.searchsorted(offsets, start, side="right") - 1
    words = _per(n, owner)
    chars = np.concatenate([[0], np.cumsum(_CHAR[data])])
    word_chars = _per(n, owner, (chars[end] - chars[start]).astype(float)).astype(np.int64)
    hashes = slices.hashes(start, end)
    in_text = hashes + owner.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)

    own = sequences(in_text, window)
    repeated = np.zeros(len(hashes), bool)
    if len(own):
        whole = owner[:len(own)] == owner[window - 1:]
        change = np.zeros(len(hashes) + 1, np.int64)
        at = np.flatnonzero(whole)
        at = at[_grouped(own[at]) > 1]
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        repeated = np.cumsum(change[:-1]) > 0

    line, line_end = runs(_LINE[data], offsets)
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line)
    has_word &= np.searchsorted(start, line) < len(start)
    line, line_end = line[has_word], line_end[has_word]
    line_owner = np.searchsorted(offsets, line, side="right") - 1
    line_keys = slices.hashes(line, line_end) + line_owner.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    _, first = np.unique(line_keys, return_index=True)
    again = np.ones(len(line), bool)
    again[first] = False

    counts = np.column_stack([words, word_chars, total(_SYMBOLS), _per(n, line_owner[again]), _per(n, owner[repeated])]).astype(np.int64)
    _, first = np.unique(in_text, return_index=True)
    lines, letters, size = _per(n, line_owner), total(_LETTER), np.maximum(np.diff(offsets), 1)
    w = np.maximum(words, 1)
    often = _grouped(in_text) if len(in_text) else np.zeros(0, np.int64)
    features = np.column_stack([
        np.log2(1 + words), word_chars / w, counts[:, 2] / size, counts[:, 3] / np.maximum(lines, 1), counts[:, 4] / w,
        total(_UPPER) / np.maximum(letters, 1), total(_DIGIT) / size, total(_MARK) / size, letters / size,
        words / np.maximum(lines, 1), _per(n, owner[first]) / w, _per(n, owner, (often > 1).astype(float)) / w])
    return counts, features


@dataclass
class Trees:
    """Boosted trees as flat arrays over all nodes; a leaf points to itself on both sides."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    depth: int = 0
    base: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of good quality per row: all trees walk down side by side."""
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], n_trees: int = 60, depth: int = 3, rate: float = 0.15,
              bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Boosting of the logistic loss over quantile bins.

    A split on a feature with direction -1 (or 1) is taken only if the right side's value is not above
    (below) the left one's, and both sides' descendants are kept on their side of the middle.
    """
    if not len(y) or y.min() == y.max():
        return Trees(base=(4.0 if not len(y) or y[0] > 0.5 else -4.0))
    share = float(y.mean())
    out = Trees(base=float(np.log(share / (1 - share))), depth=depth)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    code = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, margin = [], np.full(len(y), out.base)

    def value(g, h, low, high):
        return np.clip(g / (h + ridge), low, high)

    def grow(rows, g, h, level, low, high):
        me = len(nodes)
        mine = value(g[rows].sum(), h[rows].sum(), low, high)
        nodes.append([0, 0.0, me, me, rate * mine])
        best = (1e-6, None)
        for f, e in enumerate(edges) if level < depth else ():
            if not len(e):
                continue
            gs = np.cumsum(np.bincount(code[rows, f], g[rows], len(e) + 1))
            hs = np.cumsum(np.bincount(code[rows, f], h[rows], len(e) + 1))
            ns = np.cumsum(np.bincount(code[rows, f], minlength=len(e) + 1))
            gl, hl, nl, gr, hr, nr = gs[:-1], hs[:-1], ns[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1], ns[-1] - ns[:-1]
            a, b = value(gl, hl, low, high), value(gr, hr, low, high)
            gain = _gain(a, gl, hl, ridge) + _gain(b, gr, hr, ridge) - _gain(mine, gs[-1], hs[-1], ridge)
            bad = (nl < least) | (nr < least) | ((b - a) * directions[f] < 0)
            gain[bad] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = float(gain[k]), (f, k, float(a[k]), float(b[k]))
        if best[1] is None:
            return me, [(rows, nodes[me][4])]
        f, k, a, b = best[1]
        goes_left, middle = code[rows, f] <= k, (a + b) / 2
        bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[directions[f]]
        left, some = grow(rows[goes_left], g, h, level + 1, *bounds[0])
        right, more = grow(rows[~goes_left], g, h, level + 1, *bounds[1])
        nodes[me][:4] = f, float(edges[f][k]), left, right
        return me, some + more

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        root, leaves = grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf)
        roots.append(root)
        for rows, v in leaves:
            margin[rows] += v
    flat = list(zip(*nodes))
    out.feature, out.threshold, out.left, out.right, out.value = (np.array(c) for c in flat)
    out.roots = np.array(roots)
    return out


def _gain(v, g, h, ridge):
    return v * g - 0.5 * (h + ridge) * v * v


_STATS = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("features", pa.list_(pa.float64()))])


def _stats(rows):
    counts, features = [], []
    for _, _, data, offsets in pieces(rows["text"]):
        c, f = statistics(data, offsets)
        counts.append(c)
        features.append(f)
    c, f = np.concatenate(counts), np.concatenate(features)
    lists = pa.ListArray.from_arrays(np.arange(len(f) + 1, dtype=np.int32) * f.shape[1], pa.array(f.ravel()))
    yield batch(_STATS, rows["doc_id"], *c.T, lists)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, features) per row; a null text has no words and only zeros."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(over_batches(_stats),
                             f"doc_id BIGINT, {', '.join(f'{c} BIGINT' for c in COUNTS)}, features ARRAY<DOUBLE>")


def fit_quality(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000, **options) -> Trees:
    """Trees from at most about ``max_rows`` labelled documents, chosen by a hash of their id.

    Rows without id or label are not learned from; of several labels of an id the mean counts.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.avg(F.col("quality").cast("double")).alias("quality"))
    total = known.count()
    share = min(1.0, max_rows / max(total, 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # One row for each id, so that repeated ids do not add to the bound.
    rows = stats.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("features", "quality")).alias("row")).select("row.*").toArrow()
    if not rows.num_rows:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0), list(FEATURES.values()))
    x = rows["features"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    y = rows["quality"].to_numpy()
    order = np.lexsort([*x.T, y])  # the order of arrival must not matter
    return fit_trees(x[order], y[order], list(FEATURES.values()), **options)


_VERDICT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("base_failed", pa.bool_()),
                      ("quality", pa.float64()), ("kept", pa.bool_())])


def _judge(rows, trees, threshold):
    counts = {c: rows[c].to_numpy() for c in COUNTS}
    x = rows["features"].flatten().to_numpy().reshape(rows.num_rows, -1)
    quality = np.concatenate([trees.score(x[k:k + 2048]) for k in range(0, len(x), 2048)])
    failed = (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
    yield batch(_VERDICT, rows["doc_id"], *counts.values(), failed, quality, ~failed & (quality >= threshold))


def judge_quality(stats: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """(doc_id, counts, base_failed, quality, kept): kept if the base rules pass and the trees give
    good quality a chance of ``threshold`` or more."""
    return stats.mapInArrow(over_batches(_judge, trees, threshold),
                            f"doc_id BIGINT, {', '.join(f'{c} BIGINT' for c in COUNTS)}, base_failed BOOLEAN, quality DOUBLE, kept BOOLEAN")


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics once per document, trees from a bounded sample of labels, a verdict for every row."""
    stats = stored(document_statistics(docs))
    return judge_quality(stats, fit_quality(stats, labels))
