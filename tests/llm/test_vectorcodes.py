import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from gridscale.llm.vectorcodes import SlicedEntries, code_digests, largest_component, vector_codes

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def brute(rows, parts=16, n_codes=64, rounds=2):
    """{vec_id: (code, error, label_error)} and the digest of the codebooks, in plain Python."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort()
    width = len(kept[0][1]) // parts
    cut = {i: [v[p * width:(p + 1) * width] for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i, _, _ in kept[:n_codes]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for i in cut:
                groups[nearest(p, cut[i][p])[1]].append(cut[i][p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if groups[e] else c for e, c in enumerate(books[p])]
    coded = {i: [nearest(p, cut[i][p]) for p in range(parts)] for i in cut}
    errors, totals = {i: sum(d for d, _ in found) for i, found in coded.items()}, defaultdict(int)
    for i, _, label in kept:
        totals[label] += errors[i]
    flat = ",".join(str(x) for book in books for c in book for x in c)
    return ({i: ("".join(f"{e:02x}" for _, e in coded[i]), errors[i], totals[label]) for i, _, label in kept},
            hashlib.sha256(flat.encode()).hexdigest())


def vectors(n, dims, seed, scale=1.0):
    r = np.random.default_rng(seed)
    return (r.normal(0, scale, (n, dims))).astype(np.float32).tolist()


@pytest.mark.parametrize(("n", "dims", "scale"), [(300, 64, 0.15), (40, 32, 1.0), (200, 16, 0.01), (1, 16, 1.0)])
def test_against_brute_force(spark, n, dims, scale):
    rows = [(3 * k - 50, v, None if k % 11 == 0 else k % 4) for k, v in enumerate(vectors(n, dims, n, scale))]
    rows += [(1000, None, 1), (1001, [None] + [0.0] * (dims - 1), 1), (1002, [float("nan")] * dims, 2), (1003, [float("inf")] * dims, None), (1004, [], 1)]
    random.Random(1).shuffle(rows)
    want, digest = brute(rows)
    found = code_digests(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in found} == want
    assert {r["codebooks_sha256"] for r in found} == {digest}


def test_masks_find_the_nearest_entry_and_the_lower_of_equals():
    r = np.random.default_rng(2)
    for width, span, n in [(1, 3, 64), (4, 2, 64), (4, 100, 64), (7, 5, 3), (3, 1 << 27, 64), (2, 1, 1)]:
        entries, points = r.integers(-span, span + 1, (n, width)), r.integers(-2 * span, 2 * span + 1, (500, width))
        at, distance = SlicedEntries(entries).nearest(points)
        away = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (distance == away.min(axis=1)).all() and (at == away.argmin(axis=1)).all()


def test_repeated_ids_null_ids_other_lengths_and_columns(spark):
    v = vectors(6, 16, 9)
    rows = [(1, v[0], 1), (1, v[0], 1), (1, v[1], 1), (None, v[2], None), (2, v[3][:8], 1), (2, [0.5] * 32, 1), (3, v[4][:15], 1)]
    given = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS code", "1 AS cells", "2 AS error", "3 AS vector")
    got = code_digests(given).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, 1), (False, 1), (False, 1), (True, 0)]
    assert {r["error"] for r in got} == {0} and {r["label_error"] for r in got} == {0}


def test_huge_components_are_held_at_the_bound(spark):
    rows = [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, 1)]
    coded = vector_codes(spark.createDataFrame(rows, SCHEMA), n_codes=1, rounds=0)
    bound = largest_component(16)
    assert {r["vec_id"]: r["error"] for r in coded.codes.collect()} == {1: 0, 2: 16 * (2 * bound) ** 2, 3: 16 * bound ** 2}


def test_empty_table_and_bad_parameters(spark):
    assert code_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([], SCHEMA), n_codes=65)
