import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import EDGES, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from gridscale.llm import suffixes
from gridscale.llm.suffixes import LENGTH, anchors, joined_spans, repeat_digests, repeated_spans, suffix_array


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k:k + LENGTH] for d in data for k in range(len(d) - LENGTH + 1))
    out = {}
    for name, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - LENGTH + 1):
            if seen[d[k:k + LENGTH]] > 1:
                gone[k:k + LENGTH] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out[name] = (len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda k: text[k:])


def test_suffix_array_of_runs_and_periods():
    for text in ([1] * 200, [1, 2] * 100, [3, 2, 1] * 60 + [2], list(range(1, 150)), list(range(150, 1, -1))):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda k: text[k:])


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{k}é" for k in range(500)]
    long = prose(1, 300, vocabulary)
    passage = long.encode()[100:LENGTH + 160].decode(errors="ignore")
    exact = long.encode()[300:300 + LENGTH - 1].decode(errors="ignore")  # one byte short at most
    texts = list(EDGES) + [long, long, long.replace("w7é", "XX"), long[:900] + "?" + long[900:], long[600:1400], "Hahend " * 200, "y" * 1000, "ab" * 399,
                           "abc" * 200 + prose(5, 60, vocabulary), prose(2, 80, vocabulary) + prose(2, 80, vocabulary)]
    texts += [prose(10 + k, 40, vocabulary) + passage + prose(50 + k, r.randint(0, 60), vocabulary) for k in range(12)]
    texts += [prose(90 + k, 30, vocabulary) + exact + prose(150 + k, 30, vocabulary) for k in range(6)]
    for k in range(6):
        cut = r.randint(0, 500)
        texts.append(prose(200 + k, 20, vocabulary) + long[cut:cut + r.randint(300, 700)] + prose(300 + k, 20, vocabulary) + long[cut + 100:cut + 600])
    return texts


@pytest.mark.parametrize("chunk,unit", [(2048, 2 << 20), (2, 5000)])
def test_against_brute_force(spark, monkeypatch, chunk, unit):
    monkeypatch.setattr(suffixes, "CHUNK_CONTEXTS", chunk)  # anchors over several units
    monkeypatch.setattr(suffixes, "UNIT_BYTES", unit)
    texts = corpus(chunk)
    docs = documents(spark, texts).selectExpr("*", "1 AS uid", "2 AS spans", "3 AS anchor")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeat_digests(docs.repartition(6)).collect()}
    want = brute(texts)
    assert {k for k in want if got[k] != want[k]} == set()


def test_equal_and_null_rows(spark):
    text = prose(4, 200)
    docs = documents(spark, [text, None])
    assert {r["n_removed"] for r in repeat_digests(docs).collect()} == {0}
    rows = repeat_digests(docs.unionByName(docs)).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 0, len(text), len(text)]
    assert repeat_digests(docs.limit(0)).count() == 0
    unnamed = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    assert sum(r["n_removed"] for r in repeat_digests(unnamed.unionByName(unnamed)).collect()) == 2 * len(text)


def test_parts_of_a_long_text_have_the_same_anchors(monkeypatch):
    data = np.random.default_rng(3).integers(97, 100, 30_000).astype(np.uint8)
    whole = anchors(data, np.array([0, len(data)]))[0]
    monkeypatch.setattr(suffixes, "_PART", 4096)
    assert anchors(data, np.array([0, len(data)]))[0].tolist() == whole.tolist()


def test_joined_spans():
    assert joined_spans([{"start": 5, "end": 9}, {"start": 0, "end": 2}, {"start": 2, "end": 4}, {"start": 8, "end": 12}]) == [(0, 4), (5, 12)]


def test_many_equal_rows_cost_in_proportion(spark):
    """Spans of equal rows are kept once: every one of 3,000 rows is removed whole, and no row carries those of the others."""
    text = "".join(chr(97 + (k * k + 7 * k) % 23) for k in range(900))
    docs = documents(spark, [text]).crossJoin(spark.range(3000)).drop("id")
    spans = repeated_spans(docs).collect()
    assert len(spans) == 1 and len(spans[0]["spans"]) < 100
    found = {(r["n_bytes"], r["n_removed"], r["n_spans"]) for r in repeat_digests(docs).collect()}
    assert found == {(900, 900, 1)}


def test_split_anchors_are_settled_without_a_join_of_strings(spark, monkeypatch):
    """A row for each string that two units saw came out of a join; counting them needs none."""
    monkeypatch.setattr(suffixes, "CHUNK_CONTEXTS", 2)
    passage = prose(1, 120)
    docs = documents(spark, [prose(10 + k, 60) + passage + prose(50 + k, 60) for k in range(9)])
    spans = repeated_spans(docs)
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Join [string" not in plan
    assert spans.count() == 9
