import random
import re

import numpy as np
import pytest
from helpers import EDGES, documents, prose

from gridscale.llm import jaccard
from gridscale.llm.graphs import components
from gridscale.llm.jaccard import Block, jaccard_components, linked, pack, unpack


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {k: (len(sets[k]), top(k)) for k in range(len(texts))}


def changed(text, r, n):
    w = text.split(" ")
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def corpus(seed):
    """Copies, chains of near copies around the threshold, and unlike texts that share a long passage."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = prose(1, 40, vocabulary)
    texts = list(EDGES)
    for k in range(6):
        base = prose(10 + k, r.choice([12, 60, 150]), vocabulary)
        texts += [base, base.upper()] + [changed(base, r, r.randint(0, 6)) for _ in range(14)]
        for _ in range(6):
            texts.append(changed(texts[-1], r, 2))
    texts += [prose(100 + k, r.choice([5, 8, 10, 60]), vocabulary) + " " + passage for k in range(25)]
    return texts


@pytest.mark.parametrize("chunk", [512, 4])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", chunk)  # small chunks leave most links to the lists
    monkeypatch.setattr(jaccard, "GROUP_DOCS", 20)
    monkeypatch.setattr(jaccard, "BUCKET_SHINGLES", 300)
    texts = corpus(chunk)
    docs = documents(spark, texts).selectExpr("*", "1 AS uid", "2 AS grp", "3 AS cid", "4 AS component_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == brute(texts)


def test_without_leaders_the_lists_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_chunked_leaders", lambda sets, key: sets.selectExpr("cid", "cid AS leader").limit(0))
    texts = corpus(9)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(documents(spark, texts)).collect()}
    assert got == brute(texts)


def test_empty_null_and_repeated(spark):
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", None])
    assert jaccard_components(docs.limit(0)).count() == 0
    twice = docs.unionByName(docs).unionByName(docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars"))
    rows = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_components(twice).collect()), key=str)
    assert rows == sorted([(0, 0), (0, 0), (1, 0), (1, 0), (2, 2), (2, 2), (None, 0), (None, 0), (None, None)], key=str)


def test_blocks_answer_as_all_pairs_do():
    r = np.random.default_rng(2)
    for _ in range(60):
        pivot = np.unique(r.integers(0, 400, 100).astype(np.uint64))
        sets = [np.unique(np.concatenate([r.permutation(pivot)[:r.integers(60, 95)], r.integers(0, 400, 8).astype(np.uint64)])) for _ in range(8)]
        block = Block(pivot, [(s, len(s)) for s in sets])
        query = np.unique(np.concatenate([r.permutation(pivot)[:r.integers(50, 95)], r.integers(0, 400, 5).astype(np.uint64)]))
        assert block.links(query, len(query)) == any(linked(len(np.intersect1d(query, s)), len(query), len(s)) for s in sets)


def test_packing():
    for kind in (np.uint64, np.uint32, np.uint8):
        values = np.random.default_rng(1).integers(0, 250, 1000).astype(kind)
        assert (unpack(pack(values), kind) == values).all()
    assert len(unpack(pack(np.zeros(0, np.uint64)))) == 0


def test_components(spark):
    chain = [(f"{k:03}", f"{k + 1:03}") for k in range(40)] + [("x", "y"), ("z", "y"), ("q", "q")]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a STRING, b STRING")).collect()}
    assert got == {f"{k:03}": "000" for k in range(41)} | {"x": "x", "y": "x", "z": "x"}
