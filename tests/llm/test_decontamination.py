import hashlib
import random
import re

import pytest
from helpers import EDGES, documents, prose

from gridscale.llm import decontamination
from gridscale.llm.decontamination import contamination, contamination_digests


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window=10):
    out = {}
    for k, text in enumerate(texts):
        own, hit, found = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            size = min(window, len(w))
            for a in range(len(w) - size + 1) if size else ():
                for b in range(len(own) - size + 1):
                    if own[b:b + size] == w[a:a + size]:
                        hit |= set(range(b, b + size))
                        if item is not None:
                            found.add(str(item))
        out[k] = (len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


COLUMNS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.fixture(scope="module")
def case():
    r = random.Random(5)
    few = "alpha beta gamma delta eps".split()
    items = [(k, prose(100 + k, 25)) for k in range(8)] + [(20, "Alpha, beta"), (21, ""), (22, None), (None, "gamma gamma gamma"), (9, prose(3, 12)), (9, "delta eps delta")]
    texts = [*EDGES, *(" ".join(r.choice(few) for _ in range(30)) for _ in range(6)), *(prose(k, 60) for k in range(6))]
    for k, text in items[:5]:
        texts += [prose(50 + k, 30) + " " + text + " " + prose(60 + k, 20), text.upper(), " ".join(text.split()[3:14]), " ".join(text.split()[:9])]
    return texts, items


def test_against_brute_force(spark, case):
    texts, items = case
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in contamination_digests(documents(spark, texts), benchmark).collect()}
    assert got == brute(texts, items)
    assert any(v[4] for v in got.values()) and not all(v[4] for v in got.values())


def test_blocks_of_benchmark_and_small_pieces_change_nothing(spark, case, monkeypatch):
    texts, items = case
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in contamination_digests(documents(spark, texts), benchmark).collect()}
    assert got == brute(texts, items)


def test_proximity(spark):
    benchmark = spark.createDataFrame([(1, "one two three four")], "item_id BIGINT, text STRING")
    docs = documents(spark, ["one two x three four", "one two x y z three four", "zero one two three four five"])
    near = {r["doc_id"]: r["items"] for r in contamination(docs, benchmark, slack=1).collect()}
    assert near == {0: ["1"], 1: [], 2: ["1"]}
    exact = {r["doc_id"]: r["hits"] for r in contamination(docs, benchmark).collect()}
    assert exact == {0: [], 1: [], 2: [1, 2, 3, 4]}


def test_empty_tables_and_other_columns(spark):
    benchmark = spark.createDataFrame([], "item_id BIGINT, text STRING")
    docs = documents(spark, ["a b", None]).selectExpr("*", "1 AS hits", "2 AS n_words", "3 AS item_id")
    assert [r["n_hit"] for r in contamination_digests(docs, benchmark).collect()] == [0, 0]
    assert contamination_digests(docs.limit(0), benchmark).count() == 0
