import random
import re
import zlib
from collections import Counter

import pytest
from helpers import EDGES, SCHEMA, documents

from gridscale.llm import spelling
from gridscale.llm.spelling import document_variants, near_words, roots, spelling_variants, word_counts


def counted(rows, least=7, drop_every=31):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


COLUMNS = ["n", "n_near", "form", "form_n", "root"]


def found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in COLUMNS) for r in rows}


def vocabulary(seed, n, letters="abé", least=1, most=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(least, most))): r.choice([2, 3, 20, 25, 300, 4000]) for _ in range(n)}


def table(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word STRING, n LONG")


@pytest.mark.parametrize("tile", [1024, 7])
def test_near_words_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    words = vocabulary(1, 700) | vocabulary(2, 100, "aβ😀", 1, 6) | vocabulary(3, 60, "ab", 60, 62) | {"x": 5, "": 3}
    assert found(spelling_variants(table(spark, words))) == brute(words)


def test_words_of_documents(spark):
    r = random.Random(4)
    pool = ["wonderful", "wonderfull", "ÀÉÎõü÷×z", "Understand", "café-noiré", "straße12ABCDEFG", "seventh", "letters8"]
    texts = [*EDGES, *(" ".join(r.choice(pool) + r.choice(["", "é", "s", ".", "ÿ", "中"]) for _ in range(60)) for _ in range(300)),
             "Abcdefgh" * 5000, "Abcdefgh" * 5000, "é" * 70 + " " + "é" * 70]
    docs = documents(spark, texts).repartition(6)
    want = counted(enumerate(texts))
    got = {row["word"]: row["n"] for row in word_counts(docs, drop_every=31).collect()}
    assert got == want
    assert found(document_variants(docs)) == brute(want)
    plain = {row["word"]: row["n"] for row in word_counts(docs, least_points=3, least_count=1).collect()}
    assert plain == {w: k for w, k in Counter(
        "".join(c.lower() if "A" <= c <= "Z" else c for c in w) for t in texts for w in re.findall("[A-Za-zÀ-ÿ]+", t or "")).items() if len(w) >= 3}


def test_pieces_do_not_change_words(spark, monkeypatch):
    texts = [f"repeated {'words ' * k}repeatedly" for k in range(50)]
    rows = list(enumerate(texts))
    got = {r["word"]: r["n"] for r in word_counts(documents(spark, texts), drop_every=31).collect()}
    assert got == counted(rows)


def test_roots_of_long_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(19)]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain, "word STRING, form STRING")).collect()}
    assert got == {f"w{k}": "w19" for k in range(19)}


def test_null_and_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "lettered lettered"), (None, "lettered lettered"), (1, None)], "doc_id BIGINT, text STRING")
    docs = docs.selectExpr("*", "'x' AS word", "1 AS n", "2 AS best")
    assert found(document_variants(docs)) == brute(counted([(None, "lettered lettered")] * 2 + [(1, None)]))
    words = spark.createDataFrame([("abc", 1), ("abc", 2), (None, 4), ("abd", None), ("abcd", 40)], "word STRING, n LONG")
    assert found(spelling_variants(words.selectExpr("*", "1 AS key", "2 AS cut", "3 AS gid"))) == brute({"abc": 3, "abcd": 40})


def test_empty_tables(spark):
    assert document_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_words(spark.createDataFrame([], "word STRING, n LONG")).count() == 0
