import hashlib
import random
from collections import defaultdict

import pytest
from helpers import EDGES, SCHEMA, documents

from gridscale.llm.lines import bitmap_lines, line_digests, line_keeps, without_lines

SPACE = " \t\n\v\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(texts, least=10, points=1, first=False):
    """(n_lines, n_dropped, text) by row; ``first`` keeps the first line of the first document."""
    having = defaultdict(set)
    for k, text in enumerate(texts):
        for line in (text or "").split("\n"):
            having[key(line)].add(k)
    out = []
    for k, text in enumerate(texts):
        kept, lines, seen = [], (text or "").split("\n"), set()
        for line in lines:
            own = key(line)
            gone = len(own) >= points and len(having[own]) >= least
            if gone and first and min(having[own]) == k and own not in seen:
                gone = False
            seen.add(own)
            if not gone:
                kept.append(line)
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    pool = [f"line {k} of the pool" for k in range(40)] + ["", "  ", "Ä", "ä", "x", "X ", "\tx\r", " x", "\x00", "😀"]
    made = ["\n".join(r.choice(pool[:8 + 2 * (k % 21)]) for _ in range(r.randint(0, 12))) for k in range(400)]
    return [*EDGES, *made, *("Read more\n" + t + "\n  read MORE  " for t in made[:150]), "long line " * 20000 + "\nx"]


@pytest.mark.parametrize(("least", "points", "first"), [(10, 1, False), (3, 2, False), (10, 1, True), (2, 3, True), (1, 1, False)])
def test_against_brute_force(spark, texts, least, points, first):
    docs = documents(spark, texts).repartition(7)
    keeps = line_keeps(docs, least, points, "first" if first else "none")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in without_lines(docs, keeps).collect()}
    assert got == dict(enumerate(brute(texts, least, points, first)))


def test_keys_over_many_ranges(spark, texts):
    """One line in every document, and so many ranges that it spans most of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", 61)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        given = ["everywhere\n" + (t or "") for t in texts]
        for first in (False, True):
            docs = documents(spark, given)
            keeps = line_keeps(docs, 12, 1, "first" if first else "none")
            got = {r["doc_id"]: r["text"] for r in without_lines(docs, keeps).collect()}
            assert got == {k: t for k, (_, _, t) in enumerate(brute(given, 12, 1, first))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_digests_and_bitmaps(spark, texts):
    docs = documents(spark, texts)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in line_digests(docs).collect()}
    want = brute(texts)
    assert got == {k: (n, d, hashlib.sha256(t.encode()).hexdigest()) for k, (n, d, t) in enumerate(want)}
    for r in line_keeps(docs).collect():
        bits = bitmap_lines(r["keep"], r["n_lines"])
        assert len(bits) == r["n_lines"] and (~bits).sum() == r["n_dropped"] == want[r["doc_id"]][1]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(7, "a\nb", "x")] * 9 + [(None, "a\nc", "x"), (None, "a\nd", "x"), (None, None, "x"), (8, "e", "x")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, uid STRING").selectExpr("*", "1 AS hash", "2 AS lines", "3 AS n_lines", "4 AS keep")
    got = sorted((str(r["doc_id"]), r["text"]) for r in without_lines(docs, line_keeps(docs, 10)).collect())
    assert got == sorted([("7", "b")] * 9 + [("None", "c"), ("None", "d"), ("None", ""), ("8", "e")])
    first = sorted((str(r["doc_id"]), r["text"]) for r in without_lines(docs, line_keeps(docs, 10, keep="first")).collect())
    assert len(first) == len(rows) and sum("a" in t for _, t in first) in (1, 9)  # equal rows share one bitmap
    assert line_digests(docs).count() == len(rows)


def test_empty_table_and_bad_parameters(spark):
    assert line_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        line_keeps(spark.createDataFrame([], SCHEMA), keep="last")
