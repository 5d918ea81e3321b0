import zlib

from helpers import EDGES, documents, prose

from gridscale.llm import sharding
from gridscale.llm.sharding import bounded_shards, capacities, clockwise, ring, shard_documents


def brute(rows, spark, n_shards, slack=0.0):
    """Place keys one by one in the rounds that the docstring states; positions and priorities come from Spark."""
    nodes = ring(n_shards)
    ways = clockwise(nodes)
    places = [p for p, _ in nodes]
    keys = spark.createDataFrame(rows, "doc_id BIGINT, size BIGINT, text_crc32 BIGINT").selectExpr(
        "doc_id", "shiftrightunsigned(xxhash64(cast(doc_id as string), text_crc32, size), 1) AS p",
        "shiftrightunsigned(xxhash64('priority', cast(doc_id as string), text_crc32, size), 1) AS q").collect()
    room = capacities(len(keys), n_shards, slack)
    waiting, out = [(r["q"], r["doc_id"], next((k for k, p in enumerate(places) if p >= r["p"]), 0)) for r in keys], {}
    for step in range(n_shards):
        rest = []
        for q, doc, arc in sorted(waiting):
            shard = ways[arc][step]
            if room[shard]:
                room[shard] -= 1
                out[doc] = shard
            else:
                rest.append((q, doc, arc))
        waiting = rest
    assert not waiting
    return out


def test_against_brute_force_with_any_rank_groups(spark, monkeypatch):
    rows = [(k, 10 + k % 7, k * 977 % 5003) for k in range(700)]
    keys = spark.createDataFrame(rows, "doc_id BIGINT, size BIGINT, text_crc32 BIGINT")
    for group, slack in ((5000, 0.0), (10, 0.0), (5000, 0.05)):
        monkeypatch.setattr(sharding, "RANK_GROUP", group)
        got = bounded_shards(keys, 5, slack=slack).collect()
        assert {r["doc_id"]: r["shard"] for r in got} == brute(rows, spark, 5, slack)
        for s in range(5):
            own = sorted(r["slot"] for r in got if r["shard"] == s)
            assert own == list(range(len(own)))


def test_documents(spark):
    texts = [*EDGES, *(prose(k, 20) for k in range(90))]
    docs = documents(spark, texts).selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS arc")
    rows = {r["doc_id"]: r for r in shard_documents(docs).collect()}
    assert len(rows) == len(texts)
    counts = [sum(r["shard"] == s for r in rows.values()) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for k, text in enumerate(texts):
        data = (text or "").encode()
        assert (rows[k]["size"], rows[k]["text_crc32"], rows[k]["law"], rows[k]["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert {k: r["shard"] for k, r in rows.items()} == {r["doc_id"]: r["shard"] for r in shard_documents(docs.repartition(5)).collect()}


def test_few_empty_repeated_and_null_rows(spark):
    docs = documents(spark, ["a", "b", "c"])
    assert shard_documents(docs.limit(0)).count() == 0
    assert shard_documents(docs).count() == 3
    same = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'x' AS text").unionByName(docs.selectExpr("1L AS doc_id", "text"))
    rows = shard_documents(same.unionByName(same)).collect()
    assert len(rows) == 12 and len({(r["shard"], r["slot"]) for r in rows}) == 12


def test_one_more_shard_moves_few(spark):
    keys = spark.range(4000).selectExpr("id AS doc_id", "1L AS size", "0L AS text_crc32")
    a = {r["doc_id"]: r["shard"] for r in bounded_shards(keys, 8, slack=0.1).collect()}
    b = {r["doc_id"]: r["shard"] for r in bounded_shards(keys, 9, slack=0.1).collect()}
    assert sum(a[k] != b[k] for k in a) < 4000 * 0.3
