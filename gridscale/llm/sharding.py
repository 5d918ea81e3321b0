"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from functools import reduce

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridscale.llm.text import stored

#: Rows of one rank group: ranks are counted within groups of about this size and the groups' totals are added up.
RANK_GROUP = 5_000
RING = 1 << 63
#: 4096 cells of equal size find a position's arc by an equi-join.
CELL_SHIFT = 51


def ring(n_shards: int, virtual_nodes: int = 128) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, clockwise, on a ring of 2^63 positions."""
    return sorted((xxhash.xxh64_intdigest(f"{shard}/{node}") >> 1, shard)
                  for shard in range(n_shards) for node in range(virtual_nodes))


def clockwise(nodes: list[tuple[int, int]]) -> list[list[int]]:
    """For each virtual node the shards in the order in which a key landing there meets them."""
    out: list[list[int]] = [[] for _ in nodes]
    for k in range(len(nodes)):
        out[k] = list(dict.fromkeys(nodes[(k + j) % len(nodes)][1] for j in range(len(nodes))))
    return out


def capacities(n_rows: int, n_shards: int, slack: float = 0.0) -> list[int]:
    """The most rows of each shard: with no slack the floor or ceiling of the mean, adding up to ``n_rows``;
    otherwise the ceiling of (1 + slack) times the mean."""
    if slack > 0:
        return [-int(-n_rows * (1 + slack) // n_shards)] * n_shards
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def _segments(spark: SparkSession, nodes: list[tuple[int, int]]) -> DataFrame:
    """(cell, low, high, arc): the arcs of the ring, cut at the borders of equal cells."""
    rows, low = [], 0
    stops = [p for p, _ in nodes] + [RING - 1]
    for k, stop in enumerate(stops):
        arc = k % len(nodes)
        while low <= stop:
            cell = low >> CELL_SHIFT
            high = min(stop, ((cell + 1) << CELL_SHIFT) - 1)
            rows.append((cell, low, high, arc))
            low = high + 1
    return spark.createDataFrame(rows, "cell BIGINT, low BIGINT, high BIGINT, arc INT")


def _ranked(rows: DataFrame, by: str, groups: int, name: str) -> DataFrame:
    """Adds the gapless rank of ``priority`` within ``by``, from 0.

    Priorities are hashes, so equal parts of their range hold about as many rows: ranks are counted in each
    part and the parts before are added, which no task does for a whole shard.
    """
    rows = rows.withColumn("part", F.shiftright(F.shiftright("priority", 43) * F.lit(groups), 20))
    totals = rows.groupBy(by, "part").agg(F.count("*").alias("rows_here"))
    before = totals.select(by, "part", (F.sum("rows_here").over(Window.partitionBy(by).orderBy("part")) - F.col("rows_here")).alias("rows_before"))
    here = F.row_number().over(Window.partitionBy(by, "part").orderBy("priority", "doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("rank_here", here).join(before, [by, "part"]).withColumn(
        name, F.col("rows_before") + F.col("rank_here")).drop("part", "rank_here", "rows_before")


def bounded_shards(keys: DataFrame, n_shards: int, virtual_nodes: int = 128, slack: float = 0.0) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless from 0 in each shard) to rows of (doc_id, size, text_crc32).

    A row lands on the ring by a hash of its key and belongs to the next virtual node clockwise. A shard takes
    rows by priority (another hash) up to its capacity; the others go on to the next shard on
    their way round and stay there if it has room, and so on. After as many rounds as there are shards every row
    has a place, because the capacities add up to the number of rows or more and a full shard stays full.
    Only rows that overflow move, so a change of load moves few.

    The key is ``doc_id``; rows with equal or null ids are told apart by their other columns, and rows equal in
    all columns are interchangeable. The driver holds one count per shard.
    """
    nodes = ring(n_shards, virtual_nodes)
    ways = clockwise(nodes)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    position = F.shiftrightunsigned(F.xxhash64(key, "text_crc32", "size"), 1)
    rows = keys.select("doc_id", "size", "text_crc32", position.alias("position"), F.shiftright(position, CELL_SHIFT).alias("cell"),
                       F.shiftrightunsigned(F.xxhash64(F.lit("priority"), key, "text_crc32", "size"), 1).alias("priority"))
    spark = keys.sparkSession
    # The sizes of both small tables are set by the parameters alone.
    segments = F.broadcast(_segments(spark, nodes))
    steps = F.broadcast(spark.createDataFrame([(a, s, k) for a, w in enumerate(ways) for k, s in enumerate(w)], "arc INT, shard INT, step INT"))
    waiting = stored(rows.join(segments, "cell").where("position BETWEEN low AND high").drop("cell", "position", "low", "high"))
    n_rows = waiting.count()
    groups = max(1, min(1 << 20, n_rows // n_shards // RANK_GROUP + 1))
    room = capacities(n_rows, n_shards, slack)
    placed = []
    for step in range(n_shards):
        free = F.broadcast(spark.createDataFrame(list(enumerate(room)), "shard INT, free BIGINT"))
        tried = waiting.join(steps.where(F.col("step") == step).drop("step"), "arc")
        tried = stored(_ranked(tried, "shard", groups, "rank").join(free, "shard"))
        taken = tried.where("rank < free").drop("rank", "free")
        for shard, count in taken.groupBy("shard").count().collect():
            room[shard] -= count
        placed.append(taken)
        waiting = tried.where("rank >= free").drop("rank", "free", "shard")
        if waiting.isEmpty():
            break
    done = reduce(DataFrame.unionByName, placed)
    return _ranked(done, "shard", groups, "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Rows of ``docs`` in shards whose numbers of rows are at most one apart (law ``rows``).

    Size: UTF-8 bytes of the text plus 1; a null text has no bytes and the checksum of the empty text.
    Texts that are equal may be in different shards: a group may be larger than a shard.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    keys = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    return bounded_shards(keys, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
