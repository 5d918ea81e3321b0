"""A training corpus from raw documents: stages that each call one operator of ``gridscale.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscale.llm.decontamination import contamination
from gridscale.llm.jaccard import jaccard_components
from gridscale.llm.languages import fit_languages, held_out, keep_languages
from gridscale.llm.privacy import sanitise
from gridscale.llm.sentencepieces import code_digests
from gridscale.llm.text import stored, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: A long text whose score is not this part of the way from the lowest score to 1 is claimed by no language. On sf0.01,
#: held-out rows claim 0.25 or more, random letters and unseen languages below 0.1.
LEAST_CLAIM = 0.15


#: Rows of an Arrow batch: texts are long, and a batch is held by Spark and by Python at once, several times over.
BATCH_ROWS = 1_000


def _short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row, from id and text: rows without an id and different texts of one id are told apart."""
    return docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _as_ids(keyed: DataFrame) -> DataFrame:
    """Texts under their rows' keys, for operators that name rows by ``doc_id``."""
    return keyed.select(F.col("__row").alias("doc_id"), "text")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages learned from those not held out; texts without letters or in no learned
    language go."""
    _short_batches(spark)
    return keep_languages(docs, fit_languages(docs.where(~held_out())), LEAST_CLAIM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that of the smallest id (null is larger than any), and of rows equal in
    id and text one."""
    _short_batches(spark)
    keyed = _keyed(docs)
    groups = jaccard_components(_as_ids(keyed)).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("group"))
    named = keyed.select("__row", "doc_id").join(groups.distinct(), "__row")
    kept = named.groupBy("group").agg(F.min_by("__row", F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("__row")).select("__row")
    return keyed.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a passage of the benchmark."""
    _short_batches(spark)
    keyed = _keyed(docs)
    hit = contamination(_as_ids(keyed), table(spark, sf_dir, "benchmark")).where("size(hits) > 0").select(F.col("doc_id").alias("__row")).distinct()
    return keyed.join(stored(hit), "__row", "left_anti").select(docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, its personal data and the terms that reveal them replaced."""
    _short_batches(spark)
    return sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as digests."""
    _short_batches(spark)
    return code_digests(docs, MODEL)


STAGES = [
    ("language id", language_id),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("pii", private_data),
    ("sentencepiece", encode),
]

#: The stages learn a model, follow links and count co-occurrences over whole texts, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
