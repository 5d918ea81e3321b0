"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridscale.llm.chat import conversation_digests
from gridscale.llm.decontamination import contamination_digests
from gridscale.llm.jaccard import jaccard_components
from gridscale.llm.languages import languages
from gridscale.llm.lines import line_digests
from gridscale.llm.privacy import private_spans, span_digests
from gridscale.llm.quality import quality_verdicts
from gridscale.llm.sentencepieces import code_digests
from gridscale.llm.sharding import shard_documents
from gridscale.llm.spelling import document_variants
from gridscale.llm.suffixes import repeat_digests
from gridscale.llm.text import table
from gridscale.llm.tokencounts import section_tokens
from gridscale.llm.vectorcodes import code_digests as vector_code_digests


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return languages(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and the trees' verdict of every document."""
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return code_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets have a similarity of 0.8 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shard_documents(table(spark, sf_dir, "documents"), 8)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, read back from its formatted form."""
    return conversation_digests(table(spark, sf_dir, "conversations"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie within a window of a benchmark item."""
    return contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every section of every document, and of those the ones that cross its border."""
    return section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that occur twice."""
    return repeat_digests(table(spark, sf_dir, "documents"))


def op10_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms in every document."""
    return span_digests(private_spans(table(spark, sf_dir, "documents")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, and the common form of each rare one."""
    return document_variants(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector and how far it is from the vector."""
    return vector_code_digests(table(spark, sf_dir, "embeddings"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that ten documents share."""
    return line_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard": op4_jaccard,
    "op5_sharding": op5_sharding,
    "op6_chat": op6_chat,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_privacy": op10_privacy,
    "op11_spelling": op11_spelling,
    "op12_vector_codes": op12_vector_codes,
    "op13_line_dedup": op13_line_dedup,
}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _word_lists(table_name: str, key: str, pattern: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}') AS w FROM {table_name}")


def _assigned(book: str) -> str:
    """For every part of every vector the nearest entry of a codebook, the lower of equals."""
    return f"""SELECT vec_id, p, v, best['e'] AS e, best['d'] AS d FROM (
    SELECT vec_id, p, v, min({{'d': list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT, 'e': e}}) AS best
    FROM parts JOIN {book} USING (p) GROUP BY vec_id, p, v)"""


def _moved(book: str, assigned: str) -> str:
    """The codebook after its entries went to the floor of the mean of their parts."""
    return f"""SELECT p, e, coalesce(m, c) AS c FROM {book} LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS m FROM (
      SELECT p, e, i, floor(sum(x) / count(*))::BIGINT AS x
      FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM {assigned}) GROUP BY p, e, i)
    GROUP BY p, e) USING (p, e)"""


#: Checksums of words, language models, trees, token codes, hash rings, byte windows and matches of patterns in order have no SQL form; the tests hold those
#: queries against brute force.
ORACLES: dict[str, str] = {
    "op4_jaccard": rf"""WITH RECURSIVE docs AS ({_word_lists('documents', 'doc_id', r'[^\x20\x09-\x0D]+')}),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reached(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
FROM (SELECT a AS doc_id, min(b) AS c FROM reached GROUP BY a) LEFT JOIN sizes USING (doc_id)""",
    "op6_chat": r"""WITH everything AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
given AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM everything),
escaped AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsb;') AS etext,
         replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsb;'), chr(10), '&nl;') AS erole FROM given)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(erole) + length(etext) + 9)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op7_decontamination": rf"""WITH docs AS ({_word_lists('documents', 'doc_id', r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')}),
items AS ({_word_lists('benchmark', 'item_id', r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')}),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
found AS (
  SELECT doc_id, i, k, item_id
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k) d
  JOIN windows USING (k) WHERE array_to_string(w[i:i + k - 1], ' ') = g),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    "op12_vector_codes": f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM (SELECT vec_id, v, unnest(range(16)) AS p FROM kept)),
book0 AS MATERIALIZED (
  SELECT p, e, v AS c FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
assigned0 AS MATERIALIZED ({_assigned("book0")}),
book1 AS MATERIALIZED ({_moved("book0", "assigned0")}),
assigned1 AS MATERIALIZED ({_assigned("book1")}),
book2 AS MATERIALIZED ({_moved("book1", "assigned1")}),
assigned2 AS MATERIALIZED ({_assigned("book2")}),
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM assigned2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)""",
    "op13_line_dedup": rf"""WITH split AS MATERIALIZED (
  SELECT doc, doc_id, unnest(l) AS line, unnest(range(len(l))) AS k
  FROM (SELECT row_number() OVER () AS doc, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS MATERIALIZED (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM split),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.key = c.key GROUP BY doc, doc_id""",
}
