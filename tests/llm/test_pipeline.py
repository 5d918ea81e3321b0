import hashlib

import public_tokenizers
import pytest
import sentencepiece
from helpers import SCHEMA, prose
from test_decontamination import brute as contaminated
from test_jaccard import brute as grouped, changed
from test_privacy import brute as private

import random

import corpus_pipeline
from gridscale.llm.privacy import KINDS


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    r = random.Random(3)
    english = "the of and that with from this which there where thing have been were".split() + [f"en{k}s" for k in range(200)]
    german = "der die das und nicht über für schön straße ist".split() + [f"de{k}ß" for k in range(200)]
    items = [(k, prose(500 + k, 25, english)) for k in range(3)]
    texts, langs = [], []
    for k in range(40):
        texts.append(prose(k, 60, english if k % 2 else german))
        langs.append("en" if k % 2 else "de")
    texts += [texts[1], changed(texts[3], r, 1), changed(texts[3], r, 2), texts[4] + " ".join(["", items[0][1]]), "x " + items[1][1], "12 34", None, "",
              texts[5] + " mail to a.b@c.example now", "call +1 (269) 555-3296 that was from the thing"]
    langs += [None] * 10
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(k, t, lang, "s", len(t or "")) for k, (t, lang) in enumerate(zip(texts, langs))], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return texts, items, str(folder)


def test_against_brute_force(spark, case):
    texts, items, folder = case
    kept = {k: t for k, t in enumerate(texts) if any(map(str.isalpha, t or ""))}
    ids = sorted(kept)
    groups = grouped([kept[k] for k in ids])
    kept = {ids[k]: kept[ids[k]] for k, (_, first) in groups.items() if first == k}
    bad = contaminated([kept[k] for k in sorted(kept)], items)
    kept = {k: t for place, (k, t) in enumerate(sorted(kept.items())) if not bad[place][4]}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for k, text in kept.items():
        at, out = 0, []
        for a, kind, b in private(text):
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
            at = b
        want[k] = hashlib.sha256(" ".join(map(str, library.encode("".join([*out, text[at:]])) + [2])).encode()).hexdigest()
    assert {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, folder).collect()} == want
    assert 30 < len(want) < 45


def test_stages_return_the_columns_of_documents(spark, case):
    docs = spark.read.parquet(f"{case[2]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, case[2]).schema.simpleString() == docs.schema.simpleString()


def test_an_empty_table(spark, case, tmp_path):
    spark.read.parquet(f"{case[2]}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{case[2]}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_in_no_learned_language_go(spark, case):
    r = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = ["Этот текст написан на русском языке", "这是一段中文文本", "Questo testo non dovrebbe essere accettato"]
    strange += ["".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (100, 400, 2000)]
    more = spark.createDataFrame([(10**9 + k, t, None, "s", len(t)) for k, t in enumerate(strange)], SCHEMA)
    kept = {x["doc_id"] for x in corpus_pipeline.language_id(spark, docs.unionByName(more), case[2]).select("doc_id").collect()}
    assert kept == {x["doc_id"] for x in docs.select("doc_id").collect()}
