import hashlib
import random
import time

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import EDGES, documents

from gridscale.llm import sentencepieces, text as shared
from gridscale.llm.sentencepieces import PieceCodec, code_digests, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(MODEL)


def texts(n, alphabet, longest, seed):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("alphabet", ["  \n\tabthe▁éﬁ㎏😀\x00éinon  . ,<s></s>", "abcdeinorst ", "()[]{};:.,'\"/<>=+-*&% \\", "  　ab", "0123456789. -"])
def test_ids_and_decoding_equal_the_library(codec, library, alphabet):
    for text in texts(2500, alphabet, 30, 1):
        ids = codec.encode(text)
        assert ids == library.encode(text) + [library.eos_id()], text
        assert codec.decode(ids) == library.decode(ids), text
        count, joined, decoded = codec.summary(text)
        assert (count, joined, decoded) == (len(ids), " ".join(map(str, ids)), library.decode(ids))


def test_any_ids_decode_as_in_the_library(codec, library):
    r = random.Random(3)
    for _ in range(3000):
        ids = [r.choice([0, 1, 2, r.randint(3, 260), r.randint(259, 31999)]) for _ in range(r.randint(0, 8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_forgetting_changes_nothing(codec, monkeypatch):
    import gridscale.llm.sentencepieces as module

    text = " ".join(texts(300, "abcde", 5, 4))
    whole = codec.summary(text)
    monkeypatch.setattr(module, "REMEMBERED", 8)
    assert PieceCodec(MODEL).summary(text) == whole


def test_rows(spark, library):
    docs = documents(spark, EDGES)
    rows = {r["doc_id"]: r for r in code_digests(docs, MODEL).collect()}
    assert len(rows) == len(EDGES)
    for k, text in enumerate(EDGES):
        ids = library.encode(text or "") + [2]
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    full = {r["doc_id"]: r for r in encode_decode(docs, MODEL).collect()}
    assert full[4]["ids"] == library.encode("a") + [2] and full[0]["ids"] == [2] and full[0]["decoded"] == ""


def test_empty_table_and_null_ids(spark):
    docs = documents(spark, ["a", "b"])
    assert code_digests(docs.limit(0), MODEL).count() == 0
    assert code_digests(docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "'x' AS ids_sha256"), MODEL).count() == 2


def test_very_long_runs_of_spaces_and_symbols(library, codec):
    for text in ("a" + " " * 100_000 + "b", "x" + " " * 777 + "y" + "=" * 5000, " " * 3001, "─" * 2000 + " " * 17 + "a b"):
        start = time.perf_counter()
        assert codec.encode(text) == library.encode(text) + [library.eos_id()]
        assert time.perf_counter() - start < 5


def test_a_worker_lets_go_of_the_codec_when_it_turns_to_other_work():
    """Workers outlive stages: chunks remembered for one stage stayed beside the data of all stages after it."""
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "some words"}], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    shared._kept.clear()
    coding = shared.over_batches(sentencepieces._digest_rows, MODEL)
    assert [list(coding([batch])), list(coding([batch]))] and len([k for k in shared._kept if k != "work"]) == 1
    own = shared.kept(sentencepieces.PieceCodec, MODEL)
    assert own is shared.kept(sentencepieces.PieceCodec, MODEL) and own.known
    list(shared.over_batches(lambda rows: iter([rows]))([batch]))
    assert [k for k in shared._kept if k != "work"] == []


def test_a_remembered_chunk_is_one_string_unless_it_shows_another():
    own = sentencepieces.PieceCodec(MODEL)
    for words in ("plain words again and again", "\x00 \ufffd 😀 ▁ ▁▁ a", "  two  spaces "):
        ids = own.encode(words)
        for _ in range(2):  # made, then remembered
            assert own.summary(words) == (len(ids), " ".join(map(str, ids)), own.decode(ids))
    assert type(own.known["▁words"]) is str
