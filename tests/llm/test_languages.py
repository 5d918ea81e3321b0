import random
import zlib

import numpy as np
from helpers import EDGES, documents

from gridscale.llm.languages import FEATURE_BITS, LENGTHS, fit_languages, held_out, languages, predict_languages, presence
from gridscale.llm.text import mixed, pieces
import pyarrow as pa

WORDS = {"en": "the of and that with from this which there where thing".split(), "de": "der die das und nicht über für schön straße ist".split(),
         "fr": "le la les et des élève être où garçon avec pour".split()}


def corpus(n, seed=1):
    r = random.Random(seed)
    langs = [r.choice(list(WORDS)) for _ in range(n)]
    return [" ".join(r.choice(WORDS[x]) for _ in range(r.randint(3, 60))) for x in langs], langs


def features(text):
    """The blended spectrum of one text by a plain loop."""
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in data)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    out = set()
    for n in LENGTHS:
        for k in range(len(data) - n + 1):
            code = np.array([int.from_bytes(data[k:k + n]) * (2 * n - 1) % 2**64], np.uint64)
            out.add(int(mixed(code)[0] >> np.uint64(64 - FEATURE_BITS)))
    return out


def test_presence_equals_a_loop():
    texts = [t or "" for t in EDGES] + corpus(10)[0]
    for _, _, data, offsets in pieces(pa.array(texts)):
        for row, text in zip(presence(data, offsets), texts, strict=True):
            assert set(np.flatnonzero(row)) == features(text)


def test_held_out_accuracy_and_edges(spark):
    texts, langs = corpus(300)
    docs = documents(spark, texts + EDGES, langs + [None] * len(EDGES)).selectExpr("*", "'de' AS lang_pred", "1 AS score")
    rows = {r["doc_id"]: r for r in languages(docs).collect()}
    assert len(rows) == 300 + len(EDGES)
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for k, r in rows.items())
    assert all(rows[k]["lang_pred"] == langs[k] for k in range(300) if rows[k]["held_out"])
    for k, text in enumerate(EDGES):
        has_letter = any(map(str.isalpha, text or ""))
        assert (rows[300 + k]["lang_pred"] == "und") == (not has_letter)


def test_only_the_text_counts_and_arrival_does_not(spark):
    texts, langs = corpus(120)
    docs = documents(spark, texts, langs)
    model = fit_languages(docs.where(~held_out()))
    again = fit_languages(docs.repartition(7).where(~held_out()))
    a = {r["doc_id"]: (r["lang_pred"], round(r["score"], 5)) for r in predict_languages(docs, model).collect()}
    b = {r["doc_id"]: (r["lang_pred"], round(r["score"], 5)) for r in predict_languages(docs.selectExpr("doc_id", "text", "'xx' AS lang"), again).collect()}
    assert a == b


def test_nothing_to_learn_and_nothing_to_predict(spark):
    docs = documents(spark, ["some text", None])
    assert {r["lang_pred"] for r in languages(docs).collect()} == {"und"}
    assert languages(docs.limit(0)).count() == 0
    one = documents(spark, ["one language", "two words", "three more words", "and four"], ["en"] * 4)
    assert {r["lang_pred"] for r in languages(one).collect()} <= {"en", "und"}


def test_margins_equal_plain_kernel_ridge_when_every_text_is_a_landmark(spark):
    texts, langs = corpus(60, 5)
    model = fit_languages(documents(spark, texts, langs), per_language=10_000, landmarks=10_000, ridge=1e-2)
    own = [features(t) for t in texts]

    def kernel(a, b):
        return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))

    names = sorted(set(langs))
    gram = np.array([[kernel(a, b) for b in own] for a in own])
    y = np.array([[1.0 if lang == n else -1.0 for n in names] for lang in langs])
    w = np.array([1 / langs.count(lang) / len(names) for lang in langs])
    n = len(texts)
    system = np.zeros((n + 1, n + 1))
    system[:n, :n], system[:n, n] = w[:, None] * gram + 1e-2 * np.eye(n), w
    system[n, :n], system[n, n] = w @ gram, w.sum()
    solved = np.linalg.solve(system, np.vstack([w[:, None] * y, w @ y]))
    unseen = corpus(15, 6)[0]
    want = np.array([[kernel(features(t), b) for b in own] for t in unseen]) @ solved[:n] + solved[n]
    for first, end, data, offsets in pieces(pa.array(unseen)):
        assert model.languages == names
        assert np.allclose(model.margins(presence(data, offsets)), want[first:end], atol=5e-3)
