"""Small document tables and the edge cases that every operator must take."""

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"

EDGES = [None, "", " ", "\n\n", "a", "ä", "😀 x", "\x00", "the " * 300, "same text twice", "same text twice", "▁ ▁▁", "x" * 5000]


def documents(spark, texts, langs=None):
    langs = langs or [None] * len(texts)
    rows = [(k, t, lang, "s", len(t or "")) for k, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n_words, vocabulary="the of and in it rest on nd here there then that shall we see it all again".split()):
    r = random.Random(seed)
    return " ".join(r.choice(vocabulary) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n_words))


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
