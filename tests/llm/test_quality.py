import re
from collections import Counter

import numpy as np
from helpers import EDGES, documents, prose

from gridscale.llm.quality import COUNTS, FEATURES, fit_trees, document_statistics, quality_verdicts


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    often, hit = Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            hit |= set(range(k, k + 8))
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit)


TEXTS = [*EDGES, *(prose(k, 40 + 30 * k) for k in range(8)), "a b c\n\n a b c\na b c\n", "\n".join([prose(1, 12)] * 3), "#$ | x\r\n y\x0b\x0cz\x1d",
         prose(2, 30) + " " + prose(2, 30), "word " * 19, "é ü\n" * 11]


def test_counts_against_brute_force(spark):
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in document_statistics(documents(spark, TEXTS)).collect()}
    assert got == {k: brute(t) for k, t in enumerate(TEXTS)}


def test_verdicts_follow_labels_and_base_rules(spark):
    good, bad = [prose(k, 80, [f"w{i}" for i in range(400)]) for k in range(150)], [prose(k, 80, ["#x|", "$y", "%"]) for k in range(150)]
    docs = documents(spark, good + bad + TEXTS)
    labels = spark.createDataFrame([*((k, int(k < 150), 0) for k in range(300) if k % 3), (None, 1, 0), (5, None, 0), (7, 1, None)], "doc_id BIGINT, quality INT, toxic INT")
    rows = {r["doc_id"]: r for r in quality_verdicts(docs, labels).collect()}
    assert len(rows) == 300 + len(TEXTS)
    for r in rows.values():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert sum(rows[k]["kept"] for k in range(150)) == 150
    assert not any(rows[k]["kept"] for k in range(150, 300))


def test_no_labels_and_no_documents(spark):
    docs = documents(spark, [prose(1, 50), None])
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert {r["doc_id"]: r["kept"] for r in quality_verdicts(docs, labels).collect()} == {0: True, 1: False}
    assert quality_verdicts(docs.limit(0), labels).count() == 0


def test_trees_hold_the_directions_and_the_flat_arrays_equal_a_walk():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 3))
    y = (np.sin(2 * x[:, 0]) - x[:, 1] + 0.3 * r.normal(size=3000) > 0).astype(float)
    trees = fit_trees(x, y, [-1, -1, 0], n_trees=40)
    rising = np.linspace(-3, 3, 200)
    for f in (0, 1):
        for row in x[:50]:
            line = np.repeat(row[None], 200, 0)
            line[:, f] = rising
            assert (np.diff(trees.score(line)) <= 1e-12).all()
    for row in x[:50]:
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert abs(trees.score(row[None])[0] - 1 / (1 + np.exp(-total))) < 1e-9
    free = fit_trees(x, y, [0, 0, 0], n_trees=40)
    assert ((free.score(x) > 0.5) == y).mean() > 0.9


def test_feature_names_match_the_matrix(spark):
    row = document_statistics(documents(spark, ["A b!"])).first()
    assert len(row["features"]) == len(FEATURES)
