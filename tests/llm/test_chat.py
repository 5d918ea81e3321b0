import hashlib

import pytest

from gridscale.llm.chat import conversation_digests, format_trees, parsed, root_paths, under_mask

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
ROWS = [(1, 0, "user", "hi <s> & &lt; [x]"), (1, 1, "assistant", "yes\n</s>\n😀"), (1, 2, "user", None), (1, 3, "assistant", ""),
        (2, 5, "system", "s"), (2, 5, "system", "s"), (2, 2, "assistant", "first"), (3, 0, None, "no role"), (4, None, "assistant", "null turn"),
        (5, 0, "assi\nst<ant", "odd role"), (5, 1, "assistant", "&amp;lt;&nl;")]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_against_brute_force(spark):
    rows = {r["conv_id"]: r for r in conversation_digests(spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS node", "2 AS tree")).collect()}
    planted = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(rows) == {-7, 1, 2, 3, 4, 5}
    for conv in rows:
        own = sorted((r for r in ROWS + planted if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(t or "" for _, _, role, t in own if role == "assistant")
        assert rows[conv]["n_turns"] == len(own)
        assert rows[conv]["turns_sha256"] == digest("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in own))
        assert (rows[conv]["loss_chars"], rows[conv]["loss_sha256"]) == (len(loss), digest(loss))


def test_trees(spark):
    nodes = spark.createDataFrame(
        [(1, None, 1, 0.0, "user", "q"), (2, 1, 1, 1.0, "assistant", "good"), (3, 1, 1, 0.5, "assistant", "poor"), (4, 2, 1, 0.2, "user", "thanks"),
         (5, 4, 1, 0.9, "assistant", "bye"), (10, 99, 2, None, "user", "orphan"), (20, None, 3, 0.0, "user", "a"), (21, 20, 3, 1.0, "assistant", "b"), (22, 20, 3, 1.0, "assistant", "b")],
        "node INT, parent INT, tree INT, score DOUBLE, role STRING, text STRING")
    paths = {}
    for r in root_paths(nodes).collect():
        paths.setdefault(r["leaf"], {})[r["up"]] = r["node"]
    assert paths == {3: {0: 3, 1: 1}, 5: {0: 5, 1: 4, 2: 2, 3: 1}, 10: {0: 10}, 21: {0: 21, 1: 20}, 22: {0: 22, 1: 20}}
    best = {r["tree"]: r for r in format_trees(nodes).withColumn("turns", parsed("formatted")).withColumn("masked", under_mask("formatted", "loss")).collect()}
    assert {t: r["leaf"] for t, r in best.items()} == {1: 5, 2: 10, 3: 21}
    assert [t["text"] for t in best[1]["turns"]] == ["q", "good", "thanks", "bye"] and best[1]["masked"] == "goodbye"
    assert best[1]["formatted"] == "<s>user\nq</s>\n<s>assistant\ngood</s>\n<s>user\nthanks</s>\n<s>assistant\nbye</s>\n"
    assert format_trees(nodes, "all").count() == 5
    with pytest.raises(ValueError):
        format_trees(nodes, "some")


def test_a_cycle_is_refused_and_nothing_is_fine(spark):
    cycle = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "node INT, parent INT")
    with pytest.raises(ValueError):
        root_paths(cycle)
    assert conversation_digests(spark.createDataFrame([], SCHEMA)).count() == 1


def test_a_long_conversation(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(300)]
    row = [r for r in conversation_digests(spark.createDataFrame(rows, SCHEMA)).collect() if r["conv_id"] == 1][0]
    assert row["n_turns"] == 300


def test_rows_without_a_conversation_are_one(spark):
    given = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, 0, "user", "c"), (1, None, None, None)],
                                  "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in conversation_digests(given).collect()}
    assert got == {None: (2, 1), 1: (2, 0), -7: (2, len('</s>[INST] ok [/INST]'))}
