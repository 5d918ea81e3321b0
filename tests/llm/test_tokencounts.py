import hashlib

import numpy as np
import public_tokenizers
import pytest
from helpers import EDGES, documents, prose

from gridscale.llm.tokencounts import SECTION_END, allocate, encoding, section_starts, section_tokens, token_spans, token_totals

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [*EDGES, prose(1, 80), "Straße. Über\n\n\n  Ärger! é😀😀. ok", "a.\n\n\n b", "...   ...", "  lead. Then  \n", "😀😀😀.😀 😀\n😀"]


def brute(text, rule):
    """Walk the tokens one by one and count the characters they share with each section."""
    text = text or ""
    coder, _ = encoding(RANKS, PATTERN)
    starts = [0] if text else []
    for m in SECTION_END.finditer(text):
        if m.end() < len(text):
            starts.append(m.end())
    section_of = {}
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(text)])):
        section_of |= dict.fromkeys(range(a, b), k)
    owner_of_byte = [c for c, ch in enumerate(text) for _ in ch.encode()]
    tokens, crossing, at = [0] * len(starts), [0] * len(starts), 0
    for piece in coder.decode_tokens_bytes(coder.encode_ordinary(text)):
        touched = sorted(set(owner_of_byte[at:at + len(piece)]))
        at += len(piece)
        share = {}
        for c in touched:
            share[section_of[c]] = share.get(section_of[c], 0) + 1
        k = {"most": min(share, key=lambda s: (-share[s], s)), "first": min(share), "last": max(share)}[rule]
        tokens[k] += 1
        crossing[k] += len(share) > 1
    return tokens, crossing


@pytest.mark.parametrize("rule", ["most", "first", "last"])
def test_sections_against_brute_force(spark, rule):
    docs = documents(spark, TEXTS).selectExpr("*", "1 AS section", "2 AS n_tokens")
    got = {}
    for r in section_tokens(docs, RANKS, PATTERN, rule).collect():
        got.setdefault(r["doc_id"], []).append((r["section"], r["n_tokens"], r["n_crossing"], r["start"], r["end"]))
    for k, text in enumerate(TEXTS):
        rows = sorted(got.get(k, []))
        tokens, crossing = brute(text, rule)
        assert ([r[1] for r in rows], [r[2] for r in rows]) == (tokens, crossing), text
        assert "".join((text or "")[r[3]:r[4]] for r in rows) == (text or "")
    assert any(any(brute(t, rule)[1]) for t in TEXTS)


def test_totals(spark):
    coder, _ = encoding(RANKS, PATTERN)
    docs = documents(spark, TEXTS)
    for r in token_totals(docs, RANKS, PATTERN).collect():
        text = TEXTS[r["doc_id"]] or ""
        tokens, crossing = brute(text, "most")
        assert r["n_tokens"] == len(coder.encode_ordinary(text)) == sum(tokens)
        assert (r["n_sections"], r["n_crossing"], r["largest_section"]) == (len(tokens), sum(crossing), max(tokens, default=0))
        assert r["section_tokens_sha256"] == hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest()
    assert token_totals(docs.limit(0), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        token_totals(docs, RANKS, PATTERN, "none")


def test_ties_go_to_the_earlier_section():
    chosen, crossing = allocate(np.array([0, 4]), np.array([4, 10]), np.array([0, 2, 6, 8]))
    assert chosen.tolist() == [0, 1] and crossing.tolist() == [True, True]
    assert section_starts("a. b").tolist() == [0, 3]
    assert [x.tolist() for x in token_spans("é", np.array([0, 1]), np.array([1, 1]))] == [[0, 0], [1, 1]]
