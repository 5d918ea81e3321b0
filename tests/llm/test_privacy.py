import hashlib
import math
import random
import re

import pytest
from helpers import EDGES, documents, prose

from gridscale.llm.privacy import (
    _FOUND_SQL,
    _found_rows,
    _named,
    CHANCE_BITS,
    KINDS,
    Z,
    base_spans,
    disclosures,
    entity,
    private_spans,
    sanitise,
    sanitised,
    span_digests,
    words_of,
)
from gridscale.llm.text import over_batches

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        total = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != 3 or 10 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if valid(k, m[0]))


CASES = [*EDGES, "x a.b@c.de, é +1 (269) 555-3296 4111 1111 1111 1111 and 4111-1111-1111-1112", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3", "a@b.c_d@e.f",
         "@@a@b a@b.c@d.e a@.b.c a@b..c a@b.c.", "+49 30 1234567 +1+23456789012 +(1) +1234567890123456", "4" * 25, "0" * 4000 + ".1.2.3", "1" * 3000, "%" * 3000 + "@", "a@" * 50 + "b.c"]


def test_base_spans_equal_the_patterns():
    r = random.Random(4)
    for alphabet in ("ab@.-_1 ", "0123456789. -", "+0123() .-", "4 1-2.@a+é"):
        for _ in range(3000):
            text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
            assert base_spans(text) == brute(text), text
    for text in CASES:
        assert base_spans(text) == brute(text), text[:80]


def test_digests(spark):
    docs = documents(spark, CASES).selectExpr("*", "1 AS spans", "2 AS n_email", "3 AS uid", "4 AS terms")
    rows = {r["doc_id"]: r for r in span_digests(private_spans(docs)).collect()}
    assert len(rows) == len(CASES)
    for k, text in enumerate(CASES):
        found = brute(text)
        shown = ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in found)
        assert rows[k]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [rows[k][f"n_{n}"] for n in KINDS] == [sum(f[1] == i for f in found) for i in range(4)]
        assert rows[k]["spans"] == shown  # no term is seen in two texts with an entity here


def planted():
    """One address that is always near the same odd word, in different contexts, and that word nowhere else."""
    some = [prose(k, 40) for k in range(60)]
    telling = [f"{prose(200 + k, 6)} Zorblatt writes from ana@mail.example {prose(300 + k, 6)}" for k in range(5)]
    copied = [prose(999, 9) + " Quixel sells at bob@mail.example now"] * 6
    return some + telling + copied


def test_revealing_terms(spark):
    texts = planted()
    rows = {r["doc_id"]: r for r in span_digests(private_spans(documents(spark, texts))).collect()}
    for k, text in enumerate(texts):
        at = text.find("Zorblatt")
        terms = [s for s in rows[k]["spans"].split(",") if s.startswith("term")]
        assert (f"term:{at}:{at + 8}" in terms) == (at >= 0), text
        assert "Quixel" not in text or not terms  # six copies are one context
        words = [text[int(a):int(b)] for _, a, b in (t.split(":") for t in terms)]
        assert set(words) <= {"Zorblatt", "writes", "from"}


def test_sanitised_texts(spark):
    texts = planted() + [None, "", "call +1 (269) 555-3296 or a@b.cd"]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in sanitise(docs).collect()}
    assert sanitise(docs).schema == docs.schema and len(rows) == len(texts)
    assert rows[len(texts) - 1]["text"] == "call [PHONE] or [EMAIL]" and rows[len(texts) - 1]["n_chars"] == len("call [PHONE] or [EMAIL]")
    assert rows[len(texts) - 3]["text"] is None and rows[len(texts) - 2]["text"] == ""
    assert all(rows[k]["text"] == texts[k] for k in range(60))
    assert not any("Zorblatt" in (r["text"] or "") or "@" in (r["text"] or "") for r in rows.values())
    assert sanitise(docs.limit(0)).count() == 0
    twice = sanitise(docs.unionByName(docs))
    assert twice.count() == 2 * len(texts)


def test_overlapping_spans():
    base = [{"start": 0, "kind": 2, "end": 6}, {"start": 4, "kind": 3, "end": 8}]
    assert sanitised("123456789", base, []) == "[CARD]9"
    assert sanitised("ab Cd 12 e", [], [{"start": 3, "end": 5, "removed": False}, {"start": 6, "end": 8, "removed": False}, {"start": 0, "end": 2, "removed": True}]) == " [NAME] [NUMBER] e"


def rare(n):
    """Many texts, and three addresses with a word of their own: in one text, in two, and in copies of one."""
    return [*(f"{prose(k, 12)} no{k // 2}" for k in range(n)), "the Wibble of wib@mail.example and", "then Grumbel it gru@mail.example in",
            "nd Grumbel here it gru@mail.example rest", *["that Quixel sells bob@mail.example again"] * 40]


def test_two_texts_are_enough_and_one_is_not(spark):
    """In one text every word is alone with the address, so none of them says more than another; copies are one text."""
    texts = rare(1500)
    rows = {r["doc_id"]: r["spans"] for r in span_digests(private_spans(documents(spark, texts))).collect()}
    for k, text in enumerate(texts):
        words = [text[int(a):int(b)] for s in rows[k].split(",") if s.startswith("term") for _, a, b in [s.split(":")]]
        assert words == re.findall("Grumbel", text), text


def by_hand(texts):
    """{(entity, term): (n_et, n_t, n_e, n)} over different texts."""
    texts = set(filter(None, texts))
    with_term, with_entity = {}, {}
    for t in texts:
        spans = base_spans(t)
        for w in {w for w, _, _ in words_of(t)} if spans else {w.lower() for w in re.findall(r"[^\W_]+", t)}:
            with_term.setdefault(w, set()).add(t)
        for a, kind, b in spans:
            with_entity.setdefault(entity(kind, t[a:b]), set()).add(t)
    return {(e, w): (len(own & x), len(x), len(own), len(texts)) for e, own in with_entity.items() for w, x in with_term.items() if own & x}


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8])
def test_disclosures_by_hand(spark, least):
    r = random.Random(8)
    names = [f"name{k}" for k in range(12)]
    texts = [" ".join(r.choice(names) for _ in range(4)) + f" {prose(k, 8)}" + (f" a{k % 5}@mail.example name{k % 5}x" if k % 3 == 0 else "") for k in range(240)]
    texts += texts[:30] + [None, ""]
    docs = documents(spark, texts)
    found = _named(docs).mapInArrow(over_batches(_found_rows), _FOUND_SQL)
    got = {(x["entity"], x["term"]): x["disclosure"] for x in disclosures(found, docs, least).collect()}
    want = {}
    for key, (n_et, n_t, n_e, n) in by_hand(texts).items():
        share, base = n_et / n_t, n_e / n
        low = (share + Z * Z / (2 * n_t) - Z * math.sqrt(share * (1 - share) / n_t + Z * Z / (4 * n_t * n_t))) / (1 + Z * Z / n_t)
        bits = n_t * (share * math.log2(share / base) + ((1 - share) * math.log2((1 - share) / (1 - base)) if share < 1 else 0))
        if low >= least and share > base and bits >= CHANCE_BITS:
            want[key] = low
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and want


def test_a_larger_corpus_discloses_no_more(spark):
    """The same texts among 200 or 4,000 others: the same terms with the same scores, and other texts stay as they are."""
    own = [f"{prose(700 + k, 5)} Zorblatt zor@mail.example once{k}" for k in range(6)] + ["Zorblatt was here", f"only1 {prose(1, 4)} x@mail.example"]
    seen = []
    for n in (200, 4000):
        docs = documents(spark, own + [f"{prose(k, 12)} word{k}" for k in range(n)])
        found = _named(docs).mapInArrow(over_batches(_found_rows), _FOUND_SQL)
        seen.append({(x["entity"], x["term"], round(x["disclosure"], 9)) for x in disclosures(found, docs, 0.5).collect()})
        changed = {x["doc_id"] for x in private_spans(docs).where("size(base) + size(terms) > 0").collect()}
        assert changed == set(range(8))  # "Zorblatt was here" has no address, and is found by its name
    assert seen[0] == seen[1] and {t for _, t, _ in seen[0]} == {"zorblatt"}


def test_terms_go_wherever_they_are(spark):
    """A telling name far from the address, in texts without the address, and names of one and two characters."""
    far = " ".join(["the of and in it"] * 60)
    texts = [prose(k, 12) for k in range(1500)]
    texts += [f"{prose(2000 + k, 5)} Zorblatt {far} {k} zor@mail.example {far} zorblatt" for k in range(20)] + ["Zorblatt here", f"then {far} ZORBLATT"]
    texts += [f"{prose(3000 + k, 5)} 李 {far} li@mail.example {far} 王五" for k in range(3)]
    rows = {r["doc_id"]: r["spans"] for r in span_digests(private_spans(documents(spark, texts))).collect()}
    for k, text in enumerate(texts):
        words = [text[int(a):int(b)] for s in rows[k].split(",") if s.startswith("term") for _, a, b in [s.split(":")]]
        assert [w for w in words if not w.isdigit()] == re.findall("zorblatt(?!@)|李|王五", text, re.I), text
    clean = [r["text"] for r in sanitise(documents(spark, texts)).collect()]
    assert not any(re.search("zorblatt|李|王五", t, re.I) for t in clean)


def test_words_beside_entities():
    for text in ["call +1 (269) 555-3296x or a@b.cd, _c a@b.cde é", "a@b.cd", "x 1.2.3.4.5 6", ""]:
        spans = base_spans(text)
        want = [m.span() for m in re.finditer(r"[^\W_]+", text) if all(m.end() < a or b < m.start() for a, _, b in spans)]
        assert [(a, b) for _, a, b in words_of(text)] == want
