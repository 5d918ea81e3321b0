"""Personal data: patterns, and terms that reveal them by how often both occur together."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import batch, over_batches, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number's start is the start of its digits, and possessive digits never give one back: no retry within a run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")

#: Telling terms are looked for by this many bits of their checksum before they are joined.
TERM_BITS = 24
#: Shares of texts are taken at their lower bound, which nine of ten samples exceed.
Z = 1.28
#: What would happen by chance once in 2^10 terms is no disclosure.
CHANCE_BITS = 10


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base entities, by start, then kind."""
    if not text:
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
    out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and _is_card(m[0])]
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def entity(kind: int, value: str) -> str:
    """One name for all spellings of a value."""
    return f"{KINDS[kind]}:{value.lower() if kind == 0 else _digits(value) if kind > 1 else value}"


def words_of(text: str) -> list[tuple[str, int, int]]:
    """(term, start, end) of all words but those in an entity or glued to one, which are a part of its spelling."""
    found = base_spans(text)
    if not found:
        return [(m[0].lower(), *m.span()) for m in _WORD.finditer(text)]
    out, at, end = [], 0, -1
    for m in _WORD.finditer(text):
        x, y = m.span()
        while at < len(found) and found[at][0] <= y:
            end = max(end, found[at][2])
            at += 1
        # Entities that start at the word's end or before it: it is clear of them if it starts behind their ends.
        if x > end:
            out.append((m[0].lower(), x, y))
    return out


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("copy", pa.int64()), ("spans", pa.list_(_SPAN)), ("entities", pa.list_(pa.string()))])
_FOUND_SQL = "doc_id BIGINT, uid BIGINT, copy BIGINT, spans ARRAY<STRUCT<start:INT,kind:INT,end:INT>>, entities ARRAY<STRING>"


def _found_rows(rows):
    spans, entities = [], []
    for text in rows["text"].to_pylist():
        found = base_spans(text)
        spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
        entities.append(sorted({entity(k, text[a:b]) for a, k, b in found}))
    yield batch(_FOUND, rows["doc_id"], rows["uid"], rows["copy"], spans, entities)


_COUNTS = pa.schema([("term", pa.string()), ("n", pa.int64()), ("copy", pa.int64())])


def _term_counts(batches):
    """Numbers of texts by term; for texts with an entity one row per term, with the text's hash."""
    counts: Counter[str] = Counter()
    for rows in batches:
        for text, copy in zip(rows["text"].to_pylist(), rows["copy"].to_pylist()):
            if text and base_spans(text):
                terms = list({t for t, _, _ in words_of(text)})
                yield batch(_COUNTS, terms, [1] * len(terms), [copy] * len(terms))
            elif text:
                counts.update({w.lower() for w in set(_WORD.findall(text))})
            if len(counts) >= 500_000:
                yield batch(_COUNTS, list(counts), list(counts.values()), [None] * len(counts))
                counts.clear()
    yield batch(_COUNTS, list(counts), list(counts.values()), [None] * len(counts))


def _named(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("uid"),
                       F.xxhash64(text).alias("copy"), text.alias("text"))


def _distinct_texts(source: DataFrame, found: DataFrame) -> DataFrame:
    """One row of each text; only texts that occur more than once are shuffled, as long as their hashes can be broadcast."""
    copied = stored(found.groupBy("copy").count().where("count > 1").select("copy"))
    texts = source.select("copy", "text")
    return texts.join(copied, "copy", "left_anti").unionByName(texts.join(copied, "copy", "left_semi").dropDuplicates(["copy"]))


def lower_share(k: Column, n: Column, z: float = Z) -> Column:
    """Wilson's lower bound of the share that ``k`` of ``n`` stand for: 1 of 1 is little, 20 of 20 nearly all."""
    share = k / n
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def disclosures(found: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """(entity, term, disclosure) of all terms in a text with an entity, near it or not, that disclose ``least`` or more.

    Of an entity's information, log2(n / n_e) bits if n_e of n texts have it, a term gives away the pointwise mutual information
    log2(n_et n / (n_e n_t)), so -log2(n_et / n_t) bits are left to whoever knows the term. The disclosure is the share n_et / n_t
    behind these bits, at its lower bound: 1 text of 1 is worth 0.38, 2 of 2 0.55, 10 of 10 0.86, in a corpus of any
    size. A term must also be found with the entity more often than chance explains: the divergence of that share
    from the base rate n_e / n, over all n_t texts, is ``CHANCE_BITS`` or more. Counts are of different texts, over the whole
    corpus: copies count once, so a word is not taken for revealing because its text was copied; near copies count each.
    """
    terms = stored(_distinct_texts(_named(docs), found).select("copy", "text").mapInArrow(_term_counts, "term STRING, n BIGINT, copy BIGINT"))
    totals = stored(terms.groupBy("term").agg(F.sum("n").alias("n_t")))
    owners = found.select("copy", F.explode("entities").alias("entity")).distinct()
    owners = stored(owners.join(owners.groupBy("entity").agg(F.count("*").alias("n_e")), "entity"))
    n = max(1, found.select("copy").distinct().count())
    most = owners.agg(F.max("n_e")).first()[0] or 1
    # The bound is below n_e / n_t, so more texts than this put a term below ``least``, whatever else is known.
    rare = lambda n_e: 1.001 * n_e / least if least > 0 else F.lit(float("inf"))
    # Terms of every 200th text are few and would be the hot keys of the join; those that may still tell stay.
    common = totals.where((F.col("n_t") > rare(most)) & (F.col("n_t") > n / 200)).select("term")
    held = terms.where("copy IS NOT NULL").select("copy", "term").join(F.broadcast(common), "term", "left_anti").join(totals, "term")
    pairs = held.join(owners, "copy").where(F.col("n_t") <= rare(F.col("n_e"))).groupBy("entity", "term").agg(
        F.count("*").alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    told, base = F.least("n_et", "n_t"), F.col("n_e") / F.lit(n)
    share = told / F.col("n_t")
    missing = F.when(share < 1, (1 - share) * F.log2((1 - share) / (1 - base))).otherwise(0.0)
    # An entity that is in every text has no information left to give away.
    apart = F.when((base < 1) & (share > base), F.col("n_t") * (share * F.log2(share / base) + missing)).otherwise(0.0)
    return pairs.withColumn("disclosure", lower_share(told, F.col("n_t"))).where((F.col("disclosure") >= least) & (apart >= CHANCE_BITS)).select(
        "entity", "term", "disclosure")


_PLACES = pa.schema([("uid", pa.int64()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _places(rows, bits: np.ndarray):
    """All occurrences of the terms whose bit is set."""
    known: dict[str, bool] = {}
    uids, terms, starts, ends = [], [], [], []
    for uid, text in zip(rows["uid"].to_pylist(), rows["text"].to_pylist()):
        here = set()
        for w in set(_WORD.findall(text or "")):
            hit = known.get(w)
            if hit is None:
                at = zlib.crc32(w.lower().encode()) & ((1 << TERM_BITS) - 1)
                hit = known[w] = bool(bits[at >> 3] >> (at & 7) & 1)
            if hit:
                here.add(w.lower())
        for term, x, y in words_of(text) if here else ():
            if term in here:
                uids.append(uid)
                terms.append(term)
                starts.append(x)
                ends.append(y)
    yield batch(_PLACES, uids, terms, starts, ends)


def _bits_of(terms: DataFrame) -> np.ndarray | None:
    """2 MB whatever the number of terms; none if there is no term."""
    at = terms.select((F.crc32(F.col("term").cast("binary")) % (1 << TERM_BITS)).cast("int").alias("at")).distinct().toArrow()["at"].to_numpy()
    if not len(at):
        return None
    bits = np.zeros(1 << TERM_BITS, bool)
    bits[at] = True
    return np.packbits(bits, bitorder="little")


def private_spans(docs: DataFrame, generalise: float = 0.5, remove: float = 0.75) -> DataFrame:
    """(doc_id, uid, base, terms) of each row of ``docs``.

    ``base``: spans of e-mail addresses, IP addresses, card and phone numbers. ``terms``: spans of all words of the
    corpus, in texts with an entity or without, whose term's disclosure of any entity reaches ``generalise``; from ``remove`` on
    they are marked for removal. ``uid`` is a hash of id and text, so equal rows share it and their result. Null and empty
    texts have no spans.
    """
    source = _named(docs)
    found = stored(source.mapInArrow(over_batches(_found_rows), _FOUND_SQL))
    telling = stored(disclosures(found, docs, generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure")))
    nothing = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    columns = ["doc_id", "uid", F.col("spans").alias("base")]
    bits = _bits_of(telling)
    if bits is None:
        return found.select(*columns, nothing.alias("terms"))
    places = source.select("uid", "text").mapInArrow(over_batches(_places, bits), "uid BIGINT, term STRING, start INT, end INT")
    marked = places.join(telling, "term").groupBy("uid").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", (F.col("disclosure") >= remove).alias("removed")))).alias("terms"))
    return found.join(marked, "uid", "left").select(*columns, F.coalesce("terms", nothing).alias("terms"))


def _labels(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def _number_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def span_digests(spans: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as text."""
    base = F.transform("base", lambda s: F.concat_ws(":", _labels(s["kind"]), s["start"], s["end"]))
    both = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))))
    names = F.array(*map(F.lit, [*KINDS, TERM]))
    shown = F.transform(both, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return spans.select(
        "doc_id", *(_number_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(shown, ",").alias("spans"))


def _generalised(word: str) -> str:
    return "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitised(text: str | None, base: list[dict], terms: list[dict]) -> str | None:
    """The text with base entities replaced by their kind, revealing terms generalised to a class or removed.
    Of overlapping spans the first one, then the longer one, is replaced; what sticks out of the others goes too."""
    if not text or not base and not terms:
        return text
    spans = [(s["start"], -s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base]
    spans += [(s["start"], -s["end"], "" if s["removed"] else _generalised(text[s["start"]:s["end"]])) for s in terms]
    out, at = [], 0
    for start, end, label in sorted(spans):
        if start >= at:
            out += [text[at:start], label]
        at = max(at, -end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with their texts sanitised, all columns kept; ``n_chars`` follows the text where it is there. Only the spans of
    rows that have any are joined to the texts."""
    spans = stored(private_spans(docs, **options).where("size(base) + size(terms) > 0").dropDuplicates(["uid"]))
    text = F.col("text").cast("string")
    rows = docs.withColumn("__uid", F.xxhash64(F.col("doc_id").cast("bigint"), text)).join(
        spans.select(F.col("uid").alias("__uid"), F.col("base").alias("__base"), F.col("terms").alias("__terms")), "__uid", "left")
    names = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for b in batches:
            new = [sanitised(t, x or [], y or []) for t, x, y in zip(b["text"].to_pylist(), b["__base"].to_pylist(), b["__terms"].to_pylist())]
            columns = []
            for name in names:
                if name == "text":
                    columns.append(pa.array(new, pa.string()))
                elif name == "n_chars":
                    columns.append(pa.array([n if t is None else len(t) for n, t in zip(b["n_chars"].to_pylist(), new)], b["n_chars"].type))
                else:
                    columns.append(b[name])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*names, "__base", "__terms").mapInArrow(run, kinds)
