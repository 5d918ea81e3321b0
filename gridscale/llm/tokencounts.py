"""Token counts per section of a document, from one encoding of the whole text."""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import batch, over_batches

#: A section ends with the white space after a sentence, or with the white space that begins at a line break.
SECTION_END = re.compile(r"[.!?]+\s+|\n\s*")
RULES = ("most", "first", "last")


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The tokenizer of a rank file, and the bytes of each token; once per Python worker."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(table.values()) + 1, np.int64)
    for token, rank in table.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={}), sizes


def section_starts(text: str) -> np.ndarray:
    """First character of each section; the first section starts at 0."""
    return np.array([0, *(e for e in (m.end() for m in SECTION_END.finditer(text)) if e < len(text))], np.int64)


def token_spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters [start, end) that each token touches; tokens within one character share it."""
    end = np.cumsum(sizes[ids])
    start = end - sizes[ids]
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) == len(text):
        return start, end
    character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
    return character[start], character[end - 1] + 1


def allocate(start: np.ndarray, end: np.ndarray, sections: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary).

    Tokens and sections are both in order, so the interval join is a search of starts and ends. A token
    that crosses goes whole to the section with ``most`` of its characters, the earlier of equals, or
    to the ``first`` or ``last`` one that it touches.
    """
    first = np.searchsorted(sections, start, side="right") - 1
    last = np.searchsorted(sections, end - 1, side="right") - 1
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    chosen = first.copy()
    for t in np.flatnonzero(crossing):
        edges = np.concatenate([[start[t]], sections[first[t] + 1:last[t] + 1], [end[t]]])
        chosen[t] = first[t] + int(np.argmax(np.diff(edges)))
    return chosen, crossing


def _encoded(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    return np.array(coder.encode_ordinary(text), np.int64)


_SECTIONS = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])


def _counted(text: str | None, ranks: str, pattern: str, rule: str):
    """Starts of the sections, tokens of each, and crossing tokens given to each."""
    text = text or ""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    coder, sizes = encoding(ranks, pattern)
    starts = section_starts(text)
    chosen, crossing = allocate(*token_spans(text, _encoded(coder, text), sizes), starts, rule)
    return starts, np.bincount(chosen, minlength=len(starts)), np.bincount(chosen[crossing], minlength=len(starts))


def _section_rows(rows, ranks, pattern, rule):
    out = [[] for _ in _SECTIONS]
    for doc, text in zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()):
        starts, tokens, crossing = _counted(text, ranks, pattern, rule)
        ends = [*starts[1:].tolist(), len(text or "")][:len(starts)]
        for column, values in zip(out, ([doc] * len(starts), range(len(starts)), starts.tolist(), ends, tokens.tolist(), crossing.tolist())):
            column.extend(values)
        if len(out[0]) > 20_000:
            yield batch(_SECTIONS, *out)
            out = [[] for _ in _SECTIONS]
    yield batch(_SECTIONS, *out)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def section_tokens(docs: DataFrame, ranks: str, pattern: str, rule: str = "most") -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing) for each section of each row.

    The counts of a document's sections add up to the tokens of its whole text, which encoding the sections
    one by one would not. Null and empty texts have no sections; repeated rows are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    return _texts(docs).mapInArrow(over_batches(_section_rows, ranks, pattern, rule),
                                   "doc_id BIGINT, section INT, start INT, end INT, n_tokens BIGINT, n_crossing BIGINT")


_TOTALS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_sections", pa.int64()), ("n_crossing", pa.int64()),
                     ("largest_section", pa.int64()), ("section_tokens_sha256", pa.string())])


def _total_rows(rows, ranks, pattern, rule):
    out = [[] for _ in list(_TOTALS)[1:]]
    for text in rows["text"].to_pylist():
        _, tokens, crossing = _counted(text, ranks, pattern, rule)
        joined = ",".join(map(str, tokens.tolist()))
        for column, value in zip(out, (int(tokens.sum()), len(tokens), int(crossing.sum()), int(tokens.max(initial=0)), hashlib.sha256(joined.encode()).hexdigest())):
            column.append(value)
    yield batch(_TOTALS, rows["doc_id"], *out)


def token_totals(docs: DataFrame, ranks: str, pattern: str, rule: str = "most") -> DataFrame:
    """One row per document: all tokens, sections, crossing tokens, the largest section's tokens, and a digest of the
    sections' counts in order. Null and empty texts have no tokens and no sections."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    return _texts(docs).mapInArrow(over_batches(_total_rows, ranks, pattern, rule),
                                   "doc_id BIGINT, n_tokens BIGINT, n_sections BIGINT, n_crossing BIGINT, largest_section BIGINT, section_tokens_sha256 STRING")
