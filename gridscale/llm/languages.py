"""Language identification with string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import LOWER, batch, byte_set, mixed, over_batches, pieces, stored

#: Byte n-grams of these lengths make up the blended spectrum.
LENGTHS = (2, 3, 4)
#: n-grams are held as this many hashed features.
FEATURE_BITS = 16
UNDETERMINED = "und"

_ASCII_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
_SPELLED = byte_set((0x61, 0x7A), (0x80, 0xFF))  # after lower-casing
_ROWS = 64


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """texts x features: whether an n-gram of the feature occurs. All but letters counts as one space."""
    n, width = len(offsets) - 1, 1 << FEATURE_BITS
    out = np.zeros((n, width), bool)
    data = LOWER[data]
    data = np.where(_SPELLED[data], data, np.uint8(0x20))
    keep = np.ones(len(data), bool)  # runs of spaces shrink to one
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    starts = offsets[:-1][offsets[:-1] < len(data)]
    keep[starts] = True
    owner = np.repeat(np.arange(n), np.diff(offsets))[keep]
    data = data[keep].astype(np.uint64)
    code = data.copy()
    flat = out.reshape(-1)
    for k in range(1, max(LENGTHS)):
        if len(data) <= k:
            break
        code = code[:-1] << np.uint64(8) | data[k:]
        if k + 1 in LENGTHS:
            inside = owner[:-k] == owner[k:]
            feature = (mixed(code * np.uint64(2 * k + 1)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
            flat[(owner[:-k] * width + feature)[inside]] = True
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    columns: np.ndarray    # features that any landmark has
    landmarks: np.ndarray  # columns x landmarks, scaled by the landmarks' self-similarity
    weights: np.ndarray    # landmarks x languages: Nyström map and ridge solution in one
    bias: np.ndarray

    def margins(self, present: np.ndarray) -> np.ndarray:
        """texts x languages by two matrix products: similarities to the landmarks, then their weights."""
        return _similarities(present, self.columns, self.landmarks) @ self.weights + self.bias


def _similarities(present: np.ndarray, columns: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(present.sum(axis=1), 1)).astype(np.float32)
    return (present[:, columns].astype(np.float32) @ landmarks) / size[:, None]


def _training_rows(docs: DataFrame, per_language: int, max_rows: int) -> DataFrame:
    """(lang, grams): packed presence bits of about ``per_language`` documents of each language, fewer if ``max_rows`` asks for it."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = stored(known.groupBy("lang").count())
    each = min(per_language, max_rows / max(counts.count(), 1))
    share = counts.select("lang", (F.lit(each) / F.col("count") * (1 << 30)).cast("bigint").alias("below"))
    chosen = known.join(share, "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("below"))
    return chosen.select("lang", "text").mapInArrow(over_batches(_packed), "lang STRING, grams BINARY")


_GRAMS = pa.schema([("lang", pa.string()), ("grams", pa.binary())])


def _packed(rows):
    for first, end, data, offsets in pieces(rows["text"], 1 << 18):
        for k in range(0, end - first, _ROWS):
            o = offsets[k:k + _ROWS + 1]
            bits = np.packbits(presence(data[o[0]:o[-1]], o - o[0]), axis=1)
            yield batch(_GRAMS, rows["lang"][first + k:first + k + len(bits)], [b.tobytes() for b in bits])


def fit_languages(docs: DataFrame, per_language: int = 500, max_rows: int = 32_000, landmarks: int = 96,
                  ridge: float = 1e-2) -> LanguageModel:
    """A model from a bounded sample of labelled rows: about ``per_language`` documents, chosen by a hash, of each
    label, and of all labels together about ``max_rows``. Their presence bits (8 KB a document, whatever the
    length of its text) come to the driver.

    The kernel is the number of n-grams that two texts share, over the square root of the product of
    their own numbers. Landmarks are dealt evenly to the languages; Nyström's map takes a text to its
    similarities with them, whitened by their own matrix; a ridge regression to 1 and -1 per language
    follows, rows weighted so that each language counts alike.
    """
    rows = _training_rows(docs, per_language, max_rows).toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    if not languages:
        nothing = np.zeros((0, 0), np.float32)
        return LanguageModel([], np.zeros(0, np.int64), nothing, nothing, np.zeros(0))
    lang, grams = np.array(rows["lang"].to_pylist()), rows["grams"].to_pylist()
    order = np.lexsort([np.array(grams), lang])  # the order of arrival must not matter
    lang = lang[order]
    packed = np.frombuffer(b"".join(grams[i] for i in order), np.uint8).reshape(len(order), -1)
    each = max(1, landmarks // len(languages))
    rng = np.random.default_rng(7)
    pick = np.concatenate([rng.permutation(np.flatnonzero(lang == one))[:each] for one in languages])
    marks = np.unpackbits(packed[pick], axis=1).astype(bool)
    columns = np.flatnonzero(marks.any(axis=0))
    scaled = (marks / np.sqrt(np.maximum(marks.sum(axis=1), 1))[:, None]).astype(np.float32)[:, columns].T.copy()
    own = _similarities(marks, columns, scaled).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    solid = values > 1e-6 * values.max()
    whiten = vectors[:, solid] / np.sqrt(values[solid])
    phi = np.concatenate([_similarities(np.unpackbits(packed[k:k + _ROWS], axis=1).astype(bool), columns, scaled)
                          for k in range(0, len(packed), _ROWS)]).astype(np.float64) @ whiten
    target = np.where(lang[:, None] == np.array(languages)[None], 1.0, -1.0)
    counts = np.array([(lang == one).sum() for one in languages])
    weight = (1 / counts)[np.searchsorted(languages, lang)] / len(languages)
    mean, middle = weight @ phi, weight @ target
    centred = phi - mean
    solved = np.linalg.solve(centred.T @ (centred * weight[:, None]) + ridge * np.eye(phi.shape[1]) * weight.sum(),
                             centred.T @ ((target - middle) * weight[:, None]))
    return LanguageModel(languages, columns, scaled, (whiten @ solved).astype(np.float32), middle - mean @ solved)


_LANG = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _named_scores(texts: pa.Array, model: LanguageModel) -> tuple[list[str], list[float]]:
    named, scores = [], []
    for first, end, data, offsets in pieces(texts, 1 << 18):
        ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
        spelled = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
        for k in np.flatnonzero(~spelled):
            spelled[k] = any(map(str.isalpha, texts[first + int(k)].as_py() or ""))
        for k in range(0, end - first, _ROWS):
            o = offsets[k:k + _ROWS + 1]
            some = spelled[k:k + _ROWS]
            if not model.languages:
                named += [None] * len(some)
                scores += [0.0] * len(some)
                continue
            margins = model.margins(presence(data[o[0]:o[-1]], o - o[0]))
            best = margins.argmax(axis=1)
            named += [model.languages[b] if s else None for b, s in zip(best, some)]
            scores += np.where(some, np.clip(0.5 + 0.5 * margins.max(axis=1), 0, 1), 0.0).tolist()
    return [n if n is not None else UNDETERMINED for n in named], scores


def _predict(rows, model: LanguageModel):
    yield batch(_LANG, rows["doc_id"], *_named_scores(rows["text"], model))


def keep_languages(docs: DataFrame, model: LanguageModel, least_claim: float = 0.0, half_bytes: int = 8) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a language of the model; one pass, nothing is shuffled.

    Margins of L languages sum to 2 - L, so no score is below 1 / L; a text's claim is how far its score goes from there to 1. Texts without
    letters go, and those whose claim is below ``least_claim`` * b / (b + ``half_bytes``) for b bytes of text: what few
    n-grams say is weak in any language. A single language has nothing to be held against and claims every text with letters.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    lowest = 1 / len(model.languages) if model.languages else 1.0

    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            texts = rows["text"].cast(pa.string())
            named, scores = _named_scores(texts, model)
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(float)
            claim = (np.array(scores) - lowest) / (1 - lowest) if lowest < 1 else np.full(len(scores), 1.0)
            kept = (np.array(named) != UNDETERMINED) & (claim >= least_claim * size / (size + half_bytes))
            yield rows.filter(pa.array(kept))

    return docs.mapInArrow(run, kinds)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) per row, from the whole text alone.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. The score is the best
    margin, moved from -1..1 to 0..1.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(over_batches(_predict, model), "doc_id BIGINT, lang_pred STRING, score DOUBLE")


def held_out(doc_id: str = "doc_id"):
    """Documents that are not learned from; a null id is never learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn from the documents not held out, predict all."""
    model = fit_languages(docs.where(~held_out()))
    return predict_languages(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
