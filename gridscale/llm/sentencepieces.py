"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

import codecs
import hashlib
import re
from functools import lru_cache
from heapq import heappop, heappush

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from gridscale.llm.text import batch, kept, over_batches

_SPACE = "▁"
#: Chunks whose codes a task remembers; the rarer ones are forgotten when it is full. Longer chunks hardly come twice.
REMEMBERED, LONGEST = 400_000, 48
#: Pairs of pieces whose compatibility a task remembers.
REMEMBERED_PAIRS = 500_000
_EACH_BYTE = "each-byte"
codecs.register_error(_EACH_BYTE, lambda e: ("\ufffd", e.start + 1))  # as the library does


class PieceCodec:
    """Encoder and decoder of one BPE model whose pieces hold no space after another character.

    In BPE the tokens of a prefix, up to the last one, are the tokens of a shorter prefix, so one
    table with the *last token* of every prefix stores all their encodings. The automaton lists the
    pieces that end at a position; of those the one piece is right that is compatible with the last
    token of the prefix before it: merging both side by side must not yield another result. Ids are
    then read from the table backwards.

    Texts are cut before each run of spaces, which no piece crosses. Chunks that begin with several
    spaces are merged step by step instead, because pieces of spaces share one score, so that their
    order also depends on the place in the text, which no table of pairs can hold.
    """

    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib, n = self.library, self.library.get_piece_size()
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) or lib.is_byte(i))]
        self.text = {i: lib.id_to_piece(i) for i in plain}
        self.id = {piece: i for i, piece in self.text.items()}
        if any(re.search(f"[^{_SPACE}]{_SPACE}", piece) for piece in self.id):
            raise ValueError("the model has pieces with a space after another character")
        self.score = {i: lib.get_score(i) for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.end = lib.eos_id()
        self.chunk = self._chunk_pattern()
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}
        self.length = [len(self.text.get(i, "")) for i in range(n)]
        self.known = _Remembered(self._coded)
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            if self._reached(i):
                self.automaton.add_word(self.text[i], i)
        self.automaton.make_automaton()

    def _chunk_pattern(self) -> re.Pattern:
        """Cuts before runs of spaces, and between letters and marks that no piece joins with a letter."""
        inside = {pair for piece in self.id for pair in zip(piece, piece[1:])}
        marks = "".join(re.escape(m) for m in map(chr, range(0x80)) if not m.isalnum()
                        and not any(m == a and b.isalnum() or m == b and a.isalnum() for a, b in inside))
        return re.compile(f"{_SPACE}*(?:[^\\W_]++(?=[{_SPACE}{marks}]|\\Z)|[{marks}]++(?=[^\\W_]|{_SPACE}|\\Z)|[^{_SPACE}]+)|{_SPACE}+")

    def _merged(self, symbols: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """Merge the best pair, the leftmost of equals, until none is left; also the last merge.

        Pairs wait in a heap, symbols are linked to their neighbours: n log n steps for n symbols."""
        symbols, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        last, waiting = None, []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n:
                piece = self.id.get(symbols[k] + symbols[after[k]])
                if piece is not None:
                    heappush(waiting, (-self.score[piece], k, len(symbols[k]), len(symbols[after[k]])))

        for k in range(n):
            offer(k)
        while waiting:
            _, k, own, other = heappop(waiting)
            right = after[k]
            # A pair is out of date once one of its symbols has grown or has become a part of another.
            if len(symbols[k]) != own or right >= n or len(symbols[right]) != other:
                continue
            last = symbols[k], symbols[right]
            symbols[k] += symbols[right]
            symbols[right] = ""
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [x for x in symbols if x], last

    def _reached(self, i: int) -> bool:
        """Whether merging yields this piece at all; notes the two pieces of its last merge."""
        symbols, last = self._merged(list(self.text[i]))
        self.parts[i] = last and (self.id[last[0]], self.id[last[1]])
        return len(symbols) == 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether pieces ``a`` and ``b`` side by side stay as they are.

        Undo the later of their merges again and again: if at some time a piece across the border would
        have been merged before the merge that was undone, they do not.
        """
        limit: tuple[float, int] | None = None  # what was undone last: score, and 1 if it lies right of the border
        while True:
            across = self.id.get(self.text[a] + self.text[b])
            if across is not None:
                score = self.score[across]
                # Equal scores are merged from the left: a merge right of the border comes after the crossing one.
                if limit is None or score > limit[0] or score == limit[0] and limit[1]:
                    return False
            left, right = self.parts[a], self.parts[b]
            if left is None and right is None:
                return True
            undo_left = right is None or left is not None and self.score[a] < self.score[b]
            if undo_left:
                limit, a = (self.score[a], 0), left[1]
            else:
                limit, b = (self.score[b], 1), right[0]

    def _ids(self, chunk: str) -> list[int]:
        if chunk.startswith(_SPACE * 2):
            return self._as_ids(self._merged(list(chunk))[0])
        last = [-1] * len(chunk)  # -1: a character without a piece
        length, fits = self.length, self.fits
        for end, i in self.automaton.iter(chunk):
            if last[end] >= 0:
                continue
            start = end - length[i]
            before = last[start] if start >= 0 else -1
            if before >= 0:
                pair = before << 32 | i
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) >= REMEMBERED_PAIRS:
                        fits.clear()
                    fit = fits[pair] = self.compatible(before, i)
                if not fit:
                    continue
            last[end] = i
        ids: list[int] = []
        at = len(chunk)
        while at:
            i = last[at - 1]
            if i == -1:
                ids.extend(self.bytes[b] for b in reversed(chunk[at - 1].encode()))
                at -= 1
            else:
                ids.append(i)
                at -= len(self.text[i])
        return ids[::-1]

    def _as_ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            out.extend([self.id[s]] if s in self.id else [self.bytes[b] for b in s.encode()])
        return out

    def _joined(self, ids: list[int]) -> str:
        """The pieces' texts, spaces still marked; bytes that form no character become U+FFFD."""
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            out += [_utf8(pending), self.text.get(i, "" if i in self.silent else " ⁇ ")]
            pending = bytearray()
        return "".join([*out, _utf8(pending)])

    def _coded(self, chunk: str) -> str | tuple[str, str]:
        """Ids, and what they show unless it is the chunk itself: one string for nearly every chunk, as many are remembered."""
        ids = self._ids(chunk)
        shown, ids = self._joined(ids), " ".join(map(str, ids))
        return ids if shown == chunk else (ids, shown)

    def _chunks(self, text: str) -> list[str]:
        return self.chunk.findall(_SPACE + text.replace(" ", _SPACE)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text with the end id; null is empty."""
        return [i for c in self._chunks(text or "") for i in self._ids(c)] + [self.end]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space put before a text is taken away again."""
        return self._shown(self._joined(ids))

    @staticmethod
    def _shown(marked: str) -> str:
        return marked.removeprefix(_SPACE).replace(_SPACE, " ")

    def summary(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids joined by a space, and the text decoded from them, end id included."""
        if not text:
            return 1, str(self.end), ""
        chunks = self._chunks(text)
        coded = list(map(self.known.__getitem__, chunks))
        ids = " ".join([*(x if type(x) is str else x[0] for x in coded), str(self.end)])
        return ids.count(" ") + 1, ids, self._shown("".join([c if type(x) is str else x[1] for c, x in zip(chunks, coded)]))


class _Remembered(dict):
    """Results by chunk. When half full they become the old ones, of which only those asked for again stay."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, chunk):
        if len(chunk) > LONGEST:
            return self.make(chunk)
        found = self.old.pop(chunk, None) or self.make(chunk)
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        self[chunk] = found
        return found


def _utf8(data: bytes) -> str:
    return bytes(data).decode("utf-8", errors=_EACH_BYTE) if data else ""


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    """One codec per model and Python worker."""
    return PieceCodec(model)


def encode_decode(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, decoded) of each row: ids with the end id, then the text that they decode to.

    Null and empty texts have the end id alone and decode to the empty text; equal rows are coded
    each; other columns are ignored.
    """
    source = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        own = codec(model)
        for rows in batches:
            ids = [own.encode(t) for t in rows["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows["id"], pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(i) for i in ids])],
                names=[id_column, "ids", "decoded"])

    return source.mapInArrow(run, f"`{id_column}` {kind}, ids ARRAY<INT>, decoded STRING")


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _digest_rows(rows, model):
    own = kept(PieceCodec, model)
    done = [own.summary(t) for t in rows["text"].to_pylist()]
    yield batch(_DIGESTS, rows["doc_id"], [d[0] for d in done],
                [hashlib.sha256(d[1].encode()).hexdigest() for d in done],
                [hashlib.sha256(d[2].encode()).hexdigest() for d in done])


def code_digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode_decode`` without carrying the ids."""
    source = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))

    return source.mapInArrow(over_batches(_digest_rows, model), "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING")
