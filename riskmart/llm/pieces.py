"""SentencePiece encoding by suffix-array matching, and decoding.

The distinct words of a batch are concatenated and indexed by a suffix array. A binary search of every vocabulary piece
gives its occurrence range; each occurrence is an edge over the characters it covers. Edges are sorted by position and
relaxed from left to right. The model is a byte-pair model, so an edge is taken if the encoder would leave its piece
beside the piece that ends where it starts: of the edges that end at one place exactly one is, and following them back
gives the ids the reference encoder gives.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .suffixes import rank_by_doubling

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
GAP = 0x110000  # stands between words; no character has this number
CACHED_WORDS = 350_000
CACHED_PAIRS = 300_000
SLICE = 512  # rows that are encoded and decoded together
SLICE_CHARACTERS = 1 << 22  # of texts whose new words are collected
BATCH_CHARACTERS = 1 << 18  # of words that are indexed together
_WORD = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n|[^{BLANK}\n]+")  # no piece crosses a word start or a line break


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def plain_pieces(model) -> list[bytes]:
    """What each id decodes to."""
    plain = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            plain.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            plain.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
        else:
            plain.append(name.replace(BLANK, " ").encode())
    return plain


class Vocabulary:
    """Pieces and scores of a byte-pair model with byte fallback. Unknown characters have the id ``size`` + code point."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(self.size)]
        names = [model.id_to_piece(i) for i in range(self.size)]
        self.ids = {names[i]: i for i in range(self.size) if not special[i] and not model.is_byte(i)}
        if any(BLANK in name.lstrip(BLANK) or "\n" in name for name in self.ids):
            raise ValueError("pieces must not run over word starts and line breaks")
        self.names = names
        self.plain = plain_pieces(model)
        self.scores = {name: model.get_score(i) for name, i in self.ids.items()}
        self.bytes = np.zeros(256, np.int64)
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
        ordered = sorted(self.ids, key=lambda name: [ord(c) for c in name])
        self.lengths = np.array([len(name) for name in ordered])
        self.numbers = np.array([self.ids[name] for name in ordered])
        self.longest = int(self.lengths.max())
        self.symbols = np.full((len(ordered), self.longest), -1, np.int32)
        for row, name in enumerate(ordered):
            self.symbols[row, : len(name)] = [ord(c) for c in name]
        self.alone: dict[int, bool] = {}
        self.last_merge: dict[str, tuple[str, str]] = {}  # of pieces only, so no more than the vocabulary
        self.beside: dict[int, bool] = {}

    def name(self, number: int) -> str:
        return self.names[number] if number < self.size else chr(number - self.size)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text: the adjacent pair that joins to the best piece is joined first, the left one of equals."""
        parts, score, last = list(text), self.scores.get, None
        while len(parts) > 1:
            joined = [score(a + b) for a, b in zip(parts, parts[1:])]
            best = max((s for s in joined if s is not None), default=None)
            if best is None:
                break
            at = joined.index(best)
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 1 and last:
            self.last_merge[text] = last
        return parts

    def halves(self, name: str) -> tuple[str, str]:
        """The two pieces whose merge makes a piece that stands alone."""
        if name not in self.last_merge:
            self.merge(name)
        return self.last_merge[name]

    def _time(self, name: str) -> float:
        """When a piece is merged: the better its score, the earlier."""
        return -self.scores[name] if len(name) > 1 else -math.inf

    def _apart(self, left: str, right: str, until: float = math.inf) -> bool:
        """Whether no merge joins two pieces that stand alone before the time ``until``.

        The later-made piece is taken apart, again and again; what meets at the border must not join before that piece was
        made. Of equal merges the left one comes first.
        """
        while True:
            joined = self.scores.get(left + right)
            if joined is not None and -joined < until:
                return False
            if len(left) == len(right) == 1:
                return True
            if self._time(left) > self._time(right):
                until = min(until, self._time(left))
                left = self.halves(left)[1]
            else:
                until = min(until, math.nextafter(self._time(right), math.inf))
                right = self.halves(right)[0]

    def stands_alone(self, number: int) -> bool:
        """Whether the text of a piece is encoded as that piece."""
        if number not in self.alone:
            name = self.name(number)
            self.alone[number] = len(name) == 1 or self.merge(name) == [name]
        return self.alone[number]

    def stay_apart(self, pair: int) -> bool:
        """Whether two pieces (left * 2**32 + right) side by side are left as they are; the left one stands alone."""
        if pair not in self.beside:
            if len(self.beside) >= CACHED_PAIRS:
                self.beside.clear()
            left, right = pair >> 32, pair & 0xFFFFFFFF
            self.beside[pair] = self.stands_alone(right) and self._apart(self.name(left), self.name(right))
        return self.beside[pair]


def _search(text: np.ndarray, order: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every piece in the suffix order, all pieces searched at once, symbol by symbol."""
    low = np.zeros(len(vocabulary.lengths), np.int64)
    high = np.full(len(low), len(order), np.int64)
    for depth in range(vocabulary.longest):
        rows = np.flatnonzero((vocabulary.lengths > depth) & (low < high))
        symbol = vocabulary.symbols[rows, depth]

        def bound(wanted):
            first, last = low[rows].copy(), high[rows].copy()
            while (open_ := first < last).any():
                middle = (first + last) // 2
                at = order[np.minimum(middle, len(order) - 1)] + depth
                below = text[np.minimum(at, len(text) - 1)] < wanted
                first = np.where(open_ & below, middle + 1, first)
                last = np.where(open_ & ~below, middle, last)
            return first

        start, end = bound(symbol), bound(symbol + 1)
        low[rows], high[rows] = start, end
    return low, high


def encode_words(words: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of each word (which starts with its blanks) as little-endian unsigned 32-bit bytes."""
    if not words:
        return []
    joined = np.frombuffer("\0".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    sizes = np.array([len(w) for w in words])
    begins = np.cumsum(np.r_[0, sizes[:-1] + 1])
    text = np.concatenate([joined, np.full(vocabulary.longest + 1, GAP)])
    text[begins[1:] - 1] = GAP
    n = len(joined)
    order = rank_by_doubling(text, vocabulary.longest)
    low, high = _search(text, order, vocabulary)

    counts = high - low
    shift = np.repeat((low - (np.cumsum(counts) - counts)).astype(np.int32), counts)
    start = order.astype(np.int32)[np.arange(len(shift), dtype=np.int32) + shift]
    length = np.repeat(vocabulary.lengths.astype(np.int32), counts)
    known = np.zeros(len(text), bool)
    known[start[length == 1]] = True
    unknown = np.flatnonzero(~known[:n] & (text[:n] != GAP)).astype(np.int32)
    number = np.r_[np.repeat(vocabulary.numbers.astype(np.int32), counts), (vocabulary.size + text[unknown]).astype(np.int32)]
    end = np.r_[start + length, unknown + 1]
    start = np.r_[start, unknown]
    del shift, length

    word_start = np.zeros(len(text) + 1, np.int32)
    word_start[begins] = begins
    word_start = np.maximum.accumulate(word_start)
    inside = end - word_start[start]  # edges that end at the same distance from their word's start are relaxed together
    by_end = np.argsort(inside, kind="stable")
    start, number, end, inside = start[by_end], number[by_end], end[by_end], inside[by_end]
    cuts = np.flatnonzero(np.diff(inside)) + 1
    del by_end, inside
    last = np.full(len(text) + 1, -1, np.int64)  # the piece that ends at each place
    begin = np.full(len(text) + 1, -1, np.int64)
    for first, stop in zip(np.r_[0, cuts], np.r_[cuts, len(start)]):
        s, p, e = start[first:stop], number[first:stop].astype(np.int64), end[first:stop]
        initial = s == word_start[s]
        pairs = np.where(initial, -1 - p, (last[s] << 32) | p)
        distinct, back = np.unique(pairs, return_inverse=True)
        fits = np.array([vocabulary.stands_alone(-1 - c) if c < 0 else vocabulary.stay_apart(c) for c in distinct.tolist()])[back]
        last[e[fits]], begin[e[fits]] = p[fits], s[fits]

    at, owner, steps = begins + sizes, np.arange(len(words)), []
    while len(at):
        steps.append((owner, last[at]))
        at = begin[at]
        more = at > word_start[at]
        at, owner = at[more], owner[more]
    owner, number = (np.concatenate(c)[::-1] for c in zip(*steps))
    by_word = np.argsort(owner, kind="stable")
    owner, number = owner[by_word], number[by_word]
    odd = number >= vocabulary.size  # unknown characters fall back to their bytes
    if odd.any():
        plain = [vocabulary.name(code).encode("utf-8", "surrogatepass") for code in number[odd].tolist()]
        widths = np.ones(len(number), np.int64)
        widths[odd] = [len(p) for p in plain]
        number, owner, odd = (np.repeat(x, widths) for x in (number, owner, odd))
        number[odd] = vocabulary.bytes[np.frombuffer(b"".join(plain), np.uint8)]
    data = number.astype("<u4").tobytes()
    bounds = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


class Encoder:
    """Ids of whole texts; the new words of a batch are matched together."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.words = vocabulary, {}

    @staticmethod
    def _split(text: str) -> list[str]:
        return _WORD.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def _learn(self, texts: list[list[str]]) -> None:
        found: set[str] = set().union(*texts)
        if len(self.words) + len(found) > CACHED_WORDS:
            self.words = {}
        new, size = [], 0
        for word in sorted(found - self.words.keys()):
            new.append(word)
            size += len(word)
            if size > BATCH_CHARACTERS:
                self.words.update(zip(new, encode_words(new, self.vocabulary)))
                new, size = [], 0
        self.words.update(zip(new, encode_words(new, self.vocabulary)))

    def encode(self, texts: list[str]) -> list[bytes]:
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_CHARACTERS):
                size += len(texts[end])
                end += 1
            split = [self._split(text) for text in texts[at:end]]
            self._learn(split)
            known = self.words.__getitem__
            out += [b"".join(map(known, words)) for words in split]
            at = end
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder and the words it has met stay with the Python worker."""
    return Encoder(Vocabulary(path))


@lru_cache(maxsize=1)
def plain_of(path: str) -> list[bytes]:
    """All that a worker that only decodes has to hold."""
    import sentencepiece

    return plain_pieces(sentencepiece.SentencePieceProcessor(model_file=path))


def decode_ids(ids: bytes, plain: list[bytes]) -> str:
    """Text of little-endian 32-bit ids; the blank that every text is given before encoding is taken off."""
    return b"".join(map(plain.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace").removeprefix(" ")


def _append(table: DataFrame, source: str, added: list[tuple[str, T.DataType]], convert) -> DataFrame:
    """``table`` with columns computed from another one, a few rows at a time; columns that had their names are replaced."""
    names = [name for name, _ in added]
    rows = table.select(*(c for c in table.columns if c not in names), F.col(source).alias("__source"))
    kept = [f for f in rows.schema.fields if f.name != "__source"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = convert()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *step(part.column(len(kept)))], [*(f.name for f in kept), *names])

    return rows.mapInArrow(run, T.StructType([*kept, *(T.StructField(name, kind) for name, kind in added)]))


def encode(docs: DataFrame, text_column: str = "text", ids_column: str = "ids", model: str | None = None) -> DataFrame:
    """All rows and columns with the ids of the text appended, as little-endian unsigned 32-bit bytes.

    A null or empty text has no ids. The model's path is a parameter of the job and must exist on every executor. Names that
    begin with two underscores are reserved.
    """
    path = model or default_model()

    def convert():
        encoder = encoder_of(path)
        return lambda texts: [pa.array(encoder.encode([t or "" for t in texts.to_pylist()]), pa.binary())]

    return _append(docs, text_column, [(ids_column, T.BinaryType())], convert)


def decode(encoded: DataFrame, ids_column: str = "ids", text_column: str = "decoded", model: str | None = None) -> DataFrame:
    """All rows and columns with the text of the ids appended; null ids give the empty text."""
    path = model or default_model()

    def convert():
        plain = plain_of(path)
        return lambda ids: [pa.array([decode_ids(one.as_py() or b"", plain) for one in ids], pa.string())]

    return _append(encoded, ids_column, [(text_column, T.StringType())], convert)


def encode_and_decode(
    docs: DataFrame, text_column: str = "text", ids_column: str = "ids", decoded_column: str = "decoded", model: str | None = None
) -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that only one worker a task holds the vocabulary."""
    path = model or default_model()

    def convert():
        encoder = encoder_of(path)

        def step(texts):
            ids = encoder.encode([t or "" for t in texts.to_pylist()])
            return [pa.array(ids, pa.binary()), pa.array([decode_ids(one, encoder.vocabulary.plain) for one in ids], pa.string())]

        return step

    return _append(docs, text_column, [(ids_column, T.BinaryType()), (decoded_column, T.StringType())], convert)
