"""Packing of tokenised documents into fixed windows: minimum bin slack over the multiset of lengths.

A document longer than a window is cut into full windows and one remainder. Only the histogram of remainder lengths
(at most one row per token count below the window) reaches the driver; there a bitset subset-sum picks, for the longest
remaining length, the multiset of other lengths that fills the window closest to its capacity, and the pattern is
repeated as often as the counts allow. Rows then find their place from their rank within their length.
"""

from __future__ import annotations

import gc
import string
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

WINDOW = 2048
END = 1  # id that ends every document
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 600_000
CACHED_STEMS = 500_000
TAIL = string.punctuation.replace("'", "")  # an apostrophe may begin an ending of its own
SLICE = 2048  # texts that are encoded together
GROUP = 50_000  # pieces of one length that are numbered in one task


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write visible bytes as themselves and the others, in order, as characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(256 + place) for place, byte in enumerate(hidden)}


BYTE_ALPHABET = _byte_alphabet()


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes; only words not met before go to the tokenizer.

    Blanks and line breaks separate words in this vocabulary's pre-tokenizer and are dropped, so the ids of a text are
    those of its words in order. Punctuation after a letter is a word of its own there, and the case of Latin letters does
    not count, so a word of such letters is a stem and a tail. The stem passes the normaliser and the pre-tokenizer as it
    is and goes straight to the tokenizer's model, in the byte alphabet of its vocabulary. With ``special_as_text`` the
    strings of added tokens are ordinary text; without it they get their ids wherever they stand, as the tokenizer does.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [] if special_as_text else [token.content for token in added]  # none holds a blank
        self.words: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {"": b""}
        self.tails: dict[str, bytes] = {"": b""}

    def _whole(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        for at in range(0, len(words), 10_000):
            some = words[at : at + 10_000]
            for word, encoding in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                yield word, array("I", encoding.ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        odd, stems, tails, tokenize = [], self.stems, self.tails, self.tokenizer.model.tokenize
        for word in words:
            stem = word.rstrip(TAIL)
            if not stem.isalpha() or not (stem.isascii() or max(stem) < "\u0100"):
                odd.append(word)
                continue
            tail = word[len(stem) :]
            if tail and tail not in tails:
                tails.update(self._whole([tail]))
            stem = stem.lower()
            ids = stems.get(stem)
            if ids is None:
                letters = stem if stem.isascii() else stem.encode().decode("latin-1").translate(BYTE_ALPHABET)
                ids = stems[stem] = array("I", [token.id for token in tokenize(letters)]).tobytes()
            self.words[word] = ids + tails[tail] if tail else ids
        self.words.update(self._whole(odd))

    def encode(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.large_string())
        for string in self.added:
            column = pc.replace_substring(column, string, f" {string} ")
        split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        numbered = split.flatten().dictionary_encode()  # so that each distinct word is looked up once
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        for known, limit in ((self.words, CACHED_WORDS), (self.stems, CACHED_STEMS), (self.tails, CACHED_WORDS)):
            _forget(known, limit)
        found = [*map(self.words.get, words)]
        new = [place for place, ids in enumerate(found) if ids is None]
        if new:
            collecting = gc.isenabled()
            gc.disable()  # no cycles arise here, and a collection would walk all known words
            try:
                self._learn([words[place] for place in new])
            finally:
                if collecting:
                    gc.enable()
            for place in new:
                found[place] = self.words[words[place]]
        ids = pa.array(found, pa.large_binary()).take(numbered.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64)[split.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(data or b"")
        return [bytes(data[start:end]) for start, end in zip(ends, ends[1:])]


def _forget(known: dict[str, bytes], limit: int) -> None:
    """Drop the later half of too many words; those met first, most of them frequent, stay."""
    if len(known) > limit:
        for word in list(known)[limit // 2 :]:
            del known[word]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """The encoder and the words it has met stay with the Python worker."""
    return WordEncoder(path, special_as_text=False)


def cut_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens) of at most ``window`` tokens; ids are little-endian 32-bit integers.

    Every document ends with the id 1, so a null or empty text gives one piece of one token. Repeated rows give their
    pieces each; a null id stays null. The tokenizer's path is a parameter of the job and must exist on every executor.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([END], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):  # so that pieces leave while others are encoded
                batch = whole.slice(at, SLICE)
                encoded = [ids + end for ids in encoder.encode(batch.column(1).to_pylist())]
                spans = [(n, s, len(ids) // 4) for n, ids in enumerate(encoded) for s in range(0, len(ids) // 4, window)]
                number, start, total = (np.array(c, np.int64) for c in zip(*spans))
                pieces = [encoded[n][4 * s : 4 * (s + window)] for n, s, _ in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(number)), pa.array(start), pa.array(np.minimum(window, total - start)),
                        pa.array(pieces, pa.binary()), pa.array(total),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    picked = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return picked.mapInArrow(cut, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint")


def fill_window(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths whose sum comes closest to ``room`` without passing it.

    Bit s of the set says that sum s can be reached. Counts are taken in powers of two, so a length with a large count
    costs a few shifts; the sets before each step lead back to the counts used.
    """
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in lengths:
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & mask
            left -= take
            take *= 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan_windows(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """(repeats, lengths and counts of one window) until every piece has a place.

    Every pattern holds the longest remaining length. It repeats while all counts last, so each pattern uses up at least
    one length or halves the rest: the number of patterns depends on the window, not on the number of pieces.
    """
    counts = {length: n for length, n in histogram.items() if n}
    plan = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        pattern = fill_window([l for l in sorted(counts, reverse=True) if counts[l]], counts, window - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        counts[longest] += 1
        repeats = min(counts[length] // used for length, used in pattern.items())
        plan.append((repeats, pattern))
        for length, used in pattern.items():
            counts[length] -= used * repeats
            if not counts[length]:
                del counts[length]
    return plan


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, list[np.ndarray]]:
    """By length: first rank, pieces per window, first window and first offset of each pattern that uses it."""
    found: dict[int, list[list[int]]] = {}
    used_up: dict[int, int] = {}
    first_window = 0
    for repeats, pattern in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            rank = used_up.get(length, 0)
            found.setdefault(length, []).append([rank, pattern[length], first_window, offset])
            used_up[length] = rank + pattern[length] * repeats
            offset += pattern[length] * length
        first_window += repeats
    return {length: np.array(rows, np.int64).T for length, rows in found.items()}


def _place(places: dict[int, list[np.ndarray]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            length, rank = (columns[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                ranks, per_window, first_window, first_offset = places[int(length[own[0]])]
                pattern = np.searchsorted(ranks, rank[own], side="right") - 1
                inside = rank[own] - ranks[pattern]
                sequence[own] = first_window[pattern] + inside // per_window[pattern]
                offset[own] = first_offset[pattern] + inside % per_window[pattern] * length[own]
            kept = [(name, c) for name, c in columns.items() if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [c for _, c in kept] + [pa.array(sequence), pa.array(offset)], [n for n, _ in kept] + ["sequence_id", "offset"]
            )

    return place


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``pieces`` (doc_id, start, length and any others) with ``sequence_id`` and ``offset`` appended.

    Offsets are gapless from 0 within a sequence and no sequence passes the window. Pieces are numbered within their
    length in two steps (rank within a group of bounded size, plus the sizes of the groups before), so a length that most
    pieces share is spread over many tasks; ties may be ranked in any order. ``pieces`` is read several times and should
    be a written table. An empty table gives an empty result. Columns named like the appended ones are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset", "rank", "group")
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # one row per length
    if histogram and max(histogram) > window:
        raise ValueError(f"a piece is longer than {window}")
    places = _places(plan_windows(histogram, window))
    groups = max(1, -(-max(histogram.values(), default=1) // GROUP))
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)))
    sizes = materialise(
        grouped.groupBy("length", "group").count().selectExpr(
            "length", "`group`", "sum(count) OVER (PARTITION BY length ORDER BY `group`) - count AS before"
        ),
        "packing-groups",
    )
    ranked = grouped.selectExpr("*", "row_number() OVER (PARTITION BY length, `group` ORDER BY doc_id, start) - 1 AS own")
    numbered = ranked.join(sizes, ["length", "group"]).withColumn("rank", F.col("before") + F.col("own"))
    numbered = numbered.select(*pieces.columns, F.col("rank").cast("long").alias("rank"))
    schema = pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return numbered.mapInArrow(_place(places), schema)


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Places of all pieces of all documents; of the ids themselves their CRC-32 is kept (``ids_crc32``)."""
    pieces = cut_documents(docs, id_column, text_column, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(materialise(pieces, "packing-pieces"))


def assemble(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """Whole sequences (sequence_id, used, ids) from packed pieces with their ids, padded to the window."""
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("used"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda left, part: F.concat(left, part["ids"]))
    padding = F.expr(f"unhex(repeat('{np.array([pad], '<u4').tobytes().hex()}', int({window} - used)))")
    return parts.select("sequence_id", "used", F.concat(joined, padding).alias("ids"))
