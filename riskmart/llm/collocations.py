"""Phrase collocations by weighted acyclic automata.

Every shard of text sorts its phrases and builds count transducers, one for each prefix range. The transducers of a range
are united, summing weights, and phrases below the least count go. Longer phrases are counted only where all their words
or word pairs are frequent, which a filter of fixed size tells without missing one. The counts of a candidate's parts come
from composing the parts with the transducers of their ranges.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from .hotjoin import join_unique
from .transducers import Ranges, Transducer, Union, build, even_ranges, trim

LEAST = 30
LONGEST = 4
KEEP = 2000  # phrases of a language that are returned
COVERED = 80  # per cent of a phrase's count that a longer phrase must have for the shorter one to go
SCALE = 2_000_000
SLICE_BYTES = 8 << 20  # text whose phrases become transducers together
RANGE_BYTES = 24 << 20  # text behind one prefix range, about
MOST_WORDS = 3 << 19  # words of one slice before another part of a text, so that three of their numbers fit 64 bits
CHUNK = 1 << 20
SAMPLE = 2000  # documents whose beginnings say where ranges are cut; the cuts balance work only
BITS = 26  # of the filter of frequent phrases: 8 MB whatever the corpus
BLOCK = 16
BUCKETS = 256  # a language's phrases are ranked in this many parts first
BREAK = b"\xff"  # no UTF-8 text holds this byte

_FOLD = bytes(b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


def _parts(text: bytes) -> Iterator[bytes]:
    """Consecutive parts of the folded text, cut between words."""
    data, at = text.translate(_FOLD), 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def tokens(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """Words of a UTF-8 text in order, a part of it at a time, with a mark between pieces, and the part's bytes."""
    for part in _parts(text):
        yield part.replace(BREAK, b" \xff ").split(), len(part)


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\0" + word)


def phrase_hashes(hashes: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of phrases from those of their words, column by column."""
    out = np.zeros(len(hashes[0]), np.uint64)
    for column in hashes:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only for phrases the filter was not given."""
    one, two = _places(hashes)
    return ((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1).astype(bool)


class _Slice:
    """Folded texts of one language, counted together."""

    def __init__(self, lang: bytes, bits: np.ndarray | None):
        self.lang, self.bits = lang, bits
        self.parts: list[bytes] = []
        self.old: list[bool] = []
        self.most = 0  # no fewer than the words added

    def add(self, part: bytes, old: bool = False) -> None:
        self.parts.append(part.replace(BREAK, b" \xff "))
        self.old.append(old)
        self.most += part.count(b" ") + part.count(BREAK) + 1

    def _numbered(self) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """(codes, old, words, hashes): places of the words in their sorted list, -1 for the mark and for words the filter rules out."""
        split = pc.split_pattern(pa.array(self.parts, pa.large_binary()), " ")
        numbered = split.flatten().dictionary_encode()  # so that each distinct word is looked at once
        order = pc.sort_indices(numbered.dictionary).to_numpy()
        words = numbered.dictionary.to_numpy(zero_copy_only=False)[order].tolist()
        blank = order[0] if words[:1] == [b""] else -1  # between two blanks
        held = slice(int(blank >= 0), len(words) - (words[-1:] == [BREAK]))  # the mark sorts last
        order, words = order[held], words[held]
        hashes = np.empty(0, np.uint64)
        if self.bits is not None and words:
            hashes = np.fromiter((word_hash(self.lang, word) for word in words), np.uint64, len(words))
            held = may_hold(self.bits, phrase_hashes([hashes]))
            order, hashes, words = order[held], hashes[held], [word for word, own in zip(words, held.tolist()) if own]
        rank = np.full(len(numbered.dictionary), -1, np.int64)
        rank[order] = np.arange(len(order))
        numbers = numbered.indices.to_numpy()
        old = np.repeat(np.array(self.old, bool), np.diff(split.offsets.to_numpy()))
        real = numbers != blank
        return rank[numbers[real]], old[real], words, hashes

    def count(self, lengths: tuple[int, ...], pairs: np.ndarray | None) -> tuple[int, list[bytes], np.ndarray, np.ndarray]:
        """(words in all, sorted words, codes, counts) of the phrases of the wanted lengths that end in new words."""
        codes, old, words, hashes = self._numbered()
        size = len(words) + 1
        total = int(((codes >= 0) & ~old).sum())
        if lengths == (1,):
            counts = np.bincount(codes[(codes >= 0) & ~old], minlength=len(words))
            used = np.flatnonzero(counts)
            return total, words, used[:, None], counts[used]
        together = (codes[:-1] >= 0) & (codes[1:] >= 0)
        if lengths == (2,):
            at = np.flatnonzero(together & ~old[1:])
            keys, counts = np.unique(codes[at] * size + codes[at + 1], return_counts=True)
            return total, words, np.column_stack([keys // size, keys % size]), counts
        at = np.flatnonzero(together)
        together[at] = may_hold(pairs, phrase_hashes([hashes[codes[at]], hashes[codes[at + 1]]]))
        at = np.flatnonzero(together[:-1] & together[1:])
        keys, place, counts = np.unique(
            (codes[at] * size + codes[at + 1]) * size + codes[at + 2], return_inverse=True, return_counts=True
        )
        counts = np.bincount(place[~old[at + 2]], minlength=len(keys))
        three = np.column_stack([keys // size // size, keys // size % size, keys % size])
        longer = np.flatnonzero((at + 3 < len(codes)) & together[np.minimum(at + 2, max(len(together) - 1, 0))]) if len(at) else at
        longer = longer[~old[at[longer] + 3]]
        four, four_counts = np.unique(place[longer] * size + codes[at[longer] + 3], return_counts=True)
        codes = np.concatenate([np.column_stack([three, np.full(len(three), -1)]), np.column_stack([three[four // size], four % size])])
        order = np.argsort(np.r_[np.arange(len(three)) * size, four + 1], kind="stable")  # a phrase before its continuations
        codes, counts = codes[order], np.r_[counts, four_counts][order]
        return total, words, codes[counts > 0], counts[counts > 0]


_SHARD = "`range` int, lang string, total bigint, entries bigint, automaton binary"


def _shards(lengths: tuple[int, ...], ranges: Ranges, words, pairs, slice_bytes: int):
    """Count transducers (range, lang, total, entries, automaton) of slices of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.frombuffer(words.value, np.uint8) if words else None
        two = np.frombuffer(pairs.value, np.uint8) if pairs else None
        overlap = max(lengths) - 1
        slices: dict[str, _Slice] = {}
        size = 0

        def done() -> Iterator[pa.RecordBatch]:
            for lang, own in slices.items():
                total, names, codes, counts = own.count(lengths, two)
                numbers = ranges.of_rows(names, codes) if len(codes) else np.empty(0, np.int64)
                cuts = np.r_[0, np.flatnonzero(np.diff(numbers)) + 1, len(numbers)]
                for start, end in zip(cuts, cuts[1:]) if len(numbers) else [(0, 0)]:
                    data = trim(names, codes[start:end], counts[start:end]).dump()
                    where = int(numbers[start]) if end else 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([where], pa.int32()), pa.array([lang]), pa.array([total]), pa.array([int(end - start)]), pa.array([data], pa.binary())],
                        ["range", "lang", "total", "entries", "automaton"],
                    )
                    total = 0  # given once for a slice

        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            for row in range(batch.num_rows):
                text, lang = texts[row].as_py(), batch.column(1)[row].as_py()
                tail: list[bytes] = []
                for part in _parts(text):
                    if size >= slice_bytes or (lang in slices and slices[lang].most > MOST_WORDS):
                        yield from done()
                        slices, size = {}, 0
                        if tail:
                            slices[lang] = _Slice(lang.encode(), one)
                            slices[lang].add(b" ".join(tail), old=True)
                    if lang not in slices:
                        slices[lang] = _Slice(lang.encode(), one)
                    slices[lang].add(part)
                    size += len(part)
                    if overlap and len(text) > CHUNK:  # else there is no further part
                        tail = (tail + part.replace(BREAK, b" \xff ").rsplit(None, overlap)[-overlap:])[-overlap:]
                if lang in slices:
                    slices[lang].add(BREAK)
        yield from done()

    return run


def _unite(least: int):
    """The union of the transducers of each range and language; rows come sorted by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, union, words = None, Union(), 0

        def done():
            made = union.result(least)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([words]), pa.array([int((made.weight > 0).sum())]), pa.array([made.dump()], pa.binary())],
                ["range", "lang", "total", "entries", "automaton"],
            )

        for batch in batches:
            for where, lang, total, data in zip(*(batch.column(n) for n in (0, 1, 2, 4))):
                own = (where.as_py(), lang.as_py())
                if key is not None and own != key:
                    yield done()
                    union, words = Union(), 0
                key = own
                words += total.as_py()
                union.add(Transducer.load(data.as_py()))
        if key is not None:
            yield done()

    return run


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of transducers as rows (lang, phrase, words, a)."""
    for batch in batches:
        for lang, data in zip(batch.column(1).to_pylist(), batch.column(4)):
            made = Transducer.load(data.as_py())
            codes, weights = made.phrases()
            names = [w.decode() for w in made.words]
            for at in range(0, len(codes), 10_000):
                part = [[names[c] for c in row if c >= 0] for row in codes[at : at + 10_000].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([" ".join(p) for p in part]), pa.array([len(p) for p in part], pa.int32()), pa.array(weights[at : at + 10_000])],
                    ["lang", "phrase", "words", "a"],
                )


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, data in zip(batch.column(1).to_pylist(), batch.column(4)):
            made = Transducer.load(data.as_py())
            codes, _ = made.phrases()
            hashes = np.array([word_hash(lang.encode(), w) for w in made.words], np.uint64)
            if len(codes):
                places = np.unique(np.concatenate(_places(phrase_hashes([hashes[c] for c in codes.T]))))
                yield pa.RecordBatch.from_arrays([pa.array(places >> BLOCK), pa.array((places & ((1 << BLOCK) - 1)).astype(np.int32))], ["block", "bit"])


def _frequent(automata: DataFrame):
    """Broadcast filter of ``2**BITS`` bits that holds every phrase of the transducers; its size never grows."""
    blocks = automata.mapInArrow(_filter_bits, "block bigint, bit int").groupBy("block").agg(F.collect_set("bit").alias("bits"))
    bits = np.zeros(1 << BITS, np.uint8)
    for row in blocks.toLocalIterator():  # at most 2**(BITS - BLOCK) rows of at most 2**BLOCK numbers
        bits[(row.block << BLOCK) + np.array(row.bits)] = 1
    return automata.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the asked phrases; a range's transducers come before its phrases."""
    key, made = None, []
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        at = 0
        while at < len(rows):
            if rows[at][:2] != key:
                key, made = rows[at][:2], []
            if rows[at][2] is not None:
                one = Transducer.load(rows[at][2])
                made.append((one, {w: i for i, w in enumerate(one.words)}))
                at += 1
                continue
            end = at
            while end < len(rows) and rows[end][:2] == key and rows[end][2] is None:
                end += 1
            asked = [r[3] for r in rows[at:end]]
            weights = np.zeros(len(asked), np.int64)
            for one, number in made:
                codes = np.full((len(asked), LONGEST), -1, np.int64)
                for row, phrase in enumerate(asked):
                    split = phrase.encode().split(b" ")
                    codes[row, : len(split)] = [number.get(w, -2) for w in split]
                weights = np.maximum(weights, one.weights_of(codes))
            yield pa.RecordBatch.from_arrays([pa.array([key[1]] * len(asked)), pa.array(asked), pa.array(weights)], ["lang", "part", "f"])
            at = end


def _part_counts(automata: DataFrame, parts: DataFrame, ranges: Ranges) -> DataFrame:
    """(lang, part, f) of every distinct part: each goes to the task that holds the transducers of its range."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            where = [ranges.of(w[0], w[1] if len(w) > 1 else b"") for w in split]
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), batch.column(0), pa.nulls(len(where), pa.binary()), batch.column(1)], ["range", "lang", "automaton", "part"]
            )

    kind = "`range` int, lang string, automaton binary, part string"
    asked = parts.select("lang", "part").distinct().mapInArrow(locate, kind)
    held = automata.select("range", "lang", "automaton", F.lit(None).cast("string").alias("part"))
    rows = held.unionByName(asked).repartition("range", "lang")
    rows = rows.sortWithinPartitions("range", "lang", F.col("automaton").isNull(), "part")
    return rows.mapInArrow(_compose, "lang string, part string, f bigint")


def _sampled_ranges(texts: DataFrame, range_bytes: int) -> Ranges:
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    number = min(1 + size.bytes // range_bytes, 100_000)
    if number == 1:
        return Ranges()
    picked = texts.select(F.substring("text", 1, 4000).alias("text")).sample(min(1.0, SAMPLE / size.n), seed=1).limit(2 * SAMPLE)
    counts: Counter[bytes] = Counter()
    for row in picked.toLocalIterator():
        for part, _ in tokens(row.text.encode()):
            counts.update(part)
    del counts[BREAK]
    return even_ranges(counts, number)


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, keep: int = KEEP,
    covered: int = COVERED, slice_bytes: int = SLICE_BYTES, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The best phrases of two to four words of every language: lang, rank, phrase, a, l, r, n, score.

    Counts are taken per language (null: ``und``) over all rows, repeated ones included, within pieces of the text. Of a
    phrase's cuts the lowest-scoring one counts, then the smallest; phrases inside a longer candidate that has at least
    ``covered`` per cent of their count are dropped. Null and empty texts have no words; a language whose phrases are all
    rare gives no row, an empty table an empty result. Other columns are not read.

    All words are counted first, then pairs of frequent words, then longer phrases of frequent pairs. The two filters of
    frequent words and pairs are bit fields of fixed size: they may let a rare phrase through, which the exact counts then
    drop, but never hold a frequent one back. ``slice_bytes`` and ``range_bytes`` bound what a task holds.
    """
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"), F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"))
    ranges = _sampled_ranges(texts, range_bytes)

    def united(lengths: tuple[int, ...], words=None, pairs=None) -> DataFrame:
        shards = texts.mapInArrow(_shards(lengths, ranges, words, pairs, slice_bytes), _SHARD)
        dealt = shards.repartition("range", "lang").sortWithinPartitions("range", "lang")
        return materialise(dealt.mapInArrow(_unite(least), _SHARD), "collocations-united")

    one = united((1,))
    sizes = one.groupBy("lang").agg(F.sum("total").alias("n"))
    words = _frequent(one)
    two = united((2,), words)
    longer = united((3, 4), words, _frequent(two))

    candidates = materialise(two.unionByName(longer).mapInArrow(_list, "lang string, phrase string, words int, a bigint"), "collocations-candidates")
    split = candidates.withColumn("w", F.split("phrase", " "))

    def joined(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    cut = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    cut = materialise(cut, "collocations-cuts")
    parts = cut.select("lang", F.col("left").alias("part")).unionByName(cut.select("lang", F.col("right").alias("part")))
    found = materialise(_part_counts(one.unionByName(two).unionByName(longer), parts, ranges), "collocations-parts")
    cut = join_unique(cut, found.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = join_unique(cut, found.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = "decimal(38,0)"
    score = F.expr(f"(cast({SCALE} as {wide}) * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    scored = cut.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"), F.first("a").alias("a")
    )

    inner = split.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inside = inner.select("lang", joined(F.col("first"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = scored.join(inside, ["lang", "phrase"], "left")
    left = left.filter(F.col("most").isNull() | (F.lit(100).cast(wide) * F.col("most") < F.lit(covered).cast(wide) * F.col("a")))
    left = materialise(left.select("lang", "phrase", "a", "best.l", "best.r", "best.score"), "collocations-scored")

    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    part = left.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    best = part.filter(F.col("rank") <= keep).drop("bucket", "rank")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= keep)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
