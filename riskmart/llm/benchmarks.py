"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The items' words form one automaton per shard of bounded size. Every document's words are streamed through it; the state
and the length of the longest match that ends at each word say which items' windows end there. Matched spans longer than
the limits are cut out of the text, documents that consist of them to a large part are marked.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

WINDOW = 10  # words; items of fewer words are matched whole
MAX_COVERAGE = 0.5  # share of hit words from which on a document is marked to be dropped
SHARD_WORDS = 100_000  # words of items in one automaton; further items go to further automata
PIECE_WORDS = 20_000  # longer items are cut into overlapping pieces
CHUNK = 1 << 20  # bytes of a text that are split into words at a time

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)  # A-Z become lower case, other ASCII characters but digits and letters become blanks


def _chunks(data: bytes) -> Iterator[bytes]:
    """Consecutive parts of folded bytes, cut between words."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text: digits, lower-cased letters and all characters beyond ASCII."""
    return text.translate(_FOLD).split()


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers. State 0 is the start; ``go`` is keyed by state * words + word."""

    numbers: dict[bytes, int]
    go: dict[int, int]
    link: list[int]
    longest: list[int]
    window: int
    shortest: int  # words of the shortest window
    class_of: list[int]  # the state that holds the last ``window`` words of a state's strings, or -1
    owners: dict[int, list[int]]  # items by such a state
    marked: list[int]  # nearest state, upwards from a state, that a short item ends in, or -1
    marks: dict[int, list[tuple[int, list[int]]]]  # (words, items) of the short items that end in a state
    ids: list  # item ids


def build_automaton(items: list[tuple[object, list[bytes]]], window: int = WINDOW) -> Automaton:
    """The automaton of all items, each (id, words); an item may come in several overlapping pieces."""
    numbers: dict[bytes, int] = {}
    coded = [(item, [numbers.setdefault(w, len(numbers)) for w in words]) for item, words in items if words]
    width = max(len(numbers), 1)
    edges: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]

    def split(p: int, c: int, q: int) -> int:
        """A copy of state q for the strings that end in p followed by c."""
        edges.append(dict(edges[q]))
        link.append(link[q])
        longest.append(longest[p] + 1)
        copy = len(edges) - 1
        link[q] = copy
        while p >= 0 and edges[p].get(c) == q:
            edges[p][c] = copy
            p = link[p]
        return copy

    def extend(last: int, c: int) -> int:
        q = edges[last].get(c)
        if q is not None:  # the string is known from another item
            return q if longest[q] == longest[last] + 1 else split(last, c, q)
        edges.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        state, p = len(edges) - 1, last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = state
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            link[state] = q if longest[q] == longest[p] + 1 else split(p, c, q)
        return state

    for _, words in coded:
        last = 0
        for c in words:
            last = extend(last, c)

    order = sorted(range(1, len(edges)), key=longest.__getitem__)  # links lead to shorter strings
    class_of = [-1] * len(edges)
    for state in order:
        class_of[state] = (state if longest[link[state]] < window else class_of[link[state]]) if longest[state] >= window else -1
    ids: dict[object, int] = {}
    owners: dict[int, set[int]] = {}
    short: dict[int, dict[int, set[int]]] = {}
    for item, words in coded:
        number, state = ids.setdefault(item, len(ids)), 0
        for place, c in enumerate(words, 1):
            state = edges[state][c]
            if place >= window:
                owners.setdefault(class_of[state], set()).add(number)
        if len(words) < window:
            short.setdefault(state, {}).setdefault(len(words), set()).add(number)
    marked = [-1] * len(edges)
    for state in order:
        marked[state] = state if state in short else marked[link[state]]
    go = {state * width + c: target for state, out in enumerate(edges) for c, target in out.items()}
    return Automaton(
        numbers, go, link, longest, window, min((min(len(w), window) for _, w in coded), default=window), class_of,
        {s: sorted(o) for s, o in owners.items()}, marked,
        {s: [(m, sorted(o)) for m, o in by.items()] for s, by in short.items()}, list(ids),
    )


def _add(runs: list[tuple[int, int, int]], first: int, end: int, length: int) -> None:
    """Add a hit that ends last to maximal runs (first word, end, longest match)."""
    while runs and first <= runs[-1][1]:
        before = runs.pop()
        first, length = min(first, before[0]), max(length, before[2])
    runs.append((first, end, length))


def match(automaton: Automaton, data: bytes) -> tuple[int, list[tuple[int, int, int]], set[int]]:
    """(words, hits, items) of folded bytes: hits are maximal runs of hit words, (first word, end, longest match).

    Words that no item has cut the text into runs; runs shorter than the shortest window are passed over.
    """
    number, width, go = automaton.numbers.get, max(len(automaton.numbers), 1), automaton.go
    link, longest, window = automaton.link, automaton.longest, automaton.window
    class_of, marked = automaton.class_of, automaton.marked
    count, state, length = 0, 0, 0
    hits: list[tuple[int, int, int]] = []
    items: set[int] = set()
    for chunk in _chunks(data):
        codes = np.array([number(w, -1) for w in chunk.split()], np.int64)
        unknown = np.flatnonzero(codes < 0)
        bounds = np.r_[-1, unknown, len(codes)]
        runs = np.flatnonzero(np.diff(bounds) - 1 >= automaton.shortest)
        first = (bounds[runs] + 1).tolist()
        ends = bounds[runs + 1].tolist()
        # A run at either edge of a chunk may go on in the next one, so it is followed whatever its length.
        head = int(bounds[1]) if len(unknown) else len(codes)
        if head and (not first or first[0] != 0):
            first.insert(0, 0)
            ends.insert(0, head)
        tail = int(unknown[-1]) + 1 if len(unknown) else len(codes)
        if tail < len(codes) and first[-1:] != [tail]:
            first.append(tail)
            ends.append(len(codes))
        for begin, end in zip(first, ends):
            if begin:
                state = length = 0
            for place, c in enumerate(codes[begin:end].tolist(), count + begin + 1):
                target = go.get(state * width + c)
                while target is None and state:
                    state = link[state]
                    length = longest[state]
                    target = go.get(state * width + c)
                if target is None:
                    length = 0
                    continue
                state, length = target, length + 1
                if length >= window:
                    _add(hits, place - window, place, length)
                    items.update(automaton.owners[class_of[state]])
                at = marked[state]
                while at > 0:
                    for words, own in automaton.marks[at]:
                        if words <= length:
                            _add(hits, place - words, place, length)
                            items.update(own)
                    at = marked[link[at]]
        if len(unknown) and tail == len(codes):
            state = length = 0
        count += len(codes)
    return count, hits, items


def merge_hits(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal runs of hit words, each with its longest match, from hits of several automata."""
    merged: list[tuple[int, int, int]] = []
    for first, end, length in sorted(hits, key=lambda h: h[1]):
        _add(merged, first, end, length)
    return merged


def byte_ranges(data: bytes, runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Where runs of words stand in the folded bytes, from the first byte of the first word to the end of the last."""
    inside = np.frombuffer(data, np.uint8) != 32
    edges = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return [(int(starts[first]), int(ends[end - 1])) for first, end, _ in runs]


_HIT = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("longest", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_word", pa.int64()), ("words", pa.int64()), ("longest", pa.int64())])
_APPENDED = ["n_words", "n_hit", "items", "spans", "kept", "dropped"]


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column:
        yield (text.as_py() or "").encode("utf-8", "surrogatepass")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _build(window: int):
    """One pickled automaton for every shard; rows come sorted by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, items = None, []

        def done():
            data = pickle.dumps(build_automaton(items, window), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([data], pa.binary())], ["shard", "automaton"])

        for batch in batches:
            for number, item, words in zip(*(c.to_pylist() for c in batch.columns)):
                if shard is not None and number != shard:
                    yield done()
                    items = []
                shard = number
                items.append((item, words.split(b" ")))
        if shard is not None:
            yield done()

    return run


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for number, text in enumerate(_texts(batch.column(1))):
                words = words_of(text)
                for at in range(0, max(len(words) - window + 1, 1) if words else 0, PIECE_WORDS):
                    piece = words[at : at + PIECE_WORDS + window - 1]
                    rows.append((number, b" ".join(piece), len(piece)))
            if rows:
                number, piece, count = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(number, pa.int64())), pa.array(piece, pa.binary()), pa.array(count, pa.int64())],
                    ["item", "piece", "count"],
                )

    return run


def build_shards(items: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, automaton): pickled automata of about ``shard_words`` words of items each.

    Items without words have no window. Repeated items are one item; items with a null id are matched but have no name.
    """
    kind = items.schema[id_column].dataType.simpleString()
    picked = items.select(F.col(id_column).alias("item"), F.col(text_column).alias("text"))
    pieces = materialise(picked.mapInArrow(_pieces(window), f"item {kind}, piece binary, count bigint").distinct(), "benchmark-pieces")
    total = pieces.agg(F.coalesce(F.sum(F.col("count") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))
    dealt = pieces.select(F.pmod(F.xxhash64("item", "piece"), F.lit(shards)).alias("shard"), "item", "piece")
    built = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(_build(window), "shard bigint, automaton binary")
    return materialise(built, "benchmark-automata")


def _find(shared):
    """Hits and items of every text in one automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pickle.loads(shared.value)
        for batch in _slices(batches):
            for row, text in enumerate(_texts(batch.column(2))):
                _, hits, items = match(automaton, text.translate(_FOLD))
                if hits:
                    found = [automaton.ids[i] for i in sorted(items) if automaton.ids[i] is not None]
                    runs = [{"first": f, "end": e, "longest": n} for f, e, n in hits]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(row, 1), batch.column(1).slice(row, 1), pa.array([runs], pa.list_(_HIT)), pa.array([[str(i) for i in found]])],
                        ["k1", "k2", "hits", "items"],
                    )

    return run


def _clean(names: list[str], shared, min_words: int, max_coverage: float):
    """Appends the counts, items, spans and remaining text; hits come from the automaton or, without one, from ``__hits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pickle.loads(shared.value) if shared else None
        for batch in _slices(batches):
            columns = dict(zip(batch.schema.names, batch.columns))
            out: list[list] = [[] for _ in _APPENDED]
            for row, text in enumerate(_texts(columns["__text"])):
                data = text.translate(_FOLD)
                if automaton:
                    count, runs, found = match(automaton, data)
                    items = {str(automaton.ids[i]) for i in found if automaton.ids[i] is not None}
                else:
                    count = sum(len(chunk.split()) for chunk in _chunks(data))
                    runs = merge_hits([(h["first"], h["end"], h["longest"]) for h in columns["__hits"][row].as_py() or []])
                    items = set(columns["__items"][row].as_py() or [])
                places = byte_ranges(data, runs) if runs else []
                hit = sum(end - first for first, end, _ in runs)
                cut = [place for place, (first, end, _) in zip(places, runs) if end - first >= min_words]
                edges = [0, *(edge for place in cut for edge in place), len(text)]
                kept = b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])).decode("utf-8", "replace")
                spans = [
                    {"start": s, "end": e, "first_word": first, "words": end - first, "longest": n}
                    for (s, e), (first, end, n) in zip(places, runs)
                ]
                for values, value in zip(out, (count, hit, sorted(items), spans, kept, hit > max_coverage * count)):
                    values.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(_SPAN), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), *map(pa.array, out, kinds)], [*names, *_APPENDED])

    return run


def decontaminate(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, min_words: int = 0, max_coverage: float = MAX_COVERAGE,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """All rows and columns of ``docs`` with what they share with the items appended.

    ``n_words`` and ``n_hit`` count words, ``items`` holds the ids (as text, in order) of items of which a window occurs,
    ``spans`` the maximal runs of hit words (UTF-8 byte range, first word, words, longest match in words), ``kept`` the
    text without the runs of at least ``min_words`` words, ``dropped`` whether more than ``max_coverage`` of the words
    are hit. A window is ``window`` consecutive words of an item; an item of fewer words is one window.

    One automaton of at most about ``shard_words`` words goes to every task and documents pass through it without a
    shuffle. If the items need several automata, each one passes over the documents in turn, only documents with hits are
    written, and the hits are joined back by a 128-bit digest of id and text, so memory stays bounded however many items
    there are. Null texts are empty and have no words; repeated rows and null ids are kept; items with null ids are matched
    but not named; without items nothing is hit. Columns that had one of the appended names are replaced; names that begin
    with two underscores are reserved.
    """
    spark = docs.sparkSession
    docs = docs.drop(*_APPENDED)
    names = docs.columns
    keys = [F.xxhash64(id_column, text_column), F.xxhash64(F.lit(1), text_column, id_column)]
    table = docs.select(*names, F.col(text_column).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema = (
        f"{types}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start: bigint, `end`: bigint, "
        "first_word: bigint, words: bigint, longest: bigint>>, kept string, dropped boolean"
    )
    automata = build_shards(items, item_id, item_text, window, shard_words)
    shards = [r.shard for r in automata.select("shard").distinct().orderBy("shard").collect()]

    def shared(shard):
        return spark.sparkContext.broadcast(bytes(automata.filter(F.col("shard") == shard).first().automaton))  # bounded by shard_words

    if len(shards) <= 1:
        own = shared(shards[0]) if shards else spark.sparkContext.broadcast(pickle.dumps(build_automaton([], window)))
        return table.mapInArrow(_clean(names, own, min_words, max_coverage), schema)
    keyed = table.select("*", keys[0].alias("__k1"), keys[1].alias("__k2"))
    found = []
    for shard in shards:
        own = shared(shard)
        hits = keyed.select("__k1", "__k2", "__text").mapInArrow(
            _find(own), "k1 bigint, k2 bigint, hits array<struct<first: bigint, `end`: bigint, longest: bigint>>, items array<string>"
        )
        found.append(materialise(hits.dropDuplicates(["k1", "k2"]), "benchmark-hits"))
        own.unpersist()
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    merged = together.groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).agg(
        F.flatten(F.collect_list("hits")).alias("__hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("__items")
    )
    joined = keyed.join(merged, ["__k1", "__k2"], "left").select(*names, "__text", "__hits", "__items")
    return joined.mapInArrow(_clean(names, None, min_words, max_coverage), schema)
