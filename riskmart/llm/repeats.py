"""Removal of passages that repeat anywhere in the corpus, exact to the byte, with suffix arrays over shards.

Every start of a 400-byte string belongs to the smallest hash of the 64-byte strings inside it, so equal strings meet
under equal hashes wherever they stand. Consecutive starts with the same smallest hash form one fragment. A hash that
occurs once, in one place, needs no further look; fragments that occur twice as a whole are repeats as a whole; the others are
sent, by hash, to shards whose suffix arrays are induced and whose permuted common prefixes show the strings that occur twice. A
hash under which very many different fragments meet is not kept in one shard: its strings are counted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .suffixes import permuted_common_prefixes, suffix_array

LENGTH = 400
GRAM = 64
SEGMENT_BYTES = 1 << 18
SLICE = 128  # rows that are handled together
FRAGMENT_STARTS = 4096
SHARD_BYTES = 2 << 20
SHARD_FRAGMENTS = 4096  # more different fragments under one hash are counted string by string

_BYTE_VALUES = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all 64-byte strings of a byte array, by doubling."""
    hashed = _BYTE_VALUES[data]
    size = 1
    while size < GRAM:
        hashed = hashed[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + hashed[size:]
        hashed ^= hashed >> np.uint64(29)
        size *= 2
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    return hashed ^ (hashed >> np.uint64(32))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window, from running minima of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def fragments(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Text number and arrays of (first start, starts, smallest hash, inner): each start of a ``length``-byte string in one fragment.

    ``inner`` tells that the smallest hash stands in more than one place nearby, as it must if a string recurs within the
    fragment itself.
    """
    long = [(n, 0, len(t)) for n, t in enumerate(texts) if len(t) >= length]
    pieces = [(n, at, min(size, at + SEGMENT_BYTES + length - 1)) for n, _, size in long for at in range(0, size - length + 1, SEGMENT_BYTES)]
    at = 0
    while at < len(pieces):
        part, size = [], 0
        while at < len(pieces) and (not part or size + pieces[at][2] - pieces[at][1] <= SEGMENT_BYTES):
            part.append(pieces[at])
            size += pieces[at][2] - pieces[at][1]
            at += 1
        data = np.frombuffer(b"".join(texts[n][s:e] for n, s, e in part), np.uint8)
        hashes, width = gram_hashes(data), length - GRAM + 1
        least = sliding_minimum(hashes, width)
        edge = np.full(width - 1, np.iinfo(np.uint64).max)
        reached = ~sliding_minimum(~np.r_[~edge, least, ~edge], width)  # largest minimum among the windows of each place
        smallest = np.sort(hashes[hashes == reached])
        several = smallest[1:][smallest[1:] == smallest[:-1]]
        offsets = np.cumsum([0, *(e - s for _, s, e in part)])
        for (number, start, end), offset in zip(part, offsets):
            own = least[offset : offset + end - start - length + 1]
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            bounds = np.r_[0, cuts, len(own)]
            if np.diff(bounds).max() > FRAGMENT_STARTS:
                bounds = np.unique(np.r_[bounds, np.arange(0, len(own), FRAGMENT_STARTS)])
            chosen, inner = own[bounds[:-1]], np.isin(own[bounds[:-1]], several)
            yield number, start + bounds[:-1], np.diff(bounds), chosen, inner


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that a task never holds a whole batch of texts and what is found in them."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _fragment_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = [_bytes(t.as_py()) for t in batch.column(2)]
            held, count = [], 0

            def done():
                number = pa.array(np.repeat([n for n, *_ in held], [len(at) for _, at, *_ in held]))
                at, starts, hashed, inner, digest = (np.concatenate([h[i] for h in held]) for i in range(1, 6))
                return pa.RecordBatch.from_arrays(
                    [pa.array(hashed.view(np.int64)), pa.array(digest.view(np.int64)), batch.column(0).take(number), batch.column(1).take(number),
                     pa.array(at), pa.array(starts), pa.array(inner)],
                    ["h", "g", "k1", "k2", "at", "starts", "inside"],
                )

            for number, at, starts, hashed, inner in fragments(texts, length):
                text = texts[number]
                ends = (at + starts + (length - 1)).tolist()
                digest = np.fromiter((xxhash.xxh64_intdigest(text[s:e]) for s, e in zip(at.tolist(), ends)), np.uint64, len(at))
                held.append((number, at, starts, hashed, inner, digest))
                count += len(at)
                if count >= 50_000:
                    yield done()
                    held, count = [], 0
            if held:
                yield done()

    return run


def _cut_fragments(length: int):
    """Bytes of the wanted fragments of each document: (h, c, k1, k2, at, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for row in range(batch.num_rows):
                text, wanted = _bytes(columns["__text"][row].as_py()), columns["wanted"][row].as_py()
                n = len(wanted)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["h"] for w in wanted]), pa.array([w["c"] for w in wanted]), pa.array([w["hot"] for w in wanted]),
                        pa.array([columns["__k1"][row].as_py()] * n), pa.array([columns["__k2"][row].as_py()] * n),
                        pa.array([w["at"] for w in wanted]),
                        pa.array([text[w["at"] : w["at"] + w["starts"] + length - 1] for w in wanted], pa.binary()),
                    ],
                    ["h", "c", "hot", "k1", "k2", "at", "data"],
                )

    return run


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Which starts of each piece begin a ``length``-byte string that another start, in any piece, begins too."""
    sizes = np.array([len(p) + 1 for p in pieces])
    text = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(1)  # no UTF-8 text holds 255: separators become 0
    prefix, previous = permuted_common_prefixes(text, suffix_array(text, 256))
    at = np.flatnonzero(prefix >= length)
    marked = np.zeros(len(text), bool)
    marked[at] = marked[previous[at]] = True
    ends = np.cumsum(sizes)
    return [np.flatnonzero(marked[e - s : e - length]) for s, e in zip(sizes, ends)]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges that strings beginning at sorted starts cover."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(part[0]), int(part[-1]) + length) for part in np.split(starts, cuts)]


def _shards(length: int):
    """Suffix arrays over whole hashes, as many as fill a shard; ranges are given for fragments that occur once."""

    def solve(rows):
        out = [
            (c1, c2, at + s, at + e)
            for (_, c, c1, c2, at, _), starts in zip(rows, repeated_starts([r[5] for r in rows], length))
            if c == 1
            for s, e in _runs(starts, length)
        ]
        k1, k2, start, end = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k1, k2, start, end)], ["k1", "k2", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[0] != group[-1][0]:
                    held += group
                    size += sum(len(r[5]) for r in group)
                    group = []
                    if size >= SHARD_BYTES:
                        yield solve(held)
                        held, size = [], 0
                group.append(row)
        if held or group:
            yield solve(held + group)

    return run


def _strings(length: int):
    """Every string of the fragments under a crowded hash, as a 128-bit digest with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, at, data in zip(*(batch.column(n).to_pylist() for n in range(4))):
                digests = np.frombuffer(
                    b"".join(xxhash.xxh3_128_digest(data[s : s + length]) for s in range(len(data) - length + 1)), "<i8"
                ).reshape(-1, 2)
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(digests[:, 0])), pa.array(np.ascontiguousarray(digests[:, 1])),
                     pa.array([k1] * n), pa.array([k2] * n), pa.array(np.arange(at, at + n))],
                    ["d1", "d2", "k1", "k2", "start"],
                )

    return run


def _remove(names: list[str], as_text: bool, least_words: int):
    """Text without its ranges: appends size, maximal removed ranges and what remains, as bytes or as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            columns = dict(zip(batch.schema.names, batch.columns))
            sizes, removed, kept = [], [], []
            for text, ranges in zip(columns["__text"], columns["__ranges"]):
                data, merged = _bytes(text.as_py()), []
                for one in sorted((r["start"], r["end"]) for r in ranges.as_py() or []):
                    if merged and one[0] <= merged[-1][1]:
                        merged[-1] = (merged[-1][0], max(one[1], merged[-1][1]))
                    else:
                        merged.append(one)
                merged = [(s, e) for s, e in merged if e - s >= LENGTH or len(data[s:e].split()) >= least_words]
                edges = [0, *(edge for one in merged for edge in one), len(data)]
                sizes.append(len(data))
                removed.append([{"start": s, "end": e} for s, e in merged])
                rest = b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2]))
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(columns[n] for n in names), pa.array(sizes, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.string() if as_text else pa.binary())],
                [*names, "n_bytes", "removed", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, crowd: int = SHARD_FRAGMENTS,
    as_text: bool = False, least_words: int = 0,
) -> DataFrame:
    """All rows and columns with ``n_bytes``, ``removed`` (maximal byte ranges) and ``kept`` (remaining bytes) appended.

    With ``as_text`` the remaining bytes are text; bytes of a character that a cut has split are left out of it. Maximal ranges
    below 400 bytes stay if they hold fewer than ``least_words`` words, cut ones counted.

    Every byte goes that is covered by a ``length``-byte string of the UTF-8 text which also starts anywhere else, in the
    same document or another; strings are judged on the input and never cross documents. Null texts are empty; texts
    below ``length`` bytes lose nothing; repeated rows count as two places. Rows are told apart by 128-bit digests of id
    and text, so null and repeated ids are fine. Columns that had one of the appended names are replaced; names that begin
    with two underscores are reserved.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings below {2 * GRAM} bytes would need shorter grams")
    docs = docs.drop("n_bytes", "removed", "kept")
    names = docs.columns
    keys = {"__k1": F.xxhash64(id_column, text_column), "__k2": F.xxhash64(F.lit(1), text_column, id_column)}
    keyed = docs.select(*names, F.col(text_column).alias("__text"), *(key.alias(name) for name, key in keys.items()))

    found = materialise(
        keyed.select("__k1", "__k2", "__text").mapInArrow(_fragment_rows(length), "h bigint, g bigint, k1 bigint, k2 bigint, at bigint, starts bigint, inside boolean"),
        "repeats-fragments",
    )
    twice = found.groupBy("h").agg(F.count("*").alias("n"), F.max("inside").alias("inside")).filter("n > 1 OR inside").select("h")
    twice = materialise(twice, "repeats-hashes")
    meeting = materialise(found.join(twice, "h", "left_semi"), "repeats-meeting")
    distinct = materialise(
        meeting.groupBy("h", "g").agg(F.count("*").alias("c"), *(F.first(x).alias(x) for x in ("k1", "k2", "at", "starts", "inside"))),
        "repeats-distinct",
    )
    whole = meeting.join(distinct.filter("c > 1").select("h", "g"), ["h", "g"], "left_semi").select(
        "k1", "k2", F.col("at").alias("start"), (F.col("at") + F.col("starts") + (length - 1)).alias("end")
    )
    crowds = distinct.groupBy("h").agg(F.count("*").alias("different"), F.max("inside").alias("some"))
    crowds = crowds.filter("different > 1 OR some").select("h", "different")
    wanted = (
        distinct.join(materialise(crowds, "repeats-crowds"), "h")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("h", "c", (F.col("different") > crowd).alias("hot"), "at", "starts")).alias("wanted"))
    )
    wanted = wanted.withColumnsRenamed({"k1": "__k1", "k2": "__k2"})
    pieces = keyed.select("__text", "__k1", "__k2").join(wanted, ["__k1", "__k2"]).dropDuplicates(["__k1", "__k2"]).mapInArrow(
        _cut_fragments(length), "h bigint, c bigint, hot boolean, k1 bigint, k2 bigint, at bigint, data binary"
    )
    pieces = materialise(pieces, "repeats-pieces")
    ranges = "k1 bigint, k2 bigint, start bigint, end bigint"
    sharded = (
        pieces.filter("NOT hot").select("h", "c", "k1", "k2", "at", "data").repartition("h").sortWithinPartitions("h").mapInArrow(_shards(length), ranges)
    )
    strings = pieces.filter("hot").select("k1", "k2", "at", "data").mapInArrow(
        _strings(length), "d1 bigint, d2 bigint, k1 bigint, k2 bigint, start bigint"
    )
    repeated = materialise(strings.groupBy("d1", "d2").count().filter("count > 1").select("d1", "d2"), "repeats-strings")
    single = strings.join(repeated, ["d1", "d2"], "left_semi").select("k1", "k2", "start", (F.col("start") + length).alias("end"))
    covered = (
        whole.unionByName(sharded).unionByName(single).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("__ranges"))
    )
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join([*types, "n_bytes bigint", "removed array<struct<start: bigint, `end`: bigint>>", f"kept {'string' if as_text else 'binary'}"])
    covered = covered.withColumnsRenamed({"k1": "__k1", "k2": "__k2"})
    return keyed.join(covered, ["__k1", "__k2"], "left").select(*names, "__text", "__ranges").mapInArrow(_remove(names, as_text, least_words), schema)
