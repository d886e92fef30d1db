"""SimHash near duplicates, linked through one-wildcard variants of a few fingerprint segments.

Two fingerprints that differ in at most four of 64 bits differ in at most one bit of one of three segments. Every
distinct fingerprint is therefore indexed under each segment with each single bit left out (64 variants); fingerprints
that share a variant are compared over all bits. Variants held by very many fingerprints are cut into blocks and
compared block by block, so no task holds an unbounded group and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .components import connected_components

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
SEGMENTS = [(0, 21), (21, 21), (42, 22)]  # (first bit, width): one differs by one bit at most if the whole differs by four
BLOCK = 4096  # fingerprints of one variant compared in one task
SMALL = 16  # up to this many are compared in bulk, larger groups by breadth-first search
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, A-Z lower-cased; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[min(shingle, len(words)) - 1 :])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s : e - 1], SEED) for s, e in spans), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long. Null or blank texts have fingerprint 0."""
    kind = docs.schema[id_column].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    picked = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return picked.mapInArrow(compute, f"doc_id {kind}, fp bigint")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for number, (first, width) in enumerate(SEGMENTS):
            part = (values >> np.uint64(first)) & np.uint64((1 << width) - 1)
            for bit in range(width):
                key = (part & ~np.uint64(1 << bit)).astype(np.int64) | ((number * 22 + bit) << 22)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], ["key", "fp"])


def variants(distinct: DataFrame) -> DataFrame:
    """(key, fp): 64 rows per fingerprint; the key holds segment, left-out bit and the other bits of the segment."""
    return distinct.select("fp").mapInArrow(_variants, "key bigint, fp bigint")


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 1 << 20) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted batches as arrays (group number, key, fp), cut only between groups."""
    held: list[np.ndarray] = []
    count = 0

    def cut(last: bool):
        data = np.concatenate(held, axis=1)
        new = np.flatnonzero((np.diff(data[:3], axis=1) != 0).any(axis=0)) + 1
        end = data.shape[1] if last else (new[-1] if len(new) else 0)
        groups = np.zeros(data.shape[1], np.int64)
        groups[new] = 1
        return (np.cumsum(groups)[:end], data[0, :end], data[3, :end].view(np.uint64)), data[:, end:]

    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        count += batch.num_rows
        if count >= rows:
            done, rest = cut(False)
            yield done
            held, count = [rest], rest.shape[1]
    if count:
        yield cut(True)[0]


def _first_variant(key: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Whether this variant is the first one in which a pair with these differing bits meets."""
    number, bit = (key >> 22) // 22, (key >> 22) % 22
    first = np.zeros(len(key), bool)
    earlier = np.zeros(len(key), bool)
    for n, (start, width) in enumerate(SEGMENTS):
        inside = differing & np.uint64(((1 << width) - 1) << start)
        here = number == n
        meets = np.where(inside == 0, bit == 0, (inside >> (bit + start).astype(np.uint64)) & np.uint64(1) == 1)
        first |= here & meets & ~earlier
        earlier |= np.bitwise_count(inside) <= 1
    return first


def _links(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, key, fp in _whole_groups(batches):
            starts = np.flatnonzero(np.r_[True, np.diff(group) != 0])
            sizes = np.diff(np.r_[starts, len(group)])
            small = np.repeat(sizes <= SMALL, sizes)
            a, b = [], []
            for step in range(1, SMALL):
                at = np.flatnonzero((group[step:] == group[:-step]) & small[:-step])
                if not len(at):
                    break
                differing = fp[at] ^ fp[at + step]
                near = np.bitwise_count(differing) <= distance
                at, differing = at[near], differing[near]
                at = at[_first_variant(key[at], differing)]
                a.append(fp[at])
                b.append(fp[at + step])
            for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
                own = fp[start : start + size]
                for x, y in _forest(own, distance):
                    a.append(np.full(len(y), x, np.uint64))
                    b.append(y)
            if a:
                left, right = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

    return link


def _forest(values: np.ndarray, distance: int) -> Iterator[tuple[np.uint64, np.ndarray]]:
    """Links that span the groups of near values: breadth-first, each value compared once with those not yet reached."""
    rest, queue = values, []
    while len(rest):
        if queue:
            x = queue.pop()
        else:
            x, rest = rest[0], rest[1:]
        near = np.bitwise_count(rest ^ x) <= distance
        if near.any():
            yield x, rest[near]
            queue.extend(rest[near])
            rest = rest[~near]


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between fingerprints of at most ``distance`` (4 or less) differing bits, enough to span every component.

    ``distinct`` has a column ``fp`` without repeats. Groups of up to 16 give each link once; larger groups give a
    spanning forest of their links.
    """
    if distance > 4:
        raise ValueError("three segments find up to four differing bits")
    index = variants(distinct)
    hot = materialise(
        index.groupBy("key").count().filter(F.col("count") > block).select("key", F.ceil(F.col("count") / block).alias("blocks")),
        "simhash-hot",
    )
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))
    dealt = (
        index.join(hot, "key", "left")
        .select("key", "fp", own.alias("own"), F.coalesce("blocks", F.lit(1)).alias("blocks"))
        .select("key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    )
    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_links(distance), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, distance: int = MAX_DISTANCE
) -> DataFrame:
    """One row per input row: doc_id, fp (signed long), component_id, the smallest doc_id reachable by links, and root, the
    smallest fingerprint of the component.

    Links hold between fingerprints, so equal texts and repeated rows always share a component. Null and blank texts all
    have fingerprint 0 and link like any other. A row with a null id takes its component's smallest id (null if none has
    an id). Other columns are not read; an empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, id_column, text_column, shingle), "simhash-rows")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "simhash-distinct")
    roots = connected_components(links(distinct, distance), "a", "b")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = materialise(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "simhash-roots")
    named = materialise(rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id", "root"), "simhash-components")
    return rows.join(named, "fp", "left").select("doc_id", "fp", "component_id", "root")
