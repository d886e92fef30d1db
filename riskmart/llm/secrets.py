"""Secret scan with a trigram inverted index.

Each rule's regular expression yields a Boolean query over trigrams that every match must contain. Documents are
indexed in segments of a few megabytes inside the scanning tasks: one posting list per wanted trigram. Postings are
intersected and united as the query says, and only the remaining candidates are verified with the expression itself.
A rule without a mandatory trigram (a run of hex digits, say) scans every document. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op, _parser  # the parse tree of Python's own expressions

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SEGMENT_BYTES = 4 << 20
MAX_STRINGS = 64  # an exact set above this size is turned into a trigram query
MAX_CLASS = 8  # a character class above this size ends an exact string

ALL = ("all",)  # matches every document


@dataclass(frozen=True)
class Rule:
    """``keep`` is asked of every leftmost non-overlapping match; failing matches are dropped."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    keep: Callable[[re.Match], bool] = lambda match: True


BASE_RULES = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
        lambda m: m.end(2) - m.start(2) >= 8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", re.ASCII, lambda m: m.end() - m.start() >= 16),
    Rule("hex", r"[0-9a-f]+", re.ASCII, lambda m: m.end() - m.start() >= 32),
]
BASE_KINDS = [rule.kind for rule in BASE_RULES]

# Published formats of common credentials.
MORE_RULES = [
    # The BEGIN line with the lines up to the END line, or else with the long lines that follow it.
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----(?:(?:\r?\n[A-Za-z0-9+/=]+)*\r?\n-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----|(?:\r?\n[A-Za-z0-9+/=]{20,})*)"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}", re.ASCII | re.IGNORECASE),
]
RULES = BASE_RULES + MORE_RULES


def trigram_query(pattern: str, flags: int = re.ASCII) -> tuple:
    """What every match of ``pattern`` must contain, lower-cased: nested ``("and"|"or", ...)``, ``("tri", bytes)``, ``ALL``."""
    return _sequence(_parser.parse(pattern, flags))


def _both(*queries: tuple) -> tuple:
    parts = list(dict.fromkeys(q for q in queries if q != ALL))
    return ALL if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(*queries: tuple) -> tuple:
    parts = list(dict.fromkeys(queries))
    return ALL if ALL in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str]) -> tuple:
    """Each string gives the conjunction of its trigrams; strings shorter than three say nothing."""
    grams = [[("tri", s[i : i + 3].encode()) for i in range(len(s) - 2)] for s in sorted(strings)]
    return _either(*(_both(*g) if g else ALL for g in grams))


def _sequence(items) -> tuple:
    """Query of a concatenation: exact strings grow until something open follows, then become a query."""
    strings, query = {""}, ALL
    for item in items:
        exact, inner = _node(*item)
        if exact is not None and len(strings) * len(exact) <= MAX_STRINGS:
            strings = {a + b for a, b in product(strings, exact)}
            continue
        query = _both(query, _of_strings(strings), inner if exact is None else ALL)
        strings = exact if exact is not None else {""}
    return _both(query, _of_strings(strings))


def _strings(items) -> set[str] | None:
    """All strings a concatenation can match, lower-cased, or None if they are open or too many."""
    strings = {""}
    for item in items:
        exact, _ = _node(*item)
        if exact is None or len(strings) * len(exact) > MAX_STRINGS:
            return None
        strings = {a + b for a, b in product(strings, exact)}
    return strings


def _node(kind, value) -> tuple[set[str] | None, tuple]:
    """The exact strings of one parse node, or None with the query that holds in any case."""
    if kind is op.LITERAL:
        return ({chr(value).lower()} if value < 128 else None), ALL
    if kind is op.IN:
        chars = {c.lower() for k, v in value for c in _class(k, v)}
        return (chars if chars and len(chars) <= MAX_CLASS and "" not in chars else None), ALL
    if kind is op.SUBPATTERN:
        return _strings(value[-1]), _sequence(value[-1])
    if kind is op.BRANCH:
        each = [_strings(branch) for branch in value[1]]
        return (None if None in each else set().union(*each)), _either(*(_sequence(b) for b in value[1]))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        exact = _strings(inner)
        if exact is not None and (low, high) == (0, 1):
            return exact | {""}, ALL
        return None, _sequence(inner) if low else ALL
    return ({""} if kind is op.AT else None), ALL


def _class(kind, value) -> list[str]:
    """Members of a class item; an empty string marks an open one."""
    if kind is op.LITERAL and value < 128:
        return [chr(value)]
    if kind is op.RANGE and value[1] < 128:
        return [chr(c) for c in range(value[0], value[1] + 1)]
    return [""]


def wanted_trigrams(query: tuple) -> set[bytes]:
    return {query[1]} if query[0] == "tri" else set().union(*(wanted_trigrams(q) for q in query[1:])) if query[1:] else set()


def candidates(query: tuple, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Sorted numbers of the documents whose trigrams satisfy the query."""
    if query == ALL:
        return np.arange(n)
    if query[0] == "tri":
        return postings[query[1]]
    parts = sorted((candidates(q, postings, n) for q in query[1:]), key=len)
    return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), parts) if query[0] == "and" else reduce(np.union1d, parts)


class TrigramIndex:
    """Postings of the wanted trigrams over one segment of texts."""

    def __init__(self, wanted: set[bytes]):
        self.wanted = sorted(wanted)
        self.numbers = np.zeros(1 << 24, np.uint16)
        for number, gram in enumerate(self.wanted, 1):
            self.numbers[int.from_bytes(gram, "big")] = number

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        ends = np.cumsum([len(t) + 1 for t in texts])  # no wanted trigram holds the line break between texts
        data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        if len(data) < 3:
            return {gram: np.empty(0, np.int64) for gram in self.wanted}
        codes = data[:-2].astype(np.uint32) << 16
        codes |= data[1:-1].astype(np.uint32) << 8
        codes |= data[2:]
        numbers = self.numbers[codes]
        at = np.flatnonzero(numbers)
        found = np.unique(numbers[at].astype(np.int64) * len(texts) + np.searchsorted(ends, at, side="right"))
        cuts = np.searchsorted(found, np.arange(1, len(self.wanted) + 2) * len(texts))
        return {
            gram: found[cuts[i] : cuts[i + 1]] - (i + 1) * len(texts) for i, gram in enumerate(self.wanted)
        }


def _segments(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SEGMENT_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def scan_texts(texts: list[str], rules: list[Rule], index: TrigramIndex, queries: list[tuple]) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) of each text, by start and then in the order of the rules."""
    out: list[list[tuple[int, int, int]]] = []
    for part in _segments(texts):
        spans: list[list[tuple[int, int, int]]] = [[] for _ in part]
        postings = index.postings([t.encode("utf-8", "surrogatepass") for t in part])
        for order, (rule, query) in enumerate(zip(rules, queries)):
            expression = re.compile(rule.pattern, rule.flags)
            for number in candidates(query, postings, len(part)):
                spans[number] += [(m.start(), order, m.end()) for m in expression.finditer(part[number]) if rule.keep(m)]
        out += spans
    return [[(rules[order].kind, start, end) for start, order, end in sorted(found)] for found in out]


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of (kind, start, end) in code points, end exclusive.

    Spans are ordered by start, then in the order of the rules. A null or empty text has no spans; a null id stays
    null; repeated rows each give a row. Other columns are not read.
    """
    rules = RULES if rules is None else rules
    queries = [trigram_query(rule.pattern, rule.flags) for rule in rules]
    wanted = set().union(*map(wanted_trigrams, queries))
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(wanted)
        for batch in batches:
            found = scan_texts(batch.column(1).to_pylist(), rules, index, queries)
            spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in one] for one in found], spans_type)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["doc_id", "spans"])

    return docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).mapInArrow(scan, schema)
