"""Quality rules: a decision list learnt from labelled text statistics and applied as one conditional expression.

Sequential covering: a rule grows by the threshold condition with the largest information gain on two thirds of the
labelled documents, is cut back to the prefix that does best on the other third, and is kept while it is precise there;
its documents are then set aside and the next rule grows. Statistics, learning and verdicts are DataFrame operations;
the driver sees one row per statistic, bin and label.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

BINS = 64  # cut points per statistic, between quantiles of the labelled documents
MAX_CONDITIONS = 3
MAX_RULES = 12
LEAST_COVERED = 3  # documents of the held-back third a rule must cover
LEAST_PRECISION = 0.95  # share of rejected ones among them that are labelled bad

_BLANK = r"[ \\t-\\r]"
_COUNTS = {
    "n_words": "cast(size(words) as bigint)",
    "word_chars": "cast(char_length(array_join(words, '')) as bigint)",
    "n_symbols": "cast(regexp_count(text, '[#*$%&|<>]') as bigint)",
    "n_lines": "cast(size(lines) as bigint)",
    "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
    "n_upper": r"cast(regexp_count(text, '\\p{Lu}') as bigint)",
}
# Windows of three words as (hash, place) in order; equal neighbours recur. Each starts three words at most.
_REPEATED = """
CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
  aggregate(
    transform(
      array(sort_array(transform(windows, (h, i) -> struct(h, i)))),
      s -> array_sort(array_distinct(flatten(filter(
        zip_with(s, slice(s, 2, size(s)), (a, b) -> IF(a.h = b.h, array(a.i, b.i), NULL)), x -> x IS NOT NULL))))
    ), 0L,
    (total, places) -> total + aggregate(
      zip_with(places, slice(places, 2, size(places)), (a, b) -> least(3, coalesce(b - a, 3))), 0L, (n, x) -> n + x)
  )
END
"""
STATISTICS = {
    "words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
}


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool  # statistic >= threshold, else below it
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, the counts and the shares of every row, over whole texts; a null text has no words.

    Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return. Repeated windows
    are recognised by 64-bit hashes within one text.
    """
    text = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    split = text.selectExpr(
        "doc_id", "text", f"array_remove(split(text, '{_BLANK}+'), '') AS words",
        rf"filter(split(text, '\\n'), line -> line RLIKE '[^ \\t-\\r]') AS lines",
    )
    counted = split.selectExpr(
        "doc_id", *(f"{expression} AS {name}" for name, expression in _COUNTS.items()),
        """IF(size(words) < 3, cast(array() AS array<bigint>), transform(sequence(0, size(words) - 3),
           i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))) AS windows""",
    )
    rows = counted.selectExpr("doc_id", *_COUNTS, f"{_REPEATED} AS n_repeat_words")
    return rows.selectExpr("*", *(f"{expression} AS {name}" for name, expression in STATISTICS.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn_rules(statistics: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality") -> list[Rule]:
    """Ordered rules that reject documents labelled 0; rows without a label or an id teach nothing.

    Rows that fail the base rule are left out, since it has judged them. Labelled rows are counted once per combination of bins, so every later step reads that table only. The split for
    growing and pruning follows a hash of the id. Ties between conditions go to the first statistic and threshold.
    """
    marked = labels.select(F.col(id_column).alias("doc_id"), (F.col(label_column) == 0).alias("bad")).filter("bad IS NOT NULL")
    known = statistics.filter(~base_failed()).join(marked, "doc_id")
    levels = [(i + 1) / BINS for i in range(BINS - 1)] + [0.98, 0.99, 0.995]
    found = known.agg(*(F.percentile_approx(s, levels, 10_000).alias(s) for s in STATISTICS)).first()
    if found[0] is None:
        return []
    values = {s: sorted(set(found[s])) for s in STATISTICS}
    cuts = {s: [(a + b) / 2 for a, b in zip(own, own[1:])] for s, own in values.items()}  # halfway, so as to hold beyond the labelled
    bins = [sum(((F.col(s) >= cut).cast("int") for cut in cuts[s]), F.lit(0)).alias(s) for s in STATISTICS]
    grow = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0).alias("grow")
    cells = materialise(known.select(grow, "bad", *bins).groupBy("grow", "bad", *STATISTICS).count(), "quality-cells")
    rules: list[list[tuple[str, bool, int]]] = []

    def holds(condition: tuple[str, bool, int]) -> Column:
        statistic, above, number = condition
        return F.col(statistic) >= number if above else F.col(statistic) < number

    def fires(rule) -> Column:
        fired = F.lit(True)
        for condition in rule:
            fired = fired & holds(condition)
        return fired

    while len(rules) < MAX_RULES:
        left = cells
        for rule in rules:
            left = left.filter(~fires(rule))
        rule, score = _grow_rule(left, fires)
        if rule is None or score < LEAST_PRECISION:
            break
        rules.append(rule)
    return [tuple(Condition(s, above, cuts[s][number - 1]) for s, above, number in rule) for rule in rules]


def _counts(cells: DataFrame) -> dict[tuple[str, int], dict[tuple[bool, bool], int]]:
    """(statistic, bin) -> (grow, bad) -> documents: one row per statistic, bin and label comes to the driver."""
    long = cells.unpivot(["grow", "bad", "count"], list(STATISTICS), "statistic", "bin")
    found: dict = {}
    for row in long.groupBy("statistic", "bin", "grow", "bad").agg(F.sum("count").alias("n")).collect():
        found.setdefault((row.statistic, row.bin), {})[(row.grow, row.bad)] = row.n
    return found


def _grow_rule(left: DataFrame, fires) -> tuple[list | None, float]:
    """The best prefix of a greedily grown rule and its precision on the held-back third."""
    rule, best, best_score = [], None, -1.0
    while len(rule) < MAX_CONDITIONS:
        counts = _counts(left.filter(fires(rule)))
        if not counts:
            break
        first = next(iter(STATISTICS))
        whole = _total(n for (s, _), n in counts.items() if s == first)
        if not whole[True, True] or not whole[True, False]:
            break
        chosen, gain = None, 0.0
        for statistic in STATISTICS:
            numbers = sorted(b for s, b in counts if s == statistic)
            for number in numbers[1:]:
                for above in (True, False):
                    part = _total(n for (s, b), n in counts.items() if s == statistic and (b >= number) == above)
                    own = _gain(part[True, True], part[True, False], whole[True, True], whole[True, False])
                    if own > gain + 1e-9:
                        chosen, gain, kept = (statistic, above, number), own, part
        if chosen is None:
            break
        rule = [*rule, chosen]
        bad, good = kept[False, True], kept[False, False]
        score = bad / (bad + good) if bad + good >= LEAST_COVERED else -1.0
        if score > best_score:
            best, best_score = rule, score
    return best, best_score


def _total(parts) -> dict[tuple[bool, bool], int]:
    total = {(g, b): 0 for g in (True, False) for b in (True, False)}
    for part in parts:
        for key, n in part.items():
            total[key] += n
    return total


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Information gained about the bad documents covered."""
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(all_bad / (all_bad + all_good)))


def verdict(rules: list[Rule]) -> Column:
    """Text of the first rule that rejects a document, null if none does: one ordered conditional expression."""
    chosen = F.lit(None).cast("string")
    for rule in reversed(rules):
        fired = F.lit(True)
        for condition in rule:
            fired = fired & condition.column()
        chosen = F.when(fired, F.lit(" and ".join(map(str, rule)))).otherwise(chosen)
    return chosen


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, statistics, ``base_failed``, the rejecting ``rule`` (null if none) and ``kept`` of every row.

    Null and empty texts fail the base rule. Repeated rows and null ids give a row each. Without usable labels only the
    base rule decides. Extra columns are not read.
    """
    rows = materialise(text_statistics(docs, id_column, text_column), "quality-statistics")
    rule = verdict(learn_rules(rows, labels))
    judged = rows.withColumns({"base_failed": base_failed(), "rule": rule})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
