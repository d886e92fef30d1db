"""Bias of one facet value against everybody else."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .profiling import column_values

# The four-fifths rule as an interval for disparate impact.
FOUR_FIFTHS = (0.8, 1.25)


def bias_metrics(
    df: DataFrame, facets: Mapping[str, Sequence[str] | None], label: str, prediction: str, min_rows: int = 30
) -> DataFrame:
    """Pre- and post-training bias for every listed facet value (all values where the list is None).

    Counts per facet value come from one aggregate over all facet columns; "everybody else" is the column total
    minus the facet, which includes rows whose facet is NULL. Undefined ratios are NULL.
    """
    y, p = F.col("_y"), F.col("_p")
    carry = [F.col(label).cast("int").alias("_y"), F.col(prediction).cast("int").alias("_p")]
    counts = column_values(df, list(facets), carry).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos"), F.sum("_p").alias("sel"),
        F.count(F.when(y == p, 1)).alias("hit"), F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
    )
    parts = ["n", "pos", "sel", "hit", "tp"]
    totals = counts.groupBy("column").agg(*[F.sum(c).alias(f"all_{c}") for c in parts])
    wanted = F.lit(False)
    for column, values in facets.items():
        here = F.col("column") == column
        wanted = wanted | (here if values is None else here & F.col("value").isin(list(values)))
    chosen = counts.where(wanted & F.col("value").isNotNull() & (F.col("n") >= min_rows)).join(totals, "column")
    chosen = chosen.select("*", *[(F.col(f"all_{c}") - F.col(c)).alias(f"o_{c}") for c in parts])

    def rate(top: str, bottom: str) -> Column:
        return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))

    sel_f, sel_o = rate("sel", "n"), rate("o_sel", "o_n")
    acc_f, acc_o = rate("hit", "n"), rate("o_hit", "o_n")
    rec_f, rec_o = rate("tp", "pos"), rate("o_tp", "o_pos")
    impact = F.try_divide(sel_f, sel_o)
    return chosen.select(
        "column", "value", F.col("n").alias("n_facet"), F.col("o_n").alias("n_other"),
        F.try_divide((F.col("o_n") - F.col("n")).cast("double"), F.col("all_n").cast("double")).alias("class_imbalance"),
        (rate("pos", "n") - rate("o_pos", "o_n")).alias("difference_in_label_proportion"),
        impact.alias("disparate_impact"),
        (sel_f - sel_o).alias("difference_in_selection_rate"),
        (acc_f - acc_o).alias("accuracy_difference"), (rec_f - rec_o).alias("recall_difference"),
        sel_f.alias("selection_rate_facet"), sel_o.alias("selection_rate_other"),
        acc_f.alias("accuracy_facet"), acc_o.alias("accuracy_other"),
        rec_f.alias("recall_facet"), rec_o.alias("recall_other"),
        F.coalesce(impact.between(*FOUR_FIFTHS), F.lit(False)).cast("int").alias("within_four_fifths"),
    )


def long_report(metrics: DataFrame, keys: Sequence[str], section: str) -> DataFrame:
    """``section, subject, metric, value`` rows of a wide metric table."""
    values = [c for c in metrics.columns if c not in keys]
    subject = F.concat_ws("=", *[F.col(k) for k in keys]).alias("subject")
    cast = metrics.select(F.lit(section).alias("section"), subject, *[F.col(v).cast("double").alias(v) for v in values])
    return cast.unpivot(["section", "subject"], values, "metric", "value")


def fairness_report(bias: DataFrame, attribution: DataFrame) -> DataFrame:
    """Bias per facet and feature attribution in one long table. ``attribution`` has ``feature, mean_abs``."""
    return long_report(bias, ["column", "value"], "bias").unionByName(
        long_report(attribution.select("feature", "mean_abs"), ["feature"], "attribution")
    )
