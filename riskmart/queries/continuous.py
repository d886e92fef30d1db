"""Work that goes on: monitoring states by day, alarm transitions, feature history, rows scored as they land."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import null_markers
from ..operators import modeling, monitoring, states
from ..plans import evaluation as jobs
from ..session import work_path
from ..sources.catalog import append_features
from ..sources.history import delete_features, features_as_of, join_as_of
from ..streaming.scoring import read_worklist, score_stream, write_scored_batch
from ..streaming.transitions import alarm_transitions, streamed_transitions
from .aggregates import rounded
from .models import _SCORED_2, features
from .quality import _DQ, _DQ_CATEGORICAL, _DQ_SQL, _VIOLATIONS, _dq_sql, _halves
from .registry import CHECKS, query
from .sql import check
from .storage import _table
from .tables import encounters, records, table

_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


def _save_by_day(df, day, path, columns, numeric=()):
    """States of each value of ``day``, one write a day, the way days arrive."""
    dated = df.withColumn("_day", day)
    for (name,) in sorted(dated.select("_day").distinct().collect()):
        states.save_day(dated.where(F.col("_day") == name), name, path, columns, numeric)


@query("q8_merged_baseline", check("WITH " + _dq_sql("SELECT *, 'train' AS split FROM encounters", _DQ, _DQ_CATEGORICAL) + """
SELECT "column", n, n_null, round(completeness, 6) AS completeness, n_distinct,
  round(share_integral, 6) AS share_integral, round(share_fractional, 6) AS share_fractional, round(share_text, 6) AS share_text FROM b"""))
def _(spark, folder):
    path = work_path(spark, "states")
    _save_by_day(null_markers(encounters(spark, folder)), F.concat(F.lit("day"), F.col("encounter_id").cast("bigint") % 4), path, _DQ)
    return rounded(monitoring.column_profile(states.merged_counts(spark, path)))


@query("q8_merged_statistics", CHECKS["q8_numeric_statistics"])
def _(spark, folder):
    path = work_path(spark, "states")
    _save_by_day(table(spark, folder, "lineitem"), F.concat(F.lit("day"), F.col("l_linenumber") % 3), path, ["l_returnflag"], _NUMERIC)
    return rounded(states.merged_statistics(spark, path), 4)


@query("q12_from_states", check(f"WITH {_DQ_SQL}, {_VIOLATIONS} SELECT * FROM violations"))
def _(spark, folder):
    paths = []
    for half in _halves(spark, folder):
        paths.append(work_path(spark, "states"))
        _save_by_day(half, F.concat(F.lit("day"), F.col("encounter_id").cast("bigint") % 3), paths[-1], _DQ)
    return states.violations_from_states(spark, *paths, _DQ_CATEGORICAL)


_TRANSITIONS = """
WITH w AS (SELECT CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS p, event_type, avg(value) AS a FROM events GROUP BY ALL),
u AS (SELECT CAST(floor((epoch_us(max(ts)) - 3600000000) / 60000000) AS BIGINT) AS last FROM events),
b AS (SELECT p, event_type, last, lag(p) OVER o AS before, lead(p) OVER o AS after FROM w, u WHERE a > 20 AND p + 1 <= last
  WINDOW o AS (PARTITION BY event_type ORDER BY p)),
t AS (SELECT p, event_type, 'ALARM' AS state FROM b WHERE before IS NULL OR before < p - 1
  UNION ALL SELECT p + 1, event_type, 'OK' FROM b WHERE (after IS NULL OR after > p + 1) AND p + 2 <= last)
SELECT make_timestamp(p * 60000000) AS period_start, event_type, state FROM t"""


@query("t2_alarm_transitions", _TRANSITIONS)
def _(spark, folder):
    events = table(spark, folder, "events")
    until = F.lit(events.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0])
    twice = events.unionByName(events.where("event_id % 3 = 0"))  # repeated events count once
    return alarm_transitions(twice, "ts", "event_type", "value", "event_id", 20.0, until=until)


@query("t2_alarm_transitions_streamed", _TRANSITIONS)
def _(spark, folder):
    """The table lands in four parts in the order of time; then a part lands again, late and repeated."""
    events = table(spark, folder, "events")
    landing, sink, state = (work_path(spark, n) for n in ("landing", "transitions", "transitions-state"))
    low, high = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    part = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - low) / ((high - low + 1) / 4)), F.lit(3))
    for number in (0, 1, 2, 3, 2):
        events.where(part == number).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    changes = streamed_transitions(stream, "ts", "event_type", "value", "event_id", "1 hour", 20.0)
    run = (changes.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state)
           .outputMode("append").trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.parquet(sink)


_DAY = 86_400.0
_START = 1_700_000_000.0


@query("s11_features_as_of", check("""
SELECT id, CASE WHEN id % 2 = 0 THEN price * 2 ELSE price END AS price FROM records WHERE id % 5 <> 0"""))
def _(spark, folder):
    """Four appends a day apart, one of them of deletions; read between the third and the fourth."""
    name, path = _table(spark, "history")
    rows = records(spark, folder).select("id", "price")

    def append(df, number):
        append_features(df.withColumn("event_time", F.lit(_START + number * _DAY)), name, path, _START + number * _DAY)

    append(rows, 0)
    append(rows.where("id % 2 = 0").withColumn("price", F.col("price") * 2), 1)
    delete_features(spark, rows.where("id % 5 = 0").select("id"), name, path, "id", _START + 2 * _DAY)
    append(rows.withColumn("price", F.col("price") * 3), 3)
    return features_as_of(spark, name, "id", _START + 2.5 * _DAY).select("id", "price")


@query("s11_join_as_of", """
WITH f AS (SELECT o_custkey, CAST(o_orderdate AS TIMESTAMP) AS at_time, max(o_totalprice) AS price FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL)
SELECT o.o_orderkey, f.price FROM orders o ASOF LEFT JOIN f ON f.o_custkey = o.o_custkey AND f.at_time <= CAST(o.o_orderdate AS TIMESTAMP)""")
def _(spark, folder):
    """Every order with the highest price of its customer's latest day, up to its own, among every third order."""
    orders = table(spark, folder, "orders")
    prices = orders.where("o_orderkey % 3 = 0").groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("price"))
    found = join_as_of(orders.select("o_orderkey", "o_custkey", "o_orderdate"), prices, "o_custkey", "o_orderdate", "o_orderdate", ["price"],
                       day_seconds=200 * 86_400)
    return found.select("o_orderkey", "price")


@query("m11_streamed_worklist", check(f"WITH {_SCORED_2} SELECT encounter_id, round(s, 4) AS score FROM scored WHERE split = 'production'"))
def _(spark, folder):
    """Production rows land in files, are scored batch by batch, and one batch is run again."""
    model = modeling.fit_plain_logistic(features(spark, folder, "train"), jobs.BENCHMARK_FEATURES, S.TARGET)
    production = features(spark, folder, "production").select("encounter_id", *jobs.BENCHMARK_FEATURES)
    landing, path, state = (work_path(spark, n) for n in ("landing", "worklist", "worklist-state"))
    production.repartition(4, "encounter_id").write.parquet(landing)

    def score(batch):
        return modeling.add_score(batch, model).select("encounter_id", F.round("score", 4).alias("score"))

    stream = spark.readStream.schema(production.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    score_stream(stream, score, path, "2024-01-01", state).awaitTermination()
    write_scored_batch(spark.read.parquet(path).where("batch = 0").select("encounter_id", "score"), f"{path}-again", "2024-01-01", 0)
    write_scored_batch(spark.read.parquet(f"{path}-again").select("encounter_id", "score"), path, "2024-01-01", 0)
    return read_worklist(spark, path, "2024-01-01")


@query("m14_tree_attribution")
def _(spark, folder):
    from ..operators import attribution, boosting
    from .models import _schema

    train = features(spark, folder, "train")
    model = boosting.fit_second_order(train, _schema(train), S.TARGET, "encounter_id", {"num_round": 2, "max_depth": 3}).model()
    return rounded(attribution.tree_attribution(model, features(spark, folder, "production"), "encounter_id"))


@query("m8_halving_search")
def _(spark, folder):
    """All 25 declared trials over a schema of six columns; the winner's refit is scored on validation."""
    from ..operators import search
    from ..operators.ranking import ranking_metrics

    schema = modeling.FeatureSchema(("race", "medical_specialty"), ("number_inpatient", "time_in_hospital", "num_medications", "age_ordinal"))
    train, validation = features(spark, folder, "train"), features(spark, folder, "validation")
    ranges = {**search.SEARCH_RANGES, "max_depth": (2, 3, "integer"), "num_round": (3, 4, "integer")}
    trials, model = search.halving_search(train, validation, schema, S.TARGET, "encounter_id", rungs=(1, 2, 4), ranges=ranges)
    refit = ranking_metrics(model.add_score(validation), "score", S.TARGET).first()["pr_auc"]
    return rounded(trials.withColumn("refit_pr_auc", F.when(F.col("won"), F.lit(refit))))
