from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskmart.operators import monitoring, profiling, states
from riskmart.plans import features as feature_jobs
from riskmart.sources import catalog, history
from riskmart.streaming import scoring, transitions

START = dt.datetime(2024, 1, 1)


def day_rows(seed, n=60):
    rng = random.Random(seed)
    return [(rng.choice(["x", "y", None, "1", "2.5"]), rng.choice([None, 1.0, 2.0, 1e9 + seed])) for _ in range(n)]


def test_merged_states_equal_all_rows(spark, tmp_path):
    path, kind = str(tmp_path / "states"), "c string, v double"
    days = {f"2024-01-0{i}": day_rows(i) for i in range(1, 4)}
    for day, rows in days.items():
        states.save_day(spark.createDataFrame(rows, kind), day, path, ["c", "v"], ["v"])
    states.save_day(spark.createDataFrame(days["2024-01-02"], kind), "2024-01-02", path, ["c", "v"], ["v"])  # written again
    for chosen in (None, ["2024-01-01", "2024-01-03"]):
        every = spark.createDataFrame([r for d in chosen or days for r in days[d]], kind)
        merged, direct = states.merged_counts(spark, path, chosen), profiling.value_counts(every, ["c", "v"])
        assert sorted(map(tuple, merged.select("column", "value", "n").collect()), key=str) == sorted(map(tuple, direct.select("column", "value", "n").collect()), key=str)
        assert sorted(map(str, monitoring.column_profile(merged).collect())) == sorted(map(str, monitoring.column_profile(direct).collect()))
        got, want = states.merged_statistics(spark, path, chosen).first(), profiling.numeric_statistics(every, ["v"]).first()
        assert (got.n_present, got.n_null, got.min, got.max) == (want.n_present, want.n_null, want.min, want.max)
        assert got["mean"] == pytest.approx(want["mean"]) and got["std"] == pytest.approx(want["std"])


def test_empty_day(spark, tmp_path):
    states.save_day(spark.createDataFrame([], "c string, v double"), "2024-01-01", str(tmp_path), ["c"], ["v"])
    assert states.merged_counts(spark, str(tmp_path)).collect() == []


EVENTS = "id long, ts timestamp_ntz, host string, v double"


def events(seed, n=400):
    rng = random.Random(seed)
    return [(i, START + dt.timedelta(seconds=rng.randrange(3600)), rng.choice(["a", "b", None]), rng.choice([None, 10.0, 95.0, 99.0])) for i in range(n)]


def by_definition(rows, until, period=60):
    sums = {}
    for _, ts, host, v in {r[0]: r for r in rows}.values():
        if v is not None:
            sums.setdefault((host, int((ts - START).total_seconds()) // period), []).append(v)
    last = int((until - START).total_seconds()) // period
    out = []
    for host in {h for h, _ in sums}:
        alarmed = False
        for p in range(last):
            values = sums.get((host, p), [])
            now = bool(values) and sum(values) / len(values) > 90
            if now != alarmed:
                out.append((START + dt.timedelta(seconds=p * period), host, "ALARM" if now else "OK"))
            alarmed = now
    return sorted(out, key=str)


def test_transitions_of_a_batch(spark):
    rows = events(1)
    until = START + dt.timedelta(seconds=2000)
    found = transitions.alarm_transitions(spark.createDataFrame(rows + rows[:50], EVENTS), "ts", "host", "v", "id", until=F.lit(until))
    assert sorted(map(tuple, found.collect()), key=str) == by_definition(rows, until)


def test_stream_equals_batch_under_late_and_repeated_events(spark, tmp_path):
    rows = sorted(events(2), key=lambda r: r[1])
    rng = random.Random(3)
    parts = [rows[i : i + 80] for i in range(0, 400, 80)]
    for i in range(1, 5):  # some events arrive a part late, within the delay; some arrive twice
        late = [r for r in parts[i - 1] if rng.random() < 0.2 and r[1] > parts[i - 1][-1][1] - dt.timedelta(minutes=5)]
        parts[i - 1] = [r for r in parts[i - 1] if r not in late]
        parts[i] = parts[i] + late + rng.sample(parts[i], 20)
    parts.append([(9999, START - dt.timedelta(hours=1), "a", 99.0), rows[0]])  # far too late
    folder, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
    changes = transitions.streamed_transitions(stream, "ts", "host", "v", "id", "20 minutes")
    for _ in range(2):  # the second run has nothing new to do
        changes.writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "state")).outputMode(
            "append").trigger(availableNow=True).start().awaitTermination()
    until = max(r[1] for r in rows) - dt.timedelta(minutes=20)
    assert sorted(map(tuple, spark.read.parquet(sink).collect()), key=str) == by_definition(rows, until)


def test_features_as_of(spark, tmp_path):
    name, path, day = "asof_features", str(tmp_path / "features"), 86_400.0

    def append(rows, at):
        catalog.append_features(spark.createDataFrame(rows, "k string, x double").withColumn("event_time", F.lit(at)), name, path, at)

    append([("a", 1.0), ("b", 1.0), (None, 1.0)], 10 * day)
    append([("a", 2.0), ("c", None)], 11 * day)
    history.delete_features(spark, spark.createDataFrame([("b",)], "k string"), name, path, "k", 12 * day)
    append([("b", 3.0)], 13 * day)

    def at(t):
        return sorted(((r.k, r.x) for r in history.features_as_of(spark, name, "k", t * day).collect()), key=str)

    assert at(9) == [] and at(10) == sorted([("a", 1.0), ("b", 1.0), (None, 1.0)], key=str)
    assert at(11.5) == sorted([("a", 2.0), ("b", 1.0), ("c", None), (None, 1.0)], key=str)
    assert at(12.5) == sorted([("a", 2.0), ("c", None), (None, 1.0)], key=str) and ("b", 3.0) in at(13)
    plan = history.features_as_of(spark, name, "k", 11 * day)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    spark.sql(f"DROP TABLE {name}")


def test_join_as_of(spark):
    rng = random.Random(5)
    left = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, rng.randrange(1000) * 1.0]), "old") for i in range(80)]
    right = [(k, t * 1.0, f"{k}{t}", rng.random() < 0.2) for k in "ab" for t in rng.sample(range(1000), 25)] + [(None, 1.0, "x", False)]
    found = history.join_as_of(
        spark.createDataFrame(left, "id long, k string, t double, v string"), spark.createDataFrame(right, "k string, t double, v string, gone boolean"),
        "k", "t", "t", ["v"], "gone", day_seconds=100)
    assert found.columns == ["id", "k", "t", "v"]
    expected = []
    for i, k, t, _ in left:
        hits = [r for r in right if k is not None and t is not None and r[0] == k and r[1] <= t]
        best = max(hits, key=lambda r: r[1], default=None)
        expected.append((i, k, t, None if best is None or best[3] else best[2]))
    assert sorted(map(tuple, found.collect())) == expected


def test_scoring_again_changes_nothing(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "worklist")
    df = spark.range(40).withColumn("x", F.col("id") / 7)
    df.repartition(3).write.parquet(landing)

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        scoring.score_stream(stream, lambda b: b.select("id", (F.col("x") * 2).alias("score")), path, "2024-01-01", str(tmp_path / "state")).awaitTermination()
        return sorted(map(tuple, scoring.read_worklist(spark, path, "2024-01-01").collect()))

    first = run()
    assert first == [(i, i / 7 * 2) for i in range(40)]
    batch = spark.createDataFrame(spark.read.parquet(path).where("batch = 1").select("id", "score").collect(), "id long, score double")
    scoring.write_scored_batch(batch, path, "2024-01-01", 1)  # as after a failure
    scoring.write_scored_batch(batch, path, "2024-01-02", 1)  # another date
    assert run() == first
    spark.range(40, 45).withColumn("x", F.col("id") / 7).coalesce(1).write.mode("append").parquet(landing)
    assert len(run()) == 45


def test_feature_job_asks_for_all_rows(spark, tmp_path, monkeypatch):
    clean = spark.createDataFrame([(str(i), "p", 1, 1.5) for i in range(6)], "encounter_id string, patient_nbr string, readmit_30 int, x double")
    found = feature_jobs.run_feature_job(spark, clean, "all_rows", str(tmp_path / "a"), 1.7e9)
    assert found["records_ingested"] == 6
    append = feature_jobs.append_features
    monkeypatch.setattr(feature_jobs, "append_features", lambda df, *rest: append(df.where("encounter_id <> '3'"), *rest))  # loses a row
    with pytest.raises(RuntimeError):
        feature_jobs.run_feature_job(spark, clean, "all_rows", str(tmp_path / "a"), 1.7e9 + 1)
    spark.sql("DROP TABLE all_rows")
