from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F, types as T

from riskmart import schema as S
from riskmart.config import Settings
from riskmart.operators.gates import GateFailure
from riskmart.plans import features as jobs
from riskmart.sources import catalog, csv, manifest, reports, stacked

STACKED = (
    "admission_type_id,description\n1,Planned\n6,NULL\n8,\n,\ndischarge_disposition_id,description\n"
    '1,"To kin, ""by car"""\n\n,\nadmission_source_id,description\n7, By boat\n'
)
TABLES = {name: [key, "description"] for name, key in S.DIMENSIONS.items()}


def test_stacked_tables(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text(STACKED)
    tables = stacked.read_stacked(spark, str(path), TABLES)
    first = [tuple(r)[:2] for r in tables["admission_type"].orderBy("line_no").collect()]
    assert first == [("1", "Planned"), ("6", "NULL"), ("8", None)]
    assert tables["discharge_disposition"].first()["description"] == 'To kin, "by car"'
    assert tables["admission_source"].first()["description"] == " By boat"


@pytest.mark.parametrize("text,message", [
    (STACKED.split("\n\n")[0] + "\n", "found 2"), (STACKED + "\nextra,description\n1,x\n", "found 4"),
    (STACKED.replace("admission_source_id", "source"), "expected columns"),
])
def test_stacked_errors(spark, tmp_path, text, message):
    path = tmp_path / "ids.csv"
    path.write_text(text)
    with pytest.raises(stacked.StackedFileError, match=message):
        stacked.read_stacked(spark, str(path), TABLES)


def test_csv_keeps_text_and_spaces(spark, tmp_path):
    rows = [("NA", 'quo"te', " 428 "), ("None", "a,b", "?"), ("x", "back\\slash", None)]
    path = str(tmp_path / "out")
    csv.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), path)
    schema = S.all_strings(["a", "b", "c"])
    assert sorted(map(tuple, csv.read_csv(spark, path, schema).collect()), key=str) == sorted(rows, key=str)
    assert {r["a"] for r in csv.read_csv_with_default_nulls(spark, path, schema).collect()} == {None, "x"}


def test_typed_csv_keeps_bad_rows(spark, tmp_path):
    path = tmp_path / "scores.csv"
    path.write_text("a,0.5\nb,oops\nc,\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("score", T.DoubleType())])
    assert [tuple(r) for r in csv.read_typed_csv(spark, str(path), schema).orderBy("id").collect()] == [("a", 0.5), ("b", None), ("c", None)]


def test_manifest(spark, tmp_path):
    contents = {"one.csv": b"h\n1\n2\n", "two.csv": b"h\n1\n\"a\nb\"", "odd.csv": b"h\r1\r2\n"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    rows = {r["filename"]: r for r in manifest.manifest(spark, [str(tmp_path)], "now").collect()}
    assert set(rows) == set(contents)
    for name, content in contents.items():
        assert rows[name]["sha256"] == hashlib.sha256(content).hexdigest()
        assert rows[name]["row_count"] == len(content.splitlines(True) if b"\r" not in content else content.split(b"\n")[:-1]) - 1


def test_partitioned_table_overwrites_stale_partitions(spark, tmp_path):
    path, table = str(tmp_path / "t"), "stale_check"
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string")
    catalog.write_partitioned(df, table, path)
    assert catalog.read_partition(spark, table, "test").columns == ["id", "split"]
    plan = catalog.read_partition(spark, table, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    catalog.write_partitioned(df.where("split = 'train'"), table, path)
    assert [r["split"] for r in spark.table(table).collect()] == ["train"]


def test_dated_output_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "predictions")
    df = spark.createDataFrame([("a", 0.5)], "id string, score double")
    for date, rows in (("2024-01-01", df), ("2024-01-02", df), ("2024-01-02", df.union(df))):
        catalog.write_dated(rows, path, date)
    assert sorted(r["dt"] for r in spark.read.schema("id string, score double, dt string").option("header", True).csv(path).collect()) == ["2024-01-01", "2024-01-02", "2024-01-02"]


def test_feature_table_appends_and_counts(spark, tmp_path):
    df = spark.createDataFrame([("1", 2)], "encounter_id string, n int")
    for i in (1, 2):
        report = jobs.run_feature_job(spark, df, "feature_append", str(tmp_path / "f"), 1700000000.0 + i)
        assert report["records_ingested"] == 1 and report["row_count"] == i
    row = spark.table("feature_append").first()
    assert row["is_deleted"] is False and str(row["event_date"]) == "2023-11-14"
    with pytest.raises(RuntimeError, match="expected at least 3"):
        catalog.check_row_count(spark, "feature_append", 3)


def test_csv_table_names(spark, tmp_path):
    path = str(tmp_path / "raw")
    csv.write_csv(spark.createDataFrame([("a", "b")], "`A1Cresult` string, `glyburide-metformin` string"), path)
    catalog.create_csv_tables(spark, "names_check", {"raw": (path, ["A1Cresult", "glyburide-metformin"])})
    assert spark.sql("SELECT a1cresult, glyburide_metformin FROM names_check.raw").collect() == [("a", "b")]


def test_reports(spark, tmp_path):
    path = tmp_path / "violations.json"
    path.write_text(json.dumps({"violations": [{"feature_name": "race", "constraint_check_type": "completeness_check", "description": "d"}] * 2}, indent=2))
    assert reports.read_violations(spark, str(path)).count() == 2
    table = spark.createDataFrame([("b", 0.5), ("a", None)], "model string, auc double")
    lines = [r["line"] for r in reports.markdown_lines(table, "model").collect()]
    assert lines == ["| model | auc |", "| --- | --- |", "| a |  |", "| b | 0.5 |"]


def test_split_job_writes_nothing_when_a_gate_fails(spark, raw, dimensions, tmp_path):
    with pytest.raises(GateFailure):
        jobs.run_split_job(spark, raw, dimensions, Settings(), "never_written", str(tmp_path / "n"))
    assert not spark.catalog.tableExists("never_written") and not (tmp_path / "n").exists()


def test_split_job(spark, raw, dimensions, tmp_path):
    out = jobs.run_split_job(spark, raw, dimensions, Settings(), "split_job", str(tmp_path / "s"), exact=True, floor=1,
                             proportion_tolerance=1.0, prevalence_tolerance=1.1)
    assert out["gates"].where("not passed").count() == 0
    assert spark.table("split_job").count() == 3 and "split" in spark.table("split_job").columns


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a\n"say ""x"", d:\\",1\n')
    schema = S.all_strings(["a", "b"])
    assert csv.read_csv(spark, str(tmp_path / "a.csv"), schema).collect() == [("1", 'say "x", d:\\')]
    with pytest.raises(Exception, match="(?i)column|cannot be resolved"):
        csv.read_csv(spark, str(tmp_path / "a.csv"), S.all_strings(["a", "c"])).collect()
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two" / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_csv(spark, str(tmp_path / "two"), schema).collect()


def test_csv_line_breaks(spark, tmp_path):
    rows = [("1", 'x\ny "z"'), ("2", "plain")]
    path = str(tmp_path / "out")
    csv.write_csv(spark.createDataFrame(rows, "a string, b string"), path)
    schema = S.all_strings(["a", "b"])
    assert sorted(map(tuple, csv.read_csv(spark, path, schema, multi_line=True).collect())) == rows
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_csv(spark, path, schema).collect()


def test_typed_csv_knows_what_a_number_is(spark, tmp_path):
    path = tmp_path / "scores.csv"
    path.write_text('250d,7\n12f,7.0\n inf,x\n" 4.5 "," 8 "\n1e3,\n')
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("n", T.IntegerType())])
    found = [tuple(r) for r in csv.read_typed_csv(spark, str(path), schema).collect()]
    assert found == [(None, 7), (None, None), (None, None), (4.5, 8), (1000.0, None)]


@pytest.mark.parametrize("name", ["with space.csv", "per%20cent%.csv", "plus+sign.csv", "é.csv"])
def test_manifest_of_any_file_name(spark, tmp_path, name):
    (tmp_path / name).write_bytes(b"h\n1\n2\n")
    row = manifest.manifest(spark, [str(tmp_path)], "now").first()
    assert (row["sha256"], row["row_count"]) == (hashlib.sha256(b"h\n1\n2\n").hexdigest(), 2)


def test_schemes_of_stores():
    from pyarrow import fs

    assert manifest.file_system("file:/a/b c%20.csv")[1] == "/a/b c%20.csv"
    try:
        system, name = manifest.file_system("s3a://bucket/a b.csv")
    except Exception as error:  # the store itself may be out of reach
        assert "scheme" not in str(error).lower()
    else:
        assert isinstance(system, fs.FileSystem) and name == "bucket/a b.csv"


def test_stacked_files_in_blocks(spark, tmp_path):
    path = tmp_path / "ids.csv"
    body = "".join(f"{i},text {i}\n" for i in range(3000))
    path.write_text(f"a,b\n{body},\n\nc,d\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        tables = stacked.read_stacked(spark, str(path), {"one": ["a", "b"], "two": ["c", "d"]})
        for name, start in (("one", 2), ("two", 3005)):
            rows = tables[name].orderBy("line_no").collect()
            assert [(r[0], r["line_no"]) for r in rows] == [(str(i), start + i) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_work_folder_is_empty_afterwards(spark):
    from riskmart import session

    session.materialise(spark.range(3), "check")
    root = session.work_root(spark).removeprefix("file:")
    assert root.startswith(session.shared_folder(spark).removeprefix("file:"))
    import os

    assert os.listdir(root)
    path = session.work_path(spark, "one")
    spark.range(1).write.parquet(path)
    session.remove_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
