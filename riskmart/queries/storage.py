"""Sources and sinks: each query writes below the shared folder, reads back and aggregates the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..config import DEFAULT_SEED, DEFAULT_SPLITS
from ..functions import DEFAULT_NULL_TOKENS, flag_at
from ..functions.nulls import texts
from ..operators import decoding, monitoring, worklist
from ..operators.evaluation import comparison_table, score_columns_to_rows
from ..operators.features import coerce_for_feature_table
from ..plans import monitoring as monitor_inputs
from ..sources import catalog, csv, manifest as M, reports, stacked
from ..session import materialise, work_path
from .aggregates import _FULL, _LEVELS, rounded
from .registry import query
from .sql import check
from .tables import clean, dimension, encounters, records, split_records, table

DATABASE = "riskmart_checks"


def _table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A fresh table name and its path in the shared folder."""
    path = work_path(spark, name)
    catalog.create_database(spark, DATABASE)
    return f"{DATABASE}.{path.rsplit('/', 1)[1].replace('-', '_')}", path


_TEXT_COLUMNS = ["encounter_id", "race", "medical_specialty", "diag_1", "diag_2", "A1Cresult", "readmitted"]


@query("s1_csv_null_tokens", check(
    "SELECT " + ", ".join(f"CASE WHEN \"{c}\" NOT IN ({texts(DEFAULT_NULL_TOKENS)}) THEN \"{c}\" END AS \"{c}\"" for c in _TEXT_COLUMNS)
    + " FROM encounters"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "encounters")
    csv.write_csv(encounters(spark, folder).select(*_TEXT_COLUMNS), path)
    return csv.read_csv_with_default_nulls(spark, path, S.all_strings(_TEXT_COLUMNS))


@query("s1_csv_keeps_other_text", check("SELECT encounter_id, medical_specialty, diag_1, \"A1Cresult\" AS a1c FROM encounters"))
def _(spark, folder):
    path = work_path(spark, "encounters")
    names = ["encounter_id", "medical_specialty", "diag_1", "A1Cresult"]
    csv.write_csv(encounters(spark, folder).select(*names), path)
    return csv.read_csv(spark, path, S.all_strings(names)).withColumnRenamed("A1Cresult", "a1c")


_ANY_TEXT = """SELECT doc_id, text || ' "quoted", back\\slash,' AS text, CASE doc_id % 4 WHEN 0 THEN '250d' WHEN 1 THEN '12f' WHEN 2 THEN ' 4.5 ' ELSE 'inf' END AS number FROM documents"""


@query("s1_csv_any_text", _ANY_TEXT.replace("\\\\", "\\"))
def _(spark, folder):
    """Quotes, separators, backslashes and line breaks inside cells come back as they were."""
    path = work_path(spark, "any-text")
    number = F.when(F.col("doc_id") % 4 == 0, "250d").when(F.col("doc_id") % 4 == 1, "12f").when(F.col("doc_id") % 4 == 2, " 4.5 ").otherwise("inf")
    text = F.concat("text", F.lit(' "quoted", back\\slash,'))
    csv.write_csv(table(spark, folder, "documents").select("doc_id", text.alias("text"), number.alias("number")), path)
    back = csv.read_csv(spark, path, S.all_strings(["number", "doc_id", "text"]), multi_line=True)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "number")


@query("s2_catalog_csv_tables", check("""
SELECT readmitted, glyburide_metformin, count(*) AS n, count(DISTINCT patient_nbr) AS n_patients
FROM (SELECT *, "glyburide-metformin" AS glyburide_metformin FROM encounters) GROUP BY 1, 2"""))
def _(spark, folder):
    name, path = _table(spark, "raw_encounters")
    csv.write_csv(encounters(spark, folder), path)
    catalog.create_csv_tables(spark, DATABASE, {name.split(".")[1]: (path, S.ENCOUNTER_COLUMNS)})
    return spark.sql(f"SELECT readmitted, glyburide_metformin, count(*) AS n, count(DISTINCT patient_nbr) AS n_patients "
                     f"FROM {name} GROUP BY 1, 2")


_RAW = {"dictionary": S.DIAGNOSIS_DICTIONARY_COLUMNS, **{n: [k, "description"] for n, k in S.DIMENSIONS.items()}}


@query("s2_all_raw_tables", check("""
SELECT 'encounters' AS name, count(*) AS n, count(DISTINCT patient_nbr) AS n_keys FROM encounters
UNION ALL SELECT 'dictionary', count(*), count(DISTINCT p_partkey) FROM part
UNION ALL SELECT t.name, count(*), count(DISTINCT dim_id) FROM dimension, (VALUES ('admission_type'), ('discharge_disposition'), ('admission_source')) t(name) GROUP BY t.name"""))
def _(spark, folder):
    """The encounters, the diagnosis dictionary and the three id maps, all registered from CSV folders."""
    part = table(spark, folder, "part")
    frames = {"encounters": encounters(spark, folder), "dictionary": part.select(
        F.col("p_partkey").cast("string").alias("dgns_cd"), F.col("p_name").alias("longdesc"), F.col("p_brand").alias("shortdesc"),
        F.lit("9").alias("version"), F.lit("2014").alias("fyear"))}
    frames |= {n: dimension(spark, folder, k).select(k, "description") for n, k in S.DIMENSIONS.items()}
    keys = {"encounters": "patient_nbr", "dictionary": "dgns_cd", **S.DIMENSIONS}
    tables, names = {}, {}
    for kind, frame in frames.items():
        full, path = _table(spark, f"raw-{kind}")
        csv.write_csv(frame, path)
        names[kind], tables[full.split(".")[1]] = full, (path, frame.columns)
    catalog.create_csv_tables(spark, DATABASE, tables)
    return csv.union_by_name([
        spark.table(names[kind]).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("n_keys")).select(
            F.lit(kind).alias("name"), "n", "n_keys") for kind, key in keys.items()])


@query("s3_stacked_tables", """
SELECT n_name || CASE n_nationkey WHEN 3 THEN ', quoted' ELSE '' END AS nation, CASE r_regionkey WHEN 2 THEN 'NULL' ELSE r_name END AS region, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def _(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    line = lambda position, *cells: F.struct(F.lit(position).alias("section"), *cells)
    nations = nation.select(F.lit(1).alias("section"), F.col("n_nationkey").alias("i"), F.concat(
        F.col("n_nationkey").cast("string"), F.lit(',"'), F.col("n_name"),
        F.when(F.col("n_nationkey") == 3, ", quoted").otherwise(""), F.lit('"')).alias("line"))
    links = nation.select(F.lit(2).alias("section"), F.col("n_nationkey").alias("i"),
                          F.concat_ws(",", "n_nationkey", "n_regionkey").alias("line"))
    regions = region.select(F.lit(3).alias("section"), F.col("r_regionkey").alias("i"), F.concat_ws(
        ",", "r_regionkey", F.when(F.col("r_regionkey") == 2, "NULL").otherwise(F.col("r_name"))).alias("line"))
    heads = F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(i).alias("i"), F.lit(text).alias("line")) for s, i, text in (
        (1, -1, "nation_id,description"), (2, -2, ","), (2, -1, "nation_id,region_id"), (3, -3, ""), (3, -2, ""),
        (3, -1, "region_id,description"))]))
    lines = csv.union_by_name([nations, links, regions, spark.range(1).select(heads)])
    path = work_path(spark, "stacked")
    lines.coalesce(1).sortWithinPartitions("section", "i").select("line").write.text(path)  # a dictionary file
    parts = stacked.read_stacked(spark, path, {
        "nation": ["nation_id", "description"], "link": ["nation_id", "region_id"], "region": ["region_id", "description"]})
    df = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation_id"))
    df = decoding.decode(df, "nation_id", parts["nation"], "nation_id", "description", "nation", "line_no")
    df = decoding.decode(df, "nation_id", parts["link"], "nation_id", "region_id", "region_id", "line_no")
    df = decoding.decode(df, "region_id", parts["region"], "region_id", "description", "region", "line_no")
    return df.groupBy("nation", "region").agg(F.count(F.lit(1)).alias("n"))


@query("s4_dimension_csv_sink", check("""
SELECT description, count(*) AS n FROM customer JOIN dimension ON dim_id = CAST(c_nationkey AS VARCHAR) GROUP BY description"""))
def _(spark, folder):
    path = work_path(spark, "dimension")
    names = ["dim_id", "description"]
    csv.write_csv(dimension(spark, folder).select(*names), path, single_file=True)
    back = csv.read_csv(spark, path, S.all_strings(names))
    df = table(spark, folder, "customer").select(F.col("c_nationkey").cast("string").alias("dim_id"))
    return df.join(back, "dim_id").groupBy("description").agg(F.count(F.lit(1)).alias("n"))


@query("s5_partitioned_sink", check("SELECT split, label, count(*) AS n, count(DISTINCT entity) AS n_entities FROM split_records GROUP BY split, label"))
def _(spark, folder):
    name, path = _table(spark, "features")
    catalog.write_partitioned(split_records(spark, folder), name, path)
    return spark.table(name).groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("entity").alias("n_entities"))


@query("s6_partition_read", check("SELECT id, entity, label, split FROM split_records WHERE split = 'validation'"))
def _(spark, folder):
    name, path = _table(spark, "features")
    catalog.write_partitioned(split_records(spark, folder).select("id", "entity", "label", "split"), name, path)
    return catalog.read_partition(spark, name, "validation").select("id", "entity", "label", "split")


@query("s7_multi_part_csv", check("SELECT status, count(*) AS n, round(avg(price), 4) AS mean_price FROM records GROUP BY status"))
def _(spark, folder):
    df, path = records(spark, folder).select("id", "status", "price"), work_path(spark, "parts")
    df.withColumn("part", F.col("status")).write.partitionBy("part").option("header", True).csv(path)  # a folder per status
    schema = T.StructType([df.schema["id"], df.schema["status"], df.schema["price"]])
    back = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    return back.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("mean_price"))


@query("s8_split_csv_export", check("SELECT counter, coarse_score, label, count(*) AS n FROM split_records WHERE split = 'train' GROUP BY ALL"))
def _(spark, folder):
    path = work_path(spark, "channel")
    csv.write_csv(split_records(spark, folder).where("split = 'train'").select("counter", "coarse_score", "label"), path)
    back = spark.read.schema("counter int, coarse_score double, label int").option("header", True).csv(path)
    return back.groupBy("counter", "coarse_score", "label").agg(F.count(F.lit(1)).alias("n"))


_SQL_TEXT = """SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS n_entities
FROM {orders} WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority"""


@query("s9_sql_text", _SQL_TEXT.replace("{orders}", "orders"))
def _(spark, folder):
    return spark.sql(_SQL_TEXT, orders=table(spark, folder, "orders"))


@query("s10_manifest", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad_checksums FROM orders")
def _(spark, folder):
    path = work_path(spark, "raw")
    csv.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), path)
    files = M.manifest(spark, [path], "2024-01-01T00:00:00Z")
    content = spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("again"))
    both = files.where("length > 0").join(content, "path")
    bad = F.count(F.when(F.col("sha256") != F.col("again"), 1))
    return both.agg(F.sum("row_count").alias("n_rows"), bad.alias("n_bad_checksums"))


@query("s11_feature_append", check("""
SELECT CAST(d AS DATE) AS event_date, count(*) AS n, count(DISTINCT id) AS n_ids, CAST(sum(CASE WHEN priority IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing
FROM records, (VALUES ('2023-11-14'), ('2023-11-16')) v(d) GROUP BY 1"""))
def _(spark, folder):
    name, path = _table(spark, "encounter_features")
    df = records(spark, folder).select("id", "entity", "priority", "score")
    for event_time in (1700000000.0, 1700150000.0):
        catalog.append_features(coerce_for_feature_table(df, event_time), name, path, event_time)
    missing = F.count(F.when(F.col("priority") == "Missing", 1))
    return spark.table(name).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"), missing.alias("n_missing"))


@query("s12_headerless_typed_csv", check("""
SELECT encounter_id, CASE WHEN regexp_matches(trim(diag_1), '^[0-9]+([.][0-9]*)?$') THEN CAST(trim(diag_1) AS DOUBLE) END AS value FROM encounters"""))
def _(spark, folder):
    path = work_path(spark, "scores")
    csv.write_csv(encounters(spark, folder).select("encounter_id", "diag_1"), path, header=False)
    schema = T.StructType([T.StructField("encounter_id", T.StringType()), T.StructField("value", T.DoubleType())])
    return csv.read_typed_csv(spark, path, schema)


@query("s13_dated_worklist", check("""
SELECT dt, flag, count(*) AS n, round(max(coarse_score), 6) AS top FROM (
  SELECT '2024-01-01' AS dt, coarse_score, CAST(coarse_score >= CAST(0.9 AS DOUBLE) AS INT) AS flag FROM records
  UNION ALL SELECT '2024-01-02', coarse_score, CAST(coarse_score >= CAST(0.5 AS DOUBLE) AS INT) FROM records WHERE label = 1) GROUP BY dt, flag"""))
def _(spark, folder):
    path, df = work_path(spark, "predictions"), records(spark, folder)
    for date, threshold, rows in (("2024-01-01", 0.9, df), ("2024-01-02", 0.7, df), ("2024-01-02", 0.5, df.where("label = 1"))):
        catalog.write_dated(worklist.worklist(rows, "id", "coarse_score", threshold), path, date)
    back = spark.read.schema("id bigint, score double, flag int, dt string").option("header", True).csv(path)
    return back.groupBy("dt", "flag").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("score"), 6).alias("top"))


@query("s14_json_report", check("""
SELECT status AS feature, 'completeness_check' AS constraint_check_type, 'n=' || count(*) AS description FROM records GROUP BY status"""))
def _(spark, folder):
    path = work_path(spark, "violations")
    found = records(spark, folder).groupBy(F.col("status").alias("feature")).agg(
        F.concat(F.lit("n="), F.count(F.lit(1)).cast("string")).alias("description"))
    found = found.select("feature", F.lit("completeness_check").alias("constraint_check_type"), "description")
    reports.write_json_report(reports.violations_document(found), path)
    return reports.read_violations(spark, path)


@query("s15_comparison_report", check("WITH models AS (SELECT split, id, label, 'fine' AS model, score AS s FROM split_records UNION ALL SELECT split, id, label, 'coarse', coarse_score FROM split_records), base AS (SELECT * FROM models WHERE split = 'test'), val AS (SELECT * FROM models WHERE split = 'validation'),"
    + _LEVELS.format(by="model", score="s", source="base") + "," + _FULL.format(by="model", score="s", source="base", validation="val") + """,
t AS (SELECT row_number() OVER (ORDER BY model) AS line_no, '| ' || model || ' | ' || printf('%.4f', pr_auc) || ' | ' || printf('%.4f', roc_auc) || ' |' AS line FROM flat JOIN auc USING (model))
SELECT * FROM t UNION ALL SELECT -1, '| --- | --- | --- |' UNION ALL SELECT -2, '| model | pr_auc | roc_auc |'"""))
def _(spark, folder):
    path = work_path(spark, "comparison")
    scored = materialise(score_columns_to_rows(
        split_records(spark, folder), {"fine": "score", "coarse": "coarse_score"}, ["id", "label", "split"]), "scored")
    reports.save_comparison(
        comparison_table(scored.where("split = 'validation'"), scored.where("split = 'test'"), "label", "id"), path)
    back = spark.read.schema("model string, pr_auc double, roc_auc double").option("header", True).csv(f"{path}/model_comparison_csv")
    four = back.select("model", *[F.format_string("%.4f", F.col(c)).alias(c) for c in ("pr_auc", "roc_auc")])
    return reports.markdown_lines(four, "model")


@query("s16_monitor_inputs", check("""
SELECT CAST(score >= CAST(0.7 AS DOUBLE) AS INT) AS prediction, label, count(*) AS n, round(avg(score), 6) AS mean_probability FROM split_records WHERE split = 'production' GROUP BY 1, 2"""))
def _(spark, folder):
    path = work_path(spark, "scored")
    scored = split_records(spark, folder).where("split = 'production'").select(
        F.col("score").alias("probability"), flag_at(F.col("score"), 0.7).alias("prediction"), "label")
    scored.write.parquet(path)
    return spark.read.parquet(path).groupBy("prediction", "label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("probability"), 6).alias("mean_probability"))


@query("s16_feature_inputs", check("""
SELECT race, time_in_hospital, count(*) AS n FROM clean WHERE split = 'train' GROUP BY ALL"""))
def _(spark, folder):
    """The feature-only input of the data-quality monitor: neither ids nor target."""
    path = work_path(spark, "baseline")
    monitor_inputs.feature_input(clean(spark, folder).where("split = 'train'")).write.parquet(path)
    back = spark.read.parquet(path)
    assert S.TARGET not in back.columns and "encounter_id" not in back.columns
    return back.groupBy("race", "time_in_hospital").agg(F.count(F.lit(1)).alias("n"))


@query("s16_bias_inputs", check("""
SELECT priority, status, label, CAST(score >= CAST(0.7 AS DOUBLE) AS INT) AS prediction, count(*) AS n FROM records GROUP BY ALL"""))
def _(spark, folder):
    """The bias input: facets, label and 0/1 prediction."""
    path = work_path(spark, "bias")
    monitor_inputs.bias_input(records(spark, folder), ["priority", "status"], "label", "score", 0.7).write.parquet(path)
    return spark.read.parquet(path).groupBy("priority", "status", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("s17_row_count_check", check("SELECT count(*) AS expected, count(*) AS landed FROM records"))
def _(spark, folder):
    name, path = _table(spark, "landed")
    df = records(spark, folder).select("id", "score")
    catalog.append_features(coerce_for_feature_table(df, 1700000000.0), name, path, 1700000000.0)
    expected = df.agg(F.count(F.lit(1)).alias("expected"))
    landed = catalog.check_row_count(spark, name, expected.first()["expected"])
    return expected.withColumn("landed", F.lit(landed).cast("bigint"))
