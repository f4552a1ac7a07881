"""Sinks, schemas, lookups and the registered queries."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom import schemas
from ticketloom.operators import governance, lookups, scans, terms
from ticketloom.sources import sinks, tables
from ticketloom.sources.tables import Store


def test_every_query_has_a_stable_schema(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 150


def test_conform(spark):
    df = spark.createDataFrame([("I1", 3)], "number string, extra int")
    row = schemas.conform(df, schemas.PREPROCESSED_INCIDENTS).first()
    assert row.number == "I1" and row.embedding == [] and row.sys_created_on is None
    assert schemas.required_violations(schemas.conform(df, schemas.PREPROCESSED_INCIDENTS), schemas.PREPROCESSED_INCIDENTS).first().missing == ["sys_created_on"]


def test_schema_from_records():
    got = schemas.from_config(
        [
            {"name": "a", "type": "STRING", "mode": "REQUIRED"},
            {"name": "v", "type": "FLOAT", "mode": "REPEATED"},
            {"name": "r", "type": "REPEATED", "fields": [{"name": "value", "type": "FLOAT"}]},
        ]
    )
    assert not got["a"].nullable
    assert got["v"].dataType == T.ArrayType(T.DoubleType(), False)
    assert got["r"].dataType.elementType.fieldNames() == ["value"]
    with pytest.raises(KeyError):
        schemas.get("nothing")


def test_sinks_round_trip(spark, views, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = lookups.with_team(views.incidents, views.team_services)
    sinks.save_results(rows, store, "results", "WRITE_TRUNCATE")
    sinks.save_results(rows, store, "results")
    back = tables.read_parts(spark, [store.path("results")])
    assert back.count() == 2 * rows.count() and set(back.columns) <= set(sinks.RESULT_COLUMNS)
    manifest = sinks.write_large(rows, str(tmp_path / "large"), 50)
    assert manifest.agg(F.sum("rows")).first()[0] == rows.count() and manifest.where("rows > 50").isEmpty()
    sinks.write_csv(rows.select("number", "short_description"), str(tmp_path / "csv"))
    csv = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "csv"))
    assert csv.count() == rows.count()
    sinks.write_json(rows.select("number", F.col("TechCenter").alias("tech_center")), str(tmp_path / "json"), "tech_center")
    assert spark.read.json(str(tmp_path / "json")).count() == rows.count()
    sinks.sorted_by_day(rows, str(tmp_path / "days"), "sys_created_on", ["business_service"])
    assert spark.read.parquet(str(tmp_path / "days")).where("dt = '2024-01-02'").count() == rows.where(F.to_date("sys_created_on") == "2024-01-02").count()
    assert tables.list_folder(spark, str(tmp_path / "json")).count() >= 1
    with pytest.raises(ValueError):
        sinks.save_results(rows, store, "results", "WRITE_SOMEHOW")


def test_versions_replace_themselves_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one = spark.createDataFrame([("I1", "c", "s", [1.0])], "incident_number string, tech_center string, description_summary string, embedding array<double>")
    now = F.lit("2024-01-01").cast("timestamp")
    sinks.save_training_data(one, store, "2024_q2", now)
    sinks.save_training_data(one.unionByName(one), store, "2024_q4", now)
    sinks.save_training_data(one.withColumn("domain", F.lit("d")), store, "2024_q4", now)
    got = store.read("training_data", merge=True).groupBy("training_version").agg(F.count("*"), F.max("domain")).collect()
    assert {tuple(r) for r in got} == {("2024_q2", 1, None), ("2024_q4", 1, "d")}


def test_hash_like_numbers_stay_text(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([("I1", "c", 1, "2024_q2", h) for h in ("00012345", "12345e10")], "number string, tech_center string, cluster_id int, model_version string, model_hash string")
    sinks.save_cluster_results(rows.withColumn("sys_created_on", F.current_timestamp()), store, F.current_timestamp())
    assert {r.model_hash for r in store.read("cluster_results").collect()} == {"00012345", "12345e10"}


def test_log_rows_need_their_fields(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    ok = spark.createDataFrame([("r", "INFO", "m")], "run_id string, log_level string, message string").withColumn("timestamp", F.current_timestamp())
    sinks.append_logs(ok, store)
    assert store.read("training_logs").count() == 1
    with pytest.raises(PySparkException):
        sinks.append_logs(ok.withColumn("message", F.lit(None).cast("string")), store)


def test_checkpointed_stage_is_reused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    assert store.read_or_compute("x", make).count() == 3 and store.read_or_compute("x", make).count() == 3
    assert len(calls) == 1


def test_create_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS ticketloom_test CASCADE")
    try:
        names = schemas.create_all(spark, "ticketloom_test")
        assert {r.tableName for r in spark.sql("SHOW TABLES IN ticketloom_test").where("NOT isTemporary").collect()} == set(names)
        schemas.create_table(spark, "ticketloom_test.daily", schemas.INCIDENTS, "sys_created_on", ["business_service"])
        assert "dt" in spark.table("ticketloom_test.daily").columns
    finally:
        spark.sql("DROP DATABASE IF EXISTS ticketloom_test CASCADE")


def test_first_matching_rule_wins(spark):
    df = spark.createDataFrame([(1, "BT-TC-Mail"), (2, "Mail Desk"), (3, "Development X")], "i int, business_service string")
    assert [r.i for r in scans.match_center(df, "BT-TC-Mail").collect()] == [1]
    assert [r.i for r in scans.match_center(df.where("i > 1"), "BT-TC-Mail").collect()] == [2]
    assert [r.i for r in scans.match_center(df, "BT-TC-Development & More").collect()] == [3]
    assert scans.match_center(df, "Other").isEmpty()


def test_upsert(spark):
    schema = "pipeline_name string, tech_center string, v int"
    old = spark.createDataFrame([("p", "a", 1), ("p", "b", 2)], schema)
    new = spark.createDataFrame([("p", "b", 3), ("q", "b", 4)], schema)
    assert {tuple(r) for r in governance.update_watermarks(old, new).collect()} == {("p", "a", 1), ("p", "b", 3), ("q", "b", 4)}


def test_tf_idf_ignores_phrases(spark):
    df = spark.createDataFrame([(1, "disk full disk"), (2, "full moon"), (3, "")], "id int, t string")
    vocab = spark.createDataFrame([("disk",), ("full",), ("full moon",)], "term string")
    got = {(r.id, r.term): r.weight for r in terms.tf_idf(df, "id", "t", vocab).collect()}
    assert set(got) == {(1, "disk"), (1, "full"), (2, "full")} and abs(got[(2, "full")] - 1) < 1e-12


def test_group_limit_is_applied_before_the_shuffle(views):
    plan = governance.latest_per_center(views.cycles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_filters_reach_the_scan(views):
    orders = views.table("orders")
    plan = scans.window_scan(orders, "1996-01-01", "1996-06-30", ("o_orderkey",), "o_orderdate")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(o_order" in pushed and "LessThanOrEqual(o_orde" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in plan


def test_embeddings_artefacts_and_analysis_round_trip(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([("I1", "s", [1.0, 2.0], 5)], "number string, combined_incidents_summary string, embedding array<double>, extra int")
    sinks.save_embeddings(rows, store, "embeddings")
    sinks.save_embeddings(rows, store, "embeddings")
    assert store.read("embeddings").columns == list(sinks.EMBEDDING_COLUMNS) and store.read("embeddings").count() == 2
    item = spark.createDataFrame([("c", "2024_q2", "0001", "metrics", "p", '{"k": 3}')], "tech_center string, model_version string, model_hash string, kind string, path string, payload string")
    sinks.save_artefacts(item.withColumn("last_modified", F.current_timestamp()), store)
    assert store.read("artefacts").select(F.get_json_object("payload", "$.k")).first()[0] == "3"
    analysis = spark.createDataFrame([("c", "2024_q2", 3, 0.25)], "tech_center string, model_version string, n_clusters long, noise_ratio double")
    sinks.save_analysis(analysis, str(tmp_path / "analysis"))
    assert sinks.load_analysis(spark, str(tmp_path / "analysis"), analysis.schema).exceptAll(analysis).isEmpty()
