"""The jobs end to end on a small generated set of incidents."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketloom.operators import governance
from ticketloom.plans import predict, stages, train
from ticketloom.plans.preprocess import preprocess, to_table
from ticketloom.sources import sinks
from ticketloom.sources.tables import Store
from ticketloom.streaming import incremental

NOW = datetime(2024, 6, 30, 12)
TOPICS = ("mail server queue stuck delivery", "vpn tunnel drops login token", "invoice printer jam tray paper")


def make_incidents(spark, n=180, start=0):
    topic = F.element_at(F.array(*[F.lit(t) for t in TOPICS]), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(start, start + n).select(
        F.concat(F.lit("INC"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("number"),
        (F.to_timestamp(F.lit("2024-06-01 00:00:00")) + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("sys_created_on"),
        F.concat(topic, F.lit(" in building "), (F.col("id") % 7).cast("string")).alias("description"),
        topic.alias("short_description"),
        F.when(F.col("id") % 2 == 0, "Mail Desk - PROD").otherwise("Network").alias("business_service"),
    )


@pytest.fixture(scope="module")
def services(spark):
    return spark.createDataFrame([("Mail Desk - PROD", "BT-TC-Mail"), ("Network", "BT-TC-Net")], "business_service string, TechCenter string")


OPTIONS = train.TrainingOptions(min_cluster_size=10, min_samples=3)


@pytest.fixture(scope="module")
def trained(spark, services, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    rows = to_table(preprocess(make_incidents(spark), F.lit(NOW).cast("timestamp"), services, dims=64))
    sinks.write_table(rows, store, "preprocessed_incidents")
    train.train(store, store.read("preprocessed_incidents"), NOW, options=OPTIONS)
    return store


def test_training_stores_everything(trained):
    cycles = {r.tech_center: r for r in trained.read("training_cycle_metadata").collect()}
    assert set(cycles) == {"BT-TC-Mail", "BT-TC-Net"}
    assert [(c.training_status, c.clusters_count, c.error_message) for c in cycles.values()] == [("SUCCESS", 3, None)] * 2
    results = trained.read("cluster_results")
    assert results.count() == 180
    assert results.where("cluster_id >= 0 and cluster_label = 'Noise'").count() == 0
    # each topic is one cluster of its center
    purity = results.withColumn("t", F.substring("combined_incidents_summary", 1, 4)).where("cluster_id >= 0")
    assert purity.groupBy("tech_center", "cluster_id").agg(F.countDistinct("t").alias("n")).where("n > 1").count() == 0
    assert trained.read("model_registry").where("model_status = 'active'").count() == 2
    assert trained.read("training_logs").count() == 2
    assert {r.kind for r in trained.read("artefacts").collect()} == {"reducer", "clusterer", "metadata"}
    assert all('"min_cluster_size": 10' in r.model_params for r in trained.read("model_registry").collect())


def test_training_again_replaces_its_rows(spark, trained):
    before = {t: trained.read(t).count() for t in ("training_cycle_metadata", "model_registry", "clusters", "artefacts", "cluster_results")}
    few = trained.read("preprocessed_incidents").where("tech_center = 'BT-TC-Net'").limit(4).withColumn("tech_center", F.lit("BT-TC-Few"))
    train.train(trained, trained.read("preprocessed_incidents").unionByName(few), NOW, options=OPTIONS)
    after = {t: trained.read(t).count() for t in before}
    assert after.pop("training_cycle_metadata") == before.pop("training_cycle_metadata") + 1
    assert after == before
    row = trained.read("training_cycle_metadata").where("tech_center = 'BT-TC-Few'").first()
    assert (row.training_status, row.error_message, row.incidents_count) == ("FAILED", "too_few_rows", 4)


def test_scoring_follows_the_model(spark, services, trained):
    fresh = to_table(preprocess(make_incidents(spark, 30, 1000), F.lit(NOW).cast("timestamp"), services, dims=64))
    lost = fresh.limit(1).withColumn("tech_center", F.lit("BT-TC-Other")).withColumn("number", F.lit("LOST"))
    out = predict.score(trained, fresh.unionByName(lost), F.lit(NOW).cast("timestamp"), min_samples=3)
    rows = {r.incident_id: r for r in out.collect()}
    assert len(rows) == 31
    assert rows["LOST"].status == "failed" and rows["LOST"].predicted_cluster_label == "Prediction_Failed"
    assert rows["LOST"].confidence_score == 0.0 and rows["LOST"].predicted_domain_name == "Error"
    ok = [r for r in rows.values() if r.status == "ok"]
    assert len(ok) == 30 and sum(r.predicted_cluster_id >= 0 for r in ok) >= 25
    assert all(0.0 <= r.confidence_score <= 1.0 for r in ok)


def test_prediction_cycle_takes_only_new_rows(trained):
    first = predict.run_prediction_cycle(trained, NOW, days=60, batch=50, min_samples=3)
    assert first.count() == 50
    second = predict.run_prediction_cycle(trained, NOW, min_samples=3)
    assert second.count() == 130
    stored = trained.read("incident_predictions")
    assert stored.count() == 180 and stored.select("incident_id").distinct().count() == 180
    assert "embedding" not in stored.columns


def test_prediction_run_uses_watermarks(trained):
    before = trained.read("prediction_watermarks").groupBy("tech_center").agg(F.max("prediction_timestamp").alias("t")).count()
    assert before == 2
    again = predict.run_predictions(trained, NOW, min_samples=3)
    assert again.count() == 0  # everything is older than the last run


def test_prediction_run_finds_rows_that_were_stored_late(spark, services, trained):
    """An incident from before the last run that was stored after it, and one of a center that never had a run."""
    predict.run_predictions(trained, NOW, min_samples=3)
    later = F.lit(NOW + timedelta(hours=1)).cast("timestamp")
    late = to_table(preprocess(make_incidents(spark, 4, 2000), later, services, dims=64))
    late = late.withColumn("sys_created_on", F.lit(NOW - timedelta(hours=9)).cast("timestamp"))
    strange = late.limit(1).withColumn("tech_center", F.lit("BT-TC-New")).withColumn("number", F.lit("STRANGE"))
    sinks.write_table(late.unionByName(strange), trained, "preprocessed_incidents")
    got = predict.run_predictions(trained, NOW + timedelta(hours=2), min_samples=3)
    assert {r.incident_id for r in got.collect()} == {r.number for r in late.collect()} | {"STRANGE"}
    assert predict.run_predictions(trained, NOW + timedelta(hours=3), min_samples=3).count() == 0


def test_training_is_skipped_outside_the_schedule(trained):
    assert train.train_if_due(trained, trained.read("preprocessed_incidents"), datetime(2024, 5, 1)) is None
    assert train.train_if_due(trained, trained.read("preprocessed_incidents"), NOW) is None  # version is there


def test_incremental_runs_and_watermarks(spark, services, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = make_incidents(spark, 48)
    first = incremental.run_incremental(store, rows, services, datetime(2024, 6, 3), "2024-06-01", "2024-06-01", dims=32)
    assert (first["start_time"], first["end_time"]) == (datetime(2024, 6, 1), datetime(2024, 6, 2))
    assert store.read("preprocessed_incidents").count() == 24
    second = incremental.run_incremental(store, rows, services, datetime(2024, 6, 3, 1), dims=32)
    assert second["start_time"] == datetime(2024, 6, 2) and second["end_time"] == datetime(2024, 6, 2, 1)
    assert store.read("preprocessed_incidents").count() == 25
    # the same window again adds nothing
    incremental.run_incremental(store, rows, services, datetime(2024, 6, 3, 2), "2024-06-01", "2024-06-01", dims=32)
    assert store.read("preprocessed_incidents").count() == 25
    # an empty run still moves the watermark
    incremental.run_incremental(store, rows, services, datetime(2024, 6, 9), "2024-06-08", "2024-06-08", dims=32)
    marks = store.read("preprocessing_watermarks")
    assert marks.count() == 4
    metrics = governance.run_metrics(store.read("run_log")).first()
    assert (metrics.stage, metrics.runs, metrics.rows) == ("preprocessing", 4, 25) and metrics.seconds > 0
    assert marks.orderBy(F.desc("time_trigger")).first().preprocessed_rows == 0
    incremental.run_incremental(store, rows, services, datetime(2024, 6, 10), "2024-06-08", "2024-06-08", overwrite_watermark=True, dims=32)
    assert store.read("preprocessing_watermarks").count() == 1


def test_failures_are_kept_and_retried(spark, services, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = make_incidents(spark, 12)

    def refuses(texts):
        if any("vpn" in t for t in texts):
            raise ValueError("rate limit 429")
        return [[1.0, 2.0]] * len(texts)

    day = ("2024-06-01", "2024-06-01")
    incremental.run_incremental(store, rows, services, datetime(2024, 6, 3), *day, embedding_provider=refuses)
    assert store.read("preprocessed_incidents").count() == 8
    failed = store.read("processing_failures").collect()
    assert len(failed) == 4 and {(r.stage, r.error_class, r.message) for r in failed} == {("embedding", "RATE_LIMIT", "rate limit 429")}
    later = datetime(2024, 6, 4)
    incremental.run_incremental(store, rows, services, later, "2024-06-03", "2024-06-03", retry=True, dims=2)
    assert store.read("preprocessed_incidents").count() == 12
    assert store.read("processing_failures").count() == 4


def test_stream_equals_batch(spark, services, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    rows = make_incidents(spark, 40)
    rows.where("number < 'INC0000020'").coalesce(1).write.parquet(folder)
    incremental.preprocess_stream(store, folder, services, checkpoint, dims=32).awaitTermination(120)
    rows.where("number >= 'INC0000015'").coalesce(1).write.mode("append").parquet(folder)  # five numbers come twice
    incremental.preprocess_stream(store, folder, services, checkpoint, dims=32).awaitTermination(120)
    got = spark.read.parquet(store.path("preprocessed_stream"))
    want = to_table(preprocess(rows, F.lit(NOW).cast("timestamp"), services, dims=32))
    cols = ["number", "combined_incidents_summary", "tech_center"]
    assert got.count() == 40
    assert got.select(*cols).exceptAll(want.select(*cols)).isEmpty()
    records = spark.read.parquet(store.path("preprocessed_stream_runs")).orderBy("batch_id").collect()
    assert [r.preprocessed_rows for r in records if r.start_time] == [20, 20] and all(r.seconds > 0 for r in records)
    assert sum(r.preprocessed_rows for r in records) == 40  # a stream may end in batches without rows
    assert spark.read.schema("number string, batch_id long").parquet(store.path("preprocessed_stream_failures")).count() == 0


def test_hourly_count_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = make_incidents(spark, 12)
    rows.coalesce(1).write.parquet(folder)
    stream = incremental.hourly_count_stream(spark, rows.schema, folder, "business_service", "sys_created_on")
    q = stream.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = incremental.hourly_counts(rows)
    assert spark.table("hourly").exceptAll(batch).isEmpty() and batch.count() == 12
    spark.catalog.dropTempView("hourly")


def test_stages_restart(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = make_incidents(spark, 90).withColumn("tech_center", F.lit("BT-TC-Mail"))
    with pytest.raises(ValueError):
        stages.run_stages(store, rows, NOW, 3, 2)
    with pytest.raises(FileNotFoundError):
        stages.run_stages(store, rows, NOW, 2, 2, options=OPTIONS)
    stages.run_stages(store, rows, NOW, 1, 2, options=OPTIONS, dims=64)
    out = stages.run_stages(store, rows.limit(0), NOW, 3, 4, options=OPTIONS)
    assert out["results"].count() == 90
    assert set(out["results"].columns) <= set(sinks.RESULT_COLUMNS)
    # three topics times two services: six texts, each shared by fifteen rows, which is more than the minimum size
    assert out["stage_metrics"].first().n_clusters == 6


def test_stages_embed_what_preprocessing_embeds(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = make_incidents(spark, 40).withColumn("tech_center", F.lit("BT-TC-Mail"))
    given = spark.createDataFrame([(rows.first().number, "given before")], "number string, combined_incidents_summary string")
    out = stages.run_stages(store, rows, NOW, 1, 1, summaries=given, dims=32)["stage_embeddings"]
    want = preprocess(rows, F.lit(NOW).cast("timestamp"), dims=32)
    both = out.select("number", "embedding").join(want.select("number", F.col("embedding").alias("e")), "number")
    assert both.where(F.col("embedding") == F.col("e")).count() == want.count() == 40
    made = {r.number: r.combined_incidents_summary for r in out.collect()}
    kept = {r.number: r.combined_incidents_summary for r in want.collect()}
    changed = [n for n in kept if made[n] != kept[n]]
    assert [made[n] for n in changed] == ["given before"]


def test_centers_with_their_own_minimum(spark):
    seen = spark.createDataFrame([("a", 10), ("b", 10), ("c", 3)], "tech_center string, incidents_count long")
    own = spark.createDataFrame([("a", 500), ("c", 1), ("d", 2)], "tech_center string, min_incidents int")
    got = {r.tech_center: r.enough for r in train.with_minimum(seen, 5, own).collect()}
    assert got == {"a": False, "b": True, "c": False}
    assert {r.enough for r in train.with_minimum(seen, 3).collect()} == {True}
