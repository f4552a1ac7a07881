"""Scoring job: new incidents of all centers against the latest model of their center, in one pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import scoring, vectors
from ticketloom.operators import density, governance, lookups, reduction, scans
from ticketloom.sources import sinks
from ticketloom.sources.tables import Store

FAILED_LABEL = "Prediction_Failed"
MODEL = ["tech_center", "model_version", "model_hash"]
_MODEL_FIELDS = "tech_center string, model_version string, model_hash string, "
MODEL_TABLES = {
    "model_components": _MODEL_FIELDS + "component int, mean array<double>, loadings array<double>, variance double",
    "model_points": _MODEL_FIELDS + "number string, reduced array<double>, cluster_id int, probability double, "
    "lambda double, outlier_score double, core_distance double",
    "model_labels": _MODEL_FIELDS + "cluster_id int, size long, primary_label string, description string, "
    "keywords array<string>, domain string",
    "model_domains": _MODEL_FIELDS + "cluster_id int, domain_id int, domain_name string, domain_description string",
}


def load_model(store: Store, name: str, models: DataFrame) -> DataFrame:
    """Model table restricted to the given models; the partition columns make it a pruned read."""
    return store.read(name, MODEL_TABLES[name]).join(models.select(*MODEL), MODEL, "left_semi")


def with_failure_records(predictions: DataFrame, failed: Column) -> DataFrame:
    """Rows that could not be scored become records of their own kind instead of errors."""
    bad = F.coalesce(failed, F.lit(True))

    def pick(column: str, value) -> Column:
        return F.when(bad, F.lit(value)).otherwise(F.col(column))

    return (
        predictions.withColumn("status", F.when(bad, "failed").otherwise("ok"))
        .withColumn("is_outlier", bad | (F.col("predicted_cluster_id") == -1))
        .withColumn("predicted_cluster_id", pick("predicted_cluster_id", -1))
        .withColumn("predicted_cluster_label", pick("predicted_cluster_label", FAILED_LABEL))
        .withColumn("confidence_score", pick("confidence_score", 0.0))
    )


def score(store: Store, incidents: DataFrame, as_of: Column, min_samples: int = density.MIN_SAMPLES,
          keep_vectors: bool = False) -> DataFrame:
    """Predictions for incidents with ``number, tech_center, embedding``; every input row gets a record."""
    cycles = store.read("training_cycle_metadata")
    latest = governance.latest_per_center(cycles).select(*MODEL, "cluster_results_table", "clusterer_artifact_path")
    axes = load_model(store, "model_components", latest)
    trained = load_model(store, "model_points", latest)
    info = load_model(store, "model_labels", latest)
    domain_rows = load_model(store, "model_domains", latest)

    usable = incidents.where(vectors.finite(F.col("embedding"))).join(
        axes.select("tech_center").distinct(), "tech_center", "left_semi"
    )
    placed = reduction.project(usable.select("tech_center", "number", "embedding"), axes, ["tech_center"], "embedding")
    found = density.predict(
        placed.select("tech_center", "number", "reduced"),
        trained.select("tech_center", "number", "reduced", "cluster_id", "core_distance", "lambda"),
        ["tech_center"], "number", "reduced", min_samples,
    )
    named = lookups.label_predictions(found, info, domain_rows.select("tech_center", "cluster_id", "domain_name"), ["tech_center"])
    ids = domain_rows.select("tech_center", "cluster_id", F.col("domain_id").alias("predicted_domain_id"))
    named = named.join(ids, ["tech_center", "cluster_id"], "left")
    base = incidents.select("number", "tech_center", *(["embedding"] if keep_vectors else []))
    joined = base.join(latest.drop("model_version", "model_hash"), "tech_center", "left").join(named, ["tech_center", "number"], "left")
    records = joined.select(
        F.col("number").cast("string").alias("incident_id"), "tech_center",
        F.col("cluster_id").alias("predicted_cluster_id"), F.col("cluster_name").alias("predicted_cluster_label"),
        scoring.confidence(F.col("cluster_id"), 1.0 - F.col("strength")).alias("confidence_score"),
        "predicted_domain_id", F.col("domain").alias("predicted_domain_name"), as_of.alias("prediction_timestamp"),
        F.col("cluster_results_table").alias("model_table_used"), F.col("clusterer_artifact_path").alias("blob_model_path"),
        "distance", F.col("cluster_id").isNull().alias("_failed"), *(["embedding"] if keep_vectors else []),
    )
    out = with_failure_records(records, F.col("_failed")).drop("_failed")
    return out.withColumn("predicted_domain_name", F.when(F.col("status") == "failed", "Error").otherwise(F.col("predicted_domain_name"))).withColumn(
        "confidence_band", scoring.confidence_band(F.col("confidence_score"), F.col("distance"))
    )


def run_predictions(store: Store, now: datetime, hours: int = 2, json_path: str | None = None, **options) -> DataFrame:
    """Score everything stored since each center's last run, append the predictions, then advance the watermarks.

    ``hours`` before the last run are looked at again; a center without a run starts with all its rows.
    """
    rows = store.read("preprocessed_incidents")
    done = store.read("incident_predictions").select(F.col("incident_id").alias("number"))
    fresh = scans.ingested_since(rows, store.read("prediction_watermarks"), done, hours)
    return _score_and_store(store, fresh, now, json_path, **options)


def run_prediction_cycle(store: Store, now: datetime, centers: list[str] | None = None, batch: int | None = None,
                         days: int | None = None, **options) -> DataFrame:
    """Score every incident that has no prediction yet; ``batch`` and ``days`` narrow one cycle to the newest.

    A narrowed cycle doesn't move the watermarks, so what it leaves out is found by the next one.
    """
    rows = store.read("preprocessed_incidents")
    done = store.read("incident_predictions").select(F.col("incident_id").alias("number"))
    todo = scans.not_yet_predicted(rows, done, now, centers, days, batch, key="number")
    return _score_and_store(store, todo, now, None, move_marks=batch is None and days is None, **options)


def predict_one(store: Store, incident: DataFrame, now: datetime, **options) -> DataFrame:
    """A single incident takes the same way as a batch."""
    return score(store, incident, F.lit(now).cast("timestamp"), **options)


def _score_and_store(store: Store, rows: DataFrame, now: datetime, json_path: str | None, move_marks: bool = True,
                     **options) -> DataFrame:
    from ticketloom.runtime import cut

    with sinks.run_logged(store, "prediction", now) as log:
        rows = cut(rows)
        predictions = cut(score(store, rows, F.lit(now).cast("timestamp"), **options))
        log["rows"] = predictions.count()
        sinks.save_predictions(predictions, store)
        if json_path:
            sinks.write_json(sinks.without_vectors(predictions), json_path, "tech_center")
        if move_marks:
            marks = governance.prediction_watermarks(rows, now)
            sinks.write_table(schemas.conform(marks, schemas.PREDICTION_WATERMARKS), store, "prediction_watermarks")
    return predictions
