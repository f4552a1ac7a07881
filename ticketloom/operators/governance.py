"""Model registry, training cycles, watermarks, retention, monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions import dates, json_repair, scoring, text
from ticketloom.operators.lookups import upsert
from ticketloom.operators.scans import as_time, top_per_group


def latest_per_center(cycles: DataFrame, status: str = "SUCCESS", keys: tuple[str, ...] = ("tech_center",)) -> DataFrame:
    """Latest successful cycle of every center in one pass."""
    ok = cycles.where(F.col("training_status") == status)
    return top_per_group(ok, list(keys), [F.desc("training_completed_date"), F.desc("model_hash")], 1)


def latest_active(registry: DataFrame) -> DataFrame:
    ok = registry.where(F.col("model_status") == "active")
    return top_per_group(ok, ["tech_center"], [F.desc("training_completed_date"), F.desc("model_hash")], 1)


def latest_or_fallback(cycles: DataFrame, centers: DataFrame, fallback: str) -> DataFrame:
    """Model version to load per center: the latest one, or the fallback version where there is none."""
    latest = latest_per_center(cycles).select("tech_center", F.col("model_version").alias("_v"))
    return centers.join(latest, "tech_center", "left").select(
        "tech_center",
        F.coalesce("_v", F.lit(fallback)).alias("model_version"),
        F.col("_v").isNull().alias("is_fallback"),
    )


def newest_versions(registry: DataFrame, keep: int = 3) -> DataFrame:
    """Rows of the newest versions of each center.

    Versions are ranked on the distinct (center, version) pairs, never on the raw rows.
    """
    versions = registry.groupBy("tech_center", "model_version").agg(F.max("training_completed_date").alias("_last"))
    kept = top_per_group(versions, ["tech_center"], [F.desc("model_version")], keep)
    return registry.join(kept.select("tech_center", "model_version"), ["tech_center", "model_version"], "left_semi")


def version_metrics(cycles: DataFrame) -> DataFrame:
    """One row per center and version: average quality of its successful cycles."""
    return (
        cycles.where(F.col("training_status") == "SUCCESS")
        .groupBy("tech_center", "model_version")
        .agg(
            F.count("*").alias("n_cycles"),
            F.avg("silhouette_score").alias("silhouette_score"),
            F.avg("noise_ratio").alias("noise_ratio"),
            F.avg("clusters_count").alias("clusters_count"),
        )
    )


def version_history(cycles: DataFrame) -> DataFrame:
    """Versions of a center in order, with the change against the one before.

    The window runs over one row per version, so even a center with most of the cycles gives a short partition.
    """
    w = Window.partitionBy("tech_center").orderBy("model_version")
    m = version_metrics(cycles)
    return m.withColumn("previous_version", F.lag("model_version").over(w)).withColumn(
        "silhouette_change", F.col("silhouette_score") - F.lag("silhouette_score").over(w)
    )


def quality_drift(cycles: DataFrame, drop: float = 0.05) -> DataFrame:
    """Version history with a flag where the silhouette fell by more than ``drop``."""
    return version_history(cycles).withColumn(
        "drifted", F.coalesce(F.col("silhouette_change") < -drop, F.lit(False))
    )


def parameter_correlation(cycles: DataFrame) -> DataFrame:
    """How cluster count and noise go with the silhouette, per center."""
    return (
        cycles.where(F.col("training_status") == "SUCCESS")
        .groupBy("tech_center")
        .agg(
            F.corr("clusters_count", "silhouette_score").alias("clusters_vs_silhouette"),
            F.corr("noise_ratio", "silhouette_score").alias("noise_vs_silhouette"),
        )
    )


def best_version(cycles: DataFrame) -> DataFrame:
    """Version with the best silhouette per center."""
    return top_per_group(
        version_metrics(cycles), ["tech_center"], [F.desc("silhouette_score"), F.desc("model_version")], 1
    )


def version_exists(registry: DataFrame) -> DataFrame:
    """Versions that already have an active row."""
    return registry.where(F.col("model_status") == "active").select("tech_center", "model_version").distinct()


def archive_old(registry: DataFrame, as_of, days: int = dates.REGISTRY_RETENTION_DAYS) -> DataFrame:
    """Registry with active rows past retention set to archived."""
    cutoff = dates.days_before(as_time(as_of), days)
    old = (F.col("model_status") == "active") & (F.col("training_completed_date") < cutoff)
    return registry.withColumn("model_status", F.when(old, "archived").otherwise(F.col("model_status")))


def keep_unexpired(artefacts: DataFrame, as_of, days: int = dates.ARTEFACT_RETENTION_DAYS) -> DataFrame:
    return artefacts.where(F.col("last_modified") >= dates.days_before(as_time(as_of), days))


def delete_version(artefacts: DataFrame, version: str, center: str, digest: str) -> DataFrame:
    gone = (F.col("model_version") == version) & (F.col("tech_center") == center) & (F.col("model_hash") == digest)
    return artefacts.where(~gone)


def list_artefacts(artefacts: DataFrame, center: str | None = None) -> DataFrame:
    """Artefacts, newest first."""
    out = artefacts if center is None else artefacts.where(F.col("tech_center") == center)
    return out.orderBy(F.desc("last_modified"), "path")


def newest_artefact(artefacts: DataFrame) -> DataFrame:
    return artefacts.groupBy("tech_center", "model_version").agg(
        F.max_by("path", F.struct("last_modified", "path")).alias("path"), F.max("last_modified").alias("last_modified")
    )


def promote(registry: DataFrame, min_silhouette: float = scoring.MIN_SILHOUETTE) -> DataFrame:
    """Stage transition: the newest good staging model of a center becomes production, the old production is archived.

    The candidates are found by one aggregation per center and joined back; no window sorts a whole center.
    """
    good = registry.where((F.col("stage") == "staging") & (F.col("silhouette_score") >= min_silhouette))
    pick = good.groupBy("tech_center").agg(
        F.max_by("training_cycle_id", F.struct("training_completed_date", "training_cycle_id")).alias("_pick")
    )
    joined = registry.join(pick, "tech_center", "left")
    new = (
        F.when(F.col("training_cycle_id") == F.col("_pick"), "production")
        .when(F.col("_pick").isNotNull() & (F.col("stage") == "production"), "archived")
        .otherwise(F.col("stage"))
    )
    return joined.withColumn("new_stage", new).drop("_pick")


def model_dashboard(cycles: DataFrame) -> DataFrame:
    """Latest production and staging model per center, side by side."""
    rows = cycles.where((F.col("training_status") == "SUCCESS") & F.col("stage").isin("production", "staging"))
    pick = F.struct("training_completed_date", "model_hash", "model_version", "silhouette_score", "clusters_count")
    return (
        rows.groupBy("tech_center")
        .pivot("stage", ["production", "staging"])
        .agg(F.max(pick).alias("m"))
        .select(
            "tech_center",
            *[
                F.col(f"{stage}.{c}").alias(f"{stage}_{c}")
                for stage in ("production", "staging")
                for c in ("model_version", "silhouette_score", "clusters_count")
            ],
        )
    )


def watermark_of(df: DataFrame, time: str = "sys_created_on", keys: tuple[str, ...] = ()) -> DataFrame:
    """Newest processed time, overall or per key."""
    return df.groupBy(*keys).agg(F.max(time).alias("last_processed_timestamp"))


def newest_row(df: DataFrame, key: str = "number", time: str = "sys_created_on", keys: tuple[str, ...] = ()):
    """Identifier and time of the newest row."""
    return df.groupBy(*keys).agg(
        F.max_by(key, F.struct(time, key)).alias("newest_incident_id"), F.max(time).alias("newest_incident_timestamp")
    )


def update_watermarks(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Watermark table after an upsert on pipeline and center."""
    return upsert(target, changes, ["pipeline_name", "tech_center"])


def latest_run(runs: DataFrame) -> DataFrame:
    """Latest run record with its end date taken out of the details."""
    last = runs.orderBy(F.desc("time_trigger"), F.desc("run_id")).limit(1)
    end = dates.parse_timestamp(json_repair.run_end(F.col("run_details")))
    return last.withColumn("end_time", end)


def run_record(rows: Column, start: Column, end: Column, newest_id: Column, newest_time: Column) -> Column:
    """Details document of a run; times keep their fractions, as the next window begins at the end."""
    iso = dates.ISO_FRACTIONS
    return F.to_json(
        F.struct(
            F.date_format(start, iso).alias("start_date"),
            F.date_format(end, iso).alias("end_date"),
            rows.alias("rows_processed"),
            newest_id.alias("newest_incident_id"),
            F.date_format(newest_time, iso).alias("newest_incident_timestamp"),
        )
    )


def prediction_watermarks(predictions: DataFrame, as_of, time: str = "sys_created_on") -> DataFrame:
    return predictions.groupBy("tech_center").agg(
        as_time(as_of).alias("prediction_timestamp"),
        F.max(time).alias("last_processed_incident_time"),
        F.count("*").alias("processed_incident_count"),
    )


def prediction_status(predictions: DataFrame, as_of, active_days: int = 30) -> DataFrame:
    """Totals per center and overall; a center is active when it had predictions lately."""
    cutoff = dates.days_before(as_time(as_of), active_days)
    rolled = predictions.rollup("tech_center").agg(
        F.grouping("tech_center").alias("is_total"),
        F.count("*").alias("total_predictions"),
        F.count_if(F.col("failed")).alias("failed_predictions"),
        F.count_if(F.col("predicted_cluster_id") == -1).alias("outliers"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.max("prediction_timestamp").alias("last_prediction"),
    )
    return rolled.withColumn("tech_center", F.when(F.col("is_total") == 1, "all").otherwise(F.col("tech_center"))).withColumn(
        "active", F.col("last_prediction") >= cutoff
    )


def alerts(status: DataFrame, cycles: DataFrame, max_error_rate: float = scoring.MAX_ERROR_RATE) -> DataFrame:
    """Raised conditions per center: failed trainings, low quality, too many failed predictions."""
    c = cycles.groupBy("tech_center").agg(
        F.count_if(F.col("training_status") == "FAILED").alias("failed_trainings"),
        F.count_if(F.col("silhouette_score") < scoring.MIN_SILHOUETTE).alias("low_quality_models"),
    )
    s = status.where(F.col("is_total") == 0).select(
        "tech_center", (F.col("failed_predictions") / F.col("total_predictions")).alias("error_rate")
    )
    joined = c.join(s, "tech_center", "full")
    return joined.select(
        "tech_center",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("failed_trainings") > 0, "training_failure"),
                    F.when(F.col("low_quality_models") > 0, "low_quality"),
                    F.when(F.col("error_rate") > max_error_rate, "prediction_errors"),
                )
            )
        ).alias("alert"),
    )


def confidence_histogram(predictions: DataFrame, bins: int = 10) -> DataFrame:
    """Predictions per confidence bin, model table and center."""
    b = F.least(F.floor(F.col("confidence_score") * bins), F.lit(bins - 1))
    return predictions.groupBy("model_table_used", b.alias("bin")).agg(F.count("*").alias("n"))


def usage_metrics(predictions: DataFrame) -> DataFrame:
    """Use and confidence of every model table."""
    return predictions.groupBy("model_table_used").agg(
        F.count("*").alias("predictions"),
        F.countDistinct("tech_center").alias("centers"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.count_if(F.col("confidence_score") < scoring.MIN_CONFIDENCE).alias("low_confidence"),
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Throughput per stage from the run log."""
    agg = runs.groupBy("stage").agg(
        F.count("*").alias("runs"), F.sum("preprocessed_rows").alias("rows"), F.sum("seconds").alias("seconds")
    )
    return agg.withColumn("seconds_per_row", F.col("seconds") / F.nullif("rows", F.lit(0))).withColumn(
        "rows_per_second", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")).otherwise(0.0)
    )


def cluster_distribution(predictions: DataFrame, cluster: str = "predicted_cluster_id") -> DataFrame:
    return predictions.groupBy("tech_center", cluster).agg(F.count("*").alias("n"))


# --- failures --------------------------------------------------------------------------------------------------------


def failure_breakdown(failures: DataFrame) -> DataFrame:
    """Failures by stage and error class with the number of distinct incidents."""
    return (
        failures.withColumn("error_class", text.classify_error(F.col("message")))
        .groupBy("stage", "error_class")
        .agg(F.count("*").alias("failures"), F.countDistinct("number").alias("incidents"))
    )


def failed_incidents(failures: DataFrame) -> DataFrame:
    """Distinct failed incidents over all stages, with the stages they failed in."""
    return failures.groupBy("number").agg(F.array_sort(F.collect_set("stage")).alias("stages"))


def center_failure_share(failures: DataFrame) -> DataFrame:
    """Share of each center in all failures. The total comes from the per-center counts."""
    n = failures.groupBy("tech_center").agg(F.count("*").alias("failures"))
    total = n.agg(F.sum("failures").alias("_total")).withColumn("_one", F.lit(1))
    return (
        n.withColumn("_one", F.lit(1))
        .join(total, "_one")
        .select("tech_center", "failures", (F.col("failures") / F.col("_total") * 100).alias("percentage"))
    )


def stage_rollup(inputs: DataFrame, failures: DataFrame) -> DataFrame:
    """Input rows, failures per stage and rows left over with the overall success rate."""
    f = failures.groupBy().agg(
        F.countDistinct(F.when(F.col("stage") == "summarization", F.col("number"))).alias("summarization_failures"),
        F.countDistinct(F.when(F.col("stage") == "embedding", F.col("number"))).alias("embedding_failures"),
        F.countDistinct("number").alias("total_failed"),
    )
    n = inputs.agg(F.count("*").alias("total_incidents"))
    joined = n.withColumn("_one", F.lit(1)).join(f.withColumn("_one", F.lit(1)), "_one").drop("_one")
    ready = F.greatest(F.col("total_incidents") - F.col("total_failed"), F.lit(0))
    return joined.withColumn("ready", ready).withColumn(
        "overall_success_rate", scoring.safe_rate(F.col("ready"), F.col("total_incidents"))
    )
