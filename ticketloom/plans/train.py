"""Training job: all centers are reduced, clustered, judged, labelled and registered together."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import dates, scoring, text, vectors
from ticketloom.operators import cluster_stats, density, domains, governance, lookups, quality, reduction, scans, terms
from ticketloom.runtime import cut
from ticketloom.sources import sinks
from ticketloom.sources.tables import Store

KEYS = ["tech_center"]
MODEL = ["tech_center", "model_version", "model_hash"]


@dataclass(frozen=True)
class TrainingOptions:
    min_cluster_size: int = density.MIN_CLUSTER_SIZE
    min_samples: int = density.MIN_SAMPLES
    cluster_selection_epsilon: float = 0.0
    cluster_selection_method: str = "eom"
    n_components: int = reduction.COMPONENTS
    standardize: bool = False
    reduce: bool = True
    silhouette: str = "sqeuclidean"
    max_domains: int = scoring.MAX_DOMAINS
    scored_domains: bool = False


def cluster_points(points: DataFrame, options: TrainingOptions, ident: str = "number") -> tuple[DataFrame, DataFrame]:
    """Vectors to labelled points: optional scaling, reduction, clustering. Also returns the fitted axes."""
    rows = points
    if options.standardize:
        rows = vectors.standardize(rows, KEYS, "embedding")
    axes = cut(reduction.fit_components(rows, KEYS, "embedding", options.n_components))
    reduced = reduction.project(rows, axes, KEYS, "embedding")
    if not options.reduce:
        reduced = reduced.withColumn("reduced", F.col("embedding"))
    reduced = cut(reduced)
    found = density.cluster(
        reduced, KEYS, ident, "reduced", options.min_cluster_size, options.min_samples,
        options.cluster_selection_method, options.cluster_selection_epsilon,
    )
    return reduced.join(found, [*KEYS, ident]), axes


def label_model(points: DataFrame, options: TrainingOptions, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Keyword labels of the clusters and their domains."""
    info = terms.label_clusters(points, keys, "combined_incidents_summary")
    centres = cut(cluster_stats.planar_centers(points, keys))
    grouped = (
        domains.group_domains_scored(centres, keys)
        if options.scored_domains
        else domains.group_domains(centres, keys, options.max_domains)
    )
    named = domains.name_domains(grouped, info.withColumnRenamed("primary_label", "topic"), keys)
    return cut(info), cut(named)


def complete_analysis(points: DataFrame, options: TrainingOptions, keys: list[str]) -> dict[str, DataFrame]:
    """Labels, domains, labelled points and summary of clustered points."""
    info, named = label_model(points, options, keys)
    return {
        "cluster_info": info,
        "domain_info": named,
        "labelled": lookups.label_points(points, info, named, keys),
        "summary": cluster_stats.analysis_summary(info, named, keys),
    }


def _hash(options: TrainingOptions, day: str) -> Column:
    """Digest over date, size, parameters and center, by name."""
    return scoring.model_hash(
        F.col("incidents_count"), F.lit(str(sorted(asdict(options).items()))).alias("parameters"),
        F.col("tech_center"), F.lit(day).alias("training_date"), algorithm="md5",
    )


def with_minimum(seen: DataFrame, least: int, centers: DataFrame | None = None) -> DataFrame:
    """Add ``enough``: has a center the rows it needs? ``centers`` may ask for more by ``tech_center, min_incidents``."""
    if centers is None:
        return seen.withColumn("enough", F.col("incidents_count") >= least)
    own = centers.groupBy("tech_center").agg(F.max("min_incidents").alias("_own"))
    return seen.join(own, "tech_center", "left").withColumn(
        "enough", F.col("incidents_count") >= F.greatest(F.lit(least), F.coalesce("_own", F.lit(0)))
    ).drop("_own")


def train(store: Store, preprocessed: DataFrame, now: datetime, months: int = dates.TRAINING_WINDOW_MONTHS,
          options: TrainingOptions | None = None, centers: DataFrame | None = None) -> DataFrame:
    """Train every center on its window and store results, model tables, artefact, registry and cycle rows.

    ``centers`` may name a least number of incidents for each center (``tech_center, min_incidents``). A center that fails the quality gate, or has fewer rows than a cluster needs, is stored with status FAILED and the
    reasons; scoring takes successful cycles only. A rerun replaces its own partitions. Returns the cycle rows.
    """
    with sinks.run_logged(store, "training", now) as log:
        cycles = _train(store, preprocessed, now, months, options or TrainingOptions(), centers)
        log["rows"] = cycles.agg(F.sum("incidents_count")).first()[0] or 0
    return cycles


def _train(store: Store, preprocessed: DataFrame, now: datetime, months: int, options: TrainingOptions, centers: DataFrame | None):
    end = F.lit(now).cast("timestamp")
    version = f"{now.year}_q{(now.month - 1) // 3 + 1}"
    window = scans.window_scan(
        scans.with_vectors(preprocessed), dates.window_start(end, months), end,
        ("number", "sys_created_on", "combined_incidents_summary", "tech_center", "embedding"),
    ).where(vectors.finite(F.col("embedding")))
    window = cut(window)
    # a center needs at least one cluster's worth of rows
    seen = window.groupBy("tech_center").agg(F.count("*").alias("incidents_count"))
    seen = cut(seen.withColumn("model_version", F.lit(version)).withColumn("model_hash", _hash(options, now.date().isoformat())))
    seen = cut(with_minimum(seen, options.min_cluster_size, centers))
    counts, small = seen.where("enough").drop("enough"), seen.where("not enough").drop("enough")
    seen = seen.drop("enough")
    usable = window.join(counts.select("tech_center"), "tech_center", "left_semi")
    clustered, axes = cluster_points(usable, options)
    points = cut(clustered.join(counts, "tech_center"))
    results = complete_analysis(points, options, MODEL)
    judged = cut(quality.gated(quality.analyse(points, MODEL, vec="reduced", silhouette=options.silhouette)))

    sinks.save_cluster_results(results["labelled"], store, end)
    for name, table in (
        ("model_components", axes.join(counts, "tech_center")),
        ("model_points", points.select(*MODEL, "number", "reduced", "cluster_id", "probability", "lambda", "outlier_score", "core_distance")),
        ("model_labels", results["cluster_info"]),
        ("model_domains", results["domain_info"]),
    ):
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MODEL).parquet(store.path(name))
    model_clusters = results["cluster_info"].select(
        *MODEL, "cluster_id", F.col("size").alias("cluster_size"), F.col("keywords").alias("cluster_keywords"),
        F.col("description").alias("cluster_description"), "domain",
    )
    sinks.save_clusters(model_clusters, store, version, end)
    cycles = cut(_cycle_rows(_with_small(judged, small), results["domain_info"], seen, now, end))
    sinks.write_table(cycles, store, "training_cycle_metadata", "WRITE_TRUNCATE")
    sinks.write_table(_registry_rows(cycles, judged, now, months, end, options), store, "model_registry", "WRITE_TRUNCATE")
    sinks.save_artefacts(_artefact_rows(cycles.where("training_status = 'SUCCESS'"), end), store)
    logs = cycles.select(
        F.concat_ws("-", F.lit("train"), "tech_center", "model_hash").alias("run_id"), end.alias("timestamp"),
        F.lit("training").alias("pipeline_stage"), "tech_center", "model_version",
        F.when(F.col("training_status") == "SUCCESS", "INFO").otherwise("WARNING").alias("log_level"),
        F.concat(F.lit("training "), F.lower("training_status")).alias("message"),
        F.to_json(F.struct("clusters_count", "noise_ratio", "error_message")).alias("details"),
    )
    sinks.append_logs(logs, store)
    marks = counts.select(
        F.lit("training_pipeline").alias("pipeline_name"), "tech_center", end.alias("last_processed_timestamp"),
        end.alias("updated_at"),
    )
    sinks.write_table(marks, store, "watermarks")
    return cycles


def _with_small(judged: DataFrame, small: DataFrame) -> DataFrame:
    """Judgements of all centers: those with too few rows have failed for that reason."""
    columns = [*MODEL, "silhouette_score", "noise_ratio", "n_clusters", "passed", "reasons"]
    kinds = {f.name: f.dataType for f in judged.schema}
    values = {"n_clusters": F.lit(0), "passed": F.lit(False), "reasons": F.array(F.lit("too_few_rows"))}
    failed = small.select(*(F.col(c) if c in MODEL else values.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in columns))
    return judged.select(*columns).unionByName(failed)


def _artefact_rows(cycles: DataFrame, end: Column) -> DataFrame:
    """One row for each stored part of a model: its kind, where it lies, and what it was made from."""
    parts = {"reducer": "umap_artifact_path", "clusterer": "clusterer_artifact_path", "metadata": "metadata_artifact_path"}
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("path")) for k, c in parts.items()]))
    payload = F.to_json(F.struct("incidents_count", "clusters_count", "domains_count"))
    return cycles.select(*MODEL, kind.alias("a"), end.alias("last_modified"), payload.alias("payload")).select(
        *MODEL, "a.kind", "a.path", "last_modified", "payload"
    )


def _cycle_rows(judged: DataFrame, domain_rows: DataFrame, counts: DataFrame, now: datetime, end: Column) -> DataFrame:
    n_domains = domain_rows.where("domain_id >= 0").groupBy(*MODEL).agg(F.countDistinct("domain_id").alias("domains_count"))
    slug = text.center_slug(F.col("tech_center"))
    path = F.concat_ws("/", "model_version", "model_hash", slug)
    rows = judged.join(n_domains, MODEL, "left").join(counts, MODEL)
    return schemas.conform(
        rows.select(
            *MODEL, "silhouette_score", "noise_ratio", "incidents_count", "domains_count",
            F.col("model_version").alias("training_cycle_id"), slug.alias("tech_center_slug"),
            F.lit(now.month).alias("training_month"), F.lit(now.year).alias("training_year"),
            end.alias("training_completed_date"),
            F.concat(F.lit("model_components/"), path).alias("umap_artifact_path"),
            F.concat(F.lit("model_points/"), path).alias("clusterer_artifact_path"),
            F.concat(F.lit("model_labels/"), path).alias("metadata_artifact_path"),
            text.versioned_name("cluster_results", F.col("model_version"), F.col("model_hash")).alias("cluster_results_table"),
            F.lit("preprocessed_incidents").alias("embeddings_source_table"),
            F.col("n_clusters").alias("clusters_count"),
            F.when(F.col("passed"), "SUCCESS").otherwise("FAILED").alias("training_status"),
            F.when(~F.col("passed"), F.array_join("reasons", ",")).alias("error_message"),
            end.alias("created_timestamp"),
        ),
        schemas.TRAINING_CYCLES,
    )


def _registry_rows(
    cycles: DataFrame, judged: DataFrame, now: datetime, months: int, end: Column, options: TrainingOptions
) -> DataFrame:
    metrics = judged.select(
        *MODEL, F.to_json(F.struct("n_clusters", "noise_ratio", "calinski_harabasz", "davies_bouldin", "stability_score")).alias("metrics")
    )
    return cycles.join(metrics, MODEL).select(
        *MODEL, F.lit("density").alias("model_type"),
        dates.window_start(end, months).cast("date").alias("training_data_start"), F.to_date(end).alias("training_data_end"),
        F.col("clusterer_artifact_path").alias("blob_path"), end.alias("created_timestamp"),
        F.lit(json.dumps(asdict(options), sort_keys=True, default=str)).alias("model_params"), F.col("clusters_count").alias("cluster_count"), "silhouette_score",
        F.when(F.col("training_status") == "SUCCESS", "active").otherwise("rejected").alias("model_status"),
        end.alias("training_date"), end.alias("updated_at"), "incidents_count", "metrics",
    )


def train_if_due(store: Store, preprocessed: DataFrame, now: datetime, **kwargs) -> DataFrame | None:
    """Train in the scheduled months only, and only the centers that have no active model of the version yet."""
    if now.month not in dates.TRAINING_MONTHS:
        return None
    version = f"{now.year}_q{(now.month - 1) // 3 + 1}"
    active = governance.version_exists(store.read("model_registry")).where(F.col("model_version") == version)
    todo = preprocessed.join(active.select("tech_center").distinct(), "tech_center", "left_anti")
    return None if todo.isEmpty() else train(store, todo, now, **kwargs)
