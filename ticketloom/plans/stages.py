"""Restartable stages and the single-shot form. Each stage reads tables and writes tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import providers
from ticketloom.operators import cluster_stats, lookups, preparation, quality
from ticketloom.plans.preprocess import prepare_texts
from ticketloom.plans.train import TrainingOptions, cluster_points, complete_analysis
from ticketloom.sources import sinks
from ticketloom.sources.tables import Store

STAGES = {1: "embeddings", 2: "clustering", 3: "analysis", 4: "results"}
KEYS = ["tech_center"]


def run_stages(
    store: Store,
    incidents: DataFrame,
    now: datetime,
    start: int = 1,
    end: int = 4,
    options: TrainingOptions | None = None,
    summaries: DataFrame | None = None,
    dims: int = providers.DEFAULT_DIMENSIONS,
    reuse: bool = False,
) -> dict[str, DataFrame]:
    """Run stages ``start`` to ``end``; earlier stages are read from their tables, and with ``reuse`` the asked ones too.

    ``incidents`` carries ``tech_center``. Given summaries are joined by number and only missing ones are made.
    """
    if not 1 <= start <= 4 or not 1 <= end <= 4 or start > end:
        raise ValueError(f"stages must satisfy 1 <= start <= end <= 4, got {start} to {end}")
    options = options or TrainingOptions()
    out: dict[str, DataFrame] = {}

    def stage(number: int, name: str, make) -> DataFrame:
        if number < start and not store.exists(name):
            raise FileNotFoundError(f"stage {number} left no table {name}")
        out[name] = store.read_or_compute(name, make, reuse=reuse or number < start)
        return out[name]

    def embeddings() -> DataFrame:
        rows = prepare_texts(incidents)
        if summaries is not None:
            rows = preparation.keep_summaries(rows, summaries)
        return providers.embed(rows, "combined_text", dims=dims)  # whole texts, as in the preprocessing job

    embedded = stage(1, "stage_embeddings", embeddings)
    if end >= 2:
        usable = embedded.where("embedding is not null and tech_center is not null")
        clustered = stage(2, "stage_clustering", lambda: cluster_points(usable, options)[0])
    if end >= 3:
        parts = complete_analysis(clustered, options, KEYS) if start <= 3 else {}
        for name in ("cluster_info", "domain_info", "summary"):
            stage(3, f"stage_{name}", lambda name=name: parts[name])
        stage(3, "stage_metrics", lambda: quality.analyse(clustered, KEYS, vec="reduced", silhouette=options.silhouette))
    if end >= 4:
        topics = out["stage_cluster_info"].withColumnRenamed("primary_label", "topic")
        final = lookups.categorize_points(clustered, topics, out["stage_domain_info"], KEYS)
        final = final.withColumn("cluster", F.col("cluster_id")).withColumn("TechCenter", F.col("tech_center"))
        sinks.save_results(final, store, "results", "WRITE_TRUNCATE")
        sinks.save_minimal_results(final, store, "results_minimal")
        out["results"] = store.read("results", sinks.result_columns(final).schema)
        meta = cluster_stats.cluster_statistics(clustered, KEYS).withColumn("finished_at", F.lit(now).cast("timestamp"))
        sinks.write_json(meta, store.path("run_metadata"))
    return out


def run_clustering(store: Store, incidents: DataFrame, now: datetime, **kwargs) -> dict[str, DataFrame]:
    """Single-shot form: all stages, nothing reused."""
    return run_stages(store, incidents, now, 1, 4, **kwargs)
