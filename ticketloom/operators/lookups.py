"""Joins of incidents and points with services, labels, domains and models.

None of the joins carries a broadcast hint: adaptive execution broadcasts a lookup side when its measured size is below
the session's threshold, and otherwise splits the skewed partitions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.operators.scans import top_per_group

MODEL_KEYS = ["tech_center", "model_version"]


def with_team(df: DataFrame, services: DataFrame) -> DataFrame:
    """Inner join of incidents with team services."""
    return df.join(services, "business_service")


def training_window(df: DataFrame, services: DataFrame, start, end, center: str | None = None) -> DataFrame:
    """Preprocessed incidents of a window with their center; all centers at once unless one is asked for."""
    from ticketloom.operators.scans import as_time, with_vectors

    t = services.select("business_service", F.col("TechCenter").alias("tech_center"))
    rows = with_vectors(df.where(F.col("sys_created_on").between(as_time(start), as_time(end))))
    out = rows.join(t, "business_service")
    if center is not None:
        out = out.where(F.col("tech_center") == center)
    return out.select("number", "tech_center", "sys_created_on", "combined_incidents_summary", "embedding")


def unmatched(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_anti")


def label_points(
    points: DataFrame, info: DataFrame, domains: DataFrame, keys: list[str] = MODEL_KEYS
) -> DataFrame:
    """Points with cluster label, description and domain; noise and unknown clusters get the noise defaults."""
    on = [*keys, "cluster_id"]
    joined = points.join(
        info.select(*on, F.col("primary_label").alias("_label"), F.col("description").alias("_text")), on, "left"
    ).join(domains.select(*on, F.col("domain_id").alias("_domain"), F.col("domain_name").alias("_name")), on, "left")
    return (
        joined.withColumn("cluster_label", F.coalesce("_label", F.lit("Noise")))
        .withColumn("cluster_description", F.coalesce("_text", F.lit("")))
        .withColumn("domain_id", F.coalesce("_domain", F.lit(-1)))
        .withColumn("domain_name", F.coalesce("_name", F.lit("Noise")))
        .drop("_label", "_text", "_domain", "_name")
    )


def explode_domains(domains: DataFrame) -> DataFrame:
    """Domain records with a ``clusters`` array to one row per cluster."""
    return domains.withColumn("cluster_id", F.explode("clusters")).drop("clusters")


def categorize_points(
    points: DataFrame, topics: DataFrame, domain_rows: DataFrame, keys: list[str] = MODEL_KEYS
) -> DataFrame:
    """Category and subcategory columns; topics default to "Unknown", domains to "Other", noise is "Noise"."""
    on = [*keys, "cluster_id"]
    joined = points.join(topics.select(*on, F.col("topic").alias("_topic")), on, "left").join(
        domain_rows.select(*on, F.col("domain_name").alias("_name")), on, "left"
    )
    noise = F.col("cluster_id") == -1
    return (
        joined.withColumn("subcategory", F.when(noise, "Noise").otherwise(F.coalesce("_topic", F.lit("Unknown"))))
        .withColumn("category", F.coalesce("_name", F.lit("Other")))
        .drop("_topic", "_name")
    )


def label_predictions(
    predictions: DataFrame, labels: DataFrame, domains: DataFrame, keys: list[str], cluster: str = "cluster_id"
) -> DataFrame:
    """Cluster and domain names of predictions; unknown clusters are called ``Cluster_{id}`` in domain "Unknown"."""
    on = [*keys, cluster]
    joined = predictions.join(
        labels.select(*keys, F.col("cluster_id").alias(cluster), F.col("primary_label").alias("_label")), on, "left"
    ).join(domains.select(*keys, F.col("cluster_id").alias(cluster), F.col("domain_name").alias("_name")), on, "left")
    return (
        joined.withColumn("cluster_name", F.coalesce("_label", F.concat(F.lit("Cluster_"), F.col(cluster))))
        .withColumn("domain", F.coalesce("_name", F.lit("Unknown")))
        .drop("_label", "_name")
    )


def latest_mapping(cycles: DataFrame, results: DataFrame) -> DataFrame:
    """Distinct cluster and domain mapping of each center's latest successful model."""
    ok = cycles.where(F.col("training_status") == "SUCCESS")
    latest = top_per_group(ok, ["tech_center"], [F.desc("training_completed_date"), F.desc("model_hash")], 1)
    on = ["tech_center", "model_version", "model_hash"]
    return (
        results.join(latest.select(*on), on, "left_semi")
        .select(*on, "cluster_id", "cluster_label", "domain_id", "domain_name")
        .distinct()
    )


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Target with changed rows replaced and new rows added."""
    return target.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def overlay(base: DataFrame, new: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Last writer wins: the new value where there is one, the old value otherwise."""
    n = new.select(*keys, F.col(column).alias("_new"))
    return base.join(n, keys, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def fill_missing_labels(ids: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Every cluster gets a label: its own, or a generated one; noise is called "Noise"."""
    joined = ids.join(labels.select(*keys, "cluster_id", "topic", "description"), [*keys, "cluster_id"], "left")
    noise = F.col("cluster_id") == -1
    return joined.withColumn(
        "topic",
        F.when(noise, "Noise").otherwise(F.coalesce("topic", F.concat(F.lit("Cluster "), "cluster_id"))),
    ).withColumn(
        "description",
        F.when(noise, "Uncategorized data points").otherwise(
            F.coalesce("description", F.lit("Group of related IT incidents"))
        ),
    )


def concat_parts(*parts: DataFrame) -> DataFrame:
    """Parts of one result, matched by column name; a column that a part lacks is null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def compare_versions(analysis: DataFrame, version1: str, version2: str) -> DataFrame:
    """Changes of clusters, silhouette and noise between two versions, with a recommendation, per center."""
    from ticketloom.functions.scoring import recommendation

    def side(version: str, tag: str) -> DataFrame:
        return analysis.where(F.col("model_version") == version).select(
            "tech_center",
            F.col("n_clusters").alias(f"n{tag}"),
            F.col("silhouette_score").alias(f"s{tag}"),
            F.col("noise_ratio").alias(f"r{tag}"),
        )

    joined = side(version1, "1").join(side(version2, "2"), "tech_center")
    return joined.select(
        "tech_center",
        F.lit(version1).alias("version1"),
        F.lit(version2).alias("version2"),
        (F.col("n2") - F.col("n1")).alias("cluster_count_change"),
        (F.col("s2") - F.col("s1")).alias("quality_score_change"),
        (F.col("r2") - F.col("r1")).alias("noise_ratio_change"),
        recommendation(F.col("s1"), F.col("s2"), F.col("r1"), F.col("r2")).alias("recommendation"),
    )
