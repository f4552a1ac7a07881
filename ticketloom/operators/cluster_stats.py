"""Statistics of a clustering, keyed by model. Every aggregate combines map-side; no window runs over raw points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import scoring, vectors
from ticketloom.operators.scans import top_per_group

MODEL_KEYS = ["tech_center", "model_version"]


def cluster_sizes(points: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Size and share of each cluster, noise included."""
    sizes = points.groupBy(*keys, "cluster_id").agg(F.count("*").alias("size"))
    totals = sizes.groupBy(*keys).agg(F.sum("size").alias("total_points"))
    return sizes.join(totals, keys).withColumn("percentage", F.col("size") / F.col("total_points") * 100)


def cluster_statistics(points: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Cluster count, noise share and size range; balance and stability from the entropy of the sizes."""
    sizes = points.groupBy(*keys, "cluster_id").agg(F.count("*").alias("size"))
    s = F.when(F.col("cluster_id") != -1, F.col("size"))
    # sum(p ln p) with p = s / S equals sum(s ln s) / S - ln S, so one pass over the sizes is enough
    agg = sizes.groupBy(*keys).agg(
        F.count(s).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col("cluster_id") == -1, F.col("size"))), F.lit(0)).alias("n_noise_points"),
        F.sum("size").alias("n_total_points"),
        F.coalesce(F.avg(s), F.lit(0.0)).alias("avg_cluster_size"),
        F.coalesce(F.min(s), F.lit(0)).alias("min_cluster_size"),
        F.coalesce(F.max(s), F.lit(0)).alias("max_cluster_size"),
        F.coalesce(F.sum(s), F.lit(0)).alias("_in"),
        F.coalesce(F.sum(s * F.log(s)), F.lit(0.0)).alias("_slns"),
    )
    k = F.col("n_clusters")
    entropy = F.when(k > 0, F.log(F.col("_in")) - F.col("_slns") / F.col("_in")).otherwise(0.0)
    out = agg.withColumn("noise_ratio", F.col("n_noise_points") / F.col("n_total_points"))
    out = out.withColumn("entropy", F.greatest(entropy, F.lit(0.0)))
    out = out.withColumn("cluster_balance", F.when(k > 1, F.col("entropy") / F.log(k)).otherwise(F.col("entropy")))
    return out.withColumn(
        "stability_score",
        F.least(F.lit(1.0), k / scoring.EXPECTED_CLUSTERS) * F.col("cluster_balance"),
    ).drop("_in", "_slns")


def outlier_analysis(points: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    agg = points.groupBy(*keys).agg(
        F.count_if(F.col("cluster_id") == -1).alias("n_outliers"), F.count("*").alias("n_total_points")
    )
    out = agg.withColumn("outlier_percentage", F.col("n_outliers") / F.col("n_total_points") * 100)
    return out.withColumn("quality_assessment", scoring.outlier_band(F.col("outlier_percentage")))


def cluster_report(points: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Per-cluster size and share next to the balance, stability and outlier band of its model.

    One aggregation over the points; everything else works on the per-cluster sizes.
    """
    stats = cluster_statistics(points, keys).withColumn("outlier_percentage", F.col("noise_ratio") * 100)
    stats = stats.withColumn("quality_assessment", scoring.outlier_band(F.col("outlier_percentage")))
    sizes = points.groupBy(*keys, "cluster_id").agg(F.count("*").alias("size"))
    return sizes.join(stats, keys).withColumn("percentage", F.col("size") / F.col("n_total_points") * 100)


def sample_members(points: DataFrame, text_column: str, n: int = 5, seed: str = "42", keys: list[str] = MODEL_KEYS):
    """Seeded sample of members per cluster: the rows with the smallest salted digest."""
    digest = F.md5(F.concat(F.lit(seed), F.col("number").cast("string")))
    return top_per_group(points, [*keys, "cluster_id"], [digest, F.col("number")], n).select(
        *keys, "cluster_id", "number", text_column
    )


def first_members(points: DataFrame, n: int = 10, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Newest members per cluster."""
    return top_per_group(points, [*keys, "cluster_id"], [F.desc("sys_created_on"), F.col("number")], n)


def cluster_info(points: DataFrame, text_column: str, n: int = 5, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Size, share rounded to two digits and up to ``n`` sample texts per cluster."""
    on = [*keys, "cluster_id"]
    samples = (
        sample_members(points, text_column, n, keys=keys)
        .groupBy(*on)
        .agg(F.array_sort(F.collect_list(F.col(text_column).cast("string"))).alias("samples"))
    )
    sizes = cluster_sizes(points, keys).withColumn("percentage", F.bround("percentage", 2))
    return sizes.join(samples, on).select(*on, "size", "percentage", "samples")


def centroids(points: DataFrame, vec: str = "embedding", keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Size, centroid and population deviation per dimension of every cluster; members stay in the points table."""
    m = vectors.moments(points.where(F.col("cluster_id") != -1), [*keys, "cluster_id"], vec)
    return m.select(
        *keys,
        "cluster_id",
        F.col("n").alias("size"),
        F.col("mean").alias("centroid"),
        F.transform("var_pop", lambda x: F.sqrt(F.greatest(x, F.lit(0.0)))).alias("std"),
    )


def planar_centers(points: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Centre and spread of each cluster in the two reduced dimensions."""
    return (
        points.where(F.col("cluster_id") != -1)
        .groupBy(*keys, "cluster_id")
        .agg(
            F.count("*").alias("size"),
            F.avg("umap_x").alias("center_x"),
            F.avg("umap_y").alias("center_y"),
            F.stddev_pop("umap_x").alias("spread_x"),
            F.stddev_pop("umap_y").alias("spread_y"),
        )
    )


def largest_clusters(points: DataFrame, labels: DataFrame, k: int = 10, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Top clusters by size with their topic."""
    on = [*keys, "cluster_id"]
    sizes = points.where(F.col("cluster_id") != -1).groupBy(*on).agg(F.count("*").alias("size"))
    return (
        sizes.join(labels.select(*on, "primary_label"), on, "left")
        .orderBy(F.desc("size"), *on)
        .limit(k)
    )


def cluster_members(points: DataFrame, center: str, version: str, cluster: int, n: int = 5) -> DataFrame:
    """First members of a chosen cluster."""
    mine = (F.col("tech_center") == center) & (F.col("model_version") == version) & (F.col("cluster_id") == cluster)
    return points.where(mine).orderBy("number").limit(n)


def domain_totals(info: DataFrame, domains: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Clusters and incidents per domain. The members of a domain stay rows, see :func:`domain_members`."""
    on = [*keys, "cluster_id"]
    return (
        info.join(domains, on)
        .groupBy(*keys, "domain_id", "domain_name")
        .agg(
            F.count("*").alias("n_clusters"),
            F.sum("size").alias("total_incidents"),
            F.sum(F.size("keywords")).cast("long").alias("n_keywords"),
        )
    )


def domain_members(info: DataFrame, domains: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Clusters of each domain with size, label, description and keywords, one row per cluster."""
    return info.join(domains, [*keys, "cluster_id"]).select(
        *keys, "domain_id", "domain_name", "cluster_id", "size", "primary_label", "description", "keywords"
    )


def analysis_summary(info: DataFrame, domains: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Totals and ranges over clusters and over domains, per model."""
    c = info.groupBy(*keys).agg(
        F.count("*").alias("total_clusters"),
        F.sum("size").alias("total_incidents"),
        F.bround(F.avg("size"), 2).alias("avg_cluster_size"),
        F.max("size").alias("largest_cluster_size"),
        F.min("size").alias("smallest_cluster_size"),
    )
    d = (
        domain_totals(info, domains, keys)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_domains"),
            F.bround(F.avg("total_incidents"), 2).alias("avg_domain_size"),
            F.max("total_incidents").alias("largest_domain_size"),
            F.min("total_incidents").alias("smallest_domain_size"),
        )
    )
    return c.join(d, keys, "left")


def mapping_confidence(points: DataFrame, domains: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Clusters, domains and mapping confidence of each model's clusters."""
    on = [*keys, "cluster_id"]
    sizes = points.where(F.col("cluster_id") != -1).groupBy(*on).agg(F.count("*").alias("incident_count"))
    return sizes.join(domains, on, "left").withColumn(
        "mapping_confidence", scoring.mapping_confidence(F.col("incident_count"))
    )


def model_metadata(mapping: DataFrame, keys: list[str] = MODEL_KEYS) -> DataFrame:
    """Clusters and distinct domains per model."""
    return mapping.groupBy(*keys).agg(
        F.countDistinct("cluster_id").alias("total_clusters"), F.countDistinct("domain_id").alias("total_domains")
    )


def variance_ratio(points: DataFrame, vec: str, reduced: str, keys: list[str]) -> DataFrame:
    """Share of the total variance that the reduced vectors keep, with dimensions and reduction ratio."""

    def spread(column: str, tag: str) -> DataFrame:
        m = vectors.moments(points, keys, column)
        return m.select(
            *keys, F.col("n").alias(f"_n{tag}"), F.size("mean").alias(f"_d{tag}"), vectors.total(F.col("var_pop")).alias(f"_v{tag}")
        )

    a, b = spread(vec, "a"), spread(reduced, "b")
    return a.join(b, keys).select(
        *keys,
        F.col("_na").alias("n_samples"),
        F.col("_da").cast("long").alias("original_dimensions"),
        F.col("_db").cast("long").alias("reduced_dimensions"),
        (F.col("_da") / F.col("_db")).alias("reduction_ratio"),
        (F.col("_vb") / F.col("_va")).alias("explained_variance_ratio"),
    )


def quality_gate(stats: DataFrame) -> DataFrame:
    """Verdict and failed rules of the quality gate; a missing silhouette is not held against a model."""
    reasons = scoring.quality_reasons(F.col("n_clusters"), F.col("noise_ratio"), F.col("silhouette_score"))
    return stats.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)


def analysis_report(analysis: DataFrame) -> DataFrame:
    """Report text of every analysed model, in fixed number formats."""
    # Fixed value: layout of the report.
    layout = (
        "CLUSTER ANALYSIS REPORT\n=======================\nTech Center: %s\nModel Version: %s\nAnalysis Date: %s\n\n"
        "CLUSTER STATISTICS:\n- Number of Clusters: %d\n- Noise Points: %d (%.1f%%)\n- Average Cluster Size: %.1f\n\n"
        "QUALITY METRICS:\n- Silhouette Score: %.3f\n- Calinski-Harabasz Score: %.1f\n- Davies-Bouldin Score: %.3f\n\n"
        "OUTLIER ANALYSIS:\n- Outlier Percentage: %.1f%%\n- Quality Assessment: %s\n\n"
        "STABILITY METRICS:\n- Stability Score: %.3f\n- Cluster Balance: %.3f\n"
    )
    pct = F.col("noise_ratio") * 100
    return analysis.select(
        "tech_center",
        "model_version",
        F.format_string(
            layout,
            "tech_center",
            "model_version",
            F.date_format("analysis_timestamp", "yyyy-MM-dd'T'HH:mm:ss"),
            "n_clusters",
            "n_noise_points",
            pct,
            "avg_cluster_size",
            "silhouette_score",
            "calinski_harabasz",
            "davies_bouldin",
            pct,
            scoring.outlier_band(pct),
            "stability_score",
            "cluster_balance",
        ).alias("report"),
    )
