"""Small numeric rules: confidence, bands, domain counts, recommendations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the acceptance and quality rules.
MIN_CONFIDENCE = 0.3
HIGH_CONFIDENCE = 0.8
MAX_DISTANCE = 2.0
MIN_CLUSTERS = 3
MAX_NOISE_RATIO = 0.30
MIN_SILHOUETTE = 0.15
MAX_DOMAINS = 20
DEFAULT_DOMAINS = 15
EXPECTED_CLUSTERS = 20
OUTLIER_BANDS = ((5, "excellent"), (10, "good"), (20, "acceptable"))
WORST_BAND = "poor"
MAX_ERROR_RATE = 0.05


def confidence(cluster_id: Column, outlier_score: Column, failed: Column | None = None) -> Column:
    """Confidence of a prediction from the row's own outlier score."""
    out = (
        F.when(cluster_id == -1, 0.0)
        .when(outlier_score.isNull(), 0.7)
        .otherwise(F.greatest(F.lit(0.0), 1.0 - outlier_score))
    )
    return out if failed is None else F.when(failed, 0.5).otherwise(out)


def confidence_band(score: Column, distance: Column | None = None) -> Column:
    """``high``, ``accepted`` or ``rejected``; a point too far from its cluster is rejected as well."""
    reject = score < MIN_CONFIDENCE
    if distance is not None:
        reject = reject | (distance > MAX_DISTANCE)
    return F.when(reject, "rejected").when(score >= HIGH_CONFIDENCE, "high").otherwise("accepted")


def outlier_band(percentage: Column) -> Column:
    out = None
    for limit, name in OUTLIER_BANDS:
        out = F.when(percentage < limit, name) if out is None else out.when(percentage < limit, name)
    return out.otherwise(WORST_BAND)


def quality_reasons(n_clusters: Column, noise_ratio: Column, silhouette: Column) -> Column:
    """Names of the failed quality rules; empty means the gate is passed."""
    return F.array_compact(
        F.array(
            F.when(n_clusters < MIN_CLUSTERS, "too_few_clusters"),
            F.when(noise_ratio > MAX_NOISE_RATIO, "too_much_noise"),
            F.when(silhouette < MIN_SILHOUETTE, "low_silhouette"),
        )
    )


def domain_count(n_clusters: Column, max_domains: int = MAX_DOMAINS) -> Column:
    """A third of the clusters, at least three, at most the maximum, never more than there are clusters."""
    wanted = F.least(F.lit(max_domains), F.greatest(F.lit(3), F.floor(n_clusters / 3)))
    return F.least(wanted, n_clusters).cast("long")


def fallback_domain_count(n_clusters: Column) -> Column:
    return F.least(F.lit(DEFAULT_DOMAINS), F.greatest(F.lit(2), F.floor(n_clusters / 5))).cast("long")


def combined_domain_score(silhouette: Column, calinski: Column) -> Column:
    return silhouette + calinski / (1000 + calinski)


def mapping_confidence(incidents: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.1), incidents / 100.0))


def recommendation(sil1: Column, sil2: Column, noise1: Column, noise2: Column) -> Column:
    return (
        F.when((sil2 > sil1 + 0.05) & (noise2 < noise1), "upgrade_recommended")
        .when((sil2 < sil1 - 0.05) | (noise2 > noise1 + 0.1), "keep_previous_version")
        .otherwise("similar_performance")
    )


def safe_rate(part: Column, whole: Column) -> Column:
    """Percentage, zero where there is nothing to divide by."""
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def model_hash(*parts: Column, length: int = 8, algorithm: str = "sha256") -> Column:
    """Stable short digest of the named parts, in the order of their names."""
    payload = F.to_json(F.struct(*parts))
    digest = F.md5(payload) if algorithm == "md5" else F.sha2(payload, 256)
    return F.substring(digest, 1, length)
