"""Clustering statistics, labels, registry and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.catalogue.registry import query
from ticketloom.operators import cluster_stats as cs
from ticketloom.operators import governance as gov
from ticketloom.operators import lookups, scans

_KEYS = "tech_center, model_version"
_SIZES = f"""sizes AS (SELECT {_KEYS}, cluster_id, count(*) AS size FROM clustered GROUP BY ALL)"""
_STATS = f"""{_SIZES}, stats AS (SELECT {_KEYS},
    count(*) FILTER (cluster_id <> -1) AS n_clusters,
    coalesce(sum(size) FILTER (cluster_id = -1), 0)::BIGINT AS n_noise_points, sum(size)::BIGINT AS n_total_points,
    avg(size) FILTER (cluster_id <> -1) AS avg_cluster_size, min(size) FILTER (cluster_id <> -1) AS min_cluster_size,
    max(size) FILTER (cluster_id <> -1) AS max_cluster_size, sum(size) FILTER (cluster_id <> -1) AS members FROM sizes GROUP BY ALL),
  ent AS (SELECT s.tech_center, s.model_version, -sum(size / members * ln(size / members)) AS entropy
    FROM sizes s JOIN stats t ON s.tech_center = t.tech_center AND s.model_version = t.model_version
    WHERE cluster_id <> -1 GROUP BY ALL)"""
_BAND = "CASE WHEN {0} < 5 THEN 'excellent' WHEN {0} < 10 THEN 'good' WHEN {0} < 20 THEN 'acceptable' ELSE 'poor' END"


def _rounded(df, *names, digits=6):
    for n in names:
        df = df.withColumn(n, F.round(n, digits))
    return df


def _long(df, *names):
    for n in names:
        df = df.withColumn(n, F.col(n).cast("long"))
    return df


@query(
    "cluster_report",
    f"""WITH {_STATS} SELECT s.tech_center, s.model_version, s.cluster_id::BIGINT AS cluster_id, s.size,
          round(s.size / n_total_points * 100, 6) AS percentage, n_clusters, n_noise_points,
          round(n_noise_points / n_total_points, 6) AS noise_ratio, round(entropy / ln(n_clusters), 6) AS cluster_balance,
          round(least(1.0, n_clusters / 20) * entropy / ln(n_clusters), 6) AS stability_score,
          {_BAND.format('n_noise_points / n_total_points * 100')} AS quality_assessment
        FROM sizes s JOIN stats t USING ({_KEYS}) JOIN ent e USING ({_KEYS})""",
)
def _(v):
    out = cs.cluster_report(v.clustered).select(
        "tech_center", "model_version", F.col("cluster_id").cast("long").alias("cluster_id"), "size", "percentage",
        "n_clusters", "n_noise_points", "noise_ratio", "cluster_balance", "stability_score", "quality_assessment",
    )
    return _rounded(out, "percentage", "noise_ratio", "cluster_balance", "stability_score")


@query(
    "cluster_statistics",
    f"""WITH {_STATS} SELECT {_KEYS}, n_clusters, n_noise_points, n_total_points, round(avg_cluster_size, 6) AS avg_cluster_size,
          min_cluster_size, max_cluster_size, round(n_noise_points / n_total_points, 6) AS noise_ratio FROM stats""",
)
def _(v):
    out = cs.cluster_statistics(v.clustered).drop("entropy", "cluster_balance", "stability_score")
    return _rounded(out, "avg_cluster_size", "noise_ratio")


@query(
    "cluster_stability",
    f"""WITH {_STATS} SELECT {_KEYS}, round(entropy, 6) AS entropy, round(entropy / ln(n_clusters), 6) AS cluster_balance,
          round(least(1.0, n_clusters / 20) * entropy / ln(n_clusters), 6) AS stability_score FROM stats JOIN ent USING ({_KEYS})""",
)
def _(v):
    out = cs.cluster_statistics(v.clustered).select(
        "tech_center", "model_version", "entropy", "cluster_balance", "stability_score"
    )
    return _rounded(out, "entropy", "cluster_balance", "stability_score")


@query(
    "cluster_sizes",
    f"""WITH {_SIZES} SELECT {_KEYS}, CASE WHEN cluster_id = -1 THEN 'noise' ELSE 'cluster_' || cluster_id END AS name, size,
          round(size / sum(size) OVER (PARTITION BY {_KEYS}) * 100, 6) AS percentage FROM sizes""",
)
def _(v):
    name = F.when(F.col("cluster_id") == -1, "noise").otherwise(F.concat(F.lit("cluster_"), "cluster_id"))
    out = cs.cluster_sizes(v.clustered).select("tech_center", "model_version", name.alias("name"), "size", "percentage")
    return _rounded(out, "percentage")


@query(
    "outlier_analysis",
    f"""SELECT {_KEYS}, count(*) FILTER (cluster_id = -1) AS n_outliers, count(*) AS n_total_points,
          round(count(*) FILTER (cluster_id = -1) / count(*) * 100, 6) AS outlier_percentage,
          {_BAND.format('count(*) FILTER (cluster_id = -1) / count(*) * 100')} AS quality_assessment FROM clustered GROUP BY {_KEYS}""",
)
def _(v):
    return _rounded(cs.outlier_analysis(v.clustered), "outlier_percentage")


@query(
    "cluster_info",
    f"""WITH {_SIZES}, ranked AS (SELECT {_KEYS}, cluster_id, combined_incidents_summary AS s,
          row_number() OVER (PARTITION BY {_KEYS}, cluster_id ORDER BY md5('42' || number), number) AS rn FROM clustered),
        picked AS (SELECT {_KEYS}, cluster_id, array_to_string(list_sort(list(s)), ';') AS samples FROM ranked WHERE rn <= 5 GROUP BY ALL)
        SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, size,
          round_even(size / sum(size) OVER (PARTITION BY {_KEYS}) * 100, 2) AS percentage, samples
        FROM sizes JOIN picked USING ({_KEYS}, cluster_id)""",
)
def _(v):
    out = cs.cluster_info(v.clustered, "combined_incidents_summary").withColumn("samples", F.array_join("samples", ";"))
    return _long(out, "cluster_id")


@query(
    "cluster_centroids",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, i AS dim, count(*) AS size, round(avg(x), 6) AS mean,
          round(stddev_pop(x), 6) AS std FROM (SELECT {_KEYS}, cluster_id, unnest(embedding) AS x,
          unnest(range(len(embedding))) AS i FROM clustered WHERE cluster_id <> -1) GROUP BY ALL""",
)
def _(v):
    c = cs.centroids(v.clustered).select(
        "tech_center", "model_version", F.col("cluster_id").cast("long").alias("cluster_id"), "size",
        F.posexplode(F.arrays_zip(F.col("centroid").alias("m"), F.col("std").alias("s"))).alias("dim", "e"),
    )
    return c.select(
        "tech_center", "model_version", "cluster_id", "size", F.col("dim").cast("long").alias("dim"),
        F.round("e.m", 6).alias("mean"), F.round("e.s", 6).alias("std"),
    )


@query(
    "cluster_membership",
    f"SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, number FROM clustered WHERE cluster_id <> -1",
)
def _(v):
    out = scans.without_noise(v.clustered).select("tech_center", "model_version", "cluster_id", "number")
    return _long(out, "cluster_id")


@query(
    "planar_centers",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, count(*) AS size, round(avg(umap_x), 6) AS center_x,
          round(avg(umap_y), 6) AS center_y, round(stddev_pop(umap_x), 6) AS spread_x, round(stddev_pop(umap_y), 6) AS spread_y
        FROM clustered WHERE cluster_id <> -1 GROUP BY ALL""",
)
def _(v):
    return _long(_rounded(cs.planar_centers(v.clustered), "center_x", "center_y", "spread_x", "spread_y"), "cluster_id")


@query(
    "first_members",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, number FROM clustered
        QUALIFY row_number() OVER (PARTITION BY {_KEYS}, cluster_id ORDER BY sys_created_on DESC, number) <= 10""",
)
def _(v):
    return _long(cs.first_members(v.clustered).select("tech_center", "model_version", "cluster_id", "number"), "cluster_id")


@query(
    "sample_members",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, number FROM clustered
        QUALIFY row_number() OVER (PARTITION BY {_KEYS}, cluster_id ORDER BY md5('42' || number), number) <= 5""",
)
def _(v):
    out = cs.sample_members(v.clustered, "combined_incidents_summary")
    return _long(out.drop("combined_incidents_summary"), "cluster_id")


@query(
    "largest_clusters",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, s.size, primary_label
        FROM (SELECT {_KEYS}, cluster_id, count(*) AS size FROM clustered WHERE cluster_id <> -1 GROUP BY ALL) s
        LEFT JOIN cluster_info i USING ({_KEYS}, cluster_id) ORDER BY s.size DESC, {_KEYS}, cluster_id LIMIT 10""",
)
def _(v):
    return _long(cs.largest_clusters(v.clustered, v.cluster_info), "cluster_id")


@query(
    "cluster_head",
    """SELECT number FROM clustered WHERE tech_center = 'BT-TC-1' AND model_version = '2024_q4' AND cluster_id = 3
       ORDER BY number LIMIT 5""",
)
def _(v):
    return cs.cluster_members(v.clustered, "BT-TC-1", "2024_q4", 3).select("number")


@query(
    "domain_members",
    f"""SELECT {_KEYS}, domain_id::BIGINT AS domain_id, domain_name, cluster_id::BIGINT AS cluster_id, size, primary_label
        FROM cluster_info JOIN domain_map USING ({_KEYS}, cluster_id)""",
)
def _(v):
    return _long(cs.domain_members(v.cluster_info, v.domain_map).drop("description", "keywords"), "domain_id", "cluster_id")


@query(
    "domain_totals",
    f"""SELECT {_KEYS}, domain_id::BIGINT AS domain_id, domain_name, count(*) AS n_clusters, sum(size)::BIGINT AS total_incidents,
          sum(len(keywords))::BIGINT AS n_keywords FROM cluster_info JOIN domain_map USING ({_KEYS}, cluster_id) GROUP BY ALL""",
)
def _(v):
    return _long(cs.domain_totals(v.cluster_info, v.domain_map), "domain_id")


@query(
    "domain_explode",
    f"SELECT {_KEYS}, domain_name, cluster_id::BIGINT AS cluster_id FROM domain_map",
)
def _(v):
    nested = v.domain_map.groupBy("tech_center", "model_version", "domain_name").agg(
        F.collect_list("cluster_id").alias("clusters")
    )
    return _long(lookups.explode_domains(nested), "cluster_id")


@query(
    "analysis_summary",
    f"""WITH d AS (SELECT {_KEYS}, domain_id, sum(size) AS t FROM cluster_info JOIN domain_map USING ({_KEYS}, cluster_id) GROUP BY ALL),
        dd AS (SELECT {_KEYS}, count(*) AS total_domains, round_even(avg(t), 2) AS avg_domain_size,
          max(t)::BIGINT AS largest_domain_size, min(t)::BIGINT AS smallest_domain_size FROM d GROUP BY ALL)
        SELECT * FROM (SELECT {_KEYS}, count(*) AS total_clusters, sum(size)::BIGINT AS total_incidents,
          round_even(avg(size), 2) AS avg_cluster_size, max(size) AS largest_cluster_size, min(size) AS smallest_cluster_size
          FROM cluster_info GROUP BY ALL) JOIN dd USING ({_KEYS})""",
)
def _(v):
    return cs.analysis_summary(v.cluster_info, v.domain_map)


@query(
    "mapping_confidence",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, incident_count, round(least(1.0, greatest(0.1, incident_count / 100)), 6)
          AS mapping_confidence FROM (SELECT {_KEYS}, cluster_id, count(*) AS incident_count FROM clustered
          WHERE cluster_id <> -1 GROUP BY ALL)""",
)
def _(v):
    out = cs.mapping_confidence(v.clustered, v.domain_map).drop("domain_id", "domain_name")
    return _long(_rounded(out, "mapping_confidence"), "cluster_id")


@query(
    "model_metadata",
    f"SELECT {_KEYS}, count(DISTINCT cluster_id) AS total_clusters, count(DISTINCT domain_id) AS total_domains FROM domain_map GROUP BY ALL",
)
def _(v):
    return cs.model_metadata(v.domain_map)


# --- labels ----------------------------------------------------------------------------------------------------------


@query(
    "label_points",
    f"""SELECT c.number, coalesce(i.primary_label, 'Noise') AS cluster_label, coalesce(i.description, '') AS cluster_description,
          coalesce(d.domain_id, -1)::BIGINT AS domain_id, coalesce(d.domain_name, 'Noise') AS domain_name
        FROM clustered c LEFT JOIN cluster_info i USING ({_KEYS}, cluster_id) LEFT JOIN domain_map d USING ({_KEYS}, cluster_id)""",
)
def _(v):
    out = lookups.label_points(v.clustered, v.cluster_info, v.domain_map)
    return _long(out.select("number", "cluster_label", "cluster_description", "domain_id", "domain_name"), "domain_id")


@query(
    "categorize_points",
    f"""SELECT c.number, CASE WHEN c.cluster_id = -1 THEN 'Noise' ELSE coalesce(i.primary_label, 'Unknown') END AS subcategory,
          coalesce(d.domain_name, 'Other') AS category
        FROM clustered c LEFT JOIN cluster_info i USING ({_KEYS}, cluster_id) LEFT JOIN domain_map d USING ({_KEYS}, cluster_id)""",
)
def _(v):
    topics = v.cluster_info.withColumnRenamed("primary_label", "topic")
    return lookups.categorize_points(v.clustered, topics, v.domain_map).select("number", "subcategory", "category")


@query(
    "label_predictions",
    """SELECT incident_id, coalesce('Topic ' || i.cluster_id, 'Cluster_' || predicted_cluster_id) AS cluster_name,
          coalesce(d.domain_name, 'Unknown') AS domain
       FROM predictions p
       LEFT JOIN (SELECT tech_center, cluster_id FROM cluster_info WHERE model_version = '2024_q4') i
         ON p.tech_center = i.tech_center AND predicted_cluster_id = i.cluster_id
       LEFT JOIN (SELECT * FROM domain_map WHERE model_version = '2024_q4') d
         ON p.tech_center = d.tech_center AND predicted_cluster_id = d.cluster_id""",
)
def _(v):
    now = F.col("model_version") == "2024_q4"
    return lookups.label_predictions(
        v.predictions, v.cluster_info.where(now), v.domain_map.where(now), ["tech_center"], "predicted_cluster_id"
    ).select("incident_id", "cluster_name", "domain")


@query(
    "latest_mapping",
    f"""WITH ok AS (SELECT tech_center, model_version, substr(md5(tech_center || '|' || model_version), 1, 8) AS model_hash
          FROM (SELECT tech_center, max(model_version) AS model_version FROM clustered GROUP BY 1))
        SELECT DISTINCT c.tech_center, c.model_version, c.model_hash, c.cluster_id::BIGINT AS cluster_id,
          coalesce(i.primary_label, 'Noise') AS cluster_label, coalesce(d.domain_id, -1)::BIGINT AS domain_id,
          coalesce(d.domain_name, 'Noise') AS domain_name
        FROM clustered c JOIN ok USING (tech_center, model_version, model_hash)
        LEFT JOIN cluster_info i USING ({_KEYS}, cluster_id) LEFT JOIN domain_map d USING ({_KEYS}, cluster_id)""",
)
def _(v):
    cycles = v.clustered.groupBy("tech_center", "model_version", "model_hash").agg(
        F.max("sys_created_on").alias("_t")
    ).select(
        "tech_center", "model_version", "model_hash", F.lit("SUCCESS").alias("training_status"),
        F.when(F.col("model_version") == "2024_q4", F.lit("2024-12-31")).otherwise(F.lit("2024-06-30")).cast("timestamp")
        .alias("training_completed_date"),
    )
    results = lookups.label_points(v.clustered, v.cluster_info, v.domain_map)
    return _long(lookups.latest_mapping(cycles, results), "cluster_id", "domain_id")


@query(
    "label_overlay",
    f"""SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, CASE WHEN cluster_id % 2 = 0 THEN 'Standard ' || cluster_id
          ELSE primary_label END AS primary_label FROM cluster_info""",
)
def _(v):
    new = v.cluster_info.where("cluster_id % 2 = 0").withColumn("primary_label", F.concat(F.lit("Standard "), "cluster_id"))
    out = lookups.overlay(v.cluster_info, new, ["tech_center", "model_version", "cluster_id"], "primary_label")
    return _long(out.select("tech_center", "model_version", "cluster_id", "primary_label"), "cluster_id")


@query(
    "label_fallback",
    f"""SELECT DISTINCT {_KEYS}, cluster_id::BIGINT AS cluster_id, CASE WHEN cluster_id = -1 THEN 'Noise'
          ELSE coalesce(primary_label, 'Cluster ' || cluster_id) END AS topic,
          CASE WHEN cluster_id = -1 THEN 'Uncategorized data points' ELSE coalesce(description, 'Group of related IT incidents') END
          AS description FROM clustered LEFT JOIN cluster_info USING ({_KEYS}, cluster_id)""",
)
def _(v):
    ids = v.clustered.select("tech_center", "model_version", "cluster_id").distinct()
    labels = v.cluster_info.withColumnRenamed("primary_label", "topic")
    return _long(lookups.fill_missing_labels(ids, labels, ["tech_center", "model_version"]), "cluster_id")


# --- registry --------------------------------------------------------------------------------------------------------


@query(
    "latest_model_per_center",
    """SELECT tech_center, model_version, model_hash, training_completed_date FROM cycles WHERE training_status = 'SUCCESS'
       QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY training_completed_date DESC, model_hash DESC) = 1""",
)
def _(v):
    return gov.latest_per_center(v.cycles).select("tech_center", "model_version", "model_hash", "training_completed_date")


@query(
    "latest_active_model",
    """SELECT tech_center, model_version, model_hash FROM cycles WHERE model_status = 'active'
       QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY training_completed_date DESC, model_hash DESC) = 1""",
)
def _(v):
    return gov.latest_active(v.cycles).select("tech_center", "model_version", "model_hash")


@query(
    "model_or_fallback",
    """WITH latest AS (SELECT tech_center, model_version FROM cycles WHERE training_status = 'RUNNING' AND clusters_count = 7
         QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY training_completed_date DESC, model_hash DESC) = 1)
       SELECT c.tech_center, coalesce(l.model_version, '2024_q4') AS model_version, l.model_version IS NULL AS is_fallback
       FROM (SELECT DISTINCT tech_center FROM cycles) c LEFT JOIN latest l USING (tech_center)""",
)
def _(v):
    some = v.cycles.where("training_status = 'RUNNING' AND clusters_count = 7").withColumn("training_status", F.lit("SUCCESS"))
    return gov.latest_or_fallback(some, v.cycles.select("tech_center").distinct(), "2024_q4")


@query(
    "newest_versions",
    """SELECT training_cycle_id FROM cycles QUALIFY dense_rank() OVER (PARTITION BY tech_center ORDER BY model_version DESC) <= 3""",
)
def _(v):
    return gov.newest_versions(v.cycles).select("training_cycle_id")


_METRICS = """metrics AS (SELECT tech_center, model_version, count(*) AS n_cycles, avg(silhouette_score) AS silhouette_score,
    avg(noise_ratio) AS noise_ratio, avg(clusters_count) AS clusters_count FROM cycles WHERE training_status = 'SUCCESS' GROUP BY ALL)"""


@query(
    "version_history",
    f"""WITH {_METRICS} SELECT tech_center, model_version, n_cycles, round(silhouette_score, 6) AS silhouette_score,
          lag(model_version) OVER w AS previous_version,
          round(silhouette_score - lag(silhouette_score) OVER w, 6) AS silhouette_change FROM metrics
        WINDOW w AS (PARTITION BY tech_center ORDER BY model_version)""",
)
def _(v):
    out = gov.version_history(v.cycles).drop("noise_ratio", "clusters_count")
    return _rounded(out, "silhouette_score", "silhouette_change")


@query(
    "quality_drift",
    f"""WITH {_METRICS} SELECT tech_center, model_version,
          coalesce(silhouette_score - lag(silhouette_score) OVER w < -0.05, false) AS drifted FROM metrics
        WINDOW w AS (PARTITION BY tech_center ORDER BY model_version)""",
)
def _(v):
    return gov.quality_drift(v.cycles).select("tech_center", "model_version", "drifted")


@query(
    "parameter_correlation",
    """SELECT tech_center, round(corr(clusters_count, silhouette_score), 6) AS clusters_vs_silhouette,
          round(corr(noise_ratio, silhouette_score), 6) AS noise_vs_silhouette FROM cycles
       WHERE training_status = 'SUCCESS' GROUP BY 1""",
)
def _(v):
    return _rounded(gov.parameter_correlation(v.cycles), "clusters_vs_silhouette", "noise_vs_silhouette")


@query(
    "best_version",
    f"""WITH {_METRICS} SELECT tech_center, model_version, round(silhouette_score, 6) AS silhouette_score FROM metrics
        QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY silhouette_score DESC, model_version DESC) = 1""",
)
def _(v):
    return _rounded(gov.best_version(v.cycles).select("tech_center", "model_version", "silhouette_score"), "silhouette_score")


@query("active_versions", "SELECT DISTINCT tech_center, model_version FROM cycles WHERE model_status = 'active'")
def _(v):
    return gov.version_exists(v.cycles)


@query(
    "archive_old_models",
    """SELECT training_cycle_id, CASE WHEN model_status = 'active' AND
          training_completed_date < TIMESTAMP '2001-08-01' - INTERVAL 730 DAY THEN 'archived' ELSE model_status END AS model_status FROM cycles""",
)
def _(v):
    return gov.archive_old(v.cycles, "2001-08-01").select("training_cycle_id", "model_status")


_ARTEFACTS = """artefacts AS (SELECT tech_center, model_version, model_hash, training_completed_date AS last_modified,
    'models/' || training_cycle_id AS path FROM cycles)"""


def _artefacts(v):
    return v.cycles.select(
        "tech_center", "model_version", "model_hash", F.col("training_completed_date").alias("last_modified"),
        F.concat(F.lit("models/"), "training_cycle_id").alias("path"),
    )


@query(
    "list_artefacts",
    f"WITH {_ARTEFACTS} SELECT path, last_modified FROM artefacts WHERE tech_center = 'BT-TC-3' ORDER BY last_modified DESC, path",
)
def _(v):
    return gov.list_artefacts(_artefacts(v), "BT-TC-3").select("path", "last_modified")


@query(
    "newest_artefact",
    f"""WITH {_ARTEFACTS} SELECT tech_center, model_version, path, last_modified FROM artefacts
        QUALIFY row_number() OVER (PARTITION BY tech_center, model_version ORDER BY last_modified DESC, path DESC) = 1""",
)
def _(v):
    return gov.newest_artefact(_artefacts(v))


@query(
    "expire_artefacts",
    f"WITH {_ARTEFACTS} SELECT path FROM artefacts WHERE last_modified >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY",
)
def _(v):
    return gov.keep_unexpired(_artefacts(v), "2001-08-01").select("path")


@query(
    "delete_version",
    f"""WITH {_ARTEFACTS} SELECT path FROM artefacts WHERE NOT (tech_center = 'BT-TC-2' AND model_version = '1996_q2'
        AND model_hash = substr(md5('1'), 1, 8))""",
)
def _(v):
    return gov.delete_version(_artefacts(v), "1996_q2", "BT-TC-2", "c4ca4238").select("path")


@query(
    "promote_models",
    """WITH pick AS (SELECT tech_center, training_cycle_id AS pick FROM cycles WHERE stage = 'staging' AND silhouette_score >= 0.15
         QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY training_completed_date DESC, training_cycle_id DESC) = 1)
       SELECT training_cycle_id, CASE WHEN training_cycle_id = pick THEN 'production'
         WHEN pick IS NOT NULL AND stage = 'production' THEN 'archived' ELSE stage END AS new_stage
       FROM cycles LEFT JOIN pick USING (tech_center)""",
)
def _(v):
    return gov.promote(v.cycles).select("training_cycle_id", "new_stage")


@query(
    "model_dashboard",
    """WITH best AS (SELECT tech_center, stage, model_version, silhouette_score FROM cycles WHERE training_status = 'SUCCESS'
         AND stage <> 'archived' QUALIFY row_number() OVER (PARTITION BY tech_center, stage
         ORDER BY training_completed_date DESC, model_hash DESC) = 1)
       SELECT tech_center, max(model_version) FILTER (stage = 'production') AS production_model_version,
         round(max(silhouette_score) FILTER (stage = 'production'), 6) AS production_silhouette_score,
         max(model_version) FILTER (stage = 'staging') AS staging_model_version,
         round(max(silhouette_score) FILTER (stage = 'staging'), 6) AS staging_silhouette_score FROM best GROUP BY 1""",
)
def _(v):
    out = gov.model_dashboard(v.cycles).drop("production_clusters_count", "staging_clusters_count")
    return _rounded(out, "production_silhouette_score", "staging_silhouette_score")


@query(
    "watermarks",
    "SELECT tech_center, max(sys_created_on) AS last_processed_timestamp FROM center_incidents GROUP BY 1",
)
def _(v):
    return gov.watermark_of(v.center_incidents, keys=("tech_center",))


@query(
    "newest_incident",
    "SELECT max_by(number, sys_created_on) AS newest_incident_id, max(sys_created_on) AS newest_incident_timestamp FROM incidents",
)
def _(v):
    return gov.newest_row(v.incidents)


@query(
    "watermark_upsert",
    """WITH target AS (SELECT 'prediction' AS pipeline_name, tech_center, max(training_completed_date) AS t FROM cycles
         WHERE model_status = 'archived' GROUP BY 2),
       changes AS (SELECT 'prediction' AS pipeline_name, tech_center, max(training_completed_date) AS t FROM cycles
         WHERE tech_center IN ('BT-TC-1', 'BT-TC-2') GROUP BY 2 UNION ALL SELECT 'training_pipeline', tech_center,
         max(training_completed_date) FROM cycles GROUP BY 2)
       SELECT pipeline_name, tech_center, t AS last_processed_timestamp FROM changes UNION ALL
       SELECT t.pipeline_name, t.tech_center, t.t FROM target t ANTI JOIN changes c USING (pipeline_name, tech_center)""",
)
def _(v):
    def marks(rows, name):
        return gov.watermark_of(rows, "training_completed_date", ("tech_center",)).withColumn("pipeline_name", F.lit(name))

    target = marks(v.cycles.where("model_status = 'archived'"), "prediction")
    changes = marks(v.cycles.where("tech_center IN ('BT-TC-1', 'BT-TC-2')"), "prediction").unionByName(
        marks(v.cycles, "training_pipeline")
    )
    return gov.update_watermarks(target, changes)


@query(
    "latest_run",
    """SELECT run_id, time_trigger, CASE WHEN run_id % 4 = 3 THEN NULL ELSE date_trunc('second', time_trigger) END AS end_time
       FROM runs ORDER BY time_trigger DESC, run_id DESC LIMIT 1""",
)
def _(v):
    return gov.latest_run(v.runs).select("run_id", "time_trigger", "end_time")


@query(
    "run_records",
    """SELECT run_id, '{"start_date":"' || strftime(time_trigger - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '","end_date":"' ||
         strftime(time_trigger, '%Y-%m-%dT%H:%M:%S.%f') || '","rows_processed":' || preprocessed_rows || ',"newest_incident_id":"INC' ||
         run_id || '","newest_incident_timestamp":"' || strftime(time_trigger, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS details FROM runs""",
)
def _(v):
    t = F.col("time_trigger")
    rec = gov.run_record(
        F.col("preprocessed_rows"), t - F.expr("interval 1 hour"), t, F.concat(F.lit("INC"), "run_id"), t
    )
    return v.runs.select("run_id", rec.alias("details"))


@query(
    "prediction_watermarks",
    """SELECT tech_center, TIMESTAMP '2024-03-01' AS prediction_timestamp, max(prediction_timestamp) AS last_processed_incident_time,
         count(*) AS processed_incident_count FROM predictions GROUP BY 1""",
)
def _(v):
    return gov.prediction_watermarks(v.predictions.withColumnRenamed("prediction_timestamp", "t"), "2024-03-01", "t")


@query(
    "prediction_status",
    """SELECT coalesce(tech_center, 'all') AS tech_center, grouping(tech_center)::BIGINT AS is_total, count(*) AS total_predictions,
         count(*) FILTER (failed) AS failed_predictions, count(*) FILTER (predicted_cluster_id = -1) AS outliers,
         round(avg(confidence_score), 6) AS avg_confidence, max(prediction_timestamp) AS last_prediction,
         max(prediction_timestamp) >= TIMESTAMP '2001-12-01' - INTERVAL 30 DAY AS active
       FROM predictions GROUP BY ROLLUP (tech_center)""",
)
def _(v):
    return _long(_rounded(gov.prediction_status(v.predictions, "2001-12-01"), "avg_confidence"), "is_total")


@query(
    "alerts",
    """WITH c AS (SELECT tech_center, count(*) FILTER (training_status = 'FAILED') AS f, count(*) FILTER (silhouette_score < 0.15) AS q
         FROM cycles GROUP BY 1), s AS (SELECT tech_center, count(*) FILTER (failed) / count(*) AS e FROM predictions GROUP BY 1)
       SELECT tech_center, 'training_failure' AS alert FROM c WHERE f > 0 UNION ALL
       SELECT tech_center, 'low_quality' FROM c WHERE q > 0 UNION ALL SELECT tech_center, 'prediction_errors' FROM s WHERE e > 0.05""",
)
def _(v):
    return gov.alerts(gov.prediction_status(v.predictions, "2001-12-01"), v.cycles)


@query(
    "confidence_histogram",
    """SELECT model_table_used, least(floor(confidence_score * 10)::BIGINT, 9) AS bin, count(*) AS n FROM predictions GROUP BY ALL""",
)
def _(v):
    return _long(gov.confidence_histogram(v.predictions), "bin")


@query(
    "model_usage",
    """SELECT model_table_used, count(*) AS predictions, count(DISTINCT tech_center) AS centers,
         round(avg(confidence_score), 6) AS avg_confidence, count(*) FILTER (confidence_score < 0.3) AS low_confidence
       FROM predictions GROUP BY 1""",
)
def _(v):
    return _rounded(gov.usage_metrics(v.predictions), "avg_confidence")


@query(
    "run_metrics",
    """SELECT stage, count(*) AS runs, sum(preprocessed_rows)::BIGINT AS rows, round(sum(seconds), 4) AS seconds,
         round(sum(seconds) / sum(preprocessed_rows), 6) AS seconds_per_row, round(sum(preprocessed_rows) / sum(seconds), 6) AS rows_per_second
       FROM runs GROUP BY 1""",
)
def _(v):
    return _rounded(_rounded(gov.run_metrics(v.runs), "seconds_per_row", "rows_per_second"), "seconds", digits=4)


@query(
    "prediction_distribution",
    "SELECT tech_center, predicted_cluster_id, count(*) AS n FROM predictions GROUP BY ALL",
)
def _(v):
    return gov.cluster_distribution(v.predictions)


@query(
    "prediction_records",
    """SELECT incident_id, CASE WHEN failed THEN -1 ELSE predicted_cluster_id END AS predicted_cluster_id,
         CASE WHEN failed THEN 'Prediction_Failed' ELSE 'Cluster_' || predicted_cluster_id END AS predicted_cluster_label,
         CASE WHEN failed THEN 0.0 ELSE confidence_score END AS confidence_score, failed OR predicted_cluster_id = -1 AS is_outlier,
         CASE WHEN failed THEN 'failed' ELSE 'ok' END AS status, model_table_used FROM predictions""",
)
def _(v):
    from ticketloom.plans.predict import with_failure_records

    rows = v.predictions.withColumn("predicted_cluster_label", F.concat(F.lit("Cluster_"), "predicted_cluster_id"))
    return with_failure_records(rows, F.col("failed")).select(
        "incident_id", "predicted_cluster_id", "predicted_cluster_label", "confidence_score", "is_outlier", "status",
        "model_table_used",
    )


@query(
    "engine_status",
    """SELECT c.tech_center, c.model_version, c.silhouette_score, p.last_prediction, coalesce(p.n_predictions, 0) AS n_predictions
       FROM (SELECT tech_center, model_version, round(silhouette_score, 6) AS silhouette_score FROM cycles WHERE training_status = 'SUCCESS'
         QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY training_completed_date DESC, model_hash DESC) = 1) c
       LEFT JOIN (SELECT tech_center, max(prediction_timestamp) AS last_prediction, count(*) AS n_predictions FROM predictions
                  WHERE tech_center <> 'BT-TC-0' GROUP BY 1) p
       USING (tech_center)""",
)
def _(v):
    from ticketloom.plans.analyse import engine_status

    return _rounded(engine_status(v.cycles, v.predictions.where("tech_center <> 'BT-TC-0'")), "silhouette_score")


@query(
    "pipeline_status",
    """WITH m AS (SELECT count(*) AS current_models, max(training_completed_date) AS last_training FROM (
           SELECT tech_center, training_completed_date FROM cycles WHERE training_status = 'SUCCESS'
           QUALIFY row_number() OVER (PARTITION BY tech_center ORDER BY training_completed_date DESC, model_hash DESC) = 1)),
         p AS (SELECT count(*) AS predictions, max(prediction_timestamp) AS last_prediction FROM predictions),
         t AS (SELECT count(DISTINCT TechCenter) AS tech_centers_count FROM team_services)
       SELECT 6::BIGINT AS training_frequency_months, 24::BIGINT AS training_window_months, 120::BIGINT AS prediction_frequency_minutes,
         tech_centers_count, current_models, last_training, (last_training + INTERVAL 6 MONTH)::DATE::TIMESTAMP AS next_training, predictions,
         last_prediction FROM m, p, t""",
)
def _(v):
    from ticketloom.plans.analyse import pipeline_status

    centers = v.team_services.withColumnRenamed("TechCenter", "tech_center")
    out = pipeline_status(v.cycles, v.predictions, centers, "2025-01-01").drop("last_updated")
    return _long(out, "training_frequency_months", "training_window_months", "prediction_frequency_minutes")


@query(
    "result_projection",
    """SELECT i.number, i.sys_created_on, t.TeamDepartment AS team_department, i.short_description, i.business_service, i.description
       FROM incidents i JOIN team_services t ON i.business_service = t.business_service""",
)
def _(v):
    from ticketloom.sources.sinks import result_columns

    wide = lookups.with_team(v.incidents, v.team_services).withColumn("scratch", F.lit(1))
    return result_columns(wide).select(
        "number", "sys_created_on", F.col("TeamDepartment").alias("team_department"), "short_description",
        "business_service", "description",
    )


@query(
    "conformed_rows",
    """SELECT number, sys_created_on, short_description AS combined_incidents_summary, 0::BIGINT AS embedding_size,
         NULL::VARCHAR AS tech_center FROM incidents""",
)
def _(v):
    from ticketloom import schemas

    rows = v.incidents.select("number", "sys_created_on", F.col("short_description").alias("combined_incidents_summary"))
    return schemas.conform(rows, schemas.PREPROCESSED_INCIDENTS).select(
        "number", "sys_created_on", "combined_incidents_summary", F.size("embedding").cast("long").alias("embedding_size"),
        "tech_center",
    )


@query(
    "predictions_without_vectors",
    "SELECT number AS incident_id, tech_center, cluster_id::BIGINT AS predicted_cluster_id FROM clustered",
)
def _(v):
    from ticketloom.sources.sinks import without_vectors

    rows = v.clustered.select(
        F.col("number").alias("incident_id"), "tech_center", F.col("cluster_id").cast("long").alias("predicted_cluster_id"),
        "embedding",
    )
    return without_vectors(rows)
