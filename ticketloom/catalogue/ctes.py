"""The sample views once more, in SQL, for the comparison run."""

from ticketloom.sources.sample_views import CENTERS, FAILURE_MESSAGES

_MESSAGES = "[" + ", ".join("'" + m + "'" for m in FAILURE_MESSAGES) + "]"

CTES = {
    "incidents": """
        SELECT 'INC' || lpad(CAST(doc_id AS VARCHAR), greatest(7, length(CAST(doc_id AS VARCHAR)))::INT, '0') AS number,
               TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 HOUR AS sys_created_on,
               text AS description, substr(text, 1, 80) AS short_description,
               CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN source || ' - PROD' ELSE source END
                 AS business_service
        FROM documents""",
    "team_services": """
        SELECT source AS business_service, 'BT-TC-' || r_name AS TechCenter,
               'Department ' || CAST(n % 4 AS VARCHAR) AS TeamDepartment, 'Area ' || CAST(n % 3 AS VARCHAR) AS Area,
               'Unit ' || CAST(n AS VARCHAR) AS Unit
        FROM (SELECT DISTINCT source, CAST(substr(source, 4) AS BIGINT) AS n FROM documents WHERE source <> 'src19') s
        JOIN region ON n % 5 = r_regionkey""",
    "center_incidents": """
        SELECT i.*, t.TechCenter AS tech_center FROM incidents i
        JOIN team_services t ON i.business_service = t.business_service""",
    "points": """
        SELECT vec_id AS number, 'BT-TC-' || CAST(vec_id % 3 AS VARCHAR) AS tech_center,
               CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings""",
    "clustered": """
        SELECT vec_id AS number, TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 1 HOUR AS sys_created_on,
               'BT-TC-' || CAST(vec_id % 3 AS VARCHAR) AS tech_center,
               CASE WHEN vec_id % 2 = 0 THEN '2024_q2' ELSE '2024_q4' END AS model_version,
               substr(md5('BT-TC-' || CAST(vec_id % 3 AS VARCHAR) || '|' ||
                   CASE WHEN vec_id % 2 = 0 THEN '2024_q2' ELSE '2024_q4' END), 1, 8) AS model_hash,
               CASE WHEN vec_id % 10 = 3 THEN -1 ELSE label END AS cluster_id,
               'Summary of ' || CAST(vec_id AS VARCHAR) AS combined_incidents_summary,
               CAST(embedding AS DOUBLE[]) AS embedding,
               CAST(embedding[1] AS DOUBLE) AS umap_x, CAST(embedding[2] AS DOUBLE) AS umap_y
        FROM embeddings""",
    "cluster_info": """
        SELECT tech_center, model_version, cluster_id, count(*) AS size, 'Topic ' || cluster_id AS primary_label,
               'Incidents of kind ' || cluster_id AS description,
               ['k' || cluster_id, 'w' || cluster_id] AS keywords
        FROM clustered WHERE cluster_id >= 0 AND cluster_id <> 9 GROUP BY ALL""",
    "domain_map": """
        SELECT DISTINCT tech_center, model_version, cluster_id, cluster_id // 3 AS domain_id,
               'Domain ' || CAST(cluster_id // 3 AS VARCHAR) AS domain_name
        FROM clustered WHERE cluster_id >= 0 AND cluster_id <> 8""",
    "cycles": f"""
        SELECT 'cycle-' || CAST(o_orderkey AS VARCHAR) AS training_cycle_id,
               'BT-TC-' || CAST(o_custkey % {CENTERS} AS VARCHAR) AS tech_center,
               CAST(o_orderdate AS TIMESTAMP) AS training_completed_date,
               year(o_orderdate) || '_q' || quarter(o_orderdate) AS model_version,
               substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS model_hash,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'RUNNING' END AS training_status,
               o_orderkey % 50 AS clusters_count, o_orderkey % 997 + 100 AS incidents_count,
               o_totalprice / 1000000 AS silhouette_score, (o_custkey % 60) / 100.0::DOUBLE AS noise_ratio,
               CASE o_orderkey % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'production' ELSE 'archived' END AS stage,
               CASE WHEN o_orderkey % 4 = 0 THEN 'archived' ELSE 'active' END AS model_status
        FROM orders""",
    "predictions": f"""
        SELECT l_orderkey || '-' || l_linenumber AS incident_id,
               'BT-TC-' || CAST(l_suppkey % {CENTERS} AS VARCHAR) AS tech_center,
               CASE WHEN l_linenumber = 7 THEN -1 ELSE l_partkey % 40 END AS predicted_cluster_id,
               CASE WHEN l_linenumber = 7 THEN 0.0::DOUBLE ELSE round(l_quantity / 50, 4) END AS confidence_score,
               l_tax * 40 AS distance, CAST(l_shipdate AS TIMESTAMP) AS prediction_timestamp,
               'results_' || year(l_shipdate) AS model_table_used, l_returnflag = 'R' AS failed
        FROM lineitem""",
    "runs": """
        SELECT event_id AS run_id, ts AS time_trigger, user_id AS preprocessed_rows, event_type AS stage,
               value AS seconds,
               CASE event_id % 4
                 WHEN 0 THEN '{"rows": ' || event_id || ', "end_date": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC"}'
                 WHEN 1 THEN '"{\\"rows\\": ' || event_id || ', \\"end_date\\": \\"' || strftime(ts, '%Y-%m-%d %H:%M:%S')
                             || ' UTC\\"}"'
                 WHEN 2 THEN '{"rows": , "end_date": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"'
                 ELSE props END AS run_details
        FROM events""",
    "failures": f"""
        SELECT 'INC' || CAST(user_id * 100 + event_id % 100 AS VARCHAR) AS number,
               CASE event_type WHEN 'error' THEN 'embedding' ELSE 'summarization' END AS stage,
               ({_MESSAGES})[event_id % {len(FAILURE_MESSAGES)} + 1] AS message,
               'BT-TC-' || CAST(user_id % {CENTERS} AS VARCHAR) AS tech_center
        FROM events WHERE event_type IN ('error', 'view')""",
}
