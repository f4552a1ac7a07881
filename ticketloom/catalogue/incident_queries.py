"""Scans, filters, joins and preparation over incidents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ticketloom.catalogue.registry import query
from ticketloom.catalogue.text_queries import _combined, _deep, _email_free, _leading, _words
from ticketloom.functions import text
from ticketloom.operators import governance, lookups, preparation, scans
from ticketloom.sources.sample_views import incident_number

A, B = "2024-01-10 00:00:00", "2024-01-25 06:00:00"
_COLS = "number, sys_created_on, description, short_description, business_service"


@query(
    "window_scan",
    f"SELECT {_COLS} FROM incidents WHERE sys_created_on BETWEEN TIMESTAMP '{A}' AND TIMESTAMP '{B}' ORDER BY sys_created_on",
)
def _(v):
    return scans.window_scan(v.incidents, A, B).orderBy("sys_created_on")


@query(
    "window_scan_half_open",
    f"SELECT number FROM incidents WHERE sys_created_on >= TIMESTAMP '{A}' AND sys_created_on < TIMESTAMP '{B}'",
)
def _(v):
    return scans.window_scan(v.incidents, A, B, ("number",), closed=False)


@query("ordered_scan", "SELECT number, sys_created_on FROM incidents ORDER BY sys_created_on DESC")
def _(v):
    return v.incidents.select("number", "sys_created_on").orderBy(F.desc("sys_created_on"))


@query(
    "sql_with_parameters",
    """SELECT tech_center, count(*) AS n FROM predictions WHERE prediction_timestamp >= TIMESTAMP '1996-01-01'
       AND confidence_score >= 0.5 GROUP BY tech_center""",
)
def _(v):
    from ticketloom.sources.tables import run_sql

    return run_sql(
        v.spark,
        """SELECT tech_center, count(*) AS n FROM {p}
           WHERE prediction_timestamp >= :since AND confidence_score >= :floor GROUP BY tech_center""",
        args={"since": "1996-01-01", "floor": 0.5},
        p=v.predictions,
    )


@query("projected_read", "SELECT o_orderkey, o_totalprice FROM orders")
def _(v):
    from ticketloom.sources.tables import read_columns

    return read_columns(v.spark, f"{v.folder}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query("year_scan", "SELECT l_orderkey, l_linenumber::BIGINT AS line FROM lineitem WHERE year(l_shipdate) = 1996")
def _(v):
    return scans.year_scan(v.table("lineitem"), 1996, "l_shipdate").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("line")
    )


@query("center_filter", "SELECT number FROM center_incidents WHERE tech_center = 'BT-TC-ASIA'")
def _(v):
    return scans.of_centers(v.center_incidents, ["BT-TC-ASIA"]).select("number")


@query("center_list_filter", "SELECT number FROM center_incidents WHERE tech_center IN ('BT-TC-ASIA', 'BT-TC-EUROPE')")
def _(v):
    return scans.of_centers(v.center_incidents, ["BT-TC-ASIA", "BT-TC-EUROPE"]).select("number")


@query(
    "center_fuzzy_match",
    """WITH tagged AS (SELECT number, CASE WHEN business_service = 'BT-TC-SRC1' THEN 1
           WHEN contains(lower(business_service), lower('SRC1')) THEN 2 END AS rule FROM incidents)
       SELECT number FROM tagged WHERE rule = (SELECT min(rule) FROM tagged)""",
)
def _(v):
    return scans.match_center(v.incidents, "BT-TC-SRC1").select("number")


@query(
    "center_mapping_default",
    """SELECT i.number, coalesce(t.TechCenter, 'BT-TC-General') AS tech_center FROM incidents i
       LEFT JOIN team_services t ON i.business_service = t.business_service""",
)
def _(v):
    mapping = v.team_services.withColumnRenamed("TechCenter", "tech_center")
    return scans.with_center(v.incidents, mapping).select("number", "tech_center")


_MARKS = """marks AS (SELECT tech_center, max(sys_created_on) AS mark FROM center_incidents
    JOIN labels ON number = 'INC' || lpad(CAST(doc_id AS VARCHAR), 7, '0') WHERE doc_id % 2 = 0
      AND tech_center <> 'BT-TC-ASIA' GROUP BY 1)"""


def _marks(v):
    done = v.table("labels").where("doc_id % 2 = 0").select(incident_number(F.col("doc_id")).alias("number"))
    rows = v.center_incidents.join(done, "number", "left_semi").where("tech_center <> 'BT-TC-ASIA'")
    return governance.watermark_of(rows, keys=("tech_center",))


@query(
    "rows_since_watermark",
    f"WITH {_MARKS} SELECT number FROM center_incidents i JOIN marks m USING (tech_center) WHERE sys_created_on > mark",
)
def _(v):
    return scans.since_watermark(v.center_incidents, _marks(v)).select("number")


@query(
    "rows_since_newest_watermark",
    """WITH marks AS (SELECT tech_center, date_trunc('week', sys_created_on) AS mark, doc % 2 AS pipeline
         FROM (SELECT *, CAST(substr(number, 4) AS BIGINT) AS doc FROM center_incidents) WHERE doc % 3 = 0),
       newest AS (SELECT tech_center, max(mark) AS mark FROM marks WHERE pipeline = 1 GROUP BY tech_center)
       SELECT number, sys_created_on FROM center_incidents i JOIN newest m USING (tech_center) WHERE sys_created_on > mark""",
)
def _(v):
    doc = F.substring("number", 4, 20).cast("long")
    marks = v.center_incidents.where(doc % 3 == 0).select(
        "tech_center", F.date_trunc("week", "sys_created_on").alias("last_processed_timestamp"),
        F.when(doc % 2 == 1, "prediction").otherwise("training").alias("pipeline_name"),
    )
    return scans.since_watermark(v.center_incidents, marks, pipeline="prediction").select("number", "sys_created_on")


@query(
    "consecutive_windows",
    """WITH ends AS (SELECT DISTINCT date_trunc('hour', ts) + (hour(ts) % 7) * INTERVAL 123456 MICROSECOND AS edge FROM events),
       spans AS (SELECT edge AS a, lead(edge) OVER (ORDER BY edge) AS b FROM ends)
       SELECT event_id, a AS window_start FROM events JOIN spans ON ts >= a AND ts < b""",
)
def _(v):
    """Windows that follow each other pick up every row between the first and the last end, once."""
    from ticketloom.functions import dates

    events = v.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    shift = F.make_dt_interval(secs=(F.hour("ts") % 7) * F.lit(0.123456).cast("decimal(18,6)"))
    ends = events.select((F.date_trunc("hour", "ts") + shift).alias("at")).distinct()
    following = ends.select("at", F.lead("at").over(Window.orderBy("at")).alias("end_time")).where("end_time IS NOT NULL")
    spans = following.select(dates.next_start(F.col("at")).alias("start_time"), "end_time")
    inside = (F.col("ts") >= F.col("start_time")) & (F.col("ts") < F.col("end_time"))
    return events.join(spans, inside).select("event_id", F.col("start_time").alias("window_start"))


@query(
    "rows_since_watermark_or_default",
    f"""WITH {_MARKS} SELECT number FROM center_incidents i LEFT JOIN marks m USING (tech_center)
        WHERE sys_created_on > coalesce(mark, TIMESTAMP '{B}' - INTERVAL 2 HOUR)""",
)
def _(v):
    marks = _marks(v).withColumnRenamed("last_processed_timestamp", "prediction_timestamp")
    return scans.since_watermark_or_default(v.center_incidents, marks, B).select("number")


@query(
    "unprocessed_batch",
    """SELECT number FROM center_incidents
        WHERE number NOT IN (SELECT 'INC' || lpad(CAST(doc_id AS VARCHAR), 7, '0') FROM labels)""",
)
def _(v):
    done = v.table("labels").select(incident_number(F.col("doc_id")).alias("number"))
    return scans.not_yet_predicted(v.center_incidents, done, B, key="number").select("number")


@query("vector_present", "SELECT number FROM points WHERE embedding IS NOT NULL AND len(embedding) > 0")
def _(v):
    return scans.with_vectors(v.points).select("number")


@query(
    "vector_validity",
    """SELECT number, CASE number % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'not_finite' WHEN 2 THEN 'not_finite'
              WHEN 3 THEN 'wrong_size' ELSE 'ok' END AS vector_status FROM points""",
)
def _(v):
    k, e = F.col("number") % 5, F.col("embedding")
    spoiled = (
        F.when(k == 0, F.array().cast("array<double>"))
        .when(k == 1, F.transform(e, lambda x, i: F.when(i == 3, float("nan")).otherwise(x)))
        .when(k == 2, F.transform(e, lambda x, i: F.when(i == 5, float("inf")).otherwise(x)))
        .when(k == 3, F.slice(e, 1, 10))
        .otherwise(e)
    )
    return scans.split_by_vector_validity(v.points.withColumn("embedding", spoiled), "embedding", 64).select(
        "number", "vector_status"
    )


@query("without_noise", "SELECT number, cluster_id::BIGINT AS cluster_id FROM clustered WHERE cluster_id <> -1")
def _(v):
    return scans.without_noise(v.clustered).select("number", F.col("cluster_id").cast("long").alias("cluster_id"))


@query(
    "valid_text_filter",
    f"""SELECT doc_id, c AS text
        FROM (SELECT doc_id, {_deep('text')} AS c FROM documents) WHERE length(c) >= 10""",
)
def _(v):
    return preparation.clean_and_filter(v.table("documents"), "text").select("doc_id", "text")


@query(
    "valid_text_filter_fast",
    r"""SELECT doc_id, c AS text FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x{85}\p{Z}]+', ' ', 'g')) AS c
        FROM documents) WHERE length(c) >= 10""",
)
def _(v):
    return preparation.clean_and_filter(v.table("documents"), "text", fast=True).select("doc_id", "text")


@query(
    "embedding_input",
    """SELECT doc_id, CASE WHEN length(t) = 0 THEN 'empty' WHEN length(t) // 4 > 400 THEN 'long' ELSE 'valid' END AS status,
              nullif(t, '') AS prepared FROM (SELECT doc_id, trim(text, E' \\n\\t\\r') AS t FROM documents)""",
)
def _(v):
    return preparation.embedding_input(v.table("documents"), "text", 400).select("doc_id", "status", "prepared")


@query(
    "embedding_input_strict",
    """SELECT doc_id, CASE WHEN length(trim(text)) = 0 THEN 'empty' WHEN length(text) // 4 + 1 > 1000 THEN 'too_long'
              WHEN length(trim(text, E' \\n\\t\\r')) < 10 THEN 'too_short' ELSE 'ok' END AS reason FROM documents""",
)
def _(v):
    return v.table("documents").select(
        "doc_id", F.coalesce(preparation.strict_reason(F.col("text"), 1000), F.lit("ok")).alias("reason")
    )


@query(
    "embedding_chars_filter",
    """SELECT doc_id, t AS text, greatest(ceil(length(t) / 8000), 1)::BIGINT AS n_pieces, t[8001:16000] AS second
       FROM (SELECT doc_id, trim(text, E' \\n\\t\\r') AS t FROM documents) WHERE length(t) > 0""",
)
def _(v):
    cut = preparation.filter_by_chars(v.table("documents"), "text")
    second = F.coalesce(F.get("pieces", F.lit(1)), F.lit(""))
    return cut.select("doc_id", "text", F.size("pieces").cast("long").alias("n_pieces"), second.alias("second"))


@query("rename_columns", "SELECT number AS incident_number, sys_created_on AS created_date FROM incidents")
def _(v):
    preparation.require_columns(v.incidents)
    return v.incidents.select("number", "sys_created_on").withColumnsRenamed(
        {"number": "incident_number", "sys_created_on": "created_date"}
    )


@query(
    "centers_with_enough_rows",
    """SELECT tech_center, count(*) AS n FROM predictions GROUP BY tech_center
       HAVING count(*) >= 5 * (1 + CAST(substr(tech_center, 7) AS BIGINT)) * (SELECT count(*) FROM supplier)""",
)
def _(v):
    base = v.table("supplier").agg(F.count("*").alias("base")).withColumn("_one", F.lit(1))
    centers = v.predictions.select("tech_center").distinct().withColumn("_one", F.lit(1)).join(base, "_one")
    minimum = 5 * (1 + F.substring("tech_center", 7, 10).cast("long")) * F.col("base")
    centers = centers.select("tech_center", minimum.alias("min_incidents"))
    return scans.centers_with_enough_rows(v.predictions, centers).select("tech_center", "n")


@query(
    "incident_contract",
    """SELECT i.number, array_to_string(list_filter([CASE WHEN length(description) < 10 THEN 'description_too_short' END,
         CASE WHEN coalesce(TechCenter, '') NOT IN ('BT-TC-ASIA', 'BT-TC-EUROPE') THEN 'unknown_tech_center' END,
         CASE WHEN length(description) / 1000.0 > 1 THEN 'confidence_out_of_range' END], lambda x: x IS NOT NULL), ',') AS broken
       FROM incidents i LEFT JOIN team_services t ON i.business_service = t.business_service""",
)
def _(v):
    joined = v.incidents.join(v.team_services, "business_service", "left")
    broken = preparation.incident_violations(
        F.col("description"),
        F.col("TechCenter"),
        ["BT-TC-ASIA", "BT-TC-EUROPE"],
        F.length("description") / 1000.0,
    )
    return joined.select("number", F.array_join(broken, ",").alias("broken"))


@query(
    "cumulative_training_scan",
    f"""SELECT {_COLS} FROM incidents WHERE sys_created_on BETWEEN TIMESTAMP '2024-03-31' - INTERVAL 60 DAY
        AND TIMESTAMP '2024-03-31'""",
)
def _(v):
    return scans.cumulative_training_scan(v.incidents, 2024, 1, months=2)


# --- joins -----------------------------------------------------------------------------------------------------------


@query(
    "team_join",
    """SELECT number, TechCenter AS center, TeamDepartment AS department, Area AS area, Unit AS unit FROM incidents i
       JOIN team_services t ON i.business_service = t.business_service""",
)
def _(v):
    return lookups.with_team(v.incidents, v.team_services).select(
        "number",
        F.col("TechCenter").alias("center"),
        F.col("TeamDepartment").alias("department"),
        F.col("Area").alias("area"),
        F.col("Unit").alias("unit"),
    )


@query(
    "training_window_join",
    f"""SELECT i.number, t.TechCenter AS tech_center, i.sys_created_on, i.short_description AS combined_incidents_summary,
               len(p.embedding)::BIGINT AS dims
        FROM incidents i JOIN embeddings p ON i.number = 'INC' || lpad(CAST(p.vec_id AS VARCHAR), 7, '0')
        JOIN team_services t ON i.business_service = t.business_service
        WHERE i.sys_created_on BETWEEN TIMESTAMP '{A}' AND TIMESTAMP '{B}'""",
)
def _(v):
    vecs = v.table("embeddings").select(incident_number(F.col("vec_id")).alias("number"), "embedding")
    rows = v.incidents.join(vecs, "number").withColumnRenamed("short_description", "combined_incidents_summary")
    return lookups.training_window(rows, v.team_services, A, B).withColumn(
        "dims", F.size("embedding").cast("long")
    ).drop("embedding")


@query(
    "unlabelled_incidents",
    """SELECT number FROM incidents LEFT JOIN labels ON number = 'INC' || lpad(CAST(doc_id AS VARCHAR), 7, '0')
       WHERE doc_id IS NULL""",
)
def _(v):
    done = v.table("labels").select(incident_number(F.col("doc_id")).alias("number"))
    return lookups.unmatched(v.incidents, done, "number").select("number")


@query(
    "reassociate_vectors",
    f"""SELECT i.number, len(e.embedding)::BIGINT AS dims, {_leading('description')} AS summary
        FROM incidents i JOIN embeddings e ON i.number = 'INC' || lpad(CAST(e.vec_id AS VARCHAR), 7, '0')""",
)
def _(v):
    vecs = v.table("embeddings").select(incident_number(F.col("vec_id")).alias("number"), "embedding")
    return v.incidents.join(vecs, "number").select(
        "number",
        F.size("embedding").cast("long").alias("dims"),
        text.leading_words(F.col("description")).alias("summary"),
    )


@query(
    "services_top_ten",
    """SELECT business_service, count(*) AS n FROM incidents WHERE business_service IS NOT NULL
       GROUP BY 1 ORDER BY n DESC, business_service LIMIT 10""",
)
def _(v):
    return (
        v.incidents.where("business_service IS NOT NULL")
        .groupBy("business_service")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "business_service")
        .limit(10)
    )


@query("distinct_services", "SELECT DISTINCT business_service FROM incidents WHERE business_service IS NOT NULL")
def _(v):
    return v.incidents.where("business_service IS NOT NULL").select("business_service").distinct()


@query(
    "concat_parts",
    """SELECT doc_id AS id, text, lang FROM documents UNION ALL SELECT conv_id AS id, text, NULL AS lang FROM conversations""",
)
def _(v):
    return lookups.concat_parts(
        v.table("documents").select(F.col("doc_id").alias("id"), "text", "lang"),
        v.table("conversations").select(F.col("conv_id").alias("id"), "text"),
    )


# --- preparation statistics ------------------------------------------------------------------------------------------


@query(
    "preparation_statistics",
    f"""SELECT count(*) AS total_incidents, count(*) FILTER (length(c) >= 10) AS processed_incidents,
               count(*) - count(*) FILTER (length(c) >= 10) AS failed_incidents,
               round(count(*) FILTER (length(c) >= 10) / count(*) * 100, 6) AS success_rate
        FROM (SELECT {_deep('text')} AS c FROM documents)""",
)
def _(v):
    return preparation.preparation_statistics(v.table("documents"), "text").withColumn(
        "success_rate", F.round("success_rate", 6)
    )


@query(
    "embedding_report",
    """SELECT lang, count(*) AS total_processed, count(*) FILTER (length(t) = 0) AS empty_texts,
              count(*) FILTER (length(t) // 4 > 400) AS too_long_texts, count(*) FILTER (length(t) > 0) AS valid_texts,
              round(count(*) FILTER (length(t) > 0) / count(*) * 100, 6) AS success_rate
       FROM (SELECT lang, trim(text, E' \\n\\t\\r') AS t FROM documents) GROUP BY lang""",
)
def _(v):
    staged = preparation.embedding_input(v.table("documents"), "text", 400)
    return preparation.embedding_report(staged, ["lang"]).withColumn("success_rate", F.round("success_rate", 6))


@query(
    "summary_statistics",
    f"""SELECT count(*) AS total_incidents, count(*) FILTER (s) AS short_text, 0::BIGINT AS provider_failures,
               0::BIGINT AS final_sweep, count(*) FILTER (NOT s) AS attempted, count(*) FILTER (s) AS total_fallbacks,
               count(*) FILTER (NOT s) AS succeeded, 100.0::DOUBLE AS success_rate,
               round(count(*) FILTER (NOT s) / count(*) * 100, 6) AS overall_rate
        FROM (SELECT length({_email_free('description')}) < 300 AS s FROM incidents)""",
)
def _(v):
    return preparation.summary_statistics(preparation.route_summaries(v.incidents)).withColumn(
        "overall_rate", F.round("overall_rate", 6)
    )


@query(
    "summary_length_check",
    f"""SELECT source, count(*) AS n, count(*) FILTER (len(list_distinct({_words('text')})) >= 30) AS full_length,
               sum(least(len(list_distinct({_words('text')})), 30))::BIGINT AS words FROM documents GROUP BY source""",
)
def _(v):
    words = text.word_count(text.leading_words(F.col("text")))
    return (
        v.table("documents")
        .groupBy("source")
        .agg(
            F.count("*").alias("n"),
            F.count_if(words == text.SUMMARY_WORDS).alias("full_length"),
            F.sum(words).alias("words"),
        )
    )


@query(
    "prediction_light_path",
    r"""SELECT number, trim(regexp_replace(description, '[\s\x0b\x{85}\p{Z}]+', ' ', 'g')) AS processed_text FROM incidents
        WHERE length(trim(regexp_replace(description, '[\s\x0b\x{85}\p{Z}]+', ' ', 'g'))) >= 10""",
)
def _(v):
    return preparation.clean_and_filter(
        v.incidents.select("number", F.col("description").alias("processed_text")), "processed_text", fast=True
    )


@query(
    "preprocess_texts",
    f"""SELECT i.number, i.sys_created_on, CASE WHEN length(c) < 100 THEN c
               ELSE {_leading('c')} END AS combined_incidents_summary, i.business_service, t.TechCenter AS tech_center
        FROM (SELECT number, {_deep('(' + _combined() + ')')} AS c FROM incidents) x
        JOIN incidents i USING (number) LEFT JOIN team_services t ON i.business_service = t.business_service
        WHERE length(c) >= 10""",
)
def _(v):
    from ticketloom.plans.preprocess import prepare_texts

    services = v.team_services.select("business_service", F.col("TechCenter").alias("tech_center"))
    return prepare_texts(v.incidents.join(services, "business_service", "left")).select(
        "number", "sys_created_on", "combined_incidents_summary", "business_service", "tech_center"
    )


# --- failures --------------------------------------------------------------------------------------------------------

from ticketloom.catalogue.text_queries import _CLASSIFY  # noqa: E402


@query(
    "failure_breakdown",
    f"""SELECT stage, {_CLASSIFY} AS error_class, count(*) AS failures, count(DISTINCT number) AS incidents
        FROM failures GROUP BY ALL""",
)
def _(v):
    return governance.failure_breakdown(v.failures)


@query(
    "failed_incidents",
    "SELECT number, array_to_string(list_sort(list_distinct(list(stage))), ',') AS stages FROM failures GROUP BY number",
)
def _(v):
    return governance.failed_incidents(v.failures).select("number", F.array_join("stages", ",").alias("stages"))


@query(
    "lost_per_stage",
    """SELECT DISTINCT number, stage FROM failures""",
)
def _(v):
    lost = [v.failures.where(F.col("stage") == s).select("number", "stage") for s in ("summarization", "embedding")]
    return lost[0].union(lost[1]).distinct()


@query(
    "center_failure_share",
    """SELECT tech_center, count(*) AS failures, round(count(*) * 100.0 / (SELECT count(*) FROM failures), 6) AS percentage
       FROM failures GROUP BY tech_center""",
)
def _(v):
    return governance.center_failure_share(v.failures).withColumn("percentage", F.round("percentage", 6))


@query(
    "stage_rollup",
    """SELECT (SELECT count(*) FROM events) AS total_incidents,
              count(DISTINCT number) FILTER (stage = 'summarization') AS summarization_failures,
              count(DISTINCT number) FILTER (stage = 'embedding') AS embedding_failures, count(DISTINCT number) AS total_failed,
              greatest((SELECT count(*) FROM events) - count(DISTINCT number), 0) AS ready,
              round(greatest((SELECT count(*) FROM events) - count(DISTINCT number), 0) * 100.0 / (SELECT count(*) FROM events), 6)
                AS overall_success_rate FROM failures""",
)
def _(v):
    return governance.stage_rollup(v.table("events"), v.failures).withColumn(
        "overall_success_rate", F.round("overall_success_rate", 6)
    )


@query(
    "hourly_counts",
    """SELECT date_trunc('hour', ts) AS window_start, event_type AS service, count(*) AS n FROM events GROUP BY ALL""",
)
def _(v):
    from ticketloom.streaming.incremental import hourly_counts

    rows = v.table("events").select(F.col("ts").cast("timestamp").alias("sys_created_on"), F.col("event_type").alias("service"))
    return hourly_counts(rows, "service")


@query(
    "late_rows",
    f"""SELECT number FROM incidents WHERE sys_created_on <= TIMESTAMP '{B}'
        AND number NOT IN (SELECT 'INC' || lpad(CAST(doc_id AS VARCHAR), 7, '0') FROM labels)""",
)
def _(v):
    done = v.table("labels").select(incident_number(F.col("doc_id")).alias("number"))
    return scans.late_rows(v.incidents, done, B).select("number")


@query(
    "boundary_gap_rows",
    """SELECT event_id FROM events WHERE ts - date_trunc('hour', ts) > INTERVAL 0 SECOND
       AND ts - date_trunc('hour', ts) < INTERVAL 1 SECOND""",
)
def _(v):
    from ticketloom.streaming.incremental import boundary_gap

    return boundary_gap(v.table("events").withColumn("ts", F.col("ts").cast("timestamp")), "ts").select("event_id")


@query(
    "append_without_duplicates",
    """SELECT number FROM incidents WHERE number NOT IN (SELECT 'INC' || lpad(CAST(doc_id AS VARCHAR), 7, '0') FROM labels)""",
)
def _(v):
    from ticketloom.streaming.incremental import new_rows_only

    done = v.table("labels").select(incident_number(F.col("doc_id")).alias("number"))
    twice = v.incidents.unionByName(v.incidents)
    return new_rows_only(twice, done).select("number")


@query(
    "back_fill_scan",
    f"SELECT number FROM incidents WHERE sys_created_on >= TIMESTAMP '2024-01-05' AND sys_created_on < TIMESTAMP '2024-01-08'",
)
def _(v):
    from ticketloom.functions import dates

    none = F.lit(None).cast("timestamp")
    w = dates.back_fill_window("2024-01-05", "2024-01-07", none, F.lit("2024-02-01").cast("timestamp"))
    return scans.window_scan(v.incidents, w["start_time"], w["end_time"], ("number",), closed=False)
