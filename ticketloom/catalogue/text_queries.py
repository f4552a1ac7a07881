"""Text, date and JSON functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.catalogue.registry import query
from ticketloom.functions import dates, json_repair, scoring, text

# SQL spellings of the cleaning steps, composed below.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _deep(c: str) -> str:
    s = rf"regexp_replace({c}, 'https?://[!$-_a-z]+', '', 'g')"
    s = rf"regexp_replace({s}, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}\b', '', 'g')"
    s = rf"regexp_replace({s}, '{_WS}+', ' ', 'g')"
    s = rf"regexp_replace({s}, '[^\p{{L}}\p{{N}}_ .,!?;:-]', ' ', 'g')"
    return rf"trim(regexp_replace({s}, '[.!?]{{3,}}', '...', 'g'))"


def _summary(c: str) -> str:
    s = rf"regexp_replace(regexp_replace({c}, '[\n\r\t]+', ' ', 'g'), '{_WS}+', ' ', 'g')"
    return rf"trim(regexp_replace(coalesce({s}, ''), '\p{{C}}', '', 'g'))"


def _service(c: str) -> str:
    s = rf"regexp_replace(trim({c}), '\s*-\s*(PROD|TEST|DEV)(\s|$)', ' ', 'g')"
    for w in ("PROD", "TEST", "DEV"):
        s = rf"regexp_replace({s}, '\s+{w}$', ' ')"
    return rf"coalesce(trim(regexp_replace(regexp_replace({s}, '[-_+]', '', 'g'), '\s+', ' ', 'g')), '')"


def _normal(c: str) -> str:
    s = rf"regexp_replace({c}, '\s*[-_]\s*(PROD|DEV|TEST|UAT|QA)$', '')"
    return rf"coalesce(trim(regexp_replace(regexp_replace({s}, '[-_]+', ' ', 'g'), '\s+', ' ', 'g')), '')"


def _combined() -> str:
    parts = f"[{_deep('description')}, {_deep('short_description')}, {_service('business_service')}]"
    kept = f"list_filter({parts}, lambda x: x IS NOT NULL AND length(trim(x)) > 0)"
    return f"CASE WHEN len({kept}) > 0 THEN array_to_string({kept}, ' | ') ELSE 'No description available' END"


def _words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{_WS}+'), lambda w: w <> '')"


def _leading(c: str) -> str:
    """The thirty most frequent words, the earlier first; every word is grouped once."""
    return (
        f"CASE WHEN {c} IS NOT NULL THEN coalesce((SELECT string_agg(x.w, ' ' ORDER BY x.n DESC, x.p) FROM (SELECT u.w, count(*) AS n, "
        f"min(u.i) AS p FROM (SELECT unnest(l.ws) AS w, generate_subscripts(l.ws, 1) AS i FROM (SELECT {_words(c)} AS ws) l) u "
        "GROUP BY u.w ORDER BY n DESC, p LIMIT 30) x), '') END"
    )


@query("text_deep_clean", f"SELECT doc_id, {_deep('text')} AS cleaned FROM documents")
def _(v):
    return v.table("documents").select("doc_id", text.deep_clean(F.col("text")).alias("cleaned"))


@query("text_deep_clean_pages", f"SELECT page_id, {_deep('html')} AS cleaned FROM pages")
def _(v):
    return v.table("pages").select("page_id", text.deep_clean(F.col("html")).alias("cleaned"))


@query("text_fast_clean", rf"SELECT doc_id, trim(regexp_replace(text, '{_WS}+', ' ', 'g')) AS cleaned FROM documents")
def _(v):
    return v.table("documents").select("doc_id", text.fast_clean(F.col("text")).alias("cleaned"))


@query("text_summary_clean", f"SELECT doc_id, {_summary('text')} AS cleaned FROM documents")
def _(v):
    return v.table("documents").select("doc_id", text.summary_clean(F.col("text")).alias("cleaned"))


@query("service_clean", f"SELECT number, {_service('business_service')} AS service FROM incidents")
def _(v):
    return v.incidents.select("number", text.clean_service(F.col("business_service")).alias("service"))


@query("service_normalize", f"SELECT number, {_normal('business_service')} AS service FROM incidents")
def _(v):
    return v.incidents.select("number", text.normalize_service(F.col("business_service")).alias("service"))


@query("combine_columns", f"SELECT number, {_combined()} AS combined FROM incidents")
def _(v):
    return v.incidents.select(
        "number",
        text.combine_incident(F.col("description"), F.col("short_description"), F.col("business_service")).alias(
            "combined"
        ),
    )


@query("safe_text", "SELECT number, coalesce(business_service, '') AS service FROM incidents")
def _(v):
    return v.incidents.select("number", text.safe_text(F.col("business_service")).alias("service"))


@query(
    "estimate_tokens",
    """SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE length(text) // 4 + 1 END::BIGINT AS tokens,
              coalesce(length(text), 0)::BIGINT // 4 AS tokens_plain FROM documents""",
)
def _(v):
    return v.table("documents").select(
        "doc_id",
        text.estimate_tokens(F.col("text")).alias("tokens"),
        text.estimate_tokens_plain(F.col("text")).alias("tokens_plain"),
    )


def _email_free(c: str) -> str:
    return rf"regexp_replace({_summary(c)}, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}', '', 'g')"


@query(
    "short_text_rule",
    f"""SELECT number, CASE WHEN length({_email_free('description')}) < 300 THEN 'short_text' ELSE 'summarize' END AS summary_source,
        CASE WHEN length({_email_free('description')}) < 300
             THEN trim({_summary('short_description')} || ' - ' || {_normal('business_service')}) END AS summary,
        CASE WHEN length({_email_free('description')}) >= 300
             THEN {_email_free('description')} END AS summary_input FROM incidents""",
)
def _(v):
    from ticketloom.operators import preparation

    return preparation.route_summaries(v.incidents).select("number", "summary_source", "summary", "summary_input")


@query(
    "append_service",
    f"""SELECT number, CASE WHEN svc = '' OR contains(lower(s), lower(svc)) THEN s ELSE s || ' - ' || svc END AS summary
        FROM (SELECT number, {_leading('description')} AS s,
                     {_normal('business_service')} AS svc FROM incidents)""",
)
def _(v):
    return v.incidents.select(
        "number",
        text.append_if_missing(
            text.leading_words(F.col("description")), text.normalize_service(F.col("business_service"))
        ).alias("summary"),
    )


@query(
    "final_sweep_fill",
    f"""SELECT number, coalesce(CASE WHEN quality = 1 THEN {_leading('description')} END,
               trim(coalesce(short_description, '') || ' - ' || {_normal('business_service')})) AS summary
        FROM (SELECT i.*, l.quality FROM incidents i LEFT JOIN labels l
              ON i.number = 'INC' || lpad(CAST(l.doc_id AS VARCHAR), 7, '0'))""",
)
def _(v):
    from ticketloom.operators import preparation
    from ticketloom.sources.sample_views import incident_number

    labels = v.table("labels").select(incident_number(F.col("doc_id")).alias("number"), "quality")
    done = (
        v.incidents.join(labels, "number")
        .where("quality = 1")
        .select("number", text.leading_words(F.col("description")).alias("combined_incidents_summary"))
    )
    return preparation.reuse_summaries(v.incidents, done).select(
        "number", F.col("combined_incidents_summary").alias("summary")
    )


@query(
    "summary_skip_short",
    f"""SELECT doc_id, CASE WHEN length(text) < 100 THEN text
            ELSE regexp_replace({_leading('text')}, '^["'']+|["'']+$', '', 'g') END AS summary
        FROM documents""",
)
def _(v):
    t = F.col("text")
    return v.table("documents").select(
        "doc_id",
        F.when(F.length(t) < text.SUMMARY_SKIP_CHARS, t)
        .otherwise(text.strip_quotes(text.leading_words(t)))
        .alias("summary"),
    )


_CLASSIFY = """CASE WHEN contains(lower(message), 'rate limit') OR contains(message, '429') THEN 'RATE_LIMIT'
    WHEN contains(lower(message), 'timeout') THEN 'TIMEOUT'
    WHEN contains(lower(message), 'token') OR contains(lower(message), 'context length') THEN 'TOKEN_LIMIT'
    WHEN contains(lower(message), 'empty') OR contains(lower(message), 'null') OR contains(lower(message), 'short')
      THEN 'VALIDATION_ERROR'
    WHEN contains(lower(message), 'batch') THEN 'BATCH_ERROR'
    WHEN contains(lower(message), 'authentication') OR contains(message, '401') THEN 'AUTH_ERROR'
    WHEN contains(lower(message), 'connection') THEN 'CONNECTION_ERROR'
    WHEN contains(lower(message), 'service unavailable') OR contains(message, '503') THEN 'SERVICE_UNAVAILABLE'
    ELSE 'API_ERROR' END"""


@query("classify_errors", f"SELECT stage, {_CLASSIFY} AS error_class, count(*) AS n FROM failures GROUP BY ALL")
def _(v):
    return v.failures.groupBy("stage", text.classify_error(F.col("message")).alias("error_class")).agg(
        F.count("*").alias("n")
    )


@query(
    "center_slugs",
    """SELECT DISTINCT TechCenter AS center,
           replace(replace(replace(lower(TechCenter || ', A & B'), ' ', '-'), ',', ''), '&', 'and') AS slug,
           translate(lower(TechCenter || '_x y'), ' _', '--') AS slug_plain FROM team_services""",
)
def _(v):
    c = F.col("TechCenter")
    return v.team_services.select(
        c.alias("center"),
        text.center_slug(F.concat(c, F.lit(", A & B"))).alias("slug"),
        text.center_slug_plain(F.concat(c, F.lit("_x y"))).alias("slug_plain"),
    ).distinct()


@query(
    "versioned_names",
    """SELECT training_cycle_id, model_version || '_' || model_hash AS table_name,
              'cluster_results_' || model_version || '_' || model_hash AS results_table,
              'models/' || lower(tech_center) || '/' || model_version || '/reducer_' || model_hash AS path FROM cycles""",
)
def _(v):
    return v.cycles.select(
        "training_cycle_id",
        text.versioned_name(F.col("model_version"), F.col("model_hash")).alias("table_name"),
        text.versioned_name("cluster_results", F.col("model_version"), F.col("model_hash")).alias("results_table"),
        text.artefact_path("reducer", F.col("model_version"), F.col("model_hash"), F.col("tech_center")).alias("path"),
    )


@query(
    "table_references",
    """SELECT s_suppkey, CASE len(p) WHEN 3 THEN p[1] ELSE 'main' END AS catalog,
              CASE len(p) WHEN 3 THEN p[2] WHEN 2 THEN p[1] ELSE 'default' END AS schema,
              CASE len(p) WHEN 3 THEN p[3] WHEN 2 THEN p[2] ELSE p[1] END AS table_name
       FROM (SELECT s_suppkey, string_split(CASE s_suppkey % 3 WHEN 0 THEN 'cat.sch.' || s_name WHEN 1 THEN 'sch.' || s_name
             ELSE s_name END, '.') AS p FROM supplier)""",
)
def _(v):
    k = F.col("s_suppkey")
    ref = F.concat(F.when(k % 3 == 0, "cat.sch.").when(k % 3 == 1, "sch.").otherwise(""), F.col("s_name"))
    parts = text.table_reference(ref, "main")
    return v.table("supplier").select(
        "s_suppkey",
        parts["catalog"].alias("catalog"),
        parts["schema"].alias("schema"),
        parts["table"].alias("table_name"),
    )


@query("contains_ignore_case", "SELECT number FROM incidents WHERE contains(lower(description), lower('THE OR'))")
def _(v):
    return v.incidents.where(text.contains_ignore_case(F.col("description"), "THE OR")).select("number")


@query("word_count", f"SELECT doc_id, len({_words('text')})::BIGINT AS words FROM documents")
def _(v):
    return v.table("documents").select("doc_id", text.word_count(F.col("text")).alias("words"))


@query(
    "chunk_text",
    """SELECT doc_id, i::BIGINT AS chunk, substr(text, i * 1000 + 1, 1000) AS piece FROM (
         SELECT doc_id, text, unnest(range(greatest(ceil(length(text) / 1000.0)::BIGINT, 1))) AS i FROM documents)""",
)
def _(v):
    return v.table("documents").select(
        "doc_id", F.posexplode(text.chunks(F.col("text"), 1000)).alias("chunk", "piece")
    ).withColumn("chunk", F.col("chunk").cast("long"))


@query(
    "prompt_assembly",
    """SELECT number, replace('Summarize in 30 words or less: {combined_text}', '{combined_text}', short_description)
         AS prompt, '- ' || short_description || chr(10) || '- ' || coalesce(business_service, '') AS bullets FROM incidents""",
)
def _(v):
    short = F.col("short_description")
    return v.incidents.select(
        "number",
        text.fill_template("Summarize in 30 words or less: {combined_text}", combined_text=short).alias("prompt"),
        text.bullet_list(F.array(short, text.safe_text(F.col("business_service")))).alias("bullets"),
    )


@query("strip_fence", "SELECT event_id, props AS reply FROM events")
def _(v):
    fenced = F.concat(F.when(F.col("event_id") % 2 == 0, "```json\n").otherwise("```\n"), "props", F.lit("\n```"))
    return v.table("events").select("event_id", text.strip_fence(fenced).alias("reply"))


@query(
    "tokenize",
    r"""SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS token
        FROM documents) GROUP BY token""",
)
def _(v):
    return (
        v.table("documents")
        .select(F.explode(text.tokens(F.col("text"))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


# --- dates -----------------------------------------------------------------------------------------------------------


@query(
    "parse_timestamps",
    """SELECT event_id, CASE event_id % 5 WHEN 3 THEN NULL WHEN 0 THEN ts WHEN 4 THEN ts
              ELSE date_trunc('second', ts) END AS parsed FROM events""",
)
def _(v):
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 5
    raw = (
        F.when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 2, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .when(k == 3, F.date_format(ts, "dd/MM/yyyy"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return v.table("events").select("event_id", dates.parse_timestamp(raw).alias("parsed"))


@query(
    "normalize_iso",
    """SELECT event_id, CASE event_id % 3 WHEN 2 THEN strftime(ts, '%d/%m/%Y')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso FROM events""",
)
def _(v):
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    raw = (
        F.when(k == 0, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "dd/MM/yyyy"))
    )
    return v.table("events").select("event_id", dates.to_iso(raw).alias("iso"))


@query(
    "training_window_start",
    """SELECT o_orderkey, (o_orderdate::DATE - 720)::TIMESTAMP AS start_days,
              (o_orderdate - INTERVAL 24 MONTH)::DATE::TIMESTAMP AS start_calendar FROM orders""",
)
def _(v):
    d = F.col("o_orderdate").cast("timestamp")
    return v.table("orders").select(
        "o_orderkey",
        dates.window_start(d).alias("start_days"),
        dates.window_start(d, mode="calendar").alias("start_calendar"),
    )


@query(
    "quarter_version",
    """SELECT o_orderkey, year(o_orderdate) || '_q' || quarter(o_orderdate) AS model_version,
              'q' || quarter(o_orderdate) AS quarter_name FROM orders""",
)
def _(v):
    d = F.col("o_orderdate")
    return v.table("orders").select(
        "o_orderkey", dates.version_of(d).alias("model_version"), dates.quarter_name(d).alias("quarter_name")
    )


@query(
    "quarter_end",
    """SELECT o_orderkey, strftime(last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)), '%Y-%m-%d')
         AS quarter_end FROM orders""",
)
def _(v):
    d = F.col("o_orderdate")
    return v.table("orders").select(
        "o_orderkey", dates.quarter_end(F.year(d), F.quarter(d)).cast("string").alias("quarter_end")
    )


@query(
    "training_due",
    """SELECT o_orderkey, month(o_orderdate) IN (6, 12) AS due,
              (CASE WHEN month(o_orderdate) < 6 THEN 6 WHEN month(o_orderdate) < 12 THEN 12 ELSE 6 END)::BIGINT AS next_month
       FROM orders""",
)
def _(v):
    d = F.col("o_orderdate")
    return v.table("orders").select(
        "o_orderkey", dates.training_due(d).alias("due"), dates.next_training_month(d).cast("long").alias("next_month")
    )


@query(
    "day_bounds",
    """SELECT event_id, date_trunc('day', ts) + INTERVAL 86399 SECOND AS day_end, ts - INTERVAL 7 DAY AS week_before
       FROM events""",
)
def _(v):
    ts = F.col("ts").cast("timestamp")
    return v.table("events").select(
        "event_id", dates.end_of_day(ts).alias("day_end"), dates.days_before(ts, 7).alias("week_before")
    )


@query(
    "retention_cutoffs",
    """SELECT training_cycle_id, training_completed_date < TIMESTAMP '2001-09-01' - INTERVAL 730 DAY AS registry_expired,
              training_completed_date < TIMESTAMP '2001-09-01' - INTERVAL 365 DAY AS artefact_expired FROM cycles""",
)
def _(v):
    as_of = F.to_timestamp(F.lit("2001-09-01"))
    done = F.col("training_completed_date")
    return v.cycles.select(
        "training_cycle_id",
        (done < dates.days_before(as_of, dates.REGISTRY_RETENTION_DAYS)).alias("registry_expired"),
        (done < dates.days_before(as_of, dates.ARTEFACT_RETENTION_DAYS)).alias("artefact_expired"),
    )


@query(
    "cache_expired",
    "SELECT event_id, (TIMESTAMP '2024-01-15 12:00:00' - ts) > INTERVAL 24 HOUR AS expired FROM events",
)
def _(v):
    as_of = F.to_timestamp(F.lit("2024-01-15 12:00:00"))
    return v.table("events").select(
        "event_id", dates.cache_expired(F.col("ts").cast("timestamp"), as_of).alias("expired")
    )


@query(
    "hourly_windows",
    """SELECT event_id, last_end IS NULL AS first_run,
              CASE WHEN last_end IS NULL THEN TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 1 HOUR ELSE last_end END
                AS start_time,
              CASE WHEN last_end IS NULL THEN TIMESTAMP '2024-01-20 00:00:00'
                   ELSE least(last_end + INTERVAL 1 HOUR, TIMESTAMP '2024-01-20 00:00:00') END AS end_time
       FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN ts END AS last_end FROM events)""",
)
def _(v):
    last = F.when(F.col("event_type") != "view", F.col("ts").cast("timestamp"))
    now = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    w = dates.hourly_window(last, now)
    return v.table("events").select(
        "event_id",
        last.isNull().alias("first_run"),
        w["start_time"].alias("start_time"),
        w["end_time"].alias("end_time"),
    )


# --- JSON, digests, scores -------------------------------------------------------------------------------------------


@query(
    "run_end_dates",
    """SELECT run_id, CASE run_id % 4 WHEN 3 THEN NULL WHEN 2 THEN strftime(time_trigger, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(time_trigger, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS end_date FROM runs""",
)
def _(v):
    return v.runs.select("run_id", json_repair.run_end(F.col("run_details")).alias("end_date"))


@query(
    "json_repair",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'none' WHEN 1 THEN 'closed' WHEN 2 THEN 'structure'
              WHEN 3 THEN 'commas' WHEN 4 THEN 'outer_object' ELSE 'lost' END AS repair_stage,
              CASE WHEN event_id % 6 = 5 THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def _(v):
    k, props = F.col("event_id") % 6, F.col("props")
    raw = (
        F.when(k == 0, props)
        .when(k == 1, F.regexp_replace(props, r"\}$", ', "note": "cut of'))
        .when(k == 2, F.regexp_replace(F.regexp_replace(props, '"k"', "k"), r"\}$", ",}"))
        .when(k == 3, F.concat(F.regexp_replace(props, r"\}$", ""), F.lit(', "a": "b" "c": 1}')))
        .when(k == 4, F.concat(F.lit("Here it is: "), props, F.lit(" - done")))
        .otherwise(F.lit("no document"))
    )
    return json_repair.repair(v.table("events").withColumn("raw", raw), "raw").select(
        "event_id", "repair_stage", F.coalesce(F.get_json_object("repaired", "$.k").cast("long"), F.lit(-1)).alias("k")
    )


@query(
    "json_repair_documents",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'structure' ELSE 'commas' END AS repair_stage,
         '{"k":' || json_extract(props, '$.k') || ',"note":' || CASE event_id % 3 WHEN 0 THEN '[{"x":""},{"y":" , : } ] { "}]'
           WHEN 1 THEN '"","type":"' || event_type || ' 5"' ELSE '[1,"p, q: r","",true],"n":null' END || '}' AS document FROM events""",
)
def _(v):
    """Whole documents: nothing inside strings is touched, empty strings stay empty."""
    k, head = F.col("event_id") % 3, F.regexp_replace("props", r"\}$", "")
    raw = (
        F.when(k == 0, F.concat(head, F.lit(', note: [{"x": ""} {"y": " , : } ] { "},],}')))
        .when(k == 1, F.concat(head, F.lit(', "note": "" "type": "'), "event_type", F.lit(' 5"}')))
        .otherwise(F.concat(head, F.lit(', "note": [1, "p, q: r" "" true] "n": null}')))
    )
    done = json_repair.repair(v.table("events").withColumn("raw", raw), "raw")
    return done.select("event_id", "repair_stage", F.col("repaired").alias("document"))


@query(
    "json_required_keys",
    """SELECT run_id, CASE WHEN json_valid(run_details) AND json_type(run_details) = 'OBJECT' THEN
         CASE WHEN json_extract(run_details, '$.rows') IS NULL OR json_extract(run_details, '$.end_date') IS NULL
              THEN 'Missing required keys: rows, end_date' ELSE 'Valid JSON' END ELSE 'Empty JSON response' END AS verdict
       FROM runs""",
)
def _(v):
    return v.runs.select("run_id", json_repair.validate(F.col("run_details"), ["rows", "end_date"]).alias("verdict"))


@query(
    "json_encode",
    """SELECT event_id, '{"event_id":' || event_id || ',"kind":"' || event_type || '","ok":' ||
              CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END || '}' AS document FROM events""",
)
def _(v):
    return v.table("events").select(
        "event_id",
        F.to_json(
            F.struct("event_id", F.col("event_type").alias("kind"), (F.col("event_type") != "error").alias("ok"))
        ).alias("document"),
    )


@query(
    "vector_json_round_trip",
    "SELECT number, len(embedding)::BIGINT AS dims, round(list_sum(embedding), 6) AS total FROM points",
)
def _(v):
    from ticketloom.functions import vectors

    back = vectors.from_json_text(vectors.to_json_text(F.col("embedding")))
    return v.points.select(
        "number", F.size(back).cast("long").alias("dims"), F.round(vectors.total(back), 6).alias("total")
    )


@query(
    "model_hashes",
    """SELECT training_cycle_id,
         substr(sha256('{"incidents_count":' || incidents_count || ',"tech_center":"' || tech_center || '","training_date":"' ||
           strftime(training_completed_date, '%Y-%m-%d') || '"}'), 1, 8) AS model_hash,
         substr(md5('{"incidents_count":' || incidents_count || ',"tech_center":"' || tech_center || '","training_date":"' ||
           strftime(training_completed_date, '%Y-%m-%d') || '"}'), 1, 8) AS model_hash_md5 FROM cycles""",
)
def _(v):
    parts = (
        F.col("incidents_count"),
        F.col("tech_center"),
        F.date_format("training_completed_date", "yyyy-MM-dd").alias("training_date"),
    )
    return v.cycles.select(
        "training_cycle_id",
        scoring.model_hash(*parts).alias("model_hash"),
        scoring.model_hash(*parts, algorithm="md5").alias("model_hash_md5"),
    )


@query(
    "confidence_scores",
    """SELECT incident_id, CASE WHEN failed THEN 0.5 WHEN predicted_cluster_id = -1 THEN 0.0
              WHEN distance > 2.5 THEN 0.7 ELSE greatest(0.0, 1.0 - round(distance / 2, 6)) END::DOUBLE AS confidence FROM predictions""",
)
def _(v):
    score = F.when(F.col("distance") <= 2.5, F.round(F.col("distance") / 2, 6))
    return v.predictions.select(
        "incident_id", scoring.confidence(F.col("predicted_cluster_id"), score, F.col("failed")).alias("confidence")
    )


@query(
    "confidence_bands",
    """SELECT tech_center, CASE WHEN confidence_score < 0.3 OR distance > 2.0 THEN 'rejected'
              WHEN confidence_score >= 0.8 THEN 'high' ELSE 'accepted' END AS band, count(*) AS n FROM predictions GROUP BY ALL""",
)
def _(v):
    band = scoring.confidence_band(F.col("confidence_score"), F.col("distance"))
    return v.predictions.groupBy("tech_center", band.alias("band")).agg(F.count("*").alias("n"))


@query(
    "domain_counts",
    """SELECT training_cycle_id, least(least(20, greatest(3, clusters_count // 3)), clusters_count)::BIGINT AS domains,
              least(15, greatest(2, clusters_count // 5))::BIGINT AS fallback_domains,
              round(silhouette_score + incidents_count / (1000 + incidents_count), 9) AS combined_score FROM cycles""",
)
def _(v):
    n = F.col("clusters_count")
    return v.cycles.select(
        "training_cycle_id",
        scoring.domain_count(n).alias("domains"),
        scoring.fallback_domain_count(n).alias("fallback_domains"),
        F.round(
            scoring.combined_domain_score(F.col("silhouette_score"), F.col("incidents_count").cast("double")), 9
        ).alias("combined_score"),
    )


@query(
    "domain_confidence",
    """SELECT incident_id, predicted_cluster_id // 3 AS domain_id, round(confidence_score * 0.9, 6) AS domain_confidence
       FROM predictions WHERE predicted_cluster_id >= 0""",
)
def _(v):
    return v.predictions.where("predicted_cluster_id >= 0").select(
        "incident_id",
        F.floor(F.col("predicted_cluster_id") / 3).alias("domain_id"),
        F.round(F.col("confidence_score") * 0.9, 6).alias("domain_confidence"),
    )
