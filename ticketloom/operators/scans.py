"""Window scans and row filters over incident tables.

All predicates are plain column comparisons with literals, so the Parquet reader gets them as pushed filters and day
partitions are pruned.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions import dates, text, vectors

INCIDENT_COLUMNS = ("number", "sys_created_on", "description", "short_description", "business_service")


def as_time(value: str | datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def window_scan(
    df: DataFrame,
    start,
    end,
    columns: tuple[str, ...] = INCIDENT_COLUMNS,
    time: str = "sys_created_on",
    closed: bool = True,
) -> DataFrame:
    """Rows of a time window: both ends included by default, half-open with ``closed=False``."""
    c = F.col(time)
    upper = c <= as_time(end) if closed else c < as_time(end)
    return df.where((c >= as_time(start)) & upper).select(*columns)


def year_scan(df: DataFrame, year: int, time: str = "sys_created_on") -> DataFrame:
    """Rows of one year, written as a range so that the filter reaches the scan."""
    c = F.col(time)
    return df.where((c >= as_time(f"{year}-01-01 00:00:00")) & (c < as_time(f"{year + 1}-01-01 00:00:00")))


def cumulative_training_scan(df: DataFrame, year: int, quarter: int, months: int = dates.TRAINING_WINDOW_MONTHS):
    """Raw incidents of the training window that ends with a quarter."""
    end = dates.quarter_end(F.lit(year), F.lit(quarter)).cast("timestamp")
    return window_scan(df, dates.window_start(end, months), end)


def of_centers(df: DataFrame, centers: list[str], column: str = "tech_center") -> DataFrame:
    return df.where(F.col(column).isin(*centers))


def match_center(df: DataFrame, center: str, column: str = "business_service") -> DataFrame:
    """Rows whose service fits a center name: exact match, else the bare name within it, else "Development".

    Every row is tagged with its best rule; the best rule that any row fits is found by one map-side combined minimum,
    and its rows are kept. No rule is tried on the driver.
    """
    service = F.col(column)
    rule = F.when(service == center, 1)
    if center.startswith(text.CENTER_PREFIX):
        rule = rule.when(text.contains_ignore_case(service, center[len(text.CENTER_PREFIX) :]), 2)
    if "Development &" in center:
        rule = rule.when(text.contains_ignore_case(service, "Development"), 3)
    tagged = df.withColumn("_rule", rule).where(F.col("_rule").isNotNull())
    best = tagged.agg(F.min("_rule").alias("_rule"))
    return tagged.join(best, "_rule", "left_semi").drop("_rule")


def with_center(df: DataFrame, mapping: DataFrame, default: str = "BT-TC-General") -> DataFrame:
    """Add the tech center of the service from a mapping table, with a default for unknown services."""
    m = mapping.select("business_service", F.col("tech_center").alias("_center"))
    return (
        df.join(m, "business_service", "left")
        .withColumn("tech_center", F.coalesce("_center", F.lit(default)))
        .drop("_center")
    )


def since_watermark(
    df: DataFrame, watermarks: DataFrame, time: str = "sys_created_on", pipeline: str | None = None
) -> DataFrame:
    """Rows strictly newer than the newest watermark of their center, of one pipeline if it is named."""
    if pipeline is not None:
        watermarks = watermarks.where(F.col("pipeline_name") == pipeline)
    w = watermarks.groupBy("tech_center").agg(F.max("last_processed_timestamp").alias("_mark"))
    return df.join(w, "tech_center").where(F.col(time) > F.col("_mark")).drop("_mark")


def since_watermark_or_default(
    df: DataFrame, watermarks: DataFrame, as_of, hours: int = 2, time: str = "sys_created_on"
) -> DataFrame:
    """Like :func:`since_watermark`; a center without watermark starts ``hours`` before ``as_of``."""
    w = watermarks.groupBy("tech_center").agg(F.max("prediction_timestamp").alias("_mark"))
    start = F.coalesce("_mark", as_time(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return df.join(w, "tech_center", "left").where(F.col(time) > start).drop("_mark")


def ingested_since(
    df: DataFrame, watermarks: DataFrame, done: DataFrame, overlap_hours: int = 2, time: str = "created_timestamp", key: str = "number"
) -> DataFrame:
    """Rows stored since their center's last run that are not ``done``; a center without a run starts with all its rows.

    Watermarks are run times, so they are compared with the time at which a row was stored, never with event time: an
    incident may be stored hours after it happened. ``overlap_hours`` are read again for rows that were being stored
    while the last run read; ``done`` keeps them from being taken twice.
    """
    w = watermarks.groupBy("tech_center").agg(F.max("prediction_timestamp").alias("_mark"))
    since = F.col("_mark") - F.make_dt_interval(F.lit(0), F.lit(overlap_hours))
    fresh = df.join(w, "tech_center", "left").where(F.col("_mark").isNull() | F.col(time).isNull() | (F.col(time) > since))
    return fresh.drop("_mark").join(done.select(key).distinct(), key, "left_anti").select(df.columns)


def not_yet_predicted(
    df: DataFrame,
    predictions: DataFrame,
    as_of,
    centers: list[str] | None = None,
    days: int | None = None,
    limit: int | None = None,
    key: str = "incident_id",
    time: str = "sys_created_on",
) -> DataFrame:
    """All rows without a prediction; ``days`` leaves out older ones, ``limit`` takes the newest of them only."""
    recent = df if days is None else df.where(F.col(time) >= dates.days_before(as_time(as_of), days))
    if centers is not None:
        recent = of_centers(recent, centers)
    out = recent.join(predictions.select(key), key, "left_anti")
    return out if limit is None else out.orderBy(F.desc(time), key).limit(limit)


def with_vectors(df: DataFrame, vec: str = "embedding") -> DataFrame:
    return df.where(vectors.present(F.col(vec)))


def split_by_vector_validity(df: DataFrame, vec: str, dims: int) -> DataFrame:
    """Tag rows with what is wrong with their vector; ``ok`` rows are fit for clustering."""
    v = F.col(vec)
    return df.withColumn(
        "vector_status",
        F.when(~vectors.present(v), "missing")
        .when(F.size(v) != dims, "wrong_size")
        .when(~vectors.finite(v), "not_finite")
        .otherwise("ok"),
    )


def without_noise(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.where(F.col(cluster) != -1)


def centers_with_enough_rows(df: DataFrame, centers: DataFrame) -> DataFrame:
    """Centers whose row count reaches their own ``min_incidents``."""
    n = df.groupBy("tech_center").agg(F.count("*").alias("n"))
    return centers.join(n, "tech_center").where(F.col("n") >= F.col("min_incidents"))


def late_rows(df: DataFrame, processed: DataFrame, window_end, key: str = "number", time: str = "sys_created_on"):
    """Rows older than the last window end that no run has picked up."""
    return df.where(F.col(time) <= as_time(window_end)).join(processed.select(key), key, "left_anti")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group. The rank filter is applied before the shuffle too, so a hot group stays small."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
