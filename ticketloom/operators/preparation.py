"""Row-level preparation of incidents: combination, filters, summaries and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import text
from ticketloom.functions.scoring import safe_rate

REQUIRED = ("number", "sys_created_on", "description", "short_description", "business_service")


def require_columns(df: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def with_combined_text(df: DataFrame, out: str = "combined_text") -> DataFrame:
    """Combined text plus a flag for rows in which nothing was written."""
    require_columns(df)
    combined = text.combine_incident(F.col("description"), F.col("short_description"), F.col("business_service"))
    return df.withColumn(out, combined).withColumn("is_placeholder", F.col(out) == text.PLACEHOLDER)


def clean_and_filter(
    df: DataFrame,
    column: str,
    fast: bool = False,
    min_length: int = text.MIN_LENGTH,
    max_length: int | None = None,
) -> DataFrame:
    """Clean a text column and keep rows of the minimum length; only if ``max_length`` is given, longer ones are cut."""
    cleaned = text.fast_clean(F.col(column)) if fast else text.deep_clean(F.col(column))
    # a plain filter would be pushed below the projection and clean every text twice
    long_enough = F.filter(F.array(cleaned), lambda t: F.length(t) >= min_length)
    out = F.col("_cleaned") if max_length is None else text.truncate(F.col("_cleaned"), max_length)
    return df.withColumn("_cleaned", F.explode(long_enough)).withColumn(column, out).drop("_cleaned")


def embedding_input(df: DataFrame, column: str, max_tokens: int = text.EMBEDDING_TOKENS) -> DataFrame:
    """``status`` (empty, long, valid) and the ``prepared`` text for embedding, always whole."""
    stripped = text.strip(F.col(column))
    empty = F.coalesce(F.length(stripped), F.lit(0)) == 0
    too_long = F.floor(F.length(stripped) / 4) > max_tokens
    return df.withColumn(
        "status", F.when(empty, "empty").when(too_long, "long").otherwise("valid")
    ).withColumn(
        "prepared",
        F.when(~empty, stripped),
    )


def strict_reason(column: Column, max_tokens: int = text.STRICT_EMBEDDING_TOKENS) -> Column:
    """Why the strict check refuses a text; null where it passes."""
    stripped = text.strip(column)
    return (
        F.when(F.coalesce(F.length(stripped), F.lit(0)) == 0, "empty")
        .when(text.estimate_tokens(column) > max_tokens, "too_long")
        .when(F.length(stripped) < text.MIN_LENGTH, "too_short")
    )


def filter_by_chars(df: DataFrame, column: str, limit: int = text.EMBEDDING_CHARS) -> DataFrame:
    """Drop empty texts and add ``pieces``, the whole text in parts of at most ``limit`` characters."""
    stripped = text.strip(F.col(column))
    return df.where(F.length(stripped) > 0).withColumn(column, stripped).withColumn("pieces", text.chunks(F.col(column), limit))


def route_summaries(df: DataFrame) -> DataFrame:
    """Short descriptions become ``short - service`` at once; longer ones are marked for summarisation."""
    cleaned = F.regexp_replace(text.summary_clean(F.col("description")), text.EMAIL_IN_SUMMARY, "")
    staged = df.withColumn("_clean", cleaned)
    is_short = F.length("_clean") < text.SHORT_DESCRIPTION
    service = text.normalize_service(F.col("business_service"))
    return (
        staged.withColumn("summary_source", F.when(is_short, "short_text").otherwise("summarize"))
        .withColumn(
            "summary",
            F.when(is_short, text.short_dash_service(text.summary_clean(F.col("short_description")), service)),
        )
        .withColumn("summary_input", F.when(~is_short, F.col("_clean")))
        .drop("_clean")
    )


def reuse_summaries(df: DataFrame, summaries: DataFrame) -> DataFrame:
    """Take earlier summaries by incident number; fill the rest from short description and service."""
    fallback = text.short_dash_service(
        text.safe_text(F.col("short_description")), text.normalize_service(F.col("business_service"))
    )
    known = summaries.select("number", F.col("combined_incidents_summary").alias("_known"))
    return (
        df.join(known, "number", "left")
        .withColumn("summary_source", F.when(F.col("_known").isNull(), "final_sweep").otherwise("reused"))
        .withColumn("combined_incidents_summary", F.coalesce("_known", fallback))
        .drop("_known")
    )


def keep_summaries(prepared: DataFrame, summaries: DataFrame) -> DataFrame:
    """Earlier summaries, by incident number, in place of the ones that were made; rows without one keep theirs."""
    known = summaries.groupBy("number").agg(F.max("combined_incidents_summary").alias("_known"))
    return (
        prepared.join(known, "number", "left")
        .withColumn("summary_source", F.when(F.col("_known").isNull(), F.col("summary_source")).otherwise("reused"))
        .withColumn("combined_incidents_summary", F.coalesce("_known", "combined_incidents_summary"))
        .select(prepared.columns)
    )


def summary_statistics(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts and rates by ``summary_source``."""
    source = F.col("summary_source")
    agg = df.groupBy(*(keys or [])).agg(
        F.count("*").alias("total_incidents"),
        F.count_if(source == "short_text").alias("short_text"),
        F.count_if(source == "provider_failed").alias("provider_failures"),
        F.count_if(source == "final_sweep").alias("final_sweep"),
        F.count_if(source.isin("summarize", "provider_failed", "final_sweep")).alias("attempted"),
    )
    ok = F.col("attempted") - F.col("provider_failures") - F.col("final_sweep")
    return (
        agg.withColumn("total_fallbacks", F.col("short_text") + F.col("provider_failures") + F.col("final_sweep"))
        .withColumn("succeeded", ok)
        .withColumn("success_rate", safe_rate(ok, F.col("attempted")))
        .withColumn("overall_rate", safe_rate(ok, F.col("total_incidents")))
    )


def preparation_statistics(df: DataFrame, column: str, min_length: int = text.MIN_LENGTH) -> DataFrame:
    """Originals, cleaned and dropped rows with the success rate, in one pass."""
    cleaned = text.deep_clean(F.col(column))
    n_ok = F.count_if(F.length(cleaned) >= min_length)
    agg = df.agg(F.count("*").alias("total_incidents"), n_ok.alias("processed_incidents"))
    return agg.withColumn("failed_incidents", F.col("total_incidents") - F.col("processed_incidents")).withColumn(
        "success_rate", safe_rate(F.col("processed_incidents"), F.col("total_incidents"))
    )


def embedding_report(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Totals by ``status`` of :func:`embedding_input` with the success rate."""
    agg = df.groupBy(*(keys or [])).agg(
        F.count("*").alias("total_processed"),
        F.count_if(F.col("status") == "empty").alias("empty_texts"),
        F.count_if(F.col("status") == "long").alias("too_long_texts"),
        F.count_if(F.col("status") != "empty").alias("valid_texts"),
    )
    return agg.withColumn("success_rate", safe_rate(F.col("valid_texts"), F.col("total_processed")))


def incident_violations(
    description: Column, center: Column, centers: list[str], confidence_score: Column
) -> Column:
    """Names of the contract rules an incident row breaks."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(F.length(description), F.lit(0)) < text.MIN_LENGTH, "description_too_short"),
            F.when(~F.coalesce(center.isin(*centers), F.lit(False)), "unknown_tech_center"),
            F.when(~F.coalesce(confidence_score.between(0.0, 1.0), F.lit(False)), "confidence_out_of_range"),
        )
    )
