"""Preprocessing job: combine, clean, summarise, embed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import providers, vectors
from ticketloom.operators import preparation, scans

PROCESSING_VERSION = "v2.0.0"


def prepare_texts(
    incidents: DataFrame, provider: providers.Provider | None = None, keep_placeholders: bool = True
) -> DataFrame:
    """Text part of the job: one row per incident that has enough text, with its summary."""
    staged = preparation.with_combined_text(incidents)
    if not keep_placeholders:
        staged = staged.where(~F.col("is_placeholder"))
    cleaned = preparation.clean_and_filter(staged, "combined_text")
    return providers.summarize(cleaned, "combined_text", provider)


def preprocess(
    incidents: DataFrame,
    created: Column,
    services: DataFrame | None = None,
    summary_provider: providers.Provider | None = None,
    embedding_provider: providers.Provider | None = None,
    dims: int = providers.DEFAULT_DIMENSIONS,
    keep_placeholders: bool = True,
) -> DataFrame:
    """Incidents to preprocessed rows. One lazy plan: the only steps outside the JVM are the providers, if given."""
    rows = incidents
    if services is not None:
        mapping = services.select("business_service", F.col("TechCenter").alias("tech_center"))
        rows = scans.with_center(rows, mapping)
    prepared = prepare_texts(rows, summary_provider, keep_placeholders)
    embedded = providers.embed(prepared, "combined_text", embedding_provider, dims)
    return embedded.withColumn("created_timestamp", created).withColumn(
        "processing_version", F.lit(PROCESSING_VERSION)
    )


def to_table(preprocessed: DataFrame) -> DataFrame:
    """Columns of the preprocessed table; rows without a vector are those of :func:`failures`."""
    return schemas.conform(scans.with_vectors(preprocessed), schemas.PREPROCESSED_INCIDENTS)


def failures(preprocessed: DataFrame, when: Column) -> DataFrame:
    """Rows that got no vector, with the stage and the error, for ``processing_failures``."""
    rows = preprocessed.where(~vectors.present(F.col("embedding"))).select(
        "number", F.lit("embedding").alias("stage"),
        F.coalesce("error_class", F.upper("embedding_status")).alias("error_class"),
        F.col("error_message").alias("message"), "tech_center", when.alias("time_trigger"),
    )
    return schemas.conform(rows, schemas.PROCESSING_FAILURES)


def to_retry(incidents: DataFrame, failed: DataFrame, done: DataFrame) -> DataFrame:
    """Incidents that failed in an earlier run and are not in the table yet."""
    open_ = failed.select("number").distinct().join(done.select("number"), "number", "left_anti")
    return incidents.join(open_, "number", "left_semi")
