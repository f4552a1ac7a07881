"""Writing: result tables, versioned partitions, large multi-file results, CSV and JSON outputs."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.sources.tables import Store, list_files

# Columns that a result table may carry, in order.
RESULT_COLUMNS = (
    "number", "priority", "sys_created_on", "TeamDepartment", "Area", "Unit", "TechCenter", "short_description",
    "close_code", "vendor", "assignment_group", "state", "business_service", "close_notes", "work_notes", "chanel",
    "description", "cluster", "subcategory", "category",
)
MINIMAL_COLUMNS = ("number", "combined_incidents_summary", "category", "subcategory")
EMBEDDING_COLUMNS = ("number", "combined_incidents_summary", "embedding")
ROWS_PER_FILE = 50_000
DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite"}


def _mode(disposition: str) -> str:
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown disposition {disposition!r}")
    return DISPOSITIONS[disposition]


def result_columns(df: DataFrame) -> DataFrame:
    """Those of the result columns that the frame has."""
    return df.select(*[c for c in RESULT_COLUMNS if c in df.columns])


def minimal_columns(df: DataFrame) -> DataFrame:
    return df.select(*MINIMAL_COLUMNS)


def without_vectors(df: DataFrame) -> DataFrame:
    """Predictions are stored without their vectors."""
    return df.drop("embedding", "embedding_vector")


def write_table(df: DataFrame, store: Store, name: str, disposition: str = "WRITE_APPEND") -> None:
    """Append to or replace a table; tables with a declared schema are conformed first."""
    if name in schemas.ALL:
        df = schemas.conform(df, schemas.ALL[name])
    writer: DataFrameWriter = df.write.mode(_mode(disposition))
    if name in schemas.PARTITIONS:
        writer = writer.partitionBy(*schemas.PARTITIONS[name]).option("partitionOverwriteMode", "dynamic")
    writer.parquet(store.path(name))


def save_results(df: DataFrame, store: Store, name: str, disposition: str = "WRITE_APPEND") -> None:
    result_columns(df).write.mode(_mode(disposition)).parquet(store.path(name))


def save_minimal_results(df: DataFrame, store: Store, name: str) -> None:
    minimal_columns(df).write.mode("append").parquet(store.path(name))


def save_embeddings(df: DataFrame, store: Store, name: str, disposition: str = "WRITE_APPEND") -> None:
    df.select(*EMBEDDING_COLUMNS).write.mode(_mode(disposition)).parquet(store.path(name))


def save_predictions(df: DataFrame, store: Store, name: str = "incident_predictions") -> None:
    write_table(without_vectors(df), store, name)


def save_training_data(df: DataFrame, store: Store, version: str, created: Column) -> None:
    """Training rows of one version; a rerun replaces that version only, new columns are allowed."""
    (
        df.withColumn("training_version", F.lit(version))
        .withColumn("created_timestamp", created)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("training_version")
        .parquet(store.path("training_data"))
    )


def save_clusters(df: DataFrame, store: Store, version: str, created: Column) -> None:
    """One row per cluster of a version; a rerun replaces the rows of its version and centers."""
    out = df.withColumn("created_at", created)
    rows = schemas.conform(out, schemas.CLUSTERS).withColumn("model_version", F.lit(version))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("model_version", "tech_center").parquet(store.path("clusters"))


def save_cluster_results(df: DataFrame, store: Store, predicted_at: Column) -> None:
    """Labelled points, partitioned by version, hash and center; a rerun replaces its own partitions."""
    write_table(df.withColumn("prediction_timestamp", predicted_at), store, "cluster_results", "WRITE_TRUNCATE")


def write_large(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write in files of bounded size and return the manifest."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return list_files(df.sparkSession.read.parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def save_analysis(df: DataFrame, path: str) -> None:
    write_json(df, path)


def load_analysis(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_logs(df: DataFrame, store: Store) -> None:
    """Append log rows; a row that lacks a required value makes the write fail."""
    rows = schemas.conform(df, schemas.TRAINING_LOGS)
    for field in schemas.TRAINING_LOGS:
        if not field.nullable:
            value = F.when(F.col(field.name).isNull(), F.raise_error(F.lit(f"log row without {field.name}")))
            rows = rows.withColumn(field.name, value.otherwise(F.col(field.name)))
    rows.write.mode("append").parquet(store.path("training_logs"))


def save_artefacts(df: DataFrame, store: Store) -> None:
    write_table(df, store, "artefacts", "WRITE_TRUNCATE")


def sorted_by_day(df: DataFrame, path: str, time: str, cluster_by: list[str]) -> None:
    """Day partitions with rows ordered by the clustering columns, so that row-group statistics prune."""
    (
        df.withColumn("dt", F.to_date(time))
        .repartition("dt", F.pmod(F.xxhash64(*cluster_by), F.lit(16)))
        .sortWithinPartitions("dt", *cluster_by)
        .write.mode("overwrite")
        .partitionBy("dt")
        .parquet(path)
    )


@contextmanager
def run_logged(store: Store, stage: str, now: datetime):
    """Append what a job did to ``run_log``: stage, rows (set them in the yielded dictionary) and seconds.

    A job that fails leaves no row. The rows feed :func:`ticketloom.operators.governance.run_metrics`.
    """
    done = {"rows": 0}
    began = time.monotonic()
    yield done
    row = (f"{stage}-{uuid.uuid4().hex}", stage, now, done["rows"], time.monotonic() - began)
    write_table(store.spark.createDataFrame([row], schemas.RUN_LOG), store, "run_log")
