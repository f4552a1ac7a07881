"""Reading: projected Parquet scans, parameterised SQL, multi-part results, stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketloom import schemas


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet read; only the asked columns are fetched and row groups are split between tasks."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Rebalance rows before costly text work, whatever the size of the input: few large row groups become even tasks."""
    return df.hint("rebalance")


def run_sql(spark: SparkSession, statement: str, args: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound parameters (``:name``) and frames (``{name}``)."""
    return spark.sql(statement, args=args, **frames)


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All parts of one result as a frame; columns that a part lacks are null."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def list_files(df: DataFrame) -> DataFrame:
    """Files behind a frame with their row counts: the manifest of a multi-file result."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))


def list_folder(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder, newest first, without reading their contents."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("modificationTime").alias("last_modified"), "length")
        .orderBy(F.desc("last_modified"), "path")
    )


class Store:
    """Named Parquet tables below one root folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return bool(fs.exists(jvm_path))

    def read(self, name: str, schema: StructType | str | None = None, merge: bool = False) -> DataFrame:
        """Stored table; one that was never written reads as empty.

        A declared schema is applied to the files, which saves the footer scan and keeps partition values text.
        ``merge`` asks for the union of the columns of all parts instead.
        """
        schema = schema if schema is not None else schemas.ALL.get(name)
        if not self.exists(name):
            if schema is None:
                raise FileNotFoundError(self.path(name))
            return self.spark.createDataFrame([], schema)
        if merge or schema is None:
            return self.spark.read.option("mergeSchema", "true").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def read_or_compute(self, name: str, compute: Callable[[], DataFrame], reuse: bool = True) -> DataFrame:
        """Stage result: read if it is there, else compute, store and read back."""
        if not (reuse and self.exists(name)):
            compute().write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))
