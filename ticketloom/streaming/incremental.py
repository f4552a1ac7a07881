"""Incremental loading: hourly windows behind a run watermark, and the same job as a stream."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import dates
from ticketloom.operators import governance, scans
from ticketloom.plans.preprocess import failures, preprocess, to_retry, to_table
from ticketloom.sources.sinks import run_logged, write_table
from ticketloom.sources.tables import Store

KEY = "number"


def new_rows_only(df: DataFrame, existing: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is new, each once: makes a repeated window harmless."""
    return df.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def hourly_counts(df: DataFrame, service: str = "business_service", time: str = "sys_created_on") -> DataFrame:
    """Rows per hour and service; the same expression runs on batches and on streams with a watermark."""
    return (
        df.groupBy(F.window(time, "1 hour").alias("w"), F.col(service).alias("service"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "service", "n")
    )


def boundary_gap(df: DataFrame, time: str) -> DataFrame:
    """Rows that fall between two windows that include both ends, when the next starts a second after a full hour."""
    past = F.col(time).cast("double") - F.date_trunc("hour", time).cast("double")
    return df.where((past > 0) & (past < 1))


def next_window(
    store: Store, now: datetime, start_date: str | None = None, end_date: str | None = None, parity: bool = False
) -> DataFrame:
    """One-row frame with the window of the next run."""
    runs = store.read("preprocessing_watermarks")
    last = runs.withColumn("run_id", F.col("time_trigger")).orderBy(F.desc("time_trigger")).limit(1)
    spark = store.spark
    one = spark.range(1).select(F.lit(now).cast("timestamp").alias("now"), F.lit(1).alias("_one"))
    end = governance.latest_run(last).select("end_time").withColumn("_one", F.lit(1))
    window = dates.back_fill_window(start_date, end_date, F.col("end_time"), F.col("now"), parity)
    return one.join(end, "_one", "left").select(window.alias("w")).select("w.*")


def run_incremental(
    store: Store,
    incidents: DataFrame,
    services: DataFrame,
    now: datetime,
    start_date: str | None = None,
    end_date: str | None = None,
    overwrite: bool = False,
    overwrite_watermark: bool = False,
    parity: bool = False,
    retry: bool = False,
    **options,
) -> dict:
    """One run: scan the window, preprocess, append new rows, then advance the watermark - also after an empty run.

    Windows are half-open and follow each other without a gap (``parity``: both ends included, a second apart). Rows
    without a vector go to ``processing_failures`` with their stage and error; ``retry`` takes those of earlier runs
    along.
    """
    with run_logged(store, "preprocessing", now) as log:
        w = next_window(store, now, start_date, end_date, parity).first()  # a single row
        rows = scans.window_scan(incidents, w.start_time, w.end_time, closed=parity)
        trigger = F.lit(now).cast("timestamp")
        table, failed = "preprocessed_incidents", "processing_failures"
        if retry and store.exists(failed):
            again = to_retry(incidents, store.read(failed), store.read(table)).select(*rows.columns)
            rows = rows.unionByName(again).dropDuplicates([KEY])
        done = preprocess(rows, trigger, services, **options).persist()
        fresh = to_table(done)
        write_table(failures(done, trigger), store, failed)
        if not overwrite:
            fresh = new_rows_only(fresh, store.read(table))
        write_table(fresh, store, table, "WRITE_TRUNCATE" if overwrite else "WRITE_APPEND")
        stored = store.read(table).where(F.col("created_timestamp") == F.lit(now).cast("timestamp"))
        newest = governance.newest_row(stored)
        record = governance.run_record(
            F.col("n"), F.lit(w.start_time), F.lit(w.end_time), F.col("newest_incident_id"), F.col("newest_incident_timestamp")
        )
        counted = stored.agg(F.count("*").alias("n")).withColumn("_one", F.lit(1))
        mark = (
            counted.join(newest.withColumn("_one", F.lit(1)), "_one")
            .select(
                F.col("n").alias("preprocessed_rows"),
                F.lit(now).cast("timestamp").alias("time_trigger"),
                record.alias("run_details"),
            )
        )
        done.unpersist()
        disposition = "WRITE_TRUNCATE" if overwrite_watermark else "WRITE_APPEND"
        # the record is a single row; taking it first lets the same table be replaced
        record_rows = mark.collect()
        single = store.spark.createDataFrame(record_rows, schemas.RUN_WATERMARKS)
        write_table(single, store, "preprocessing_watermarks", disposition)
        log["rows"] = record_rows[0].preprocessed_rows
    return {"start_time": w.start_time, "end_time": w.end_time}


def preprocess_stream(
    store: Store, incident_folder: str, services: DataFrame, checkpoint: str, delay: str = "2 hours", **options
):
    """The job as a stream over arriving Parquet files.

    Every micro-batch replaces its own ``batch_id`` partition, so a replayed batch leaves no duplicate; repeated numbers
    within the watermark delay are dropped by state, older ones by the join with what is stored. Beside its rows a batch
    leaves what failed, with stage and error, and one run record (``preprocessed_stream_failures``, ``_runs``).
    """
    spark = store.spark
    source = spark.readStream.schema(schemas.INCIDENTS).parquet(incident_folder)
    unique = source.withWatermark("sys_created_on", delay).dropDuplicatesWithinWatermark([KEY])
    table = "preprocessed_stream"

    def put(rows: DataFrame, name: str, batch_id: int) -> None:
        rows = rows.withColumn("batch_id", F.lit(batch_id))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
        writer.parquet(store.path(name))

    def load(batch: DataFrame, batch_id: int) -> None:
        began, now = time.monotonic(), F.current_timestamp()
        done = preprocess(batch, now, services, **options).persist()
        rows = to_table(done)
        if store.exists(table):
            earlier = spark.read.parquet(store.path(table)).where(F.col("batch_id") != batch_id)
            rows = new_rows_only(rows, earlier)
        put(rows, table, batch_id)
        put(failures(done, now), f"{table}_failures", batch_id)
        done.unpersist()
        stored = spark.read.parquet(store.path(table)).where(F.col("batch_id") == batch_id)
        record = stored.agg(
            F.count("*").alias("preprocessed_rows"), F.min("sys_created_on").alias("start_time"), F.max("sys_created_on").alias("end_time")
        )
        put(record.select("*", now.alias("time_trigger"), F.lit(time.monotonic() - began).alias("seconds")), f"{table}_runs", batch_id)

    return (
        unique.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_count_stream(spark, schema, folder: str, service: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Hourly counts as a stream; rows later than the delay are left to :func:`ticketloom.operators.scans.late_rows`."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn(time, F.col(time).cast("timestamp"))
    return hourly_counts(rows.withWatermark(time, delay), service, time)
