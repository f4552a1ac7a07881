"""Incident-shaped views over the driver's tables.

The library itself takes any DataFrame with the right columns; these views only give the registered queries, the tests
and the benchmark rows to work on. Each view is a projection, filter or join that Catalyst pushes into the scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.runtime import use_utc
from ticketloom.sources.tables import spread

TEXT_TABLES = ("documents", "pages", "events")
EPOCH = "2024-01-01 00:00:00"
CENTERS = 15
FAILURE_MESSAGES = (
    "Rate limit reached, status 429",
    "Request timeout after 30 s",
    "Maximum context length exceeded",
    "Empty or null text",
    "Batch 7 was refused",
    "Authentication failed (401)",
    "Connection reset by peer",
    "Service unavailable 503",
    "Unknown failure",
)


def incident_number(key: Column) -> Column:
    text = key.cast("string")
    return F.concat(F.lit("INC"), F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0")))


def hours_after_epoch(key: Column) -> Column:
    return F.to_timestamp(F.lit(EPOCH)) + F.make_dt_interval(F.lit(0), key.cast("int"))


class Views:
    """Lazily built views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            self._tables[name] = spread(df) if name in TEXT_TABLES else df
        return self._tables[name]

    @cached_property
    def incidents(self) -> DataFrame:
        d = self.table("documents")
        service = (
            F.when(F.col("doc_id") % 50 == 0, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 7 == 0, F.concat("source", F.lit(" - PROD")))
            .otherwise(F.col("source"))
        )
        return d.select(
            incident_number(F.col("doc_id")).alias("number"),
            hours_after_epoch(F.col("doc_id")).alias("sys_created_on"),
            F.col("text").alias("description"),
            F.substring("text", 1, 80).alias("short_description"),
            service.alias("business_service"),
        )

    @cached_property
    def team_services(self) -> DataFrame:
        sources = self.table("documents").where(F.col("source") != "src19").select("source").distinct()
        n = F.substring("source", 4, 10).cast("long")
        return sources.join(self.table("region"), n % 5 == F.col("r_regionkey")).select(
            F.col("source").alias("business_service"),
            F.concat(F.lit("BT-TC-"), "r_name").alias("TechCenter"),
            F.concat(F.lit("Department "), n % 4).alias("TeamDepartment"),
            F.concat(F.lit("Area "), n % 3).alias("Area"),
            F.concat(F.lit("Unit "), n).alias("Unit"),
        )

    @cached_property
    def center_incidents(self) -> DataFrame:
        t = self.team_services.select("business_service", F.col("TechCenter").alias("tech_center"))
        return self.incidents.join(t, "business_service")

    @cached_property
    def points(self) -> DataFrame:
        """Vectors of one center each, double precision."""
        e = self.table("embeddings")
        return e.select(
            F.col("vec_id").alias("number"),
            F.concat(F.lit("BT-TC-"), F.col("vec_id") % 3).alias("tech_center"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )

    @cached_property
    def clustered(self) -> DataFrame:
        e = self.table("embeddings")
        vec = F.col("embedding").cast("array<double>")
        center = F.concat(F.lit("BT-TC-"), F.col("vec_id") % 3)
        version = F.when(F.col("vec_id") % 2 == 0, "2024_q2").otherwise("2024_q4")
        return e.select(
            F.col("vec_id").alias("number"),
            hours_after_epoch(F.col("vec_id")).alias("sys_created_on"),
            center.alias("tech_center"),
            version.alias("model_version"),
            F.substring(F.md5(F.concat_ws("|", center, version)), 1, 8).alias("model_hash"),
            F.when(F.col("vec_id") % 10 == 3, -1).otherwise(F.col("label")).cast("int").alias("cluster_id"),
            F.concat(F.lit("Summary of "), "vec_id").alias("combined_incidents_summary"),
            vec.alias("embedding"),
            vec[0].alias("umap_x"),
            vec[1].alias("umap_y"),
        )

    @cached_property
    def cluster_info(self) -> DataFrame:
        """Label table of the clusters; cluster 9 has no entry."""
        c = self.clustered.where((F.col("cluster_id") >= 0) & (F.col("cluster_id") != 9))
        return (
            c.groupBy("tech_center", "model_version", "cluster_id")
            .agg(F.count("*").alias("size"))
            .withColumn("primary_label", F.concat(F.lit("Topic "), "cluster_id"))
            .withColumn("description", F.concat(F.lit("Incidents of kind "), "cluster_id"))
            .withColumn("keywords", F.array(F.concat(F.lit("k"), "cluster_id"), F.concat(F.lit("w"), "cluster_id")))
        )

    @cached_property
    def domain_map(self) -> DataFrame:
        """Cluster to domain; cluster 8 has no domain."""
        c = self.clustered.where((F.col("cluster_id") >= 0) & (F.col("cluster_id") != 8))
        domain = F.floor(F.col("cluster_id") / 3).cast("int")
        return (
            c.select("tech_center", "model_version", "cluster_id")
            .distinct()
            .withColumn("domain_id", domain)
            .withColumn("domain_name", F.concat(F.lit("Domain "), domain))
        )

    @cached_property
    def cycles(self) -> DataFrame:
        """Training cycles, one per order."""
        o = self.table("orders")
        when = F.col("o_orderdate").cast("timestamp")
        center = F.concat(F.lit("BT-TC-"), F.col("o_custkey") % CENTERS)
        status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "FAILED")
        version = F.concat(F.year(when), F.lit("_q"), F.quarter(when))
        return o.select(
            F.concat(F.lit("cycle-"), "o_orderkey").alias("training_cycle_id"),
            center.alias("tech_center"),
            when.alias("training_completed_date"),
            version.alias("model_version"),
            F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8).alias("model_hash"),
            status.otherwise("RUNNING").alias("training_status"),
            (F.col("o_orderkey") % 50).alias("clusters_count"),
            (F.col("o_orderkey") % 997 + 100).alias("incidents_count"),
            (F.col("o_totalprice") / 1000000).alias("silhouette_score"),
            ((F.col("o_custkey") % 60) / 100.0).alias("noise_ratio"),
            F.when(F.col("o_orderkey") % 3 == 0, "staging").when(F.col("o_orderkey") % 3 == 1, "production")
            .otherwise("archived").alias("stage"),
            F.when(F.col("o_orderkey") % 4 == 0, "archived").otherwise("active").alias("model_status"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Stored predictions, one per line item."""
        li = self.table("lineitem")
        cluster = F.when(F.col("l_linenumber") == 7, -1).otherwise(F.col("l_partkey") % 40)
        return li.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("incident_id"),
            F.concat(F.lit("BT-TC-"), F.col("l_suppkey") % CENTERS).alias("tech_center"),
            cluster.alias("predicted_cluster_id"),
            F.when(cluster == -1, 0.0).otherwise(F.round(F.col("l_quantity") / 50, 4)).alias("confidence_score"),
            (F.col("l_tax") * 40).alias("distance"),
            F.col("l_shipdate").cast("timestamp").alias("prediction_timestamp"),
            F.concat(F.lit("results_"), F.year("l_shipdate")).alias("model_table_used"),
            (F.col("l_returnflag") == "R").alias("failed"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Run records of the incremental job, one per event; details are JSON, partly quoted twice or broken."""
        e = self.table("events")
        ts = F.col("ts").cast("timestamp")
        end = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
        plain = F.concat(F.lit('{"rows": '), F.col("event_id").cast("string"), F.lit(', "end_date": "'), end, F.lit(' UTC"}'))
        quoted = F.concat(F.lit('"'), F.replace(plain, F.lit('"'), F.lit('\\"')), F.lit('"'))
        broken = F.concat(F.lit('{"rows": , "end_date": "'), end, F.lit('"'))
        details = (
            F.when(F.col("event_id") % 4 == 0, plain)
            .when(F.col("event_id") % 4 == 1, quoted)
            .when(F.col("event_id") % 4 == 2, broken)
            .otherwise(F.col("props"))
        )
        return e.select(
            F.col("event_id").alias("run_id"),
            ts.alias("time_trigger"),
            F.col("user_id").alias("preprocessed_rows"),
            F.col("event_type").alias("stage"),
            F.col("value").alias("seconds"),
            details.alias("run_details"),
        )

    @cached_property
    def failures(self) -> DataFrame:
        """Failed rows per stage, one per error or view event."""
        e = self.table("events").where(F.col("event_type").isin("error", "view"))
        messages = F.array(*[F.lit(m) for m in FAILURE_MESSAGES])
        return e.select(
            F.concat(F.lit("INC"), F.col("user_id") * 100 + F.col("event_id") % 100).alias("number"),
            F.when(F.col("event_type") == "error", "embedding").otherwise("summarization").alias("stage"),
            F.element_at(messages, (F.col("event_id") % len(FAILURE_MESSAGES) + 1).cast("int")).alias("message"),
            F.concat(F.lit("BT-TC-"), F.col("user_id") % CENTERS).alias("tech_center"),
        )
