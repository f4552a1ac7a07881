"""Session helpers: session settings, lineage cuts and plan-size guards."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ticketloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC and Arrow on; everything else stays at the cluster's defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times are UTC wall-clock times, so that windows do not depend on where the job runs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster; only a local session may fall back to a temporary one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="ticketloom-checkpoint-")
    sc.setCheckpointDir(shared)
    return shared


_CUTS: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and go on from the written table.

    A lost executor costs a re-read, not a recomputation of every round before. A written table is used instead of
    ``checkpoint()`` because iterative plans would otherwise inherit the constraints of all earlier rounds, which grow
    with every round; it also gives the planner exact sizes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _CUTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_cuts(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far; frames that still read them become unusable."""
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    while _CUTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_CUTS.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
