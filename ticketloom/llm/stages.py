"""Stages of the corpus pipeline: each takes documents and returns what it keeps of them, with the same columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import decontaminate, language, mixing, neardup, shards
from ticketloom.llm.blocks import bounded_batches


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those without a letter go, and those that speak for no language at all.

    A document with a language label that was learned stays even if its words say nothing, as every labelled language is
    learned. Null and empty texts have no letter. Repeated rows share one fate, an empty table stays empty, and columns
    named like the operator's own are carried along untouched.
    """
    bounded_batches(spark)
    model = language.fit(docs)
    even = 1.0 / len(model.languages) if len(model.languages) > 1 else 0.0
    own = {c: f"__own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    judged = language.predict(docs.withColumnsRenamed(own), model)
    speaks = (F.col("score") > even + 1e-9) | F.coalesce(F.col("lang").isin(model.languages), F.lit(False))
    kept = judged.where((F.col("lang_pred") != language.UNDETERMINED) & speaks).drop("lang_pred", "score")
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    bounded_batches(spark)
    return neardup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of benchmark items."""
    bounded_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_overlap(docs, benchmark).where(~decontaminate.contaminated()).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: the files of the written table follow each other in it."""
    placed = mixing.mixed(docs)
    return placed.repartitionByRange("place", "in_block").sortWithinPartitions("place", "in_block").select(docs.columns)


def in_order(docs: DataFrame, place: str) -> DataFrame:
    """Number the rows from 0 as they come: files by name, rows as they lie in them; a frame without files row by row."""
    own = [F.col(c) for c in docs.columns]
    try:
        rows = docs.select(*own, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        rows = docs.select(*own, F.spark_partition_id().cast("string").alias("__file"), F.monotonically_increasing_id().alias("__row"))
        rows = rows.withColumns({"__row": F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)), "__file": F.lpad("__file", 10, "0")})
    before = F.expr("coalesce(sum(n) OVER (ORDER BY __file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    starts = rows.groupBy("__file").agg(F.count("*").alias("n")).select("__file", before.alias("__start"))  # a row per file
    return rows.join(starts, "__file").select(*docs.columns, (F.col("__start") + F.col("__row")).alias(place))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard and slot; the slots of a shard keep the order that the rows come in, that of the mixture."""
    return shards.placed(in_order(docs, "__come"), place="__come")
