"""The operators applied to the tables of a data folder, with SQL counterparts where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import (
    archives, conversations, decontaminate, language, lexical, licences, mixing, neardup, quality, secrets, shards, suffixes,
    token_files,
)
from ticketloom.llm.blocks import bounded_batches
from ticketloom.llm.oracles import ORACLES
from ticketloom.runtime import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files, in the folder that the cluster shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence templates that parts of every document match."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = licences.scan(documents, columns=["doc_id"])
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), "best", "dice")


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by a model of the documents that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(documents.where(~language.held_out(F.col("doc_id"))))
    found = language.predict(documents, model, columns=["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality cascade over all documents, with the base measures of every text."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.cascade(documents, columns=["doc_id"], measures=base)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *base, failed.alias("base_failed"), "kept")


@query
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every document in a mixture whose weights damp large sources."""
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mixed(documents).select("doc_id", "source", "weight", "block", "place", "in_block")


@query
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document: known forms, and random strings by the models."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(documents, secrets.fit(documents))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed("assign", "access", "hex").cast("binary"), 256).alias("base_sha256"),
        secrets.listed(*secrets.KINDS).alias("spans"),
    )


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document, and the links found at its text."""
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_overlap(documents, table(spark, folder, "benchmark"), columns=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages recorded as ARC files, converted to WARC files and read back."""
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    archives.write_arc(table(spark, folder, "pages"), arc)
    archives.convert(spark, arc, warc)
    return archives.read_back(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents shuffled into forty shards, written and read back."""
    documents = table(spark, folder, "documents")
    rows = shards.write_shards(shards.placed(documents), scratch(spark, "shards"))
    return rows.select(
        "doc_id", F.col("shard_size").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard",
    )


@query
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written as Simple-8b files and read back."""
    import public_tokenizers

    path = scratch(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), plain_specials=False)
    digests = scratch(spark, "token-digests")
    token_files.read_digests(spark, path).write.parquet(digests)
    return token_files.with_global_start(spark.read.parquet(digests)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten documents that rank highest for every benchmark item."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return lexical.search(documents, table(spark, folder, "benchmark").select("item_id", "text"))


@query
def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document without the byte strings of smaller documents."""
    found = suffixes.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op13_repair_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Cheapest repair of every conversation after planted damage."""
    talks = table(spark, folder, "conversations")
    report, edited = conversations.repair(conversations.damaged(talks), copies="copies")
    hashes = conversations.digests(edited).withColumnRenamed("_conv", "_h")
    report = report.withColumnRenamed("conv_id", "_r")
    found = talks.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("_r")), "left")
    found = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("_h")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
