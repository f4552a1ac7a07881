"""Term statistics: keyword labels of clusters, dictionary frequencies, TF-IDF over a fixed vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import text
from ticketloom.operators.scans import top_per_group
from ticketloom.runtime import cut

LABEL_TERMS = 3
KEYWORDS = 10
TERMS_PER_CLASS = 50


def term_counts(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Occurrences of every term per key."""
    return (
        rows.select(*keys, F.explode(text.tokens(F.col(column))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("tf"))
    )


def class_terms(points: DataFrame, keys: list[str], column: str, per_class: str = "cluster_id", n: int = KEYWORDS) -> DataFrame:
    """Terms that set a class apart: frequency in the class times ln(1 + average class size / total frequency).

    Terms are counted map-side before they are shuffled, and the rank filter cuts each partition before the ranking.
    """
    # the texts are read once; what is kept is one row per class and term
    counts = cut(term_counts(points.where(F.col(per_class) != -1), [*keys, per_class], column))
    sizes = counts.groupBy(*keys).agg(
        (F.sum("tf") / F.countDistinct(per_class)).alias("_avg")
    )
    totals = counts.groupBy(*keys, "term").agg(F.sum("tf").alias("_all"))
    scored = counts.join(totals, [*keys, "term"]).join(sizes, keys).withColumn(
        "score", F.col("tf") * F.log(1 + F.col("_avg") / F.col("_all"))
    )
    return top_per_group(scored, [*keys, per_class], [F.desc("score"), F.col("term")], n).select(
        *keys, per_class, "term", "tf", "score"
    )


def label_clusters(points: DataFrame, keys: list[str], column: str, per_class: str = "cluster_id") -> DataFrame:
    """Label, description and keywords per class from its leading terms; a class without terms gets a generated label."""
    top = class_terms(points, keys, column, per_class)
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("term").alias("t")))), lambda e: e["t"]
    )
    named = top.groupBy(*keys, per_class).agg(ordered.alias("keywords"))  # at most KEYWORDS entries
    sizes = points.where(F.col(per_class) != -1).groupBy(*keys, per_class).agg(F.count("*").alias("size"))
    label = F.array_join(F.slice("keywords", 1, LABEL_TERMS), " ")
    out = sizes.join(named, [*keys, per_class], "left")
    return out.select(
        *keys, per_class, "size",
        F.coalesce(label, F.concat(F.lit("Cluster_"), F.col(per_class))).alias("primary_label"),
        F.coalesce(F.concat(F.lit("Incidents about "), F.array_join("keywords", ", ")), F.lit("Auto-generated cluster")).alias("description"),
        F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"),
        F.lit("Unknown").alias("domain"),
    )


def dictionary_frequencies(rows: DataFrame, column: str, dictionary: DataFrame, n: int = TERMS_PER_CLASS) -> DataFrame:
    """Frequencies of dictionary terms, the most common ones per class. ``dictionary`` has ``term, class``."""
    counts = term_counts(rows, [], column).join(dictionary, "term")
    return top_per_group(counts, ["class"], [F.desc("tf"), F.col("term")], n).select("class", "term", F.col("tf").alias("frequency"))


def tf_idf(rows: DataFrame, ident: str, column: str, vocabulary: DataFrame) -> DataFrame:
    """Unit-length TF-IDF weights over a fixed vocabulary, in long form: ``ident, term, weight``.

    idf = ln((1 + n) / (1 + df)) + 1; a term of several words never matches, as texts are split into words.
    """
    found = rows.select(ident, F.explode(text.tokens(F.col(column))).alias("term"))
    found = found.join(vocabulary.select("term").distinct(), "term", "left_semi")
    counts = cut(found.groupBy(ident, "term").agg(F.count("*").alias("tf")))
    df = counts.groupBy("term").agg(F.count("*").alias("_df")).withColumn("_one", F.lit(1))
    total = rows.agg(F.count("*").alias("_n")).withColumn("_one", F.lit(1))
    idf = df.join(F.broadcast(total), "_one").select(  # a single row
        "term", (F.log((1 + F.col("_n")) / (1 + F.col("_df"))) + 1).alias("_idf"))
    raw = counts.join(idf, "term").withColumn("_w", F.col("tf") * F.col("_idf"))
    # the terms of one text are few, so its length and its weights come from one grouping
    entry = F.collect_list(F.struct("term", "_w")).alias("_es")
    packed = raw.groupBy(ident).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_len"), entry)
    flat = packed.select(ident, "_len", F.explode("_es").alias("e"))
    return flat.select(ident, F.col("e.term").alias("term"), (F.col("e._w") / F.col("_len")).alias("weight"))
