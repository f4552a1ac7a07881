"""Grouping of clusters into domains, and their names.

Grouping runs keyed k-means over the cluster centres (all centers and restarts advance in the same jobs), or merges them
by Ward's criterion and scores the cuts.
Everything here works on one row per cluster.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions import scoring, vectors
from ticketloom.operators import quality, ward
from ticketloom.operators.scans import top_per_group
from ticketloom.runtime import cut

RESTARTS = 10
#: Rounds between two looks at whether the centres have come to rest.
ROUNDS = 4


def keyed_kmeans(
    rows: DataFrame,
    keys: list[str],
    ident: str,
    vec: str,
    k: str,
    restarts: int = RESTARTS,
    rounds: int = ROUNDS,
    max_k: int = scoring.MAX_DOMAINS,
) -> DataFrame:
    """k-means per key, best of several seeded starts, each run until its cost falls no more. ``k`` is at most ``max_k``.

    The centres of a run are an array of at most ``max_k`` vectors, so the nearest one is found inside the row.
    """
    runs = cut(
        rows.select(*keys, F.col(ident).alias("_id"), F.col(vec).alias("_v"), F.col(k).alias("_goal")).withColumn(
            "_run", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1)))
        )
    )
    on = [*keys, "_run"]
    w = Window.partitionBy(*on).orderBy(F.xxhash64("_id", "_run"), F.col("_id"))
    first = runs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_k).where(F.col("_rn") <= F.col("_goal"))
    centres = first.groupBy(*on).agg(F.collect_list("_v").alias("_cs"))

    def nearest(c: DataFrame) -> DataFrame:
        gaps = F.transform("_cs", lambda x: vectors.total(F.zip_with(x, F.col("_v"), lambda p, q: (p - q) * (p - q))))
        return (
            runs.join(c, on)
            .withColumn("_gaps", gaps)
            .withColumn("_cost", F.array_min("_gaps"))
            .withColumn("_c", (F.array_position("_gaps", F.col("_cost")) - 1).cast("int"))
            .drop("_gaps", "_cs")
        )

    earlier = None
    while True:
        for _ in range(rounds):
            mean = Summarizer.metrics("mean").summary(array_to_vector("_v"))
            moved = nearest(centres).groupBy(*on, "_c").agg(mean.alias("_m")).select(*on, "_c", vector_to_array("_m.mean").alias("_m"))
            centres = moved.groupBy(*on).agg(F.transform(F.array_sort(F.collect_list(F.struct("_c", "_m"))), lambda e: e["_m"]).alias("_cs"))
        centres = cut(centres)
        cost = cut(nearest(centres).groupBy(*on).agg(F.sum("_cost").alias("_total")))
        if earlier is not None:
            falling = earlier.withColumnRenamed("_total", "_old").join(cost, on).where(F.col("_total") < F.col("_old") * (1 - 1e-9))
            if falling.isEmpty():
                break
        earlier = cost
    placed = cut(nearest(centres))
    best = cost.groupBy(*keys).agg(F.min(F.struct("_total", "_run")).alias("_b")).select(*keys, F.col("_b._run").alias("_run"))
    chosen = placed.join(best, on)
    # domains are numbered by their smallest member
    first_of = chosen.groupBy(*keys, "_c").agg(F.min("_id").alias("_low"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_low")) - 1
    names = first_of.withColumn("domain_id", number.cast("int")).drop("_low")
    return chosen.join(names, [*keys, "_c"]).select(*keys, F.col("_id").alias(ident), "domain_id")


def group_domains(centres: DataFrame, keys: list[str], max_domains: int = scoring.MAX_DOMAINS) -> DataFrame:
    """Domains by k-means with a third as many domains as clusters. ``centres`` has ``cluster_id, center_x, center_y``."""
    n = centres.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = centres.join(n, keys).select(
        *keys, "cluster_id", F.array("center_x", "center_y").alias("_v"),
        scoring.domain_count(F.col("_n"), max_domains).alias("_k"),
    )
    return keyed_kmeans(rows, keys, "cluster_id", "_v", "_k", max_k=max_domains)


def group_domains_scored(centres: DataFrame, keys: list[str], max_domains: int = scoring.DEFAULT_DOMAINS) -> DataFrame:
    """Domains by Ward merging, the count chosen by silhouette and Calinski-Harabasz over the cuts of the merge tree.

    Keys with at most three clusters get the single domain 0. Columns: keys, cluster_id, domain_id, domain_count.
    """
    n = centres.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = cut(centres.join(n, keys).select(*keys, "cluster_id", F.array("center_x", "center_y").alias("_v"), "_n"))
    few = rows.where("_n <= 3").select(*keys, "cluster_id", F.lit(0).alias("domain_id"), F.lit(1).alias("domain_count"))
    on = [*keys, "_want"]
    grouped = cut(ward.cuts(rows.where("_n > 3"), keys, "cluster_id", "_v", max_domains))
    scored = grouped.join(rows, [*keys, "cluster_id"]).select(
        *on, F.col("cluster_id").alias("number"), F.col("domain_id").alias("cluster_id"), "_v", "_n"
    )
    scored = cut(scored)
    sil = quality.silhouette_exact(scored, on, "number", "_v")
    ch = quality.calinski_harabasz(scored, on, "_v")
    score = scoring.combined_domain_score(F.col("silhouette_score"), F.col("calinski_harabasz"))
    table = sil.join(ch, on).withColumn("_score", score).join(n, keys)
    fallback = scoring.fallback_domain_count(F.col("_n"))
    best = table.groupBy(*keys).agg(
        F.max(F.when(F.col("_score") > 0, F.struct(F.col("_score"), (-F.col("_want")).alias("_neg")))).alias("_b"),
        F.first(fallback).alias("_f"),
    ).select(*keys, F.coalesce(-F.col("_b._neg"), F.col("_f")).cast("int").alias("_want"))
    picked = grouped.join(best, on).select(*keys, "cluster_id", "domain_id", F.col("_want").alias("domain_count"))
    return picked.unionByName(few)


def name_domains(domains: DataFrame, labels: DataFrame, keys: list[str], given: DataFrame | None = None) -> DataFrame:
    """Domain names: a given one, else "Domain {id}: {topic of its first cluster}", or "All Incidents" for a lone domain.

    Returns one row per cluster, plus the noise domain -1.
    """
    on = [*keys, "cluster_id"]
    joined = domains.join(labels.select(*on, "topic"), on, "left")
    first = joined.groupBy(*keys, "domain_id").agg(F.min_by("topic", "cluster_id").alias("_topic"))
    count = first.groupBy(*keys).agg(F.count("*").alias("_n"))
    names = first.join(count, keys).withColumn(
        "_auto",
        F.when(F.col("_n") == 1, "All Incidents").otherwise(
            F.concat_ws(": ", F.concat(F.lit("Domain "), "domain_id"), "_topic")
        ),
    )
    if given is not None:
        names = names.join(given.select(*keys, "domain_id", F.col("domain_name").alias("_given")), [*keys, "domain_id"], "left")
        names = names.withColumn("domain_name", F.coalesce("_given", "_auto")).drop("_given")
    else:
        names = names.withColumn("domain_name", F.col("_auto"))
    names = names.withColumn("domain_description", F.when(F.col("_n") == 1, "All incident clusters").otherwise("Group of related incidents"))
    rows = domains.select(*on, "domain_id").join(names.select(*keys, "domain_id", "domain_name", "domain_description"), [*keys, "domain_id"])
    noise = rows.select(*keys).distinct().select(
        *keys, F.lit(-1).alias("domain_id"), F.lit(-1).alias("cluster_id"), F.lit("Noise").alias("domain_name"),
        F.lit("Uncategorized incidents").alias("domain_description"),
    )
    return rows.unionByName(noise)
