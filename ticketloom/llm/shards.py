"""Two-pass external shuffle into shards.

First pass: a seeded hash scatters every record over its shard's buckets, each of which fits in a task's memory. Second
pass: every bucket is put into a fixed order and shuffled by Fisher and Yates; a record's slot is the place of its
bucket in the shard plus its place in the bucket. Any task can be repeated with the same outcome. Rows that come in an
order of their own (``place``) keep it in every shard: buckets are then ranges of places, and nothing is drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OVERHEAD = 16
BUCKET_BYTES = 8 << 20
#: Buckets (a few numbers each) that may be broadcast; beyond that their starts are joined.
SMALL = 200_000


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of 0 .. n-1: from the last place down, each place swaps with one at or before it."""
    order = np.arange(n)
    picks = (np.random.Generator(np.random.PCG64(seed)).random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    out = order.tolist()
    for last in range(n - 1, 0, -1):
        k = picks[last]
        out[last], out[k] = out[k], out[last]
    return np.array(out, np.int64)


def scores(key: Column, seed: int, shard: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(shard), key)


def home(key: Column, shards: int, seed: int) -> Column:
    """The shard with the highest seeded hash for ``key``, as (hash, shard)."""
    return F.array_max(F.array(*[F.struct(scores(key, seed, s).alias("h"), F.lit(s).alias("s")) for s in range(shards)]))


def placed(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 40, seed: int = 17, bucket_bytes: int = BUCKET_BYTES,
    place: str | None = None,
) -> DataFrame:
    """All columns of ``df`` with ``shard_size, shard, grown_shard, slot``; law ``key``.

    ``doc_id`` and the number of shards decide the shard, ``grown_shard`` is the one among one shard more. Rows with a
    null id have no key and go by their text instead, so that they don't pile up. ``shard_size`` is the UTF-8 length of
    the text (null: 0) plus 16. Slots count from 0 without gaps in every shard. Rows with equal id and text are in one
    bucket (any order among them is the same); columns of ``df`` with one of these names are replaced. ``place`` names a
    column that numbers the rows from 0; it is not returned.
    """
    made = ("shard_size", "shard", "grown_shard", "slot")
    carried = [c for c in df.columns if c not in made and c != place]
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + OVERHEAD
    rows = df.select(*carried, size.alias("shard_size"), *([F.col(place).alias("__mark")] if place else []))
    total, count = rows.agg(F.coalesce(F.sum("shard_size"), F.lit(0)), F.count("*")).first()
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    unkeyed = F.xxhash64(F.lit("unkeyed"), F.col(text))
    key = F.coalesce(F.xxhash64(F.col(doc_id)) if dict(df.dtypes)[doc_id] == "string" else F.col(doc_id).cast("long"), unkeyed)
    mark = F.col("__mark") if place else F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    bucket = F.floor(mark * buckets / max(1, count)) if place else F.pmod(mark, F.lit(buckets))
    rows = rows.withColumns({"__mark": mark, "__bucket": bucket.cast("int"), "__key": key}).withColumn("__home", home(F.col("__key"), shards, seed))
    one_more = F.when(scores(F.col("__key"), seed, shards) >= F.col("__home.h"), F.lit(shards)).otherwise(F.col("__home.s"))
    rows = rows.withColumns({"shard": F.col("__home.s"), "grown_shard": one_more}).drop("__key", "__home")
    sizes = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("n"))
    before = F.expr("coalesce(sum(n) OVER (PARTITION BY shard ORDER BY __bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    starts = sizes.select("shard", "__bucket", before.alias("__start"))
    fields = [f for f in rows.schema if f.name not in ("__mark",)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "__place long"])

    def shuffle(key: tuple, table: pa.Table) -> pa.Table:
        shard, bucket = (k.as_py() for k in key)
        marks = table.column("__mark").to_numpy()
        fixed = np.argsort(marks, kind="stable")
        mixed = fixed if place else fixed[fisher_yates(len(fixed), (seed * 1_000_003 + shard) * 1_000_003 + bucket)]
        out = table.drop(["__mark"]).take(pa.array(mixed))
        return out.append_column("__place", pa.array(np.arange(len(mixed))))

    mixed = rows.groupBy("shard", "__bucket").applyInArrow(shuffle, schema)
    slot = F.col("__start") + F.col("__place")
    if shards * buckets <= SMALL:
        starts = F.broadcast(starts)
    return mixed.join(starts, ["shard", "__bucket"]).select(*carried, "shard_size", "shard", "grown_shard", slot.alias("slot"))


def write_shards(rows: DataFrame, path: str) -> DataFrame:
    """Write one folder per shard, whose files hold their rows in the order of the slots, and read it back."""
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
