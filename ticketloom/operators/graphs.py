"""Connected components on edge tables, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.runtime import cut


def _fingerprint(edges: DataFrame, keys: list[str]) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*keys, "_u", "_w").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame, keys: list[str], a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """Smallest identifier reachable from every node that has an edge: ``keys, node, component``.

    Each round hangs neighbours below the smallest node around, first from the larger, then from the smaller side, so
    long paths shrink geometrically. A round exchanges edges only; no component is ever gathered in one place.
    """
    e = cut(
        edges.where(F.col(a) != F.col(b))
        .select(*keys, F.greatest(a, b).alias("_u"), F.least(a, b).alias("_w"))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(*keys, F.col("_w").alias("_u"), F.col("_u").alias("_w")))
        low = both.groupBy(*keys, "_u").agg(F.least(F.min("_w"), F.col("_u")).alias("_m"))
        large = both.join(low, [*keys, "_u"]).where(F.col("_w") > F.col("_u"))
        large = large.select(*keys, F.col("_w").alias("_u"), F.col("_m").alias("_w"))
        down = large.groupBy(*keys, "_u").agg(F.min("_w").alias("_m"))
        small = large.join(down, [*keys, "_u"])
        small = small.where(F.col("_w") != F.col("_m")).select(*keys, F.col("_w").alias("_u"), F.col("_m").alias("_w"))
        e = cut(small.unionByName(down.select(*keys, "_u", F.col("_m").alias("_w"))).where("_u <> _w").distinct())
        now = _fingerprint(e, keys)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    nodes = e.select(*keys, F.col("_u").alias("node"), F.col("_w").alias("component"))
    roots = e.select(*keys, F.col("_w").alias("node"), F.col("_w").alias("component")).distinct()
    return nodes.unionByName(roots)


def collapse(pointers: DataFrame, keys: list[str], node: str, target: str) -> DataFrame:
    """Common root of every node that points to exactly one other node: ``keys, node, root``.

    Two nodes that point at each other are closed at the smaller one, then all pointers are doubled until they rest; a
    path of length n takes log2(n) joins of one row per node.
    """
    p = cut(pointers.select(*keys, F.col(node).alias("_n"), F.col(target).alias("_t")))

    def jump(table: DataFrame, closing: bool = False) -> DataFrame:
        hop = table.select(*keys, F.col("_n").alias("_t"), F.col("_t").alias("_next"))
        joined = table.join(hop, [*keys, "_t"])
        if closing:
            here = (F.col("_next") == F.col("_n")) & (F.col("_n") < F.col("_t"))
            return joined.select(*keys, "_n", F.when(here, F.col("_n")).otherwise(F.col("_t")).alias("_t"))
        return joined.select(*keys, "_n", F.col("_next").alias("_t"))

    p = cut(jump(p, closing=True))
    while True:
        hop = p.select(*keys, F.col("_n").alias("_t"), F.col("_t").alias("_next"))
        moving = p.join(hop, [*keys, "_t"]).where("_next <> _t")
        if moving.isEmpty():
            return p.select(*keys, F.col("_n").alias("node"), F.col("_t").alias("root"))
        p = cut(jump(jump(p)))
