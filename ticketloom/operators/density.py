"""Density clustering: spanning tree of mutual reachability, flat cuts, hierarchy, membership, outliers, prediction.

All operators are keyed, so every center is clustered in the same jobs. The tree is exact: neighbour lists settle most
of it, and where a component's best way out may lie beyond the lists, an exact bounded search finds it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators import neighbours as nb
from ticketloom.operators.arrow_blocks import array, matrix, squared_distances
from ticketloom.operators.graphs import collapse, components
from ticketloom.runtime import cut

# Defaults of the clustering.
MIN_CLUSTER_SIZE = 25
MIN_SAMPLES = 5
EDGE_NEIGHBOURS = 15
TINY = 1e-12


@dataclass
class SpanningTree:
    """Tree edges ``_k, a, b, w`` over representatives, core distances, and members of the representatives."""

    edges: DataFrame
    nodes: DataFrame
    members: DataFrame


def _cores(lists: DataFrame, sizes: DataFrame, min_samples: int) -> DataFrame:
    """Core distance of every representative, counting the members of its neighbours."""
    state = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("core"))

    def step(s, e):
        seen = s["seen"] + e["_m"]
        reached = s["core"].isNull() & (seen >= min_samples)
        return F.struct(seen.alias("seen"), F.when(reached, e["_d"]).otherwise(s["core"]).alias("core"))

    joined = sizes.join(lists, (sizes["_k"] == lists["_k"]) & (sizes["_id"] == lists["_q"]), "left").select(
        sizes["_k"], sizes["_id"], sizes["_m"], "_list"
    )
    own = F.array(F.struct(F.lit(0.0).alias("_d"), F.col("_id").alias("_p"), (F.col("_m") - 1).alias("_m")))
    full = F.concat(own, F.coalesce("_list", F.slice(own, 1, 0)))
    core = F.aggregate(full, state, step)["core"]
    # a key with fewer points than asked for: the farthest point there is
    return joined.select("_k", "_id", "_m", "_list", F.coalesce(core, F.element_at(full, -1)["_d"]).alias("_core"))


class _WayOut:
    """Best way out of every component that a group of queries belongs to."""

    def __init__(self, queries: pa.Table, pivots, radius, pure, alpha: float, empty: pa.Schema):
        self.key = queries.column("_k")[0].as_py()
        self.q, self.ids, self.core = matrix(queries.column("_v")), queries.column("_id").combine_chunks(), array(queries.column("_core"))
        comps = queries.column("_comp").combine_chunks()
        self.comps = comps.unique()
        self.code = array(pc.index_in(comps, value_set=self.comps))
        self.place = {c: i for i, c in enumerate(self.comps.to_pylist())}
        self.bound = np.full(len(self.comps), np.inf)
        np.minimum.at(self.bound, self.code, array(queries.column("_bound")))
        self.pivots, self.radius, self.pure, self.alpha, self.empty = pivots[self.key], radius[self.key], pure[self.key], alpha, empty
        self.found: list[pa.Table] = []
        self.rows, self.cell, self.near = 0, None, None

    def _limit(self, rows: np.ndarray) -> np.ndarray:
        return self.bound[self.code[rows]] * (1 + 1e-7) + 1e-7

    def meet(self, cell: int, points: pa.RecordBatch) -> None:
        if cell != self.cell:
            gap = np.sqrt(squared_distances(self.q, self.pivots[cell : cell + 1]))[:, 0] - self.radius[cell]
            self.cell, self.near = cell, np.maximum(self.core, np.maximum(gap, 0.0) / self.alpha)
            self.near[self.code == self.place.get(self.pure[cell], -1)] = np.inf
        active = np.flatnonzero(np.isfinite(self.near) & (self.near <= self._limit(np.arange(len(self.q)))))
        p, core = matrix(points.column("_v")), array(points.column("_core"))
        other = array(pc.index_in(points.column("_comp"), value_set=self.comps).fill_null(-1))
        for i in range(0, len(active), 512):
            part = active[i : i + 512]
            d2 = squared_distances(self.q[part], p)
            rough = np.maximum(np.maximum(self.core[part][:, None], core[None, :]), np.sqrt(d2) / self.alpha)
            rough[self.code[part][:, None] == other[None, :]] = np.inf
            limit = np.minimum(rough.min(1) * (1 + 1e-7) + 1e-7, self._limit(part))
            r, c = np.nonzero((rough <= limit[:, None]) & np.isfinite(rough))
            if not len(r):
                continue
            w = np.maximum(np.maximum(self.core[part][r], core[c]), nb._exact(self.q[part], p, r, c) / self.alpha)
            code = self.code[part][r]
            np.minimum.at(self.bound, code, w)
            keep = w <= self.bound[code]  # equal weights stay: identifiers decide between them
            a, take = self.ids.take(pa.array(part[r[keep]])), pa.array(c[keep])
            to = points.column("_id").take(take)
            self.found.append(pa.table({
                "code": code[keep], "w": w[keep], "lo": pc.min_element_wise(a, to), "hi": pc.max_element_wise(a, to),
                "a": a, "b": to, "cb": points.column("_comp").take(take),
            }))
            self.rows += int(keep.sum())
        if self.rows > nb.CHUNK_CELLS // 4:
            self._compact()

    def _compact(self) -> None:
        if not self.found:
            return
        rows = pa.concat_tables(self.found)
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("code", "w", "lo", "hi")]))
        first = np.unique(array(rows.column("code")), return_index=True)[1]
        self.found, self.rows = [rows.take(pa.array(first)).combine_chunks()], len(first)

    def result(self) -> pa.Table:
        self._compact()
        if not self.found:
            return self.empty.empty_table()
        rows = self.found[0]
        own = self.comps.take(rows.column("code").combine_chunks())
        return pa.table(
            [pa.array([self.key] * rows.num_rows, pa.string()), own, rows.column("a"), rows.column("b"), rows.column("cb"), rows.column("w")],
            schema=self.empty,
        )


def _cells_outside(pivots, radius, size, pure, top_core, alpha):
    """Cells that may hold a better way out of the query's component than the bound it came with."""

    def reach(batch):
        keys = np.asarray(batch.column("_k").to_pylist(), dtype=object)
        comps = np.asarray(batch.column("_comp").to_pylist(), dtype=object)
        core, bound = array(batch.column("_core")), array(batch.column("_bound"))
        for key in set(keys):
            at = np.flatnonzero(keys == key)
            step = nb.chunk_rows(len(pivots[key]))
            for i in range(0, len(at), step):
                part = at[i : i + step]
                x = matrix(batch.column("_v").take(pa.array(part)))
                d = np.sqrt(squared_distances(x, pivots[key]))
                closed = (comps[part][:, None] == pure[key][None, :]) | (size[key] == 0)[None, :]
                near = np.maximum(core[part][:, None], np.maximum(d - radius[key][None, :], 0.0) / alpha)
                far = np.maximum(
                    np.maximum(core[part][:, None], top_core[key][None, :]), (d + radius[key][None, :]) / alpha
                )
                far[closed] = np.inf
                limit = np.minimum(bound[part], far.min(1)) * (1 + 1e-7) + 1e-7
                r, c = np.nonzero(~closed & (near <= limit[:, None]))
                yield part[r], c

    return reach


def _search_outside(index: nb.CellIndex, points: DataFrame, queries: DataFrame, alpha: float) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    stats = points.groupBy("_k", "_cell").agg(
        F.min("_comp").alias("lo"), F.max("_comp").alias("hi"), F.max("_core").alias("core")
    )
    pure = {k: np.full(len(p), None, dtype=object) for k, p in index.pivots.items()}
    top = {k: np.zeros(len(p)) for k, p in index.pivots.items()}
    for row in stats.collect():  # at most one row per pivot
        top[row._k][row._cell] = row.core
        if row.lo == row.hi:
            pure[row._k][row._cell] = row.lo
    ident = index.points.schema["_id"].dataType
    schema = T.StructType(
        [
            T.StructField("_k", T.StringType()),
            T.StructField("_comp", ident),
            T.StructField("_a", ident),
            T.StructField("_b", ident),
            T.StructField("_cb", ident),
            T.StructField("_wt", T.DoubleType()),
        ]
    )
    empty = to_arrow_schema(schema)
    pivots, radius = index.pivots, index.radius
    reach = _cells_outside(pivots, radius, index.size, pure, top, alpha)
    return nb.sweep(queries, index, points, reach, lambda rows: _WayOut(rows, pivots, radius, pure, alpha, empty), schema)


def spanning_tree(
    points: DataFrame,
    keys: list[str],
    ident: str,
    vec: str,
    min_samples: int = MIN_SAMPLES,
    metric: str = "euclidean",
    alpha: float = 1.0,
    edge_neighbours: int = EDGE_NEIGHBOURS,
    cell_rows: int = nb.CELL_ROWS,
) -> SpanningTree:
    """Minimum spanning tree of the mutual reachability graph, by rounds of component merging.

    In a round every component takes its cheapest edge to another one. The number of components at least halves, so
    there are at most log2(n) rounds, each cut from its lineage.
    """
    k = max(min_samples, edge_neighbours)
    base = cut(nb.keyed(points, keys, ident, vec, metric))
    reps = cut(nb.distinct_vectors(base))
    index = nb.build_index(reps, cell_rows)
    lists = cut(nb.search(index, index.points, k, True))
    cores = _cores(lists, index.points.select("_k", "_id", "_m"), min_samples)
    reach = F.when(F.size("_list") >= k, F.greatest("_core", F.element_at("_list", -1)["_d"] / alpha)).otherwise(
        F.lit(float("inf"))
    )
    nodes = cut(cores.select("_k", "_id", "_m", "_core", F.coalesce(reach, F.lit(float("inf"))).alias("_beyond"), "_list"))
    located = cut(
        index.points.drop("_dp", "_m").join(nodes.select("_k", "_id", "_core", "_beyond"), ["_k", "_id"])
    )
    other = nodes.select("_k", F.col("_id").alias("_b"), F.col("_core").alias("_cb_core"))
    directed = nodes.select("_k", F.col("_id").alias("_a"), "_core", F.explode("_list").alias("e")).select(
        "_k", "_a", F.col("e._p").alias("_b"), F.col("e._d").alias("_d"), "_core"
    )
    weight = F.greatest("_core", "_cb_core", F.col("_d") / alpha)
    edges = cut(
        directed.join(other, ["_k", "_b"])
        .select("_k", F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"), weight.alias("_wt"))
        .distinct()
        .select("_k", "_a", "_b", F.col("_a").alias("_ca"), F.col("_b").alias("_cb"), "_wt")
    )
    comp = nodes.select("_k", "_id", F.col("_id").alias("_comp"))
    tree: list[DataFrame] = []
    while True:
        alive = comp.groupBy("_k").agg(F.min("_comp").alias("lo"), F.max("_comp").alias("hi")).where("lo <> hi")
        if alive.isEmpty():
            break
        way = F.struct("_wt", "_a", "_b", "_ca", "_cb")
        back = edges.select("_k", "_a", "_b", "_ca", "_cb", "_wt")
        out = back.select("_k", F.col("_ca").alias("_comp"), way.alias("_e")).unionByName(
            back.select("_k", F.col("_cb").alias("_comp"), way.alias("_e"))
        )
        listed = cut(out.groupBy("_k", "_comp").agg(F.min("_e").alias("_e")))
        placed = located.join(comp, ["_k", "_id"])
        bound = listed.select("_k", "_comp", F.col("_e._wt").alias("_w"))
        open_points = cut(
            placed.join(bound, ["_k", "_comp"], "left")
            .withColumn("_bound", F.coalesce("_w", F.lit(float("inf"))))
            .where(F.col("_beyond") <= F.col("_bound"))
            .join(alive.select("_k"), "_k", "left_semi")
            .select("_k", "_id", "_v", "_cell", "_comp", "_core", "_bound")
        )
        found = _search_outside(
            index, placed.select("_k", "_id", "_v", "_cell", "_comp", "_core"), open_points, alpha
        )
        straight = F.col("_a") < F.col("_b")
        extra = found.select(
            "_k", "_comp",
            F.struct(
                "_wt", F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"),
                F.when(straight, F.col("_comp")).otherwise(F.col("_cb")).alias("_ca"),
                F.when(straight, F.col("_cb")).otherwise(F.col("_comp")).alias("_cb"),
            ).alias("_e"),
        )
        best = cut(listed.unionByName(extra).groupBy("_k", "_comp").agg(F.min("_e").alias("_e")))
        tree.append(best.select("_k", "_e._a", "_e._b", "_e._wt").distinct())
        other_end = F.when(F.col("_e._ca") == F.col("_comp"), F.col("_e._cb")).otherwise(F.col("_e._ca"))
        merged = collapse(best.select("_k", "_comp", other_end.alias("_to")), ["_k"], "_comp", "_to")
        new = merged.select("_k", F.col("node").alias("_comp"), F.col("root").alias("_new"))
        comp = cut(
            comp.join(new, ["_k", "_comp"], "left").select("_k", "_id", F.coalesce("_new", "_comp").alias("_comp"))
        )
        for side in ("_ca", "_cb"):
            mapping = new.select("_k", F.col("_comp").alias(side), "_new")
            edges = edges.join(mapping, ["_k", side], "left").withColumn(side, F.coalesce("_new", side)).drop("_new")
        edges = cut(edges.where("_ca <> _cb"))
    spark = points.sparkSession
    schema = T.StructType(
        [T.StructField("_k", T.StringType()), *[T.StructField(c, reps.schema["_id"].dataType) for c in ("a", "b")],
         T.StructField("w", T.DoubleType())]
    )
    all_edges = spark.createDataFrame([], schema)
    for part in tree:
        all_edges = all_edges.unionByName(part.select("_k", F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_wt").alias("w")))
    members = base.join(reps.select("_k", "_v", F.col("_id").alias("_rep")), ["_k", "_v"]).select("_k", "_id", "_rep")
    return SpanningTree(cut(all_edges), nodes.select("_k", "_id", "_m", "_core"), cut(members))


def tree_edges(tree: SpanningTree, keys: list[str]) -> DataFrame:
    """Edges of the whole tree: equal vectors hang on their representative at its core distance."""
    twins = tree.members.where("_id <> _rep").join(
        tree.nodes.select("_k", F.col("_id").alias("_rep"), "_core"), ["_k", "_rep"]
    )
    rows = tree.edges.unionByName(
        twins.select("_k", F.col("_rep").alias("a"), F.col("_id").alias("b"), F.col("_core").alias("w"))
    )
    return nb.unkeyed(rows, keys)


def _ranked(sizes: DataFrame) -> DataFrame:
    """Cluster numbers per key: larger first, ties by the smallest member. Runs on one row per cluster."""
    w = Window.partitionBy("_k").orderBy(F.desc("_size"), F.col("_comp"))
    return sizes.withColumn("cluster_id", (F.row_number().over(w) - 1).cast("int"))


def flat_cut(
    tree: SpanningTree, keys: list[str], ident: str, eps: float, min_cluster_size: int = MIN_CLUSTER_SIZE
) -> DataFrame:
    """Clusters at a fixed distance: components of edges up to ``eps`` between points whose core distance allows it."""
    near = tree.edges.where(F.col("w") <= eps)
    linked = components(near, ["_k"], "a", "b").select("_k", F.col("node").alias("_id"), F.col("component").alias("_comp"))
    reps = tree.nodes.join(linked, ["_k", "_id"], "left")
    alone = F.when(F.col("_core") <= eps, F.col("_id"))  # equal vectors may form a cluster of their own
    reps = cut(reps.withColumn("_comp", F.coalesce("_comp", alone)))
    sizes = reps.where("_comp is not null").groupBy("_k", "_comp").agg(F.sum("_m").alias("_size"))
    numbered = _ranked(sizes.where(F.col("_size") >= min_cluster_size))
    labelled = reps.join(numbered.select("_k", "_comp", "cluster_id"), ["_k", "_comp"], "left").select(
        "_k", F.col("_id").alias("_rep"), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id")
    )
    out = tree.members.join(labelled, ["_k", "_rep"]).select("_k", F.col("_id").alias(ident), "cluster_id")
    return nb.unkeyed(out, keys)


@dataclass
class Hierarchy:
    """Condensed cluster tree and, per representative, where it left it."""

    clusters: DataFrame  # _k, cluster, parent, birth, death, stability, size, selected
    points: DataFrame  # _k, _rep, cluster_id, probability, outlier_score


def _dendrogram(tree: SpanningTree) -> tuple[DataFrame, DataFrame]:
    """Exact single-linkage tree of the spanning tree, by contracting it in log n rounds of joins.

    Edges are ordered by weight, then by their ends. In a round every supervertex is contracted along its least edge. A
    contracted edge settles in the chain of the supervertex it lies in as soon as it is less than all edges that leave
    that vertex, else it waits for the next round; the edges of a chain follow each other upwards, and above the last
    comes the least edge that leaves the vertex. First frame: ``_k, _n`` (edge), ``_up`` (the edge that merges its component
    next), ``_size, _low`` (members and smallest representative of the component). Second: ``_k, _rep, _up`` of all
    representatives that have an edge.
    """
    live = cut(tree.edges.select("_k", F.struct("w", "a", "b").alias("_n"), F.col("a").alias("_u"), F.col("b").alias("_v")))
    waiting = live.select("_k", "_n", F.col("_u").alias("_s")).limit(0)
    settled, tops, level = [], [], 0
    while True:
        ends = live.select("_k", F.col("_u").alias("_s"), F.struct("_n", F.col("_v").alias("_to")).alias("_e")).unionByName(
            live.select("_k", F.col("_v").alias("_s"), F.struct("_n", F.col("_u").alias("_to")).alias("_e"))
        )
        best = cut(ends.groupBy("_k", "_s").agg(F.min("_e").alias("_e")).select("_k", "_s", F.col("_e._n").alias("_f"), "_e._to"))
        tops.append(best.select("_k", F.lit(level).alias("_l"), "_s", "_f"))
        placed = waiting.join(best.select("_k", "_s", "_f"), ["_k", "_s"], "left")
        here = F.col("_f").isNull() | (F.col("_n") < F.col("_f"))
        settled.append(cut(placed.where(here).select("_k", F.lit(level).alias("_l"), "_s", "_n")))
        if best.isEmpty():
            break
        root = collapse(best, ["_k"], "_s", "_to").select("_k", F.col("node").alias("_s"), F.col("root").alias("_r"))
        least = best.select("_k", F.col("_f").alias("_n")).distinct()
        rest = placed.where(~here).select("_k", "_n", "_s").unionByName(
            live.join(least, ["_k", "_n"], "left_semi").select("_k", "_n", F.col("_u").alias("_s"))
        )
        waiting = cut(rest.join(root, ["_k", "_s"]).select("_k", "_n", F.col("_r").alias("_s")))
        live = live.join(least, ["_k", "_n"], "left_anti")
        for side in ("_u", "_v"):
            live = live.join(root.withColumnRenamed("_s", side), ["_k", side]).drop(side).withColumnRenamed("_r", side)
        live = cut(live)
        level += 1
    chains, above = settled[0], tops[0]
    for part, top in zip(settled[1:], tops[1:]):
        chains, above = chains.unionByName(part), above.unionByName(top)
    above = cut(above)
    # a chain may hold most edges of a key: it is dealt in ranges, whose first edges and sums join up afterwards
    chain = ["_k", "_l", "_s"]
    chains = cut(chains.repartitionByRange(*chain, "_n").withColumn("_p", F.spark_partition_id()))
    inside = Window.partitionBy(*chain, "_p").orderBy("_n")
    after = Window.partitionBy(*chain).orderBy("_first")
    ranges = cut(chains.groupBy(*chain, "_p").agg(F.min("_n").alias("_first")))
    chains = chains.withColumn("_next", F.lead("_n").over(inside)).join(
        ranges.withColumn("_then", F.lead("_first").over(after)), [*chain, "_p"]
    )
    chains = cut(
        chains.join(above, chain, "left").select(*chain, "_p", "_n", "_first", F.coalesce("_next", "_then", "_f").alias("_up"))
    )
    leaves = cut(above.where("_l = 0").select("_k", F.col("_s").alias("_rep"), F.col("_f").alias("_up")))
    whole = tree.nodes.select("_k", F.col("_id").alias("_rep"), F.col("_m").cast("long").alias("_size"))
    hung = cut(leaves.join(whole, ["_k", "_rep"]).groupBy("_k", F.col("_up").alias("_n")).agg(
        F.sum("_size").alias("_size"), F.min("_rep").alias("_low")
    ))
    parts = [chains.limit(0).select("_k", "_n", "_up", F.lit(0).cast("long").alias("_size"), F.col("_s").alias("_low"))]
    # members, chain by chain: whatever hangs on the edges of a chain was settled in an earlier round
    for now in range(1, level + 1):
        mine = chains.where(F.col("_l") == now).join(hung, ["_k", "_n"], "left")
        mine = cut(mine.withColumns({"_size": F.sum("_size").over(inside), "_low": F.min("_low").over(inside)}))
        before = Window.partitionBy(*chain).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
        sums = mine.groupBy(*chain, "_p", "_first").agg(F.max("_size").alias("_size"), F.min("_low").alias("_low"))
        sums = sums.select(*chain, "_p", F.sum("_size").over(before).alias("_ds"), F.min("_low").over(before).alias("_dl"))
        mine = cut(mine.join(sums, [*chain, "_p"]).select(
            *chain, "_n", "_up", (F.coalesce("_size", F.lit(0)) + F.coalesce("_ds", F.lit(0))).alias("_size"),
            F.least("_low", "_dl").alias("_low"),
        ))
        parts.append(mine.select("_k", "_n", "_up", "_size", "_low"))
        done = mine.groupBy(*chain).agg(F.max("_size").alias("_size"), F.min("_low").alias("_low"))
        done = done.join(above, chain).select("_k", F.col("_f").alias("_n"), "_size", "_low")
        hung = cut(hung.unionByName(done).groupBy("_k", "_n").agg(F.sum("_size").alias("_size"), F.min("_low").alias("_low")))
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    return cut(nodes), leaves


def hierarchy(
    tree: SpanningTree,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    method: str = "eom",
    eps: float = 0.0,
) -> Hierarchy:
    """Cluster hierarchy: the exact single-linkage tree, condensed to components of at least ``min_cluster_size`` members.

    Exact for any number of distinct weights; edges of equal weight part at once. A cluster is named by the weight at
    which it is whole and its smallest representative.
    """
    if method not in ("eom", "leaf"):
        raise ValueError(f"unknown method {method!r}")
    joins, leaves = _dendrogram(tree)
    # a representative with enough members is a cluster by itself as long as its core distance allows
    big = tree.nodes.where(F.col("_m") >= min_cluster_size).select(
        "_k", F.col("_id").alias("_rep"), F.struct(F.col("_core").alias("w"), F.col("_id").alias("a"), F.col("_id").alias("b")).alias("_n"),
        F.col("_m").cast("long").alias("_size"), F.col("_id").alias("_low"),
    )
    big = cut(big.join(leaves, ["_k", "_rep"], "left"))
    kept = cut(joins.where(F.col("_size") >= min_cluster_size).unionByName(big.drop("_rep")))
    # edges of equal weight that follow each other are one component
    tied = F.coalesce(F.col("_up.w") == F.col("_n.w"), F.lit(False))
    same = collapse(kept.select("_k", "_n", F.when(tied, F.col("_up")).otherwise(F.col("_n")).alias("_to")), ["_k"], "_n", "_to")
    same = cut(same.select("_k", F.col("node").alias("_n"), F.col("root").alias("_top")))
    whole = kept.where(~tied).join(same.select("_k", F.col("_n").alias("_up"), F.col("_top").alias("_over")), ["_k", "_up"], "left")
    whole = whole.select("_k", "_n", F.col("_over").alias("_up"), "_size", "_low")
    kids = whole.where("_up is not null").groupBy("_k", "_up").agg(F.count("*").alias("_kids"))
    starts = F.col("_up").isNull() | (F.col("_kids") > 1)
    lam = 1.0 / F.greatest("_n.w", F.lit(TINY))
    born = F.when(F.col("_up").isNull(), 0.0).otherwise(1.0 / F.greatest("_up.w", F.lit(TINY)))
    whole = cut(whole.join(kids, ["_k", "_up"], "left").select(
        "_k", "_n", "_up", "_size", "_low", starts.alias("_starts"), lam.alias("_lam"), born.alias("_prev")
    ))
    # a cluster runs along an unbranched stretch, from the component that starts it
    run = collapse(whole.select("_k", "_n", F.when(F.col("_starts"), F.col("_n")).otherwise(F.col("_up")).alias("_to")), ["_k"], "_n", "_to")
    head = whole.where("_starts").select("_k", F.col("_n").alias("root"), F.struct(F.col("_n.w").alias("w"), F.col("_low").alias("c")).alias("cluster"))
    run = cut(run.join(head, ["_k", "root"]).select("_k", F.col("node").alias("_n"), "cluster"))
    chain = cut(whole.join(run, ["_k", "_n"]))
    grown = chain.groupBy("_k", "cluster").agg(
        F.sum(F.col("_size") * (F.col("_lam") - F.col("_prev"))).alias("stability"),
        F.min("_prev").alias("birth"), F.max("_lam").alias("death"),
        F.max(F.when(F.col("_starts"), F.col("_size"))).alias("size"),
        F.max(F.when(F.col("_starts"), F.col("_up"))).alias("_parent"),
    )
    owner = run.select("_k", F.col("_n").alias("_parent"), F.col("cluster").alias("parent"))
    nodes = cut(grown.join(owner, ["_k", "_parent"], "left").drop("_parent"))

    state = _select(nodes, method, eps)
    # points: the smallest kept component around each, and the level at which they left their selected cluster
    top = joins.join(kept.select("_k", "_n"), ["_k", "_n"], "left_anti").select("_k", "_n", F.coalesce("_up", "_n").alias("_to"))
    climb = collapse(top.unionByName(kept.select("_k", "_n", F.col("_n").alias("_to"))), ["_k"], "_n", "_to")
    lone = big.select("_k", "_rep", F.col("_n").alias("_up"))
    first = leaves.join(big, ["_k", "_rep"], "left_anti").select("_k", "_rep", "_up").unionByName(lone)
    first = first.join(climb.select("_k", F.col("node").alias("_up"), F.col("root").alias("_n")), ["_k", "_up"])
    first = first.join(same, ["_k", "_n"]).select("_k", "_rep", F.col("_top").alias("_n"))
    deepest = cut(
        first.join(chain.select("_k", "_n", "cluster", F.col("_lam").alias("_leave")), ["_k", "_n"]).select("_k", "_rep", "_leave", "cluster")
    )
    scored = deepest.join(state.select("_k", "cluster", "deepest_death"), ["_k", "cluster"]).select(
        "_k", "_rep",
        F.greatest(F.lit(0.0), (F.col("deepest_death") - F.col("_leave")) / F.col("deepest_death")).alias("outlier_score"),
    )
    chosen = cut(state.where("selected"))
    w = Window.partitionBy("_k").orderBy(F.desc("size"), F.col("cluster.c"))
    ids = chosen.withColumn("cluster_id", (F.row_number().over(w) - 1).cast("int"))
    ends = F.when(F.col("selected") | F.col("parent").isNull(), F.col("cluster")).otherwise(F.col("parent"))
    within = collapse(state.select("_k", "cluster", ends.alias("_to")), ["_k"], "cluster", "_to")
    within = within.select("_k", F.col("node").alias("cluster"), F.col("root").alias("_in"))
    # a point that went on into a cluster below was in its selected cluster to the end
    in_chosen = deepest.join(within, ["_k", "cluster"]).join(
        ids.select("_k", F.col("cluster").alias("_in"), "cluster_id", "death"), ["_k", "_in"]
    )
    left = F.when(F.col("cluster") == F.col("_in"), F.col("_leave")).otherwise(F.col("death"))
    labels = in_chosen.select("_k", "_rep", "cluster_id", (left / F.col("death")).alias("probability"), left.alias("lambda"))
    reps = tree.nodes.select("_k", F.col("_id").alias("_rep"), F.col("_core").alias("core_distance"))
    points = (
        reps.join(labels, ["_k", "_rep"], "left")
        .join(scored, ["_k", "_rep"], "left")
        .select(
            "_k", "_rep", "core_distance", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"),
            F.coalesce(F.least("probability", F.lit(1.0)), F.lit(0.0)).alias("probability"),
            F.coalesce("lambda", F.lit(0.0)).alias("lambda"),
            F.coalesce("outlier_score", F.lit(1.0)).alias("outlier_score"),
        )
    )
    selected = state.join(ids.select("_k", "cluster", "cluster_id"), ["_k", "cluster"], "left")
    return Hierarchy(cut(selected), cut(points))


def _subtree_values(nodes: DataFrame) -> DataFrame:
    """``_kids, _best, deepest_death`` of every cluster, by contracting the tree in log n rounds.

    The best choice below a cluster is ``max(stability, sum over its children)``. Rake: a cluster whose children have all
    settled settles. Compress: a cluster with one open child is the map ``x -> max(a, b + x)`` of that child's value; such
    maps compose to maps of the same kind, so chains of them halve in every round, however deep the tree is.
    """
    state = cut(nodes.select(
        "_k", "cluster", "parent", "stability", "death", F.lit(None).cast("double").alias("_best"),
        F.lit(None).cast("double").alias("deepest_death"), F.lit(0).cast("long").alias("_kids"),
        F.lit(None).cast(nodes.schema["cluster"].dataType).alias("_to"), *(F.lit(None).cast("double").alias(c) for c in ("_a", "_b", "_d")),
    ))
    while True:
        open_ = F.col("_best").isNull()
        below = state.where("parent is not null").groupBy("_k", F.col("parent").alias("cluster")).agg(
            F.count("*").alias("_n"), F.count(F.when(open_, 1)).alias("_open"), F.max(F.when(open_, F.col("cluster"))).alias("_child"),
            F.coalesce(F.sum("_best"), F.lit(0.0)).alias("_sum"), F.max("deepest_death").alias("_deep"),
        )
        seen = state.join(below, ["_k", "cluster"], "left")
        left = F.coalesce("_open", F.lit(0))
        rake, chain = open_ & (left == 0), open_ & (left == 1) & F.col("_to").isNull()
        sums, deep = F.coalesce("_sum", F.lit(0.0)), F.greatest("death", "_deep")  # ``greatest`` skips nulls
        raked = cut(seen.select(
            "_k", "cluster", "parent", "stability", "death",
            F.when(rake, F.greatest("stability", sums)).otherwise(F.col("_best")).alias("_best"),
            F.when(rake, deep).otherwise(F.col("deepest_death")).alias("deepest_death"),
            F.coalesce("_n", F.lit(0)).alias("_kids"),
            F.when(chain, F.col("_child")).otherwise(F.col("_to")).alias("_to"),
            F.when(chain, F.col("stability")).otherwise(F.col("_a")).alias("_a"),
            F.when(chain, sums).otherwise(F.col("_b")).alias("_b"),
            F.when(chain, deep).otherwise(F.col("_d")).alias("_d"),
        ))
        at = raked.select(
            "_k", F.col("cluster").alias("_to"), F.col("_best").alias("_x"), F.col("deepest_death").alias("_xd"),
            F.col("_to").alias("_to2"), F.col("_a").alias("_a2"), F.col("_b").alias("_b2"), F.col("_d").alias("_d2"),
        )
        joined = raked.join(at, ["_k", "_to"], "left")
        waits = F.col("_best").isNull() & F.col("_to").isNotNull()
        done, hop = waits & F.col("_x").isNotNull(), waits & F.col("_x").isNull() & F.col("_to2").isNotNull()
        state = cut(joined.select(
            "_k", "cluster", "parent", "stability", "death",
            F.when(done, F.greatest("_a", F.col("_b") + F.col("_x"))).otherwise(F.col("_best")).alias("_best"),
            F.when(done, F.greatest("_d", "_xd")).otherwise(F.col("deepest_death")).alias("deepest_death"), "_kids",
            F.when(hop, F.col("_to2")).otherwise(F.col("_to")).alias("_to"),
            F.when(hop, F.greatest("_a", F.col("_b") + F.col("_a2"))).otherwise(F.col("_a")).alias("_a"),
            F.when(hop, F.col("_b") + F.col("_b2")).otherwise(F.col("_b")).alias("_b"),
            F.when(hop, F.greatest("_d", "_d2")).otherwise(F.col("_d")).alias("_d"),
        ))
        if state.where("_best is null").isEmpty():
            return state.drop("_to", "_a", "_b", "_d")


def _under_a_pick(state: DataFrame) -> DataFrame:
    """``_k, cluster, _under``: has something above it been picked? Pointers to ancestors double in every round."""
    at = cut(state.select("_k", "cluster", F.col("parent").alias("_up"), F.lit(False).alias("_under")))
    picks = state.select("_k", F.col("cluster").alias("_up"), "_picks")
    while not at.where("_up is not null").isEmpty():
        hop = at.select("_k", F.col("cluster").alias("_up"), F.col("_up").alias("_next"), F.col("_under").alias("_more"))
        joined = at.join(hop.join(picks, ["_k", "_up"]), ["_k", "_up"], "left")
        gained = F.coalesce(F.col("_picks") | F.col("_more"), F.lit(False))
        at = cut(joined.select("_k", "cluster", F.col("_next").alias("_up"), (F.col("_under") | gained).alias("_under")))
    return at.drop("_up")


def _select(nodes: DataFrame, method: str, eps: float) -> DataFrame:
    """Choose clusters: bottom-up by stability, or the leaves; the root of a key is never chosen. Log n rounds of joins."""
    values = _subtree_values(nodes)
    sums = values.where("parent is not null").groupBy("_k", F.col("parent").alias("cluster")).agg(F.sum("_best").alias("_sum"))
    picks = (F.col("_kids") == 0) if method == "leaf" else F.coalesce(F.col("_sum") <= F.col("stability"), F.lit(True))
    known = values.join(sums, ["_k", "cluster"], "left").select(
        "_k", "cluster", "deepest_death", (picks & F.col("parent").isNotNull()).alias("_picks")
    )
    state = cut(nodes.join(known, ["_k", "cluster"]))
    under = _under_a_pick(state)
    state = state.join(under, ["_k", "cluster"]).withColumn("selected", F.col("_picks") & ~F.col("_under"))
    state = cut(state.drop("_picks", "_under"))
    return _merge_below(state, eps) if eps > 0 else state


def _merge_below(state: DataFrame, eps: float) -> DataFrame:
    """Selected clusters that were born below ``eps`` climb to the first ancestor born above it, below the root at most."""
    born = F.when(F.col("birth") > 0, 1.0 / F.col("birth")).otherwise(F.lit(float("inf")))
    tops = state.select("_k", F.col("cluster").alias("parent"), F.col("parent").isNotNull().alias("_below_root"))
    climbs = (born < eps) & F.coalesce("_below_root", F.lit(False))
    step = state.join(tops, ["_k", "parent"], "left").select(
        "_k", "cluster", F.when(climbs, F.col("parent")).otherwise(F.col("cluster")).alias("_to")
    )
    ends = collapse(step, ["_k"], "cluster", "_to").select("_k", F.col("node").alias("cluster"), F.col("root").alias("_end"))
    chosen = state.where("selected").join(ends, ["_k", "cluster"]).select("_k", F.col("_end").alias("cluster")).distinct()
    return state.drop("selected").join(chosen.withColumn("selected", F.lit(True)), ["_k", "cluster"], "left").withColumn(
        "selected", F.coalesce("selected", F.lit(False))
    )


def cluster(
    points: DataFrame,
    keys: list[str],
    ident: str,
    vec: str,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES,
    method: str = "eom",
    eps: float = 0.0,
    metric: str = "euclidean",
    alpha: float = 1.0,
    cell_rows: int = nb.CELL_ROWS,
) -> DataFrame:
    """Cluster number, membership probability and outlier score of every point; -1 is noise."""
    tree = spanning_tree(points, keys, ident, vec, min_samples, metric, alpha, cell_rows=cell_rows)
    return assignments(tree, hierarchy(tree, min_cluster_size, method, eps), keys, ident)


def assignments(tree: SpanningTree, h: Hierarchy, keys: list[str], ident: str) -> DataFrame:
    joined = tree.members.join(h.points, ["_k", "_rep"])
    return nb.unkeyed(
        joined.select("_k", F.col("_id").alias(ident), "cluster_id", "probability", "lambda", "outlier_score", "core_distance"),
        keys,
    )


def predict(
    queries: DataFrame,
    model: DataFrame,
    keys: list[str],
    ident: str,
    vec: str,
    min_samples: int = MIN_SAMPLES,
    metric: str = "euclidean",
    cell_rows: int = nb.CELL_ROWS,
) -> DataFrame:
    """Cluster of new points: that of the training point nearest in mutual reachability.

    ``model`` has the training vectors with ``cluster_id, core_distance, lambda``. A point that is farther out than any
    member of its cluster was is noise. Columns: keys, ident, cluster_id, strength, nearest, distance.
    """
    k = 2 * min_samples
    nn = nb.neighbours(model, keys, ident, vec, k, metric, queries=queries, cell_rows=cell_rows)
    core = nn.where(F.col("rank") == min_samples).select(*keys, ident, F.col("distance").alias("_core"))
    far = nn.groupBy(*keys, ident).agg(F.max("distance").alias("_far"))
    facts = model.select(*keys, F.col(ident).alias("neighbour"), "cluster_id", "core_distance", "lambda")
    joined = nn.join(far, [*keys, ident]).join(core, [*keys, ident], "left").join(facts, [*keys, "neighbour"])
    reach = F.greatest(F.coalesce("_core", "_far"), "core_distance", "distance")
    near = F.struct(reach.alias("reach"), F.col("rank"), F.col("cluster_id"), F.col("neighbour"), F.col("distance"))
    best = joined.groupBy(*keys, ident).agg(F.min(near).alias("m"))
    spans = model.where("cluster_id >= 0").groupBy(*keys, "cluster_id").agg(
        F.min("lambda").alias("_low"), F.max("lambda").alias("_high")
    )
    lam = 1.0 / F.greatest("reach", F.lit(TINY))
    flat = best.select(*keys, ident, "m.*").join(spans, [*keys, "cluster_id"], "left")
    inside = (F.col("cluster_id") >= 0) & (lam >= F.col("_low"))
    return flat.select(
        *keys, ident,
        F.when(inside, F.col("cluster_id")).otherwise(-1).cast("int").alias("cluster_id"),
        F.when(inside, F.least(lam / F.col("_high"), F.lit(1.0))).otherwise(0.0).alias("strength"),
        F.col("neighbour").alias("nearest"), "distance",
    )
