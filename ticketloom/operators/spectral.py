"""Neighbour embedding: leading eigenvectors of the normalised Laplacian of a weighted graph, all keys in the same jobs.

The graph stays an edge table and the vectors a node table. A block of vectors is multiplied by the normalised weights
``D^-1/2 W D^-1/2`` through a join, a Chebyshev polynomial of which damps everything below the block's least Ritz value,
and a Rayleigh-Ritz step rotates the block: only a few numbers per key (products of the block's columns) meet in one
place. It is block power iteration with fewer rounds for the same multiplications.

A multiplication by joins costs a shuffle, whatever the size of a key, and a long thin graph takes hundreds of them. A key
of at most ``LOCAL_ENTRIES`` entries is therefore iterated inside a task, many keys at a time; larger ones go by joins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.operators.arrow_blocks import array
from ticketloom.runtime import cut

# Components of the layout.
COMPONENTS = 2
#: Vectors that are iterated beyond those asked for; they take up the slow directions.
GUARD = 4
#: Multiplications between two Rayleigh-Ritz steps, and how much further than the others they may carry one vector.
DEGREE = 16
SPREAD = 1e5
TOLERANCE = 1e-3
MAX_ROUNDS = 30
#: Entries of the matrix of a key (about 100 bytes each at work) up to which it is iterated inside a task, and the
#: multiplications between two Rayleigh-Ritz steps there.
LOCAL_ENTRIES = 1 << 20
LOCAL_DEGREE = 256


@dataclass
class Spectrum:
    """``vectors``: keys, node, component, value. ``values``: keys, component, eigenvalue, residual."""

    vectors: DataFrame
    values: DataFrame


def normalised(graph: DataFrame, keys: list[str], a: str, b: str, weight: str) -> tuple[DataFrame, DataFrame]:
    """Both directions of the edges with weights over the roots of the degrees, and the nodes with their degrees."""
    pairs = graph.select(*keys, F.col(a).alias("_a"), F.col(b).alias("_b"), F.col(weight).cast("double").alias("_w")).where("_a <> _b")
    both = pairs.unionByName(pairs.select(*keys, F.col("_b").alias("_a"), F.col("_a").alias("_b"), "_w"))
    edges = cut(both.groupBy(*keys, "_a", "_b").agg(F.sum("_w").alias("_w")).where("_w > 0"))
    nodes = cut(edges.groupBy(*keys, "_a").agg(F.sum("_w").alias("_d")))
    far = nodes.select(*keys, F.col("_a").alias("_b"), F.col("_d").alias("_e"))
    scaled = edges.join(nodes, [*keys, "_a"]).join(far, [*keys, "_b"])
    return scaled.select(*keys, "_a", "_b", (F.col("_w") / F.sqrt(F.col("_d") * F.col("_e"))).alias("_s")), nodes


def _products(left: list[Column], right: list[Column]) -> Column:
    """Sums of all products of two blocks of columns, row by row."""
    return F.array(*(F.sum(p * q) for p in left for q in right))


def _rotated(gram: np.ndarray, image: np.ndarray, square: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values in descending order, their residuals and the rotation; the constant vector is taken out."""
    gram, image, square = (m - np.outer(share, share) for m in (gram, image, square))
    sizes, axes = np.linalg.eigh((gram + gram.T) / 2)
    good = sizes > max(sizes.max(), 0) * 1e-12
    white = axes[:, good] / np.sqrt(sizes[good])
    values, turn = np.linalg.eigh(white.T @ ((image + image.T) / 2) @ white)
    order = np.argsort(-values, kind="stable")
    values, rotation = values[order], (white @ turn)[:, order]
    gap = np.einsum("ij,ik,kj->j", rotation, square, rotation) - values**2
    return values, np.sqrt(np.maximum(gap, 0.0)), rotation


def _ritz(width: int, wanted: int):
    """Rotation of a block onto its Ritz vectors, from the products of its columns."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        row = frame.iloc[0]
        gram, image, square = (np.asarray(row[c], float).reshape(width, width) for c in ("_g", "_h", "_q"))
        share = np.asarray(row["_c"], float)
        values, residual, rotation = _rotated(gram, image, square, share)
        wide = np.zeros((width, width))
        wide[:, : rotation.shape[1]] = rotation
        frame = frame.iloc[:1].copy()
        frame["_rotation"], frame["_share"] = [wide.ravel().tolist()], [share.tolist()]
        frame["_values"], frame["_residuals"] = [values.tolist()], [residual.tolist()]
        frame["_floor"] = float(values[-1]) if len(values) > wanted else 0.0
        return frame[[c for c in frame.columns if c not in ("_g", "_h", "_q", "_c")]]

    return solve


def _inside(keys: list[str], width: int, wanted: int, tolerance: float, max_rounds: int):
    """The same iteration for one key of bounded size: its entries, and a row per node with the constant vector ``_t``."""

    def solve(table: pa.Table) -> pa.Table:
        own = table.filter(pc.is_valid(table.column("_t")))
        own = own.take(pc.sort_indices(own.column("_a")))
        nodes, t = own.column("_a").combine_chunks(), array(own.column("_t"))
        entries = table.filter(pc.is_null(table.column("_t")))
        at = array(pc.index_in(entries.column("_a").combine_chunks(), value_set=nodes))
        to = array(pc.index_in(entries.column("_b").combine_chunks(), value_set=nodes))
        by = np.lexsort((to, at))
        at, to, s = at[by], to[by], array(entries.column("_s"))[by, None]
        starts = np.searchsorted(at, np.arange(len(nodes)))  # every node has an entry

        def times(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(s * x[to], starts)

        x = np.random.default_rng(len(nodes)).uniform(-1, 1, (len(nodes), width))
        for step in range(max_rounds):
            y = times(x)
            share = t @ x
            values, residuals, rotation = _rotated(x.T @ x, x.T @ y, y.T @ y, share)
            x = np.pad((x - np.outer(t, share)) @ rotation, ((0, 0), (0, width - rotation.shape[1])))
            if step == max_rounds - 1 or not (residuals[:wanted] > tolerance).any():
                break
            floor = max(-0.5, min(float(values[-1]) if len(values) > wanted else 0.0, 1 - 1e-9))
            half, centre = (floor + 1) / 2, (floor - 1) / 2
            old = np.zeros_like(x)
            for n in range(max(1, min(LOCAL_DEGREE, int(np.arccosh(SPREAD) / np.arccosh((3 - floor) / (1 + floor)))))):
                x, old = (1.0 if n == 0 else 2.0) / half * (times(x) - centre * x) - old, x
        n = len(nodes)
        once = [[v.tolist()] + [None] * (n - 1) for v in (values, residuals)]
        lists = pa.list_(pa.float64())
        return pa.table(
            [*(own.column(k) for k in keys), nodes, pa.array(x[:, :wanted].tolist(), lists), *(pa.array(o, lists) for o in once)],
            names=[*keys, "_a", "_x", "_values", "_residuals"],
        )

    return solve


def eigenvectors(
    graph: DataFrame,
    keys: list[str],
    a: str = "a",
    b: str = "b",
    weight: str = "weight",
    node: str = "id",
    components: int = COMPONENTS,
    tolerance: float = TOLERANCE,
    max_rounds: int = MAX_ROUNDS,
) -> Spectrum:
    """Eigenvectors of ``D^-1/2 W D^-1/2`` with the largest eigenvalues, the trivial one (root of the degrees) left out.

    Vectors have unit length per key; their largest entry in size is positive, ties by the largest node. ``residual``
    is the length of ``A x - value x``. A key has at most as many components as nodes less one. Nodes without an edge are
    no part of the graph.
    """
    if not keys:
        found = eigenvectors(graph.withColumn("_one", F.lit(0)), ["_one"], a, b, weight, node, components, tolerance, max_rounds)
        return Spectrum(found.vectors.drop("_one"), found.values.drop("_one"))
    width = components + GUARD
    names = [f"_x{j}" for j in range(width)]
    old = [f"_y{j}" for j in range(width)]
    edges, nodes = normalised(graph, keys, a, b, weight)
    kinds = {f.name: f.dataType.simpleString() for f in edges.schema}
    kind = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    total = nodes.groupBy(*keys).agg(F.sum("_d").alias("_all"))
    base = nodes.join(total, keys).withColumn("_t", F.sqrt(F.col("_d") / F.col("_all")))
    sizes = cut(edges.groupBy(*keys).agg(F.count("*").alias("_n")))
    small, large = (sizes.where(f"_n {sign} {LOCAL_ENTRIES}").select(*keys) for sign in ("<=", ">"))
    rows = edges.withColumn("_t", F.lit(None).cast("double")).unionByName(
        base.select(*keys, "_a", F.col("_a").alias("_b"), F.lit(0.0).alias("_s"), "_t")
    )
    # little data, much work: adaptive execution would put all keys into one task
    dealt = rows.join(small, keys, "left_semi").repartition(max(1, min(1000, small.count())), *keys)
    solved = cut(dealt.groupBy(*keys).applyInArrow(
        _inside(keys, width, components, tolerance, max_rounds),
        f"{kind}, _a {kinds['_a']}, _x array<double>, _values array<double>, _residuals array<double>",
    ))
    settled = [solved.select(*keys, F.col("_a").alias(node), F.posexplode("_x"))]
    models = [solved.where("_values is not null").select(*keys, "_values", "_residuals")]
    rounds = 0 if large.isEmpty() else max_rounds
    edges, nodes, base = (f.join(large, keys, "left_semi") for f in (edges, nodes, base))
    # a node is its own neighbour with weight 0 and ``_own`` 1, so that a multiplication reads the vectors once
    loops = nodes.select(*keys, "_a", F.col("_a").alias("_b"), F.lit(0.0).alias("_s"), F.lit(1.0).alias("_own"))
    edges = edges.withColumn("_own", F.lit(0.0)).unionByName(loops).repartition(*keys, "_b").persist()
    table = f"{kind}, _rotation array<double>, _share array<double>, _values array<double>, _residuals array<double>, _floor double"
    seeds = [(F.pmod(F.xxhash64("_a", F.lit(j)), F.lit(2_000_003)) / 1_000_001.5 - 1).alias(n) for j, n in enumerate(names)]
    block = cut(base.select(*keys, "_a", "_t", *seeds)) if rounds else base

    own, s = F.col("_own"), F.col("_s")

    def times(frame: DataFrame, extra: list[str]) -> DataFrame:
        """Every node's row at all of its neighbours and at itself."""
        source = frame.select(*keys, F.col("_a").alias("_b"), "_t", *names, *extra)
        return edges.join(source, [*keys, "_b"])

    def filtered(frame: DataFrame, degree: int) -> DataFrame:
        """Chebyshev polynomial over the spectrum between -1 and the floor of the key."""
        half, centre = (F.col("_floor") + 1) / 2, (F.col("_floor") - 1) / 2
        now = frame.select(*keys, "_a", "_t", "_floor", *names, *(F.lit(0.0).alias(o) for o in old))
        for n in range(degree):
            scale = F.lit(1.0 if n == 0 else 2.0) / half
            now = times(now, ["_floor", *old]).groupBy(*keys, "_a").agg(
                F.max(F.when(own == 1, F.col("_t"))).alias("_t"), F.max("_floor").alias("_floor"),
                *(F.sum(scale * (s - own * centre) * F.col(x) - own * F.col(o)).alias(x) for x, o in zip(names, old)),
                *(F.sum(own * F.col(x)).alias(o) for x, o in zip(names, old)),
            )
        return now

    worst = F.array_max(F.slice("_residuals", 1, components))
    lowest = None
    for step in range(rounds):
        if step:
            # the least floor of any key tells how far a polynomial drives the block apart
            gain = np.arccosh((3 - lowest) / (1 + lowest))
            block = cut(filtered(block, max(1, min(DEGREE, int(np.arccosh(SPREAD) / gain)))).select(*keys, "_a", "_t", *names))
        both = times(block, []).groupBy(*keys, "_a").agg(
            F.max(F.when(own == 1, F.col("_t"))).alias("_t"),
            *(F.sum(own * F.col(x)).alias(x) for x in names), *(F.sum(s * F.col(x)).alias(o) for x, o in zip(names, old)),
        )
        x, y = [F.col(c) for c in names], [F.col(c) for c in old]
        parts = [_products(x, x).alias("_g"), _products(x, y).alias("_h"), _products(y, y).alias("_q"),
                 F.array(*(F.sum(F.col("_t") * c) for c in x)).alias("_c")]
        model = cut(both.groupBy(*keys).agg(*parts).groupBy(*keys).applyInPandas(_ritz(width, components), table))
        turn = model.select(*keys, "_rotation", "_share", "_floor", (worst > tolerance).alias("_open"))
        clean = [F.col(c) - F.col("_t") * F.get("_share", F.lit(j)) for j, c in enumerate(names)]

        def turned(j: int) -> Column:
            out = F.lit(0.0)
            for i, c in enumerate(clean):
                out = out + c * F.get("_rotation", F.lit(i * width + j))
            return out

        floor = F.greatest(F.lit(-0.5), F.least("_floor", F.lit(0.999))).alias("_floor")
        columns = [turned(j).alias(c) for j, c in enumerate(names)]
        block = cut(block.drop("_floor").join(turn, keys).select(*keys, "_a", "_t", floor, F.coalesce("_open", F.lit(False)).alias("_open"), *columns))
        last = step == max_rounds - 1
        stay = F.lit(True) if last else ~F.col("_open")
        settled.append(block.where(stay).select(*keys, F.col("_a").alias(node), F.posexplode(F.array(*names[:components]))))
        model = model if last else model.where(~F.coalesce(worst > tolerance, F.lit(False)))
        models.append(model.select(*keys, "_values", "_residuals"))
        block = block.where("_open").drop("_open")
        lowest = block.agg(F.min("_floor")).first()[0]
        if lowest is None:
            break
    edges.unpersist()
    model, entries = models[0], settled[0]
    for m, e in zip(models[1:], settled[1:]):
        model, entries = model.unionByName(m), entries.unionByName(e)
    pairs = F.arrays_zip(F.slice("_values", 1, components).alias("v"), F.slice("_residuals", 1, components).alias("r"))
    values = model.select(*keys, F.posexplode(pairs))
    values = values.select(*keys, F.col("pos").alias("component"), F.col("col.v").alias("eigenvalue"), F.col("col.r").alias("residual"))
    long = entries.select(*keys, node, F.col("pos").alias("component"), F.col("col").alias("value"))
    long = long.join(values.select(*keys, "component"), [*keys, "component"])
    # the largest entry in size is positive; rounded, so that mirror images of a vector agree on it
    by = F.max(F.struct(F.round(F.abs("value"), 6).alias("s"), F.col(node).alias("n"), F.signum("value").alias("sign")))
    sign = long.groupBy(*keys, "component").agg(by.alias("_b")).select(*keys, "component", F.col("_b.sign").alias("_sign"))
    signed = long.join(sign, [*keys, "component"])
    return Spectrum(cut(signed.select(*keys, node, "component", (F.col("value") * F.col("_sign")).alias("value"))), values)


def layout(graph: DataFrame, keys: list[str], node: str = "id", components: int = COMPONENTS, **options) -> tuple[DataFrame, DataFrame]:
    """``keys, node, reduced`` (an array, missing components are 0) and the eigenvalues with their residuals."""
    found = eigenvectors(graph, keys, node=node, components=components, **options)
    packed = found.vectors.groupBy(*keys, node).agg(F.map_from_entries(F.collect_list(F.struct("component", "value"))).alias("_m"))
    reduced = F.array(*(F.coalesce(F.try_element_at("_m", F.lit(j)), F.lit(0.0)) for j in range(components)))
    return packed.select(*keys, node, reduced.alias("reduced")), found.values
