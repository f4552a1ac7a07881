"""Dimension reduction: principal components of all keys in one job, with optional neighbourhood smoothing.

The linear layout is deterministic and can be applied to new rows. :func:`graph_layout` places the points of a neighbour
graph (:func:`neighbours.fuzzy_graph`) by the leading eigenvectors of its Laplacian, where a stochastic embedding starts;
the sequential optimisation of such an embedding does not distribute.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import vectors
from ticketloom.operators import neighbours as nb
from ticketloom.operators import spectral
from ticketloom.operators.arrow_blocks import matrix
from ticketloom.runtime import cut

# Defaults of the reduction.
COMPONENTS = 2
NEIGHBOURS = 15


def _partial_products(batches):
    """Per partition and key: rows of X'X and the column sums. Memory is bounded by the dimension, not by the rows."""
    state: dict[str, list] = {}
    for batch in batches:
        keys = np.asarray(batch.column("_k").to_pylist(), dtype=object)
        for key in set(keys):
            x = matrix(batch.column("_v").take(pa.array(np.flatnonzero(keys == key))))
            if key not in state:
                state[key] = [np.zeros((x.shape[1], x.shape[1])), np.zeros(x.shape[1]), 0]
            state[key][0] += x.T @ x
            state[key][1] += x.sum(0)
            state[key][2] += len(x)
    for key, (gram, total, n) in state.items():
        rows = [*gram.tolist(), total.tolist()]
        yield pa.record_batch(
            [pa.array([key] * len(rows)), pa.array([*range(len(gram)), -1], pa.int32()),
             pa.array(rows, pa.list_(pa.float64())), pa.array([0] * len(gram) + [n], pa.int64())],
            names=["_k", "_i", "_row", "_n"],
        )


def fit_components(points: DataFrame, keys: list[str], vec: str, k: int = COMPONENTS) -> DataFrame:
    """Leading principal axes per key: ``keys, component, mean, loadings, variance``.

    Partial products are combined by row index; the eigenproblem of a key has the size of its dimension. The sign of an
    axis is fixed by its largest loading.
    """
    base = points.select(
        F.concat_ws("\u0001", *[F.col(c).cast("string") for c in keys]).alias("_k") if keys else F.lit("").alias("_k"),
        F.col(vec).cast("array<double>").alias("_v"),
    )
    parts = base.mapInArrow(_partial_products, "_k string, _i int, _row array<double>, _n bigint")
    rows = (
        parts.groupBy("_k", "_i")
        .agg(Summarizer.metrics("sum").summary(array_to_vector("_row")).alias("s"), F.sum("_n").alias("_n"))
        .select("_k", "_i", vector_to_array("s.sum").alias("_row"), "_n")
    )

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_i")
        last = frame.iloc[0]
        n, total = int(last._n), np.asarray(last._row)
        gram = np.vstack(frame._row.iloc[1:].to_list())
        mean = total / n
        values, axes = np.linalg.eigh(gram / n - np.outer(mean, mean))
        order = np.argsort(-values, kind="stable")[:k]
        axes = axes[:, order].T
        axes *= np.sign(axes[np.arange(len(order)), np.abs(axes).argmax(1)])[:, None]
        return pd.DataFrame(
            {"_k": last._k, "component": np.arange(len(order), dtype=np.int32), "mean": [mean.tolist()] * len(order),
             "loadings": axes.tolist(), "variance": np.maximum(values[order], 0.0)}
        )

    model = rows.groupBy("_k").applyInPandas(
        solve, "_k string, component int, mean array<double>, loadings array<double>, variance double"
    )
    return nb.unkeyed(model, keys)


def project(points: DataFrame, model: DataFrame, keys: list[str], vec: str, out: str = "reduced") -> DataFrame:
    """Apply fitted axes to old or new rows; adds the reduced vector and its first two coordinates."""
    packed = model.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("component", "mean", "loadings"))).alias("_axes")
    )
    joined = points.join(packed, keys) if keys else points.join(F.broadcast(packed))  # a single row when unkeyed
    centred = F.zip_with(F.col(vec), F.col("_axes")[0]["mean"], lambda x, m: x - m)
    reduced = joined.withColumn("_c", centred).withColumn(
        out, F.transform("_axes", lambda a: vectors.dot(F.col("_c"), a["loadings"]))
    )
    return (
        reduced.withColumn("umap_x", F.get(out, F.lit(0)))
        .withColumn("umap_y", F.get(out, F.lit(1)))
        .drop("_axes", "_c")
    )


def smooth(
    points: DataFrame, graph: DataFrame, keys: list[str], ident: str, reduced: str = "reduced", pull: float = 0.5, rounds: int = 3
) -> DataFrame:
    """Move every point towards the weighted mean of its graph neighbours, a fixed number of times."""
    both = graph.select(*keys, F.col("a").alias(ident), F.col("b").alias("_o"), "weight").unionByName(
        graph.select(*keys, F.col("b").alias(ident), F.col("a").alias("_o"), "weight")
    )
    for _ in range(rounds):
        other = points.select(*keys, F.col(ident).alias("_o"), F.col(reduced).alias("_v"))
        mean = Summarizer.metrics("mean").summary(array_to_vector("_v"), F.col("weight"))
        means = both.join(other, [*keys, "_o"]).groupBy(*keys, ident).agg(mean.alias("_s"))
        means = means.select(*keys, ident, vector_to_array("_s.mean").alias("_m"))
        moved = F.zip_with(reduced, "_m", lambda x, m: x * (1 - pull) + m * pull)
        points = points.join(means, [*keys, ident], "left").withColumn(
            reduced, F.when(F.col("_m").isNull(), F.col(reduced)).otherwise(moved)
        ).drop("_m")
    return points.withColumn("umap_x", F.get(reduced, F.lit(0))).withColumn("umap_y", F.get(reduced, F.lit(1)))


def graph_layout(
    graph: DataFrame, keys: list[str], ident: str, k: int = COMPONENTS, tolerance: float = spectral.TOLERANCE
) -> tuple[DataFrame, DataFrame]:
    """Nodes of a weighted graph ``keys, a, b, weight`` with ``reduced, umap_x, umap_y``, and the spectrum of every key."""
    placed, spectrum = spectral.layout(graph, keys, ident, k, tolerance=tolerance)
    placed = placed.withColumn("umap_x", F.get("reduced", F.lit(0))).withColumn("umap_y", F.get("reduced", F.lit(1)))
    return placed, spectrum


def embedded(
    points: DataFrame, keys: list[str], ident: str, vec: str, k: int = COMPONENTS, n_neighbors: int = NEIGHBOURS, metric: str = "cosine"
) -> tuple[DataFrame, DataFrame]:
    """``points`` placed by the graph of their ``n_neighbors`` nearest neighbours, and the spectrum; lone points lie at 0."""
    near = nb.neighbours(points, keys, ident, vec, n_neighbors, metric)
    placed, spectrum = graph_layout(cut(nb.fuzzy_graph(near, keys, ident, n_neighbors)), keys, ident, k)
    joined = points.join(placed, [*keys, ident], "left")
    origin = F.array_repeat(F.lit(0.0), k)
    return joined.withColumns({
        "reduced": F.coalesce("reduced", origin), "umap_x": F.coalesce("umap_x", F.lit(0.0)), "umap_y": F.coalesce("umap_y", F.lit(0.0)),
    }), spectrum


def parameters(model: DataFrame, keys: list[str]) -> DataFrame:
    """One parameter document per fitted linear model: what the fit used and found."""
    agg = model.groupBy(*keys).agg(
        F.count("*").alias("n_components"), F.max(F.size("mean")).alias("dimensions"),
        F.transform(F.array_sort(F.collect_list(F.struct("component", "variance"))), lambda c: F.round(c["variance"], 6)).alias("variances"),
    )
    doc = F.to_json(F.struct(F.lit("principal components").alias("method"), "n_components", "dimensions", "variances"))
    return agg.select(*keys, doc.alias("payload"))


def graph_parameters(spectrum: DataFrame, keys: list[str], n_neighbors: int = NEIGHBOURS, metric: str = "cosine") -> DataFrame:
    """One parameter document per graph layout: what :func:`embedded` used and found."""
    found = F.array_sort(F.collect_list(F.struct("component", F.round("eigenvalue", 6).alias("eigenvalue"), F.round("residual", 6).alias("residual"))))
    agg = spectrum.groupBy(*keys).agg(F.count("*").alias("n_components"), found.alias("spectrum"))
    fixed = F.struct(
        F.lit("graph").alias("method"), "n_components", F.lit(n_neighbors).alias("n_neighbors"), F.lit(metric).alias("metric"), "spectrum"
    )
    return agg.select(*keys, F.to_json(fixed).alias("payload"))
