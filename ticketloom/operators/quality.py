"""Cluster quality: silhouettes, Calinski-Harabasz, Davies-Bouldin, and the full analysis record."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ticketloom.functions import vectors
from ticketloom.operators.arrow_blocks import array, block_product, matrix, squared_distances
from ticketloom.operators.cluster_stats import cluster_statistics, quality_gate

MODEL_KEYS = ["tech_center", "model_version"]


def _clustered(points: DataFrame, keys: list[str], ident: str, vec: str, metric: str = "euclidean") -> DataFrame:
    v = F.col(vec).cast("array<double>")
    return points.where(F.col("cluster_id") != -1).select(
        *keys, F.col(ident).alias("_id"), F.col("cluster_id").cast("int").alias("_c"),
        (vectors.unit(v) if metric == "cosine" else v).alias("_v"),
    )


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def _average(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of (b - a) / max(a, b) per key; members of one-point clusters count as zero."""
    low = F.greatest("_a", "_b")
    value = F.when(F.col("_a").isNull() | F.col("_b").isNull() | (low == 0), 0.0).otherwise((F.col("_b") - F.col("_a")) / low)
    return scores.groupBy(*keys).agg(
        F.when(F.count("_b") > 0, F.avg(value)).alias("silhouette_score")  # null with fewer than two clusters
    )


def silhouette_exact(
    points: DataFrame, keys: list[str] = MODEL_KEYS, ident: str = "number", vec: str = "embedding", rows: int = 2048
) -> DataFrame:
    """Euclidean silhouette. Blocks of points meet in tasks and leave only distance sums per point and cluster.

    The measure itself needs every distance once, so its work is quadratic in the points of a key; use
    :func:`silhouette_linear` for large keys.
    """
    base = _clustered(points, keys, ident, vec)
    schema = T.StructType(
        [*_key_fields(points, keys), T.StructField("_id", points.schema[ident].dataType),
         T.StructField("_c", T.IntegerType()), T.StructField("_o", T.IntegerType()), T.StructField("_s", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return arrow.empty_table()
        q, p = matrix(left.column("_v")), matrix(right.column("_v"))
        others, code = np.unique(array(right.column("_c")), return_inverse=True)
        member = np.zeros((len(p), len(others)))
        member[np.arange(len(p)), code] = 1.0
        sums = np.empty((len(q), len(others)))
        for i in range(0, len(q), 256):
            part = q[i : i + 256]
            d2 = squared_distances(part, p)
            scale = (part * part).sum(1)[:, None] + (p * p).sum(1)[None, :]
            r, c = np.nonzero(d2 <= 1e-6 * scale)  # near pairs lose digits in the product form
            diff = part[r] - p[c]
            d2[r, c] = (diff * diff).sum(1)
            sums[i : i + 256] = np.sqrt(d2) @ member
        take = pa.array(np.repeat(np.arange(len(q)), len(others)))
        columns = [left.column(k).combine_chunks().take(take) for k in [*keys, "_id", "_c"]]
        return pa.table([*columns, pa.array(np.tile(others, len(q)).astype(np.int32)), pa.array(sums.ravel())], schema=arrow)

    sums = block_product(base, base, keys, kernel, schema, rows)
    sizes = base.groupBy(*keys, F.col("_c").alias("_o")).agg(F.count("*").alias("_n"))
    total = sums.groupBy(*keys, "_id", "_c", "_o").agg(F.sum("_s").alias("_s")).join(sizes, [*keys, "_o"])
    own = F.col("_o") == F.col("_c")
    per_point = total.groupBy(*keys, "_id").agg(
        F.max(F.when(own & (F.col("_n") > 1), F.col("_s") / (F.col("_n") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("_s") / F.col("_n"))).alias("_b"),
    )
    return _average(per_point, keys)


def silhouette_linear(
    points: DataFrame, keys: list[str] = MODEL_KEYS, ident: str = "number", vec: str = "embedding", metric: str = "cosine"
) -> DataFrame:
    """Mean silhouette for the cosine or the squared Euclidean distance, in time linear in the points.

    Mean distances to a cluster follow from its size, vector sum and sum of squares, so points meet clusters, not points.
    """
    if metric not in ("cosine", "sqeuclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    base = _clustered(points, keys, ident, vec, metric)
    square = vectors.dot(F.col("_v"), F.col("_v"))
    clusters = (
        base.withColumn("_sq", square)
        .groupBy(*keys, "_c")
        .agg(
            F.count("*").alias("_n"),
            Summarizer.metrics("sum").summary(array_to_vector("_v")).alias("_t"),
            F.sum("_sq").alias("_q"),
        )
        .select(*keys, F.col("_c").alias("_id"), "_n", vector_to_array("_t.sum").alias("_t"), "_q")
    )
    schema = T.StructType(
        [*_key_fields(points, keys), T.StructField("_id", points.schema[ident].dataType),
         T.StructField("_a", T.DoubleType()), T.StructField("_b", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)
    cosine = metric == "cosine"

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return arrow.empty_table()
        x, own = matrix(left.column("_v")), array(left.column("_c"))
        total, n, q = matrix(right.column("_t")), array(right.column("_n")), array(right.column("_q"))
        label = array(right.column("_id"))
        dot = x @ total.T
        mean = 1.0 - dot / n if cosine else (x * x).sum(1)[:, None] - 2.0 * dot / n + q / n
        mean = np.maximum(mean, 0.0)
        mine = own[:, None] == label[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = np.where(n > 1, mean * n / (n - 1), np.nan)
        a = np.where(mine.any(1), np.take_along_axis(scaled, mine.argmax(1)[:, None], 1)[:, 0], np.nan)
        b = np.where(mine, np.inf, mean).min(1)
        keep = [left.column(k).combine_chunks() for k in [*keys, "_id"]]
        return pa.table(
            [*keep, pa.array(a, mask=np.isnan(a)), pa.array(b, mask=np.isinf(b))], schema=arrow
        )

    met = block_product(base, clusters, keys, kernel, schema)
    per_point = met.groupBy(*keys, "_id").agg(F.max("_a").alias("_a"), F.min("_b").alias("_b"))
    return _average(per_point, keys)


def calinski_harabasz(points: DataFrame, keys: list[str] = MODEL_KEYS, vec: str = "embedding") -> DataFrame:
    """Between-cluster over within-cluster scatter, from per-cluster means and variances alone."""
    m = vectors.moments(points.where(F.col("cluster_id") != -1), [*keys, "cluster_id"], vec)
    weighted = Summarizer.metrics("mean").summary(array_to_vector("mean"), F.col("n").cast("double"))
    centre = m.groupBy(*keys).agg(weighted.alias("_g")).select(*keys, vector_to_array("_g.mean").alias("_mean"))
    gap = F.zip_with("mean", "_mean", lambda x, y: (x - y) * (x - y))
    agg = m.join(centre, keys).groupBy(*keys).agg(
        F.count("*").alias("_c"), F.sum("n").alias("_n"),
        F.sum(F.col("n") * vectors.total(gap)).alias("_between"),
        F.sum(F.col("n") * vectors.total(F.col("var_pop"))).alias("_within"),
    )
    k, n = F.col("_c"), F.col("_n")
    score = (F.col("_between") / (k - 1)) / (F.col("_within") / (n - k))
    return agg.select(
        *keys,
        F.when((k > 1) & (n > k), F.when(F.col("_within") > 0, score).otherwise(1.0)).alias("calinski_harabasz"),
    )


def davies_bouldin(points: DataFrame, keys: list[str] = MODEL_KEYS, vec: str = "embedding") -> DataFrame:
    """Mean over clusters of the worst ratio of spreads to centre distance."""
    on = [*keys, "cluster_id"]
    inside = points.where(F.col("cluster_id") != -1).select(*on, F.col(vec).alias("_v"))
    centres = vectors.moments(inside, on, "_v").select(*on, F.col("mean").alias("_m"))
    spread = (
        inside.join(centres, on)
        .groupBy(*on)
        .agg(F.avg(vectors.euclidean(F.col("_v"), F.col("_m"))).alias("_s"))
        .join(centres, on)
        .withColumnRenamed("cluster_id", "_id")
    )
    schema = T.StructType(
        [*_key_fields(points, keys), T.StructField("_id", points.schema["cluster_id"].dataType), T.StructField("_r", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return arrow.empty_table()
        a, b = matrix(left.column("_m")), matrix(right.column("_m"))
        d = np.sqrt(squared_distances(a, b))
        same = array(left.column("_id"))[:, None] == array(right.column("_id"))[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = (array(left.column("_s"))[:, None] + array(right.column("_s"))[None, :]) / d
        worst = np.where(same, -np.inf, ratio).max(1)
        keep = [left.column(k).combine_chunks() for k in [*keys, "_id"]]
        return pa.table([*keep, pa.array(worst, mask=np.isinf(worst))], schema=arrow)

    ratios = block_product(spread, spread, keys, kernel, schema)
    worst = ratios.groupBy(*keys, "_id").agg(F.max("_r").alias("_r"))
    return worst.groupBy(*keys).agg(F.avg("_r").alias("davies_bouldin"))


def analyse(
    points: DataFrame,
    keys: list[str] = MODEL_KEYS,
    ident: str = "number",
    vec: str = "embedding",
    silhouette: str = "cosine",
    degenerate: str = "null",
) -> DataFrame:
    """Statistics, quality, outliers and stability of every model in one row.

    ``silhouette`` is ``euclidean`` (exact, quadratic), ``cosine`` or ``sqeuclidean`` (linear). Models without two
    clusters get null scores, or 0, 0 and infinity with ``degenerate="zero"``.
    """
    sil = silhouette_exact(points, keys, ident, vec) if silhouette == "euclidean" else silhouette_linear(points, keys, ident, vec, silhouette)
    out = (
        cluster_statistics(points, keys)
        .join(sil, keys, "left")
        .join(calinski_harabasz(points, keys, vec), keys, "left")
        .join(davies_bouldin(points, keys, vec), keys, "left")
    )
    if degenerate == "zero":
        few = F.col("n_clusters") < 2
        for name, value in (("silhouette_score", 0.0), ("calinski_harabasz", 0.0), ("davies_bouldin", float("inf"))):
            out = out.withColumn(name, F.when(few, F.lit(value)).otherwise(F.col(name)))
    elif degenerate != "null":
        raise ValueError(f"unknown mode {degenerate!r}")
    return out


def gated(analysis: DataFrame) -> DataFrame:
    return quality_gate(analysis)
