"""Vector columns: checks, algebra and per-dimension statistics."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine distance; null where a side has no direction."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, 1.0 - dot(a, b) / scale)


def unit(a: Column) -> Column:
    """Vector of length one; a zero vector stays as it is.

    The norm is bound as the only element of an array: within the inner function it would be worked out per element.
    """
    scaled = F.transform(F.array(norm(a)), lambda n: F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(a))
    return scaled[0]


def weighted_concat(parts: list[tuple[Column, float]]) -> Column:
    def scaled(v: Column, weight: float) -> Column:
        return F.transform(v, lambda x: x * weight)

    return F.concat(*[scaled(v, w) for v, w in parts])


def to_json_text(v: Column) -> Column:
    return F.to_json(v)


def from_json_text(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def unwrap_records(v: Column) -> Column:
    """Repeated records ``{value}`` to a plain array."""
    return F.transform(v, lambda r: r["value"])


def present(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0)


def finite(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return present(v) & ~F.coalesce(bad, F.lit(True))


def valid(v: Column, dims: int) -> Column:
    return finite(v) & (F.size(v) == dims)


def moments(df: DataFrame, keys: list[str], vec: str) -> DataFrame:
    """Count, mean and population variance per dimension, one buffer per group and map-side combined.

    Columns: keys, ``n``, ``mean``, ``var_pop``. The ML summary divides by n-1; the factor restores division by n.
    """
    stats = Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(F.col(vec)))
    grouped = df.groupBy(*keys).agg(stats.alias("s")) if keys else df.agg(stats.alias("s"))
    n = F.col("s.count")
    return grouped.select(
        *keys,
        n.alias("n"),
        vector_to_array("s.mean").alias("mean"),
        F.transform(vector_to_array("s.variance"), lambda x: x * (n - 1) / n).alias("var_pop"),
    )


def standardize(df: DataFrame, keys: list[str], vec: str, out: str | None = None) -> DataFrame:
    """Z-scores with population deviation; a dimension without spread is only centred."""
    m = moments(df, keys, vec).select(
        *keys,
        F.col("mean").alias("_mean"),
        F.transform("var_pop", lambda x: F.when(x > 0, F.sqrt(x)).otherwise(1.0)).alias("_dev"),
    )
    joined = df.join(m, keys) if keys else df.join(F.broadcast(m))  # a single row when there is no key
    centred = F.zip_with(F.col(vec), F.col("_mean"), lambda x, mu: x - mu)
    return joined.withColumn(out or vec, F.zip_with(centred, F.col("_dev"), lambda x, s: x / s)).drop("_mean", "_dev")
