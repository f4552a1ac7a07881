"""Agglomerative merging by Ward's criterion over the cluster centres of a key.

A row is a cluster centre, of which a key has at most a few thousand, so the distances of one key fit one Arrow group;
keys spread over the cluster. Nearest-neighbour chains find the merges in quadratic time, and Lance-Williams updates keep
the distances.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.operators.arrow_blocks import matrix


def merges(x: np.ndarray) -> list[tuple[float, int, int]]:
    """Merges in order of height: (height, smaller place, larger place); a cluster is named by its first place.

    Among equally near clusters the first one is taken. Heights are distances for two single rows.
    """
    n = len(x)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    size, live, chain, out = np.ones(n), np.ones(n, bool), [], []
    while len(out) < n - 1:
        if not chain:
            chain.append(int(np.argmax(live)))
        while True:
            top = chain[-1]
            near = int(np.argmin(d[top]))
            if len(chain) > 1 and d[top, chain[-2]] <= d[top, near]:
                near = chain[-2]
                break
            chain.append(near)
        a, b = sorted((chain.pop(), chain.pop()))
        out.append((float(np.sqrt(d[a, b])), a, b))
        both = size[a] + size[b]
        with np.errstate(invalid="ignore"):
            row = ((size[a] + size) * d[a] + (size[b] + size) * d[b] - size * d[a, b]) / (both + size)
        row[~live] = np.inf
        row[[a, b]] = np.inf
        d[a], d[:, a], d[b], d[:, b] = row, row, np.inf, np.inf
        size[a], live[b] = both, False
    return sorted(out, key=lambda m: m[0])  # stable: a merge stays behind those it builds on


def cut_labels(n: int, steps: list[tuple[float, int, int]], count: int) -> np.ndarray:
    """Group of every row once ``count`` groups are left, numbered by their first row."""
    first = np.arange(n)
    for _, a, b in steps[: n - count]:
        low, high = sorted((first[a], first[b]))
        first[first == high] = low
    return np.unique(first, return_inverse=True)[1]


def _sorted_group(table: pa.Table, ident: str) -> tuple[pa.Table, np.ndarray]:
    table = table.sort_by(ident)
    return table, matrix(table.column("_v"))


def merge_table(centres: DataFrame, keys: list[str], ident: str, vec: str) -> DataFrame:
    """``keys, step, a, b, height``: the merges of every key; a cluster is named by its smallest identifier."""
    base = centres.select(*keys, F.col(ident).alias("_id"), F.col(vec).cast("array<double>").alias("_v"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*keys, "_id").schema).replace("`_id`", "a")
    kind = base.schema["_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table, x = _sorted_group(table, "_id")
        steps = merges(x)
        a, b = (pa.array([m[k] for m in steps], pa.int64()) for k in (1, 2))
        columns = {k: table.column(k).take(pa.array(np.zeros(len(steps), np.int64))) for k in keys}
        ids = table.column("_id")
        return pa.table({**columns, "a": ids.take(a), "b": ids.take(b), "height": pa.array([m[0] for m in steps], pa.float64()),
                         "step": pa.array(range(1, len(steps) + 1), pa.int32())})

    return base.groupBy(*keys).applyInArrow(run, f"{kinds}, b {kind}, height double, step int")


def cuts(centres: DataFrame, keys: list[str], ident: str, vec: str, most: int) -> DataFrame:
    """``keys, ident, _want, domain_id`` for every count of groups from 2 to ``most`` (one less than the rows at most)."""
    base = centres.select(*keys, F.col(ident).alias("_id"), F.col(vec).cast("array<double>").alias("_v"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*keys, "_id").schema)

    def run(table: pa.Table) -> pa.Table:
        table, x = _sorted_group(table, "_id")
        steps, n = merges(x), len(x)
        wants = list(range(2, max(2, min(most, n - 1)) + 1)) if n > 1 else []
        take = pa.array(np.tile(np.arange(n), len(wants)), pa.int64())
        labels = np.concatenate([cut_labels(n, steps, w) for w in wants]) if wants else np.zeros(0, np.int64)
        named = table.select([*keys, "_id"]).take(take)
        return named.append_column("_want", pa.array(np.repeat(np.array(wants, np.int64), n), pa.int32())).append_column(
            "domain_id", pa.array(labels, pa.int32())
        )

    found = base.groupBy(*keys).applyInArrow(run, f"{kinds}, _want int, domain_id int")
    return found.withColumnRenamed("_id", ident)
