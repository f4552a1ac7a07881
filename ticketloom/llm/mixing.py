"""Mixing sources to target weights by Pfair scheduling.

Every source is a task that asks for its weight's share of the places of a stream. Its j-th block may not come before
its release time floor((j-1)/w) and must come by its deadline ceil(j/w); taking the earliest deadline among the released
blocks keeps every source within less than one block of its share at any place. Releases and deadlines follow exactly from
the weights, block by block; only a caller's own ``slots`` rounds weights to multiples of 1/``slots`` and repeats one frame.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1000
#: Blocks that the schedule hands on at a time.
BATCH = 1 << 16


def quantised(weights: dict[str | None, float], slots: int = SLOTS) -> dict[str | None, int]:
    """Places per frame of each source: largest remainders, at least one each, ``slots`` in all."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights are positive")
    if len(weights) > slots:
        raise ValueError(f"{len(weights)} sources need a frame of as many slots")
    if not weights:
        return {}
    total, free = sum(weights.values()), slots - len(weights)
    share = {s: w / total * free for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in share.items()}
    by_rest = sorted(share, key=lambda s: (-(share[s] - int(share[s])), s is None, s or ""))
    for s in by_rest[: slots - sum(out.values())]:
        out[s] += 1
    return out


def frame(places: dict[str | None, int]) -> list[tuple[str | None, int]]:
    """One frame: for every place the source and the number of its block, by the earliest deadline first."""
    slots = sum(places.values())
    waiting: list = []
    ready: list = []
    for rank, s in enumerate(sorted(places, key=lambda s: (s is None, s or ""))):
        heapq.heappush(waiting, (0, rank, s, 1))
    out = []
    for now in range(slots):
        while waiting and waiting[0][0] <= now:
            _, rank, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * slots // places[s]), rank, s, j))
        _, rank, s, j = heapq.heappop(ready)
        out.append((s, j))
        if j < places[s]:
            heapq.heappush(waiting, (j * slots // places[s], rank, s, j + 1))
    return out


def lag(order: list[str | None], weights: dict[str | None, Fraction]) -> Fraction:
    """Largest deviation of any source from its share at any place of ``order``."""
    seen = dict.fromkeys(weights, 0)
    worst = Fraction(0)
    for t, s in enumerate(order, 1):
        seen[s] += 1
        worst = max(worst, *(abs(weights[x] * t - seen[x]) for x in weights))
    return worst


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """Source (its position), block (from 0) and place of every block there is, in ascending order of places.

    Weights are taken as exact fractions of their sum. A source that has run dry asks for no places any more; a place that
    nobody may take yet stays empty. Memory grows with the sources only.
    """
    total = sum(map(Fraction, weights))
    period = [total / Fraction(w) for w in weights]
    waiting = [(0, s, 1) for s, n in enumerate(blocks) if n]
    ready: list[tuple[int, int, int]] = []
    now = 0
    while waiting or ready:
        if not ready:
            now = max(now, waiting[0][0])
        while waiting and waiting[0][0] <= now:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * period[s].numerator // period[s].denominator), s, j))
        _, s, j = heapq.heappop(ready)
        yield s, j - 1, now
        if j < blocks[s]:
            heapq.heappush(waiting, (j * period[s].numerator // period[s].denominator, s, j + 1))
        now += 1


def tempered(df: DataFrame, source: str, power: float = 0.7) -> dict[str | None, float]:
    """Target weights that damp large sources: the row count of each to the given power."""
    return {s: float(n) ** power for s, n in _rows(df, source).items()}


def _rows(df: DataFrame, source: str) -> dict[str | None, int]:
    return {r[0]: r[1] for r in df.groupBy(source).agg(F.count("*")).collect()}


def numbered(df: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Add ``__n``, the number of each row in its source ``__s`` (from 0), in the order of the hashes ``__h, __tie``.

    Rows are ranked within ranges of the hash and the ranges' counts are added up, so a large source is many tasks.
    """
    buckets = max(1, min(1 << 20, -(-df.count() // rows_per_bucket)))
    df = df.withColumn("__r", F.expr(f"(shiftright(__h, 44) + {1 << 19}) * {buckets} div {1 << 20}"))
    sizes = df.groupBy("__s", "__r").agg(F.count("*").alias("n"))
    before = F.expr("coalesce(sum(n) OVER (PARTITION BY __s ORDER BY __r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    ranked = df.withColumn("__k", F.expr("row_number() OVER (PARTITION BY __s, __r ORDER BY __h, __tie) - 1"))
    joined = ranked.join(sizes.select("__s", "__r", before.alias("__before")), ["__s", "__r"])
    return joined.withColumn("__n", F.col("__before") + F.col("__k")).drop("__r", "__before", "__k")


def mixed(
    df: DataFrame,
    weights: dict[str | None, float] | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    block_rows: int = 16,
    slots: int | None = None,
    seed: int = 29,
    rows_per_bucket: int = 5_000,
) -> DataFrame:
    """All rows with ``weight`` (the target share), ``block`` (number of the row's block in its source), ``place`` (of the
    block in the stream) and ``in_block``.

    Reading the rows by (``place``, ``in_block``) gives the mixture: until a source runs dry, every source is within
    less than one block of its target share at every place. No row is left out: the places of a source that has run dry
    stay empty, and the others go on in their own proportions. ``weights`` default to ``tempered`` row counts; a source
    without a weight raises an error. With ``slots``, weights are rounded to multiples of 1/``slots`` with at least one each
    and a frame of that many places repeats; the deviation then holds for the rounded weights. Rows of a source come in an order drawn by a seeded hash of their id; a null source
    is a source of its own, repeated rows take a place each. Columns with one of the four names are replaced; ``source``
    is a string column.
    """
    made = ("weight", "block", "place", "in_block")
    carried = [c for c in df.columns if c not in made]
    counts = _rows(df, source)
    if weights is None:
        weights = {s: float(n) ** 0.7 for s, n in counts.items()}
    stray = [s for s in counts if s not in weights]
    if stray:
        raise ValueError(f"no weight for source {stray[0]!r}")
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights are positive")
    named = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(_key(None)))
    rows = df.select(*carried, named.alias("__s"), F.xxhash64(F.lit(seed), F.col(doc_id)).alias("__h"),
                     F.xxhash64(F.lit(seed + 1), *[F.col(c) for c in carried]).alias("__tie"))
    rows = numbered(rows, rows_per_bucket).withColumns(
        {"block": F.expr(f"__n div {block_rows}"), "in_block": (F.col("__n") % block_rows).cast("int")}
    )
    if slots is None:
        return rows.join(_plan(df, weights, counts, block_rows), ["__s", "block"]).select(*carried, *made)
    places = quantised(weights, slots)
    taken: dict[str | None, list[int]] = {s: [] for s in places}
    for slot, (s, _) in enumerate(frame(places)):
        taken[s].append(slot)
    plan = df.sparkSession.createDataFrame(
        [(_key(s), places[s] / slots, n) for s, n in taken.items()], "__s string, weight double, __slots array<int>"
    )
    share = F.size("__slots")
    place = F.expr("block div size(__slots)") * slots + F.element_at("__slots", (F.col("block") % share + 1).cast("int"))
    # the frame has one number per slot, whatever the data
    return rows.join(F.broadcast(plan), "__s").withColumn("place", place).select(*carried, *made)


def _plan(df: DataFrame, weights: dict[str | None, float], counts: dict[str | None, int], block_rows: int) -> DataFrame:
    """``__s, block, weight, place`` of every block. Places depend on all before them, so one task streams them out."""
    names = sorted(weights, key=lambda s: (s is None, s or ""))
    keys, own = [_key(s) for s in names], [float(weights[s]) for s in names]
    blocks = [-(-counts.get(s, 0) // block_rows) for s in names]
    total = sum(own)
    shares = [w / total for w in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                steps = schedule(own, blocks)
                while part := list(itertools.islice(steps, BATCH)):
                    at, block, place = zip(*part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[s] for s in at], pa.string()), pa.array(block, pa.int64()),
                         pa.array([shares[s] for s in at], pa.float64()), pa.array(place, pa.int64())],
                        names=["__s", "block", "weight", "place"],
                    )

    return df.sparkSession.range(0, 1, 1, 1).mapInArrow(run, "__s string, block long, weight double, place long")


def _key(source: str | None) -> str:
    return "null" if source is None else f"={source}"
