"""Exact nearest neighbours.

Points are assigned to cells around pivots, which are themselves points and therefore dense where the data are dense.
A query first meets its own cell. The distance of its k-th match there bounds the search, and by the triangle
inequality only cells whose ball reaches into that bound are visited in the second pass. There, queries of nearby cells
form groups of limited size; a group stays in its task while the points of all cells that any of its queries reaches pass
by in a stream, so that what moves is the points times the groups of a key, and not the queries times the cells. Cells are
split into blocks of limited size in the first pass, so a hot cell is many tasks; equal vectors are searched once and their members expanded at the end, so a
vector that a third of the rows share costs no more than any other. No partner is dropped: the result is exact.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import vectors
from ticketloom.operators.arrow_blocks import BLOCK_ROWS, array, cogroup, matrix, squared_distances
from ticketloom.operators.scans import top_per_group
from ticketloom.runtime import cut

CELL_ROWS = 1024
MAX_PIVOTS = 20_000
PIVOT_BYTES = 128 << 20
CHUNK_CELLS = 1 << 22
#: Groups of queries a key is dealt into, unless they were smaller than the least or larger than the most there may be.
GROUPS = 16
LEAST_GROUP = 256
GROUP_BYTES = 16 << 20
#: Tasks that the groups of all keys are dealt to, at most.
MAX_TASKS = 2000
SLACK = 1e-9


def keyed(points: DataFrame, keys: list[str], ident: str, vec: str, metric: str = "euclidean") -> DataFrame:
    """Internal form: one text key ``_k``, identifier ``_id``, vector ``_v`` (unit length for the cosine metric)."""
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    v = F.col(vec).cast("array<double>")
    key = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    return points.select(key.alias("_k"), F.col(ident).alias("_id"), (vectors.unit(v) if metric == "cosine" else v).alias("_v"))


def unkeyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns back from ``_k``."""
    parts = F.split("_k", "\u0001")
    return df.select(*[F.get(parts, F.lit(i)).alias(k) for i, k in enumerate(keys)], *[c for c in df.columns if c != "_k"])


def distinct_vectors(base: DataFrame) -> DataFrame:
    """One representative per key and vector, the smallest identifier, with the number of members ``_m``."""
    return base.groupBy("_k", "_v").agg(F.min("_id").alias("_id"), F.count("*").alias("_m"))


@dataclass
class CellIndex:
    """Points with their cell, and the pivots with radius and size of their cells, per key."""

    points: DataFrame
    pivots: dict[str, np.ndarray]
    radius: dict[str, np.ndarray] = field(default_factory=dict)
    size: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.points.columns if c not in ("_cell", "_dp")]


def chunk_rows(n_pivots: int) -> int:
    """Rows to compare with all pivots at a time, so that the distance table stays small."""
    return max(1, min(1024, CHUNK_CELLS // max(1, n_pivots)))


def _assigner(pivots: dict[str, np.ndarray], schema: T.StructType):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            cell, dist = np.full(n, -1, np.int32), np.zeros(n)
            keys = np.asarray(batch.column("_k").to_pylist(), dtype=object)
            for key in set(keys):
                if key not in pivots:
                    continue
                rows = np.flatnonzero(keys == key)
                x = matrix(batch.column("_v").take(pa.array(rows)))
                step = chunk_rows(len(pivots[key]))
                for i in range(0, len(rows), step):
                    part = x[i : i + step]
                    best = squared_distances(part, pivots[key]).argmin(1)
                    cell[rows[i : i + step]] = best
                    diff = part - pivots[key][best]
                    dist[rows[i : i + step]] = np.sqrt((diff * diff).sum(1))
            out = batch.append_column("_cell", pa.array(cell)).append_column("_dp", pa.array(dist))
            yield out

    return run


def _with_cells(df: DataFrame, pivots: dict[str, np.ndarray]) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_dp", T.DoubleType())])
    return df.mapInArrow(_assigner(pivots, schema), schema)


def build_index(base: DataFrame, cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS) -> CellIndex:
    """Choose pivots, assign cells, measure the cells.

    What comes to the driver is bounded: about ``max_pivots`` vectors and cell sizes per key at most, and no more than
    about ``PIVOT_BYTES`` in all.
    """
    counts = {r._k: (r.n, r.d) for r in base.groupBy("_k").agg(F.count("*").alias("n"), F.max(F.size("_v")).alias("d")).collect()}
    if not counts:
        return CellIndex(cut(_with_cells(base, {})), {})
    dims = max(d for _, d in counts.values())
    limit = max(1, min(max_pivots, PIVOT_BYTES // (8 * dims * len(counts))))
    wanted = {k: int(min(limit, max(1, -(-n // cell_rows)))) for k, (n, _) in counts.items()}
    # pivots are the points whose digest falls into a fixed share of the range: a plain filter, no ranking; the point
    # with the smallest digest is added, so that every key has one
    spark = base.sparkSession
    shares = spark.createDataFrame([(k, max(1, counts[k][0] // w)) for k, w in wanted.items()], "_k string, _share long")
    digest = F.xxhash64("_id")
    picked = base.join(shares, "_k").where(F.pmod(digest, F.col("_share")) == 0).select("_k", "_v", digest.alias("_h"))
    lowest = base.groupBy("_k").agg(F.min_by("_v", digest).alias("_v"), F.min(digest).alias("_h"))
    found: dict[str, dict] = {k: {} for k in counts}
    for row in picked.unionByName(lowest).collect():  # about ``wanted`` rows per key
        found[row._k][row._h] = row._v
    pivots = {k: np.asarray([v[h] for h in sorted(v)], dtype=float) for k, v in found.items()}
    index = CellIndex(cut(_with_cells(base, pivots)), pivots)
    for k, p in pivots.items():
        index.radius[k], index.size[k] = np.zeros(len(p)), np.zeros(len(p), int)
    for row in index.points.groupBy("_k", "_cell").agg(F.count("*").alias("n"), F.max("_dp").alias("r")).collect():
        index.radius[row._k][row._cell], index.size[row._k][row._cell] = row.r, row.n
    return index


def cell_table(index: CellIndex) -> DataFrame:
    """Number of blocks per cell, as a small frame."""
    rows = [(k, c, int(-(-n // BLOCK_ROWS))) for k, s in index.size.items() for c, n in enumerate(s) if n > 0]
    return index.points.sparkSession.createDataFrame(rows, "_k string, _cell int, _pn int")


def meet(queries: DataFrame, index: CellIndex, points: DataFrame, kernel, schema) -> DataFrame:
    """Bring queries (with a target ``_cell``) together with the points of that cell, in blocks on both sides."""
    on = ["_k", "_cell"]
    blocks = cell_table(index)
    q_blocks = queries.groupBy(*on).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("_qn"))
    both = blocks.join(q_blocks, on)
    left = (
        queries.join(both, on)
        .withColumn("_qb", F.pmod(F.xxhash64("_id"), F.col("_qn")).cast("int"))
        .withColumn("_pb", F.explode(F.sequence(F.lit(0), F.col("_pn") - 1)))
        .drop("_qn", "_pn")
    )
    right = (
        points.drop("_dp")
        .join(both, on)
        .withColumn("_pb", F.pmod(F.xxhash64("_id"), F.col("_pn")).cast("int"))
        .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_qn") - 1)))
        .drop("_qn", "_pn")
    )
    group = [*on, "_qb", "_pb"]
    return cogroup(left, right, group, kernel, schema)


def _top_k(k: int, exclude_self: bool, empty: pa.Schema):
    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return empty.empty_table()
        q, p = matrix(left.column("_v")), matrix(right.column("_v"))
        q_id, p_id = left.column("_id").combine_chunks(), right.column("_id").combine_chunks()
        bound = array(left.column("_bound"))
        order = array(pc.sort_indices(p_id))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        own = array(pc.index_in(q_id, value_set=p_id).fill_null(-1)) if exclude_self else None
        rows, cols, dist = [], [], []
        for i in range(0, len(q), 256):
            part = q[i : i + 256]
            d2 = squared_distances(part, p)
            if own is not None:
                mine = own[i : i + 256]
                hit = np.flatnonzero(mine >= 0)
                d2[hit, mine[hit]] = np.inf
            # the product form is only a filter: everything within its error of the k-th value is measured exactly
            limit = np.minimum(np.partition(d2, min(k, len(p)) - 1, axis=1)[:, min(k, len(p)) - 1], bound[i : i + 256] ** 2)
            r, c = np.nonzero((d2 <= (limit * (1 + SLACK) + SLACK)[:, None]) & np.isfinite(d2))
            diff = part[r] - p[c]
            exact = np.sqrt((diff * diff).sum(1))
            by = np.lexsort((rank[c], exact, r))
            r, c, exact = r[by], c[by], exact[by]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            keep = place < k
            rows.append(r[keep] + i)
            cols.append(c[keep])
            dist.append(exact[keep])
        r, c = pa.array(np.concatenate(rows)), pa.array(np.concatenate(cols))
        return pa.table(
            [left.column("_k").combine_chunks().take(r), q_id.take(r), p_id.take(c),
             right.column("_m").combine_chunks().take(c), pa.array(np.concatenate(dist))],
            schema=empty,
        )

    return kernel


def _along(pivots: np.ndarray) -> np.ndarray:
    """Order of the pivots in which near ones mostly follow each other: halved along their widest axis again and again."""
    parts, done = [np.arange(len(pivots))], []
    while parts:
        at = parts.pop()
        if len(at) <= 1:
            done.append(at)
            continue
        axis = pivots[at].var(0).argmax()
        at = at[np.argsort(pivots[at, axis], kind="stable")]
        parts += [at[len(at) // 2 :], at[: len(at) // 2]]
    return np.concatenate(done)


def _dealt(index: CellIndex, queries: DataFrame) -> tuple[DataFrame, int]:
    """Group ``_g`` of the queries of every cell, and how many follow it if one cell has several; number of all groups."""
    counts: dict[str, np.ndarray] = {}
    for row in queries.groupBy("_k", "_cell").agg(F.count("*").alias("n")).collect():  # a row per pivot at most
        counts.setdefault(row._k, np.zeros(len(index.pivots[row._k]), int))[row._cell] = row.n
    rows, g = [], 0
    for key, n in sorted(counts.items()):
        most = max(LEAST_GROUP, GROUP_BYTES // (8 * index.pivots[key].shape[1]))
        aim = min(most, max(LEAST_GROUP, -(-int(n.sum()) // GROUPS)))
        held = 0
        for c in _along(index.pivots[key]):
            if held and held + n[c] > aim:
                g, held = g + 1, 0
            parts = int(-(-n[c] // most))
            if parts:
                rows.append((key, int(c), g, parts))
                g, held = (g, held + int(n[c])) if parts == 1 else (g + parts, 0)
        g += held > 0
    return queries.sparkSession.createDataFrame(rows, "_k string, _cell int, _g int, _parts int"), g


def sweep(queries: DataFrame, index: CellIndex, points: DataFrame, reach, visit, schema: T.StructType) -> DataFrame:
    """Groups of queries, past each of which the points of all cells that any of its queries reaches are streamed.

    ``reach`` gives positions and cells for the queries of a batch, in parts. ``visit(queries)`` is made once per group; its
    ``meet(cell, points)`` sees a block of points of one cell at a time, and ``result()`` is what the group returns.
    """
    spark = queries.sparkSession
    groups, n = _dealt(index, queries)
    if not n:
        return spark.createDataFrame([], schema)
    asked = queries.join(groups, ["_k", "_cell"]).withColumn("_g", F.col("_g") + F.pmod(F.xxhash64("_id"), "_parts").cast("int")).drop("_parts")

    def cells(batches):
        for batch in batches:
            g, keys = array(batch.column("_g")), batch.column("_k")
            for part, cell in reach(batch):
                pairs, first = np.unique(np.stack([g[part], cell]), axis=1, return_index=True)
                yield pa.record_batch(
                    [keys.take(pa.array(part[first], pa.int64())), pa.array(pairs[1].astype(np.int32)), pa.array(pairs[0].astype(np.int32))],
                    names=["_k", "_cell", "_g"],
                )

    reached = asked.mapInArrow(cells, "_k string, _cell int, _g int").distinct()
    passing = points.join(reached, ["_k", "_cell"]).withColumn("_passes", F.lit(True))
    rows = asked.withColumn("_passes", F.lit(False)).unionByName(passing, allowMissingColumns=True)
    tasks = min(n, MAX_TASKS)
    dealt = rows.repartitionById(tasks, F.pmod("_g", F.lit(tasks))).sortWithinPartitions("_g", "_passes", "_cell")

    def run(batches):
        group, held, state = None, [], None

        def results():
            if state is not None:
                yield from state.result().to_batches()

        for batch in batches:
            g, cell, passes = (array(batch.column(c)) for c in ("_g", "_cell", "_passes"))
            if not len(g):
                continue
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(passes.astype(int)) != 0) | ((np.diff(cell) != 0) & passes[1:]))
            starts = np.r_[0, cuts + 1]
            for lo, hi in zip(starts, np.r_[starts[1:], len(g)]):
                if g[lo] != group:
                    yield from results()
                    group, held, state = g[lo], [], None
                if not passes[lo]:
                    held.append(batch.slice(lo, hi - lo))
                    continue
                if state is None:
                    state, held = visit(pa.Table.from_batches(held)), []
                for i in range(lo, hi, BLOCK_ROWS):
                    state.meet(int(cell[lo]), batch.slice(i, min(BLOCK_ROWS, hi - i)))
        yield from results()

    return dealt.mapInArrow(run, schema)


def _exact(q: np.ndarray, p: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of the pairs (r, c), by differences."""
    out = np.empty(len(r))
    step = max(1, CHUNK_CELLS // max(1, q.shape[1]))
    for i in range(0, len(r), step):
        diff = q[r[i : i + step]] - p[c[i : i + step]]
        out[i : i + step] = np.sqrt((diff * diff).sum(1))
    return out


def _reachable(pivots: dict[str, np.ndarray], radius: dict[str, np.ndarray], size: dict[str, np.ndarray]):
    """Other cells that a query's bound reaches into."""

    def reach(batch):
        keys = np.asarray(batch.column("_k").to_pylist(), dtype=object)
        own, bound = array(batch.column("_cell")), array(batch.column("_bound"))
        for key in set(keys):
            if key not in pivots:
                continue
            at = np.flatnonzero(keys == key)
            step = chunk_rows(len(pivots[key]))
            for i in range(0, len(at), step):
                part = at[i : i + step]
                x = matrix(batch.column("_v").take(pa.array(part)))
                gap = np.sqrt(squared_distances(x, pivots[key])) - radius[key][None, :]
                limit = bound[part] * (1 + SLACK) + SLACK
                near = (gap <= limit[:, None] + SLACK) & (size[key] > 0)[None, :]
                r, c = np.nonzero(near)
                keep = c != own[part][r]
                yield part[r[keep]], c[keep]

    return reach


class _Nearest:
    """The ``k`` nearest points outside their own cells of a group of queries."""

    def __init__(self, queries: pa.Table, pivots, radius, k: int, empty: pa.Schema):
        self.key = queries.column("_k")[0].as_py()
        self.q, self.ids, self.own = matrix(queries.column("_v")), queries.column("_id").combine_chunks(), array(queries.column("_cell"))
        self.bound = array(queries.column("_bound")).copy()
        self.pivots, self.radius, self.k, self.empty = pivots[self.key], radius[self.key], k, empty
        self.best = np.full((len(self.q), k), np.inf)
        self.found: list[pa.Table] = []
        self.rows, self.cell, self.gap = 0, None, None

    def meet(self, cell: int, points: pa.RecordBatch) -> None:
        if cell != self.cell:
            self.cell, self.gap = cell, np.sqrt(squared_distances(self.q, self.pivots[cell : cell + 1]))[:, 0] - self.radius[cell]
        limit = self.bound * (1 + SLACK) + 2 * SLACK
        active = np.flatnonzero((self.gap <= limit) & (self.own != cell))
        p = matrix(points.column("_v"))
        for i in range(0, len(active), 512):
            part = active[i : i + 512]
            d2 = squared_distances(self.q[part], p)
            # the product form is only a filter: everything within its error of the k-th value is measured exactly
            limit = self.bound[part] ** 2
            near = d2 <= (limit * (1 + SLACK) + SLACK)[:, None]
            if np.count_nonzero(near) > 4 * self.k * len(part) and len(p) > self.k:
                limit = np.minimum(limit, np.partition(d2, self.k - 1, axis=1)[:, self.k - 1])
                near = d2 <= (limit * (1 + SLACK) + SLACK)[:, None]
            r, c = np.nonzero(near)
            if not len(r):
                continue
            d = _exact(self.q[part], p, r, c)
            by = np.lexsort((d, r))
            r, c, d = r[by], c[by], d[by]
            first = np.searchsorted(r, r)
            place = np.arange(len(r)) - first
            some, at = np.unique(r, return_inverse=True)
            new = np.full((len(some), self.k), np.inf)
            new[at[place < self.k], place[place < self.k]] = d[place < self.k]
            self.best[part[some]] = np.sort(np.concatenate([self.best[part[some]], new], axis=1), axis=1)[:, : self.k]
            self.bound[part[some]] = np.minimum(self.bound[part[some]], self.best[part[some], -1])
            keep = d <= self.bound[part[r]]  # equal distances stay: identifiers decide between them
            take = pa.array(c[keep])
            self.found.append(pa.table({"r": part[r[keep]], "d": d[keep], "p": points.column("_id").take(take), "m": points.column("_m").take(take)}))
            self.rows += int(keep.sum())
        if self.rows > 8 * self.k * len(self.q) + CHUNK_CELLS // 4:
            self._compact()

    def _compact(self) -> None:
        if not self.found:
            return
        rows = pa.concat_tables(self.found)
        rows = rows.filter(pa.array(array(rows.column("d")) <= self.bound[array(rows.column("r"))]))
        rows = rows.take(pc.sort_indices(rows, [("r", "ascending"), ("d", "ascending"), ("p", "ascending")]))
        r = array(rows.column("r"))
        rows = rows.filter(pa.array(np.arange(len(r)) - np.searchsorted(r, r) < self.k))
        self.found, self.rows = [rows.combine_chunks()], rows.num_rows

    def result(self) -> pa.Table:
        self._compact()
        if not self.found:
            return self.empty.empty_table()
        rows = self.found[0]
        return pa.table(
            [pa.array([self.key] * rows.num_rows, pa.string()), self.ids.take(rows.column("r")), rows.column("p"), rows.column("m"), rows.column("d")],
            schema=self.empty,
        )


def search(index: CellIndex, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """``k`` nearest indexed points per query: ``_k, _q, _list`` with entries ``(_d, _p, _m)`` in order."""
    ident = index.points.schema["_id"].dataType
    schema = T.StructType(
        [
            T.StructField("_k", T.StringType()),
            T.StructField("_q", ident),
            T.StructField("_p", ident),
            T.StructField("_m", T.LongType()),
            T.StructField("_d", T.DoubleType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(schema)
    kernel = _top_k(k, exclude_self, empty)
    located = queries.select("_k", "_id", "_v", "_cell").withColumn("_bound", F.lit(float("inf")))
    first = meet(located, index, index.points, kernel, schema)

    def best(rows: DataFrame) -> DataFrame:
        entry = F.struct("_d", "_p", "_m")
        return rows.groupBy("_k", "_q").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("_list"))

    if all(len(p) <= 1 for p in index.pivots.values()):
        return best(first)
    head = cut(best(first))
    bound = F.when(F.size("_list") >= k, F.element_at("_list", -1)["_d"]).otherwise(F.lit(float("inf")))
    known = head.select("_k", F.col("_q").alias("_id"), bound.alias("_known"))
    bounded = located.drop("_bound").join(known, ["_k", "_id"], "left")
    bounded = bounded.withColumn("_bound", F.coalesce("_known", F.lit(float("inf")))).drop("_known")
    pivots, radius = index.pivots, index.radius
    second = sweep(
        bounded, index, index.points.select("_k", "_id", "_v", "_m", "_cell"), _reachable(pivots, radius, index.size),
        lambda rows: _Nearest(rows, pivots, radius, k, empty), schema,
    )
    flat = head.select("_k", "_q", F.explode("_list").alias("e")).select("_k", "_q", "e._p", "e._m", "e._d")
    return best(flat.unionByName(second))


def neighbours(
    points: DataFrame,
    keys: list[str],
    ident: str,
    vec: str,
    k: int,
    metric: str = "euclidean",
    queries: DataFrame | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``k`` nearest points of every query, within each key: ``keys, ident, neighbour, rank, distance``.

    Without ``queries`` the points search among themselves and never find themselves. Ties go to the smaller identifier.
    """
    base = cut(keyed(points, keys, ident, vec, metric))
    reps = distinct_vectors(base)
    # the smallest k+1 members of every vector are all that can appear in an answer
    members = top_per_group(base, ["_k", "_v"], [F.col("_id")], k + 1)
    reps = cut(
        reps.join(
            members.groupBy("_k", "_v").agg(F.array_sort(F.collect_list("_id")).alias("_ids")), ["_k", "_v"]
        )
    )
    index = build_index(reps, cell_rows)
    listed = index.points.select("_k", F.col("_id").alias("_p"), "_ids")

    def expand(lists: DataFrame) -> DataFrame:
        """Entries over representatives to entries over members."""
        rows = lists.select("_k", "_q", F.explode("_list").alias("e")).select("_k", "_q", "e._p", "e._d")
        rows = rows.join(listed, ["_k", "_p"]).select("_k", "_q", "_d", F.explode("_ids").alias("_p"))
        entry = F.struct("_d", "_p")
        return rows.groupBy("_k", "_q").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k + 1).alias("_list"))

    if queries is None:
        own = index.points.select("_k", F.col("_id").alias("_q"), F.array(F.struct(F.lit(0.0).alias("_d"), F.col("_id").alias("_p"), "_m")).alias("_list"))
        lists = search(index, index.points, k, True)
        rep_lists = expand(lists.unionByName(own))
        rep_of = base.join(reps.select("_k", "_v", F.col("_id").alias("_q")), ["_k", "_v"]).select("_k", "_id", "_q")
        mine = rep_of.join(rep_lists, ["_k", "_q"]).withColumn(
            "_list", F.slice(F.filter("_list", lambda e: e["_p"] != F.col("_id")), 1, k)
        )
    else:
        asked = _with_cells(keyed(queries, keys, ident, vec, metric), index.pivots).where("_cell >= 0")
        mine = expand(search(index, cut(asked), k, False)).withColumnRenamed("_q", "_id")
        mine = mine.withColumn("_list", F.slice("_list", 1, k))
    flat = mine.select("_k", "_id", F.posexplode("_list").alias("_r", "e"))
    distance = F.col("e._d") if metric == "euclidean" else F.col("e._d") * F.col("e._d") / 2
    return unkeyed(
        flat.select(
            "_k", F.col("_id").alias(ident), F.col("e._p").alias("neighbour"),
            (F.col("_r") + 1).cast("int").alias("rank"), distance.alias("distance"),
        ),
        keys,
    )


def core_distances(nn: DataFrame, keys: list[str], ident: str, min_samples: int) -> DataFrame:
    """Distance to the ``min_samples``-th neighbour, from a neighbour table that reaches that far."""
    return nn.where(F.col("rank") == min_samples).select(*keys, ident, F.col("distance").alias("core_distance"))


def reachability_edges(nn: DataFrame, cores: DataFrame, keys: list[str], ident: str, alpha: float = 1.0) -> DataFrame:
    """Mutual reachability of the neighbour pairs: the largest of both core distances and the scaled distance."""
    other = cores.select(*keys, F.col(ident).alias("neighbour"), F.col("core_distance").alias("_other"))
    joined = nn.join(cores, [*keys, ident]).join(other, [*keys, "neighbour"])
    return joined.select(
        *keys, ident, "neighbour",
        F.greatest("core_distance", "_other", F.col("distance") / alpha).alias("reachability"),
    )


def fuzzy_graph(nn: DataFrame, keys: list[str], ident: str, k: int, steps: int = 32) -> DataFrame:
    """Weighted neighbour graph: membership strength by local scale, made symmetric as a + b - ab.

    ``rho`` is the distance of the nearest neighbour; ``sigma`` solves sum(exp(-(d - rho) / sigma)) = log2(k) by a fixed
    number of bisections inside the row, so the scale needs no extra shuffle.
    """
    target = float(np.log2(k))
    lists = nn.groupBy(*keys, ident).agg(
        F.min("distance").alias("rho"), F.collect_list(F.struct("distance", "neighbour")).alias("_n")
    )

    def mass(sigma):
        return F.aggregate(
            "_n", F.lit(0.0),
            lambda a, e: a + F.when(e["distance"] <= F.col("rho"), 1.0).otherwise(F.exp(-(e["distance"] - F.col("rho")) / sigma)),
        )

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(1.0).alias("mid"))

    def step(s, _):
        heavy = mass(s["mid"]) > target
        lo = F.when(heavy, s["lo"]).otherwise(s["mid"])
        hi = F.when(heavy, s["mid"]).otherwise(s["hi"])
        mid = F.when(hi == float("inf"), s["mid"] * 2).otherwise((lo + hi) / 2)
        return F.struct(lo.alias("lo"), hi.alias("hi"), mid.alias("mid"))

    scaled = lists.withColumn("sigma", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["mid"])
    edge = scaled.select(*keys, ident, "rho", "sigma", F.explode("_n").alias("e"))
    weight = F.when(F.col("e.distance") <= F.col("rho"), 1.0).otherwise(
        F.exp(-(F.col("e.distance") - F.col("rho")) / F.col("sigma"))
    )
    directed = edge.select(*keys, F.col(ident).alias("a"), F.col("e.neighbour").alias("b"), weight.alias("w"))
    pair = directed.select(
        *keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w"
    )
    # a pair occurs once or twice; with one side only the other strength is zero
    return pair.groupBy(*keys, "a", "b").agg(
        (F.sum("w") - F.when(F.count("*") == 2, F.product("w")).otherwise(0.0)).alias("weight")
    )


def local_scale(nn: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Distance of the nearest neighbour of every point."""
    return nn.groupBy(*keys, ident).agg(F.min("distance").alias("rho"))
