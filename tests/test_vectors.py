"""Vector operators against brute force."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ticketloom.functions import vectors
from ticketloom.operators import density, domains, neighbours, quality, reduction, scans, ward

BLOBS = (((0, 0), 0.3, 60), ((3, 3), 0.2, 50), ((0, 4), 0.8, 50))


def blobs(seed=3):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(c, s, (m, 2)) for c, s, m in BLOBS])


def frame(spark, sets):
    rows = [(key, off + i, x.tolist()) for key, off, xs in sets for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "c string, id long, v array<double>")


@pytest.fixture(scope="module")
def sets():
    x = blobs()
    x[5:9] = x[5]  # equal vectors
    return [("a", 0, x), ("b", 1000, x[:70] * 2)]


@pytest.mark.parametrize("cell_rows", [1024, 15])
def test_neighbours_are_exact(spark, sets, cell_rows):
    got = neighbours.neighbours(frame(spark, sets), ["c"], "id", "v", 5, cell_rows=cell_rows).orderBy("id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((round(r.distance, 9), r.neighbour))
    for _, off, x in sets:
        d = brute.pairwise(x)
        for i in range(len(x)):
            want = sorted((d[i, j], off + j) for j in range(len(x)) if j != i)[:5]
            assert by[off + i] == [(round(a, 9), b) for a, b in want]


def test_neighbours_of_a_hot_vector(spark):
    """A third of the rows are one vector; another key has fewer rows than neighbours asked for."""
    x = np.vstack([np.ones((50, 2)), blobs()[:100]])
    got = neighbours.neighbours(frame(spark, [("a", 0, x), ("z", 900, x[50:53])]), ["c"], "id", "v", 4)
    rows = got.groupBy("id").agg(F.count("*").alias("n"), F.sum("distance").alias("d")).collect()
    assert {r.id: r.n for r in rows if r.id < 900} == {i: 4 for i in range(150)}
    assert {r.n for r in rows if r.id >= 900} == {2}
    assert all(r.d == 0 for r in rows if r.id < 50)
    assert sorted(r.neighbour for r in got.where("id = 30").collect()) == [0, 1, 2, 3]
    assert sorted(r.neighbour for r in got.where("id = 2").collect()) == [0, 1, 3, 4]


def test_fuzzy_graph_scale(spark, sets):
    nn = neighbours.neighbours(frame(spark, sets[:1]), ["c"], "id", "v", 8)
    graph = neighbours.fuzzy_graph(nn, ["c"], "id", 8).toPandas()
    assert graph.weight.between(0, 1 + 1e-9).all() and (graph.a < graph.b).all()
    x = sets[0][2]
    d = np.sort(brute.pairwise(x), axis=1)[:, 1:9]
    order = np.argsort(brute.pairwise(x) + np.eye(len(x)) * 1e9, axis=1, kind="stable")[:, :8]
    w = np.zeros((len(x), len(x)))
    for i in range(len(x)):
        lo, hi, mid = 0.0, np.inf, 1.0
        for _ in range(32):
            s = np.where(d[i] <= d[i, 0], 1.0, np.exp(-(d[i] - d[i, 0]) / mid)).sum()
            lo, hi = (lo, mid) if s > 3 else (mid, hi)
            mid = mid * 2 if np.isinf(hi) else (lo + hi) / 2
        w[i, order[i]] = np.where(d[i] <= d[i, 0], 1.0, np.exp(-(d[i] - d[i, 0]) / mid))
    want = w + w.T - w * w.T
    apart = graph[(graph.a > 20) & (graph.b > 20)]  # ties between equal vectors may go either way
    assert np.allclose([want[int(a), int(b)] for a, b in zip(apart.a, apart.b)], apart.weight, atol=1e-6)


@pytest.mark.parametrize(("cell_rows", "edges"), [(1024, 15), (10, 3)])
def test_spanning_tree_is_minimal(spark, sets, cell_rows, edges):
    tree = density.spanning_tree(frame(spark, sets), ["c"], "id", "v", 3, cell_rows=cell_rows, edge_neighbours=edges)
    got = density.tree_edges(tree, ["c"]).toPandas()
    for key, _, x in sets:
        mine = got[got.c == key]
        assert len(mine) == len(x) - 1
        assert np.isclose(mine.w.sum(), sum(w for w, _, _ in brute.mst_edges(brute.reachability(x, 3))))


@pytest.fixture(scope="module")
def tree(spark, sets):
    return density.spanning_tree(frame(spark, sets), ["c"], "id", "v", 5)


def test_flat_cut(spark, sets, tree):
    got = density.flat_cut(tree, ["c"], "id", 0.4, 10).toPandas()
    for key, off, x in sets:
        mine = got[(got.c == key) & (got.cluster_id >= 0)]
        found = {frozenset(int(i) - off for i in g) for _, g in mine.groupby("cluster_id").id}
        assert found == brute.flat(x, 5, 0.4, 10)
        sizes = mine.groupby("cluster_id").size()
        assert list(sizes) == sorted(sizes, reverse=True)


def test_hierarchy_selection_and_scores(spark, sets, tree):
    h = density.hierarchy(tree, 10)
    got = density.assignments(tree, h, ["c"], "id").toPandas()
    for key, off, x in sets:
        nodes = brute.condensed(x, 5, 10)
        picked = brute.select(nodes)
        mine = got[got.c == key]
        found = {frozenset(int(i) - off for i in g) for c, g in mine[mine.cluster_id >= 0].groupby("cluster_id").id}
        assert found == {frozenset(nodes[i]["members"]) for i in picked}
        table = h.clusters.where(F.col("_k") == key).toPandas()
        assert np.allclose(sorted(table.stability), sorted(n["stability"] for n in nodes))
        by = mine.set_index(mine.id - off)
        for i in picked:
            top = max(nodes[i]["lambda"].values())
            for p, lam in nodes[i]["lambda"].items():
                assert np.isclose(by.probability[p], min(lam, top) / top)
        assert ((by.outlier_score >= 0) & (by.outlier_score <= 1)).all()


def test_hierarchy_is_exact_beyond_many_distinct_weights(spark):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 0.5, 150), ((3, 3), 0.2, 120), ((0, 5), 0.9, 130))])
    x[20:24] = x[20]
    grid = np.array([(i // 8, i % 8) for i in range(64)], float)  # nearly all weights are equal
    twins = np.repeat([[0.0, 0.0], [4.0, 0.0], [9.0, 0.0]], 12, axis=0)
    sets = [("a", 0, x), ("g", 1000, grid), ("t", 2000, twins)]
    tree = density.spanning_tree(frame(spark, sets), ["c"], "id", "v", 4)
    assert tree.edges.where("_k like '%a%'").select("w").distinct().count() > 256
    h = density.hierarchy(tree, 8)
    got = density.assignments(tree, h, ["c"], "id").toPandas()
    for key, off, x in sets[:2]:
        nodes = brute.condensed(x, 4, 8)
        mine = got[got.c == key]
        picked = brute.select(nodes)
        found = {frozenset(int(i) - off for i in g) for c, g in mine[mine.cluster_id >= 0].groupby("cluster_id").id}
        assert found == {frozenset(nodes[i]["members"]) for i in picked}
        table = h.clusters.where(F.col("_k") == key).toPandas()
        for column, want in (
            ("stability", [n["stability"] for n in nodes]), ("birth", [n["birth"] for n in nodes]),
            ("death", [max(n["lambda"].values()) for n in nodes]), ("size", [len(n["members"]) for n in nodes]),
        ):
            assert np.allclose(sorted(table[column]), sorted(want)), column
        by = mine.set_index(mine.id - off)
        for i in picked:
            top = max(nodes[i]["lambda"].values())
            for p, lam in nodes[i]["lambda"].items():
                assert np.isclose(by.probability[p], min(lam, top) / top) and np.isclose(by["lambda"][p], lam)
        deepest = [max(nodes[j]["lambda"].values()) for j in range(len(nodes))]
        for j in reversed(range(len(nodes))):
            deepest[j] = max([deepest[j], *[deepest[c] for c in nodes[j]["children"]]])
        for n, deep in zip(nodes, deepest):
            below = set().union(*[nodes[c]["members"] for c in n["children"]])
            for p in n["members"] - below:
                assert np.isclose(by.outlier_score[p], (deep - n["lambda"][p]) / deep)
    mine = got[got.c == "t"]
    assert sorted(mine.groupby("cluster_id").size()) == [12, 12, 12] and (mine.cluster_id >= 0).all()


def test_hierarchy_leaf_and_epsilon(spark, sets, tree):
    leaves = density.hierarchy(tree, 10, "leaf").clusters
    parents = [r.parent for r in leaves.where("parent is not null").collect()]
    chosen = leaves.where("selected").collect()
    assert chosen and all(r.cluster not in parents for r in chosen)
    wide = density.hierarchy(tree, 10, eps=100.0).clusters.where("selected").count()
    assert 0 < wide <= len(chosen)


def test_labels_do_not_depend_on_row_order(spark, sets):
    df = frame(spark, [("b", 0, sets[1][2][40:])])
    a = density.cluster(df, ["c"], "id", "v", 10).select("id", "cluster_id")
    b = density.cluster(df.orderBy(F.desc("id")).repartition(5), ["c"], "id", "v", 10).select("id", "cluster_id")
    assert a.exceptAll(b).isEmpty()


def test_prediction_takes_the_nearest_cluster(spark, sets, tree):
    df = frame(spark, sets)
    model = df.join(density.assignments(tree, density.hierarchy(tree, 10), ["c"], "id"), ["c", "id"])
    fresh = spark.createDataFrame(
        [("a", 1, [0.05, 0.0]), ("a", 2, [3.0, 3.05]), ("a", 3, [50.0, 50.0])], "c string, id long, v array<double>"
    )
    got = {r.id: r for r in density.predict(fresh, model, ["c"], "id", "v").collect()}
    truth = {r.id: r.cluster_id for r in model.where("c = 'a'").collect()}
    assert got[1].cluster_id == truth[got[1].nearest] >= 0 and got[1].nearest < 60
    assert got[2].cluster_id == truth[got[2].nearest] >= 0 and 60 <= got[2].nearest < 110
    assert got[3].cluster_id == -1 and got[3].strength == 0


def labelled(spark, scale=1.0):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(c, 0.5, (30, 3)) for c in ((0, 0, 1), (2, 2, 2), (0, 3, 1))]) * scale
    rows = [("t", "v", i, i // 30 if i % 11 else -1, x[i].tolist()) for i in range(90)]
    return x, spark.createDataFrame(rows, "tech_center string, model_version string, number long, cluster_id int, embedding array<double>")


def test_silhouettes(spark):
    x, df = labelled(spark, 7.0)
    keep = [i for i in range(90) if i % 11]
    lab = np.array([i // 30 for i in keep])
    d = brute.pairwise(x[keep])
    score = []
    for i in range(len(keep)):
        own = d[i][(lab == lab[i])].sum() / ((lab == lab[i]).sum() - 1)
        other = min(d[i][lab == o].mean() for o in set(lab) - {lab[i]})
        score.append((other - own) / max(own, other))
    assert np.isclose(quality.silhouette_exact(df, rows=16).first().silhouette_score, np.mean(score))
    ml = df.where("cluster_id >= 0").select("cluster_id", array_to_vector("embedding").alias("features"))
    for metric, name in (("cosine", "cosine"), ("sqeuclidean", "squaredEuclidean")):
        want = ClusteringEvaluator(predictionCol="cluster_id", distanceMeasure=name).evaluate(ml)
        assert np.isclose(quality.silhouette_linear(df, metric=metric).first().silhouette_score, want)


def test_degenerate_quality(spark):
    _, df = labelled(spark)
    one = df.withColumn("cluster_id", F.lit(0))
    r = quality.analyse(one).first()
    assert r.silhouette_score is None and r.calinski_harabasz is None and r.davies_bouldin is None
    r = quality.analyse(one, degenerate="zero").first()
    assert (r.silhouette_score, r.calinski_harabasz, r.davies_bouldin) == (0.0, 0.0, float("inf"))
    noise = quality.analyse(df.withColumn("cluster_id", F.lit(-1)), degenerate="zero").first()
    assert noise.n_clusters == 0 and noise.stability_score == 0.0 and noise.noise_ratio == 1.0
    assert quality.analyse(df.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)) @ np.diag([3, 2, 1, 0.5, 0.1]) + 4
    df = spark.createDataFrame([("k", i, r.tolist()) for i, r in enumerate(x)], "tech_center string, number long, embedding array<double>")
    model = reduction.fit_components(df, ["tech_center"], "embedding", 2)
    got = np.array([r.reduced for r in reduction.project(df, model, ["tech_center"], "embedding").orderBy("number").collect()])
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    axes = vt[:2] * np.sign(vt[:2][np.arange(2), np.abs(vt[:2]).argmax(1)])[:, None]
    assert np.allclose(got, (x - x.mean(0)) @ axes.T)
    assert np.allclose(sorted((r.variance for r in model.collect()), reverse=True), s[:2] ** 2 / 200)


def test_standardize_without_spread(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 5.0])], "i int, v array<double>")
    got = {r.i: r.v for r in vectors.standardize(df, [], "v").collect()}
    assert got == {1: [-1.0, 0.0], 2: [1.0, 0.0]}


def test_vector_checks(spark):
    df = spark.createDataFrame(
        [(1, None), (2, []), (3, [1.0, float("nan")]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, [0.0, 0.0])], "i int, v array<double>"
    )
    got = {r.i: r.vector_status for r in scans.split_by_vector_validity(df, "v", 2).collect()}
    assert got == {1: "missing", 2: "missing", 3: "not_finite", 4: "not_finite", 5: "wrong_size", 6: "ok"}
    assert df.where("i = 6").select(vectors.cosine(F.col("v"), F.col("v"))).first()[0] is None


def test_domains(spark):
    near = [("a", i, float(i // 4 * 50 + i % 4), 0.0) for i in range(12)]
    few = [("b", i, float(i), 0.0) for i in range(3)]
    centres = spark.createDataFrame(near + few, "tech_center string, cluster_id int, center_x double, center_y double")
    plain = domains.group_domains(centres, ["tech_center"]).toPandas()
    assert plain[plain.tech_center == "a"].domain_id.nunique() == 4 and plain[plain.tech_center == "b"].domain_id.nunique() == 3
    scored = domains.group_domains_scored(centres, ["tech_center"]).toPandas()
    a = scored[scored.tech_center == "a"].sort_values("cluster_id")
    assert list(a.domain_id) == [0] * 4 + [1] * 4 + [2] * 4
    assert set(scored[scored.tech_center == "b"].domain_id) == {0}
    labels = centres.select("tech_center", "cluster_id", F.concat(F.lit("T"), "cluster_id").alias("topic"))
    names = domains.name_domains(spark.createDataFrame(scored[["tech_center", "cluster_id", "domain_id"]]), labels, ["tech_center"])
    got = {(r.tech_center, r.domain_id): r.domain_name for r in names.collect()}
    assert got[("a", 1)] == "Domain 1: T4" and got[("b", 0)] == "All Incidents" and got[("a", -1)] == "Noise"


def nested_clusters(n, rng):
    """Condensed trees as rows: a chain of nested clusters with a leaf beside each, and a random tree."""
    rows = [("chain", 0, None)]
    for i in range(1, n):
        rows += [("chain", 2 * i - 1, 2 * i - 2 if i > 1 else 0), ("chain", 2 * i, 2 * i - 2 if i > 1 else 0)]
    rows += [("random", i, int(rng.integers(max(0, i - 6), i)) if i else None) for i in range(150)] + [("lone", 0, None)]
    return [(k, i, p, float(np.round(rng.uniform(0, 4), 3)), float(i + 1)) for k, i, p in rows]


@pytest.mark.parametrize("method", ["eom", "leaf"])
def test_nested_clusters_settle_in_few_rounds(spark, monkeypatch, method):
    rows = nested_clusters(200, np.random.default_rng(11))
    name = "struct<w: double, c: long>"
    data = [(k, (0.0, i), None if p is None else (0.0, p), s, 0.5, d) for k, i, p, s, d in rows]
    nodes = spark.createDataFrame(data, f"_k string, cluster {name}, parent {name}, stability double, birth double, death double")
    real, rounds = density.cut, []
    monkeypatch.setattr(density, "cut", lambda df: (rounds.append(1), real(df))[1])
    got = {(r._k, r.cluster.c): (r.selected, r.deepest_death) for r in density._select(real(nodes), method, 0.0).collect()}
    assert len(rounds) < 40  # two tables a round at most
    kids, facts = {}, {(k, i): (p, s, d) for k, i, p, s, d in rows}
    for (k, i), (p, _, _) in facts.items():
        kids.setdefault((k, p), []).append((k, i))
    best, deep, wins = {}, {}, {}
    for node in sorted(facts, key=lambda n: -n[1]):
        below = kids.get(node, [])
        total = sum(best[c] for c in below)
        wins[node] = (not below) if method == "leaf" else not below or total <= facts[node][1]
        best[node] = max(facts[node][1], total) if below else facts[node][1]
        deep[node] = max([facts[node][2], *(deep[c] for c in below)])
    for node, (parent, _, _) in facts.items():
        above, free = parent, parent is not None
        while above is not None:
            if facts[node[0], above][0] is not None and wins[node[0], above]:
                free = False
            above = facts[node[0], above][0]
        assert got[node] == (free and wins[node], deep[node]), node


def test_selected_clusters_climb_above_a_distance(spark):
    name = "struct<w: double, c: long>"
    rows = [(0, None, 0.0), (1, 0, 0.4), (2, 1, 2.0), (3, 2, 4.0), (4, 0, 5.0)]  # births; eps 0.6 is lambda 1.67
    data = [("k", (0.0, i), None if p is None else (0.0, p), b, i in (3, 4)) for i, p, b in rows]
    state = spark.createDataFrame(data, f"_k string, cluster {name}, parent {name}, birth double, selected boolean")
    got = density._merge_below(state, 0.6)
    assert {r.cluster.c for r in got.where("selected").collect()} == {1, 4}


def test_ward_merges_like_the_definition():
    rng = np.random.default_rng(5)
    for n in (2, 3, 9, 40):
        x = rng.normal(size=(n, 2))
        groups, want = {i: [i] for i in range(n)}, []
        while len(groups) > 1:
            def gap(a, b):
                p, q = x[groups[a]], x[groups[b]]
                return 2 * len(p) * len(q) / (len(p) + len(q)) * ((p.mean(0) - q.mean(0)) ** 2).sum()
            h, a, b = min((gap(a, b), a, b) for a in groups for b in groups if a < b)
            want.append((h**0.5, a, b))
            groups[a] += groups.pop(b)
        got = ward.merges(x)
        assert [m[1:] for m in got] == [m[1:] for m in want]
        assert np.allclose([m[0] for m in got], [m[0] for m in want])
        assert [len(set(ward.cut_labels(n, got, k))) for k in range(1, n + 1)] == list(range(1, n + 1))
    equal = ward.merges(np.zeros((4, 2)))
    assert len(equal) == 3 and {m[0] for m in equal} == {0.0}


def test_queries_that_reach_all_cells_move_points_by_groups(spark, monkeypatch):
    """In many dimensions every cell is within reach: a stage hands on points times groups, not queries times cells."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 40))
    rows = [(f"k{i % 2}", f"n{i:04d}", v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, id string, v array<double>")
    most = []
    whole = neighbours.sweep

    def seen(queries, index, points, reach, visit, schema):
        out = whole(queries, index, points, reach, visit, schema)
        dealt = neighbours._dealt(index, queries)[1]
        pairs = queries.mapInArrow(lambda bs: (pa.record_batch([pa.array(c.astype("int32"))], names=["c"]) for b in bs for _, c in reach(b)), "c int")
        most.append((dealt, pairs.count()))
        return out

    monkeypatch.setattr(neighbours, "sweep", seen)
    monkeypatch.setattr(neighbours, "LEAST_GROUP", 100)
    got = {}
    for r in neighbours.neighbours(df, ["k"], "id", "v", 4, cell_rows=30).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbour))
    for i in range(900):
        others = sorted((float(np.linalg.norm(x[i] - x[j])), f"n{j:04d}") for j in range(i % 2, 900, 2) if j != i)[:4]
        assert [n for _, n in sorted(got[f"n{i:04d}"])] == [n for _, n in others]
    (groups, pairs), = most
    assert groups <= 2 * neighbours.GROUPS and pairs > 900 * 5


def test_groups_hold_equal_distances_and_hot_cells(spark, monkeypatch):
    """Points of a grid: ties go to the smaller identifier, also between groups and blocks; a cell may be many groups."""
    monkeypatch.setattr(neighbours, "LEAST_GROUP", 16)
    monkeypatch.setattr(neighbours, "GROUP_BYTES", 16 * 16)
    x = [(float(a), float(b)) for a in range(18) for b in range(18)]
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(x)], "id long, v array<double>")
    got = {}
    for r in neighbours.neighbours(df, [], "id", "v", 5, cell_rows=60).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbour))
    for i, v in enumerate(x):
        want = sorted((round(float(np.hypot(v[0] - w[0], v[1] - w[1])), 9), j) for j, w in enumerate(x) if j != i)[:5]
        assert [n for _, n in sorted(got[i])] == [n for _, n in want]
