"""Laplacian eigenvectors against dense ones: rings, two moons, several keys, unconnected graphs."""

import numpy as np
import pytest

from ticketloom.operators import neighbours as nb
from ticketloom.operators import spectral


def dense(edges, n):
    w = np.zeros((n, n))
    for a, b, x in edges:
        w[a, b] += x
        w[b, a] += x
    d = w.sum(1)
    return w / np.sqrt(np.outer(d, d)), d


def rows_of(found, key):
    out = {}
    for r in found.vectors.where(f"k = '{key}'").collect():
        out.setdefault(r.component, {})[r.id] = r.value
    return out


def ring(n):
    return [(i, (i + 1) % n, 1.0) for i in range(n)]


def test_rings_and_a_grid_side_by_side(spark):
    grid = [(6 * i + j, 6 * i + j + 1, 1.0) for i in range(9) for j in range(5)]
    grid += [(6 * i + j, 6 * i + j + 6, 0.5 + 0.1 * j) for i in range(8) for j in range(6)]
    tables = {"ring": (ring(40), 40), "grid": (grid, 54), "path": ([(i, i + 1, 1.0) for i in range(4)], 5)}
    data = [(k, a, b, w) for k, (edges, _) in tables.items() for a, b, w in edges]
    graph = spark.createDataFrame(data, "k string, a long, b long, weight double")
    found = spectral.eigenvectors(graph, ["k"], tolerance=1e-4)
    values = {(r.k, r.component): r for r in found.values.collect()}
    for k, (edges, n) in tables.items():
        matrix, d = dense(edges, n)
        want = np.sort(np.linalg.eigvalsh(matrix))[::-1][1:3]
        vectors = rows_of(found, k)
        for j in range(2):
            x = np.array([vectors[j][i] for i in range(n)])
            got = values[k, j]
            assert got.residual <= 1e-4
            assert abs(got.eigenvalue - want[j]) < 1e-5
            assert np.linalg.norm(matrix @ x - got.eigenvalue * x) < 2 * 1e-4
            assert abs(np.linalg.norm(x) - 1) < 1e-6 and abs(x @ np.sqrt(d)) < 1e-5
            assert x[max(range(n), key=lambda i: (round(abs(x[i]), 6), i))] > 0


def test_two_moons_come_apart(spark):
    rng = np.random.default_rng(7)
    t = rng.uniform(0, np.pi, 120)
    upper = np.c_[np.cos(t), np.sin(t)] + rng.normal(0, 0.04, (120, 2))
    lower = np.c_[1 - np.cos(t), 0.45 - np.sin(t)] + rng.normal(0, 0.04, (120, 2))
    gaps = np.linalg.norm(np.r_[upper, lower][:, None] - np.r_[upper, lower][None], axis=2)
    near = [("m", i, int(j), float(gaps[i, j])) for i in range(240) for j in np.argsort(gaps[i])[1:9]]
    near = spark.createDataFrame(near, "k string, id long, neighbour long, distance double")
    graph = nb.fuzzy_graph(near, ["k"], "id", 8).cache()
    placed, values = spectral.layout(graph, ["k"], components=2, tolerance=1e-5)
    first = {r.id: r.reduced[0] for r in placed.collect()}
    edges = [(r.a, r.b, r.weight) for r in graph.collect()]
    matrix, _ = dense(edges, 240)
    want = np.linalg.eigh(matrix)
    assert abs(values.where("component = 0").first().eigenvalue - want[0][-2]) < 1e-5
    x, y = np.array([first[i] for i in range(240)]), want[1][:, -2]
    if want[0][-2] - want[0][-3] > 1e-3:
        assert abs(abs(x @ y) - 1) < 1e-3
    # one side of zero is one moon, up to a few points where the moons touch
    sides = x > np.median(x)
    assert max(np.mean(sides[:120]), 1 - np.mean(sides[:120])) > 0.85


def test_unconnected_graph_and_no_edges(spark):
    graph = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (5, 6, 2.0), (9, 9, 1.0)], "a long, b long, weight double")
    found = spectral.eigenvectors(graph, [], node="n", components=3)
    assert [round(r.eigenvalue, 6) for r in found.values.orderBy("component").collect()] == [1.0, 0.0, -1.0]
    assert {r.n for r in found.vectors.collect()} == {0, 1, 2, 5, 6}
    empty = spectral.eigenvectors(graph.limit(0), [], node="n")
    assert empty.vectors.count() == empty.values.count() == 0


@pytest.mark.parametrize("n", [2, 3])
def test_fewer_nodes_than_vectors(spark, n):
    graph = spark.createDataFrame(ring(n) if n > 2 else [(0, 1, 1.0)], "a long, b long, weight double")
    placed, values = spectral.layout(graph, [], components=2)
    assert values.count() == n - 1 and placed.count() == n


def test_long_ring_settles(spark):
    graph = spark.createDataFrame(ring(2000), "a long, b long, weight double")
    found = spectral.eigenvectors(graph, [], tolerance=1e-7).values.collect()
    assert len(found) == 2 and all(r.residual <= 1e-7 for r in found)
    assert all(abs(r.eigenvalue - np.cos(2 * np.pi / 2000)) < 1e-9 for r in found)


def test_large_keys_by_joins_beside_small_ones(spark, monkeypatch):
    data = [("small", i, (i + 1) % 9, 1.0 + i) for i in range(9)] + [("large", i, (i * 7 + 1) % 30, 1.0 + i % 3) for i in range(30)]
    graph = spark.createDataFrame(data, "k string, a long, b long, weight double")
    inside = {(r.k, r.component): r.eigenvalue for r in spectral.eigenvectors(graph, ["k"], tolerance=1e-5).values.collect()}
    monkeypatch.setattr(spectral, "LOCAL_ENTRIES", 20)
    found = spectral.eigenvectors(graph, ["k"], tolerance=1e-5)
    joined = {(r.k, r.component): r.eigenvalue for r in found.values.collect()}
    assert inside.keys() == joined.keys() and len(joined) == 4
    assert all(abs(inside[x] - joined[x]) < 1e-6 for x in joined)
    assert found.vectors.count() == 2 * (9 + 30)
