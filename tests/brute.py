"""Small single-process counterparts of the graph operators, for comparison on fixtures."""

from __future__ import annotations

import numpy as np


def pairwise(x: np.ndarray) -> np.ndarray:
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))


def core_distances(x: np.ndarray, m: int) -> np.ndarray:
    return np.sort(pairwise(x), axis=1)[:, min(m, len(x) - 1)]


def reachability(x: np.ndarray, m: int) -> np.ndarray:
    c = core_distances(x, m)
    r = np.maximum(pairwise(x), np.maximum(c[:, None], c[None, :]))
    np.fill_diagonal(r, 0)
    return r


def mst_edges(r: np.ndarray) -> list[tuple[float, int, int]]:
    n, seen, out = len(r), {0}, []
    best = {j: (r[0, j], 0) for j in range(1, n)}
    while best:
        j = min(best, key=lambda t: best[t][0])
        w, i = best.pop(j)
        out.append((float(w), i, j))
        seen.add(j)
        for t in best:
            if r[j, t] < best[t][0]:
                best[t] = (r[j, t], j)
    return out


def flat(x: np.ndarray, m: int, eps: float, size: int) -> set[frozenset[int]]:
    parent = list(range(len(x)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for w, i, j in mst_edges(reachability(x, m)):
        if w <= eps:
            parent[find(i)] = find(j)
    groups: dict[int, set[int]] = {}
    for i in range(len(x)):
        groups.setdefault(find(i), set()).add(i)
    return {frozenset(g) for g in groups.values() if len(g) >= size}


def condensed(x: np.ndarray, m: int, size: int):
    """Clusters of the condensed tree: (members at birth, birth lambda, stability, children, point lambdas)."""
    edges = sorted(mst_edges(reachability(x, m)), reverse=True)
    nodes = []

    def split(members: set[int], removed: int):
        """Components of members by the edges after position ``removed``."""
        adj: dict[int, list[int]] = {i: [] for i in members}
        for w, i, j in edges[removed:]:
            if i in members and j in members:
                adj[i].append(j)
                adj[j].append(i)
        out, left = [], set(members)
        while left:
            stack, comp = [left.pop()], set()
            while stack:
                i = stack.pop()
                comp.add(i)
                for j in adj[i]:
                    if j in left:
                        left.remove(j)
                        stack.append(j)
            out.append(comp)
        return out

    def grow(members: set[int], birth: float, at: int) -> int:
        me = len(nodes)
        node = {"members": set(members), "birth": birth, "lambda": {}, "children": []}
        nodes.append(node)
        current, pos = set(members), at
        while True:
            if pos >= len(edges):
                break
            w = edges[pos][0]
            end = pos
            while end < len(edges) and edges[end][0] == w:
                end += 1
            parts = [p for p in split(current, end) if len(p) >= size]
            lam = 1.0 / w
            if len(parts) == 1:
                for i in current - parts[0]:
                    node["lambda"][i] = lam
                current, pos = parts[0], end
                continue
            for i in current:
                node["lambda"][i] = lam
            if len(parts) > 1:
                node["children"] = [grow(p, lam, end) for p in parts]
            break
        node["stability"] = sum(v - birth for v in node["lambda"].values())
        return me

    grow(set(range(len(x))), 0.0, 0)
    return nodes


def select(nodes) -> list[int]:
    best, chosen = {}, set()
    for i in reversed(range(len(nodes))):
        kids = nodes[i]["children"]
        total = sum(best[c] for c in kids)
        if i == 0:
            break
        if kids and total > nodes[i]["stability"]:
            best[i] = total
        else:
            best[i] = nodes[i]["stability"]
            stack = list(kids)
            while stack:
                c = stack.pop()
                chosen.discard(c)
                stack.extend(nodes[c]["children"])
            chosen.add(i)
    return sorted(chosen)
