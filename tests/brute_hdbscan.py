"""HDBSCAN of one group in memory, from the whole hierarchy at once: what the distributed operator is compared with."""

import numpy as np

from paceline.operators.hierarchy import TIE


def spanning_tree(x, k):
    """Edges (weight, a, b), a < b, of the minimum spanning tree under mutual reachability, by Kruskal over all pairs."""
    n = len(x)
    sq = np.zeros((n, n))
    for i in range(x.shape[1]):
        sq += (x[:, i][:, None] - x[:, i][None]) ** 2
    d = np.sqrt(sq)
    core = np.sort(d, axis=1)[:, min(k, n - 1)]
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    root, out = list(range(n)), []

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for weight, a, b in sorted((w[a, b], a, b) for a in range(n) for b in range(a + 1, n)):
        if top(a) != top(b):
            root[top(b)] = top(a)
            out.append((weight, a, b))
    return out


def labels(x, min_cluster_size=5, min_samples=3):
    """Clusters as sets of rows: the dendrogram is split from the top, then the more persistent of parent and children stays."""
    n = len(x)
    if n < max(min_samples, 2):
        return set()
    least = min(min_cluster_size, max(2, n // 4))
    tree = spanning_tree(x, min(min_samples, least))

    def split(rows, edges):
        """The two sides of the heaviest edge."""
        (weight, a, _), rest = edges[-1], edges[:-1]
        near, todo = {a}, [a]
        while todo:
            i = todo.pop()
            for _, p, q in rest:
                for s, t in ((p, q), (q, p)):
                    if s == i and t not in near:
                        near.add(t)
                        todo.append(t)
        one = (rows & near, [e for e in rest if e[1] in near])
        return 1.0 / max(weight, 1e-12), one, (rows - near, [e for e in rest if e[1] not in near])

    def walk(rows, edges, born, whole):
        """(value, clusters) of a cluster that starts with these rows."""
        own, held = 0.0, rows
        while edges:
            level, a, b = split(rows, edges)
            large = [s for s in (a, b) if len(s[0]) >= least]
            if len(large) == 1:
                own += (len(rows) - len(large[0][0])) * (level - born)
                rows, edges = large[0]
                continue
            own += len(rows) * (level - born)
            parts = [walk(*s, level, False) for s in large]
            inner = sum(v for v, _ in parts)
            below = [c for _, cs in parts for c in cs]
            if not whole and own >= inner - TIE * abs(inner):
                return max(own, inner), [held]
            return inner, below
        return own, [] if whole else [held]

    return {frozenset(c) for c in walk(set(range(n)), tree, 0.0, True)[1]}
