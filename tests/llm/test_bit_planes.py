import hashlib
import math
import random

import numpy as np
import pytest

from docquarry.llm.bit_planes import cluster_planes, dot_products, nearest, plane_weights, planes_of, values_of


@pytest.mark.parametrize("n_planes", [1, 2, 11, 28])
def test_planes_give_exact_dot_products_and_distances(n_planes):
    rng = np.random.default_rng(n_planes)
    low, high = -(1 << (n_planes - 1)), 1 << (n_planes - 1)
    x, c = rng.integers(low, high, (70, 64)), rng.integers(low, high, (5, 64))
    x[0], x[1], c[0] = low, high - 1, high - 1  # the largest distance there is
    px, pc = planes_of(x, n_planes), planes_of(c, n_planes)
    assert (values_of(px) == x).all() and sum(plane_weights(n_planes)) == -1
    assert dot_products(px, px).tolist() == [sum(int(a) * int(a) for a in row) for row in x]
    best, distance = nearest(px, dot_products(px, px), pc)
    for row, j, d in zip(x, best, distance):
        all_of_them = [sum((int(a) - int(b)) ** 2 for a, b in zip(row, other)) for other in c]
        assert d == min(all_of_them) and j == all_of_them.index(d)


def brute_force(rows, k, rounds):
    """Plain Python over (vec_id, vector) rows; the rows' order settles hash ties of equal ids."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: name(r[0]))[:k]]

    def place(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[place(v)[0]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    rows = [(i, *place(v)) for i, v in kept]
    by = {j: sum(d for _, c, d in rows if c == j) for j in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, by[j], sum(by.values()), digest[j]) for i, j, d in rows), key=str)


def test_clusters_against_brute_force_with_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * (1 + i % 3) for _ in range(64)]) for i in range(150)]
    same = [0.25] * 64
    rows += [(200 + i, same) for i in range(60)]  # a third of the rows are one vector
    rows += [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 65), (304, [float("nan")] + [0.0] * 63), (305, [float("inf")] + [0.0] * 63), (306, [None] + [0.0] * 63), (None, same), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int").repartition(5)
    for k, rounds in ((8, 10), (3, 0), (1, 2)):
        got = sorted((tuple(r) for r in cluster_planes(table, k=k, rounds=rounds).collect()), key=str)
        assert got == brute_force(rows, k, rounds)


def test_few_no_and_too_large_vectors(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert cluster_planes(frame([])).collect() == [] and cluster_planes(frame([(1, None)])).collect() == []
    got = {r.vec_id: (r.distance, r.inertia) for r in cluster_planes(frame([(1, [0.0] * 64), (2, [1.0] * 64)])).collect()}
    assert got == {1: (0, 0), 2: (0, 0)}
    with pytest.raises(ValueError):
        cluster_planes(frame([(1, [1e300] * 64)]))
