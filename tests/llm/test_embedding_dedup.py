"""Links, counts and components against brute force."""

import math

import numpy as np
import pytest

from tripflow.llm import embedding_dedup as E


def brute(rows, cosine=0.95):
    sound = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            sound[i] = np.array(v, float)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = [0] * len(rows)
    for i in sound:
        for j in sound:
            if i < j and len(sound[i]) == len(sound[j]) and E.exact_cosine(sound[i], sound[j]) >= cosine:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        least[r] = min(x for x in (least.get(r), key) if x is not None) if key is not None or r in least else None
    return sorted(((key, n[i], least[find(i)], key == least[find(i)]) for i, (key, _) in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<float>, id string, node int")
    df = df.repartition(3)
    return sorted(map(tuple, E.similar_components(df, "vec_id", "embedding").collect()), key=str)


def clustered(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), dim))
    v = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * spread
    return [(int(i), [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]


def test_odd_vectors_and_ids(spark):
    rows = [
        (5, [1.0, 0.0]), (3, [2.0, 0.0]), (9, [1.0, 0.05]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (7, None), (8, []),
        (10, [0.0, 0.0]), (11, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (13, [None, 1.0]), (14, [1.0, 0.0, 0.0]),
        (15, [-1.0, 0.0]), (16, [-0.0, -3.0]), (17, [1e-30, 1e-30]), (18, [1e30, 1e30]),
    ]
    assert run(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert E.similar_components(empty, "vec_id", "embedding").count() == 0


@pytest.mark.parametrize("spread", [0.02, 0.12, 0.25])
def test_many_blocks_against_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(E, "BLOCK_POINTS", 64)
    rows = clustered(int(spread * 100), 400, 6, spread)
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a large group of copies
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_traversal_of_one_pair_of_blocks(seed):
    rng = np.random.default_rng(seed)
    v = np.array([r[1] for r in clustered(seed, 300, 5, [0.005, 0.05, 0.15, 0.4][seed])])
    a, b = v[:170], v[170:]
    ca, cb = rng.integers(1, 4, 170), rng.integers(1, 4, 130)
    found = E.Links(E.Tree(a), E.Tree(b), False, ca, cb, 0.95).run()
    links = np.array([[E.exact_cosine(x, y) >= 0.95 for y in b] for x in a])
    assert (found.count_a == links @ cb).all() and (found.count_b == ca @ links).all()
    own = E.Tree(a)
    found = E.Links(own, own, True, ca, ca, 0.95).run()
    links = np.array([[E.exact_cosine(x, y) >= 0.95 for y in a] for x in a]) & ~np.eye(170, dtype=bool)
    assert (found.count_a == links @ ca).all()
    for level in range(own.depth):
        for node, below in enumerate(own.below[level]):
            centre, radius = own.levels[level][0][node], own.levels[level][1][node]
            assert E.distances(own.points[[centre]], own.points[below]).max() <= radius + 1e-12
