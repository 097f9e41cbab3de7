import math
import random

import numpy as np

from ludolens.llm import embeddings
from ludolens.llm.components import components, forest

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _brute(rows, threshold):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    rows = [(k, np.array(v, np.float64), y) if k is not None and y is not None and usable(v) else (k, None, y) for k, v, y in rows]
    n = len(rows)
    near = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and a[1] is not None and b[1] is not None and a[2] == b[2] and len(a[1]) == len(b[1]):
                cosine = a[1] @ b[1] / (np.linalg.norm(a[1]) * np.linalg.norm(b[1]))
                near[i][j] = cosine >= threshold
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            at = todo.pop()
            for j in range(n):
                if near[at][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        component = None if rows[i][0] is None else min(rows[j][0] for j in seen)
        out.append((rows[i][0], sum(near[i]), component, rows[i][0] is None or rows[i][0] == component))
    return sorted(out, key=repr)


def _vectors(count):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(6, 8))
    rows = []
    for i in range(count):
        v = centers[i % 6] + rng.normal(size=8) * rng.choice([0, 0.05, 0.2, 1])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 2))))
    return rows


def test_links_equal_brute_force(spark):
    rows = _vectors(150)
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] + [1.0] * 7, 1), (203, [float("inf")] + [1.0] * 7, 1)]
    rows += [(204, [None] + [1.0] * 7, 0), (205, rows[0][1], None), (None, rows[0][1], 1), (206, [1.0, 2.0], 1)]
    rows += [(207, [1.0, 2.0], 1), (208, [1.0, 2.0], 1), (209, [], 1), (210, [1e-30, 2e-30], 1), (211, [1e30, 2e30], 1)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in embeddings.link(table, 0.98, tile=16).collect()), key=repr)
    assert got == _brute(rows, 0.98)


def test_bounds_hold_and_no_pair_is_lost():
    rng = np.random.default_rng(10)
    a = rng.normal(size=(60, 48)) * rng.choice([1e-3, 1, 1e3], size=(60, 1))
    b = np.concatenate([a[:30] + rng.normal(size=(30, 48)) * 0.02, rng.normal(size=(30, 48))])
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    steps, scale, error = embeddings.quantise(unit)
    assert np.abs(steps).max() <= 127
    assert (np.linalg.norm(unit - steps * scale[:, None], axis=1) <= error + 1e-12).all()
    i, j = embeddings.linked_pairs(a, b, 0.9)
    cosine = unit @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(cosine >= 0.9))))


def test_large_group_of_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0 + (i % 2) * 1e-3], 1) for i in range(300)]
    got = embeddings.link(spark.createDataFrame(rows, SCHEMA), tile=4).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(299, 0)}


def test_no_rows(spark):
    assert embeddings.link(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_random_graphs(spark):
    rng = random.Random(11)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(500 + i, 501 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "left bigint, right bigint")).collect()}
    low = {n: n for pair in links for n in pair}
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    for node, least in low.items():
        assert got.get(node, node) == least


def test_forest_connects_the_same():
    child, parent = forest(np.array([5, 9, 9, 1]), np.array([9, 5, 2, 1]))
    assert dict(zip(child.tolist(), parent.tolist())) == {5: 2, 9: 2}
