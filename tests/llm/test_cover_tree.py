import numpy as np
import pytest

from textgate.llm.cover_tree import build, cosine_links, dual_traversal


def sample(n, seed=0, width=16):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width))
    for k in range(0, n, 5):
        x[k:k + 3] = x[k] + r.normal(0, 0.12, (len(x[k:k + 3]), width))
    return x


def brute(rows, threshold=0.9):
    valid = [v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    scaled = [np.array(v, float) / np.abs(v).max() if ok else None for (_, v), ok in zip(rows, valid)]
    unit = [v / np.linalg.norm(v) if v is not None else None for v in scaled]
    n, links, parent = len(rows), [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(n):
        for j in range(i):
            if valid[i] and valid[j] and len(unit[i]) == len(unit[j]) and (rows[i][1] == rows[j][1] or unit[i] @ unit[j] >= threshold):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    best = {}
    for k in range(n):
        if rows[k][0] is not None and valid[k]:
            best[root(k)] = min(rows[k][0], best.get(root(k), rows[k][0]))
    return sorted(((i, links[k], best.get(root(k), i) if valid[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def test_traversal_finds_exactly_the_pairs():
    x, y = sample(700), sample(500, 1)
    y[:100] = x[:100] + 0.05
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    a, b = build(x, 0.1), build(y, 0.1)
    for p, q, s, t in ((a, b, x, y), (a, a, x, x)):
        got = [pair for i, j in dual_traversal(p, q, 0.9) for pair in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == set(zip(*(k.tolist() for k in np.nonzero(s @ t.T >= 0.9))))


def test_levels_are_nested_with_halving_radii():
    x = sample(400)
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree, radius = build(x, 0.05), 2.0
    for up, down in zip(tree.levels, tree.levels[1:]):
        radius /= 2
        assert set(up.centre.tolist()) <= set(down.centre.tolist())
        assert (down.radius <= radius + 1e-9).all()
        assert up.count.sum() == len(down.centre)


@pytest.mark.parametrize("block", [40, 10_000])
def test_equals_brute_force_on_edge_rows(spark, block):
    rows = [(1000 + i, v.tolist()) for i, v in enumerate(sample(300))]
    same = rows[7][1]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [float("nan")] + [1.0] * 15), (5, [float("inf")] * 16), (6, [None] + [1.0] * 15),
             (None, same), (8, same), (9, same), (9, same), (10, [2 * c for c in same]), (1000, rows[40][1]), (11, [1e300] * 16), (12, [1e-300] * 16)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, unit string")
    got = cosine_links(df, block=block, cells=8).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_dense_cluster_and_empty(spark):
    r = np.random.default_rng(4)
    x = np.ones(8) + r.normal(0, 0.01, (500, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert {(r.n_links, r.component_id) for r in cosine_links(df, block=60).collect()} == {(499, 0)}
    assert cosine_links(df.limit(0)).count() == 0


def test_vectors_of_several_lengths_and_null_ids(spark):
    rows = [(i, [1.0, i / 1000]) for i in range(30)] + [(100 + i, [1.0, 0.0, i / 1000]) for i in range(20)] + [(5, [1.0]), (7, [-1.0]), (None, [-3.0])]
    rows += [(None, [1.0, 0.001]), (None, [0.0, 0.0, 5.0]), (None, [0.0, 0.0, 5.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cosine_links(df, block=8, cells=3).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)
    assert sum(r.kept for r in got) == 1 + 1 + 1 + 1 + 2
