from __future__ import annotations

import numpy as np

from tidemark.llm.embedding_dedup import near_vectors


def brute(rows, least=0.95):
    units = []
    for _, v in rows:
        fine = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, "f8") / np.abs(v).max() if fine else None)
        if fine:
            units[-1] /= np.linalg.norm(units[-1])
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                n[a] += 1
                n[b] += 1
                root[find(a)] = find(b)
    least_id = {}
    for i, (key, _) in enumerate(rows):
        least_id[find(i)] = min(least_id.get(find(i), key), key)
    return sorted((k, n[i], least_id[find(i)], k == least_id[find(i)]) for i, (k, _) in enumerate(rows))


def test_links_are_those_of_all_pairs(spark):
    draw = np.random.default_rng(1)
    x = draw.standard_normal((260, 24))
    near = np.repeat(x[:6], 25, axis=0) + 0.08 * draw.standard_normal((150, 24))
    pairs = x[20:60] + 0.15 * draw.standard_normal((40, 24))
    rows = [*x.tolist(), *near.tolist(), *pairs.tolist(), *[x[0].tolist()] * 40, (x[0] * 1e200).tolist(), (x[0] * 2).tolist()]
    rows += [None, [], [0.0] * 24, [None] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]
    rows = list(zip(range(5, 5 + len(rows)), rows, strict=True))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id as node", "1 as copies", "'x' as kept")
    got = sorted(tuple(r) for r in near_vectors(table).collect())
    want = brute(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.97 * true
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    if found == true:
        assert got == want


def test_no_rows(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    one = spark.createDataFrame([(3, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in near_vectors(one).collect()] == [(3, 0, 3, True)]


def grouped(centers, each, within, seed):
    """Unit vectors around each center, all at the same angle from it, in directions of their own."""
    draw = np.random.default_rng(seed)
    out = []
    for c in centers:
        side = draw.standard_normal((each, len(c)))
        side -= np.outer(side @ c, c)
        out.append(np.sqrt(within) * c + np.sqrt(1 - within) * side / np.linalg.norm(side, axis=1, keepdims=True))
    return np.concatenate(out)


def test_groups_that_fill_each_others_lists_are_one(spark):
    centers = np.zeros((4, 64))
    centers[0, 0] = centers[2, 1] = centers[3, 2] = 1
    angle = np.arccos(0.96 / 0.99)
    centers[1, 0], centers[1, 3] = np.cos(angle), np.sin(angle)
    rows = list(enumerate(grouped(centers, 60, 0.99, 3).tolist()))
    want = brute(rows)
    assert len({r[2] for r in want}) == 3
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_lost_pairs_beside_a_crowd_are_compared_at_last(spark):
    draw = np.random.default_rng(5)
    crowd = grouped(np.eye(48)[:1], 150, 0.99, 6)
    x = draw.standard_normal((400, 48))
    rows = list(enumerate([*crowd.tolist(), *x.tolist(), *(x + 0.15 * draw.standard_normal(x.shape)).tolist()]))
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), orders=1, most_rounds=0, attempts=1)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
