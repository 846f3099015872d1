import itertools

import numpy as np

from prepframe.llm.lattice import near_duplicates, nearest_e8


def test_nearest_point_of_e8():
    r = np.random.RandomState(1)
    x = r.randn(300, 8) * 1.3
    p, other = nearest_e8(x)
    for q in (p, other):
        assert ((q % 2 == 0).all(1) | (q % 2 == 1).all(1)).all() and (q.sum(1) % 4 == 0).all()
    best = np.full(len(x), np.inf)
    for half in (0.0, 0.5):
        for c in itertools.product((0, 1), repeat=8):
            z = np.floor(x - half) + np.array(c) + half
            even = np.rint(z.sum(1)).astype(int) % 2 == 0
            d = ((x - z) ** 2).sum(1)
            best = np.where(even, np.minimum(best, d), best)
    assert np.allclose(((x - p / 2) ** 2).sum(1), best)


def brute(rows, cosine):
    ids = [i for i, _ in rows]
    x = [None if v is None or not len(v) or any(a is None or not np.isfinite(a) for a in v) or not any(v) else np.array(v) / np.linalg.norm(v) for _, v in rows]
    n, root, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if x[a] is not None and x[b] is not None and len(x[a]) == len(x[b]) and x[a] @ x[b] >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for a in range(n):
        low[find(a)] = min(low.get(find(a), ids[a]), ids[a])
    return {(ids[a], links[a], low[find(a)], low[find(a)] == ids[a]) for a in range(n)}


def test_near_duplicates_equal_brute_force(spark):
    r = np.random.RandomState(2)
    rows = [(i, r.randn(64).tolist()) for i in range(300)]
    for k, noise in enumerate((0.05, 0.15, 0.3)):  # cosines of about 0.999, 0.98 and 0.92
        for j in range(60):
            v = np.array(rows[5 * j % 40][1])
            rows.append((1000 + 100 * k + j, (v + noise * r.randn(64)).tolist()))
    hot = r.randn(64)
    rows += [(2000 + j, (hot + 0.02 * r.randn(64)).tolist()) for j in range(90)] + [(2200 + j, (3 * hot).tolist()) for j in range(9)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 64), (3003, [float("nan")] * 64), (3004, [None] + [1.0] * 63), (3005, [1e-30] * 64), (3006, [1e30] * 64), (3007, [1.0] * 16)]
    rows.append(rows[-1])
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, weight int").repartition(5)
    got = {tuple(x) for x in near_duplicates(df, chunk=16).collect()}
    want = brute(rows, 0.9)
    assert {g[0] for g in got} == {w[0] for w in want}
    total = sum(w[1] for w in want)
    found = sum(g[1] for g in got)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))
    assert found >= 0.98 * total
    assert len({g[:3] for g in got} & {w[:3] for w in want}) >= 0.97 * len(want)
    assert near_duplicates(df.limit(0)).collect() == []
