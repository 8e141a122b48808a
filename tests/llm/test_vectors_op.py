import math

import numpy as np
import pytest

from windward.llm import vectors


def brute(rows, limit=0.95):
    """n_links and component per distinct (id, vector)."""
    rows = sorted({(i, None if v is None else tuple(v)) for i, v in rows}, key=lambda x: (x[0] is None, x[0] or 0, str(x[1])))
    usable = [v is not None and any(x not in (0, None) for x in v) and all(x is not None and math.isfinite(x) for x in v) for _, v in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if usable[a] and usable[b] and len(rows[a][1]) == len(rows[b][1]):
                u, v = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if u @ v / math.sqrt(u @ u) / math.sqrt(v @ v) >= limit:
                    links[a] += 1
                    links[b] += 1
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {r: (links[i], rows[find(i)][0]) for i, r in enumerate(rows)}


def check(spark, rows, **options):
    clashing = ", ".join(f"'x' {c}" for c in ("cls", "v", "n", "id", "block", "position", "kept", "component_id", "n_links", "row", "vector"))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *clashing.split(", "))
    want = brute(rows)
    got = vectors.near_duplicates(df, **options).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in got) == sorted(
        str((i, *want[i, None if v is None else tuple(v)])) for i, v in rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_groups_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 40)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(150)]
    centre = rng.standard_normal(16)
    rows += [(1000 + i, (centre + 0.08 * rng.standard_normal(16)).tolist()) for i in range(60)]
    rows += [(2000 + i, rows[3][1]) for i in range(50)] + [(3000, [x * 7 for x in rows[3][1]]), (3001, [-x for x in rows[3][1]])]
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [float("nan")] * 16), (4003, [float("inf")] + [0.0] * 15), (4004, []), (4005, [None] * 16),
             (4006, [1.0, 2.0]), (4007, [1.0, 2.1]), (4008, [1e-200, 2e-200]), rows[5], rows[5], (3002, rows[5][1])]
    check(spark, rows)


def test_links_at_the_limit_are_exact(spark):
    a = [1.0, 0.0, 0.0]
    for c, linked in ((0.9501, 1), (0.9499, 0)):
        got = vectors.near_duplicates(spark.createDataFrame([(1, a), (2, [c, math.sqrt(1 - c * c), 0.0])], "vec_id long, embedding array<double>")).collect()
        assert [r.n_links for r in got] == [linked] * 2


def test_recall_at_the_limit(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        u = rng.standard_normal(64)
        u /= np.linalg.norm(u)
        w = rng.standard_normal(64)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        c = 0.9505
        rows += [(2 * i, u.tolist()), (2 * i + 1, (c * u + math.sqrt(1 - c * c) * w).tolist())]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("n_links > 0").count()
    assert found >= 0.995 * len(rows)


def test_plan_meets_its_recall():
    for n in (100, 10**5, 10**8):
        plan = vectors.Plan(n)
        p = math.erf(vectors.WIDTH / math.sqrt(2))
        meet = 1 - (1 - p**plan.grid) ** plan.tables
        enough = sum(math.comb(plan.n, c) * p**c * (1 - p) ** (plan.n - c) for c in range(plan.least, plan.n + 1))
        assert (1 - meet) + (1 - enough) <= 1 - vectors.RECALL + 1e-9


def test_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_repeated_rows(spark):
    pytest.importorskip("numpy")
    check(spark, [(1, [1.0, 2.0])] * 3 + [(2, [1.0, 2.0])])
