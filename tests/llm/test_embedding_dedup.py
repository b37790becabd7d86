import math

import numpy as np

from strata.llm import embedding_dedup as ed

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """(id, links, component, kept) of every row, by comparing all rows."""
    def fit(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    near = [[] for _ in range(n)]
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            _, w, other = rows[j]
            if label is None or label != other or not fit(v) or not fit(w) or len(v) != len(w):
                continue
            a, b = np.array(v, np.float64), np.array(w, np.float64)
            if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                near[i].append(j)
                near[j].append(i)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        low = min(ids) if ids else None
        for k in group:
            out[k] = (rows[k][0], len(near[k]), low, rows[k][0] is not None and rows[k][0] == low)
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", n_links int")
    return sorted((tuple(r) for r in ed.near_vectors(df, **options).collect()), key=str)


def float32(v):
    return [float(np.float32(x)) for x in v]


def corpus(rng, strangers=300, chains=40, dim=16):
    rows = [float32(rng.standard_normal(dim)) for _ in range(strangers)]
    for _ in range(chains):
        at = rng.standard_normal(dim)
        for _ in range(int(rng.integers(2, 9))):  # each near the one before
            at = at / np.linalg.norm(at) + rng.standard_normal(dim) * 0.04
            rows.append(float32(at))
    return [(k, v, int(rng.integers(3))) for k, v in enumerate(rows)]


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(k, v, label % 2) for k, v, label in corpus(rng)]
    # Chains share a label only by chance; put each chain's rows under one.
    rows = [(k, v, 0 if k >= 300 else label) for k, v, label in rows]
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(r[1] for r in got) > 100


def test_odd_rows(spark):
    a = float32([1, 2, 3, 4])
    rows = [(1, a, 1), (1, a, 1), (2, [2 * x for x in a], 1), (3, a, 2), (4, a, None), (None, a, 1),
            (5, None, 1), (6, [0.0] * 4, 1), (7, [1.0, None, 3.0, 4.0], 1), (8, [math.inf, 1.0, 1.0, 1.0], 1),
            (9, [math.nan, 1.0, 1.0, 1.0], 1), (10, [], 1), (11, a[:3], 1), (12, [-x for x in a], 1),
            (13, [3e38, 3e38, 3e38, 3e38], 3), (14, [1e-30, 1e-30, 1e-30, 1e-30], 3), (None, None, None)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_hot_groups_over_many_tiles(spark, monkeypatch):
    # A third of all rows equal, a third near copies of one vector; small tiles.
    monkeypatch.setattr(ed, "CHUNK", 16)
    monkeypatch.setattr(ed, "SLAB", 8)
    rng = np.random.default_rng(2)
    one, two = rng.standard_normal(16), rng.standard_normal(16)
    rows = [float32(one)] * 150
    rows += [float32(two + rng.standard_normal(16) * 0.14) for _ in range(150)]
    rows += [float32(rng.standard_normal(16)) for _ in range(150)]
    rows = [(k, v, 0) for k, v in enumerate(rows)]
    got, want = run(spark, rows), brute(rows)
    assert got == want
    assert len({r[1] for r in want}) > 5  # not all copies are linked with all others


def test_recall_at_the_threshold(spark):
    """4,000 pairs just above the threshold: nearly all are met."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(4000):
        a, b = rng.standard_normal((2, 16))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 0.9802
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    kept = ed.near_vectors(df).where("vec_id % 2 = 1 and not kept").count()
    assert kept >= 3996


def test_number_of_tables():
    for sets in (2, 1000, 10**6, 10**9):
        bits, tables = ed.tables_for(0.98, sets, 0.9999)
        assert 1 - (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** tables >= 0.9999
    assert ed.tables_for(1.0, 1000, 0.9999)[1] == 1
