import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rfmlens.llm import neighbours as nb
from rfmlens.llm.queries import oracle_sql, queries


def brute(rows, k=10, every=100):
    v, cand = {}, []
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            continue
        e = [float(np.float32(x)) for x in e]
        v[i] = min(v.get(i, e), e)
        cand.append((i, e))
    out = []
    for q in v:
        if q % every == 0:
            d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v[q], e))), c)
                       for c, e in cand if c != q and len(e) == len(v[q]))[:k]
            out += [(q, r + 1, c, s) for r, (s, c) in enumerate(d)]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_sql_agrees(spark):
    for sf in ("sf0.01", "sf0.1"):
        con = duckdb.connect()
        con.execute(f"create view embeddings as select * from '/root/testdata/{sf}/embeddings.parquet'")
        q = con.execute(oracle_sql()["op6_neighbours"])
        cols = [c[0] for c in q.description]
        got = queries()["op6_neighbours"](spark, f"/root/testdata/{sf}")
        assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(q.fetchall())


def test_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(250)]
    rows += [(300, None), (400, []), (500, [0.0] * 4), (600, [1.0, None, 0.0, 0.0]), (700, [1.0, math.nan, 0.0, 0.0]),
             (800, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (900, [1.0, 2.0]), (901, [1.0, 3.0]),
             (1000, [5.0, 5.0, 5.0]), (100, [9.0, 9.0, 9.0, 9.0]), (7, [1.0, 1.0, 1.0, 1.0]),
             (7, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, e, 0, 1.0) for i, e in rows],
                               "vec_id long, embedding array<float>, shard int, score double")
    q = F.col("vec_id") % 100 == 0
    assert result(nb.nearest(df, q, shard_rows=40)) == brute(rows)
    assert result(nb.nearest(df.limit(0), q)) == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3000)], "vec_id long, embedding array<float>")
    assert result(nb.nearest(same, F.col("vec_id") == 2000)) == [(2000, r + 1, r, 0.0) for r in range(10)]


@pytest.mark.parametrize("factor", [1.0, 1.5, 3.0])
def test_tree_and_its_factor(factor):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8)) * 4
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 8))
    t = nb.Tree.build(x, np.arange(3000) * 7)
    assert sorted(t.order.tolist()) == list(range(3000))
    q = x[::60]
    ids, dist = t.nearest(q, np.arange(0, 3000, 60) * 7, 10, factor)
    d = nb.distances(q, x)
    d[np.arange(len(q)), np.arange(0, 3000, 60)] = np.inf
    want = np.argsort(d, axis=1)[:, :10] * 7
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, want)])
    if factor == 1.0:
        assert (ids == want).all()
        low, leaves = t.bounds(q)
        for j, (lo, hi) in enumerate(leaves):
            assert (low[:, j] <= nb.distances(q, x[t.order[lo:hi]]).min(1) + 1e-9).all()
    else:
        assert recall >= (0.9 if factor == 1.5 else 0.3)


def test_every_row_of_an_id_is_a_candidate(spark):
    rows = [(100, [0.0, 1.0]), (1, [1.0, 0.125]), (1, [2.0, 0.0]), (1, [0.0, 1.0]), (100, [5.0, 5.0]), (2, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = result(nb.nearest(df, F.col("vec_id") % 100 == 0))
    assert got == brute(rows) and [r[2] for r in got] == [1, 1, 2, 1]
