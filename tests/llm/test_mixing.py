import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rfmlens.llm import mixing as mx
from rfmlens.llm.queries import oracle_sql, queries


def fill(budget, children):
    """Plain water-filling: cap what overflows, share again, until nothing does."""
    got, left = {}, {k: v for k, v in children.items() if v[0] > 0 and v[1] > 0}
    while left:
        total = sum(w for _, w in left.values())
        rest = budget - sum(got.values())
        over = {k: c for k, (c, w) in left.items() if rest * w >= c * total}
        if not over:
            return got | {k: rest * w // total for k, (c, w) in left.items()}
        k = min(over, key=lambda k: (left[k][0] / left[k][1], k))
        got[k] = left.pop(k)[0]
    return got


def brute(rows, t):
    leaf = defaultdict(list)
    for i, text, dom, lang, src in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if n:
            leaf[dom or "", lang or "", src or ""].append((i, n))
    tokens = {k: sum(n for _, n in v) for k, v in leaf.items()}
    cap = Counter()
    for k, n in tokens.items():
        for depth in (1, 2, 3):
            cap[k[:depth]] += n * t.epochs
    weights = (t.domain, t.lang, t.source)

    def kids(node):
        return {k: (c, weights[len(node)].get(k[-1], t.default)) for k, c in cap.items()
                if len(k) == len(node) + 1 and k[:-1] == node}

    budget = {(): sum(tokens.values()) * t.share[0] // t.share[1]}
    for depth in (0, 1, 2):
        for node in [k for k in budget if len(k) == depth]:
            budget |= fill(budget[node], kids(node))
    out = []
    for k, docs in leaf.items():
        whole, rest = divmod(budget.get(k, 0), tokens[k])
        out += [(i, e) for i, _ in docs for e in range(whole)]
        h = lambda i: hashlib.md5(f"{t.seed}:{whole}:{'' if i is None else i}".encode()).hexdigest()
        used = 0
        sums = Counter()
        for i, n in docs:
            sums[h(i), i] += n
        for (_, i), n in sorted(sums.items(), key=lambda x: x[0][0]):
            if used < rest:
                out += [(i, whole)] * sum(j == i for j, _ in docs)
            used += n
    return sorted(out, key=str), budget


@pytest.mark.parametrize("seed,share,epochs", [(1, (3, 4), 2), (2, (5, 2), 3), (3, (9, 1), 2), (4, (1, 50), 1)])
def test_equals_plain_redistribution(spark, seed, share, epochs):
    rng = np.random.default_rng(seed)
    rows = [(i, "w " * int(rng.integers(0, 90)), rng.choice(["a", "b", "c"], p=[.8, .15, .05]),
             rng.choice(["en", "de", "zz"]), f"s{rng.zipf(1.7) % 7}") for i in range(400)]
    t = mx.Target(domain={"a": 1, "b": 5, "c": 4}, lang={"zz": 0, "en": 3}, source={"s3": 7}, share=share,
                  epochs=epochs, seed=str(seed))
    df = spark.createDataFrame([tuple(map(lambda x: x if isinstance(x, int) else str(x), r)) for r in rows],
                               "doc_id long, text string, dom string, lang string, source string")
    got = sorted(((r.doc_id, r.epoch) for r in mx.mix(df, t, F.col("dom")).collect()), key=str)
    want, budget = brute(rows, t)
    assert got == want


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("x", "p", "s1", 10), ("x", "p", "s2", 1000), ("x", "q", "s1", 1000), ("y", "p", "s1", 1000)],
        "__domain string, __lang string, __source string, tokens long")
    got = {r[:3]: r.got for r in mx.budgets(leaves, mx.Target(share=(400, 3010), epochs=1)).collect()}
    # 400 tokens: 200 to each domain, 100 to each language of x; s1 can take 10, s2 takes its share
    assert got == {("x", "p", "s1"): 10, ("x", "p", "s2"): 90, ("x", "q", "s1"): 100, ("y", "p", "s1"): 200}


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    q = con.execute(oracle_sql()["op4_mixing"])
    cols = [c[0] for c in q.description]
    got = queries()["op4_mixing"](spark, sf)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(q.fetchall())


def test_edges(spark):
    rows = [(1, None, "a", "en", "s"), (2, "", "a", "en", "s"), (3, " \t\n", "a", "en", "s"),
            (4, "one two", None, None, None), (4, "one two", None, None, None), (5, "w " * 200_000, "a", "en", "s"),
            (None, "x y z", "a", "de", "s"), (7, "é ß", "b", "en", "t")]
    df = spark.createDataFrame([(*r, 9, "n", "h") for r in rows], "doc_id long, text string, dom string, "
                               "lang string, source string, n_tokens int, __n string, tokens string")
    t = mx.Target(share=(3, 1), epochs=3)
    out = mx.mix(df, t, F.col("dom"))
    got = sorted(((r.doc_id, r.epoch) for r in out.collect()), key=str)
    assert got == brute(rows, t)[0] and {r.n_tokens for r in out.collect()} == {9}
    assert mx.mix(df.limit(0), t, F.col("dom")).collect() == []
