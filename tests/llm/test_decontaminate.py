import hashlib
import re

import duckdb
import numpy as np
import pytest

from rfmlens.llm import decontaminate as dc
from rfmlens.llm.queries import oracle_sql, queries

RX = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def toks(t):
    return RX.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench, window=10):
    wins = set()
    for i, t in bench:
        w = toks(t)
        if i is not None and w:
            wins |= {(i, tuple(w[s:s + window])) for s in range(max(1, len(w) - window + 1))}
    out = []
    for d, t in docs:
        w, hit, items = toks(t), set(), set()
        for i, p in wins:
            for s in range(len(w) - len(p) + 1):
                if w[s] == p[0] and tuple(w[s:s + len(p)]) == p:
                    hit |= set(range(s, s + len(p)))
                    items.add(str(i))
        ids = ",".join(sorted(items))
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                   for r in df.collect()), key=str)


def frames(spark, docs, bench):
    return (spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, pos int, w string"),
            spark.createDataFrame([(i, t, 2) for i, t in bench], "item_id long, text string, n int"))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_equal_brute_force(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(dc, "BLOCK_BYTES", 2_000)            # several blocks
    rng = np.random.default_rng(seed)
    word = lambda n: [f"v{x}" for x in rng.zipf(1.6, n) % 60]
    bench = [(i, " ".join(word(int(rng.integers(1, 30))))) for i in range(25)]
    docs = []
    for i in range(60):
        w = word(int(rng.integers(0, 120)))
        for _ in range(rng.integers(0, 3)):
            src = bench[rng.integers(0, 25)][1].split()
            lo = int(rng.integers(0, max(1, len(src) - 5)))
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = src[lo:lo + int(rng.integers(5, 30))]
        docs.append((i, " ".join(w)))
    d, b = frames(spark, docs, bench)
    assert result(dc.contamination(d, b)) == brute(docs, bench)


def test_edges(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    bench = [(10, ten), (9, ten.upper()), (9, ten), (3, "Éa, ß!"), (4, None), (5, " ... "), (None, "zz yy"),
             (6, ten + " k11"), (7, "the the the the the the the the the the the")]
    docs = [(1, None), (2, ""), (3, "x " + ten + " k11 y"), (3, "x " + ten + " k11 y"), (3, "other text"),
            (4, "éa ß Éa-ß"), (4, "Éa ß"), (5, "zz yy"), (6, "the " * 30), (None, ten), (7, "p q " * 20_000 + ten),
            (8, " ".join([ten] * 40))]
    d, b = frames(spark, docs, bench)
    got, want = result(dc.contamination(d, b)), brute(docs, bench)
    assert got == want and [x[1:4] for x in got if x[0] is None] == [(10, 10, 3)]
    kept = dc.clean_documents(d, b)
    assert kept.columns == d.columns
    bad = {(x[0]) for x in want if x[5]}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        i for (i, t) in docs if i is not None and not brute([(i, t)], bench)[0][5])
    assert 4 in bad and result(dc.contamination(d.limit(0), b)) == []
    assert {x[2] for x in result(dc.contamination(d, b.limit(0)))} == {0}


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    q = con.execute(oracle_sql()["op7_decontaminate"])
    cols = [c[0] for c in q.description]
    want = sorted(q.fetchall())
    got = sorted(tuple(r[c] for c in cols) for r in queries()["op7_decontaminate"](spark, sf).collect())
    assert got == want


def test_proximity(spark):
    bench = [(1, "alpha common beta common gamma"), (2, "solo")]
    docs = [(1, "gamma x x alpha x x beta"), (2, "alpha " + "x " * 40 + "beta gamma"), (3, "common common solo"),
            (4, "beta alpha")]
    d, b = frames(spark, docs + [(i, "common common alpha") for i in range(5, 9)], bench)
    got = {(r.doc_id, r.item_id, r.first, r.last) for r in dc.proximity_matches(d, b, terms=3, slop=6).collect()}
    assert got == {(3, 2, 2, 2), (1, 1, 0, 6)}


def test_contaminated_rows_without_an_id_go(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    docs = [(None, "x " + ten), (None, "clean words"), (None, None), (1, ten), (2, "other")]
    d, b = frames(spark, docs, [(10, ten)])
    kept = dc.clean_documents(d, b).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(None, "clean words"), (None, None), (2, "other")], key=str)
