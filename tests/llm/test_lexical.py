"""The pipelined search against a plain scoring of every document."""
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from rfmlens.llm import lexical
from rfmlens.llm.queries import oracle_sql, queries

RX = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return RX.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n, total = len(bags), sum(x[2] for x in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()}
    queries = {}
    for i, t in items:
        queries.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, q in queries.items():
        scored = []
        for d, b, size in bags:
            m = 25 + (75 * size * n) // total
            s = sum(c * w[t] * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in q.items() if t in b)
            if s > 0:
                scored.append((-s, d is not None, d or 0))
        out += [(i, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def frames(spark, docs, items, parts=3):
    return (spark.createDataFrame([(d, t, 1, "z", 2) for d, t in docs],
                                  "doc_id long, text string, shard int, term string, score int").repartition(parts),
            spark.createDataFrame([(i, t, 2, 3) for i, t in items], "item_id long, text string, rank int, slot int"))


def corpus(rng, docs, items):
    word = lambda n: " ".join(f"W{x}" for x in rng.zipf(1.4, n) % 300)
    ds = [(int(rng.integers(0, 2 * docs)), word(int(rng.integers(0, 60)))) for _ in range(docs)]
    return ds, [(i, word(int(rng.integers(1, 40)))) for i in range(items)]


@pytest.mark.parametrize("stages,k,shard,block", [(3, 10, 300, 7), (1, 3, 1 << 20, 256), (5, 2, 64, 1), (2, 40, 17, 3)])
def test_random_corpus_equals_brute_force(spark, monkeypatch, stages, k, shard, block):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "SHARD_BYTES", shard * 60)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    docs, items = corpus(np.random.default_rng(stages), 400, 17)
    d, i = frames(spark, docs, items)
    got = lexical.search(lexical.build_index(d), i, k, stages)
    assert result(got) == brute(docs, items, k)


def test_edges(spark):
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "--- !!"), (4, "Alpha ÉTÉ beta"), (4, "Alpha ÉTÉ beta"),
            (5, "alpha " * 70000 + "gamma"), (6, "漢字 alpha x_y it's 3.14"), (None, "alpha beta"), (7, "delta")]
    items = [(1, "ALPHA"), (1, "beta beta"), (None, "été ÉTÉ"), (2, None), (3, ""), (4, "nowhere"), (5, "x y it s 3 14"),
             (6, "delta")]
    d, i = frames(spark, docs, items)
    assert result(lexical.search(lexical.build_index(d), i)) == brute(docs, items)


def test_ties_rank_by_id(spark):
    docs = [(x, "same words here") for x in range(60, 0, -1)] + [(100 + x, "other text") for x in range(60)]
    items = [(1, "words")]
    d, i = frames(spark, docs, items, 4)
    got = result(lexical.search(lexical.build_index(d), i))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))
    assert got == brute(docs, items)


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "a b")], [(1, "a")])
    assert lexical.search(lexical.build_index(d.limit(0)), i).count() == 0
    assert lexical.search(lexical.build_index(d), i.limit(0)).count() == 0
    assert lexical.search(lexical.build_index(d.where("doc_id = 2")), i).count() == 0


def test_words_that_share_a_hash_stay_apart(spark, monkeypatch):
    flat = lambda buf, starts, ends: (ends - starts).astype(np.uint64)
    monkeypatch.setattr(lexical, "span_hashes", flat)
    buf = np.frombuffer(b"ab cd ab x", np.uint8)
    number, first = lexical._distinct(buf, np.array([0, 3, 6, 9]), np.array([2, 5, 8, 10]))
    assert number.tolist() == [0, 1, 0, 2] and first.tolist() == [0, 1, 3]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.execute(oracle_sql()["op13_lexical_search"])
    want = rel.fetchall()
    assert [d[0] for d in rel.description] == ["item_id", "rank", "doc_id", "score"]
    assert result(queries()["op13_lexical_search"](spark, sf)) == sorted(want, key=str) and want
