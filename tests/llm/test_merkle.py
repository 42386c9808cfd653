"""The butterfly-built tree against a plain recursive one."""
import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from rfmlens.llm import merkle
from rfmlens.llm.queries import oracle_sql, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos int, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    vals = [r[0], r[1], r[2], r[3], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def climb(nodes):
    """(root, proof pairs of each node) of a run of digests."""
    proofs = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(proofs, at):
            lo = i - i % 3
            p.append(("".join(nodes[lo:i]), "".join(nodes[i + 1:lo + 3])))
        at = [i // 3 for i in at]
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def brute(rows):
    parts = {}
    for r in rows:
        parts.setdefault(r[1], []).append(r)
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4])), r) for r in parts[s])
        own = [r for _, r in sorted(((k, r) for k, r in own), key=lambda x: x[0])]
        trees.append((own, climb([leaf(r, r[4]) for r in own])))
    root, tops = climb([t[1][0] for t in trees])
    out = []
    for (own, (sub, proofs)), top in zip(trees, tops):
        for r, p in zip(own, proofs):
            path = p + top
            x = leaf(r, r[4])
            f = x
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                f = leaf(r, None if r[4] is None else r[4].replace("\n", ""))
            for a, b in path:
                f = h(a, f, b)
            out.append((r[0], x, sub, root, h(*[a + b for a, b in path]), f, f == root))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(rng, sizes):
    rows = []
    for s, n in sizes.items():
        for i in range(n):
            text = [None, "", "a\nb", "plain", "é\n" * 3][rng.integers(0, 5)]
            d = None if rng.random() < 0.05 else int(rng.integers(0, 3 * n))
            rows.append((d, s, ["en", None][rng.integers(0, 2)], int(rng.integers(0, 9)), text, "x", 7, "y"))
    return rows


@pytest.mark.parametrize("height,sizes", [
    (1, {"a": 1, "b": 31, None: 10, "é": 9, "": 4}),
    (1, {"hot": 100}), (2, {"a": 82, "b": 9, "c": 27, "d": 28}), (7, {"a": 50, "b": 3, "c": 1, None: 2}),
    (1, {f"s{i}": int(i % 5) + 1 for i in range(29)})])
def test_equals_plain_tree(spark, monkeypatch, height, sizes):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = table(np.random.default_rng(height), sizes)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(merkle.verified(df)) == brute(rows)


def test_one_row_and_empty(spark):
    one = [(None, None, None, None, None, None, None, None)]
    assert result(merkle.verified(spark.createDataFrame(one, SCHEMA))) == brute(one)
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tampering_is_found(spark):
    rows = [(i, "s", "en", 3, f"t{i}" + "\n" * (i % 2), None, None, None) for i in range(40)]
    for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect():
        changed = r.doc_id % 2 == 1 and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert r.verified == (not changed)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = queries()["op11_merkle_manifest"](spark, sf)
    rel = con.execute(oracle_sql()["op11_merkle_manifest"])
    assert [d[0] for d in rel.description] == df.columns
    assert result(df) == sorted(rel.fetchall(), key=str)
