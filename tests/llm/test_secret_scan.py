import hashlib
import re

import pytest

from rfmlens.llm.secret_scan import BASE_RULES, MORE_RULES, scan, trigram_query

RX = {"assign": re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                           r"([A-Za-z0-9+/_.=-]+)", re.I | re.A),
      "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def brute(text):
    out = []
    for k, (kind, rx) in enumerate(RX.items()):
        for m in rx.finditer(text or ""):
            n = len(m[2]) if kind == "assign" else len(m[0])
            if n >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    out.sort()
    return ([sum(x[1] == k for x in out) for k in range(3)],
            hashlib.sha256(",".join(x[2] for x in out).encode()).hexdigest(), [x[2] for x in out])


TEXTS = [
    None, "", "nothing here", "é password = hunter2hunter2 AKIA" + "Z" * 12,
    "PassWd: 'abcdefgh' token=short secret\" = \"a.b-c_d/e+f=", "api_key:12345678 APIKEY=12345678",
    "0123456789abcdef" * 2, "0123456789abcde" * 2 + "G" + "a" * 31, "f" * 100_000,
    "password password=password=12345678", "tokentoken= x token=" + "y" * 300_000,
    "ſecret=12345678 toKen=12345678", "ghp_" + "a1B2" * 9, "pass" * 5 + "wd=123456789",
    "x" * 5 + "AKI" + "A", "AKIAAKIAAKIAAKIA" * 2,
]


def test_matches_brute_force(spark):
    rows = [(i % 14, t, "x", "y") for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_hex string")
    got = sorted((r.doc_id, [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in scan(df).collect())
    want = sorted((r[0], *brute(r[1])[:2]) for r in rows)
    assert got == want
    for r in scan(df.distinct()).collect():
        spans = [s for s in r.spans.split(",") if s.split(":")[0] in RX]
        assert hashlib.sha256(",".join(spans).encode()).hexdigest() == r.base_sha256
        starts = [int(s.split(":")[1]) for s in r.spans.split(",") if s]
        assert starts == sorted(starts)


def test_whole_table_against_brute_force(spark):
    from rfmlens.llm.queries import queries
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries()["op1_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts) and sum(r.n_assign + r.n_hex for r in rows) > 0
    for r in rows:
        n, sha, _ = brute(texts[r.doc_id])
        assert ([r.n_assign, r.n_access, r.n_hex], r.base_sha256) == (n, sha)


def test_empty_table_and_null_id(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert scan(df).collect() == []
    df = spark.createDataFrame([(None, "token=12345678")], "doc_id long, text string")
    assert [(r.doc_id, r.n_assign) for r in scan(df).collect()] == [(None, 1)]


def test_trigram_queries():
    q = {r.kind: trigram_query(r.pattern) for r in (*BASE_RULES, *MORE_RULES)}
    assert q["hex"] is True
    assert q["access"] == ("and", frozenset({b"aki", b"kia"}))
    assert q["assign"][0] == "or" and len(q["assign"][1]) == 6
    assert trigram_query("ab") is True and trigram_query("(abc)?x") is True
    assert trigram_query("abc|xyz") == ("or", frozenset({b"abc", b"xyz"}))


@pytest.mark.parametrize("rule", BASE_RULES + MORE_RULES)
def test_query_never_misses(rule):
    from rfmlens.llm.secret_scan import Segment, query_grams
    import numpy as np
    q = trigram_query(rule.pattern)
    for t in TEXTS:
        if t and re.search(rule.pattern, t):
            b = np.frombuffer(t.encode(), np.uint8)
            seg = Segment(b, np.array([0, len(b)]), sorted(query_grams(q)))
            assert seg.candidates(q).all()
