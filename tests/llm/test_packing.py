"""Every id in exactly one piece, sequences gapless, ids those of ``tokenizers``."""
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rfmlens.llm import packing
from rfmlens.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(PATH)
    return lambda s: [*t.encode(s or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def holds(rows, texts, encode, capacity=2048, whole=128):
    """Checks the pieces of documents with distinct ids; returns the padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        ids, at = encode(texts[d]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == crc(ids[at:at + p.length])
            if "ids" in p.__fields__:
                assert p.ids == ids[at:at + p.length]
            at += p.length
        assert at == len(ids)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        j = pieces[0].per_sequence
        if j:                                          # a class: a fixed count of pieces that fit
            assert len(pieces) == j and all(p.per_sequence == j and p.length <= capacity // j for p in pieces)
            assert capacity - at < whole
        if at & (at - 1):
            padding += capacity - at
    return padding


def test_query_whole_table(spark, encode):
    rows = queries()["op12_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    padding = holds(rows, texts, encode)
    assert padding < 0.02 * sum(r.length for r in rows)


def test_edge_texts(spark, encode):
    texts = {1: None, 2: "", 3: "a<|endoftext|>b  <|endoftext|>", 4: "naïve 漢字 　x\n\n  y" * 50,
             5: "word " * 5000, 6: "x" * 3000, None: "no id", 7: " \t\n" * 900}
    texts |= {100 + i: "short one" for i in range(300)}
    rows = [(d, t, "z", 3) for d, t in texts.items()]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(parts)
        holds(packing.pack(df, PATH).collect(), texts, encode)


def test_small_capacity_and_repeated_rows(spark, encode):
    rows = [(1, "same text here")] * 40 + [(2, "another one, longer than that, with many words " * 9)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = packing.pack(df, PATH, capacity=16, whole=4).collect()
    assert sum(r.length for r in out if r.doc_id == 1) == 40 * len(encode("same text here"))
    assert sum(r.start == 0 for r in out) == 43
    used = defaultdict(int)
    for r in out:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 16


def test_string_ids_and_empty_table(spark):
    df = spark.createDataFrame([("a", "b c")], "doc_id string, text string")
    assert [(r.doc_id, r.start, r.length) for r in packing.pack(df, PATH).collect()] == [("a", 0, 2), ("a", 2, 1)]
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_stretches_do_not_change_ids(encode, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    e = packing.Encoder(*packing.vocabulary(PATH))
    rng = np.random.default_rng(3)
    for _ in range(60):
        t = "".join(rng.choice(list("ab1 .\n\té漢'") + ["<|endoftext|>", "  ", " the"], int(rng.integers(0, 400))))
        assert e(t).tolist() == encode(t)[:-1]


def test_same_ids_for_every_character(encode):
    e = packing.Encoder(*packing.vocabulary(PATH))
    cps = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(cps), 500):
        t = "".join("a%c1%c %c!" % (c, c, c) for c in cps[lo:lo + 500])
        assert e(t).tolist() == encode(t)[:-1]


def test_rests_are_cut_to_class_lengths():
    cuts = packing.rest_cuts(2048, 128)
    for r, pieces in enumerate(cuts):
        assert sum(n for _, n in pieces) == r
        assert all(n <= 2048 // j for j, n in pieces)
        assert all(n == 2048 // j for j, n in pieces[:-1])
        assert len(pieces) <= 4
