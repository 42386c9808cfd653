import numpy as np
import pytest
from pyspark.sql import functions as F

from rfmlens.llm import toxicity as tx
from rfmlens.llm.queries import queries

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    r = queries()["op5_toxicity"](spark, SF).join(truth, "doc_id").where("held_out").toPandas()
    hit = (r.predicted == r.toxic)
    assert hit.mean() > 0.96 and r.score.between(0, 1).all()
    assert hit[r.toxic == 1].mean() > 0.8 and hit[r.toxic == 0].mean() > 0.98


@pytest.mark.parametrize("seed", range(4))
def test_index_equals_brute_force_cosine(seed):
    rng = np.random.default_rng(seed)
    n, q, v, k = 300, 50, 40, 5

    def sparse(m):
        x = rng.random((m, v)) * (rng.random((m, v)) < 0.1)
        if seed == 3:
            x = (x > 0).astype(float)          # many ties
        x[::7] = 0
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        x = x / np.where(norm == 0, 1, norm)
        r, c = np.nonzero(x)
        return x, np.r_[0, np.cumsum(np.bincount(r, minlength=m))], c, x[r, c]

    e, ptr, term, w = sparse(n)
    index = tx.Index.build(np.arange(n), np.zeros(n), ptr, term, w, v)
    x, ptr, term, w = sparse(q)
    best, sim = index.nearest(ptr, term, w, k)
    true = x @ e.T
    for i in range(q):
        o = np.lexsort((np.arange(n), -np.round(true[i], 10)))[:k]
        want = [j if true[i, j] > 1e-12 else -1 for j in o]
        assert np.allclose(sim[i], np.maximum(true[i, o], 0))
        if seed < 3:
            assert best[i].tolist() == want


def test_neighbours_closer_than_single_precision_are_told_apart():
    """Cosines over frequent terms alone that differ by 1e-9, in double precision; arrays of a task stay small."""
    n, v = 600, 60
    rng = np.random.default_rng(1)
    e = 1 + rng.random((1, v)) + 1e-9 * rng.random((n, v))
    e[::2] = e[::2] * (rng.random((n // 2, v)) < 0.5)
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    r, c = np.nonzero(e)
    index = tx.Index.build(np.arange(n), np.zeros(n), np.r_[0, np.cumsum(np.bincount(r, minlength=n))], c, e[r, c], v)
    q = e[1::100]
    best, sim = index.nearest(np.arange(len(q) + 1) * v, np.tile(np.arange(v), len(q)), q.ravel(), 10)
    true = np.round((q[:, None] * e).sum(2), 12)
    want = np.stack([np.lexsort((np.arange(n), -t))[:10] for t in true])
    assert np.allclose(sim, np.take_along_axis(true, want, 1), rtol=0, atol=2e-12)
    assert index.tiles.dtype == np.float32 and index.tiles.shape == (v, n)


def test_a_task_s_memory_does_not_follow_the_batch():
    """Large batches are cut into chunks of ``CHUNK`` bytes; the index is not made anew for each task."""
    import pyarrow as pa
    words = ["".join(x) for x in np.random.default_rng(2).choice(list("abcdefgh"), (400, 7))]
    texts = [" ".join(words[i:i + 40]) for i in range(300)]
    buf, offs = np.frombuffer("".join(texts).encode(), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
    vocab = np.unique(tx.terms(buf, offs)[1])
    doc, term, count = tx.vectors(buf, offs, vocab, tx.buckets(vocab))
    w, ptr = tx.weights(doc, term, count, np.ones(len(vocab)), len(texts))
    index = tx.Index.build(np.arange(len(texts)), np.zeros(len(texts)), ptr, term, w, len(vocab))
    batch = pa.RecordBatch.from_arrays([pa.array(texts * 50)], names=["text"])
    got = list(tx.neighbours(iter([batch]), (vocab, np.ones(len(vocab)), index), 3))
    assert sum(g[0].num_rows for g in got) == 15_000
    assert max(g[0].get_total_buffer_size() and len("".join(g[0].column(0).to_pylist())) for g in got) <= 1 << 20
    assert all(g[1] is index for g in got)
    assert np.concatenate([g[2] for g in got])[:, 0].tolist() == list(range(300)) * 50


def test_weighted_isotonic():
    knots, rates = tx.calibrate(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1.0]), np.array([1, 1, 3, 1.0]))
    assert np.all(np.diff(rates) >= 0) and rates[0] == 0 and rates[-1] == 1
    assert np.interp(0.25, knots, rates) == pytest.approx(0.25)


def test_edges(spark):
    nice, bad = "calm kind warm words about gardens", "vile nasty grubby insults for you"
    rng = np.random.default_rng(5)

    def filler():
        return " ".join("".join(rng.choice(list("bcdfgklmnprt"), 9)) for _ in range(60))

    rows = [(i, f"{nice if i % 2 else bad} {filler()}", 1) for i in range(120)]
    rows += [(500, None, 1), (501, "", 1), (502, "12 34", 1), (503, bad.upper(), 1), (503, bad.upper(), 1),
             (504, (nice + " ") * 30_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)] + [(4, None), (None, 1), (9999, 1)],
                                   "doc_id long, toxic int")
    m = tx.fit(docs, labels)
    got = {}
    for r in tx.score(docs, m).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and len(got[503]) == 2
    assert got[503][0].score > 0.8 and got[503][0].evidence[0].label == 1
    assert got[504][0].score < 0.3 and got[504][0].evidence[0].label == 0
    assert got[500][0].evidence == [] and len({got[i][0].score for i in (500, 501, 502)}) == 1
    cos = [e.cosine for e in got[503][0].evidence]
    assert cos == sorted(cos, reverse=True) and len(cos) == tx.NEIGHBOURS
    assert tx.score(docs.limit(0), m).collect() == []
    none = tx.fit(docs, labels.where(F.lit(False)))
    assert {r.score for r in tx.score(docs, none).collect()} == {0.0}


def test_copy_of_an_example_is_found(spark):
    """An example whose words are all its own has no chosen term, yet its copy has cosine 1."""
    rng = np.random.default_rng(6)

    def own():
        return " ".join("".join(rng.choice(list("bcdfgklmnprt"), 9)) for _ in range(40))

    rows = [(i, own()) for i in range(90)]
    docs = spark.createDataFrame(rows + [(1000 + i, t) for i, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, toxic int")
    m = tx.fit(docs, labels)
    got = {r.doc_id: r.evidence for r in tx.score(docs, m).collect()}
    examples = set(m.index.key.tolist())
    assert len(examples) > 40
    for i in examples:
        assert got[1000 + i][0].doc_id == i and got[1000 + i][0].cosine == pytest.approx(1)
        assert got[1000 + i][0].label == i % 2


def test_look_up_finds_every_term_of_the_vocabulary():
    """Buckets of leading bits give the index of each hash, also of those that crowd in one bucket."""
    rng = np.random.default_rng(7)
    for size in (0, 1, 5, 3_000):
        near = np.uint64(12345) + np.arange(size % 2_000, dtype=np.uint64)
        vocab = np.unique(np.r_[rng.integers(0, 2**64, size, np.uint64), near, np.uint64(2**64 - 1)])
        asked = np.r_[vocab[::-1], rng.integers(0, 2**64, 500, np.uint64)]
        row, i = tx._look_up(asked, np.arange(len(asked)), vocab, tx.buckets(vocab))
        got = np.full(len(asked), -1)
        got[row] = i
        at = np.minimum(np.searchsorted(vocab, asked), len(vocab) - 1)
        assert got.tolist() == np.where(vocab[at] == asked, at, -1).tolist()


def test_vectors_count_words_and_beginnings_once_for_each_place():
    buf = np.frombuffer(b"gardens Gardens garden x gardens", np.uint8)
    doc, h = tx.terms(buf, np.array([0, 24, len(buf)]))
    vocab = np.unique(h)
    doc, term, count = tx.vectors(buf, np.array([0, 24, len(buf)]), vocab, tx.buckets(vocab))
    want = {(d, t): c for d, t, c in zip(*tx._distinct(*tx.terms(buf, np.array([0, 24, len(buf)]))))}
    assert {(d, vocab[t]): c for d, t, c in zip(doc, term, count)} == want
