import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from rfmlens.llm import _trees, quality
from rfmlens.llm.queries import queries

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    r = queries()["op3_quality"](spark, SF).join(truth, "doc_id").where("held_out").toPandas()
    assert len(r) > 500
    y, p = r.quality.to_numpy(), r.predicted.to_numpy()
    assert (y == p).mean() > 0.97
    assert r.score[y == 1].mean() - r.score[y == 0].mean() > 0.8
    assert r.score.between(0, 1).all()


def test_statistics_against_plain_python():
    texts = ["", "One two two.\nOne two two.\n", "é### 12 A-B", "   \n\n", "x" * 5000, "a b a b a b"]
    data = [t.encode() for t in texts]
    offs = np.r_[0, np.cumsum([len(d) for d in data])]
    x = quality.statistics(np.frombuffer(b"".join(data), np.uint8), offs)
    for row, t, d in zip(x, texts, data):
        words = t.split()
        lens = [len(w.encode()) for w in words]
        assert row[0] == pytest.approx(np.log1p(len(d))) and row[1] == pytest.approx(np.log1p(len(words)))
        if words:
            assert row[11] == pytest.approx(np.mean(lens)) and row[12] == max(lens)
            assert row[13] == pytest.approx(np.std(lens), abs=1e-6)
            c = collections.Counter(w.lower() for w in words)
            assert row[19] == pytest.approx(len(c) / len(words))
            assert row[20] == pytest.approx(max(c.values()) / len(words))
            pairs = collections.Counter(zip(*(([w.lower() for w in words][i:]) for i in (0, 1))))
            assert row[21] == pytest.approx(len(pairs) / max(1, len(words) - 1))
        else:
            assert not row[11:23].any()


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    f = _trees.fit(x[:3000], y[:3000])
    p = f.predict(x[3000:], block=77)
    assert ((p > 0.5) == y[3000:]).mean() > 0.95

    def walk(row):
        total = f.bias
        for at in f.roots:
            while f.left[at] != at:
                at = f.left[at] if row[f.feature[at]] <= f.threshold[at] else f.right[at]
            total += f.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[3000:3050]], p[:50])
    assert _trees.fit(np.zeros((0, 3)), np.zeros(0)).predict(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_edges(spark):
    rows = [(i, "Good plain words here now. " * (i + 1), 9) for i in range(40)]
    rows += [(i, "## $$ %% ^^ && " * (i - 39), 9) for i in range(40, 80)]
    rows += [(100, None, 9), (101, "", 9), (102, "word " * 100_000, 9), (102, "word " * 100_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(3, None), (None, 1), (999, 0)],
                                   "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    s = collections.defaultdict(list)
    for r in got:
        s[r.doc_id].append(r.score)
    assert len(got) == len(rows) and s[102][0] == s[102][1] and s[100] == s[101]
    assert min(s[i][0] for i in range(40)) > 0.5 > max(s[i][0] for i in range(40, 80))
    assert quality.quality(docs.limit(0), labels).collect() == []
    none = quality.quality(docs, labels.where(F.lit(False))).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
