"""Every stage against a brute-force version of its rule, on its own input."""
import pytest

import corpus_pipeline as cp
from rfmlens.llm import language, mixing, pii

from .test_decontaminate import brute as leaks
from .test_jaccard_join import brute as groups
from .test_mixing import brute as mixed
from .test_pii import brute as private

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and output rows of every stage."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, f in cp.STAGES:
        new = f(spark, docs, SF)
        new.write.parquet(str(root / name))
        out.append((docs, new := spark.read.parquet(str(root / name))))
        docs = new
    return out


def test_names_and_columns(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "pii", "mix"]
    for before, after in stages[:-1]:
        assert after.schema == before.schema
        assert 0 < after.count() <= before.count()


def test_language(spark, stages):
    before, after = stages[0]
    model = language.fit(before)
    pred = {r.doc_id: r for r in language.identify(before, model).collect()}
    kept = {r.doc_id for r in after.collect()}
    for i, r in pred.items():
        total = sum(s.end - s.start for s in r.spans)
        own = sum(s.end - s.start for s in r.spans if s.lang == r.lang_pred)
        assert (i in kept) == (r.lang_pred != "und" and own >= 0.4 * total)
    assert len(kept) > 0.99 * len(pred)


def test_near_duplicates(stages):
    before, after = stages[1]
    want = groups([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert {r.doc_id for r in after.collect()} == {i for i, _, c in want if i == c}
    assert after.count() < before.count()


def test_decontaminate(spark, stages):
    before, after = stages[2]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = leaks([(r.doc_id, r.text) for r in before.collect()], bench)
    assert {r.doc_id for r in after.collect()} == {x[0] for x in want if not x[5]}
    assert after.count() < before.count()


def test_pii(stages):
    before, after = stages[3]
    model = pii.fit(before)
    new = {r.doc_id: r for r in after.collect()}
    changed = 0
    for r in before.collect():
        assert new[r.doc_id].text == pii.redact_text(r.text, model)
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)
        if sum(private(r.text)[0]):
            changed += 1
            assert new[r.doc_id].text != r.text and sum(private(new[r.doc_id].text)[0]) == 0
        else:
            assert (r.lang, r.source) == (new[r.doc_id].lang, new[r.doc_id].source)
    assert changed > 0


def test_mix(stages):
    before, after = stages[4]
    rows = [(r.doc_id, r.text, "d%d" % (int(r.source[3:]) % 4), r.lang, r.source) for r in before.collect()]
    assert sorted(((r.doc_id, r.epoch) for r in after.collect()), key=str) == mixed(rows, mixing.TARGET)[0]
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r.doc_id] == r.text for r in after.collect())


def test_run_and_empty(spark, stages, tmp_path):
    key = lambda df: sorted((r.doc_id, r.epoch, r.text) for r in df.collect())
    assert key(cp.run(spark, SF)) == key(stages[-1][1])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src1", 0),
                                 (2, "the of and is", None, None, None), (None, "the and of", "en", "s", 5)], docs.schema)
    (tmp_path / "odd").mkdir()
    odd.union(docs.limit(60)).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "odd" / "benchmark.parquet"))
    ids = {r.doc_id for r in cp.run(spark, str(tmp_path / "odd")).collect()}
    assert 1 not in ids and len(ids) > 10


def test_near_duplicates_go_by_row(spark):
    """A repeated id, null-id copies and one id with two texts: one row of each component, no text lost."""
    import itertools

    t1, t2, t3 = ("".join(f"{w}{i} " for i in range(60)) for w in ("alpha", "beta", "gamma"))
    near = t1.replace("alpha59", "omega")
    rows = [(None, t1)] * 3 + [(5, t1)] * 3 + [(7, t1), (7, t2), (9, t2 + "z"), (3, t3), (3, t3), (8, near), (None, t3)]
    rows += [(1, ""), (1, ""), (2, None), (4, "!"), (4, "!"), (None, "lonely words of one text"), (6, "xyz")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = cp.drop_near_duplicates(spark, docs.repartition(4), SF)
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(5, t1), (7, t2), (3, t3), (1, ""), (1, ""), (2, None), (4, "!"), (None, "lonely words of one text"),
            (6, "xyz")]
    assert kept == sorted(want, key=str) and out.columns == docs.columns
    assert cp.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0
    assert len(list(itertools.groupby(kept))) == len(kept) - 1      # only the empty text is repeated
