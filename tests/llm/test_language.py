import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from rfmlens.llm import language
from rfmlens.llm.queries import queries

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"), train_docs=500)


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    r = (queries()["op9_language_id"](spark, SF).join(truth, "doc_id").where("held_out")
         .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"),
              F.count("*")).first())
    assert r[0] > 0.99 and r[1] >= 0 and r[2] <= 1 and r[3] > 3000


def test_viterbi_is_optimal():
    rng = np.random.default_rng(3)
    counts = np.array([1, 4, 0, 6, 3])
    score = rng.normal(0, 2, (counts.sum(), 3)).astype(np.float32)
    first = np.cumsum(counts) - counts
    label = language.viterbi(score, first, counts, 1.5)

    def worth(path, s):
        return sum(s[i, p] for i, p in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

    for f, c in zip(first, counts):
        if c:
            s = score[f:f + c].astype(float)
            best = max(worth(p, s) for p in itertools.product(range(3), repeat=int(c)))
            assert worth(label[f:f + c].tolist(), s) == pytest.approx(best)


def test_mixed_text_spans(spark, model):
    d = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where(
        "n_chars between 300 and 420 and lang in ('de','es') and not text like '%##%'").collect()}
    text = d["de"] + "\n" + d["es"]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = language.identify(df, model).first().spans
    assert [s.lang for s in spans] == ["de", "es"]
    assert abs(spans[1].start - len(d["de"].encode())) < 30


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "123 --- — €"), (4, "the of and"), (4, "the of and"),
            (5, "привет"), (None, "the and of is"), (6, "the of and is " * 40_000)]
    df = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows],
                               "doc_id long, text string, lang_pred string, score double")
    got = language.identify(df, model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [
        (0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"),
        (5, got[5].lang_pred), (6, "en")]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = language.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == 5
    none = df.limit(0)
    assert language.identify(none, model).collect() == []
    empty = language.fit(none.withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in language.identify(df, empty).collect()} == {"und"}


def test_rows_with_null_lang_do_not_train(spark):
    df = spark.createDataFrame([(1, "abc abd", "xx"), (2, "the and", None), (3, None, "yy")],
                               "doc_id long, text string, lang string")
    assert language.fit(df).langs == ["xx"]


def test_script_narrows(spark):
    df = spark.createDataFrame([(1, "hello there world", "en"), (2, "абвг де", "ru")],
                               "doc_id long, text string, lang string")
    m = language.fit(df)
    got = language.identify(spark.createDataFrame([(7, "жук zzz")], "doc_id long, text string"), m)
    assert [s.lang for s in got.first().spans] == ["ru", "en"]


def test_words_beside_marks_count(spark):
    """Inverted marks, quotes, dashes, no-break and ideographic spaces are no part of a word."""
    df = spark.createDataFrame([(1, "hola que tal amigo", "es"), (2, "hello there my friend", "en"),
                                (3, "今日天气很好我们去公园散步", "zh")], "doc_id long, text string, lang string")
    m = language.fit(df)
    texts = [("es", "¡Hola!"), ("es", "¿Que?"), ("es", "«hola» “amigo”"), ("en", "—hello—friend"),
             ("en", "\u00a0friend\u00a0there"), ("zh", "\u3000今日天气很好"), ("zh", "「我们去公园」。今日天气"), ("zh", "《公园》")]
    got = language.identify(spark.createDataFrame(list(enumerate(t for _, t in texts)), "doc_id long, text string"), m)
    got = {r.doc_id: r for r in got.collect()}
    assert [got[i].lang_pred for i in range(len(texts))] == [x for x, _ in texts]
    assert all(r.score > 0 for r in got.values())
    b = "¡Hola—que tal»".encode()
    s, e, _, letters, _ = language.word_scores(np.frombuffer(b, np.uint8), np.array([0, len(b)]), m)
    assert [b[x:y].decode() for x, y in zip(s, e)] == ["Hola", "que", "tal"] and letters.tolist() == [4, 3, 3]


LETTERS = ["Ｈｅｌｌｏ", "ｶﾀｶﾅ", "々", "µ", "ª", "日本語", "ไทย", "ქართული", "हिन्दी", "العربية", "עברית", "한국어", "ΑΒΓ",
           "Здравствуй", "Հայ", "አማርኛ", "ⴰⵎⴰⵣⵉⵖ", "𝐀𝐁", "e\u0301te", "𐌰𐌱"]
NO_LETTERS = ["", None, "123 456", "٠١٢٣", "०१२", "…—«»", "\u3000\u00a0", "12.5 % – №", "\u0301\u0302", "🙂🙂", "³²½"]


def test_und_is_for_texts_without_a_letter_only(spark, model):
    rows = [(i, t) for i, t in enumerate(LETTERS + NO_LETTERS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in language.identify(df, model).collect():
        text = rows[r.doc_id][1]
        assert (r.lang_pred == "und") == (text in NO_LETTERS), text
        assert 0 <= r.score <= 1


def test_a_combining_mark_stays_with_its_letter():
    buf = np.frombuffer("e\u0301a \u0301 1\u0301x क्षि २".encode(), np.uint8)
    assert language.letters_only(buf).tobytes().decode() == "e\u0301a    1  x क्षि    "


def test_a_large_batch_is_scored_in_bounded_chunks(model, monkeypatch):
    """What is scored at once stays within ``CHUNK`` bytes, with the same results as row by row."""
    import pyarrow as pa
    texts = [f"the quick brown fox und der schnelle Hund {i} " * 60 for i in range(1200)] + [None, ""]
    seen, whole = [], language.word_scores
    monkeypatch.setattr(language, "word_scores", lambda buf, offs, m: seen.append(len(buf)) or whole(buf, offs, m))
    got = language.identify_rows(pa.RecordBatch.from_pydict({"text": texts}), "text", model)
    assert sum(seen) > 3 << 20 and max(seen) <= 1 << 20
    for i in (0, 700, 1199, 1200, 1201):
        one = language.identify_rows(pa.RecordBatch.from_pydict({"text": pa.array([texts[i]], pa.string())}), "text", model)
        assert [x[i] for x in got] == [x[0] for x in one]
