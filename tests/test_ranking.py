"""Range-partitioned exact ranks equal the plain window, with heavy ties and groups."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rfmlens.operators.ranking import RankSpec, rank_columns, top_k


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Keep the ranges small inputs would be merged into one of."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def _plain(df, metric, tie, parts, desc):
    o = F.col(metric).desc() if desc else F.col(metric).asc()
    return F.row_number().over(Window.partitionBy(*parts).orderBy(o, F.col(tie)))


def _users(t):
    c = t.calls
    return (c.groupBy("user_id", "user_region_name")
            .agg(F.count(F.lit(1)).alias("freq"),
                 F.sum("call_total_length").alias("len"),
                 F.min(F.datediff(F.lit("2001-12-31"), F.col("day"))).alias("rec")))


def test_bucketed_global_rank_matches_window(t01):
    u = _users(t01).cache()
    specs = [RankSpec("freq", "r_f", True), RankSpec("len", "r_l", True),
             RankSpec("rec", "r_r", False)]
    got = rank_columns(u, specs, "user_id", (), count_col="n")
    exp = (u.withColumn("e_f", _plain(u, "freq", "user_id", [], True))
           .withColumn("e_l", _plain(u, "len", "user_id", [], True))
           .withColumn("e_r", _plain(u, "rec", "user_id", [], False)))
    j = got.join(exp.select("user_id", "e_f", "e_l", "e_r"), "user_id")
    bad = j.filter((F.col("r_f") != F.col("e_f")) | (F.col("r_l") != F.col("e_l"))
                   | (F.col("r_r") != F.col("e_r"))).count()
    assert bad == 0
    n = u.count()
    assert got.filter(F.col("n") != n).count() == 0
    # ranks are a permutation of 1..N
    assert got.select(F.min("r_f"), F.max("r_f"), F.count_distinct("r_f")).first() == (1, n, n)


def test_bucketed_group_rank_matches_window(t01):
    u = _users(t01).cache()
    got = rank_columns(u, [RankSpec("freq", "r", True)], "user_id", ["user_region_name"],
                       count_col="n")
    exp = u.withColumn("e", _plain(u, "freq", "user_id", ["user_region_name"], True))
    j = got.join(exp.select("user_id", "e"), "user_id")
    assert j.filter(F.col("r") != F.col("e")).count() == 0
    sizes = dict(u.groupBy("user_region_name").count().collect())
    for row in got.select("user_region_name", "n").distinct().collect():
        assert row["n"] == sizes[row["user_region_name"]]


def test_heavy_tie_split(spark):
    # 300 rows share one metric value: the tie is split by id ranges.
    rows = [(i, 1 if i < 300 else i) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, m long")
    got = rank_columns(df, [RankSpec("m", "r", True)], "id", ())
    exp = {r["id"]: r["e"] for r in df.withColumn(
        "e", _plain(df, "m", "id", [], True)).collect()}
    for r in got.collect():
        assert r["r"] == exp[r["id"]]


def test_top_k_at_most_k(t001):
    c = t001.calls.groupBy("user_country_name", "streamer_country_name").count()
    top = top_k(c, ["user_country_name"], [F.col("count").desc(), F.col("streamer_country_name")], 3)
    per = top.groupBy("user_country_name").count().collect()
    assert all(r["count"] <= 3 for r in per)


def test_bucketed_rank_with_null_group(spark):
    # a large NULL group and a large named group, both split into buckets
    rows = [(None if i % 2 else "A", i, i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, id long, m long")
    got = rank_columns(df, [RankSpec("m", "r", True)], "id", ["g"], count_col="n")
    exp = {r["id"]: r["e"] for r in df.withColumn("e", _plain(df, "m", "id", ["g"], True)).collect()}
    out = got.collect()
    assert all(r["r"] == exp[r["id"]] for r in out)
    assert all((r["n"] is None) == (r["g"] is None) for r in out)
    assert {r["n"] for r in out if r["g"] == "A"} == {300}


def _ranks(df, **kw):
    specs = [RankSpec("f", "rf", True), RankSpec("m", "rm", True), RankSpec("d", "rd", True),
             RankSpec("r", "rr", False)]
    return rank_columns(df, specs, ["id", "country"], **kw)


def _entities(spark, ids):
    # several profile rows per id, heavy ties, NULL metrics and tie columns
    rows = [(i, c, k % 3, None if k % 11 == 0 else float(k % 5), k % 4, f"g{k % 2}" if k % 7 else None)
            for k, (i, c) in enumerate((i, c) for i in ids for c in ("x", None))]
    return spark.createDataFrame(rows, f"id {'string' if isinstance(ids[0], str) else 'long'}, country string, "
                                 "f long, d double, r int, g string").withColumn(
        "m", F.col("f").cast("decimal(20,4)") / 7)


@pytest.mark.parametrize("ids", [[f"u{i % 97:03d}x{i}" for i in range(200)], list(range(200))])
@pytest.mark.parametrize("parts", [[], ["g"]])
def test_terms_of_any_type_with_composite_ties(spark, ids, parts):
    df = _entities(spark, ids)
    got = _ranks(df, partition_by=parts, count_col="n")
    exp = df
    for c, out, desc in (("f", "rf", True), ("m", "rm", True), ("d", "rd", True), ("r", "rr", False)):
        o = F.col(c).desc() if desc else F.col(c).asc()
        exp = exp.withColumn(out, F.row_number().over(Window.partitionBy(*parts).orderBy(o, "id", "country")))
    n = F.count(F.lit(1)).over(Window.partitionBy(*parts))
    exp = exp.withColumn("n", F.when(F.col("g").isNotNull(), n) if parts else n)
    cols = ["id", "country", "g", "rf", "rm", "rd", "rr", "n"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got.select(*cols).collect())) == sorted(map(key, exp.select(*cols).collect()))


def test_ranks_do_not_change_after_a_repartition(spark):
    df = _entities(spark, list(range(300)))
    one = {(r.id, r.country): (r.rf, r.rm, r.rd, r.rr) for r in _ranks(df).collect()}
    two = {(r.id, r.country): (r.rf, r.rm, r.rd, r.rr) for r in _ranks(df.repartition(7, F.rand(3))).collect()}
    assert one == two and len(one) == 600


def test_bounded_rank_beyond_the_bound_uses_the_ranges(spark, monkeypatch):
    from rfmlens.operators import ranking
    df = spark.range(500).selectExpr("id", "id % 5 AS m", "if(id % 7 = 0, null, id % 3) AS g")
    for parts in ([], ["g"]):
        want = rank_columns(df, [RankSpec("m", "r", True)], "id", parts, count_col="n", bounded=True)
        want = {(r.id, r.r, r.n) for r in want.collect()}
        with monkeypatch.context() as m:
            m.setattr(ranking, "BOUNDED_ROWS", 49)
            m.setattr(ranking, "_plain", None)
            got = rank_columns(df, [RankSpec("m", "r", True)], "id", parts, count_col="n", bounded=True)
            assert {(r.id, r.r, r.n) for r in got.collect()} == want


def test_shuffle_partitions_follow_the_facts(spark, tmp_path, monkeypatch):
    """Twice the rows get twice the tasks; a small table leaves the session's number."""
    from rfmlens import session
    from rfmlens.sources.fixtures import Tables
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    keys = [session.INITIAL_KEY, session.LEAST_KEY]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (2000, 4000, 100):
            spark.range(n).write.parquet(f"{tmp_path}/{n}/lineitem.parquet")
            facts = Tables(spark, f"{tmp_path}/{n}").facts("lineitem")
            assert facts.count() == n
            at = [spark.conf.get(k, None) for k in keys]
            assert at == ([None, None] if n == 100 else [str(2 * n // 100), str(n // 100)])
            assert facts.groupBy("id").count().count() == n
        assert spark.conf.get("spark.sql.shuffle.partitions") == old
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_many_session_partitions_are_not_merged_into_too_few_tasks(spark, tmp_path, monkeypatch):
    """The facts' tasks stay apart where the session's own number would be enough."""
    from rfmlens import session
    from rfmlens.sources.fixtures import Tables
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.range(8000).write.parquet(f"{tmp_path}/t/lineitem.parquet")
        facts = Tables(spark, f"{tmp_path}/t").facts("lineitem")
        assert spark.conf.get(session.INITIAL_KEY) == "200" and spark.conf.get(session.LEAST_KEY) == "80"
        assert facts.groupBy("id").count().count() == 8000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        for k in (session.INITIAL_KEY, session.LEAST_KEY):
            spark.conf.unset(k)
