"""Windows from day partials and bitmaps, versioned profiles, publishes,
salted joins, the call-detail chain and declared schemas."""
import dataclasses
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rfmlens.operators import bitmaps as B
from rfmlens.operators import history as H
from rfmlens.operators import joins as J
from rfmlens.operators.aggregates import call_base
from rfmlens.operators.partials import day_partials, merge_partials
from rfmlens.plans import backfill as BF
from rfmlens.plans import call_facts as CF
from rfmlens.plans import daily as D
from rfmlens.plans import windowed as W
from rfmlens.sources import publish as PB
from rfmlens.sources import sinks as K
from rfmlens.sources.fixtures import RUN_DATE, WINDOW_END, Tables

SF = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted(map(tuple, df.select(*(cols or sorted(df.columns))).collect()), key=str)


# ---- day partials --------------------------------------------------------------
def test_merged_partials_equal_the_facts(spark, t01):
    keys = W.USER_BASE_KEYS
    facts = CF.window_filter(t01.calls, "day", WINDOW_END, 10)
    want = call_base(facts, RUN_DATE, ["streamer_id", "streamer_country_id", "streamer_country_name"])
    got = merge_partials(day_partials(facts), RUN_DATE, keys)
    assert rows(got, *keys, "frequency", "recency_call_interval") == \
        rows(want, *keys, "frequency", "recency_call_interval")
    total = lambda d: d.agg(F.sum("gold_coin_amount"), F.sum("call_total_length")).first()
    assert tuple(total(got)) == tuple(total(want))


def test_rerun_of_a_past_day_ignores_later_calls(spark, t01, tmp_path):
    """The window ending on an earlier day is the same with and without the days after it."""
    end = "2001-07-28"
    all_days = W.DayStore(spark, str(tmp_path / "all"))
    all_days.refresh(t01.calls, W.window_days(WINDOW_END, 12))
    past = W.DayStore(spark, str(tmp_path / "past"))
    past.refresh(t01.calls.where(F.col("day") <= end), W.window_days(end, 8))
    for f in (lambda s: W.quintile_level(s, end, RUN_DATE), lambda s: W.active_users(s, end, True),
              lambda s: W.active_streamers(s, end, t01.country_region)):
        assert rows(f(all_days)) == rows(f(past)) != []


def test_refreshing_a_day_replaces_only_it(spark, t01, tmp_path):
    store = W.DayStore(spark, str(tmp_path))
    days = W.window_days(WINDOW_END, 4)
    store.refresh(t01.calls, days)
    before = rows(store.partials(days))
    store.refresh(t01.calls, days[1:2])
    assert rows(store.partials(days)) == before
    store.refresh(t01.calls.where("false"), days[1:2])              # the day lost all its calls
    after = store.partials(days)
    assert rows(after) == [r for r in before if days[1] not in r]
    plan = store.partials(days[2:])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


# ---- bitmaps ---------------------------------------------------------------------
def test_bitmaps_equal_count_distinct_over_overlapping_windows(spark):
    rnd = random.Random(5)
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, 2 ** 40, *range(70000, 70050)]
    data = [(d, rnd.choice("ab"), rnd.choice("01"), rnd.choice(ids)) for d in range(9) for _ in range(60)]
    data += [(3, None, "1", 5), (4, "c", "0", None)]
    df = spark.createDataFrame(data, "day int, country string, vip string, id long")
    days = B.distinct_bitmaps(df, ["day", "country", "vip"], "id")
    for lo, hi in ((0, 3), (2, 5), (1, 8), (3, 4)):
        inside = F.col("day").between(lo, hi)
        want = df.where(inside).groupBy("country").agg(F.count_distinct("id").alias("n"))
        assert rows(B.distinct_members(days.where(inside), ["country"], "n")) == rows(want)
        daily = df.where(inside).groupBy("day", "country").agg(F.count_distinct("id").alias("x"))
        want = daily.groupBy("country").agg(F.avg("x").alias("n"))
        assert rows(B.avg_daily(days.where(inside), "day", ["country"], "n")) == rows(want)


def test_bitmaps_need_integers(spark):
    with pytest.raises(TypeError):
        B.distinct_bitmaps(spark.createDataFrame([("a",)], "id string"), [], "id")


# ---- versions ------------------------------------------------------------------------
VERSIONS = [(1, "A", "free", "2024-01-01"), (1, "B", "vip", "2024-01-05"), (1, "C", None, "2024-01-09"),
            (2, "D", "free", "2024-01-07"), (2, "E", "free", "2024-01-07"), (-1, "X", "x", "2024-01-01"),
            (3, "F", None, "2024-02-01")]


@pytest.fixture(scope="module")
def versions(spark):
    v = spark.createDataFrame(VERSIONS, "user_id long, country string, vip string, dt string")
    return v.withColumn("dt", F.to_date("dt"))


def test_snapshot_knows_nothing_later(versions):
    cols = ["country", "vip"]
    assert rows(H.snapshot_distinct(versions, "2024-01-05", cols), "user_id", *cols) == [
        (1, "A", "free"), (1, "B", "vip")]
    latest = H.snapshot_latest(versions, "2024-01-08", cols)
    assert rows(latest, "user_id", *cols) == [(1, "B", "vip"), (2, "E", "free")]
    without = H.snapshot_latest(versions.where("dt <= '2024-01-08'"), "2024-01-08", cols)
    assert rows(latest) == rows(without)


def test_as_of_takes_the_version_of_the_records_day(spark, versions):
    calls = [(1, d, i) for i, d in enumerate(["2023-12-31", "2024-01-01", "2024-01-04", "2024-01-05", "2024-03-01"])]
    calls += [(2, "2024-01-06", 10), (2, "2024-01-07", 11), (2, "2024-01-07", 11), (9, "2024-01-07", 12),
              (None, "2024-01-07", 13)]
    c = spark.createDataFrame(calls, "user_id long, day string, call int").withColumn("day", F.to_date("day"))
    got = H.as_of(c.withColumn("vip", F.lit("old")), versions, "day", ["country", "vip"])
    assert rows(got, "call", "country", "vip") == sorted(
        [(0, None, None), (1, "A", "free"), (2, "A", "free"), (3, "B", "vip"), (4, "C", None), (10, None, None),
         (11, "E", "free"), (11, "E", "free"), (12, None, None), (13, None, None)], key=str)


# ---- salted join ------------------------------------------------------------------------
def test_hot_streamer_is_spread_and_nothing_is_lost(spark):
    """One key with a third of all rows, profiles that fan out, a key without profile."""
    data = [(i, 7 if i % 3 == 0 else i % 50 + 100) for i in range(9000)] + [(-1, None)] * 5
    left = spark.createDataFrame(data, "call long, streamer long").repartition(8)
    right = spark.createDataFrame([(7, "x"), (7, "y")] + [(k, "z") for k in range(100, 140)] + [(None, "n")],
                                  "id long, name string")
    heavy = J.heavy_keys(left, "streamer", rows=500)
    assert [r["__heavy"] for r in heavy.collect()] == [7] and heavy.first()["__salts"] == 6
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = J.salted_join(left, right, "streamer", "id", heavy)
        want = left.join(right, left.streamer == right.id).drop("id")
        assert rows(got, "call", "streamer", "name") == rows(want, "call", "streamer", "name")
        tasks = got.where("streamer = 7").withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 0.5 * 6000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# ---- D0 -> D1 -------------------------------------------------------------------------
def test_match_reads_only_the_days_asked_for(spark, t01, tmp_path):
    path = str(tmp_path / "detail")
    detail = CF.call_detail(t01.request_record, t01.video_record, t01.minute_gold, t01.goddess_gold,
                            t01.gift_detail, t01.user_info, 21600)
    CF.detail_days(detail, path)
    few = CF.match_from_detail(CF.read_detail(spark, path, ["2024-01-03", "2024-01-09"]),
                               t01.streamer_country, t01.country_region)
    assert len(few.columns) == 15 and {r.day for r in few.select("day").distinct().collect()} == {
        "2024-01-03", "2024-01-09"}
    assert re.search(r"PartitionFilters: \[[^\]]*day", few._jdf.queryExecution().toString())
    asked = spark.range(1).select(F.lit("2024-01-03").alias("day")).union(
        spark.range(40).where("id > 38").select(F.lit("2024-01-09").alias("day")))
    assert rows(CF.match_from_detail(CF.detail_of_days(spark, path, asked), t01.streamer_country,
                                     t01.country_region)) == rows(few)
    asked = t01.raw("events").where("value > 400").select(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    assert "dynamicpruning" in CF.detail_of_days(spark, path, asked)._jdf.queryExecution().toString().lower()


# ---- publish ----------------------------------------------------------------------------
def test_a_publish_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root, day = str(tmp_path), "2024-01-01"
    wide = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "id long, name string, score double")
    PB.publish(root, day, wide, {"served": ["id", "name"]}, "wide")
    new = spark.createDataFrame([(9, "z", 1.0)], "id long, name string, score double")

    def see():
        return (rows(PB.read_published(spark, root, "wide", [day]), "id"),
                rows(PB.read_published(spark, root, "served", [day]), "id"))

    assert see() == ([(1,), (2,)], [(1,), (2,)])
    with monkeypatch.context() as m:                    # dies after the wide table is written
        m.setattr(PB, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            PB.publish(root, day, new, {"served": ["id", "name"]}, "wide")
    assert see() == ([(1,), (2,)], [(1,), (2,)])
    with pytest.raises(Exception):                      # dies between the two tables
        PB.publish(root, day, new, {"served": ["id", "no_such_column"]}, "wide")
    assert see() == ([(1,), (2,)], [(1,), (2,)])
    PB.publish(root, day, new, {"served": ["id", "name"]}, "wide")
    PB.publish(root, "2024-01-02", wide, {"served": ["id", "name"]}, "wide")
    assert see() == ([(9,)], [(9,)])
    both = PB.read_published(spark, root, "served", [day, "2024-01-02"])
    assert rows(both, "dt", "id") == [(day, 9), ("2024-01-02", 1), ("2024-01-02", 2)]
    with pytest.raises(LookupError):
        PB.read_published(spark, root, "served", ["2030-01-01"])


# ---- schemas --------------------------------------------------------------------------------
def test_bad_casts_are_counted_and_set_aside(spark):
    df = spark.createDataFrame([("1", "x", 1.9), ("7b", None, 2.0), (None, "3", None), ("", "4", -1.5)],
                               "a string, b string, c double")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                           T.StructField("c", T.LongType())])
    assert rows(K.conform(df, schema), "a", "b", "c") == sorted(
        [(1, None, 1), (None, None, 2), (None, 3, None), (None, 4, -1)], key=str)
    assert K.reject_counts(df, schema) == {"a": 2, "b": 1, "c": 0}
    side = sorted((r.a, r.b, r.bad_columns) for r in K.rejected(df, schema).fillna("-").collect())
    assert side == [("", "4", ["a"]), ("1", "x", ["b"]), ("7b", "-", ["a"])]
    assert K.reject_counts(K.conform(df, schema), schema) == {}


# ---- the day's run ------------------------------------------------------------------------
def test_day_run_is_governed_by_its_run(spark, tmp_path):
    """A run of a past day writes the same with all later calls removed, and
    differs from the run of the last day."""
    t = Tables(spark, SF)
    run = dataclasses.replace(D.FIXTURE_RUN, day="2001-07-28", user_days=None)
    out = D.build_day(t, run, str(tmp_path / "a"))
    cut = Tables(spark, SF)
    cut.__dict__["calls"] = t.calls.where(F.col("day") <= "2001-07-28")
    cut.__dict__["country_preference_pre"] = t.country_preference_pre
    again = D.build_day(cut, run, str(tmp_path / "b"))
    for name in ("streamer_level_detail", "country_user_level_detail", "country_user_amount",
                 "country_recall_percentage", "region_preference_all"):
        assert rows(out[name]) == rows(again[name]) != [], name
    assert out["streamer_call_base"].agg(F.sum("frequency")).first()[0] < t.calls.count()


def test_windowed_base_of_a_run(spark, tmp_path):
    t = Tables(spark, SF)
    run = D.DayRun(day=WINDOW_END, run_date=RUN_DATE, call_day="2024-01-30", gap_s=21600, base_days=30)
    assert D._facts(t, run).select("day").distinct().where(
        F.col("day") <= dt.date(2001, 7, 2)).count() == 0


# ---- range runs ---------------------------------------------------------------------------
def test_range_run_writes_only_what_changed(spark, tmp_path):
    """A second run writes nothing; a changed day reruns itself and the days
    whose windows hold it; a run that dies has recorded what it finished."""
    root, days = str(tmp_path), W.window_days("2024-01-10", 6)
    data = [(d, i) for d in days for i in range(3)]
    facts = lambda rows: spark.createDataFrame(rows, "day string, x int").repartition(3)
    dims = lambda v: (spark.createDataFrame([(v,)], "v int"), None)
    ran = []

    def go(rows, v=1, run=ran.extend, together=2):
        ran.clear()
        return BF.range_run(spark, root, "c", days, 2, {"f": (facts(rows), "day"), "d": dims(v)}, run, together)

    def dies(some):
        if days[4] in some:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        go(data, run=dies)
    assert go(data) == ran == days[4:]
    assert go(data) == ran == []
    assert go(list(reversed(data))) == []                          # order does not matter
    assert go([(d, 9 if (d, i) == (days[2], 0) else i) for d, i in data]) == days[2:4]
    assert go(data) == days[2:4]
    assert go(data[:-1]) == days[5:]                                # a row less
    assert go(data[:-1], v=2) == days                               # a dimension changed
    assert BF.recorded(spark, root, "other") == {}


def test_recency_offsets_of_streamers_and_users():
    run = D.DayRun(day="2024-02-28", run_date="2024-02-28")
    assert (run.recency(run.streamer_offset), run.recency(run.user_offset)) == ("2024-02-28", "2024-02-29")
    assert D.FIXTURE_RUN.recency(D.FIXTURE_RUN.user_offset) == RUN_DATE


@pytest.mark.parametrize("key", ["job_user_quintile_level", "active_users", "active_users_vip", "active_streamers",
                                 "active_streamers_region", "job_active_counts"])
def test_jobs_run_over_all_days(t001, key):
    """Without the calls of the trailing windows the jobs still see the days before."""
    from rfmlens.plans.registry import REGISTRY, queries
    queries()
    t = Tables(t001.spark, SF)
    t.__dict__["calls"] = t001.calls.where(F.col("day") < "2001-01-01")
    assert REGISTRY[key](t).count() > 0
