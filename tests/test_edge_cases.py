"""Layer 3: hand-made rows for the edge cases of SURVEY section 5 / FIXTURES part 3."""
import datetime as dt
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rfmlens.functions.columns import level3, level5
from rfmlens.operators.ranking import RankSpec, rank_columns
from rfmlens.operators.scores import minmax_scale, share
from rfmlens.plans import call_facts as CF
from rfmlens.plans import recall as R
from rfmlens.sources import sinks as K

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

REQ = "user_id long, target_user_id long, create_time timestamp_ntz, place_id string, event_id string"
VID = ("user_id long, matched_id long, room_id long, create_time timestamp_ntz, video_time long, "
       "goddess_video int, goddess_location int, is_pay int, gender_condition int, request_type int")


def _call(room, start_offset_s, dur_s=10):
    end = T0 + dt.timedelta(seconds=start_offset_s + dur_s)
    return (1, 2, room, end, dur_s * 1000, 2, 1, 0, 1, 1)


def test_gap_bounds(spark):
    req = spark.createDataFrame([(1, 2, T0, "8", "8-1-1-18")], REQ)
    vid = spark.createDataFrame([_call(10, 0), _call(11, 59), _call(12, 60), _call(13, -1)], VID)
    got = {r["room_id"] for r in CF.request_match(req, vid, 60).collect()}
    assert got == {10, 11}


def test_repeated_request_one_row_after_union(spark):
    req = spark.createDataFrame([(1, 2, T0, "8", "8-1-1-18")] * 2, REQ)
    vid = spark.createDataFrame([_call(10, 5)], VID)
    assert CF.request_match(req, vid, 60).count() == 2          # every match kept
    assert CF.channel_union(req, vid, 60).count() == 1          # distinct union


def test_ties_ordered_by_id(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, 9)], "id long, m long")
    got = {r["id"]: r["r"] for r in rank_columns(df, [RankSpec("m", "r", True)], "id").collect()}
    assert got == {4: 1, 1: 2, 2: 3, 3: 4}


def test_max_equals_min(spark):
    df = spark.createDataFrame([("a", 7.0)], "g string, x double")
    guarded = minmax_scale(df, "x", "s", flat_divisor=10000).first()["s"]
    unguarded = minmax_scale(df, "x", "s", group_by=["g"]).first()["s"]
    assert guarded == 1.0 and unguarded is None


def test_null_group_share_and_level(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("A", 2.0), ("A", 2.0)], "g string, p double")
    rows = share(df, ["g"], "p", "pct", 5).collect()
    assert all(r["pct"] is None for r in rows if r["g"] is None)
    assert sorted(r["pct"] for r in rows if r["g"] == "A") == [0.5, 0.5]
    lv = spark.createDataFrame([(None,), (0.05,)], "p double").select(
        level3("p").alias("l3"), level5("p").alias("l5")).collect()
    assert (lv[0]["l3"], lv[0]["l5"]) == (3, 5) and (lv[1]["l3"], lv[1]["l5"]) == (1, 1)


PRE_COLS = ("country_name_en string, country string, region_name string, if_vip string, streamer_country string, "
            "streamer_region string, " + ", ".join(f"{c} long" for c in R.COUNTERS[:-1])
            + ", total_video_duration decimal(22,2), avg_video_duration double, "
              "friend_total_gold decimal(22,2)")


def _pre_row(plays, success, friend_video):
    vals = dict.fromkeys(R.COUNTERS[:-1], 1)
    vals.update(both_play_times=plays, both_success_times=success, friend_video_times=friend_video,
                hotvideo_play_times=plays, hotvideo_success_times=success)
    return (("N_A", "NA", "R1", "vip", "N0", "R1") + tuple(vals[c] for c in R.COUNTERS[:-1])
            + (Decimal("100.00"), 10.0, Decimal("5.00")))


def _dims(spark):
    return spark.createDataFrame([(0, "N_0", "N0", 1, "R1")],
                                 "country_id long, country_name_en string, country_ab string, "
                                 "region_id long, region_name string")


def test_zero_plays(spark):
    pre = spark.createDataFrame([_pre_row(0, 0, 0)], PRE_COLS)
    r = R.activity(pre, _dims(spark), R.COUNTRY).first()
    assert r["raw_score"] == 0.0 and r["success_rate_both"] is None


def test_no_behaviour_row(spark):
    pref = spark.createDataFrame([(1, "N_A", 0, "N_0", "1", 3.5)],
                                 "user_country_id long, user_country_name string, "
                                 "streamer_country_id long, streamer_country_name string, "
                                 "is_user_vip string, preference double")
    pre = spark.createDataFrame([_pre_row(5, 2, 1)], PRE_COLS).filter("false")
    behav = R.behaviour(R.activity(pre, _dims(spark), R.COUNTRY), R.COUNTRY)
    integ = R.integrate(pref, behav, R.COUNTRY)
    row = integ.first()
    assert row["final_score1"] is None and row["rfm_score"] == 3.5
    base = spark.createDataFrame([(1, "N_A", "1", 0, "N_0")],
                                 "user_country_id long, user_country_name string, is_user_vip string, "
                                 "streamer_country_id long, streamer_country_name string")
    g = R.blended_grid(base, integ, _dims(spark), R.COUNTRY).first()
    assert (g["preference"], g["preference_rule"]) == (0.5, 0.1)


def test_two_profile_rows_double_the_call(spark):
    calls = spark.createDataFrame([(1, 2, 10)], "user_id long, target_user_id long, room_id long")
    prof = spark.createDataFrame([(1, 1, "A", "free"), (1, 2, "B", "vip"), (2, 3, "C", None)],
                                 "user_id long, country_id long, country_name_en string, vip_level string")
    assert CF.enrich(calls, CF.snapshot_profiles(prof)).count() == 2


def test_top3_with_two_and_five_candidates(spark):
    rows = [(1, "A", "1", i, f"S{i}", float(i)) for i in range(2)]
    rows += [(2, "B", "1", i, f"S{i}", float(i)) for i in range(5)]
    dist = spark.createDataFrame(rows, "user_country_id long, user_country_name string, "
                                       "is_user_vip string, streamer_country_id long, "
                                       "streamer_country_name string, preference double")
    allow = dist.select("user_country_name", "streamer_country_name")
    top = R.recall_top(dist, allow, R.COUNTRY).collect()
    by = {}
    for r in top:
        by.setdefault(r["user_country_name"], []).append(r)
    assert len(by["A"]) == 2 and len(by["B"]) == 3
    assert {r["streamer_country_name"] for r in by["B"]} == {"S4", "S3", "S2"}
    # three shares each rounded to 3 digits: off by at most 3 x 0.0005
    assert sum(r["percentage"] for r in by["B"]) == pytest.approx(1.0, abs=1.5e-3)


def test_day_rewrite_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="rfmlens-day-") + "/t"
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "k long, v string")
    K.write_day(a, path, "2024-01-01")
    K.write_day(b, path, "2024-01-02")
    K.write_day(b, path, "2024-01-01")
    K.write_day(b, path, "2024-01-01")
    got = K.read_days(spark, path)
    per = {r["dt"]: r["n"] for r in got.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"2024-01-01": 2, "2024-01-02": 2}
    assert got.filter("dt = '2024-01-02'").orderBy("k").collect()[0]["k"] == 2


def test_interval_match_across_bucket_edges(spark):
    """Matches straddling a time-bucket edge (bucket width = gap) are kept,
    and the result equals a brute-force pairwise check."""
    from rfmlens.operators.joins import interval_match
    base = dt.datetime(2024, 1, 1, 0, 0, 0)          # epoch seconds divisible by 60
    clicks = [(1, 2, base + dt.timedelta(seconds=s)) for s in (0, 58, 59, 60, 119, 179)]
    calls = [(1, 2, base + dt.timedelta(seconds=s)) for s in (1, 59, 60, 61, 118, 120, 178, 240)]
    r = spark.createDataFrame(clicks, "u long, t long, ts timestamp_ntz")
    c = spark.createDataFrame(calls, "cu long, ct long, cts timestamp_ntz")
    got = sorted((x["ts"], x["cts"]) for x in
                 interval_match(r, c, [("u", "cu"), ("t", "ct")], "ts", "cts", 60).collect())
    exp = sorted((a[2], b[2]) for a in clicks for b in calls
                 if 0 <= (b[2] - a[2]).total_seconds() < 60)
    assert got == exp and len(exp) > 0


def test_rewriting_a_day_without_rows_empties_it(spark, tmp_path):
    from rfmlens.sources import sinks as K
    path = str(tmp_path / "t")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    K.write_day(two, path, "2001-01-01")
    K.write_day(two, path, "2001-01-02")
    K.write_day(two.limit(0), path, "2001-01-01")
    got = K.read_days(spark, path)
    assert {r.dt for r in got.collect()} == {"2001-01-02"} and got.count() == 2
    more = two.withColumn("dt", F.lit("2001-01-03"))
    K.write_days(more, path, days=["2001-01-02", "2001-01-03"])
    assert {r.dt for r in K.read_days(spark, path).collect()} == {"2001-01-03"}


def test_day_files_do_not_grow_with_tasks(spark, tmp_path):
    import glob
    from rfmlens.sources import sinks as K
    path = str(tmp_path / "t")
    rows = spark.range(3000).repartition(24).withColumn("dt", F.concat(F.lit("d"), (F.col("id") % 5).cast("string")))
    K.write_days(rows, path)
    assert len(glob.glob(f"{path}/dt=*/part-*.parquet")) <= 10
    assert K.read_days(spark, path).count() == 3000


def test_table_root_is_the_same_for_every_application(spark):
    from rfmlens.session import TABLE_ROOT_KEY, table_root
    spark.conf.set(TABLE_ROOT_KEY, "/data/tables/")
    try:
        assert table_root(spark) == "/data/tables"
    finally:
        spark.conf.unset(TABLE_ROOT_KEY)
    assert table_root(spark).endswith("/tables")


def test_a_cluster_without_a_table_root_writes_below_the_shared_folder(tmp_path):
    """The shared folder is all a cluster session has to name."""
    from types import SimpleNamespace
    from rfmlens.session import table_root
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: f"file://{tmp_path}/shared")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=sc)
    assert table_root(session) == f"file://{tmp_path}/shared/tables"
    sc.getCheckpointDir = lambda: None
    with pytest.raises(ValueError):
        table_root(session)
