"""Call facts (reference stage ``01``): channel tagging of call records,
request-to-call match, coin and gift attach, profile enrichment, and the
30-day match table with the streamer's country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import call_start
from ..operators.aggregates import coin_total, gift_total
from ..operators.history import snapshot_distinct
from ..operators.joins import (HEAVY_ROWS, dedup, heavy_keys, interval_match, left_fill, lookup,
                               salted_join)
from ..session import write_once
from ..sources import sinks as K

GAP_S = 60  # reference: a call counts for a click when it starts < 60 s later

# Fixed channel rules of the reference.  Click channels: (name, label,
# place_id, event ids); these calls must be per-minute calls (goddess_video 2).
REQUEST_CHANNELS = (
    ("hotvideo", 1, "8", ("8-1-1-18",)),
    ("livecam", 2, "1", ("1-5-15-12", "1-5-15-14", "1-5-20-1")),
    ("quickchat", 3, "13", ("13-12-17-1",)),
    ("wall", 4, "1", ("1-1-4-7",)),
)
REQUEST_CALL_VIDEO = 2
FRIEND_LOCATIONS = (3, 12, 21, 24)


def record_channels() -> list[tuple[str, int, Column]]:
    """Call-record channels: (name, label, predicate on the call record)."""
    v, loc = F.col("goddess_video"), F.col("goddess_location")
    return [
        ("nine_coin", 5, (F.col("is_pay") == 1) & (v == 1) & (loc == 2)),
        ("both", 6, (v == 1) & (loc == 2) & (F.col("gender_condition") == 0)
         & (F.col("request_type") == 0)),
        ("friend_call_minute", 7, (v == 2) & loc.isin(*FRIEND_LOCATIONS)),
        ("friend_call_times", 8, ~v.isin(2) & loc.isin(*FRIEND_LOCATIONS)),
    ]


CHANNEL_COLS = ["user_id", "target_user_id", "room_id", "create_time", "end_time",
                "video_time", "channel_name", "label"]


def with_call_start(video: DataFrame) -> DataFrame:
    """Call start from the end time and the duration in ms."""
    return video.withColumn(
        "start_time", call_start("create_time", "video_time").cast("timestamp_ntz"))


def tag_request(req: DataFrame) -> DataFrame:
    """The click channel of each request (channels are disjoint)."""
    name = label = None
    for n, lab, place, events in REQUEST_CHANNELS:
        cond = (F.col("place_id") == place) & F.col("event_id").isin(*events)
        name = F.when(cond, F.lit(n)) if name is None else name.when(cond, F.lit(n))
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
    return (req.select("user_id", "target_user_id", "create_time",
                       name.alias("channel_name"), label.alias("label"))
            .filter(F.col("label").isNotNull()))


def request_match(req: DataFrame, video: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Clicks of the four click channels matched to the calls that start
    at or after the click and less than ``gap_s`` seconds later.  All four
    channels go through one interval join."""
    r = tag_request(req).withColumnRenamed("create_time", "click_time")
    calls = (with_call_start(video.filter(F.col("goddess_video") == REQUEST_CALL_VIDEO))
             .select(F.col("user_id").alias("c_user_id"), "matched_id", "room_id",
                     "start_time", F.col("create_time").alias("end_time"), "video_time"))
    m = interval_match(r, calls, [("user_id", "c_user_id"), ("target_user_id", "matched_id")],
                       "click_time", "start_time", gap_s)
    return m.select("user_id", "target_user_id", "room_id",
                    F.col("start_time").alias("create_time"), "end_time", "video_time",
                    "channel_name", F.col("label").cast("int").alias("label"))


def channel_tag(video: DataFrame) -> DataFrame:
    """B1 / B2: one row per call record and satisfied channel rule."""
    rules = record_channels()
    tags = F.array_compact(F.array(*[
        F.when(pred, F.struct(F.lit(n).alias("channel_name"), F.lit(lab).alias("label")))
        for n, lab, pred in rules]))
    v = with_call_start(video).withColumn("__tag", F.explode(tags))
    return v.select("user_id", F.col("matched_id").alias("target_user_id"), "room_id",
                    F.col("start_time").alias("create_time"),
                    F.col("create_time").alias("end_time"), "video_time",
                    F.col("__tag.channel_name").alias("channel_name"),
                    F.col("__tag.label").cast("int").alias("label"))


def channel_union(req: DataFrame, video: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """UNION (distinct) of the click-matched and the record channels."""
    return (request_match(req, video, gap_s).select(*CHANNEL_COLS)
            .unionByName(channel_tag(video).select(*CHANNEL_COLS))
            .distinct())


def attach_coins(channels: DataFrame, minute_gold: DataFrame, goddess_gold: DataFrame,
                 gifts: DataFrame) -> DataFrame:
    """Call coins by (user, streamer, room) and gift coins by (user,
    streamer); missing -> 0.  The gift total lands on every call of the pair
    (Q10: later sums count it once per call)."""
    coins = coin_total(minute_gold, goddess_gold).select(
        "user_id", F.col("remote_user_id").alias("target_user_id"), "room_id", "gold_num")
    g = gift_total(gifts).select("user_id", F.col("streamer_id").alias("target_user_id"),
                                 "gift_gold")
    zero = F.lit(0).cast("decimal(12,2)")
    d = left_fill(channels, coins, ["user_id", "target_user_id", "room_id"], {"gold_num": zero})
    return left_fill(d, g, ["user_id", "target_user_id"], {"gift_gold": zero})


PROFILE_COLS = ["country_id", "country_name_en", "vip_level"]


def snapshot_profiles(profiles: DataFrame, day: str | None = None) -> DataFrame:
    """A3: every profile row (dated up to ``day``, where the profiles have
    versions), sentinel id -1 removed, distinct."""
    if day is not None:
        return snapshot_distinct(profiles, day, PROFILE_COLS)
    return profiles.filter(F.col("user_id") != -1).select("user_id", *PROFILE_COLS).distinct()


def enrich(calls: DataFrame, profiles: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Inner joins to the profile snapshot for the user (country, vip)
    and for the streamer (country).  Calls without a profile drop out; a
    user with two profile rows fans out (Q10).  The profile table grows with
    the user base, so it is not broadcast (AQE may, from runtime sizes); a
    popular streamer or user is salted over several tasks."""
    u = profiles.select("user_id", F.col("country_id").alias("user_country_id"),
                        F.col("country_name_en").alias("user_country_name"),
                        F.coalesce(F.col("vip_level"), F.lit("free")).alias("is_user_vip"))
    s = profiles.select(F.col("user_id").alias("__sid"),
                        F.col("country_id").alias("streamer_country_id"),
                        F.col("country_name_en").alias("streamer_country_name"))
    calls = write_once(calls)          # counted for heavy keys, then joined
    if calls.count() <= heavy_rows:    # then no key can be heavy
        return calls.join(u, "user_id").join(s, F.col("target_user_id") == F.col("__sid")).drop("__sid")
    d = salted_join(calls, u, "user_id", "user_id", heavy_keys(calls, "user_id", rows=heavy_rows))
    return salted_join(d, s, "target_user_id", "__sid", heavy_keys(calls, "target_user_id", rows=heavy_rows))


DETAIL_COLS = ["user_id", "user_country_id", "user_country_name", "is_user_vip",
               "streamer_id", "streamer_country_id", "streamer_country_name", "channel_id",
               "channel_name", "call_begin_time", "call_end_time", "call_total_length",
               "call_gold_coin_amount", "gift_gold_coin_amount"]


def call_detail(req, video, minute_gold, goddess_gold, gifts, profiles,
                gap_s: int = GAP_S) -> DataFrame:
    """job_call_detail: one enriched row per call and channel."""
    ch = channel_union(req, video, gap_s)
    d = enrich(attach_coins(ch, minute_gold, goddess_gold, gifts), snapshot_profiles(profiles))
    return d.select("user_id", "user_country_id", "user_country_name", "is_user_vip",
                    F.col("target_user_id").alias("streamer_id"), "streamer_country_id",
                    "streamer_country_name", F.col("label").cast("bigint").alias("channel_id"),
                    "channel_name", F.col("create_time").alias("call_begin_time"),
                    F.col("end_time").alias("call_end_time"),
                    F.col("video_time").alias("call_total_length"),
                    F.col("gold_num").alias("call_gold_coin_amount"),
                    F.col("gift_gold").alias("gift_gold_coin_amount"))


def window_filter(df: DataFrame, day_col: str, end: str, days: int,
                  inclusive_end: bool = True) -> DataFrame:
    """A2: rows of the ``days`` days ending at ``end`` (partition filter)."""
    d = F.col(day_col)
    lo = F.date_sub(F.to_date(F.lit(end)), days)
    cond = d > lo
    if inclusive_end:
        cond = cond & (d <= F.to_date(F.lit(end)))
    return df.filter(cond)


def call_match(calls: DataFrame, streamer_country: DataFrame, country_region: DataFrame,
               end: str, days: int = 30) -> DataFrame:
    """job_call_match: calls of the last ``days`` days with the streamer's
    country abbreviation (inner) and country id (left lookup)."""
    recent = window_filter(calls, "day", end, days)
    sc = dedup(streamer_country, ["user_id", "country_name_ab"])
    d = recent.select("day", "user_id", "user_country_id", "user_country_name", "vip_level",
                      "streamer_id", "channel_id", "call_begin_time", "call_total_length",
                      "call_gold_coin_amount", "gift_gold_coin_amount")
    d = d.join(sc.select(F.col("user_id").alias("__sid"), "country_name_ab"),
               F.col("streamer_id") == F.col("__sid")).drop("__sid")
    d = lookup(d, country_region, "country_name_ab", "country_ab",
               {"country_id": "streamer_country_id"})
    return d.select("day", "user_id", "user_country_id", "user_country_name",
                    F.col("vip_level").alias("is_user_vip"), "streamer_id", "streamer_country_id",
                    F.col("country_name_ab").alias("streamer_country_name"), "channel_id",
                    "call_begin_time", "call_total_length", "call_gold_coin_amount",
                    "gift_gold_coin_amount")


def detail_days(detail: DataFrame, path: str, days=()) -> None:
    """Call detail written by call day (declared schema); ``days`` names days
    to be replaced even where they have no call."""
    rows = detail.withColumn("day", F.to_date("call_begin_time"))
    if days:
        rows = rows.where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
    K.write_days(rows, path, "day", K.table_schema("call_record_detail"), days)


def read_detail(spark, path: str, days=None) -> DataFrame:
    return K.read_days(spark, path, days, "day", K.table_schema("call_record_detail"))


def match_from_detail(detail: DataFrame, streamer_country: DataFrame, country_region: DataFrame) -> DataFrame:
    """D1 (job_call_match): call detail of the days read, with the streamer's
    country abbreviation (inner: calls of unknown streamers drop out) and
    country id (left lookup).  The name column holds the abbreviation (Q11)."""
    sc = dedup(streamer_country, ["user_id", "country_name_ab"])
    d = detail.drop("streamer_country_id", "streamer_country_name").join(
        sc.select(F.col("user_id").cast("string").alias("__sid"), "country_name_ab"),
        F.col("streamer_id") == F.col("__sid")).drop("__sid")
    d = lookup(d, country_region, "country_name_ab", "country_ab", {"country_id": "streamer_country_id"})
    return d.select("day", "user_id", "user_country_id", "user_country_name", "is_user_vip", "streamer_id",
                    F.col("streamer_country_id").cast("string").alias("streamer_country_id"),
                    F.col("country_name_ab").alias("streamer_country_name"), "channel_id", "channel_name",
                    "call_begin_time", "call_end_time", "call_total_length", "call_gold_coin_amount",
                    "gift_gold_coin_amount")


def detail_of_days(spark, path: str, asked: DataFrame) -> DataFrame:
    """Call detail of the days that a table of days names: the join prunes the
    partitions at run time."""
    return read_detail(spark, path).join(F.broadcast(asked.select("day").distinct()), "day", "left_semi")


def day_list(end: str, first_back: int, last_back: int) -> list[str]:
    """Days end-first_back .. end-last_back as ISO strings (driver-side,
    a handful of dates: the backfill range)."""
    import datetime as dt
    e = dt.date.fromisoformat(end)
    return [(e - dt.timedelta(days=k)).isoformat() for k in range(first_back, last_back - 1, -1)]


def backfill_rows(calls: DataFrame, streamer_country: DataFrame, end: str,
                  first_back: int, last_back: int) -> DataFrame:
    """Match rows for a range of days in one job (the reference loops
    over 26 days with one INSERT each).  Streamer country by abbreviation
    (inner), the id column left empty as in the backfill job."""
    e = F.to_date(F.lit(end))
    d = calls.filter(F.col("day").between(F.date_sub(e, first_back), F.date_sub(e, last_back)))
    sc = dedup(streamer_country, ["user_id", "country_name_ab"])
    d = d.join(sc.select(F.col("user_id").alias("__sid"), "country_name_ab"),
               F.col("streamer_id") == F.col("__sid"))
    return d.select("day", "user_id", "user_country_id", "user_country_name",
                    F.col("vip_level").alias("is_user_vip"), "streamer_id",
                    F.lit("").alias("streamer_country_id"),
                    F.col("country_name_ab").alias("streamer_country_name"), "channel_id",
                    "call_begin_time", "call_total_length", "call_gold_coin_amount",
                    "gift_gold_coin_amount")
