"""The day tables behind the trailing windows (A2) and what is merged from them.

``refresh`` turns the call facts of some days into partitions of three tables:
call-base partials, and bitmaps of active users and of active streamers (both
made from the partials).  The windows of the jobs - 3 days for the user
quintiles, 2 for the active counts - read their days' partitions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bitmaps as B
from ..operators.aggregates import USER_KEYS
from ..operators.joins import lookup
from ..operators.partials import PARTIAL_KEYS, day_partials, merge_partials
from ..sources import sinks as K
from .call_facts import day_list
from .user import quintile_level_of

# Fixed window lengths of the reference's jobs, in days.
USER_DAYS = 3
ACTIVE_DAYS = 2
MATCH_DAYS = 30

USER_COUNTRY = ["user_country_id", "user_country_name"]
STREAMER_COUNTRY_AB = ["streamer_country_id", "streamer_country_name_ab"]
USER_BASE_KEYS = [*USER_KEYS, "streamer_id", "streamer_country_id", "streamer_country_name"]


def window_days(end: str, days: int) -> list[str]:
    """The ``days`` days ending with ``end``, as ISO strings."""
    return day_list(end, days - 1, 0)


@dataclass(frozen=True)
class DayStore:
    """The three day tables below ``root``."""
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def refresh(self, calls: DataFrame, days: Sequence[str], bitmaps: bool = True) -> None:
        """(Re)write the partitions of ``days`` from the call facts; one scan of them.
        Without ``bitmaps`` the call-base partials only."""
        days = list(days)
        rows = calls.where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
        K.write_days(day_partials(rows), self.path("call_base_partials"), "day", days=days)
        if not bitmaps:
            return
        partials = self.partials(days)
        users = B.distinct_bitmaps(partials, ["day", *USER_COUNTRY, "is_user_vip"], "user_id")
        K.write_days(users, self.path("active_user_bitmaps"), "day", days=days)
        streamers = B.distinct_bitmaps(partials, ["day", *STREAMER_COUNTRY_AB], "streamer_id")
        K.write_days(streamers, self.path("active_streamer_bitmaps"), "day", days=days)

    def partials(self, days: Sequence[str]) -> DataFrame:
        return K.read_days(self.spark, self.path("call_base_partials"), days, "day")

    def users(self, days: Sequence[str]) -> DataFrame:
        return K.read_days(self.spark, self.path("active_user_bitmaps"), days, "day")

    def streamers(self, days: Sequence[str]) -> DataFrame:
        return K.read_days(self.spark, self.path("active_streamer_bitmaps"), days, "day")


def window_base(store: DayStore, end: str, days: int, run_date: str,
                keys: Sequence[str] = tuple(PARTIAL_KEYS)) -> DataFrame:
    """G1 over the window: the call base merged from day partials."""
    return merge_partials(store.partials(window_days(end, days)), run_date, keys)


def quintile_level(store: DayStore, end: str, run_date: str, days: int = USER_DAYS) -> DataFrame:
    """job_user_quintile_level (U01-U03) over the last ``days`` days."""
    return quintile_level_of(window_base(store, end, days, run_date, USER_BASE_KEYS))


def active_users(store: DayStore, end: str, with_vip: bool, days: int = ACTIVE_DAYS) -> DataFrame:
    """Average daily distinct users per user country (and vip flag)."""
    keys = USER_COUNTRY + (["is_user_vip"] if with_vip else [])
    return B.avg_daily(store.users(window_days(end, days)), "day", keys, "user_active_amount")


def active_streamers(store: DayStore, end: str, country_region: DataFrame, days: int = ACTIVE_DAYS) -> DataFrame:
    """S41 / G6 + J3: average daily distinct streamers per streamer country."""
    d = B.avg_daily(store.streamers(window_days(end, days)), "day", STREAMER_COUNTRY_AB, "streamer_active_amount")
    d = lookup(d, country_region, "streamer_country_name_ab", "country_ab",
               {"country_name_en": "streamer_country_name", "region_name": "streamer_region_name"})
    return d.select("streamer_country_id", "streamer_country_name", "streamer_country_name_ab",
                    "streamer_region_name", "streamer_active_amount")


def distinct_users(store: DayStore, end: str, lengths: Sequence[int]) -> DataFrame:
    """Distinct active users per country over several windows that end on the
    same day, from one read of the longest: each day's set counts in every
    window that holds the day."""
    ends = F.lit(end).cast("date")
    bitmaps = store.users(window_days(end, max(lengths)))
    age = F.datediff(ends, F.col("day").cast("date"))
    windows = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: age < n)
    rows = bitmaps.withColumn("window_days", F.explode(windows))
    return B.distinct_members(rows, ["window_days", *USER_COUNTRY], "user_amount")
