"""Behaviour-based recall (reference stages ``20`` steps 41-45 and ``21``
steps 41-45): activity rates and raw score per pair, behaviour score, blend
with the RFM preference, allow-list of pairs with enough coins, full grid,
top-3 streamer countries per user group and their renormalised shares.

All tables are at pair grain (user country or region x vip class x
streamer country): bounded by the country dimension, so windows are plain
and joins are left to AQE's runtime size check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag_from_if_vip, if_vip_from_flag, round_half_up, safe_div
from ..operators.joins import dedup, left_fill, lookup, semi_filter
from ..operators.ranking import RankSpec, rank_columns, top_k
from ..operators.scores import BLEND_WEIGHTS, blend, minmax_scale, rate, share

# Fixed defaults of the grid (pairs without a blended / raw score).
PREF_DEFAULT = 0.5
RULE_DEFAULT = 0.1
TOP_K = 3

COUNTERS = ["user_cnt", "both_play_times", "both_call_times", "both_request_times",
            "both_success_times", "hotvideo_play_times", "hotvideo_call_times",
            "hotvideo_request_times", "hotvideo_success_times", "friend_call_users",
            "friend_call_times", "friend_video_users", "friend_video_times",
            "total_video_duration"]
STREAMER = ["streamer_country_name", "streamer_country_name_ab", "streamer_region_name"]


@dataclass(frozen=True)
class RecallGrain:
    name: str
    user: str             # user-group name column of the activity tables
    behaviour_basis: str  # "raw" (country) or "rank" (region), Q18


COUNTRY = RecallGrain("country", "user_country_name", "raw")
REGION = RecallGrain("region", "user_region_name", "rank")


# ---- activity (F16, F17, G11) --------------------------------------------------
def activity_region_rollup(pre: DataFrame) -> DataFrame:
    """Counters summed from countries to the user's region; the average
    duration is the average of the country averages (rounded to 6 digits so
    that it does not depend on the summation order)."""
    return (pre.groupBy(F.col("region_name").alias("user_region_name"), "if_vip",
                        F.col("streamer_country").alias("streamer_country_name_ab"),
                        F.col("streamer_region").alias("streamer_region_name"))
            .agg(*[F.sum(c).alias(c) for c in COUNTERS],
                 round_half_up(F.avg("avg_video_duration"), 6).alias("avg_video_duration")))


def activity(pre: DataFrame, country_region: DataFrame, g: RecallGrain) -> DataFrame:
    """Success rates and the raw activity score per pair,
    with the streamer country's name attached by abbreviation (J3)."""
    if g is COUNTRY:
        d = pre.select(F.col("country_name_en").alias("user_country_name"),
                       F.col("country").alias("user_country_name_ab"),
                       F.col("region_name").alias("user_region_name"), "if_vip",
                       F.col("streamer_country").alias("streamer_country_name_ab"),
                       F.col("streamer_region").alias("streamer_region_name"),
                       *COUNTERS, "avg_video_duration")
    else:
        d = activity_region_rollup(pre)
    d = (d.withColumn("success_rate_both", rate("both_success_times", "both_play_times"))
         .withColumn("success_rate_hotvideo", rate("hotvideo_success_times", "hotvideo_play_times"))
         .withColumn("raw_score", F.coalesce(round_half_up(safe_div(
             F.col("both_success_times") * F.col("total_video_duration"),
             # as DOUBLE: same value as the exact product, no BIGINT overflow
             F.col("both_play_times").cast("double") * F.col("friend_video_times").cast("double")),
             3), F.lit(0.0))))
    d = lookup(d, country_region, "streamer_country_name_ab", "country_ab",
               {"country_name_en": "streamer_country_name"})
    head = (["user_country_name", "user_country_name_ab", "user_region_name"] if g is COUNTRY
            else ["user_region_name"])
    return d.select(*head, "if_vip", *STREAMER, *COUNTERS, "avg_video_duration",
                    "success_rate_both", "success_rate_hotvideo", "raw_score")


# ---- behaviour score (W5, F18) ---------------------------------------------------
def behaviour(act: DataFrame, g: RecallGrain) -> DataFrame:
    """Rank (best = 1) and inverse rank of the raw score inside (group,
    vip); F18: min-max to 1-5 per group of the raw score (country) or of the
    inverse rank (region); unguarded (NULL when max = min)."""
    d = rank_columns(act, [RankSpec("raw_score", "hotvideo_rnk", True)],
                     ["streamer_country_name_ab"], [g.user, "if_vip"], count_col="__n",
                     bounded=True)
    d = d.withColumn("hotvideo_rnk", F.col("hotvideo_rnk").cast("bigint"))
    d = d.withColumn("hotvideo_combination_score",
                     (F.col("__n") + 1 - F.col("hotvideo_rnk")).cast("bigint")).drop("__n")
    d = minmax_scale(d, "hotvideo_combination_score", "hotvideo_rank_score_norm",
                     group_by=[g.user])
    if g is COUNTRY:
        d = minmax_scale(d, "raw_score", "hotvideo_raw_score_norm", group_by=[g.user])
        return d.withColumn("hotvideo_score", F.col("hotvideo_raw_score_norm"))
    return d.withColumn("hotvideo_score", F.col("hotvideo_rank_score_norm"))


# ---- integration (J12, F19) -------------------------------------------------------
def integrate(pref: DataFrame, behav: DataFrame, g: RecallGrain) -> DataFrame:
    """The RFM preference of each pair, left-joined to its behaviour row
    on (group name, vip class, streamer country name); F19: three blends,
    NULL without a behaviour row.  The group name is taken from the left
    side (Q16).  Counters ride along for the zero-fill after the allow-list."""
    user_cols = (["user_country_id", "user_country_name"] if g is COUNTRY
                 else ["user_region_name"])
    left = dedup(pref.select(*user_cols, "streamer_country_id", "streamer_country_name",
                             if_vip_from_flag("is_user_vip").alias("if_vip"), "preference"))
    extra = ["user_country_name_ab", "user_region_name"] if g is COUNTRY else []
    right = behav.select(F.col(g.user).alias("__u"), F.col("if_vip").alias("__v"),
                         F.col("streamer_country_name").alias("__s"), *extra,
                         "streamer_country_name_ab", "streamer_region_name", "hotvideo_score",
                         F.col("raw_score").alias("raw_hotvideo_score"),
                         "success_rate_hotvideo", "success_rate_both", *COUNTERS,
                         "avg_video_duration")
    d = left.join(right, (left[g.user] == right["__u"]) & (left["if_vip"] == right["__v"])
                  & (left["streamer_country_name"] == right["__s"]), "left")
    d = d.drop("__u", "__v", "__s").withColumnRenamed("preference", "rfm_score")
    for i, (w, _) in enumerate(BLEND_WEIGHTS, start=1):
        d = d.withColumn(f"final_score{i}", blend("rfm_score", "hotvideo_score", w))
    return d


def integration_cols(g: RecallGrain) -> list[str]:
    user = (["user_country_id", "user_country_name", "user_country_name_ab", "user_region_name"]
            if g is COUNTRY else ["user_region_name"])
    return [*user, "if_vip", "streamer_country_id", *STREAMER, "final_score1", "final_score2",
            "final_score3", "rfm_score", "hotvideo_score", "raw_hotvideo_score",
            "success_rate_hotvideo"]


# ---- allow-list (B9, B10, J11, F20) ------------------------------------------------
def allow_pairs_row(pre: DataFrame, country_region: DataFrame, g: RecallGrain,
                    threshold: float) -> DataFrame:
    """(group name, streamer country name) of source rows with at least
    ``threshold`` coins, de-duplicated."""
    src = "country_name_en" if g is COUNTRY else "region_name"
    d = dedup(pre.filter(F.col("friend_total_gold") >= threshold)
              .select(F.col(src).alias(g.user), "streamer_country"))
    return _allow_names(d, country_region, g)


def allow_pairs_sum(pre: DataFrame, country_region: DataFrame, g: RecallGrain,
                    threshold: float) -> DataFrame:
    """Pairs whose coins summed over the group reach ``threshold``."""
    src = "country_name_en" if g is COUNTRY else "region_name"
    d = (pre.groupBy(F.col(src).alias(g.user), "streamer_country")
         .agg(F.sum("friend_total_gold").alias("__g"))
         .filter(F.col("__g") >= threshold).drop("__g"))
    return _allow_names(d, country_region, g)


def _allow_names(d: DataFrame, country_region: DataFrame, g: RecallGrain) -> DataFrame:
    d = lookup(d, country_region, "streamer_country", "country_ab",
               {"country_name_en": "streamer_country_name"})
    return dedup(d.select(g.user, "streamer_country_name"))


def allow_filter(integ: DataFrame, allow: DataFrame, g: RecallGrain) -> DataFrame:
    """J11 + F20: integrated pairs on the allow-list; missing activity
    counters and rates become 0 (country job)."""
    d = semi_filter(integ, allow, [g.user, "streamer_country_name"])
    if g is COUNTRY:
        fill = {c: 0 for c in COUNTERS}
        fill.update({"avg_video_duration": 0.0, "success_rate_both": 0.0,
                     "success_rate_hotvideo": 0.0})
        for c, v in fill.items():
            d = d.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(integ.schema[c].dataType)))
        return d.select(*integration_cols(g)[:-1], *COUNTERS, "avg_video_duration",
                        "success_rate_both", "success_rate_hotvideo")
    return d.select(*integration_cols(g))


# ---- grid on the blended score (J7, J8, F12, F13) -----------------------------------
def blended_grid(call_base: DataFrame, integ: DataFrame, country_region: DataFrame,
                 g: RecallGrain) -> DataFrame:
    """Every (user group, vip) x streamer country with the blended
    preference (default 0.5) and, for countries, the raw-score rule
    preference (default 0.1); joined on names (Q9)."""
    from ..operators.joins import pair_grid
    if g is COUNTRY:
        left = call_base.select("user_country_id", "user_country_name", "is_user_vip").distinct()
    else:
        left = call_base.select("user_region_name", "is_user_vip").distinct()
        left = lookup(left, country_region, "user_region_name", "region_name",
                      {"region_id": "user_region_id"})
    right = call_base.select("streamer_country_id", "streamer_country_name").distinct()
    grid = pair_grid(left, right)
    sc = integ.select(F.col(g.user).alias("__u"),
                      flag_from_if_vip("if_vip").alias("__v"),
                      F.col("streamer_country_name").alias("__s"),
                      F.col("final_score1").alias("preference"),
                      F.col("raw_hotvideo_score").alias("preference_rule"))
    d = grid.join(sc, (grid[g.user] == sc["__u"]) & (grid["is_user_vip"] == sc["__v"])
                  & (grid["streamer_country_name"] == sc["__s"]), "left")
    d = d.drop("__u", "__v", "__s")
    d = d.withColumn("preference", F.coalesce("preference", F.lit(PREF_DEFAULT)))
    if g is COUNTRY:
        d = d.withColumn("preference_rule", F.coalesce("preference_rule", F.lit(RULE_DEFAULT)))
    else:
        d = d.drop("preference_rule")
    return d


def grid_shares(grid: DataFrame, country_region: DataFrame, g: RecallGrain) -> DataFrame:
    """Preference share of the group total (5 digits); the rule
    share divides the rule preference by the same total (Q3); the streamer
    country id is re-attached by name (J3)."""
    keys = (["user_country_id", "user_country_name", "is_user_vip"] if g is COUNTRY
            else ["user_region_id", "user_region_name", "is_user_vip"])
    d = share(grid, keys, "preference", "percentage", 5)
    if g is COUNTRY:
        d = share(d, keys, "preference_rule", "percentage_rule", 5, den="preference")
    d = lookup(d.drop("streamer_country_id"), country_region, "streamer_country_name",
               "country_name_en", {"country_id": "streamer_country_id"})
    tail = ["preference", "percentage"] + (
        ["preference_rule", "percentage_rule"] if g is COUNTRY else [])
    return d.select(*keys, "streamer_country_id", "streamer_country_name", *tail)


# ---- top 3 and renormalised shares (W6, F14) -----------------------------------------
def recall_filtered(dist: DataFrame, allow: DataFrame, g: RecallGrain,
                    by: str = "preference") -> DataFrame:
    """The allow-listed grid pairs with their ``by`` preference."""
    keys = (["user_country_id", "user_country_name", "is_user_vip"] if g is COUNTRY
            else ["user_region_id", "user_region_name", "is_user_vip"])
    return semi_filter(dedup(dist.select(*keys, "streamer_country_id", "streamer_country_name",
                                         by)), allow, [g.user, "streamer_country_name"])


def recall_top(dist: DataFrame, allow: DataFrame, g: RecallGrain,
               by: str = "preference") -> DataFrame:
    """W6 + F14: allow-listed grid pairs, the 3 best streamer countries per
    (group, vip) by ``by``, and each one's share of those three (3 digits)."""
    keys = (["user_country_id", "user_country_name", "is_user_vip"] if g is COUNTRY
            else ["user_region_id", "user_region_name", "is_user_vip"])
    d = recall_filtered(dist, allow, g, by)
    top = top_k(d, [g.user, "is_user_vip"],
                [F.col(by).desc(), F.col("streamer_country_name").asc(),
                 F.col("streamer_country_id").asc()], TOP_K).drop("rnk")
    top = top.withColumnRenamed(by, "preference") if by != "preference" else top
    return share(top, keys, "preference", "percentage", 3)


__all__ = ["blended_grid", "grid_shares", "recall_filtered", "recall_top", "activity",
           "behaviour", "integrate", "allow_filter", "allow_pairs_row", "allow_pairs_sum"]
