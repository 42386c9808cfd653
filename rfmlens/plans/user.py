"""User side (reference stage ``11``): quintile RFM score with levels per
country, and the total RFM score with levels per region-country (1-3) and
per region (1-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import level3, level5, quintile, safe_div
from ..operators.aggregates import USER_KEYS, call_base, rfm_values
from ..operators.joins import lookup
from ..operators.ranking import RankSpec, rank_columns
from ..session import cut_lineage
from ..operators.scores import (QUINTILE_WEIGHTS, RFM_WEIGHTS, USER_FLAT_DIVISOR, minmax_scale,
                                rank_pct, tenths_blend)
from .streamer import country_level

USER_COUNTRY = ["user_country_id", "user_country_name"]


def user_call_base(calls: DataFrame, run_date: str) -> DataFrame:
    """(user, streamer) call base keyed by the streamer country name."""
    return call_base(calls, run_date, ["streamer_id", "streamer_country_id",
                                       "streamer_country_name"])


def quintile_scores(base: DataFrame) -> DataFrame:
    """Global ranks -> square-law quintile per term -> 0.3F+0.3R+0.4M."""
    v = rfm_values(base, USER_KEYS, {"monetary": "gold_coin_amount"})
    d = rank_columns(v, [RankSpec("frequency", "frequency_rnk", True),
                         RankSpec("monetary", "monetary_rnk", True),
                         RankSpec("recency", "recency_rnk", False)],
                     USER_KEYS, (), count_col="__n")
    for m in ("frequency", "monetary", "recency"):
        d = (d.withColumn(f"{m}_rnk", F.col(f"{m}_rnk").cast("bigint"))
             .withColumn(f"{m}_rnk_max", F.col("__n"))
             .withColumn(f"{m}_score", quintile(safe_div(f"{m}_rnk", "__n"))))
    d = d.withColumn("rfm_score", tenths_blend(
        {f"{m}_score": w for m, w in QUINTILE_WEIGHTS.items()}))
    return cut_lineage(d.drop("__n"))


def quintile_level(calls: DataFrame, run_date: str) -> DataFrame:
    """U01-U03 over all of ``calls``."""
    return quintile_level_of(user_call_base(calls, run_date))


def quintile_level_of(base: DataFrame) -> DataFrame:
    """Level 1-3 of the quintile score per country."""
    return quintile_level_from(quintile_scores(base))


def quintile_level_from(scores: DataFrame) -> DataFrame:
    """Level 1-3 of scored users inside their country."""
    d = country_level(scores, USER_COUNTRY, USER_KEYS)
    return d.select(*USER_KEYS, "frequency", "monetary", "recency",
                    "frequency_rnk", "monetary_rnk", "recency_rnk",
                    "frequency_score", "monetary_score", "recency_score",
                    "rfm_score", "rfm_rnk", "rfm_rnk_percentage", "level")


def total_values(base: DataFrame) -> DataFrame:
    """Four RFM terms per user."""
    return rfm_values(base, USER_KEYS, {"monetary1": "gold_coin_amount",
                                        "monetary2": "call_total_length"})


def total_ranks(values: DataFrame) -> DataFrame:
    """Global rank (1 = best) of each term."""
    d = rank_columns(values, [RankSpec("frequency", "frequency_rnk", True),
                              RankSpec("monetary1", "monetary1_rnk", True),
                              RankSpec("monetary2", "monetary2_rnk", True),
                              RankSpec("recency", "recency_rnk", False)], USER_KEYS, ())
    for c in ("frequency_rnk", "monetary1_rnk", "monetary2_rnk", "recency_rnk"):
        d = d.withColumn(c, F.col(c).cast("bigint"))
    return d


def combine_ranks(ranks: DataFrame) -> DataFrame:
    """F2: the blend over ranks (Q2: 1 = best, so the best user scores lowest)."""
    w = {"frequency_rnk": RFM_WEIGHTS["frequency"], "monetary1_rnk": RFM_WEIGHTS["monetary"],
         "monetary2_rnk": RFM_WEIGHTS["monetary1"], "recency_rnk": RFM_WEIGHTS["recency"]}
    return ranks.withColumn("rfm_combination_score", tenths_blend(w))


TOTAL_COLS = [*USER_KEYS[:3], "user_region_name", "is_user_vip", "frequency", "monetary1",
              "monetary2", "recency", "frequency_rnk", "monetary1_rnk", "monetary2_rnk",
              "recency_rnk", "rfm_combination_score", "rfm_score"]


def total_score(calls: DataFrame, country_region: DataFrame, run_date: str) -> DataFrame:
    """User total RFM score on 1-5 with the user's region."""
    v = total_values(user_call_base(calls, run_date))
    d = cut_lineage(combine_ranks(total_ranks(v)))
    d = minmax_scale(d, "rfm_combination_score", "rfm_score", 1, 5,
                     flat_divisor=USER_FLAT_DIVISOR)
    d = lookup(d, country_region, "user_country_name", "country_name_en",
               {"region_name": "user_region_name"})
    return d.select(*TOTAL_COLS)


def region_levels(score: DataFrame) -> DataFrame:
    """Rank percentage (6 digits) and level 1-3 inside region-country,
    and level 1-5 inside region.  NULL region -> NULL percentage -> last level."""
    d = rank_columns(score, [RankSpec("rfm_score", "rfm_rnk", True)], USER_KEYS,
                     ["user_region_name", *USER_COUNTRY], count_col="rfm_rnk_max")
    d = d.withColumn("rfm_rnk", F.col("rfm_rnk").cast("bigint"))
    d = d.withColumn("rfm_rnk_percentage", rank_pct("rfm_rnk", "rfm_rnk_max", 6))
    d = d.withColumn("level", level3("rfm_rnk_percentage")).drop("rfm_rnk_max")
    d = cut_lineage(d)
    r = rank_columns(d, [RankSpec("rfm_score", "region_rfm_rnk", True)], USER_KEYS,
                     ["user_region_name"], count_col="__rmax")
    r = r.withColumn("region_rfm_rnk", F.col("region_rfm_rnk").cast("bigint"))
    r = r.withColumn("region_rfm_rnk_percentage", rank_pct("region_rfm_rnk", "__rmax", 6))
    return r.withColumn("region_level", level5("region_rfm_rnk_percentage")).drop("__rmax")


def user_level(calls: DataFrame, country_region: DataFrame, run_date: str) -> DataFrame:
    """job_user_level."""
    s = cut_lineage(total_score(calls, country_region, run_date))
    return region_levels(s).select(
        "user_id", *USER_COUNTRY, "user_region_name", "is_user_vip", "rfm_score",
        "rfm_rnk", "rfm_rnk_percentage", "level",
        "region_rfm_rnk", "region_rfm_rnk_percentage", "region_level")
