"""The query catalogue (keys of SURVEY section 2), one function per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.fixtures import RUN_DATE, Tables
from . import streamer as S
from .registry import register


def _memo(t: Tables, key: str, build):
    """Intermediates shared by the helpers below are built once per run
    (they are checkpointed eagerly, so rebuilding would recompute them)."""
    memo = t.__dict__.setdefault("_memo", {})
    if key not in memo:
        memo[key] = build()
    return memo[key]


# ---- streamer stage --------------------------------------------------------
@register("call_base")
def q_call_base(t: Tables):
    """G1 + J3: (user, streamer) call base with regions."""
    return S.streamer_call_base(t.calls, t.country_region, RUN_DATE)


@register("job_streamer_level")
def q_job_streamer_level(t: Tables):
    """Streamer RFM score and level per country (entry query)."""
    return S.streamer_level(t.calls, t.country_region, t.streamer_weight, RUN_DATE)


# ---- call facts ---------------------------------------------------------------
from ..sources.fixtures import FIXTURE_GAP_S, WINDOW_END  # noqa: E402
from . import call_facts as CF  # noqa: E402


@register("scan_day")
def q_scan_day(t: Tables):
    """A1: one day partition of the call facts."""
    return t.calls.filter(F.col("day") == F.to_date(F.lit(WINDOW_END))).select(
        "day", "user_id", "streamer_id", "room_id", "channel_id", "call_total_length")


@register("scan_window")
def q_scan_window(t: Tables):
    """A2: the trailing 30 days of call facts ending on the run day."""
    return CF.window_filter(t.calls, "day", WINDOW_END, 30).select(
        "day", "user_id", "streamer_id", "room_id", "channel_id", "call_total_length")


@register("call_start")
def q_call_start(t: Tables):
    """Call start = end - duration (ms truncated to seconds)."""
    return CF.with_call_start(t.video_record).select(
        "user_id", "matched_id", "room_id", "create_time", "video_time", "start_time")


@register("channel_tag")
def q_channel_tag(t: Tables):
    """B1 / B2: call-record channels with name and label."""
    return CF.channel_tag(t.video_record)


@register("request_match_join")
def q_request_match_join(t: Tables):
    """Clicks of four channels matched to calls starting within the gap."""
    return CF.request_match(t.request_record, t.video_record, FIXTURE_GAP_S)


@register("channel_union")
def q_channel_union(t: Tables):
    """Distinct union of the eight channel branches."""
    return CF.channel_union(t.request_record, t.video_record, FIXTURE_GAP_S)


@register("coin_total")
def q_coin_total(t: Tables):
    """Coins per (user, remote user, room) over two coin tables."""
    from ..operators.aggregates import coin_total
    return coin_total(t.minute_gold, t.goddess_gold)


@register("gift_total")
def q_gift_total(t: Tables):
    """Gift coins per (sender, receiver)."""
    from ..operators.aggregates import gift_total
    return gift_total(t.gift_detail)


@register("coin_gift_attach")
def q_coin_gift_attach(t: Tables):
    """Coins and gifts attached to every channel row, default 0."""
    ch = CF.channel_union(t.request_record, t.video_record, FIXTURE_GAP_S)
    return CF.attach_coins(ch, t.minute_gold, t.goddess_gold, t.gift_detail)


@register("enrich_calls")
def q_enrich_calls(t: Tables):
    """Channel rows joined (inner) to both parties' profiles."""
    ch = CF.channel_union(t.request_record, t.video_record, FIXTURE_GAP_S)
    return CF.enrich(ch, CF.snapshot_profiles(t.user_info))


@register("job_call_detail")
def q_job_call_detail(t: Tables):
    """Full call-detail build (channels, match, coins, gifts, profiles)."""
    return CF.call_detail(t.request_record, t.video_record, t.minute_gold, t.goddess_gold,
                          t.gift_detail, t.user_info, FIXTURE_GAP_S)


# ---- streamer stage, operator by operator -----------------------------------
def _s_base(t: Tables):
    return S.streamer_call_base(t.calls, t.country_region, RUN_DATE)


@register("rfm_values_streamer")
def q_rfm_values_streamer(t: Tables):
    """Streamer RFM values with NULL defaults."""
    return S.streamer_values(_s_base(t))


@register("global_rank_streamer")
def q_global_rank_streamer(t: Tables):
    """Global ranks and reverse scores of the four streamer terms."""
    return S.rfm_ranks(S.streamer_values(_s_base(t)), S.STREAMER_KEYS)


@register("rfm_combine_streamer")
def q_rfm_combine_streamer(t: Tables):
    """RFM blend over the inverse ranks."""
    return S.combine_scores(S.rfm_ranks(S.streamer_values(_s_base(t)), S.STREAMER_KEYS))


@register("minmax_global")
def q_minmax_global(t: Tables):
    """Global max and min of the blended score (one row)."""
    c = S.combine_scores(S.rfm_ranks(S.streamer_values(_s_base(t)), S.STREAMER_KEYS))
    return c.agg(F.max("rfm_combination_score").alias("rfm_combination_score_max"),
                 F.min("rfm_combination_score").alias("rfm_combination_score_min"))


@register("rfm_score_streamer")
def q_rfm_score_streamer(t: Tables):
    """guarded global min-max scale to 1..5."""
    return S.scale_global(S.combine_scores(S.rfm_ranks(S.streamer_values(_s_base(t)), S.STREAMER_KEYS)))


@register("weighted_score_streamer")
def q_weighted_score_streamer(t: Tables):
    """the scaled score times the streamer weight (default 1)."""
    return S.streamer_scores(_s_base(t), t.streamer_weight)


@register("rank_percentage_country")
def q_rank_percentage_country(t: Tables):
    """Rank inside the streamer country and rank / max rank."""
    d = S.country_level(S.streamer_scores(_s_base(t), t.streamer_weight))
    return d.select("streamer_id", *S.STREAMER_COUNTRY, "rfm_score", "rfm_rnk",
                    "rfm_rnk_percentage")


@register("streamer_level")
def q_streamer_level(t: Tables):
    """level 1-3 from the rank percentage."""
    d = S.country_level(S.streamer_scores(_s_base(t), t.streamer_weight))
    return d.select("streamer_id", *S.STREAMER_COUNTRY, "rfm_rnk_percentage", "level")


@register("serve_streamer_level")
def q_serve_streamer_level(t: Tables):
    """The narrow serving table of the same day's levels."""
    return S.serve_level(S.streamer_level(t.calls, t.country_region, t.streamer_weight, RUN_DATE))


def _level_distribution(t: Tables):
    return S.level_distribution(
        S.streamer_level(t.calls, t.country_region, t.streamer_weight, RUN_DATE))


@register("level_distribution")
def q_level_distribution(t: Tables):
    """Distinct streamers per level over the country total."""
    return _level_distribution(t)


@register("job_level_distribution")
def q_job_level_distribution(t: Tables):
    """Level mix job (same output as the operator key)."""
    return _level_distribution(t)


@register("vip_recode")
def q_vip_recode(t: Tables):
    """Vip level -> flag -> vip class -> flag."""
    from ..functions.columns import flag_from_if_vip, if_vip_from_flag, vip_flag
    u = t.user_info.select("user_id", "vip_level")
    u = u.withColumn("is_user_vip", vip_flag("vip_level"))
    u = u.withColumn("if_vip", if_vip_from_flag("is_user_vip"))
    return u.withColumn("flag_back", flag_from_if_vip("if_vip"))


@register("dim_country_dedup")
def q_dim_country_dedup(t: Tables):
    """A4: country dimension de-duplicated on (name, region)."""
    from ..operators.joins import dedup
    return dedup(t.country_region, ["country_name_en", "region_name"])


@register("lookup_region")
def q_lookup_region(t: Tables):
    """Left lookup of the region (and name) by country abbreviation."""
    from ..operators.joins import lookup
    d = t.streamer_country
    return lookup(d, t.country_region, "country_name_ab", "country_ab",
                  {"country_name_en": "country_name", "region_name": "region_name"})


# ---- user stage ----------------------------------------------------------------
from . import user as U  # noqa: E402


@register("rfm_values_user")
def q_rfm_values_user(t: Tables):
    """Four RFM terms per user (total-score job)."""
    return U.total_values(U.user_call_base(t.calls, RUN_DATE))


@register("global_rank_user")
def q_global_rank_user(t: Tables):
    """Global ranks of the four user terms."""
    return U.total_ranks(U.total_values(U.user_call_base(t.calls, RUN_DATE)))


@register("rfm_combine_user")
def q_rfm_combine_user(t: Tables):
    """blend over ranks (Q2)."""
    return U.combine_ranks(U.total_ranks(U.total_values(U.user_call_base(t.calls, RUN_DATE))))


@register("rfm_score_user")
def q_rfm_score_user(t: Tables):
    """F3 + J3: user total score on 1..5 with region."""
    return U.total_score(t.calls, t.country_region, RUN_DATE)


@register("quintile_score_user")
def q_quintile_score_user(t: Tables):
    """Quintile scores per term and their blend."""
    return U.quintile_scores(U.user_call_base(t.calls, RUN_DATE))


@register("user_level_country")
def q_user_level_country(t: Tables):
    """Level 1-3 inside region-country."""
    d = U.region_levels(U.total_score(t.calls, t.country_region, RUN_DATE))
    return d.select("user_id", *U.USER_COUNTRY, "user_region_name", "is_user_vip",
                    "rfm_score", "rfm_rnk", "rfm_rnk_percentage", "level")


@register("user_level_region")
def q_user_level_region(t: Tables):
    """level 1-5 inside region."""
    d = U.region_levels(U.total_score(t.calls, t.country_region, RUN_DATE))
    return d.select("user_id", "user_region_name", "is_user_vip", "rfm_score",
                    "region_rfm_rnk", "region_rfm_rnk_percentage", "region_level")


@register("rank_percentage_region")
def q_rank_percentage_region(t: Tables):
    """Rank inside the region over the region's max rank (6 digits)."""
    d = U.region_levels(U.total_score(t.calls, t.country_region, RUN_DATE))
    return d.select("user_id", "user_region_name", "is_user_vip", "region_rfm_rnk",
                    "region_rfm_rnk_percentage")


@register("job_user_level")
def q_job_user_level(t: Tables):
    """Total score -> levels per region-country and per region."""
    return U.user_level(t.calls, t.country_region, RUN_DATE)


# ---- preference stage (country and region grains) ------------------------------
from . import preference as P  # noqa: E402


def _pref_inputs(t: Tables):
    from ..session import cut_lineage
    return _memo(t, "base", lambda: cut_lineage(
        S.streamer_call_base(t.calls, t.country_region, RUN_DATE)))


def _streamer_levels(t: Tables):
    return _memo(t, "streamer_levels", lambda: S.country_level(
        S.streamer_scores(_pref_inputs(t), t.streamer_weight)))


def _user_quintile_levels(t: Tables):
    return _memo(t, "quintile_levels", lambda: U.quintile_level(t.calls, RUN_DATE))


def _user_region_levels(t: Tables):
    return _memo(t, "region_levels", lambda: U.region_levels(
        U.total_score(t.calls, t.country_region, RUN_DATE)))


def _country_selected(t: Tables, base):
    return P.select_band(base, _user_quintile_levels(t), _streamer_levels(t))


def _region_selected(t: Tables, base):
    lv = _user_region_levels(t).select(
        "user_id", "user_region_name", "is_user_vip",
        F.col("region_rfm_rnk_percentage").alias("rfm_rnk_percentage"))
    return P.label_band(base, lv)


def _chain(t: Tables, grain: str):
    def build():
        base = _pref_inputs(t)
        if grain == "country":
            return P.preference_chain(base, _country_selected(t, base), P.COUNTRY)
        return P.preference_chain(base, _region_selected(t, base), P.REGION)
    return _memo(t, "chain_" + grain, build)


@register("mid_band_pairs_country")
def q_mid_band_pairs_country(t: Tables):
    """Call-base rows whose user and streamer are in the 0.1-0.6 band."""
    base = _pref_inputs(t)
    return _country_selected(t, base)


@register("mid_band_pairs_region")
def q_mid_band_pairs_region(t: Tables):
    """Call-base rows labelled with the band region (NULL outside)."""
    base = _pref_inputs(t)
    return _region_selected(t, base)


@register("rfm_values_country")
def q_rfm_values_country(t: Tables):
    """RFM values per (user country, vip, streamer country)."""
    return _chain(t, "country")["values"]


@register("rfm_values_region")
def q_rfm_values_region(t: Tables):
    """RFM values per (user region, vip, streamer country)."""
    return _chain(t, "region")["values"]


_PAIR_RANK_COLS = ["frequency_rnk", "frequency_score", "monetary_rnk", "monetary_score",
                   "monetary1_rnk", "monetary1_score", "recency_rnk", "recency_score"]


@register("group_rank_country")
def q_group_rank_country(t: Tables):
    """RFM ranks and scores inside the vip class (country pairs)."""
    s = _chain(t, "country")["scores"]
    return s.select(*P.COUNTRY.pair, *_PAIR_RANK_COLS)


@register("group_rank_region")
def q_group_rank_region(t: Tables):
    """RFM ranks and scores inside the vip class (region pairs)."""
    s = _chain(t, "region")["scores"]
    return s.select(*P.REGION.pair, *_PAIR_RANK_COLS)


@register("minmax_group")
def q_minmax_group(t: Tables):
    """Min / max of the pair blend per user country."""
    s = _chain(t, "country")["scores"]
    return s.groupBy("user_country_name").agg(
        F.max("rfm_combination_score").alias("rfm_combination_score_max"),
        F.min("rfm_combination_score").alias("rfm_combination_score_min"))


@register("preference_country")
def q_preference_country(t: Tables):
    """unguarded 1-5 scale per user country (NULL when max = min)."""
    s = _chain(t, "country")["scores"]
    return s.select(*P.COUNTRY.pair, "rfm_combination_score", "rfm_score")


@register("preference_region")
def q_preference_region(t: Tables):
    """unguarded 1-5 scale per vip class (region pairs)."""
    s = _chain(t, "region")["scores"]
    return s.select(*P.REGION.pair, "rfm_combination_score", "rfm_score")


@register("pair_rank_country")
def q_pair_rank_country(t: Tables):
    """Global pair rank, percentage of the vip class's max rank."""
    p = _chain(t, "country")["preference"]
    return p.select(*P.COUNTRY.pair, "rfm_combination_score", "rfm_rnk", "rfm_rnk_percentage",
                    "preference")


@register("pair_rank_region")
def q_pair_rank_region(t: Tables):
    """Global pair rank (region pairs)."""
    p = _chain(t, "region")["preference"]
    return p.select(*P.REGION.pair, "rfm_combination_score", "rfm_rnk", "rfm_rnk_percentage",
                    "preference")


@register("pair_grid_country")
def q_pair_grid_country(t: Tables):
    """(user country, vip) x streamer country."""
    return _chain(t, "country")["grid"]


@register("pair_grid_region")
def q_pair_grid_region(t: Tables):
    """(user region, vip) x streamer country."""
    return _chain(t, "region")["grid"]


@register("grid_fill_country")
def q_grid_fill_country(t: Tables):
    """Grid with preference, default 0.5."""
    return _chain(t, "country")["filled"]


@register("grid_fill_region")
def q_grid_fill_region(t: Tables):
    """Grid with preference, default 0.5 (region)."""
    return _chain(t, "region")["filled"]


@register("share_country")
def q_share_country(t: Tables):
    """preference share per (user country, vip)."""
    return _chain(t, "country")["distribution"]


@register("share_region")
def q_share_region(t: Tables):
    """preference share per (user region, vip)."""
    return _chain(t, "region")["distribution"]


@register("job_country_preference")
def q_job_country_preference(t: Tables):
    """Band -> pair RFM -> preference -> grid -> shares (country)."""
    return _chain(t, "country")["distribution"]


@register("job_region_preference")
def q_job_region_preference(t: Tables):
    """Band label -> pair RFM -> preference -> grid -> shares (region)."""
    return _chain(t, "region")["distribution"]


@register("recall_by_level")
def q_recall_by_level(t: Tables):
    """Pair share x streamer level share, one row per level."""
    dist = _chain(t, "country")["distribution"]
    mix = S.level_distribution(_streamer_levels(t))
    return P.recall_by_level(dist, mix)


# ---- recall stage (country and region grains) -------------------------------------
from ..sources.fixtures import REGION_GOLD_THRESHOLD, ROW_GOLD_THRESHOLD  # noqa: E402
from . import recall as R  # noqa: E402


def _grain(name: str):
    return R.COUNTRY if name == "country" else R.REGION


def _activity(t: Tables, grain: str):
    return R.activity(t.country_preference_pre, t.country_region, _grain(grain))


def _behaviour(t: Tables, grain: str):
    return _memo(t, "behaviour_" + grain,
                 lambda: R.behaviour(_activity(t, grain), _grain(grain)))


def _integration(t: Tables, grain: str):
    from ..session import cut_lineage
    return _memo(t, "integration_" + grain, lambda: cut_lineage(R.integrate(
        _chain(t, grain)["preference"], _behaviour(t, grain), _grain(grain))))


def _allow(t: Tables, grain: str, summed: bool = False):
    g = _grain(grain)
    if summed:
        return R.allow_pairs_sum(t.country_preference_pre, t.country_region, g,
                                 REGION_GOLD_THRESHOLD)
    return R.allow_pairs_row(t.country_preference_pre, t.country_region, g, ROW_GOLD_THRESHOLD)


def _dist(t: Tables, grain: str):
    g = _grain(grain)

    def build():
        grid = R.blended_grid(_pref_inputs(t), _integration(t, grain), t.country_region, g)
        return R.grid_shares(grid, t.country_region, g)
    return _memo(t, "dist_" + grain, build)


@register("activity_score_country")
def q_activity_score_country(t: Tables):
    """Success rates and raw activity score per country pair."""
    return _activity(t, "country")


@register("activity_region")
def q_activity_region(t: Tables):
    """Activity counters rolled up to the user's region."""
    return R.activity_region_rollup(t.country_preference_pre)


@register("activity_score_region")
def q_activity_score_region(t: Tables):
    """F16 / F17 on the region roll-up."""
    return _activity(t, "region")


_BEHAV_COLS = ["if_vip", "streamer_country_name", "streamer_country_name_ab", "raw_score",
               "hotvideo_rnk", "hotvideo_combination_score", "hotvideo_rank_score_norm",
               "hotvideo_score"]


@register("behaviour_score_country")
def q_behaviour_score_country(t: Tables):
    """Behaviour rank and raw-score based 1-5 score (country)."""
    return _behaviour(t, "country").select("user_country_name", "user_country_name_ab", *_BEHAV_COLS,
                                           "hotvideo_raw_score_norm")


@register("behaviour_score_region")
def q_behaviour_score_region(t: Tables):
    """Behaviour rank and rank based 1-5 score (region)."""
    return _behaviour(t, "region").select("user_region_name", *_BEHAV_COLS)


@register("blend_country")
def q_blend_country(t: Tables):
    """RFM preference blended with the behaviour score (country)."""
    return _integration(t, "country").select(*R.integration_cols(R.COUNTRY))


@register("blend_region")
def q_blend_region(t: Tables):
    """RFM preference blended with the behaviour score (region)."""
    return _integration(t, "region").select(*R.integration_cols(R.REGION))


@register("allow_pairs_country")
def q_allow_pairs_country(t: Tables):
    """Pairs with a source row of enough coins (country)."""
    return _allow(t, "country")


@register("allow_pairs_region")
def q_allow_pairs_region(t: Tables):
    """Pairs whose region coin sum reaches the threshold."""
    return _allow(t, "region", summed=True)


@register("allow_filter_country")
def q_allow_filter_country(t: Tables):
    """Allow-listed integrated pairs, counters zero-filled."""
    return R.allow_filter(_integration(t, "country"), _allow(t, "country"), R.COUNTRY)


@register("allow_filter_region")
def q_allow_filter_region(t: Tables):
    """Allow-listed integrated region pairs (row threshold)."""
    return R.allow_filter(_integration(t, "region"), _allow(t, "region"), R.REGION)


@register("share_country_rule")
def q_share_country_rule(t: Tables):
    """Blended and rule preference shares on the full grid."""
    return _dist(t, "country")


@register("share_region_blend")
def q_share_region_blend(t: Tables):
    """blended preference shares on the full region grid."""
    return _dist(t, "region")


def _top(t: Tables, grain: str, by: str = "preference", summed: bool = False):
    return R.recall_top(_dist(t, grain), _allow(t, grain, summed), _grain(grain), by)


@register("top3_country")
def q_top3_country(t: Tables):
    """Three best allow-listed streamer countries per (country, vip)."""
    return _top(t, "country").drop("percentage")


@register("top3_country_rule")
def q_top3_country_rule(t: Tables):
    """Three best by the rule preference."""
    return _top(t, "country", "preference_rule").drop("percentage")


@register("top3_region")
def q_top3_region(t: Tables):
    """Three best allow-listed streamer countries per (region, vip)."""
    return _top(t, "region", summed=True).drop("percentage")


@register("recall_share_country")
def q_recall_share_country(t: Tables):
    """shares renormalised inside the top 3 (country)."""
    return _top(t, "country")


@register("recall_share_country_rule")
def q_recall_share_country_rule(t: Tables):
    """rule-preference shares inside the rule top 3."""
    return _top(t, "country", "preference_rule")


@register("recall_share_region")
def q_recall_share_region(t: Tables):
    """shares renormalised inside the top 3 (region)."""
    return _top(t, "region", summed=True)


@register("job_country_recall")
def q_job_country_recall(t: Tables):
    """Activity -> behaviour -> blend -> grid -> allow-list -> top 3 shares (country)."""
    return _top(t, "country")


@register("job_region_recall")
def q_job_region_recall(t: Tables):
    """Activity -> behaviour -> blend -> grid -> allow-list -> top 3 shares (region)."""
    return _top(t, "region", summed=True)


# ---- sinks -------------------------------------------------------------------------
from ..sources import sinks as K  # noqa: E402


@register("write_then_read_day")
def q_write_then_read_day(t: Tables):
    """Write the serving table as day RUN_DATE (twice: idempotent),
    read the day back."""
    spark = t.spark
    path = K.table_path(spark, "streamer_level_" + _tag(t))
    serve = S.serve_level(S.streamer_level(t.calls, t.country_region, t.streamer_weight, RUN_DATE))
    schema = K.table_schema("streamer_level")
    K.write_day(serve, path, RUN_DATE, "dt", schema)
    K.write_day(serve, path, RUN_DATE, "dt", schema)
    return K.read_days(spark, path, [RUN_DATE], "dt", schema)


@register("conform_schema")
def q_conform_schema(t: Tables):
    """The weighted streamer score cast to its declared schema
    (string ids, coin and length sums truncated to BIGINT)."""
    d = S.streamer_scores(_s_base(t), t.streamer_weight)
    return K.conform(d, K.table_schema("streamer_rfm_score"))


@register("backfill_match")
def q_backfill_match(t: Tables):
    """The match table for days end-26 .. end-1 written by ONE job with
    dynamic partition overwrite (no driver loop), then read back."""
    spark = t.spark
    path = K.table_path(spark, "call_match_backfill_" + _tag(t))
    d = CF.backfill_rows(t.calls, t.streamer_country, WINDOW_END, 26, 1)
    days = CF.day_list(WINDOW_END, 26, 1)
    K.write_days(d, path, "day", K.table_schema("call_match"), days)
    return K.read_days(spark, path, days, "day", K.table_schema("call_match"))


@register("write_empty_day")
def q_write_empty_day(t: Tables):
    """Three days of matches are written, then the last one is
    rewritten without rows; its rows are gone, the other days stay."""
    path = K.table_path(t.spark, "call_match_empty_day_" + _tag(t))
    schema = K.table_schema("call_match")
    days = CF.day_list(WINDOW_END, 3, 1)
    d = CF.backfill_rows(t.calls, t.streamer_country, WINDOW_END, 3, 1)
    K.write_days(d, path, "day", schema, days)
    K.write_day(d.limit(0).drop("day"), path, days[-1], "day", schema)
    return K.read_days(t.spark, path, days, "day", schema)


def _tag(t: Tables) -> str:
    import hashlib
    return hashlib.md5(t.sf_dir.encode()).hexdigest()[:10]


# ---- streaming -------------------------------------------------------------------
@register("request_match_stream")
def q_request_match_stream(t: Tables):
    """J1 as a stream-stream join over the events as they arrive
    (file stream source, availableNow trigger); same rows as the batch join."""
    from ..sources.fixtures import request_record_from, video_record_from
    from ..streaming.request_match import match_stream, run_available
    spark = t.spark
    import uuid
    run = K.table_path(spark, f"request_match_stream_{_tag(t)}_{uuid.uuid4().hex[:8]}")
    schema = t.raw("events").schema
    ev = spark.readStream.schema(schema).parquet(f"{t.sf_dir}/events*.parquet")
    s = match_stream(request_record_from(ev), video_record_from(ev), FIXTURE_GAP_S)
    return run_available(spark, s, run + "/out", run + "/checkpoint")
