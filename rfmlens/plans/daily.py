"""One application per run date: every output table of the reference's five
stages, computed once and written as a day partition.

The reference runs ~30 spark-submit applications per day that pass data
through Hive partitions and recompute shared views; here the shared
intermediates (call base, entity scores and levels, pair preferences,
behaviour scores) are built once and written to the shared folder, so that
every later plan starts from a file scan.  Branches that do not need each
other (streamers, user quintiles, user totals; then the country and the region
chain) are built at the same time, and so are the tables written: at day grain
most jobs are too small to fill a cluster one by one.

``DayRun`` governs the whole run.  Nothing after its ``day`` is read, so a
rerun of a past day ignores later calls.  Each write is idempotent; the six
two-table publishes (A9) appear as one commit each (``sources.publish``).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import decimals_to_double
from ..session import cut_lineage
from ..sources import sinks as K
from ..sources.fixtures import (CALL_DAY, FIXTURE_GAP_S, REGION_GOLD_THRESHOLD, ROW_GOLD_THRESHOLD,
                                RUN_DATE, WINDOW_END, Tables)
from ..sources.publish import publish
from ..sources.schemas import DAY_SCHEMAS
from . import call_facts as CF
from . import preference as P
from . import recall as R
from . import streamer as S
from . import user as U
from . import windowed as W
from .call_facts import day_list


@dataclass(frozen=True)
class DayRun:
    """What one run is about; the defaults are the reference's values."""
    day: str                          # last day of every window, and the partition written
    run_date: str                     # recency is counted to this day (Q14: one date, two offsets)
    call_day: str | None = None       # last day of the call-detail window (default: ``day``)
    gap_s: int = CF.GAP_S             # request-to-call match
    row_gold: int = 50_000            # allow-list, coins of a source row
    region_gold: int = 50_000         # allow-list, coins of a region
    base_days: int | None = 30        # call base (None: all days up to ``day``)
    user_days: int | None = W.USER_DAYS       # user quintiles (None: as the call base)
    active_days: int = W.ACTIVE_DAYS
    match_days: int = W.MATCH_DAYS
    streamer_offset: int = 0          # days after ``run_date`` to which a streamer's recency counts
    user_offset: int = 1              # and a user's

    def recency(self, offset: int) -> str:
        return day_list(self.run_date, -offset, -offset)[0]


#: The fixtures' run (FIXTURES.md): the whole fact table is the call base's window.
FIXTURE_RUN = DayRun(WINDOW_END, RUN_DATE, CALL_DAY, FIXTURE_GAP_S, ROW_GOLD_THRESHOLD,
                     REGION_GOLD_THRESHOLD, base_days=None, user_offset=0)

# Wide table -> serving tables and their columns.
PREFERENCE_SERVED = ["streamer_country_id", "streamer_country_name", "rfm_rnk", "preference"]
PUBLISHED: dict[str, dict[str, list[str]]] = {
    "streamer_level_detail": {
        "streamer_level": ["streamer_id", "streamer_country_id", "streamer_country_name", "level", "rfm_score"]},
    "country_user_level_detail": {
        "country_user_level": ["user_id", "user_country_id", "user_country_name", "is_user_vip", "level"]},
    "region_country_user_level_detail": {
        "region_country_user_level": ["user_id", "user_country_id", "user_country_name", "user_region_name",
                                      "is_user_vip", "rfm_rnk_percentage", "level"]},
    "region_user_level_detail": {
        "region_user_level": ["user_id", "user_region_name", "is_user_vip", "rfm_rnk_percentage", "level"]},
    "country_preference_detail": {"country_preference": [*P.COUNTRY.group, *PREFERENCE_SERVED]},
    "region_preference_detail": {"region_preference": [*P.REGION.group, *PREFERENCE_SERVED]},
}


def at_once(**work: Callable):
    """Run independent branches in parallel; name -> result."""
    with ThreadPoolExecutor(max(1, len(work))) as pool:
        jobs = {n: pool.submit(f) for n, f in work.items()}
        return {n: j.result() for n, j in jobs.items()}


def _facts(t: Tables, run: DayRun) -> DataFrame:
    """The call facts of the run's base window; never a later day."""
    calls = t.calls.where(F.col("day") <= F.to_date(F.lit(run.day)))
    return calls if run.base_days is None else CF.window_filter(calls, "day", run.day, run.base_days)


def _streamers(t: Tables, run: DayRun, base: DataFrame) -> dict[str, DataFrame]:
    scores = S.streamer_scores(base, t.streamer_weight)
    level = cut_lineage(S.country_level(scores))
    return {"streamer_rfm_score": scores, "streamer_level_detail": level.select(*S.LEVEL_DETAIL_COLS),
            "streamer_level_distribution": cut_lineage(S.level_distribution(level))}


def _active(t: Tables, run: DayRun, store: W.DayStore) -> dict[str, DataFrame]:
    streamers = cut_lineage(W.active_streamers(store, run.day, t.country_region, run.active_days))
    return {"country_streamer_amount": streamers,
            "region_streamer_amount": S.active_streamers_region(streamers),
            "country_user_amount_vip": W.active_users(store, run.day, True, run.active_days),
            "country_user_amount": W.active_users(store, run.day, False, run.active_days)}


def _quintiles(t: Tables, run: DayRun, store: W.DayStore) -> dict[str, DataFrame]:
    date = run.recency(run.user_offset)
    base = (U.user_call_base(_facts(t, run), date) if run.user_days is None else
            W.window_base(store, run.day, run.user_days, date, W.USER_BASE_KEYS))
    base = cut_lineage(base)
    score = U.quintile_scores(base)
    return {"user_call_base": base, "user_quintile_score": score,
            "country_user_level_detail": cut_lineage(U.quintile_level_from(score))}


def _totals(t: Tables, run: DayRun) -> dict[str, DataFrame]:
    total = cut_lineage(U.total_score(_facts(t, run), t.country_region, run.recency(run.user_offset)))
    levels = cut_lineage(U.region_levels(total))
    return {"user_rfm_total_score": total, "levels": levels,
            "region_country_user_level_detail": levels.select(
                "user_id", *U.USER_COUNTRY, "user_region_name", "is_user_vip", "frequency", "monetary1", "monetary2",
                "recency", "rfm_score", "rfm_rnk", "rfm_rnk_percentage", "level"),
            "region_user_level_detail": levels.select(
                "user_id", "user_region_name", "is_user_vip", "frequency", "monetary1", "monetary2", "recency",
                "rfm_score", F.col("region_rfm_rnk").alias("rfm_rnk"),
                F.col("region_rfm_rnk_percentage").alias("rfm_rnk_percentage"),
                F.col("region_level").alias("level"))}


def _preference(base: DataFrame, selected: DataFrame, g: P.Grain) -> dict[str, DataFrame]:
    ch = P.preference_chain(base, selected, g)
    detail = cut_lineage(ch["preference"])
    return {f"{g.name}_band_calls": selected, f"{g.name}_pair_score": ch["scores"],
            f"{g.name}_preference_detail": detail, f"{g.name}_preference_all": ch["filled"],
            f"{g.name}_preference_distribution": ch["distribution"]}


def _recall(t: Tables, run: DayRun, base: DataFrame, detail: DataFrame, g: R.RecallGrain) -> dict[str, DataFrame]:
    pre, n = t.country_preference_pre, g.name
    act = cut_lineage(R.activity(pre, t.country_region, g))
    behav = cut_lineage(R.behaviour(act, g))
    integ = cut_lineage(R.integrate(detail, behav, g))
    allow = R.allow_pairs_row(pre, t.country_region, g, run.row_gold)
    grid = cut_lineage(R.blended_grid(base, integ, t.country_region, g))
    dist = cut_lineage(R.grid_shares(grid, t.country_region, g))
    top = allow if g is R.COUNTRY else R.allow_pairs_sum(pre, t.country_region, g, run.region_gold)
    out = {f"{n}_activity_detail": act, f"{n}_behaviour_score": behav, f"{n}_score_integration_detail": integ,
           f"{n}_score_integration": integ.select(*R.integration_cols(g)),
           f"{n}_score_integration_filtering": R.allow_filter(integ, allow, g),
           f"{n}_preference_all_blend": grid, f"{n}_preference_distribution_blend": dist,
           f"{n}_recall_filtering": R.recall_filtered(dist, top, g),
           f"{n}_recall_percentage": R.recall_top(dist, top, g)}
    if g is R.COUNTRY:
        out[f"{n}_recall_filtering_rule"] = R.recall_filtered(dist, top, g, "preference_rule")
        out[f"{n}_recall_percentage_rule"] = R.recall_top(dist, top, g, "preference_rule")
    return out


def build_day(t: Tables, run: DayRun = FIXTURE_RUN, root: str | None = None) -> dict[str, DataFrame]:
    """All output tables of one day.  Starts jobs: shared intermediates are
    written as they are built, and the day tables of the windows below ``root``."""
    root = root or K.table_path(t.spark, "daily")
    store = W.DayStore(t.spark, root)
    call_day = run.call_day or run.day
    call_days = W.window_days(call_day, run.match_days)
    t.country_preference_pre          # shared by both recall branches

    def calls() -> dict[str, DataFrame]:
        detail = CF.call_detail(t.request_record, t.video_record, t.minute_gold, t.goddess_gold,
                                t.gift_detail, t.user_info, run.gap_s)
        path = store.path("call_record_detail")
        CF.detail_days(detail, path, call_days)
        match = CF.match_from_detail(CF.read_detail(t.spark, path, call_days), t.streamer_country, t.country_region)
        return {"call_record_detail_match": match}

    first = at_once(
        calls=calls,
        base=lambda: cut_lineage(S.streamer_call_base(
            _facts(t, run), t.country_region, run.recency(run.streamer_offset))),
        store=lambda: store.refresh(t.calls, W.window_days(run.day, max(run.user_days or 1, run.active_days))),
        totals=lambda: _totals(t, run))
    base, totals = first["base"], first["totals"]
    second = at_once(streamers=lambda: _streamers(t, run, base), active=lambda: _active(t, run, store),
                     quintiles=lambda: _quintiles(t, run, store))
    out = {"streamer_call_base": base, **first["calls"], **second["streamers"], **second["active"],
           **second["quintiles"]}
    levels = totals.pop("levels")
    out |= totals
    in_country = P.select_band(base, out["country_user_level_detail"], out["streamer_level_detail"])
    in_region = P.label_band(base, levels.select(
        "user_id", "user_region_name", "is_user_vip", F.col("region_rfm_rnk_percentage").alias("rfm_rnk_percentage")))

    def chain(selected: DataFrame, g: P.Grain, rg: R.RecallGrain) -> dict[str, DataFrame]:
        pref = _preference(base, cut_lineage(selected), g)
        return pref | _recall(t, run, base, pref[f"{g.name}_preference_detail"], rg)

    third = at_once(country=lambda: chain(in_country, P.COUNTRY, R.COUNTRY),
                    region=lambda: chain(in_region, P.REGION, R.REGION))
    out |= third["country"] | third["region"]
    shares = out["country_preference_distribution"]
    out["country_recall_share"] = shares.drop("preference")
    out["country_recall_by_level"] = P.recall_by_level(shares, out["streamer_level_distribution"])
    return out


def run_day(spark: SparkSession, sf_dir: str, run: DayRun = FIXTURE_RUN, out_root: str | None = None,
            tables: list[str] | None = None, writers: int = 8) -> dict[str, float]:
    """Build and write every table of the day under ``out_root`` (default: the
    table root), as partition ``dt = run.day``; returns seconds per table.
    Published tables are read with ``sources.publish.read_published``, the
    others with ``sources.sinks.read_days``."""
    t = Tables(spark, sf_dir)
    root = out_root or K.table_path(spark, "daily")

    def write(name: str, df: DataFrame) -> dict[str, float]:
        t0 = time.perf_counter()
        served = PUBLISHED.get(name)
        if served is not None:
            publish(root, run.day, decimals_to_double(df), served, name, DAY_SCHEMAS)
        else:
            K.write_day(decimals_to_double(df), f"{root}/{name}", run.day, schema=DAY_SCHEMAS.get(name))
        spent = round(time.perf_counter() - t0, 3)
        return {n: spent for n in [name, *(served or {})]}

    out = {n: df for n, df in build_day(t, run, root).items() if not tables or n in tables}
    with ThreadPoolExecutor(writers) as pool:
        done = [pool.submit(write, n, df) for n, df in out.items()]
        times: dict[str, float] = {}
        for job in done:
            times |= job.result()
    return times
