"""Layer 2: invariants of the outputs on the sf0.001 tables."""
from pyspark.sql import functions as F

from rfmlens.plans import preference as P
from rfmlens.plans import recall as R
from rfmlens.plans import streamer as S
from rfmlens.plans import user as U
from rfmlens.sources.fixtures import RUN_DATE


def test_global_ranks_are_permutations_and_scores_reverse(t001):
    base = S.streamer_call_base(t001.calls, t001.country_region, RUN_DATE)
    d = S.rfm_ranks(S.streamer_values(base), "streamer_id")
    n = d.count()
    for m in ("frequency", "monetary", "monetary1", "recency"):
        row = d.agg(F.min(f"{m}_rnk"), F.max(f"{m}_rnk"), F.count_distinct(f"{m}_rnk")).first()
        assert tuple(row) == (1, n, n)
        assert d.filter(F.col(f"{m}_score") != n + 1 - F.col(f"{m}_rnk")).count() == 0


def test_scaled_score_within_1_5_with_both_ends(t001):
    base = S.streamer_call_base(t001.calls, t001.country_region, RUN_DATE)
    d = S.streamer_scores(base, None)
    lo, hi = d.agg(F.min("rfm_score"), F.max("rfm_score")).first()
    assert (lo, hi) == (1.0, 5.0)


def test_levels_in_range(t001):
    lv = S.streamer_level(t001.calls, t001.country_region, t001.streamer_weight, RUN_DATE)
    assert {r[0] for r in lv.select("level").distinct().collect()} <= {1, 2, 3}
    ul = U.user_level(t001.calls, t001.country_region, RUN_DATE)
    assert {r[0] for r in ul.select("region_level").distinct().collect()} <= {1, 2, 3, 4, 5}
    assert {r[0] for r in ul.select("level").distinct().collect()} <= {1, 2, 3}


def test_grid_size_and_shares_sum_to_one(t001):
    base = S.streamer_call_base(t001.calls, t001.country_region, RUN_DATE)
    users = U.quintile_level(t001.calls, RUN_DATE)
    streamers = S.country_level(S.streamer_scores(base, t001.streamer_weight))
    ch = P.preference_chain(base, P.select_band(base, users, streamers), P.COUNTRY)
    n_left = base.select(*P.COUNTRY.group).distinct().count()
    n_right = base.select(*P.STREAMER_COUNTRY).distinct().count()
    assert ch["grid"].count() == n_left * n_right
    sums = ch["distribution"].groupBy(*P.COUNTRY.group).agg(F.sum("percentage").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-3).count() == 0


def test_top3_at_most_three_and_shares(t01):
    from rfmlens.sources.fixtures import ROW_GOLD_THRESHOLD
    import __spark_entry__ as E
    top = E.queries()["recall_share_country"](t01.spark, t01.sf_dir)
    per = top.groupBy("user_country_name", "is_user_vip").agg(
        F.count(F.lit(1)).alias("n"), F.sum("percentage").alias("s"))
    assert per.filter(F.col("n") > 3).count() == 0
    assert per.filter(F.abs(F.col("s") - 1) > 2e-3).count() == 0
    assert ROW_GOLD_THRESHOLD > 0
    assert R.TOP_K == 3
