"""SQL of the windowed keys, versioned profiles and second outputs (see ``rfmlens.oracle``)."""

from __future__ import annotations

from .oracle import RUN_DATE, WINDOW_END, lvl3, query, rnd, view
from .oracle_stages import UQ

CALL_DAY = "2024-01-30"
SNAPSHOT_DAY = "2000-06-30"


def window(days: int, end: str = WINDOW_END, col: str = "day") -> str:
    return f"{col} > DATE '{end}' - INTERVAL {days} DAY AND {col} <= DATE '{end}'"


# ---- A2 / G5 / G6 -----------------------------------------------------------
view("v_calls_w2", f"SELECT * FROM v_calls WHERE {window(2)}")
view("v_calls_w30", f"SELECT * FROM v_calls WHERE {window(30)}")

query("call_base_window", f"""
SELECT user_id, user_country_id, user_country_name, CASE WHEN vip_level = 'free' THEN '0' ELSE '1' END AS is_user_vip,
       streamer_id, streamer_country_id, streamer_country_name, streamer_country_name_ab, COUNT(*) AS frequency,
       CAST(SUM(call_total_length) AS DOUBLE) AS call_total_length,
       CAST(SUM(CAST(0.6 AS DECIMAL(4,2)) * call_gold_coin_amount
                + CAST(0.4 AS DECIMAL(4,2)) * gift_gold_coin_amount) AS DOUBLE) AS gold_coin_amount,
       MIN(date_diff('day', CAST(call_begin_time AS DATE), DATE '{RUN_DATE}')) AS recency_call_interval
FROM v_calls_w30 GROUP BY ALL""")

query("job_user_quintile_level", f"""SELECT {UQ}, rfm_rnk, rfm_rnk_percentage,
       {lvl3('rfm_rnk_percentage')} AS level FROM v_uq_level""")
query("quintile_level_all_days", f"""SELECT {UQ}, rfm_rnk, rfm_rnk_percentage,
       {lvl3('rfm_rnk_percentage')} AS level FROM v_uq_level""")

query("active_users_vip", """
SELECT user_country_id, user_country_name, is_user_vip, AVG(n) AS user_active_amount
FROM (SELECT day, user_country_id, user_country_name,
             CASE WHEN vip_level = 'free' THEN '0' ELSE '1' END AS is_user_vip, COUNT(DISTINCT user_id) AS n
      FROM v_calls GROUP BY ALL) t
GROUP BY user_country_id, user_country_name, is_user_vip""")
query("active_users", """
SELECT user_country_id, user_country_name, AVG(n) AS user_active_amount
FROM (SELECT day, user_country_id, user_country_name, COUNT(DISTINCT user_id) AS n
      FROM v_calls GROUP BY day, user_country_id, user_country_name) t
GROUP BY user_country_id, user_country_name""")
query("active_users_windows", "\nUNION ALL\n".join(f"""
SELECT CAST({n} AS BIGINT) AS window_days, user_country_id, user_country_name, COUNT(DISTINCT user_id) AS user_amount
FROM v_calls WHERE {window(n)} GROUP BY user_country_id, user_country_name""" for n in (2, 7, 30)))

ACTIVE_STREAMERS = """
SELECT a.streamer_country_id, c.country_name_en AS streamer_country_name,
       a.streamer_country_name_ab, c.region_name AS streamer_region_name, a.streamer_active_amount
FROM (SELECT streamer_country_id, streamer_country_name_ab, AVG(n) AS streamer_active_amount
      FROM (SELECT day, streamer_country_id, streamer_country_name_ab, COUNT(DISTINCT streamer_id) AS n
            FROM v_calls GROUP BY day, streamer_country_id, streamer_country_name_ab) t
      GROUP BY streamer_country_id, streamer_country_name_ab) a
LEFT JOIN (SELECT DISTINCT country_ab, country_name_en, region_name FROM v_country_region) c
  ON a.streamer_country_name_ab = c.country_ab"""
view("v_active_streamers", ACTIVE_STREAMERS)
query("active_streamers", "SELECT * FROM v_active_streamers")
query("job_active_counts", "SELECT * FROM v_active_streamers")
query("active_streamers_region", f"""
SELECT streamer_region_name AS region_name, {rnd('SUM(streamer_active_amount)', 6)} AS streamer_amount
FROM v_active_streamers GROUP BY streamer_region_name""")

# the second output of the job: the last two days
view("v_active_streamers_w2", ACTIVE_STREAMERS.replace("FROM v_calls ", "FROM v_calls_w2 "))
view("v_active_regions_w2", f"""
SELECT streamer_region_name AS region_name, {rnd('SUM(streamer_active_amount)', 6)} AS streamer_amount
FROM v_active_streamers_w2 GROUP BY streamer_region_name""")
query("job_active_counts_region", """
SELECT region_name, CAST(trunc(streamer_amount) AS BIGINT) AS streamer_amount FROM v_active_regions_w2""")

# ---- A3 -----------------------------------------------------------------------
view("v_user_history", """
SELECT user_id, country_id, country_name_en, vip_level, DATE '1995-01-01' AS dt FROM v_user_info
UNION ALL
SELECT CASE WHEN o.o_orderkey % 100 = 0 THEN -1 ELSE o.o_custkey END AS user_id,
       CAST(n.n_nationkey AS BIGINT) AS country_id, n.n_name AS country_name_en,
       CASE WHEN o.o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'free'
            WHEN o.o_orderpriority = '3-MEDIUM' THEN NULL ELSE lower(substr(o.o_orderpriority, 3)) END AS vip_level,
       CAST(o.o_orderdate AS DATE) AS dt
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON n.n_nationkey = (c.c_nationkey + CASE WHEN o.o_orderkey % 11 = 0 THEN 1 ELSE 0 END) % 25""")
NEWEST = "dt DESC, country_id DESC NULLS LAST, country_name_en DESC NULLS LAST, vip_level DESC NULLS LAST"
query("snapshot_users", f"""
SELECT DISTINCT user_id, country_id, country_name_en, vip_level FROM v_user_history
WHERE dt <= DATE '{SNAPSHOT_DAY}' AND user_id <> -1""")
query("snapshot_latest", f"""
SELECT user_id, dt, country_id, country_name_en, vip_level
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {NEWEST}) AS rn FROM v_user_history
      WHERE dt <= DATE '{SNAPSHOT_DAY}' AND user_id <> -1) WHERE rn = 1""")
query("enrich_as_of", f"""
SELECT c.day, c.user_id, c.streamer_id, c.room_id, CAST(c.channel_id AS BIGINT) AS channel_id,
       CAST(c.call_total_length AS DOUBLE) AS call_total_length, v.country_id, v.country_name_en, v.vip_level
FROM v_calls_w30 c LEFT JOIN (
  SELECT *, LEAD(dt) OVER (PARTITION BY user_id ORDER BY dt) AS until
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, dt ORDER BY {NEWEST}) AS rn FROM v_user_history)
  WHERE rn = 1) v
ON c.user_id = v.user_id AND v.dt <= c.day AND (v.until IS NULL OR c.day < v.until)""")

# ---- D0 -> D1 -------------------------------------------------------------------
view("v_detail_match", """
SELECT strftime(CAST(d.call_begin_time AS DATE), '%Y-%m-%d') AS day, CAST(d.user_id AS VARCHAR) AS user_id,
       CAST(d.user_country_id AS VARCHAR) AS user_country_id, d.user_country_name, d.is_user_vip,
       CAST(d.streamer_id AS VARCHAR) AS streamer_id, CAST(cr.country_id AS VARCHAR) AS streamer_country_id,
       s.country_name_ab AS streamer_country_name, d.channel_id, d.channel_name, d.call_begin_time, d.call_end_time,
       CAST(d.call_total_length AS DOUBLE) AS call_total_length, d.call_gold_coin_amount, d.gift_gold_coin_amount
FROM v_call_detail d
JOIN (SELECT DISTINCT user_id, country_name_ab FROM v_streamer_country) s ON d.streamer_id = s.user_id
LEFT JOIN (SELECT DISTINCT country_ab, country_id FROM v_country_region) cr ON s.country_name_ab = cr.country_ab""")
query("job_call_match", f"SELECT * FROM v_detail_match WHERE {window(30, CALL_DAY, 'CAST(day AS DATE)')}")
query("call_match_asked_days", """SELECT * FROM v_detail_match WHERE day IN (
  SELECT strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'purchase' AND value > 200)""")

query("backfill_range", f"""
SELECT strftime(day, '%Y-%m-%d') AS day, COUNT(*) AS calls, COUNT(DISTINCT user_id) AS users,
       COUNT(DISTINCT streamer_id) AS streamers
FROM v_calls WHERE {window(10)} GROUP BY day""")
