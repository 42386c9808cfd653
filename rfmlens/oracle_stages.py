"""Stage views and final SELECTs of the SQL oracle (see ``rfmlens.oracle``)."""

from __future__ import annotations

from .oracle import RUN_DATE, WINDOW_END, div, lvl3, lvl5, query, quint, rnd, scale15, view

D = "::DOUBLE"
# Ties: the full key of the ranked entity, ascending (NULLs first, as Spark sorts).
S_ASC = "streamer_id, streamer_country_id NULLS FIRST, streamer_country_name NULLS FIRST"
S_DESC = "streamer_id DESC, streamer_country_id DESC NULLS LAST, streamer_country_name DESC NULLS LAST"
U_ASC = ("user_id, user_country_id NULLS FIRST, user_country_name NULLS FIRST, "
         "is_user_vip NULLS FIRST")

# ==========================================================================
# Streamer stage
# ==========================================================================
view("v_call_base", f"""
SELECT b.user_id, b.user_country_id, b.user_country_name, ur.region_name AS user_region_name,
       b.is_user_vip, b.streamer_id, b.streamer_country_id, b.streamer_country_name_ab,
       sr.country_name_en AS streamer_country_name, sr.region_name AS streamer_region_name,
       b.frequency, b.call_total_length, b.gold_coin_amount, b.recency_call_interval
FROM (
  SELECT user_id, user_country_id, user_country_name, is_user_vip,
         streamer_id, streamer_country_id, streamer_country_name_ab,
         COUNT(*) AS frequency, SUM(call_total_length) AS call_total_length,
         SUM(gold_coin_amount) AS gold_coin_amount, MIN(recency_call_interval) AS recency_call_interval
  FROM (
    SELECT user_id, user_country_id, user_country_name,
           CASE WHEN vip_level = 'free' THEN '0' ELSE '1' END AS is_user_vip,
           streamer_id, streamer_country_id, streamer_country_name_ab, call_total_length,
           CAST(0.6 AS DECIMAL(4,2)) * call_gold_coin_amount
             + CAST(0.4 AS DECIMAL(4,2)) * gift_gold_coin_amount AS gold_coin_amount,
           date_diff('day', CAST(call_begin_time AS DATE), DATE '{RUN_DATE}') AS recency_call_interval
    FROM v_calls) t
  GROUP BY user_id, user_country_id, user_country_name, is_user_vip,
           streamer_id, streamer_country_id, streamer_country_name_ab
) b
LEFT JOIN (SELECT DISTINCT country_name_en, region_name FROM v_country_region) ur
  ON b.user_country_name = ur.country_name_en
LEFT JOIN (SELECT DISTINCT country_ab, country_name_en, region_name FROM v_country_region) sr
  ON b.streamer_country_name_ab = sr.country_ab""")

view("v_s_values", """
SELECT streamer_id, streamer_country_id, streamer_country_name,
       CAST(SUM(COALESCE(frequency, 0)) AS BIGINT) AS frequency,
       SUM(COALESCE(gold_coin_amount, 0)) AS monetary,
       SUM(COALESCE(call_total_length, 0)) AS monetary1,
       CAST(MIN(COALESCE(recency_call_interval, 999)) AS BIGINT) AS recency
FROM v_call_base GROUP BY streamer_id, streamer_country_id, streamer_country_name""")

view("v_s_ranks", f"""
SELECT *,
  ROW_NUMBER() OVER (ORDER BY frequency DESC, {S_ASC}) AS frequency_rnk,
  ROW_NUMBER() OVER (ORDER BY frequency ASC, {S_DESC}) AS frequency_score,
  ROW_NUMBER() OVER (ORDER BY monetary DESC, {S_ASC}) AS monetary_rnk,
  ROW_NUMBER() OVER (ORDER BY monetary ASC, {S_DESC}) AS monetary_score,
  ROW_NUMBER() OVER (ORDER BY monetary1 DESC, {S_ASC}) AS monetary1_rnk,
  ROW_NUMBER() OVER (ORDER BY monetary1 ASC, {S_DESC}) AS monetary1_score,
  ROW_NUMBER() OVER (ORDER BY recency ASC, {S_ASC}) AS recency_rnk,
  ROW_NUMBER() OVER (ORDER BY recency DESC, {S_DESC}) AS recency_score
FROM v_s_values""")

view("v_s_comb", f"""
SELECT *, CAST(3*frequency_score + 2*monetary_score + 2*monetary1_score + 3*recency_score AS DOUBLE)
          / 10.0{D} AS rfm_combination_score
FROM v_s_ranks""")

view("v_s_scaled", f"""
SELECT c.*, {scale15('c.rfm_combination_score', 'm.mn', 'm.mx', 10000)} AS rfm_score_raw
FROM v_s_comb c CROSS JOIN (SELECT MIN(rfm_combination_score) AS mn, MAX(rfm_combination_score) AS mx
                            FROM v_s_comb) m""")

view("v_s_score", f"""
SELECT s.* EXCLUDE (rfm_score_raw),
       {rnd('s.rfm_score_raw * COALESCE(CAST(w.weight AS DOUBLE), 1.0' + D + ')', 2)} AS rfm_score
FROM v_s_scaled s LEFT JOIN v_streamer_weight w ON s.streamer_id = w.streamer_id""")

view("v_s_level", f"""
SELECT r.*, {rnd(div('r.rfm_rnk', 'm.rfm_rnk_max'), 2)} AS rfm_rnk_percentage
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY streamer_country_id, streamer_country_name
                                   ORDER BY rfm_score DESC, {S_ASC}) AS rfm_rnk
      FROM v_s_score) r
LEFT JOIN (SELECT streamer_country_id, streamer_country_name, COUNT(*) AS rfm_rnk_max
           FROM v_s_score GROUP BY streamer_country_id, streamer_country_name) m
  ON r.streamer_country_id = m.streamer_country_id AND r.streamer_country_name = m.streamer_country_name""")

view("v_streamer_level", f"""
SELECT streamer_id, streamer_country_id, streamer_country_name,
       frequency, CAST(monetary AS DOUBLE) AS monetary, CAST(monetary1 AS DOUBLE) AS monetary1, recency,
       frequency_rnk, monetary_rnk, monetary1_rnk, recency_rnk,
       frequency_score, monetary_score, monetary1_score, recency_score,
       rfm_combination_score, rfm_score, rfm_rnk, rfm_rnk_percentage,
       {lvl3('rfm_rnk_percentage')} AS level
FROM v_s_level""")

query("job_streamer_level", "SELECT * FROM v_streamer_level")

query("call_base", """
SELECT user_id, user_country_id, user_country_name, user_region_name, is_user_vip,
       streamer_id, streamer_country_id, streamer_country_name_ab, streamer_country_name,
       streamer_region_name, frequency, CAST(call_total_length AS DOUBLE) AS call_total_length,
       CAST(gold_coin_amount AS DOUBLE) AS gold_coin_amount, recency_call_interval
FROM v_call_base""")

# ==========================================================================
# Call facts
# ==========================================================================
GAP = 21600  # fixture match gap (FIXTURES.md)


def secs(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


view("v_call_rec", f"""
SELECT user_id, matched_id, room_id, create_time, video_time, goddess_video, goddess_location,
       is_pay, gender_condition, request_type,
       make_timestamp(({secs('create_time')} - CAST(trunc(video_time / 1000) AS BIGINT)) * 1000000)
         AS start_time
FROM v_video_record""")


def _click_branch(name: str, label: int, place: str, events: tuple[str, ...]) -> str:
    ev = ", ".join(f"'{e}'" for e in events)
    return f"""
SELECT r.user_id, r.target_user_id, c.room_id, c.start_time AS create_time,
       c.create_time AS end_time, c.video_time, '{name}' AS channel_name, CAST({label} AS BIGINT) AS label
FROM (SELECT user_id, target_user_id, create_time FROM v_request_record
      WHERE place_id = '{place}' AND event_id IN ({ev})) r
JOIN (SELECT * FROM v_call_rec WHERE goddess_video = 2) c
  ON r.user_id = c.user_id AND r.target_user_id = c.matched_id
 AND {secs('c.start_time')} >= {secs('r.create_time')}
 AND {secs('c.start_time')} - {secs('r.create_time')} < {GAP}"""


view("v_req_match", "\nUNION ALL\n".join([
    _click_branch("hotvideo", 1, "8", ("8-1-1-18",)),
    _click_branch("livecam", 2, "1", ("1-5-15-12", "1-5-15-14", "1-5-20-1")),
    _click_branch("quickchat", 3, "13", ("13-12-17-1",)),
    _click_branch("wall", 4, "1", ("1-1-4-7",)),
]))


def _rec_branch(name: str, label: int, where: str) -> str:
    return f"""
SELECT user_id, CAST(matched_id AS BIGINT) AS target_user_id, room_id, start_time AS create_time,
       create_time AS end_time, video_time, '{name}' AS channel_name, CAST({label} AS BIGINT) AS label
FROM v_call_rec WHERE {where}"""


view("v_channel_tag", "\nUNION ALL\n".join([
    _rec_branch("nine_coin", 5, "is_pay = 1 AND goddess_video = 1 AND goddess_location = 2"),
    _rec_branch("both", 6, "goddess_video = 1 AND goddess_location = 2 AND gender_condition = 0 "
                           "AND request_type = 0"),
    _rec_branch("friend_call_minute", 7, "goddess_video = 2 AND goddess_location IN (3,12,21,24)"),
    _rec_branch("friend_call_times", 8, "goddess_video NOT IN (2) AND goddess_location IN (3,12,21,24)"),
]))

view("v_channel_union", """
SELECT user_id, target_user_id, room_id, create_time, end_time, video_time, channel_name, label
FROM v_req_match
UNION
SELECT user_id, target_user_id, room_id, create_time, end_time, video_time, channel_name, label
FROM v_channel_tag""")

view("v_coin_total", """
SELECT user_id, remote_user_id, room_id, SUM(gold_num) AS gold_num
FROM (SELECT user_id, remote_user_id, room_id, gold_num FROM v_minute_gold
      UNION ALL
      SELECT user_id, remote_user_id, room_id, gold_num FROM v_goddess_gold) a
GROUP BY user_id, remote_user_id, room_id""")

view("v_gift_total", """
SELECT send_user_id AS user_id, user_id AS streamer_id, SUM(gift_gold) AS gift_gold
FROM v_gift_detail GROUP BY send_user_id, user_id""")

view("v_coin_attach", """
SELECT a.*, COALESCE(b.gold_num, CAST(0 AS DECIMAL(12,2))) AS gold_num,
       COALESCE(c.gift_gold, CAST(0 AS DECIMAL(12,2))) AS gift_gold
FROM v_channel_union a
LEFT JOIN v_coin_total b
  ON a.user_id = b.user_id AND a.target_user_id = b.remote_user_id AND a.room_id = b.room_id
LEFT JOIN v_gift_total c ON a.user_id = c.user_id AND a.target_user_id = c.streamer_id""")

view("v_profile_snapshot", """
SELECT DISTINCT user_id, country_id, country_name_en, vip_level FROM v_user_info WHERE user_id <> -1""")

view("v_call_detail", """
SELECT a.user_id, b.country_id AS user_country_id, b.country_name_en AS user_country_name,
       COALESCE(b.vip_level, 'free') AS is_user_vip, a.target_user_id AS streamer_id,
       s.country_id AS streamer_country_id, s.country_name_en AS streamer_country_name,
       a.label AS channel_id, a.channel_name, a.create_time AS call_begin_time,
       a.end_time AS call_end_time, a.video_time AS call_total_length,
       CAST(a.gold_num AS DOUBLE) AS call_gold_coin_amount,
       CAST(a.gift_gold AS DOUBLE) AS gift_gold_coin_amount
FROM v_coin_attach a
JOIN v_profile_snapshot b ON a.user_id = b.user_id
JOIN v_profile_snapshot s ON a.target_user_id = s.user_id""")

CALL_COLS = "day, user_id, streamer_id, room_id, CAST(channel_id AS BIGINT) AS channel_id, " \
            "CAST(call_total_length AS DOUBLE) AS call_total_length"
query("scan_day", f"SELECT {CALL_COLS} FROM v_calls WHERE day = DATE '{WINDOW_END}'")
query("scan_window", f"""SELECT {CALL_COLS} FROM v_calls
WHERE day > DATE '{WINDOW_END}' - INTERVAL 30 DAY AND day <= DATE '{WINDOW_END}'""")
query("call_start", """SELECT user_id, CAST(matched_id AS BIGINT) AS matched_id, room_id, create_time,
       video_time, start_time FROM v_call_rec""")
query("channel_tag", "SELECT * FROM v_channel_tag")
query("request_match_join", "SELECT * FROM v_req_match")
query("request_match_stream", "SELECT * FROM v_req_match")
query("channel_union", "SELECT * FROM v_channel_union")
query("coin_total", "SELECT user_id, CAST(remote_user_id AS BIGINT) AS remote_user_id, room_id, "
                    "CAST(gold_num AS DOUBLE) AS gold_num FROM v_coin_total")
query("gift_total", "SELECT user_id, streamer_id, CAST(gift_gold AS DOUBLE) AS gift_gold FROM v_gift_total")
query("coin_gift_attach", "SELECT * EXCLUDE (gold_num, gift_gold), CAST(gold_num AS DOUBLE) AS gold_num, "
                          "CAST(gift_gold AS DOUBLE) AS gift_gold FROM v_coin_attach")
ENRICH = """
SELECT a.*, CAST(b.country_id AS BIGINT) AS user_country_id, b.country_name_en AS user_country_name,
       COALESCE(b.vip_level, 'free') AS is_user_vip, CAST(s.country_id AS BIGINT) AS streamer_country_id,
       s.country_name_en AS streamer_country_name
FROM v_channel_union a JOIN v_profile_snapshot b ON a.user_id = b.user_id
JOIN v_profile_snapshot s ON a.target_user_id = s.user_id"""
query("enrich_calls", ENRICH)
query("enrich_calls_salted", ENRICH)
query("job_call_detail", """SELECT * EXCLUDE (user_country_id, streamer_country_id),
  CAST(user_country_id AS BIGINT) AS user_country_id, CAST(streamer_country_id AS BIGINT) AS streamer_country_id
FROM v_call_detail""")

view("v_call_match", f"""
SELECT c.day, c.user_id, c.user_country_id, c.user_country_name, c.vip_level AS is_user_vip,
       c.streamer_id, cr.country_id AS streamer_country_id, s.country_name_ab AS streamer_country_name,
       c.channel_id, c.call_begin_time, c.call_total_length, c.call_gold_coin_amount,
       c.gift_gold_coin_amount
FROM (SELECT * FROM v_calls WHERE day > DATE '{WINDOW_END}' - INTERVAL 30 DAY
                             AND day <= DATE '{WINDOW_END}') c
JOIN (SELECT DISTINCT user_id, country_name_ab FROM v_streamer_country) s ON c.streamer_id = s.user_id
LEFT JOIN (SELECT DISTINCT country_ab, country_id FROM v_country_region) cr
  ON s.country_name_ab = cr.country_ab""")
query("call_match_window", """
SELECT day, user_id, CAST(user_country_id AS BIGINT) AS user_country_id, user_country_name, is_user_vip,
       streamer_id, CAST(streamer_country_id AS BIGINT) AS streamer_country_id, streamer_country_name,
       CAST(channel_id AS BIGINT) AS channel_id, call_begin_time,
       CAST(call_total_length AS DOUBLE) AS call_total_length,
       CAST(call_gold_coin_amount AS DOUBLE) AS call_gold_coin_amount,
       CAST(gift_gold_coin_amount AS DOUBLE) AS gift_gold_coin_amount
FROM v_call_match""")

# ---- streamer stage, operator keys ------------------------------------------
S_VAL = ("streamer_id, streamer_country_id, streamer_country_name, frequency, "
         "CAST(monetary AS DOUBLE) AS monetary, CAST(monetary1 AS DOUBLE) AS monetary1, recency")
S_RNK = ("frequency_rnk, frequency_score, monetary_rnk, monetary_score, monetary1_rnk, "
         "monetary1_score, recency_rnk, recency_score")
query("rfm_values_streamer", f"SELECT {S_VAL} FROM v_s_values")
query("global_rank_streamer", f"SELECT {S_VAL}, {S_RNK} FROM v_s_ranks")
query("rfm_combine_streamer", f"SELECT {S_VAL}, {S_RNK}, rfm_combination_score FROM v_s_comb")
query("minmax_global", """SELECT MAX(rfm_combination_score) AS rfm_combination_score_max,
       MIN(rfm_combination_score) AS rfm_combination_score_min FROM v_s_comb""")
query("rfm_score_streamer", f"""SELECT {S_VAL}, {S_RNK}, rfm_combination_score,
       rfm_score_raw AS rfm_score FROM v_s_scaled""")
query("weighted_score_streamer", f"SELECT {S_VAL}, {S_RNK}, rfm_combination_score, rfm_score FROM v_s_score")
query("rank_percentage_country", """SELECT streamer_id, streamer_country_id, streamer_country_name,
       rfm_score, rfm_rnk, rfm_rnk_percentage FROM v_streamer_level""")
query("streamer_level", """SELECT streamer_id, streamer_country_id, streamer_country_name,
       rfm_rnk_percentage, level FROM v_streamer_level""")
query("serve_streamer_level", """SELECT streamer_id, streamer_country_id, streamer_country_name,
       level, rfm_score FROM v_streamer_level""")

view("v_level_distribution", f"""
SELECT a.streamer_country_id, a.streamer_country_name, a.level, a.streamer_amount,
       b.streamer_amount_total, {rnd(div('a.streamer_amount', 'b.streamer_amount_total'), 2)} AS percentage
FROM (SELECT streamer_country_id, streamer_country_name, level,
             COUNT(DISTINCT streamer_id) AS streamer_amount
      FROM v_streamer_level GROUP BY streamer_country_id, streamer_country_name, level) a
LEFT JOIN (SELECT streamer_country_id, streamer_country_name,
                  COUNT(DISTINCT streamer_id) AS streamer_amount_total
           FROM v_streamer_level GROUP BY streamer_country_id, streamer_country_name) b
  ON a.streamer_country_id = b.streamer_country_id AND a.streamer_country_name = b.streamer_country_name""")
query("level_distribution", "SELECT * FROM v_level_distribution")
query("job_level_distribution", "SELECT * FROM v_level_distribution")

query("vip_recode", """
SELECT user_id, vip_level, is_user_vip, if_vip, CASE WHEN if_vip = 'vip' THEN '1' ELSE '0' END AS flag_back
FROM (SELECT user_id, vip_level, is_user_vip,
             CASE WHEN is_user_vip = '1' THEN 'vip' ELSE 'free' END AS if_vip
      FROM (SELECT user_id, vip_level, CASE WHEN vip_level = 'free' THEN '0' ELSE '1' END AS is_user_vip
            FROM v_user_info) a) b""")
query("dim_country_dedup", "SELECT country_name_en, region_name FROM v_country_region GROUP BY country_name_en, region_name")
query("lookup_region", """
SELECT s.user_id, s.country_name_ab, c.country_name_en AS country_name, c.region_name
FROM v_streamer_country s
LEFT JOIN (SELECT DISTINCT country_ab, country_name_en, region_name FROM v_country_region) c
  ON s.country_name_ab = c.country_ab""")

# ==========================================================================
# User stage
# ==========================================================================
view("v_user_base", f"""
SELECT user_id, user_country_id, user_country_name, is_user_vip,
       streamer_id, streamer_country_id, streamer_country_name,
       COUNT(*) AS frequency, SUM(call_total_length) AS call_total_length,
       SUM(gold_coin_amount) AS gold_coin_amount, MIN(recency_call_interval) AS recency_call_interval
FROM (SELECT user_id, user_country_id, user_country_name,
             CASE WHEN vip_level = 'free' THEN '0' ELSE '1' END AS is_user_vip,
             streamer_id, streamer_country_id, streamer_country_name, call_total_length,
             CAST(0.6 AS DECIMAL(4,2)) * call_gold_coin_amount
               + CAST(0.4 AS DECIMAL(4,2)) * gift_gold_coin_amount AS gold_coin_amount,
             date_diff('day', CAST(call_begin_time AS DATE), DATE '{RUN_DATE}') AS recency_call_interval
      FROM v_calls) t
GROUP BY user_id, user_country_id, user_country_name, is_user_vip,
         streamer_id, streamer_country_id, streamer_country_name""")

view("v_uq_values", """
SELECT user_id, user_country_id, user_country_name, is_user_vip,
       CAST(SUM(COALESCE(frequency, 0)) AS BIGINT) AS frequency,
       SUM(COALESCE(gold_coin_amount, 0)) AS monetary,
       CAST(MIN(COALESCE(recency_call_interval, 999)) AS BIGINT) AS recency
FROM v_user_base GROUP BY user_id, user_country_id, user_country_name, is_user_vip""")

view("v_uq_ranks", f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY frequency DESC, {U_ASC}) AS frequency_rnk,
          ROW_NUMBER() OVER (ORDER BY monetary DESC, {U_ASC}) AS monetary_rnk,
          ROW_NUMBER() OVER (ORDER BY recency ASC, {U_ASC}) AS recency_rnk
FROM v_uq_values""")

view("v_uq_scores", f"""
SELECT r.*, m.fmax AS frequency_rnk_max, m.mmax AS monetary_rnk_max, m.rmax AS recency_rnk_max,
       {quint(div('r.frequency_rnk', 'm.fmax'))} AS frequency_score,
       {quint(div('r.monetary_rnk', 'm.mmax'))} AS monetary_score,
       {quint(div('r.recency_rnk', 'm.rmax'))} AS recency_score
FROM v_uq_ranks r CROSS JOIN (SELECT MAX(frequency_rnk) AS fmax, MAX(monetary_rnk) AS mmax,
                                     MAX(recency_rnk) AS rmax FROM v_uq_ranks) m""")

view("v_uq_score", f"""
SELECT *, CAST(3*frequency_score + 3*recency_score + 4*monetary_score AS DOUBLE) / 10.0{D} AS rfm_score
FROM v_uq_scores""")

view("v_uq_level", f"""
SELECT r.*, {rnd(div('r.rfm_rnk', 'm.rfm_rnk_max'), 2)} AS rfm_rnk_percentage
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_country_id, user_country_name
                                   ORDER BY rfm_score DESC, {U_ASC}) AS rfm_rnk FROM v_uq_score) r
LEFT JOIN (SELECT user_country_id, user_country_name, COUNT(*) AS rfm_rnk_max
           FROM v_uq_score GROUP BY user_country_id, user_country_name) m
  ON r.user_country_id = m.user_country_id AND r.user_country_name = m.user_country_name""")

UQ = ("user_id, user_country_id, user_country_name, is_user_vip, frequency, "
      "CAST(monetary AS DOUBLE) AS monetary, recency, frequency_rnk, monetary_rnk, recency_rnk, "
      "frequency_score, monetary_score, recency_score, rfm_score")
query("quintile_score_user", f"""SELECT {UQ}, frequency_rnk_max, monetary_rnk_max, recency_rnk_max
FROM v_uq_score""")

view("v_ut_values", """
SELECT user_id, user_country_id, user_country_name, is_user_vip,
       CAST(SUM(COALESCE(frequency, 0)) AS BIGINT) AS frequency,
       SUM(COALESCE(gold_coin_amount, 0)) AS monetary1,
       SUM(COALESCE(call_total_length, 0)) AS monetary2,
       CAST(MIN(COALESCE(recency_call_interval, 999)) AS BIGINT) AS recency
FROM v_user_base GROUP BY user_id, user_country_id, user_country_name, is_user_vip""")

view("v_ut_ranks", f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY frequency DESC, {U_ASC}) AS frequency_rnk,
          ROW_NUMBER() OVER (ORDER BY monetary1 DESC, {U_ASC}) AS monetary1_rnk,
          ROW_NUMBER() OVER (ORDER BY monetary2 DESC, {U_ASC}) AS monetary2_rnk,
          ROW_NUMBER() OVER (ORDER BY recency ASC, {U_ASC}) AS recency_rnk
FROM v_ut_values""")

view("v_ut_comb", f"""
SELECT *, CAST(3*frequency_rnk + 2*monetary1_rnk + 2*monetary2_rnk + 3*recency_rnk AS DOUBLE)
          / 10.0{D} AS rfm_combination_score
FROM v_ut_ranks""")

view("v_ut_score", f"""
SELECT c.user_id, c.user_country_id, c.user_country_name, g.region_name AS user_region_name,
       c.is_user_vip, c.frequency, c.monetary1, c.monetary2, c.recency, c.frequency_rnk,
       c.monetary1_rnk, c.monetary2_rnk, c.recency_rnk, c.rfm_combination_score,
       {scale15('c.rfm_combination_score', 'm.mn', 'm.mx', 2000000)} AS rfm_score
FROM v_ut_comb c
CROSS JOIN (SELECT MIN(rfm_combination_score) AS mn, MAX(rfm_combination_score) AS mx FROM v_ut_comb) m
LEFT JOIN (SELECT DISTINCT country_name_en, region_name FROM v_country_region) g
  ON c.user_country_name = g.country_name_en""")

UT = ("user_id, user_country_id, user_country_name, is_user_vip, frequency, "
      "CAST(monetary1 AS DOUBLE) AS monetary1, CAST(monetary2 AS DOUBLE) AS monetary2, recency")
UT_R = "frequency_rnk, monetary1_rnk, monetary2_rnk, recency_rnk"
query("rfm_values_user", f"SELECT {UT} FROM v_ut_values")
query("global_rank_user", f"SELECT {UT}, {UT_R} FROM v_ut_ranks")
query("rfm_combine_user", f"SELECT {UT}, {UT_R}, rfm_combination_score FROM v_ut_comb")
query("rfm_score_user", f"SELECT {UT}, user_region_name, {UT_R}, rfm_combination_score, rfm_score FROM v_ut_score")

view("v_ul_country", f"""
SELECT r.*, {rnd(div('r.rfm_rnk', 'm.rfm_rnk_max'), 6)} AS rfm_rnk_percentage
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_region_name, user_country_id, user_country_name
                                   ORDER BY rfm_score DESC, {U_ASC}) AS rfm_rnk FROM v_ut_score) r
LEFT JOIN (SELECT user_region_name, user_country_id, user_country_name, COUNT(*) AS rfm_rnk_max
           FROM v_ut_score GROUP BY user_region_name, user_country_id, user_country_name) m
  ON r.user_region_name = m.user_region_name AND r.user_country_id = m.user_country_id
 AND r.user_country_name = m.user_country_name""")

view("v_ul_region", f"""
SELECT r.*, {rnd(div('r.region_rfm_rnk', 'm.mx'), 6)} AS region_rfm_rnk_percentage
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_region_name ORDER BY rfm_score DESC, {U_ASC})
                AS region_rfm_rnk FROM v_ut_score) r
LEFT JOIN (SELECT user_region_name, COUNT(*) AS mx FROM v_ut_score GROUP BY user_region_name) m
  ON r.user_region_name = m.user_region_name""")

query("user_level_country", f"""
SELECT user_id, user_country_id, user_country_name, user_region_name, is_user_vip, rfm_score,
       rfm_rnk, rfm_rnk_percentage, {lvl3('rfm_rnk_percentage')} AS level FROM v_ul_country""")
query("user_level_region", f"""
SELECT user_id, user_region_name, is_user_vip, rfm_score, region_rfm_rnk, region_rfm_rnk_percentage,
       {lvl5('region_rfm_rnk_percentage')} AS region_level FROM v_ul_region""")
query("rank_percentage_region", """
SELECT user_id, user_region_name, is_user_vip, region_rfm_rnk, region_rfm_rnk_percentage FROM v_ul_region""")
query("job_user_level", f"""
SELECT c.user_id, c.user_country_id, c.user_country_name, c.user_region_name, c.is_user_vip, c.rfm_score,
       c.rfm_rnk, c.rfm_rnk_percentage, {lvl3('c.rfm_rnk_percentage')} AS level,
       r.region_rfm_rnk, r.region_rfm_rnk_percentage, {lvl5('r.region_rfm_rnk_percentage')} AS region_level
FROM v_ul_country c JOIN v_ul_region r
  ON c.user_id = r.user_id AND c.user_country_id = r.user_country_id AND c.is_user_vip = r.is_user_vip""")

# ==========================================================================
# Preference stage (country and region grains)
# ==========================================================================
BAND = "BETWEEN 0.1::DOUBLE AND 0.6::DOUBLE"
BASE_COLS = ("b.user_id, b.user_country_id, b.user_country_name, {region} AS user_region_name, "
             "b.is_user_vip, b.streamer_id, b.streamer_country_id, b.streamer_country_name, "
             "b.frequency, b.call_total_length, b.gold_coin_amount, b.recency_call_interval")

view("v_cp_band", f"""
SELECT {BASE_COLS.format(region='b.user_region_name')}
FROM v_call_base b
JOIN (SELECT user_id, user_country_id, user_country_name, is_user_vip FROM v_uq_level
      WHERE rfm_rnk_percentage {BAND}) u
  ON b.user_id = u.user_id AND b.user_country_id = u.user_country_id
 AND b.user_country_name = u.user_country_name AND b.is_user_vip = u.is_user_vip
JOIN (SELECT streamer_id, streamer_country_id, streamer_country_name FROM v_streamer_level
      WHERE rfm_rnk_percentage {BAND}) s
  ON b.streamer_id = s.streamer_id AND b.streamer_country_id = s.streamer_country_id
 AND b.streamer_country_name = s.streamer_country_name""")

view("v_rp_band", f"""
SELECT {BASE_COLS.format(region='u.user_region_name')}
FROM v_call_base b
LEFT JOIN (SELECT user_id, user_region_name, is_user_vip FROM v_ul_region
           WHERE region_rfm_rnk_percentage {BAND}
           GROUP BY user_id, user_region_name, is_user_vip) u
  ON b.user_id = u.user_id AND b.user_region_name = u.user_region_name AND b.is_user_vip = u.is_user_vip""")

BASE_OUT = ("user_id, user_country_id, user_country_name, user_region_name, is_user_vip, streamer_id, "
            "streamer_country_id, streamer_country_name, frequency, "
            "CAST(call_total_length AS DOUBLE) AS call_total_length, "
            "CAST(gold_coin_amount AS DOUBLE) AS gold_coin_amount, recency_call_interval")
query("mid_band_pairs_country", f"SELECT {BASE_OUT} FROM v_cp_band")
query("mid_band_pairs_region", f"SELECT {BASE_OUT} FROM v_rp_band")


def _pref_views(p: str, band: str, group: list[str], minmax_by: list[str]) -> None:
    pair = group + ["streamer_country_id", "streamer_country_name"]
    keys = ", ".join(pair)
    tie_cols = [c for c in pair if c != "is_user_vip"]
    tie_asc = ", ".join(f"{c} ASC NULLS FIRST" for c in tie_cols)
    tie_desc = ", ".join(f"{c} DESC NULLS LAST" for c in tie_cols)
    view(f"v_{p}_values", f"""
SELECT {keys}, CAST(SUM(COALESCE(frequency, 0)) AS BIGINT) AS frequency,
       SUM(COALESCE(gold_coin_amount, 0)) AS monetary, SUM(COALESCE(call_total_length, 0)) AS monetary1,
       CAST(MIN(COALESCE(recency_call_interval, 999)) AS BIGINT) AS recency
FROM {band} GROUP BY {keys}""")
    rk = []
    for m in ("frequency", "monetary", "monetary1"):
        rk.append(f"ROW_NUMBER() OVER (PARTITION BY is_user_vip ORDER BY {m} DESC, {tie_asc}) AS {m}_rnk")
        rk.append(f"ROW_NUMBER() OVER (PARTITION BY is_user_vip ORDER BY {m} ASC, {tie_desc}) AS {m}_score")
    rk.append(f"ROW_NUMBER() OVER (PARTITION BY is_user_vip ORDER BY recency ASC, {tie_asc}) AS recency_rnk")
    rk.append(f"ROW_NUMBER() OVER (PARTITION BY is_user_vip ORDER BY recency DESC, {tie_desc}) AS recency_score")
    view(f"v_{p}_ranks", f"SELECT *, {', '.join(rk)} FROM v_{p}_values")
    view(f"v_{p}_comb", f"""
SELECT *, CAST(3*frequency_score + 2*monetary_score + 2*monetary1_score + 3*recency_score AS DOUBLE)
          / 10.0::DOUBLE AS rfm_combination_score FROM v_{p}_ranks""")
    mk = ", ".join(minmax_by)
    on = " AND ".join(f"c.{k} = m.{k}" for k in minmax_by)
    view(f"v_{p}_scaled", f"""
SELECT c.*, {scale15('c.rfm_combination_score', 'm.mn', 'm.mx', None)} AS rfm_score
FROM v_{p}_comb c LEFT JOIN (SELECT {mk}, MIN(rfm_combination_score) AS mn,
                                    MAX(rfm_combination_score) AS mx FROM v_{p}_comb GROUP BY {mk}) m
  ON {on}""")
    view(f"v_{p}_rank", f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY rfm_combination_score DESC, is_user_vip ASC, {tie_asc}) AS rfm_rnk
FROM v_{p}_scaled""")
    view(f"v_{p}_pref", f"""
SELECT r.*, {rnd(div('r.rfm_rnk', 'm.mx'), 5)} AS rfm_rnk_percentage, r.rfm_score AS preference
FROM v_{p}_rank r
LEFT JOIN (SELECT is_user_vip, MAX(rfm_rnk) AS mx FROM v_{p}_rank GROUP BY is_user_vip) m
  ON r.is_user_vip = m.is_user_vip""")
    gk = ", ".join(group)
    view(f"v_{p}_grid", f"""
SELECT u.*, s.* FROM (SELECT DISTINCT {gk} FROM v_call_base) u
CROSS JOIN (SELECT DISTINCT streamer_country_id, streamer_country_name FROM v_call_base) s""")
    jon = " AND ".join(f"g.{k} = p.{k}" for k in pair)
    view(f"v_{p}_filled", f"""
SELECT g.*, COALESCE(p.preference, 0.5::DOUBLE) AS preference
FROM v_{p}_grid g LEFT JOIN v_{p}_pref p ON {jon}""")
    gon = " AND ".join(f"f.{k} = t.{k}" for k in group)
    view(f"v_{p}_dist", f"""
SELECT f.*, {rnd(div('f.preference', 't.tot'), 5)} AS percentage
FROM v_{p}_filled f LEFT JOIN (SELECT {gk}, SUM(CAST(preference AS DECIMAL(28,10))) AS tot
                               FROM v_{p}_filled GROUP BY {gk}) t ON {gon}""")
    vals = (f"{keys}, frequency, CAST(monetary AS DOUBLE) AS monetary, "
            f"CAST(monetary1 AS DOUBLE) AS monetary1, recency")
    query(f"rfm_values_{'country' if p == 'cp' else 'region'}", f"SELECT {vals} FROM v_{p}_values")
    sfx = "country" if p == "cp" else "region"
    query(f"group_rank_{sfx}", f"""SELECT {keys}, frequency_rnk, frequency_score, monetary_rnk,
       monetary_score, monetary1_rnk, monetary1_score, recency_rnk, recency_score FROM v_{p}_ranks""")
    query(f"preference_{sfx}", f"SELECT {keys}, rfm_combination_score, rfm_score FROM v_{p}_scaled")
    query(f"pair_rank_{sfx}", f"""SELECT {keys}, rfm_combination_score, rfm_rnk, rfm_rnk_percentage,
       preference FROM v_{p}_pref""")
    query(f"pair_grid_{sfx}", f"SELECT * FROM v_{p}_grid")
    query(f"grid_fill_{sfx}", f"SELECT * FROM v_{p}_filled")
    query(f"share_{sfx}", f"SELECT * FROM v_{p}_dist")
    query(f"job_{sfx}_preference", f"SELECT * FROM v_{p}_dist")


_pref_views("cp", "v_cp_band", ["user_country_id", "user_country_name", "is_user_vip"],
            ["user_country_name"])
_pref_views("rp", "v_rp_band", ["user_region_name", "is_user_vip"], ["is_user_vip"])

query("minmax_group", """SELECT user_country_name, MAX(rfm_combination_score) AS rfm_combination_score_max,
       MIN(rfm_combination_score) AS rfm_combination_score_min FROM v_cp_comb GROUP BY user_country_name""")
BY_LEVEL = f"""
SELECT d.user_country_id, d.user_country_name, d.is_user_vip, d.streamer_country_id, d.streamer_country_name,
       l.level, {rnd('d.percentage * l.percentage', 2)} AS percentage
FROM v_cp_dist d LEFT JOIN v_level_distribution l
  ON d.streamer_country_id = l.streamer_country_id AND d.streamer_country_name = l.streamer_country_name"""
query("recall_by_level", BY_LEVEL)
query("job_country_preference_level", BY_LEVEL)

# ==========================================================================
# Recall stage (country and region grains)
# ==========================================================================
ROW_GOLD, REGION_GOLD = 2000000, 25000000
COUNTERS = ["user_cnt", "both_play_times", "both_call_times", "both_request_times",
            "both_success_times", "hotvideo_play_times", "hotvideo_call_times",
            "hotvideo_request_times", "hotvideo_success_times", "friend_call_users",
            "friend_call_times", "friend_video_users", "friend_video_times", "total_video_duration"]
CNT = ", ".join(COUNTERS)
CNT_OUT = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == "total_video_duration" else c
                    for c in COUNTERS)
RATES = f"""{rnd(div('both_success_times', 'both_play_times'), 3)} AS success_rate_both,
       {rnd(div('hotvideo_success_times', 'hotvideo_play_times'), 3)} AS success_rate_hotvideo,
       COALESCE({rnd(div('both_success_times * total_video_duration',
                         'CAST(both_play_times AS DOUBLE) * CAST(friend_video_times AS DOUBLE)'), 3)},
                0.0::DOUBLE) AS raw_score"""
AB_NAME = "(SELECT DISTINCT country_ab, country_name_en FROM v_country_region)"

view("v_ca_act", f"""
SELECT a.user_country_name, a.user_country_name_ab, a.user_region_name, a.if_vip,
       c.country_name_en AS streamer_country_name,
       a.streamer_country_name_ab, a.streamer_region_name, {', '.join('a.' + c for c in COUNTERS)},
       a.avg_video_duration, a.success_rate_both, a.success_rate_hotvideo, a.raw_score
FROM (SELECT country_name_en AS user_country_name, country AS user_country_name_ab,
             region_name AS user_region_name, if_vip,
             streamer_country AS streamer_country_name_ab, streamer_region AS streamer_region_name,
             {CNT}, avg_video_duration, {RATES}
      FROM v_country_preference_pre) a
LEFT JOIN {AB_NAME} c ON a.streamer_country_name_ab = c.country_ab""")

view("v_ra_roll", f"""
SELECT region_name AS user_region_name, if_vip, streamer_country AS streamer_country_name_ab,
       streamer_region AS streamer_region_name,
       {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {c}' if c != 'total_video_duration'
                  else f'SUM({c}) AS {c}' for c in COUNTERS)},
       {rnd('AVG(avg_video_duration)', 6)} AS avg_video_duration
FROM v_country_preference_pre GROUP BY region_name, if_vip, streamer_country, streamer_region""")

view("v_ra_act", f"""
SELECT a.user_region_name, a.if_vip, c.country_name_en AS streamer_country_name,
       a.streamer_country_name_ab, a.streamer_region_name, {', '.join('a.' + c for c in COUNTERS)},
       a.avg_video_duration, a.success_rate_both, a.success_rate_hotvideo, a.raw_score
FROM (SELECT *, {RATES} FROM v_ra_roll) a
LEFT JOIN {AB_NAME} c ON a.streamer_country_name_ab = c.country_ab""")

ACT_OUT = (f"if_vip, streamer_country_name, streamer_country_name_ab, streamer_region_name, {CNT_OUT}, "
           "avg_video_duration, success_rate_both, success_rate_hotvideo, raw_score")
query("activity_score_country", f"SELECT user_country_name, user_country_name_ab, user_region_name, {ACT_OUT} FROM v_ca_act")
query("activity_score_region", f"SELECT user_region_name, {ACT_OUT} FROM v_ra_act")
query("activity_region", f"""SELECT user_region_name, if_vip, streamer_country_name_ab, streamer_region_name,
       {CNT_OUT}, avg_video_duration FROM v_ra_roll""")


def _behaviour_views(p: str, act: str, user: str) -> None:
    view(f"v_{p}_brank", f"""
SELECT *, ROW_NUMBER() OVER (PARTITION BY {user}, if_vip ORDER BY raw_score DESC,
                             streamer_country_name_ab ASC) AS hotvideo_rnk,
          ROW_NUMBER() OVER (PARTITION BY {user}, if_vip ORDER BY raw_score ASC,
                             streamer_country_name_ab DESC) AS hotvideo_combination_score
FROM {act}""")
    view(f"v_{p}_behav", f"""
SELECT r.*, {scale15('r.hotvideo_combination_score', 'm.cmn', 'm.cmx', None)} AS hotvideo_rank_score_norm,
       {scale15('r.raw_score', 'm.rmn', 'm.rmx', None)} AS hotvideo_raw_score_norm
FROM v_{p}_brank r
LEFT JOIN (SELECT {user}, MIN(hotvideo_combination_score) AS cmn, MAX(hotvideo_combination_score) AS cmx,
                  MIN(raw_score) AS rmn, MAX(raw_score) AS rmx FROM v_{p}_brank GROUP BY {user}) m
  ON r.{user} = m.{user}""")


_behaviour_views("cb", "v_ca_act", "user_country_name")
_behaviour_views("rb", "v_ra_act", "user_region_name")
BEH = ("if_vip, streamer_country_name, streamer_country_name_ab, raw_score, hotvideo_rnk, "
       "hotvideo_combination_score, hotvideo_rank_score_norm")
query("behaviour_score_country", f"""SELECT user_country_name, user_country_name_ab, {BEH}, hotvideo_raw_score_norm,
       hotvideo_raw_score_norm AS hotvideo_score FROM v_cb_behav""")
query("behaviour_score_region", f"""SELECT user_region_name, {BEH},
       hotvideo_rank_score_norm AS hotvideo_score FROM v_rb_behav""")


def blends(rfm: str, beh: str) -> str:
    return ", ".join(f"{rnd(f'({w} * {rfm} + {10 - w} * {beh}) / 10.0::DOUBLE', 2)} AS final_score{i}"
                     for i, w in enumerate((3, 2, 1), start=1))


view("v_ci", f"""
SELECT p.user_country_id, p.user_country_name, b.user_country_name_ab, b.user_region_name, p.if_vip,
       p.streamer_country_id,
       p.streamer_country_name, b.streamer_country_name_ab, b.streamer_region_name,
       {blends('p.preference', 'b.hotvideo_raw_score_norm')},
       p.preference AS rfm_score, b.hotvideo_raw_score_norm AS hotvideo_score,
       b.raw_score AS raw_hotvideo_score, b.success_rate_hotvideo, b.success_rate_both,
       {', '.join('b.' + c for c in COUNTERS)}, b.avg_video_duration
FROM (SELECT DISTINCT user_country_id, user_country_name, streamer_country_id, streamer_country_name,
             CASE WHEN is_user_vip = '1' THEN 'vip' ELSE 'free' END AS if_vip, preference
      FROM v_cp_pref) p
LEFT JOIN v_cb_behav b ON p.user_country_name = b.user_country_name AND p.if_vip = b.if_vip
 AND p.streamer_country_name = b.streamer_country_name""")

view("v_ri", f"""
SELECT p.user_region_name, p.if_vip, p.streamer_country_id, p.streamer_country_name,
       b.streamer_country_name_ab, b.streamer_region_name,
       {blends('p.preference', 'b.hotvideo_rank_score_norm')},
       p.preference AS rfm_score, b.hotvideo_rank_score_norm AS hotvideo_score,
       b.raw_score AS raw_hotvideo_score, b.success_rate_hotvideo
FROM (SELECT DISTINCT user_region_name, streamer_country_id, streamer_country_name,
             CASE WHEN is_user_vip = '1' THEN 'vip' ELSE 'free' END AS if_vip, preference
      FROM v_rp_pref) p
LEFT JOIN v_rb_behav b ON p.user_region_name = b.user_region_name AND p.if_vip = b.if_vip
 AND p.streamer_country_name = b.streamer_country_name""")

INTEG_TAIL = ("if_vip, streamer_country_id, streamer_country_name, streamer_country_name_ab, "
              "streamer_region_name, final_score1, final_score2, final_score3, rfm_score, hotvideo_score, "
              "raw_hotvideo_score")
query("blend_country", f"""SELECT user_country_id, user_country_name, user_country_name_ab, user_region_name, {INTEG_TAIL},
       success_rate_hotvideo FROM v_ci""")
query("blend_region", f"SELECT user_region_name, {INTEG_TAIL}, success_rate_hotvideo FROM v_ri")

view("v_c_allow", f"""
SELECT DISTINCT a.user_country_name, c.country_name_en AS streamer_country_name
FROM (SELECT DISTINCT country_name_en AS user_country_name, streamer_country FROM v_country_preference_pre
      WHERE friend_total_gold >= {ROW_GOLD}) a
LEFT JOIN {AB_NAME} c ON a.streamer_country = c.country_ab""")
view("v_r_allow_row", f"""
SELECT DISTINCT a.user_region_name, c.country_name_en AS streamer_country_name
FROM (SELECT DISTINCT region_name AS user_region_name, streamer_country FROM v_country_preference_pre
      WHERE friend_total_gold >= {ROW_GOLD}) a
LEFT JOIN {AB_NAME} c ON a.streamer_country = c.country_ab""")
view("v_r_allow_sum", f"""
SELECT DISTINCT a.user_region_name, c.country_name_en AS streamer_country_name
FROM (SELECT region_name AS user_region_name, streamer_country FROM v_country_preference_pre
      GROUP BY region_name, streamer_country HAVING SUM(friend_total_gold) >= {REGION_GOLD}) a
LEFT JOIN {AB_NAME} c ON a.streamer_country = c.country_ab""")
query("allow_pairs_country", "SELECT * FROM v_c_allow")
query("allow_pairs_region", "SELECT * FROM v_r_allow_sum")

FILL = ", ".join(
    f"COALESCE({c}, 0) AS {c}" if c != "total_video_duration"
    else f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in COUNTERS)
query("allow_filter_country", f"""
SELECT user_country_id, user_country_name, user_country_name_ab, user_region_name, {INTEG_TAIL}, {FILL},
       COALESCE(avg_video_duration, 0.0::DOUBLE) AS avg_video_duration,
       COALESCE(success_rate_both, 0.0::DOUBLE) AS success_rate_both,
       COALESCE(success_rate_hotvideo, 0.0::DOUBLE) AS success_rate_hotvideo
FROM v_ci i WHERE EXISTS (SELECT 1 FROM v_c_allow a WHERE a.user_country_name = i.user_country_name
                                                      AND a.streamer_country_name = i.streamer_country_name)""")
query("allow_filter_region", f"""
SELECT user_region_name, {INTEG_TAIL}, success_rate_hotvideo
FROM v_ri i WHERE EXISTS (SELECT 1 FROM v_r_allow_row a WHERE a.user_region_name = i.user_region_name
                                                          AND a.streamer_country_name = i.streamer_country_name)""")

STREAMERS = "(SELECT DISTINCT streamer_country_id, streamer_country_name FROM v_call_base)"
NAME_ID = "(SELECT DISTINCT country_id, country_name_en FROM v_country_region)"
view("v_cg", f"""
SELECT g.user_country_id, g.user_country_name, g.is_user_vip, g.streamer_country_name,
       COALESCE(i.final_score1, 0.5::DOUBLE) AS preference,
       COALESCE(i.raw_hotvideo_score, 0.1::DOUBLE) AS preference_rule
FROM (SELECT u.*, s.* FROM (SELECT DISTINCT user_country_id, user_country_name, is_user_vip FROM v_call_base) u
      CROSS JOIN {STREAMERS} s) g
LEFT JOIN v_ci i ON g.user_country_name = i.user_country_name
 AND g.is_user_vip = CASE WHEN i.if_vip = 'vip' THEN '1' ELSE '0' END
 AND g.streamer_country_name = i.streamer_country_name""")
view("v_cd", f"""
SELECT g.user_country_id, g.user_country_name, g.is_user_vip, c.country_id AS streamer_country_id,
       g.streamer_country_name, g.preference, {rnd(div('g.preference', 't.tot'), 5)} AS percentage,
       g.preference_rule, {rnd(div('g.preference_rule', 't.tot'), 5)} AS percentage_rule
FROM v_cg g
LEFT JOIN (SELECT user_country_id, user_country_name, is_user_vip,
                  SUM(CAST(preference AS DECIMAL(28,10))) AS tot
           FROM v_cg GROUP BY user_country_id, user_country_name, is_user_vip) t
  ON g.user_country_id = t.user_country_id AND g.user_country_name = t.user_country_name
 AND g.is_user_vip = t.is_user_vip
LEFT JOIN {NAME_ID} c ON g.streamer_country_name = c.country_name_en""")
query("share_country_rule", "SELECT * FROM v_cd")

view("v_rg", f"""
SELECT g.user_region_id, g.user_region_name, g.is_user_vip, g.streamer_country_name,
       COALESCE(i.final_score1, 0.5::DOUBLE) AS preference
FROM (SELECT u.*, s.* FROM (SELECT x.user_region_name, x.is_user_vip, r.region_id AS user_region_id
                            FROM (SELECT DISTINCT user_region_name, is_user_vip FROM v_call_base) x
                            LEFT JOIN (SELECT DISTINCT region_name, region_id FROM v_country_region) r
                              ON x.user_region_name = r.region_name) u
      CROSS JOIN {STREAMERS} s) g
LEFT JOIN v_ri i ON g.user_region_name = i.user_region_name
 AND g.is_user_vip = CASE WHEN i.if_vip = 'vip' THEN '1' ELSE '0' END
 AND g.streamer_country_name = i.streamer_country_name""")
view("v_rd", f"""
SELECT g.user_region_id, g.user_region_name, g.is_user_vip, c.country_id AS streamer_country_id,
       g.streamer_country_name, g.preference, {rnd(div('g.preference', 't.tot'), 5)} AS percentage
FROM v_rg g
LEFT JOIN (SELECT user_region_id, user_region_name, is_user_vip, SUM(CAST(preference AS DECIMAL(28,10))) AS tot
           FROM v_rg GROUP BY user_region_id, user_region_name, is_user_vip) t
  ON g.user_region_id = t.user_region_id AND g.user_region_name = t.user_region_name
 AND g.is_user_vip = t.is_user_vip
LEFT JOIN {NAME_ID} c ON g.streamer_country_name = c.country_name_en""")
query("share_region_blend", "SELECT * FROM v_rd")


def _top_views(p: str, dist: str, allow: str, keys: list[str], user: str, by: str) -> None:
    ks = ", ".join(keys)
    view(f"v_{p}_top", f"""
SELECT {ks}, streamer_country_id, streamer_country_name, preference FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {user}, is_user_vip ORDER BY preference DESC,
            streamer_country_name ASC NULLS FIRST, streamer_country_id ASC NULLS FIRST) AS rnk
  FROM (SELECT DISTINCT {ks}, streamer_country_id, streamer_country_name, {by} AS preference
        FROM {dist} d WHERE EXISTS (SELECT 1 FROM {allow} a WHERE a.{user} = d.{user}
                                     AND a.streamer_country_name = d.streamer_country_name)) f) r
WHERE rnk <= 3""")
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    view(f"v_{p}_share", f"""
SELECT t.*, {rnd(div('t.preference', 's.tot'), 3)} AS percentage
FROM v_{p}_top t LEFT JOIN (SELECT {ks}, SUM(CAST(preference AS DECIMAL(28,10))) AS tot
                            FROM v_{p}_top GROUP BY {ks}) s ON {on}""")


CK = ["user_country_id", "user_country_name", "is_user_vip"]
RK = ["user_region_id", "user_region_name", "is_user_vip"]
_top_views("ct", "v_cd", "v_c_allow", CK, "user_country_name", "preference")
_top_views("ctr", "v_cd", "v_c_allow", CK, "user_country_name", "preference_rule")
_top_views("rt", "v_rd", "v_r_allow_sum", RK, "user_region_name", "preference")
query("top3_country", "SELECT * FROM v_ct_top")
query("top3_country_rule", "SELECT * FROM v_ctr_top")
query("top3_region", "SELECT * FROM v_rt_top")
query("recall_share_country", "SELECT * FROM v_ct_share")
query("recall_share_country_rule", "SELECT * FROM v_ctr_share")
query("recall_share_region", "SELECT * FROM v_rt_share")
query("job_country_recall", "SELECT * FROM v_ct_share")
query("job_region_recall", "SELECT * FROM v_rt_share")

# ==========================================================================
# Sinks
# ==========================================================================
query("write_then_read_day", f"""
SELECT CAST(streamer_id AS VARCHAR) AS streamer_id, CAST(streamer_country_id AS VARCHAR) AS streamer_country_id,
       streamer_country_name, level, rfm_score, '{RUN_DATE}' AS dt FROM v_streamer_level""")
query("conform_schema", """
SELECT CAST(streamer_id AS VARCHAR) AS streamer_id, CAST(streamer_country_id AS VARCHAR) AS streamer_country_id,
       streamer_country_name, frequency, CAST(trunc(monetary) AS BIGINT) AS monetary,
       CAST(trunc(monetary1) AS BIGINT) AS monetary1, recency, frequency_rnk, monetary_rnk, monetary1_rnk,
       recency_rnk, frequency_score, monetary_score, monetary1_score, recency_score,
       rfm_combination_score, rfm_score FROM v_s_score""")
_MATCH_ROWS = """
SELECT CAST(c.user_id AS VARCHAR) AS user_id, CAST(c.user_country_id AS VARCHAR) AS user_country_id,
       c.user_country_name, c.vip_level AS is_user_vip, CAST(c.streamer_id AS VARCHAR) AS streamer_id,
       '' AS streamer_country_id, s.country_name_ab AS streamer_country_name,
       CAST(c.channel_id AS BIGINT) AS channel_id, c.call_begin_time,
       CAST(c.call_total_length AS DOUBLE) AS call_total_length,
       CAST(c.call_gold_coin_amount AS DOUBLE) AS call_gold_coin_amount,
       CAST(c.gift_gold_coin_amount AS DOUBLE) AS gift_gold_coin_amount,
       CAST(c.day AS VARCHAR) AS day
FROM v_calls c JOIN (SELECT DISTINCT user_id, country_name_ab FROM v_streamer_country) s
  ON c.streamer_id = s.user_id"""
query("backfill_match", _MATCH_ROWS + f"""
WHERE c.day BETWEEN DATE '{WINDOW_END}' - INTERVAL 26 DAY AND DATE '{WINDOW_END}' - INTERVAL 1 DAY""")
query("write_empty_day", _MATCH_ROWS + f"""
WHERE c.day BETWEEN DATE '{WINDOW_END}' - INTERVAL 3 DAY AND DATE '{WINDOW_END}' - INTERVAL 2 DAY""")
