"""Independent SQL formulation of every registered query (DuckDB dialect).

Each query is ``WITH <views it needs> SELECT ...`` over the raw test tables.
Views are registered here by name in dependency order; ``sql(final)``
pulls in exactly the views the final SELECT references (transitively).
The SQL is written from the reference's semantics, not from the Spark
code: global ranks are plain ``ROW_NUMBER() OVER (ORDER BY ...)``, reverse
scores are separate ascending row numbers, group totals are GROUP BY +
JOIN.  Numeric rules shared with the Spark side: DECIMAL sums, DOUBLE
division with NULL on zero, half-up rounding through DECIMAL(28,10);
integer keys are BIGINT at the output (dimension ids widened once here).
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

RUN_DATE = "2001-12-31"
WINDOW_END = "2001-08-01"


def view(name: str, body: str) -> None:
    VIEWS[name] = body


def sql(final: str) -> str:
    """``final`` prefixed with the views it references, in definition order."""
    need: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for n in VIEWS:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                todo.append(VIEWS[n])
    parts = [f"{n} AS (\n{VIEWS[n]}\n)" for n in VIEWS if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" + final) if parts else final


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def lvl3(p: str) -> str:
    return (f"CASE WHEN {p} <= 1.0::DOUBLE/9 THEN 1 WHEN {p} <= 4.0::DOUBLE/9 THEN 2 "
            f"ELSE 3 END::BIGINT")


def lvl5(p: str) -> str:
    return (f"CASE WHEN {p} <= 1.0::DOUBLE/15 THEN 1 WHEN {p} <= 3.0::DOUBLE/15 THEN 2 "
            f"WHEN {p} <= 6.0::DOUBLE/15 THEN 3 WHEN {p} <= 10.0::DOUBLE/15 THEN 4 "
            f"ELSE 5 END::BIGINT")


def quint(p: str) -> str:
    return (f"CASE WHEN {p} <= 1.0::DOUBLE/25 THEN 5 WHEN {p} <= 4.0::DOUBLE/25 THEN 4 "
            f"WHEN {p} <= 9.0::DOUBLE/25 THEN 3 WHEN {p} <= 16.0::DOUBLE/25 THEN 2 "
            f"ELSE 1 END::BIGINT")


def scale15(x: str, mn: str, mx: str, flat: int | None) -> str:
    core = f"1.0::DOUBLE + 4.0::DOUBLE * {div(f'{x} - {mn}', f'{mx} - {mn}')}"
    if flat is None:
        return rnd(core, 2)
    alt = f"1.0::DOUBLE + 4.0::DOUBLE * CAST({x} - {mn} AS DOUBLE) / {float(flat)!r}::DOUBLE"
    return rnd(f"CASE WHEN CAST({mx} - {mn} AS DOUBLE) > 0 THEN {core} ELSE {alt} END", 2)


# --------------------------------------------------------------------------
# Fixture views (FIXTURES.md part 2)
# --------------------------------------------------------------------------
view("v_country_region", """
SELECT CAST(n.n_nationkey AS BIGINT) AS country_id, n.n_name AS country_name_en,
       CONCAT('N', CAST(n.n_nationkey AS VARCHAR)) AS country_ab,
       CAST(r.r_regionkey AS BIGINT) AS region_id, r.r_name AS region_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

view("v_user_info", """
SELECT c.c_custkey AS user_id, CAST(c.c_nationkey AS BIGINT) AS country_id, n.n_name AS country_name_en,
       CASE WHEN c.c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'free'
            WHEN c.c_mktsegment = 'FURNITURE' THEN NULL ELSE lower(c.c_mktsegment) END AS vip_level
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")

view("v_streamer_country", """
SELECT s_suppkey AS user_id, CONCAT('N', CAST(s_nationkey AS VARCHAR)) AS country_name_ab FROM supplier""")

view("v_streamer_weight", """
SELECT s_suppkey AS streamer_id,
       CASE WHEN s_acctbal < 0 THEN CAST(0.8 AS DECIMAL(4,2)) ELSE CAST(1.1 AS DECIMAL(4,2)) END AS weight
FROM supplier WHERE s_suppkey % 2 = 0""")

view("v_calls", """
SELECT u.user_id, u.country_id AS user_country_id, u.country_name_en AS user_country_name,
       ur.region_name AS user_region_name, COALESCE(u.vip_level, 'free') AS vip_level,
       l.l_suppkey AS streamer_id, sr.country_id AS streamer_country_id,
       sr.country_name_en AS streamer_country_name, sr.country_ab AS streamer_country_name_ab,
       sr.region_name AS streamer_region_name,
       l.l_orderkey AS room_id, l.l_linenumber AS channel_id, l.l_shipdate AS call_begin_time,
       CAST(l.l_quantity AS DECIMAL(12,2)) AS call_total_length,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) AS call_gold_coin_amount,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS gift_gold_coin_amount,
       CAST(o.o_orderdate AS DATE) AS day, l.l_returnflag, l.l_linestatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN v_user_info u ON o.o_custkey = u.user_id
JOIN v_country_region ur ON u.country_id = ur.country_id
JOIN v_streamer_country s ON l.l_suppkey = s.user_id
JOIN v_country_region sr ON s.country_name_ab = sr.country_ab""")

view("v_country_preference_pre", """
SELECT user_country_name AS country_name_en, CONCAT('N', CAST(user_country_id AS VARCHAR)) AS country,
       user_region_name AS region_name, CASE WHEN vip_level = 'free' THEN 'free' ELSE 'vip' END AS if_vip,
       streamer_country_name_ab AS streamer_country, streamer_region_name AS streamer_region,
       COUNT(DISTINCT user_id) AS user_cnt, COUNT(*) AS both_play_times,
       CAST(SUM(CASE WHEN l_returnflag <> 'A' THEN 1 ELSE 0 END) AS BIGINT) AS both_call_times,
       CAST(SUM(CASE WHEN channel_id <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS both_request_times,
       CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS both_success_times,
       CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS hotvideo_play_times,
       CAST(SUM(CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'A' THEN 1 ELSE 0 END) AS BIGINT) AS hotvideo_call_times,
       CAST(SUM(CASE WHEN l_linestatus = 'O' AND channel_id <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS hotvideo_request_times,
       CAST(SUM(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS hotvideo_success_times,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'A' THEN user_id END) AS friend_call_users,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS friend_call_times,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN user_id END) AS friend_video_users,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS friend_video_times,
       SUM(call_total_length) AS total_video_duration,
       CAST(SUM(call_total_length) AS DOUBLE) / COUNT(*) AS avg_video_duration,
       SUM(call_gold_coin_amount) AS friend_total_gold
FROM v_calls GROUP BY user_country_name, user_country_id, user_region_name,
         CASE WHEN vip_level = 'free' THEN 'free' ELSE 'vip' END,
         streamer_country_name_ab, streamer_region_name""")

view("v_request_record", """
SELECT user_id, event_id % 2 + 1 AS target_user_id, ts AS create_time,
       CASE event_id % 4 WHEN 0 THEN '8' WHEN 1 THEN '1' WHEN 2 THEN '13' ELSE '1' END AS place_id,
       CASE event_id % 4 WHEN 0 THEN '8-1-1-18' WHEN 1 THEN '1-5-15-12' WHEN 2 THEN '13-12-17-1'
            ELSE '1-1-4-7' END AS event_id
FROM events WHERE event_type IN ('view','signup')""")

view("v_video_record", """
SELECT user_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS matched_id, event_id AS room_id,
       ts AS create_time, CAST(ROUND(ABS(value) * 100) AS BIGINT) * 10 AS video_time,
       1 + event_id % 2 AS goddess_video,
       CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 12 WHEN 3 THEN 21 ELSE 1 END AS goddess_location,
       CASE WHEN event_id % 7 < 4 THEN 1 ELSE 0 END AS is_pay, event_id % 3 AS gender_condition,
       CASE WHEN event_id % 11 < 8 THEN 0 ELSE 1 END AS request_type
FROM events WHERE event_type IN ('click','purchase')""")

view("v_minute_gold", """
SELECT user_id, matched_id AS remote_user_id, room_id, CAST(video_time % 1000 AS DECIMAL(12,2)) AS gold_num
FROM v_video_record WHERE room_id % 3 <> 0""")

view("v_goddess_gold", """
SELECT user_id, remote_user_id, room_id, gold_num FROM v_minute_gold WHERE room_id % 4 = 0""")

view("v_gift_detail", """
SELECT user_id AS send_user_id, event_id % 2 + 1 AS user_id, CAST(value AS DECIMAL(12,2)) AS gift_gold
FROM events WHERE event_type = 'error'""")


QUERIES: dict[str, str] = {}


def query(name: str, final: str) -> None:
    QUERIES[name] = final


def all_sql() -> dict[str, str]:
    from . import oracle_stages, oracle_windows  # noqa: F401  (register the stage views)
    return {k: sql(v) for k, v in QUERIES.items()}
