"""DuckDB text for every registered query, over the given tables."""

from __future__ import annotations

DAY = 86_400_000
FIVE_SECONDS = 5_000
FORMAT = "'%Y-%m-%d %H:%M:%S'"

EV = r"""ev AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k, epoch_us(ts) // 1000 AS ms
  FROM events)"""

PAGE = EV + """, page AS (
  SELECT user_id || '-' || (k % 10) AS mid,
         CASE WHEN k % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         CAST(k % 30 AS VARCHAR) AS sc, CAST(k % 2 AS VARCHAR) AS is_new,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'course_detail' WHEN 'purchase' THEN 'order'
              WHEN 'signup' THEN 'search' ELSE 'other' END AS page_id,
         CASE WHEN k % 5 <> 0 THEN 'home' END AS last_page_id,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS item,
         CASE event_type WHEN 'signup' THEN 'keyword' WHEN 'purchase' THEN 'order_id' END AS item_type,
         CAST(floor(value * 1000) AS BIGINT) AS during_time, ms AS ts, event_id
  FROM ev)"""

CHANGES = EV + """, changes AS (
  SELECT event_id, user_id, k, ms // 1000 AS ts,
         CASE WHEN event_type = 'error' THEN 'other' ELSE 'edu' END AS database,
         CASE WHEN k <> 13 THEN 't' || (k % 20) END AS tab,
         CASE event_type WHEN 'view' THEN 'bootstrap-insert' WHEN 'click' THEN 'update'
              WHEN 'purchase' THEN 'delete' ELSE 'insert' END AS type
  FROM ev),
clean AS (
  SELECT event_id, user_id, k, ts, tab, CASE WHEN type = 'bootstrap-insert' THEN 'insert' ELSE type END AS type
  FROM changes
  WHERE database = 'edu' AND tab IS NOT NULL AND type IN ('insert', 'update', 'bootstrap-insert')
    AND k <> 17 AND event_id % 11 <> 0)"""

CONFIG = CHANGES + """, config AS (
  SELECT 't' || (k % 20) AS source_table, CASE WHEN k % 2 = 0 THEN 'insert' ELSE 'update' END AS source_type,
         'sink_' || (k % 20) AS sink_table, CASE WHEN event_id % 2 = 0 THEN 'dim' ELSE 'dwd' END AS sink_type,
         CASE WHEN user_id % 2 = 0 THEN 'id,k' ELSE 'id,user_id' END AS sink_columns, 'id' AS sink_pk,
         CASE event_type WHEN 'view' THEN 'c' WHEN 'click' THEN 'u' WHEN 'error' THEN 'd'
              WHEN 'signup' THEN 'r' ELSE 'u' END AS op, event_id
  FROM ev),
dim_config AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY event_id DESC) AS n
                 FROM config WHERE sink_type = 'dim') WHERE n = 1 AND op <> 'd'),
dwd_config AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, source_type ORDER BY event_id DESC) AS n
                 FROM config WHERE sink_type = 'dwd') WHERE n = 1 AND op <> 'd')"""

# the configuration in force when half of the events have come, and in the end
PHASES = CONFIG + """, middle AS (SELECT max(event_id) // 2 AS mid FROM events),
phase_dim AS (SELECT 1 AS phase, * FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY event_id DESC) AS n
    FROM config, middle WHERE sink_type = 'dim' AND event_id <= mid) WHERE n = 1 AND op <> 'd'
  UNION ALL BY NAME SELECT 2 AS phase, * FROM dim_config),
phase_dwd AS (SELECT 1 AS phase, * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, source_type ORDER BY event_id DESC) AS n
    FROM config, middle WHERE sink_type = 'dwd' AND event_id <= mid) WHERE n = 1 AND op <> 'd'
  UNION ALL BY NAME SELECT 2 AS phase, * FROM dwd_config),
came AS (SELECT *, CASE WHEN event_id <= mid THEN 1 ELSE 2 END AS phase FROM clean, middle)"""

SECONDS = "epoch_us({}) // 1000000"
SHIP = SECONDS.format("l_shipdate")
MADE = SECONDS.format("o_orderdate")
ARRIVAL = ("CAST((CAST(l_partkey AS HUGEINT) * 1000000000000 + CAST(round(l_extendedprice * 100) AS HUGEINT)) "
           "* 1000000000000 + l_suppkey AS DECIMAL(38,0))")
SHIP_TEXT = f"strftime(l_shipdate, {FORMAT})"
MADE_TEXT = f"strftime(o_orderdate, {FORMAT})"

DETAIL = EV + f""", source AS (
  SELECT event_id, CAST(k % 30 AS VARCHAR) AS sc FROM ev WHERE event_type = 'purchase'),
detail AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_suppkey AS VARCHAR) AS course_id,
         'course ' || l_suppkey AS course_name, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_extendedprice AS DECIMAL(16,2)) AS final_amount,
         CAST(c_nationkey AS VARCHAR) AS province_id, {SHIP_TEXT} AS create_time, sc,
         {SHIP} AS ts, {ARRIVAL} AS seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       LEFT JOIN source ON l_orderkey = event_id)"""


def corrected(source: str, key: str, plain: str, measures: dict[str, str], where: str = "TRUE") -> str:
    """First row of a key as it is; later rows give the row before, with measures new minus old."""
    old = "lag({}) OVER w"
    columns = [f"CASE WHEN n = 1 THEN {c} ELSE old_{c} END AS {c}" for c in plain.split()]
    columns += [f"CASE WHEN n = 1 THEN {m} ELSE CAST({m} - old_{m} AS {kind}) END AS {m}"
                for m, kind in measures.items()]
    inner = [f"{old.format(c)} AS old_{c}" for c in [*plain.split(), *measures]]
    return (f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER w AS n, {', '.join(inner)} "
            f"FROM {source} WHERE {where} WINDOW w AS (PARTITION BY {key} ORDER BY ts, seq))")


ORDER_PLAIN = "id order_id user_id course_id course_name province_id sc ts seq"
MONEY = {"final_amount": "DECIMAL(16,2)"}
FIXED = DETAIL + ", fixed AS (" + corrected("detail", "id", ORDER_PLAIN, MONEY) + ")"
FIXED_SOURCED = DETAIL + ", fixed AS (" + corrected("detail", "id", ORDER_PLAIN, MONEY, "sc IS NOT NULL") + ")"

ANSWER = f"""answer AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS exam_id,
         CAST(l_partkey AS VARCHAR) AS paper_id, CAST(l_partkey AS VARCHAR) AS question_id,
         CAST(l_suppkey AS VARCHAR) AS user_id, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS correct,
         l_quantity AS exam_score, CAST(l_linenumber * 60 AS BIGINT) AS duration_sec,
         {SHIP} AS ts, {ARRIVAL} AS seq
  FROM lineitem)"""
EXAM_PLAIN = "exam_id paper_id user_id ts seq"
EXAM_MEASURES = {"exam_score": "DOUBLE", "duration_sec": "BIGINT"}
FIXED_EXAM = ANSWER + ", fixed AS (" + corrected("answer", "exam_id", EXAM_PLAIN, EXAM_MEASURES) + ")"


def window(n: int, millis: str = "ts") -> str:
    return f"({millis} // {n}) * {n} AS w"


def bounds(n: int) -> str:
    return (f"strftime(make_timestamp(w * 1000), {FORMAT}) AS stt, "
            f"strftime(make_timestamp((w + {n}) * 1000), {FORMAT}) AS edt")


def total(column: str, name: str | None = None) -> str:
    return f"CAST(coalesce(sum({column}), 0) AS BIGINT) AS {name or column}"


def distinct(column: str, name: str) -> str:
    return f"count(DISTINCT coalesce({column}, '<none>')) AS {name}"


# a device's and a user's days

VISITS = PAGE + """, visits AS (
  SELECT *, row_number() OVER (PARTITION BY mid, ts // 86400000
                               ORDER BY ts, last_page_id NULLS FIRST, sc, is_new) = 1 AS first
  FROM page)"""

LOGINS = PAGE + """, firsts AS (
  SELECT uid, ts // 86400000 AS d, min(ts) AS ts FROM page WHERE uid IS NOT NULL GROUP BY ALL),
days AS (SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY d) AS before FROM firsts),
logins AS (
  SELECT ts, 0 AS user_count, 0 AS back_count FROM page WHERE uid IS NOT NULL
  UNION ALL
  SELECT ts, 1, CASE WHEN (ts - before * 86400000) // 86400000 > 7 THEN 1 ELSE 0 END FROM days)"""

FLAGS = PAGE + """, first_rows AS (
  SELECT mid, ts // 86400000 - CASE WHEN is_new = '1' THEN 0 ELSE 1 END AS first_day
  FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, is_new DESC) AS n FROM page) WHERE n = 1),
flagged AS (
  SELECT page.* REPLACE (CASE WHEN is_new = '1' AND ts // 86400000 <> first_day THEN '0' ELSE is_new END AS is_new)
  FROM page JOIN first_rows USING (mid))"""

PLAYS = EV + """, play AS (
  SELECT CAST(user_id * 20 + k % 20 AS VARCHAR) AS video_id, CAST(k AS VARCHAR) AS sid,
         CASE WHEN k % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN k % 9 <> 0 THEN CAST(floor(value) AS BIGINT) END AS play_sec, ms AS ts
  FROM ev),
chaptered AS (
  SELECT play.*, p_brand AS chapter_id, 'Chapter ' || p_brand AS chapter_name
  FROM play LEFT JOIN part ON video_id = CAST(p_partkey AS VARCHAR))"""

REVIEWS = EV + """, review AS (
  SELECT CAST(k AS VARCHAR) AS course_id, CAST(user_id AS VARCHAR) AS user_id, 1 + user_id % 5 AS score,
         CASE WHEN user_id % 5 = 4 THEN 1 ELSE 0 END AS good_count,
         CASE WHEN k % 2 = 0 THEN ms ELSE ms // 1000 * 1000 END AS ts
  FROM ev WHERE event_type = 'view')"""

CARTS = EV + """, cart AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS course_id,
         'course ' || k AS course_name, ms // 1000 AS ts
  FROM ev WHERE event_type = 'click')"""

ORDER_COUNTS = (f"{distinct('order_id', 'order_count')}, {distinct('user_id', 'user_count')}, "
                "CAST(sum(final_amount) AS DECIMAL(18,2)) AS final_amount")


def summary(number: int, n: int) -> str:
    """The summary without dimension fields."""
    b = bounds(n)
    ms = window(n)
    sec = window(n, "(ts * 1000)")
    if number == 1:
        return f"""WITH {VISITS} SELECT {b}, sc AS source, is_new, {total('CASE WHEN first THEN 1 ELSE 0 END', 'uv_ct')},
          {total('CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END', 'sv_ct')}, count(*) AS pv_ct,
          {total('during_time', 'dur_sum')}
          FROM (SELECT *, {ms} FROM visits) GROUP BY w, sc, is_new"""
    if number == 2:
        return f"""WITH {PAGE} SELECT {b}, item AS keyword, count(*) AS keyword_count
          FROM (SELECT *, {ms} FROM page WHERE item_type = 'keyword' AND item IS NOT NULL) GROUP BY w, item"""
    if number == 3:
        return f"""WITH {PAGE} SELECT {b}, count(*) FILTER (page_id = 'home') AS home_count,
          count(*) FILTER (page_id = 'course_detail') AS detail_count
          FROM (SELECT *, {ms} FROM page WHERE page_id IN ('home', 'course_detail')) GROUP BY w"""
    if number == 4:
        return f"""WITH {LOGINS} SELECT {b}, {total('user_count')}, {total('back_count')}
          FROM (SELECT *, {ms} FROM logins) GROUP BY w"""
    if number == 5:
        return f"""WITH {EV} SELECT {b}, count(*) AS user_register_count
          FROM (SELECT {window(n, '(ms // 1000 * 1000)')} FROM ev WHERE event_type = 'signup') GROUP BY w"""
    if number == 6:
        return f"""WITH {CARTS} SELECT {b}, course_id, arg_min(course_name, ts) AS course_name,
          count(*) AS cart_count FROM (SELECT *, {sec} FROM cart) GROUP BY w, course_id"""
    if number == 7:
        return f"""WITH {FIXED} SELECT {b}, course_id, arg_min(course_name, ts) AS course_name, {ORDER_COUNTS}
          FROM (SELECT *, {sec} FROM fixed) GROUP BY w, course_id"""
    if number == 8:
        return f"""WITH {FIXED} SELECT {b}, province_id, {ORDER_COUNTS}
          FROM (SELECT *, {sec} FROM fixed) GROUP BY w, province_id"""
    if number == 9:
        return f"""WITH {FIXED_SOURCED} SELECT {b}, sc AS source_id, {ORDER_COUNTS}
          FROM (SELECT *, {sec} FROM fixed) GROUP BY w, sc"""
    if number == 10:
        return f"""WITH {DETAIL} SELECT {b}, province_id, {distinct('user_id', 'user_count')}
          FROM (SELECT *, {sec} FROM detail) GROUP BY w, province_id"""
    if number == 11:
        return f"""WITH {REVIEWS} SELECT {b}, course_id,
          CAST(sum(score) // count(DISTINCT user_id) AS BIGINT) AS avg_score,
          count(DISTINCT user_id) AS user_count,
          CAST(sum(good_count) // count(DISTINCT user_id) AS BIGINT) AS good_rate,
          CAST(sum(score) AS DOUBLE) / count(DISTINCT user_id) AS avg_score_exact,
          CAST(sum(good_count) AS DOUBLE) / count(DISTINCT user_id) AS good_rate_exact
          FROM (SELECT *, {ms} FROM review) GROUP BY w, course_id"""
    if number == 12:
        return f"""WITH {FIXED_EXAM} SELECT {b}, paper_id, sum(exam_score) / count(DISTINCT user_id) AS avg_score,
          count(DISTINCT user_id) AS user_count,
          CAST(trunc(CAST(sum(duration_sec) AS DOUBLE) / count(DISTINCT user_id)) AS BIGINT) AS avg_dur_sec,
          CAST(sum(duration_sec) AS DOUBLE) / count(DISTINCT user_id) AS avg_dur_sec_exact
          FROM (SELECT *, {sec} FROM fixed) GROUP BY w, paper_id"""
    if number == 13:
        return f"""WITH {ANSWER} SELECT {b}, question_id, count(*) AS answer_count,
          {total('correct', 'correct_answer_count')}, count(DISTINCT user_id) AS answer_user_count,
          count(DISTINCT CASE WHEN correct = 1 THEN user_id END) AS correct_answer_user_count
          FROM (SELECT *, {sec} FROM answer) GROUP BY w, question_id"""
    if number == 14:
        return f"""WITH {PLAYS} SELECT {b}, chapter_id, chapter_name, {distinct('sid', 'play_count')},
          {total('play_sec')}, {distinct('user_id', 'user_count')}
          FROM (SELECT *, {ms} FROM chaptered WHERE chapter_id IS NOT NULL) GROUP BY w, chapter_id, chapter_name"""
    raise KeyError(number)


def as_text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


NATION = f"(SELECT {as_text('n_nationkey')} AS dim_id, n_name, {as_text('n_regionkey')} AS category_id FROM nation)"
REGION = f"(SELECT {as_text('r_regionkey')} AS dim_id, r_name AS category_name FROM region)"
COURSE = f"(SELECT {as_text('s_suppkey')} AS dim_id, s_name, {as_text('s_nationkey')} AS subject_id FROM supplier)"
PART = (f"(SELECT {as_text('p_partkey')} AS dim_id, p_name, p_type, {as_text('p_partkey')} AS course_id "
        "FROM part)")
COURSE_PATH = f"""LEFT JOIN {COURSE} c ON s.course_id = c.dim_id LEFT JOIN {NATION} u ON c.subject_id = u.dim_id
  LEFT JOIN {REGION} g ON u.category_id = g.dim_id"""


def with_dims(number: int, n: int) -> str:
    """The summary as it is stored."""
    base = f"SELECT {{}} FROM ({summary(number, n)}) s "
    if number == 1:
        return base.format("s.*, n_name AS source_name") + f"LEFT JOIN {NATION} d ON source = d.dim_id"
    if number in (6, 7):
        return base.format("s.*, c.subject_id, u.n_name AS subject_name, u.category_id, g.category_name") + COURSE_PATH
    if number in (8, 10):
        return base.format("s.*, n_name AS province_name") + f"LEFT JOIN {NATION} d ON province_id = d.dim_id"
    if number == 9:
        return base.format("s.*, n_name AS source_name") + f"LEFT JOIN {NATION} d ON source_id = d.dim_id"
    if number == 11:
        return base.format("s.*, s_name AS course_name") + f"LEFT JOIN {COURSE} c ON s.course_id = c.dim_id"
    if number == 12:
        return base.format("s.*, p.p_name AS paper_name, p.course_id, c.s_name AS course_name, c.subject_id, "
                           "u.n_name AS subject_name, u.category_id, g.category_name") + (
            f"LEFT JOIN {PART} p ON paper_id = p.dim_id LEFT JOIN {COURSE} c ON p.course_id = c.dim_id "
            f"LEFT JOIN {NATION} u ON c.subject_id = u.dim_id LEFT JOIN {REGION} g ON u.category_id = g.dim_id")
    if number == 13:
        return base.format("s.*, p_type AS question_name") + f"LEFT JOIN {PART} p ON question_id = p.dim_id"
    return summary(number, n)
