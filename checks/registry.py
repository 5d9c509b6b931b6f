"""Every operator as a query over the given tables, with its DuckDB text."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import faults, oracles as O
from checks.inputs import DATABASE, FAR_YEAR, Inputs, text
from eduflow import schemas, session
from eduflow.functions import values as V
from eduflow.operators import filters, joins, projections, routing, state, windows
from eduflow.plans import facts, keywords, report, summaries
from eduflow.sources import topics
from eduflow.streaming import sinks, states
from eduflow.streaming.jobs import Warehouse
from eduflow.streaming.window_store import WindowStore

Query = Callable[[Inputs], DataFrame]
ENTRIES: dict[str, tuple[Query, str | None]] = {}

TABLES = dict(enumerate(windows.SUMMARIES, start=1))
SUMMARY_NAMES = {
    1: "source_page_view", 2: "keyword", 3: "home_detail", 4: "user_login", 5: "user_register", 6: "cart_add",
    7: "course_order", 8: "province_order", 9: "source_order", 10: "province_payment", 11: "course_review",
    12: "exam_paper", 13: "exam_question", 14: "video_chapter"}
REPORT_DATE = "19990328"


def add(name: str, sql: str | None):
    def keep(query: Query) -> Query:
        ENTRIES[name] = (query, sql)
        return query
    return keep


# inputs of the summaries

def summary_facts(i: Inputs, number: int) -> DataFrame:
    if number <= 4:
        return i.page_log()
    return {
        5: i.registers, 6: lambda: filters.cart_adds(i.cart_changes(), DATABASE), 7: i.order_details,
        8: i.order_details, 9: i.order_details, 10: i.payment_details, 11: i.comments,
        12: i.exam_questions, 13: i.exam_questions, 14: i.video_plays}[number]()


def windowed(i: Inputs, number: int, length: str) -> DataFrame:
    return summaries.windowed(TABLES[number], summary_facts(i, number), i.dim, length)


RATES = {11: windows.review_rates, 12: windows.exam_rates}


def _summaries() -> None:
    for number, short in SUMMARY_NAMES.items():
        def aggregated(i: Inputs, number=number) -> DataFrame:
            rows = windowed(i, number, "5 seconds")
            return RATES.get(number, lambda r: r)(rows)

        def stored(i: Inputs, number=number) -> DataFrame:
            return summaries.summary(TABLES[number], summary_facts(i, number), i.dim, "1 day")

        add(f"agg_{number:02d}_{short}", O.summary(number, O.FIVE_SECONDS))(aggregated)
        add(f"dws_{number:02d}_{short}_daily", O.with_dims(number, O.DAY))(stored)


_summaries()


@add("agg_15_order_by_source", f"""SELECT source_name, CAST(sum(final_amount) AS DECIMAL(18,2)) AS final_amount
  FROM ({O.with_dims(9, O.FIVE_SECONDS)}) WHERE strftime(CAST(stt AS TIMESTAMP), '%Y%m%d') = '{REPORT_DATE}'
  GROUP BY source_name""")
def order_by_source(i: Inputs) -> DataFrame:
    """The window table is stored by day, and the report reads one day of it."""
    store = WindowStore(i.spark, f"windows_{uuid.uuid4().hex}", session.work_folder(i.spark))
    store.store(TABLES[9], summaries.summary(TABLES[9], summary_facts(i, 9), i.dim), 0)
    return report.stored_order_by_source(store, TABLES[9], REPORT_DATE)


def _sketched(number: int, short: str) -> None:
    """Days out of 5 s windows by merged sketches, beside the exact counts: how far apart they are at most."""
    spec = windows.SUMMARIES[TABLES[number]]
    counts = ", ".join([*spec.keys, "stt", *spec.distinct])
    near = ", ".join(f"true AS {r}_near" for r in spec.distinct)

    def compared(i: Inputs) -> DataFrame:
        rows = summaries.measured(TABLES[number], summary_facts(i, number), i.dim)
        daily = windows.rolled_up(session.stored(windows.with_sketches(rows, spec)), spec)
        exact = windowed(i, number, "1 day").select("stt", *spec.keys, *spec.distinct)
        about = daily.select("stt", *spec.keys, *[F.col(r).alias(f"about_{r}") for r in spec.distinct])
        return exact.join(about, ["stt", *spec.keys], "full").select(
            *spec.keys, "stt", *spec.distinct,
            *[(F.abs(F.col(f"about_{r}") - F.col(r)) <= 0.05 * F.col(r)).alias(f"{r}_near") for r in spec.distinct])

    add(f"agg_{number:02d}_{short}_sketched", f"SELECT {counts}, {near} FROM ({O.summary(number, O.DAY)})")(compared)


_sketched(8, "province_order")
_sketched(14, "video_chapter")


# cleaning and selection

@add("src_02_change_log", f"""WITH {O.CHANGES} SELECT tab AS "table", type, count(*) AS n, CAST(sum(ts) AS BIGINT) AS ts_sum
  FROM changes WHERE event_id % 11 <> 0 GROUP BY ALL
  UNION ALL SELECT NULL, NULL, count(*), NULL FROM changes WHERE event_id % 11 = 0""")
def change_log(i: Inputs) -> DataFrame:
    parsed = topics.change_log(i.event_change_lines())
    return parsed.groupBy("table", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("ts").alias("ts_sum"))


@add("src_04_page_log_times", f"""WITH {O.PAGE} SELECT item, item_type,
  strftime(make_timestamp(ts * 1000), {O.FORMAT}) AS et FROM page""")
def page_log_times(i: Inputs) -> DataFrame:
    lines = i.page_log().select(V.json_text(i.page_log()).alias("value"))
    timed = filters.event_timed(topics.page_log(lines))
    return timed.select("item", "item_type", F.date_format("et", V.DATE_TIME).alias("et"))


def _cleaned(i: Inputs) -> DataFrame:
    return filters.clean_changes(filters.parse_changes(i.event_change_lines()), DATABASE)


@add("flt_01_clean_changes", f"""WITH {O.CHANGES} SELECT tab AS "table", CAST(event_id AS VARCHAR) AS id,
  CAST(user_id AS VARCHAR) AS user_id, ts FROM clean""")
def clean_changes(i: Inputs) -> DataFrame:
    return _cleaned(i).select("table", F.col("data")["id"].alias("id"), F.col("data")["user_id"].alias("user_id"), "ts")


@add("flt_02_bootstrap_type", f"""WITH {O.CHANGES} SELECT type, 'bootstrap-note' AS note, count(*) AS n
  FROM clean GROUP BY type""")
def bootstrap_type(i: Inputs) -> DataFrame:
    return _cleaned(i).groupBy("type", F.col("data")["note"].alias("note")).agg(F.count(F.lit(1)).alias("n"))


@add("flt_03_cart_adds", f"WITH {O.CARTS} SELECT * FROM cart")
def cart_adds(i: Inputs) -> DataFrame:
    return facts.cart_adds(i.cart_changes(), DATABASE)


DETAIL_ROWS = f"""SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_suppkey AS VARCHAR) AS course_id,
  'course ' || l_suppkey AS course_name, CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS user_id, CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS final_amount,
  {O.SHIP_TEXT} AS create_time, {O.SHIP} AS ts FROM lineitem"""


@add("flt_04_order_details", DETAIL_ROWS)
def order_details(i: Inputs) -> DataFrame:
    return filters.order_details(i.detail_changes(), DATABASE)


@add("flt_05_order_infos", f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS province_id,
  {O.MADE} AS ts FROM orders JOIN customer ON o_custkey = c_custkey""")
def order_infos(i: Inputs) -> DataFrame:
    return filters.order_infos(i.info_changes(), DATABASE)


@add("flt_06_order_sources", f"WITH {O.PAGE} SELECT item, sc, ts FROM page WHERE page_id = 'order'")
def order_sources(i: Inputs) -> DataFrame:
    return filters.order_sources(i.page_log())


PAYMENT_ROWS = f"""SELECT 'p' || o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS order_id,
  {O.MADE_TEXT} AS create_time, o_orderpriority AS payment_type, {O.MADE} AS ts
  FROM orders WHERE o_orderstatus IN ('F', 'O')"""


@add("flt_07_payments", PAYMENT_ROWS)
def payments(i: Inputs) -> DataFrame:
    return filters.payments(i.payment_changes(), DATABASE)


QUESTION_ROWS = f"""SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS exam_id,
  CAST(l_partkey AS VARCHAR) AS paper_id, CAST(l_partkey AS VARCHAR) AS question_id,
  CAST(l_suppkey AS VARCHAR) AS user_id, CASE WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS is_correct,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS score, {O.SHIP_TEXT} AS create_time, {O.SHIP} AS ts FROM lineitem"""
EXAM_ROWS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 100 AS VARCHAR) AS score,
  CAST(o_custkey AS VARCHAR) AS duration_sec, {O.MADE_TEXT} AS create_time, {O.MADE} AS ts FROM orders"""


@add("flt_08_exam_questions", QUESTION_ROWS)
def exam_questions(i: Inputs) -> DataFrame:
    return filters.exam_questions(i.question_changes(), DATABASE)


@add("flt_09_exams", EXAM_ROWS)
def exams(i: Inputs) -> DataFrame:
    return filters.exams(i.exam_changes(), DATABASE)


@add("flt_10_keyword_views", f"WITH {O.PAGE} SELECT item, ts FROM page WHERE item_type = 'keyword'")
def keyword_views(i: Inputs) -> DataFrame:
    return filters.keyword_views(i.page_log())


@add("flt_11_home_and_detail", f"""WITH {O.PAGE} SELECT CAST(page_id = 'home' AS BIGINT) AS home_count,
  CAST(page_id = 'course_detail' AS BIGINT) AS detail_count, ts FROM page WHERE page_id IN ('home', 'course_detail')""")
def home_and_detail(i: Inputs) -> DataFrame:
    return filters.home_and_detail_views(i.page_log())


@add("flt_12_known_users", f"WITH {O.PAGE} SELECT uid, mid, ts FROM page WHERE uid IS NOT NULL")
def known_users(i: Inputs) -> DataFrame:
    return filters.known_users(i.page_log()).select("uid", "mid", "ts")


@add("flt_13_sourced_orders", f"WITH {O.DETAIL} SELECT id, sc, seq FROM detail WHERE sc IS NOT NULL")
def sourced_orders(i: Inputs) -> DataFrame:
    return filters.sourced_orders(i.order_details()).select("id", "sc", "seq")


# projections

@add("prj_01_column_pruning", f"""WITH {O.CONFIG} SELECT CAST(event_id AS VARCHAR) AS id,
  CASE WHEN sink_columns = 'id,k' THEN CAST(clean.k AS VARCHAR) END AS k,
  CASE WHEN sink_columns <> 'id,k' THEN CAST(clean.user_id AS VARCHAR) END AS user_id, 2 AS columns
  FROM (SELECT c.*, d.sink_columns FROM clean c JOIN dim_config d ON c.tab = d.source_table) clean""")
def column_pruning(i: Inputs) -> DataFrame:
    routed = routing.route_dims(_cleaned(i), _config(i, "dim"))
    data = F.col("data")
    return routed.select(data["id"].alias("id"), data["k"].alias("k"), data["user_id"].alias("user_id"),
                         F.size(data).alias("columns"))


SPLIT = f"""WITH {O.EV}, part AS (
  SELECT 'start' AS kind, event_id, CAST(NULL AS VARCHAR) AS page_id, CAST(event_id AS VARCHAR) AS item
    FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT 'page', event_id, event_type, CAST(event_id AS VARCHAR)
    FROM ev WHERE event_type IN ('view', 'click', 'purchase')
  UNION ALL SELECT 'err', event_id, NULL, CAST(event_id AS VARCHAR) FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 'appVideo', event_id, NULL, CAST(event_id AS VARCHAR) FROM ev WHERE event_type = 'view'
  UNION ALL SELECT 'action', event_id, NULL, CAST(n AS VARCHAR)
    FROM (SELECT event_id, unnest(range(1, 1 + k % 3)) AS n FROM ev)
  UNION ALL SELECT 'display', event_id, NULL, CAST(n AS VARCHAR)
    FROM (SELECT event_id, unnest(range(1, 1 + k % 4)) AS n FROM ev))
SELECT kind, 'dwd_traffic_' || kind AS topic, user_id || '-' || (k % 10) AS mid, CAST(k % 30 AS VARCHAR) AS sc,
  CAST(user_id AS VARCHAR) AS uid, part.page_id, part.item, CAST(ms AS VARCHAR) AS ts"""


def _split_columns(split: DataFrame) -> DataFrame:
    names = ["mid", "sc", "uid", "page_id", "item", "ts"]
    return split.select("kind", "topic", *[F.col("data")[n].alias(n) for n in names])


@add("prj_02_log_split", SPLIT + " FROM part JOIN ev USING (event_id)")
def log_split(i: Inputs) -> DataFrame:
    return _split_columns(projections.split_log(projections.parse_log(i.raw_log_lines())))


@add("prj_03_cart_measures", f"WITH {O.CARTS} SELECT course_id, course_name, ts * 1000 AS ts, 1 AS cart_count FROM cart")
def cart_measures(i: Inputs) -> DataFrame:
    return summaries.carts(filters.cart_adds(i.cart_changes(), DATABASE))


@add("prj_04_register_measures", f"""WITH {O.EV} SELECT ms // 1000 * 1000 AS ts, 1 AS user_register_count
  FROM ev WHERE event_type = 'signup'""")
def register_measures(i: Inputs) -> DataFrame:
    return projections.register_measures(i.registers())


@add("prj_05_payment_measures", f"WITH {O.DETAIL} SELECT province_id, user_id, ts * 1000 AS ts FROM detail")
def payment_measures(i: Inputs) -> DataFrame:
    return summaries.payments(i.payment_details())


@add("prj_06_review_measures", f"WITH {O.REVIEWS} SELECT course_id, user_id, ts, score, good_count FROM review")
def review_measures(i: Inputs) -> DataFrame:
    return projections.review_measures(i.comments())


@add("prj_07_question_measures", f"""WITH {O.ANSWER} SELECT question_id, user_id, ts * 1000 AS ts, 1 AS answer_count,
  correct AS correct_answer_count FROM answer""")
def question_measures(i: Inputs) -> DataFrame:
    return summaries.exam_questions(i.exam_questions())


@add("prj_08_video_measures", f"""WITH {O.PLAYS} SELECT video_id, sid, user_id, ts,
  coalesce(play_sec, 0) AS play_sec FROM play""")
def video_measures(i: Inputs) -> DataFrame:
    return projections.video_measures(i.video_plays())


# joins of facts

INFO = ("(SELECT CAST(o_orderkey AS VARCHAR) AS info_id, CAST(c_nationkey AS VARCHAR) AS province_id "
        "FROM orders JOIN customer ON o_custkey = c_custkey)")
JOINED = f"""WITH {O.PAGE}, detail AS ({DETAIL_ROWS}),
  order_detail AS (SELECT detail.*, province_id, sc FROM detail JOIN {INFO} ON order_id = info_id
    LEFT JOIN (SELECT item, sc FROM page WHERE page_id = 'order') ON order_id = item)"""


@add("join_01_order_info", f"SELECT d.*, province_id FROM ({DETAIL_ROWS}) d JOIN {INFO} ON order_id = info_id")
def join_info(i: Inputs) -> DataFrame:
    return joins.orders_with_province(order_details(i), order_infos(i))


@add("join_02_order_source", f"""WITH {O.PAGE} SELECT d.*, sc FROM ({DETAIL_ROWS}) d
  LEFT JOIN (SELECT item, sc FROM page WHERE page_id = 'order') ON order_id = item""")
def join_source(i: Inputs) -> DataFrame:
    return joins.orders_with_source(order_details(i), order_sources(i))


def _detail_facts(i: Inputs) -> DataFrame:
    return joins.order_detail_facts(order_details(i), order_infos(i), order_sources(i))


@add("dwd_03_order_detail", JOINED + " SELECT * FROM order_detail")
def dwd_order_detail(i: Inputs) -> DataFrame:
    changes = i.detail_changes().unionByName(i.info_changes())
    return facts.order_details(changes, i.page_log(), DATABASE)


PAID = f"""{JOINED}, payment AS ({PAYMENT_ROWS}) SELECT p.id, p.order_id, p.create_time, payment_type, course_id,
  course_name, province_id, user_id, final_amount AS order_detail_amount, sc, p.ts
  FROM payment p JOIN order_detail o ON p.order_id = o.order_id"""


@add("join_03_payment_detail", PAID)
def join_payment(i: Inputs) -> DataFrame:
    return joins.payment_facts(payments(i), _detail_facts(i))


@add("dwd_04_payment_detail", PAID)
def dwd_payment(i: Inputs) -> DataFrame:
    return facts.payments(i.payment_changes(), dwd_order_detail(i), DATABASE)


EXAMINED = f"""SELECT q.id, exam_id, paper_id, question_id, user_id, is_correct, q.score AS question_score,
  e.score AS exam_score, duration_sec, q.create_time, q.ts
  FROM ({QUESTION_ROWS}) q JOIN ({EXAM_ROWS}) e ON exam_id = e.id"""


@add("join_04_exam_question", EXAMINED)
def join_exam(i: Inputs) -> DataFrame:
    return joins.exam_question_facts(exam_questions(i), exams(i))


@add("dwd_05_exam_question", EXAMINED)
def dwd_exam(i: Inputs) -> DataFrame:
    return facts.exam_questions(i.question_changes().unionByName(i.exam_changes()), DATABASE)


@add("dwd_02_cart_add", f"WITH {O.CARTS} SELECT * FROM cart")
def dwd_cart(i: Inputs) -> DataFrame:
    return facts.cart_adds(i.cart_changes(), DATABASE)


# look-ups

@add("join_05_dim_look_up", f"""WITH {O.PAGE} SELECT mid, ts, sc, n_name AS site FROM page
  LEFT JOIN {O.NATION} d ON sc = dim_id""")
def dim_look_up(i: Inputs) -> DataFrame:
    rows = i.page_log().select("mid", "ts", "sc")
    return joins.look_up(rows, i.dim("dim_base_source"), "sc", site="source_site")


@add("join_06_source_name", f"""WITH {O.PAGE} SELECT sc AS source, count(*) AS n, min(n_name) AS source_name FROM page
  LEFT JOIN {O.NATION} d ON sc = dim_id GROUP BY sc""")
def source_name(i: Inputs) -> DataFrame:
    counted = i.page_log().groupBy(F.col("sc").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return joins.add_source(counted, i.dim)


@add("join_07_province_name", f"""SELECT s.*, n_name AS province_name FROM (SELECT CAST(c_nationkey AS VARCHAR) AS
  province_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) s
  LEFT JOIN {O.NATION} d ON province_id = dim_id""")
def province_name(i: Inputs) -> DataFrame:
    return joins.add_province(order_infos(i).groupBy("province_id").agg(F.count(F.lit(1)).alias("n")), i.dim)


def _item_counts(i: Inputs, column: str, name: str) -> DataFrame:
    return i.table("lineitem").groupBy(text(column).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def _item_counts_sql(column: str, name: str) -> str:
    return f"(SELECT CAST({column} AS VARCHAR) AS {name}, count(*) AS n FROM lineitem GROUP BY {column}) s"


@add("join_08_course_path", f"""SELECT s.*, c.subject_id, u.n_name AS subject_name, u.category_id, g.category_name
  FROM {_item_counts_sql('l_suppkey', 'course_id')} {O.COURSE_PATH}""")
def course_path(i: Inputs) -> DataFrame:
    return joins.add_course_path(_item_counts(i, "l_suppkey", "course_id"), i.dim)


@add("join_09_course_name", f"""SELECT s.*, s_name AS course_name FROM {_item_counts_sql('l_suppkey', 'course_id')}
  LEFT JOIN {O.COURSE} c ON course_id = dim_id""")
def course_name(i: Inputs) -> DataFrame:
    return joins.add_course_name(_item_counts(i, "l_suppkey", "course_id"), i.dim)


@add("join_10_paper_path", f"""SELECT s.*, p.p_name AS paper_name, p.course_id, c.s_name AS course_name, c.subject_id,
  u.n_name AS subject_name, u.category_id, g.category_name FROM {_item_counts_sql('l_partkey', 'paper_id')}
  LEFT JOIN {O.PART} p ON paper_id = p.dim_id LEFT JOIN {O.COURSE} c ON p.course_id = c.dim_id
  LEFT JOIN {O.NATION} u ON c.subject_id = u.dim_id LEFT JOIN {O.REGION} g ON u.category_id = g.dim_id""")
def paper_path(i: Inputs) -> DataFrame:
    return joins.add_paper_path(_item_counts(i, "l_partkey", "paper_id"), i.dim)


@add("join_11_question_text", f"""SELECT s.*, p_type AS question_name FROM
  {_item_counts_sql('l_partkey', 'question_id')} LEFT JOIN {O.PART} p ON question_id = dim_id""")
def question_text(i: Inputs) -> DataFrame:
    return joins.add_question(_item_counts(i, "l_partkey", "question_id"), i.dim)


@add("join_12_video_chapter", f"""WITH {O.PLAYS} SELECT video_id, sid, user_id, ts, coalesce(play_sec, 0) AS play_sec,
  chapter_id, chapter_name FROM chaptered""")
def video_chapter(i: Inputs) -> DataFrame:
    return summaries.video_plays(i.video_plays(), i.dim)


# configuration

def _config(i: Inputs, sink_type: str) -> DataFrame:
    return routing.current_config(topics.config_log(i.config_lines()), sink_type, ["ts_ms"])


CONFIG_COLUMNS = "source_table, source_type, sink_table, sink_type, sink_columns, sink_pk"


@add("src_06_config_changes", f"WITH {O.CONFIG} SELECT op, event_id AS ts_ms, {CONFIG_COLUMNS} FROM config")
def config_changes(i: Inputs) -> DataFrame:
    return topics.config_log(i.config_lines()).drop("sink_extend", "pos")


@add("cfg_01_current_config", f"""WITH {O.CONFIG} SELECT {CONFIG_COLUMNS} FROM dim_config
  UNION ALL SELECT {CONFIG_COLUMNS} FROM dwd_config""")
def current_config(i: Inputs) -> DataFrame:
    return _config(i, "dim").unionByName(_config(i, "dwd")).drop("sink_extend")


@add("join_13_route_dims", f"""WITH {O.CONFIG} SELECT CAST(c.event_id AS VARCHAR) AS id, c.tab AS "table", c.type, c.ts,
  d.sink_table, d.sink_pk FROM clean c JOIN dim_config d ON c.tab = d.source_table""")
def route_dims(i: Inputs) -> DataFrame:
    routed = facts.dim_rows(filters.parse_changes(i.event_change_lines()), _config(i, "dim"), DATABASE)
    return routed.select(F.col("data")["id"].alias("id"), "table", "type", "ts", "sink_table", "sink_pk")


ROUTED = f"""WITH {O.CONFIG} SELECT CAST(c.event_id AS VARCHAR) AS id, c.ts, d.sink_table,
  CASE WHEN d.sink_columns = 'id,k' THEN CAST(c.k AS VARCHAR) END AS k,
  CASE WHEN d.sink_columns <> 'id,k' THEN CAST(c.user_id AS VARCHAR) END AS user_id
  FROM clean c JOIN dwd_config d ON c.tab = d.source_table AND c.type = d.source_type"""


@add("join_14_route_facts", ROUTED)
def route_facts(i: Inputs) -> DataFrame:
    routed = facts.routed(filters.parse_changes(i.event_change_lines()), _config(i, "dwd"), DATABASE)
    data = F.col("data")
    return routed.select(data["id"].alias("id"), "ts", "sink_table", data["k"].alias("k"),
                         data["user_id"].alias("user_id"))


@add("dwd_06_routed_topics", f"""SELECT sink_table AS topic, count(*) AS n, count(k) AS with_k,
  count(user_id) AS with_user FROM ({ROUTED}) GROUP BY sink_table""")
def routed_topics(i: Inputs) -> DataFrame:
    routed = facts.routed(filters.parse_changes(i.event_change_lines()), _config(i, "dwd"), DATABASE)
    data = F.col("data")
    return routed.groupBy(F.col("sink_table").alias("topic")).agg(
        F.count(F.lit(1)).alias("n"), F.count(data["k"]).alias("with_k"), F.count(data["user_id"]).alias("with_user"))


@add("dim_job_latest_rows", f"""WITH {O.CONFIG} SELECT sink_table, id, ts,
  CASE WHEN sink_columns = 'id,k' THEN id END AS k, CASE WHEN sink_columns <> 'id,k' THEN user_id END AS user_id FROM (
  SELECT d.sink_table, d.sink_columns, CAST(c.k AS VARCHAR) AS id, CAST(c.user_id AS VARCHAR) AS user_id, c.ts,
    row_number() OVER (PARTITION BY d.sink_table, c.k ORDER BY c.ts DESC, c.event_id DESC) AS n
  FROM clean c JOIN dim_config d ON c.tab = d.source_table) WHERE n = 1""")
def dim_job(i: Inputs) -> DataFrame:
    """Dimension rows by primary key, here the event's number `k`, newest row last."""
    changes = filters.clean_changes(filters.parse_changes(i.event_change_lines()), DATABASE)
    keyed = changes.withColumns({"pk": F.col("data")["k"], "seq": F.col("data")["id"].cast("bigint")})
    routed = routing.route_dims(keyed, _config(i, "dim"))
    newest = routing.latest(routed, ["sink_table", "pk"], ["ts", "seq"])
    data = F.col("data")
    return newest.select("sink_table", F.col("pk").alias("id"), "ts", data["k"].alias("k"),
                         data["user_id"].alias("user_id"))


# upserts

@add("snk_01_fixed_topics", f"WITH {O.CARTS} SELECT * FROM cart")
def fixed_topics(i: Inputs) -> DataFrame:
    """A stream of facts to its topic, and the topic read back."""
    rows = facts.cart_adds(Inputs(i.spark, i.folder, ("events",)).cart_changes(), DATABASE)
    folder, topic = session.work_folder(i.spark), "dwd_trade_cart_add"
    sinks.write_topics(sinks.topic_rows(rows, topic), folder, topic, "text", f"{folder}/topics", None).awaitTermination()
    return topics.facts(topics.read_topic(i.spark, topic, "text", f"{folder}/topics", streaming=False), topic)


def _warehouse(i: Inputs) -> Warehouse:
    """A warehouse over the events as change lines, with the current config."""
    folder = session.work_folder(i.spark)
    i.event_change_lines().write.text(f"{folder}/{schemas.CHANGE_LOG_TOPIC}")
    w = Warehouse(i.spark, folder, DATABASE, every=None, dim_database=f"dims_{uuid.uuid4().hex}", dim_folder=f"{folder}/dims")
    w.preload(_config(i, "dim").unionByName(_config(i, "dwd")))
    return w


@add("snk_02_topic_per_row", f"""SELECT sink_table AS topic, id, k, user_id FROM ({ROUTED})""")
def topic_per_row(i: Inputs) -> DataFrame:
    """Routed change rows in the topics that the config names, read back."""
    w = _warehouse(i)
    w.routed().awaitTermination()
    written = i.spark.read.schema("value string, topic string").text(f"{w.folder}/topics/dwd_routed")
    data = F.from_json("value", "map<string,string>")
    return written.select("topic", *[data[c].alias(c) for c in ("id", "k", "user_id")])


@add("snk_04_upsert_order_detail", f"""WITH {O.DETAIL} SELECT id, course_id, order_id, user_id, final_amount,
  province_id, sc, ts FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS n FROM detail)
  WHERE n = 1""")
def upsert_details(i: Inputs) -> DataFrame:
    """Order details written to a keyed topic twice; a reader takes the last row of each key."""
    folder, topic = session.work_folder(i.spark), "dwd_trade_order_detail"
    for _ in range(2):
        rows = Inputs(i.spark, i.folder, ("lineitem",)).order_details()
        sinks.write_topics(sinks.topic_rows(rows, topic, "id"), uuid.uuid4().hex, topic, "parquet", f"{folder}/topics",
                           None).awaitTermination()
    written = i.spark.read.schema("key string, value string, topic string").parquet(f"{folder}/topics")
    parsed = filters.as_facts(written.where(F.col("key").isNotNull()).select("value"), schemas.ORDER_DETAIL)
    last = routing.latest(parsed, ["id"], ["ts", "seq"])
    return last.select("id", "course_id", "order_id", "user_id", V.as_money(F.col("final_amount")).alias("final_amount"),
                       "province_id", "sc", "ts")


NUMBERED = JOINED.replace(f"{O.SHIP} AS ts FROM lineitem", f"{O.SHIP} AS ts, {O.ARRIVAL} AS seq FROM lineitem")


@add("snk_04_folded_details", NUMBERED + """ SELECT * FROM order_detail
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) = 1""")
def folded_details(i: Inputs) -> DataFrame:
    """Details given at once without a source, and corrected when the sources come in a later run of the same query; then
    what the keyed topic says in the end."""
    folder, topic = session.work_folder(i.spark), "dwd_trade_order_detail"
    sources = order_sources(i)
    sources.limit(0).coalesce(1).write.parquet(f"{folder}/sources")
    for _ in range(2):
        live = Inputs(i.spark, i.folder, ("lineitem", "orders"))
        late = i.spark.readStream.schema(sources.schema).parquet(f"{folder}/sources")
        details = filters.order_details(live.detail_changes(numbered=True), DATABASE)
        rows = joins.order_detail_changes(_timed(details), _timed(order_infos(live)),
                                          filters.event_timed(late, "ms", windows.DELAY), FAR, FAR)
        sinks.write_changes(rows, folder, topic, "id", "parquet", f"{folder}/topics", None).awaitTermination()
        sources.write.mode("append").parquet(f"{folder}/sources")
    said = topics.folded(i.spark, topic, f"{folder}/topics").select("value")
    return filters.as_facts(said, schemas.ORDER_DETAIL)


@add("snk_05_upsert_dim", f"""WITH {O.CONFIG} SELECT lower(d.sink_table) AS sink_table, CAST(c.event_id AS VARCHAR) AS id,
  CASE WHEN d.sink_columns = 'id,k' THEN CAST(c.k AS VARCHAR) END AS k,
  CASE WHEN d.sink_columns <> 'id,k' THEN CAST(c.user_id AS VARCHAR) END AS user_id
  FROM clean c JOIN dim_config d ON c.tab = d.source_table""")
def upsert_dim(i: Inputs) -> DataFrame:
    """Change rows of dimension tables into their tables, read back."""
    w = _warehouse(i)
    w.dim_rows().awaitTermination()
    found = None
    for table in sorted(t.name for t in i.spark.catalog.listTables(w.dim_database)):
        rows = w.dims.read(table)
        part = rows.select(F.lit(table).alias("sink_table"), "id", *[
            F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("k", "user_id")])
        found = part if found is None else found.unionByName(part)
    return found


@add("snk_05_same_second", f"""WITH {O.EV} SELECT CAST(user_id AS VARCHAR) AS id, CAST(k AS VARCHAR) AS k,
  event_type AS kind FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n
  FROM ev) WHERE n = 1""")
def upsert_same_second(i: Inputs) -> DataFrame:
    """All events as changes of one second: the last to arrive stands, also when a batch runs again."""
    store = sinks.DimStore(i.spark, f"dims_{uuid.uuid4().hex}", folder=session.work_folder(i.spark))
    store.create("dim_user", "id,k,kind", "id")
    rows = i.events().select(F.create_map(F.lit("id"), text("user_id"), F.lit("k"), text("k"), F.lit("kind"), "event_type")
                             .alias("data"), F.lit(1).cast("bigint").alias("ts"), F.col("event_id").alias("seq"))
    for _ in range(2):
        store.upsert(rows, 0, "dim_user")
    return store.read("dim_user")


# configuration that changes while the streams run

def _in_halves(i: Inputs, run: Callable[[Warehouse], None]) -> Warehouse:
    """A warehouse whose changes and config changes come in two halves, the config's before the rows'."""
    folder = session.work_folder(i.spark)
    w = Warehouse(i.spark, folder, DATABASE, every=None, dim_database=f"dims_{uuid.uuid4().hex}", dim_folder=f"{folder}/dims")
    for half in (0, 1):
        part = Inputs(i.spark, i.folder, half=half)
        part.config_lines().write.mode("append").text(f"{folder}/table_process")
        part.event_change_lines().write.mode("append").text(f"{folder}/{schemas.CHANGE_LOG_TOPIC}")
        w.config().awaitTermination()
        run(w)
    return w


@add("str_join_13_route_dims", f"""WITH {O.PHASES} SELECT CAST(c.event_id AS VARCHAR) AS id, c.tab AS "table", c.type, c.ts,
  d.sink_table, d.sink_columns FROM came c JOIN phase_dim d ON c.tab = d.source_table AND c.phase = d.phase""")
def stream_route_dims(i: Inputs) -> DataFrame:
    """Each micro-batch meets the config in force when it comes."""
    folder = session.work_folder(i.spark)

    def run(w: Warehouse) -> None:
        def keep(batch: DataFrame, number: int) -> None:
            routing.route_dims(batch, w.current_config("dim")).write.mode("overwrite").parquet(f"{folder}/batch={number}")

        rows = filters.clean_changes(w.changes(), DATABASE)
        sinks.started(rows.writeStream.foreachBatch(keep), i.spark, folder, "routed", None).awaitTermination()

    _in_halves(i, run)
    return i.spark.read.parquet(folder).select(F.col("data")["id"].alias("id"), "table", "type", "ts", "sink_table", "sink_columns")


@add("str_join_14_route_facts", f"""WITH {O.PHASES} SELECT d.sink_table AS topic, CAST(c.event_id AS VARCHAR) AS id,
  CASE WHEN d.sink_columns = 'id,k' THEN CAST(c.k AS VARCHAR) END AS k,
  CASE WHEN d.sink_columns <> 'id,k' THEN CAST(c.user_id AS VARCHAR) END AS user_id
  FROM came c JOIN phase_dwd d ON c.tab = d.source_table AND c.type = d.source_type AND c.phase = d.phase""")
def stream_route_facts(i: Inputs) -> DataFrame:
    w = _in_halves(i, lambda w: w.routed().awaitTermination())
    written = i.spark.read.schema("value string, topic string").text(f"{w.folder}/topics/dwd_routed")
    data = F.from_json("value", "map<string,string>")
    return written.select("topic", *[data[c].alias(c) for c in ("id", "k", "user_id")])


@add("snk_07_table_lifecycle", f"""WITH {O.PHASES}, dims AS (SELECT *, lower(sink_table) AS name FROM config WHERE sink_type = 'dim'),
  resets AS (SELECT name, max(event_id) FILTER (op IN ('u', 'd')) AS reset FROM dims GROUP BY name),
  made AS (SELECT name, arg_min(sink_columns, event_id) AS columns FROM dims JOIN resets USING (name)
    WHERE op <> 'd' AND (reset IS NULL OR event_id >= reset) GROUP BY name),
  sent AS (SELECT lower(d.sink_table) AS name, c.phase FROM came c JOIN phase_dim d ON c.tab = d.source_table AND c.phase = d.phase)
  SELECT made.name AS name, columns, count(sent.phase) AS n FROM made JOIN resets USING (name), middle
    LEFT JOIN sent ON sent.name = made.name AND (sent.phase = 2 OR coalesce(reset, 0) <= mid) GROUP BY ALL""")
def table_lifecycle(i: Inputs) -> DataFrame:
    """The tables that are left when the config has created, changed and dropped them between batches, and their rows."""
    w = _in_halves(i, lambda w: w.dim_rows().awaitTermination())
    found = None
    for table in sorted(t.name for t in i.spark.catalog.listTables(w.dim_database)):
        part = w.dims.read(table).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(table).alias("name"), F.lit(",".join(w.dims.columns(table))).alias("columns"), "n")
        found = part if found is None else found.unionByName(part)
    return found


# recovery: the last micro-batch is written, its commit is lost, and the query starts again

@add("snk_01_recovered_topic", f"WITH {O.CARTS} SELECT * FROM cart")
def recovered_topic(i: Inputs) -> DataFrame:
    folder, topic = session.work_folder(i.spark), "dwd_trade_cart_add"
    for again in (False, True):
        rows = facts.cart_adds(Inputs(i.spark, i.folder, ("events",)).cart_changes(), DATABASE)
        sinks.write_topics(sinks.topic_rows(rows, topic), folder, topic, "text", f"{folder}/topics", None).awaitTermination()
        if not again:
            faults.uncommit(i.spark, folder, topic)
    return topics.facts(topics.read_topic(i.spark, topic, "text", f"{folder}/topics", streaming=False), topic)


@add("snk_06_recovered_windows", O.with_dims(6, O.DAY))
def recovered_windows(i: Inputs) -> DataFrame:
    """Cart windows of a day, in the catalog's table."""
    store = WindowStore(i.spark, f"windows_{uuid.uuid4().hex}", session.work_folder(i.spark))
    closing, owner, table = session.work_folder(i.spark), uuid.uuid4().hex, TABLES[6]
    Inputs(i.spark, i.folder, (), closing).close("events")
    for again in (False, True):
        live = Inputs(i.spark, i.folder, ("events",), closing)
        rows = states.windowed(table, summary_facts(live, 6), i.dim, 86_400, "0 seconds")

        def keep(batch: DataFrame, number: int) -> None:
            store.store(table, summaries.JOBS[table].finish(batch, i.dim), number)

        sinks.started(rows.writeStream.foreachBatch(keep), i.spark, owner, table, None).awaitTermination()
        if not again:
            faults.uncommit(i.spark, owner, table)
    return store.read(table).where(F.col("stt") < str(FAR_YEAR)).drop("ts", "dt")


@add("snk_05_recovered_dims", f"""WITH {O.CONFIG} SELECT lower(d.sink_table) AS sink_table, CAST(c.event_id AS VARCHAR) AS id
  FROM clean c JOIN dim_config d ON c.tab = d.source_table""")
def recovered_dims(i: Inputs) -> DataFrame:
    w = _warehouse(i)
    w.dim_rows().awaitTermination()
    faults.uncommit(i.spark, w.owner, "dim_rows")
    w.dim_rows().awaitTermination()
    found = None
    for table in sorted(t.name for t in i.spark.catalog.listTables(w.dim_database)):
        part = w.dims.read(table).select(F.lit(table).alias("sink_table"), "id")
        found = part if found is None else found.unionByName(part)
    return found


# keyed state

@add("st_01_new_visitor_flag", f"WITH {O.FLAGS} SELECT mid, ts, page_id, item, is_new FROM flagged")
def new_visitor_flag(i: Inputs) -> DataFrame:
    return state.repair_new_flag(i.page_log()).select("mid", "ts", "page_id", "item", "is_new")


@add("dwd_01_split_repaired_log", f"""WITH {O.FLAGS}, part AS (
  SELECT 'start' AS kind, event_id FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT 'page', event_id FROM ev WHERE event_type IN ('view', 'click', 'purchase')
  UNION ALL SELECT 'err', event_id FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 'appVideo', event_id FROM ev WHERE event_type = 'view'
  UNION ALL SELECT 'action', event_id FROM (SELECT event_id, unnest(range(1, 1 + k % 3)) FROM ev)
  UNION ALL SELECT 'display', event_id FROM (SELECT event_id, unnest(range(1, 1 + k % 4)) FROM ev))
  SELECT kind, flagged.mid, flagged.is_new, CAST(flagged.ts AS VARCHAR) AS ts
  FROM part JOIN flagged ON part.event_id = flagged.event_id""")
def split_repaired_log(i: Inputs) -> DataFrame:
    data = F.col("data")
    return facts.logs(projections.parse_log(i.raw_log_lines())).select(
        "kind", data["mid"].alias("mid"), data["is_new"].alias("is_new"), data["ts"].alias("ts"))


@add("st_02_daily_visitors", f"""WITH {O.VISITS} SELECT mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day, ts,
  last_page_id, sc, is_new FROM visits WHERE first""")
def daily_visitors(i: Inputs) -> DataFrame:
    firsts = state.day_first_views(i.page_log(), windows.DEVICE_ORDER)
    return firsts.select("mid", F.date_format("day", V.DATE).alias("day"), "ts", "last_page_id", "sc", "is_new")


@add("st_03_daily_logins", f"""WITH {O.LOGINS} SELECT uid, strftime(make_timestamp(d * 86400000000), '%Y-%m-%d') AS day,
  ts, CASE WHEN (ts - before * 86400000) // 86400000 > 7 THEN 1 ELSE 0 END AS back FROM days""")
def daily_logins(i: Inputs) -> DataFrame:
    return state.login_days(i.page_log()).select("uid", F.date_format("day", V.DATE).alias("day"), "ts", "back")


def _by_device(i: Inputs) -> DataFrame:
    return i.page_log().withColumn("uid", F.col("mid"))


@add("st_03_returning_devices", f"""WITH {O.PAGE}, firsts AS (
  SELECT mid AS uid, ts // 86400000 AS d, min(ts) AS ts FROM page GROUP BY ALL),
  days AS (SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY d) AS before FROM firsts)
  SELECT uid, ts, CASE WHEN (ts - before * 86400000) // 86400000 > 7 THEN 1 ELSE 0 END AS back FROM days""")
def returning_devices(i: Inputs) -> DataFrame:
    return state.login_days(_by_device(i)).select("uid", "ts", "back")


@add("st_04_delta_order",
     f"WITH {O.FIXED} SELECT id, order_id, user_id, course_id, province_id, sc, ts, seq, final_amount "
     "FROM fixed")
def delta_order(i: Inputs) -> DataFrame:
    fixed = summaries.corrected_orders(i.order_details())
    return fixed.drop("course_name")


@add("st_04_delta_exam", f"""WITH {O.FIXED_EXAM} SELECT exam_id, paper_id, user_id, ts * 1000 AS ts, seq, exam_score,
  duration_sec FROM fixed""")
def delta_exam(i: Inputs) -> DataFrame:
    return summaries.exam_papers(i.exam_questions())


# scalar functions and words

@add("fn_01_17_functions", f"""WITH {O.EV}, odd AS (
  SELECT *, CASE WHEN k % 3 = 0 THEN 'x' || k WHEN k % 3 = 1 THEN CAST(k AS VARCHAR) END AS raw FROM ev)
  SELECT event_id, raw AS element, try_cast(raw AS BIGINT) AS as_long, coalesce(try_cast(raw AS DOUBLE), -1.0) AS as_double,
    try_cast(raw AS DECIMAL(16,2)) + CAST(1.25 AS DECIMAL(3,2)) AS money_plus,
    strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS date_text,
    strftime(make_timestamp(ms * 1000), {O.FORMAT}) AS date_time_text,
    ms // 86400000 * 86400000 AS date_millis, ms // 1000 * 1000 AS date_time_millis,
    strftime(make_timestamp(ms * 1000) - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
    CAST(trunc((k - 50) / 7.0) AS BIGINT) AS floor_div, strftime(make_timestamp(ms * 1000), '%Y%m%d') AS compact_date,
    replace('bootstrap-' || event_type, 'bootstrap-', '') AS replaced,
    regexp_replace('id,name', '[^,]+', '\\0 varchar', 'g') AS columns_sql,
    CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS listed,
    coalesce(raw, 'none') || ':' || event_type AS joined, (ms - 1704067200000) // 86400000 AS whole_days FROM odd""")
def functions(i: Inputs) -> DataFrame:
    k = F.col("k")
    raw = F.when(k % 3 == 0, F.concat(F.lit("x"), k.cast("string"))).when(k % 3 == 1, k.cast("string"))
    rows = i.events().withColumn("data", F.create_map(F.lit("raw"), raw)).withColumn("raw", F.col("data")["raw"])
    ms, value = F.col("ms"), F.col("raw")
    return rows.select(
        "event_id", value.alias("element"), V.as_long(value).alias("as_long"),
        F.coalesce(V.as_double(value), F.lit(-1.0)).alias("as_double"),
        (V.as_money(value) + F.lit("1.25").cast("decimal(3,2)")).cast("decimal(18,2)").alias("money_plus"),
        V.date_text(ms).alias("date_text"), V.date_time_text(ms).alias("date_time_text"),
        V.date_millis(V.date_text(ms)).alias("date_millis"),
        V.date_time_millis(V.date_time_text(ms)).alias("date_time_millis"),
        F.date_format(V.day_before(V.day(ms)), V.DATE).alias("day_before"),
        V.floor_div((k - 50).cast("bigint"), F.lit(7).cast("bigint")).alias("floor_div"),
        V.compact_date(V.event_time(ms)).alias("compact_date"),
        F.replace(F.concat(F.lit("bootstrap-"), "event_type"), F.lit("bootstrap-"), F.lit("")).alias("replaced"),
        F.regexp_replace(F.lit("id,name"), "[^,]+", "$0 varchar").alias("columns_sql"),
        F.array_contains(V.listed(F.lit("view,click")), F.col("event_type")).cast("int").alias("listed"),
        F.concat_ws(":", F.coalesce(value, F.lit("none")), "event_type").alias("joined"),
        V.whole_days(F.lit(1_704_067_200_000).cast("bigint"), ms).alias("whole_days"))


@add("udf_01_keyword_split", r"""SELECT keyword, count(*) AS keyword_count FROM (
  SELECT doc_id, unnest(list_distinct(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '))) AS keyword
  FROM documents) WHERE keyword <> '' GROUP BY keyword""")
def keyword_split(i: Inputs) -> DataFrame:
    return keywords.word_counts(i.table("documents"), "text")


# the same rules as streams over the tables, run until the tables are read

def run_stream(i: Inputs, rows: DataFrame, name: str) -> DataFrame:
    """Write a stream to files in the shared folder and read them back."""
    folder = f"{session.work_folder(i.spark)}/{name}"
    query = (rows.writeStream.format("parquet").option("path", f"{folder}/rows")
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return i.spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def _streams() -> None:
    for number, short in SUMMARY_NAMES.items():
        def streamed(i: Inputs, number=number, short=short) -> DataFrame:
            name = "lineitem" if number in (7, 8, 9, 10, 12, 13) else "events"
            live = Inputs(i.spark, i.folder, (name,), session.work_folder(i.spark))
            live.close(name, F.lit(-1) if number in (12, 13) else None)
            rows = states.windowed(TABLES[number], summary_facts(live, number), i.dim, delay="0 seconds")
            got = run_stream(i, RATES.get(number, lambda r: r)(rows), f"str_{number:02d}")
            return got.where(F.col("stt") < str(FAR_YEAR))

        add(f"str_{number:02d}_{short}", O.summary(number, O.FIVE_SECONDS))(streamed)


FAR = ("20000 days", "20000 days")


def _timed(rows: DataFrame) -> DataFrame:
    return filters.event_timed(rows, "s", windows.DELAY)


@add("str_join_01_order_info", f"SELECT d.*, province_id FROM ({DETAIL_ROWS}) d JOIN {INFO} ON order_id = info_id")
def stream_join_info(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("lineitem", "orders"))
    joined = joins.orders_with_province(_timed(order_details(live)), _timed(order_infos(live)), FAR)
    return run_stream(i, joined.drop("et"), "str_join_01")


def _closed(i: Inputs, *names: str) -> Inputs:
    """The tables as streams that end with rows far ahead, so that unmatched rows come out too."""
    live = Inputs(i.spark, i.folder, names, session.work_folder(i.spark))
    for name in names:
        live.close(name)
    return live


@add("str_join_02_order_source", f"""WITH {O.PAGE} SELECT d.*, sc FROM ({DETAIL_ROWS}) d
  LEFT JOIN (SELECT item, sc FROM page WHERE page_id = 'order') ON order_id = item""")
def stream_join_source(i: Inputs) -> DataFrame:
    """Both sides are streams; a detail without a source comes out when none can come any more."""
    live = _closed(i, "lineitem", "events")
    sources = filters.event_timed(order_sources(live), "ms", windows.DELAY)
    joined = joins.orders_with_source(_timed(order_details(live)), sources, FAR)
    return run_stream(i, joined.drop("et"), "str_join_02").where(F.col("create_time") < str(FAR_YEAR))


@add("str_dwd_03_order_detail", JOINED + " SELECT * FROM order_detail")
def stream_order_detail(i: Inputs) -> DataFrame:
    """Details, orders and sources as streams: an inner join, then a left one."""
    live = _closed(i, "lineitem", "orders", "events")
    sources = filters.event_timed(order_sources(live), "ms", windows.DELAY)
    rows = joins.order_detail_facts(_timed(order_details(live)), _timed(order_infos(live)), sources, FAR, FAR)
    return run_stream(i, rows, "str_dwd_03").where(F.col("create_time") < str(FAR_YEAR))


def _details_read_back(i: Inputs) -> DataFrame:
    """Order details as a stream, with their sources: the topic that the job before has written."""
    folder, topic = session.work_folder(i.spark), "dwd_trade_order_detail"
    rows = sinks.topic_rows(_detail_facts(i), topic, "id").select("value", "topic")
    rows.write.partitionBy("topic").option("compression", "gzip").text(f"{folder}/topics")
    return _timed(topics.facts(topics.read_topic(i.spark, topic, "text", f"{folder}/topics"), topic))


@add("str_join_03_payment_detail", PAID)
def stream_join_payment(i: Inputs) -> DataFrame:
    """Payments with the details of their orders, read back from the details' topic; spread over four tasks per order."""
    live = Inputs(i.spark, i.folder, ("orders",))
    return run_stream(i, joins.payment_facts(_timed(payments(live)), _details_read_back(i), FAR, salt=4), "str_join_03")


# Orders up to 60 days before their items are shipped; the rest is forgotten.
SHORT = ("60 days", "0 days")
IN_TIME = "{0} BETWEEN {1} - 60 * 86400 AND {1}"


@add("str_join_01_bounded", f"""SELECT d.*, province_id FROM ({DETAIL_ROWS}) d JOIN (SELECT i.*, {O.MADE} AS made FROM {INFO} i
  JOIN orders ON info_id = CAST(o_orderkey AS VARCHAR)) ON order_id = info_id AND {IN_TIME.format('made', 'd.ts')}""")
def stream_join_info_bounded(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("lineitem", "orders"))
    joined = joins.orders_with_province(_timed(order_details(live)), _timed(order_infos(live)), SHORT)
    return run_stream(i, joined.drop("et"), "str_join_01_bounded")


@add("str_join_02_bounded", f"""WITH {O.PAGE} SELECT d.*, sc FROM ({DETAIL_ROWS}) d LEFT JOIN (SELECT item, sc, ts // 1000 AS seen
  FROM page WHERE page_id = 'order') ON order_id = item AND seen BETWEEN d.ts - 60 * 86400 AND d.ts""")
def stream_join_source_bounded(i: Inputs) -> DataFrame:
    live = _closed(i, "lineitem", "events")
    sources = filters.event_timed(order_sources(live), "ms", windows.DELAY)
    joined = joins.orders_with_source(_timed(order_details(live)), sources, SHORT)
    return run_stream(i, joined.drop("et"), "str_join_02_bounded").where(F.col("create_time") < str(FAR_YEAR))


@add("str_join_03_bounded", f"""{PAID} AND {IN_TIME.format('p.ts', 'o.ts')}""")
def stream_join_payment_bounded(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("orders",))
    return run_stream(i, joins.payment_facts(_timed(payments(live)), _details_read_back(i), SHORT), "str_join_03_bounded")


@add("str_join_04_bounded", f"{EXAMINED} AND {IN_TIME.format('e.ts', 'q.ts')}")
def stream_join_exam_bounded(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("lineitem", "orders"))
    joined = joins.exam_question_facts(_timed(exam_questions(live)), _timed(exams(live)), SHORT)
    return run_stream(i, joined, "str_join_04_bounded")


@add("str_join_04_exam_question", EXAMINED)
def stream_join_exam(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("lineitem", "orders"))
    joined = joins.exam_question_facts(_timed(exam_questions(live)), _timed(exams(live)), FAR, salt=4)
    return run_stream(i, joined, "str_join_04")


@add("str_dwd_01_split_log", SPLIT + " FROM part JOIN ev USING (event_id)")
def stream_split_log(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("events",))
    return run_stream(i, _split_columns(projections.split_log(projections.parse_log(live.raw_log_lines()))), "str_dwd_01")


@add("str_st_01_new_visitor_flag", f"WITH {O.FLAGS} SELECT mid, ts, page_id, item, is_new FROM flagged")
def stream_visitor_flag(i: Inputs) -> DataFrame:
    live = Inputs(i.spark, i.folder, ("events",))
    rows = live.page_log().select("mid", "ts", "page_id", "item", "is_new")
    return run_stream(i, states.repair_new_flag(rows), "str_st_01")


_streams()


# the driver's view

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            session.configure(spark)
            return query(Inputs(spark, folder))
        return run

    return {name: bind(query) for name, (query, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}
