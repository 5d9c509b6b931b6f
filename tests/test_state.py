"""Hand cases of the keyed rules, as tables."""

from datetime import datetime, timezone
from decimal import Decimal

from eduflow.functions import values as V
from eduflow.operators import filters, joins, projections, state
from eduflow.plans import summaries


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


PAGE = "mid string, uid string, sc string, is_new string, last_page_id string, during_time bigint, ts bigint"


def page(spark, rows):
    return spark.createDataFrame(rows, PAGE)


def test_new_visitor_flag(spark):
    log = page(spark, [
        ("a", None, "1", "1", None, 1, ms("2024-01-01T08:00")), ("a", None, "1", "1", None, 1, ms("2024-01-01T09:00")),
        ("a", None, "1", "1", None, 1, ms("2024-01-02T09:00")),
        ("b", None, "1", "0", None, 1, ms("2024-01-01T08:00")), ("b", None, "1", "1", None, 1, ms("2024-01-01T09:00")),
        (None, None, "1", "1", None, 1, ms("2024-01-01T09:00"))])
    got = [(r.mid, r.is_new) for r in state.repair_new_flag(log).orderBy("mid", "ts").collect()]
    assert got == [("a", "1"), ("a", "1"), ("a", "0"), ("b", "0"), ("b", "0")]


def test_returning_users_need_more_than_seven_whole_days(spark):
    def back(again):
        log = page(spark, [("m", "u", "1", "1", None, 1, ms("2024-01-01T10:00")), ("m", "u", "1", "1", None, 1, ms(again))])
        return [r.back for r in state.login_days(log).orderBy("ts").collect()]

    assert back("2024-01-08T23:59") == [0, 0]
    assert back("2024-01-09T00:00") == [0, 1]


def test_first_view_of_a_day_is_the_visitor(spark):
    log = page(spark, [
        ("a", None, "1", "1", None, 5, ms("2024-01-01T00:00:01")),
        ("a", None, "2", "1", "home", None, ms("2024-01-01T00:00:02")),
        ("a", None, None, "1", "home", 7, ms("2024-01-02T00:00:02"))])
    rows = summaries.windowed("dws_traffic_source_page_view_window", log)
    got = sorted((r.stt, r.source or "", r.uv_ct, r.sv_ct, r.pv_ct, r.dur_sum) for r in rows.collect())
    assert got == [("2024-01-01 00:00:00", "1", 1, 1, 1, 5), ("2024-01-01 00:00:00", "2", 0, 0, 1, 0),
                   ("2024-01-02 00:00:00", "", 1, 0, 1, 7)]


ORDER = ("id string, order_id string, user_id string, course_id string, course_name string, province_id string, "
         "sc string, final_amount string, ts bigint, seq bigint")


def test_corrections(spark):
    rows = [("d", "o", "u", "c", "n", "p", "s", amount, 1_704_067_200 + at, at)
            for at, amount in enumerate(["10", "12", "9"])]
    facts = spark.createDataFrame(rows, ORDER)
    fixed = summaries.corrected_orders(facts).orderBy("ts", "final_amount").collect()
    assert [(r.ts - 1_704_067_200, r.final_amount) for r in fixed] == [
        (0, Decimal(2)), (0, Decimal(10)), (1, Decimal(-3))]
    dims = {"dim_course_info": "id string, course_name string, subject_id string",
            "dim_base_subject_info": "id string, subject_name string, category_id string",
            "dim_base_category_info": "id string, category_name string"}
    out = summaries.summary("dws_trade_course_order_window", facts,
                            lambda name: spark.createDataFrame([], dims[name])).collect()
    assert [(r.order_count, r.user_count, r.final_amount, r.subject_name) for r in out] == [(1, 1, Decimal(9), None)]


def test_a_missing_member_counts_once(spark):
    plays = spark.createDataFrame(
        [("v", "s", None, 1, 0), ("v", "s", None, 2, 1), ("v", None, "u", None, 2)],
        "video_id string, sid string, user_id string, play_sec bigint, ts bigint")
    dims = {"dim_video_info": spark.createDataFrame([("v", "c")], "id string, chapter_id string"),
            "dim_chapter_info": spark.createDataFrame([("c", "name")], "id string, chapter_name string")}
    row = summaries.windowed("dws_play_video_chapter_window", plays, dims.get).first()
    assert (row.play_count, row.user_count, row.play_sec) == (2, 2, 3)


def test_rows_without_a_group_key_are_left_out(spark):
    carts = spark.createDataFrame([(None, "x", 1), ("c", "y", 1)], "course_id string, course_name string, ts bigint")
    rows = summaries.windowed("dws_trade_cart_add_window", carts).collect()
    assert [(r.course_id, r.cart_count) for r in rows] == [("c", 1)]


def test_change_cleaning(spark):
    def line(text):
        return (text,)

    lines = spark.createDataFrame([
        line('{"database":"edu","table":"t","type":"bootstrap-insert","ts":"5","data":{"id":1,"n":"bootstrap-x"}}'),
        line('{"database":"edu","table":"t","type":"bootstrap-start","ts":5,"data":{}}'),
        line('{"database":"edu","table":"t","type":"delete","ts":5,"data":{"id":1}}'),
        line('{"database":"edu","table":"t","type":"insert","ts":5,"data":{}}'),
        line('{"database":"edu","type":"insert","ts":5,"data":{"id":1}}'),
        line('{"database":"x","table":"t","type":"insert","ts":5,"data":{"id":1}}'),
        line('{"database":"edu","table":"t"'), line("")], "value string")
    got = filters.clean_changes(filters.parse_changes(lines), "edu").collect()
    assert [(r.type, r.ts, r.data) for r in got] == [("insert", 5, {"id": "1", "n": "bootstrap-x"})]


def test_log_time_wins_over_a_part_and_common_over_its_fields(spark):
    lines = spark.createDataFrame([(
        '{"common":{"mid":"m","ts":"9","sc":"1"},"ts":7,"page":{"sc":"2","page_id":"p","ts":1},"actions":[{"ts":3}]}',)],
        "value string")
    got = {r.kind: r.data for r in projections.split_log(projections.parse_log(lines)).collect()}
    assert got == {"page": {"sc": "1", "page_id": "p", "ts": "7", "mid": "m"},
                   "action": {"ts": "7", "mid": "m", "sc": "1"}}


def test_review_time_is_a_number_or_a_text(spark):
    made = spark.createDataFrame([("c", "u", "5", "1704067200000"), ("c", "u", "x", "2024-01-01 00:00:00")],
                                 "course_id string, user_id string, review_stars string, create_time string")
    got = [(r.ts, r.score, r.good_count) for r in projections.review_measures(made).collect()]
    assert got == [(1_704_067_200_000, 5, 1), (1_704_067_200_000, 0, 0)]


def test_spread_join_gives_the_same_rows(spark, inputs):
    from checks import registry
    plain = registry.join_payment(inputs)
    details = registry._detail_facts(inputs)
    spread = joins.payment_facts(registry.payments(inputs), details, salt=4)
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0


def test_names():
    assert V.snake_name("userCount") == "user_count" and V.camel_name("sink_table") == "sinkTable"
    assert V.snake_name("UserCount") == "user_count"


def test_windows_start_on_the_epoch(spark):
    views = spark.createDataFrame([("home", 4999), ("home", 5000)], "page_id string, ts bigint")
    got = [(r.stt, r.edt) for r in summaries.windowed(
        "dws_user_traffic_home_detail_page_view_window", views).orderBy("stt").collect()]
    assert got == [("1970-01-01 00:00:00", "1970-01-01 00:00:05"), ("1970-01-01 00:00:05", "1970-01-01 00:00:10")]
