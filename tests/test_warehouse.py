"""Raw files to report: every job of the warehouse over hand-made input."""

import json

import pytest

from eduflow import schemas
from eduflow.operators import windows
from eduflow.plans import report
from eduflow.operators import filters
from eduflow.streaming import sinks
from eduflow.streaming.jobs import Warehouse

T0 = 1_704_067_200          # 2024-01-01 00:00:00
LATER = T0 + 4 * 86_400     # rows that close every window and join


def change(table, ts, kind="insert", database="edu", **data):
    return json.dumps({"database": database, "table": table, "type": kind, "ts": ts, "data": data})


def log(mid, ts, is_new="1", **parts):
    return json.dumps({"common": {"mid": mid, "is_new": is_new, "sc": "1", "uid": "u" + mid}, "ts": ts * 1000, **parts})


def config(op, at, table, kind, sink, sink_type, columns, pk=None):
    image = {"source_table": table, "source_type": kind, "sink_table": sink, "sink_type": sink_type,
             "sink_columns": columns, "sink_pk": pk}
    return json.dumps({"op": op, "before": image if op == "d" else None,
                       "after": None if op == "d" else image, "ts_ms": at})


CONFIG = [
    config("r", 1, "base_source", None, "DIM_BASE_SOURCE", "dim", "id,source_site", "id"),
    config("r", 2, "base_province", None, "DIM_BASE_PROVINCE", "dim", "id,name", "id"),
    config("c", 3, "course_info", None, "DIM_COURSE_INFO", "dim", "id,course_name,subject_id", "id"),
    config("c", 4, "base_subject_info", None, "DIM_BASE_SUBJECT_INFO", "dim", "id,subject_name,category_id", "id"),
    config("c", 5, "base_category_info", None, "DIM_BASE_CATEGORY_INFO", "dim", "id,category_name", "id"),
    config("c", 6, "test_paper", None, "DIM_TEST_PAPER", "dim", "id,paper_title,course_id", "id"),
    config("c", 7, "test_question_info", None, "DIM_TEST_QUESTION_INFO", "dim", "id,question_txt", "id"),
    config("c", 8, "video_info", None, "DIM_VIDEO_INFO", "dim", "id,chapter_id", "id"),
    config("c", 9, "chapter_info", None, "DIM_CHAPTER_INFO", "dim", "id,chapter_name", "id"),
    config("c", 10, "user_info", "insert", "dwd_user_register", "dwd", "create_time"),
    config("c", 11, "review_info", "insert", "dwd_interaction_comment", "dwd",
           "course_id,user_id,review_stars,create_time"),
    config("c", 12, "gone", None, "DIM_GONE", "dim", "id", "id"),
    config("d", 13, "gone", None, "DIM_GONE", "dim", "id", "id"),
    # the same source table for another kind of sink leaves the dimension alone
    config("c", 14, "course_info", "insert", "dwd_course", "dwd", "id"),
]

CHANGES = [
    change("base_source", T0, "bootstrap-insert", id="1", source_site="site one", junk="x"),
    change("base_province", T0, "bootstrap-insert", id="11", name="north"),
    change("base_province", T0 + 1, "update", id="11", name="far north"),
    change("course_info", T0, id="c1", course_name="Algebra", subject_id="s1"),
    change("base_subject_info", T0, id="s1", subject_name="Maths", category_id="k1"),
    change("base_category_info", T0, id="k1", category_name="bootstrap-science"),
    change("test_paper", T0, id="p1", paper_title="Paper", course_id="c1"),
    change("test_question_info", T0, id="q1", question_txt="Why?"),
    change("video_info", T0, id="v1", chapter_id="h1"),
    change("chapter_info", T0, id="h1", chapter_name="Chapter one"),
    change("course_info", T0, "delete", id="c1", course_name="never"),
    change("course_info", T0, database="elsewhere", id="c1", course_name="never"),
    "not json", '{"database": "edu", "table": "course_info", "type": "insert", "data": {}, "ts": 1}',
    change("cart_info", T0 + 1, id="1", user_id="u1", course_id="c1", course_name="Algebra"),
    change("cart_info", T0 + 2, id="2", user_id="u2", course_id="c1", course_name="Algebra"),
    change("order_info", T0 + 1, id="o1", province_id="11"),
    change("order_info", T0 + 1, id="o2", province_id="99"),
    change("order_detail", T0 + 1, id="d1", course_id="c1", course_name="Algebra", order_id="o1", user_id="u1",
           final_amount="10.00", create_time="x"),
    change("order_detail", T0 + 1, id="d2", course_id="c1", course_name="Algebra", order_id="o1", user_id="u1",
           final_amount="5.50", create_time="x"),
    change("order_detail", T0 + 2, id="d3", course_id="c9", course_name="Other", order_id="o2", user_id="u2",
           final_amount="1.00", create_time="x"),
    change("payment_info", T0 + 9, id="p1", order_id="o1", create_time="x", payment_type="card"),
    change("payment_info", T0 + 9, "update", id="p2", order_id="o2", create_time="x", payment_type="card"),
    change("payment_info", T0 + 9, "update", id="p3", order_id="o2", create_time="x", payment_type="card",
           callback_time="now"),
    change("test_exam", T0 + 1, id="e1", score="80", duration_sec="100"),
    change("test_exam_question", T0 + 1, id="x1", exam_id="e1", paper_id="p1", question_id="q1", user_id="u1",
           is_correct="1", score="5", create_time="x"),
    change("test_exam_question", T0 + 1, id="x2", exam_id="e1", paper_id="p1", question_id="q1", user_id="u1",
           is_correct="0", score="0", create_time="x"),
    change("user_info", T0 + 1, id="u1", create_time="2024-01-01 00:00:01"),
    change("user_info", T0 + 1, "update", id="u1", create_time="2024-01-01 00:00:01"),
    change("review_info", T0 + 1, id="r1", course_id="c1", user_id="u1", review_stars="5",
           create_time="2024-01-01 00:00:01"),
    change("review_info", T0 + 1, id="r2", course_id="c1", user_id="u2", review_stars="4",
           create_time="2024-01-01 00:00:01"),
]

LOGS = [
    log("m1", T0 + 1, page={"page_id": "home", "during_time": 100, "sc": "ignored"},
        actions=[{"action_id": "a", "ts": 1}, {"action_id": "b"}]),
    log("m1", T0 + 2, page={"page_id": "order", "last_page_id": "home", "item": "o1", "item_type": "order_id"},
        displays=[{"item": "1"}]),
    log("m2", T0 + 2, is_new="0", page={"page_id": "search", "item": "java", "item_type": "keyword"}),
    log("m1", T0 + 86_401, page={"page_id": "course_detail", "last_page_id": "home"}),
    log("m3", T0 + 3, start={"entry": "icon"}, err={"code": 7},
        appVideo={"video_id": "v1", "sid": "s", "user_id": "u3", "play_sec": 20}),
]

CLOSING_CHANGES = [
    change("cart_info", LATER, id="z", course_id="zz"), change("order_info", LATER, id="oz", province_id="z"),
    change("order_detail", LATER, id="dz", order_id="oz", course_id="zz", final_amount="0", user_id="z"),
    change("payment_info", LATER, id="pz", order_id="oz"),
    change("test_exam", LATER, id="ez", score="0", duration_sec="0"),
    change("test_exam_question", LATER, id="xz", exam_id="ez", paper_id="z", question_id="z", user_id="z"),
    change("user_info", LATER, id="z", create_time="2024-01-05 00:00:00"),
    change("review_info", LATER, id="z", course_id="z", user_id="z", review_stars="1", create_time="2024-01-05 00:00:00"),
]
CLOSING_LOGS = [
    log("mz", LATER, page={"page_id": "home"}), log("mz", LATER, page={"page_id": "order", "item": "oz",
                                                                       "item_type": "order_id"}),
    log("mz", LATER, page={"page_id": "search", "item": "end", "item_type": "keyword"}),
    log("mz", LATER, appVideo={"video_id": "v1", "sid": "z", "user_id": "z", "play_sec": 1}),
]


def write(folder, topic, number, lines):
    path = folder / topic
    path.mkdir(exist_ok=True)
    (path / f"part-{number}.txt").write_text("\n".join(lines) + "\n")


def run(*starts):
    """Start the queries together and wait for all of them."""
    for query in [start() for start in starts]:
        query.awaitTermination()
        assert query.exception() is None


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    w = Warehouse(spark, str(folder), "edu", every=None, dim_database="dims_e2e")
    write(folder, schemas.CHANGE_LOG_TOPIC, 0, CHANGES + CLOSING_CHANGES)
    write(folder, schemas.RAW_LOG_TOPIC, 0, LOGS + CLOSING_LOGS)
    write(folder, "table_process", 0, CONFIG)
    run(w.config, w.logs, w.cart_adds, w.exam_questions)
    run(w.dim_rows, w.routed, w.order_details)
    run(w.payments)
    run(*[lambda t=t: w.summary(t) for t in windows.SUMMARIES])
    return w


def rows(w, table, *columns):
    first_days = w.windows(table).where("stt < '2024-01-05'")
    return sorted(tuple(r) for r in first_days.select(*columns).collect())


def test_dims_hold_latest_rows(warehouse):
    read = warehouse.dims.read
    assert [tuple(r) for r in read("dim_base_province").collect()] == [("11", "far north")]
    assert [tuple(r) for r in read("dim_base_source").collect()] == [("1", "site one")]
    assert read("dim_course_info").first().course_name == "Algebra"
    # only the type of a change is rewritten, never its data
    assert read("dim_base_category_info").first().category_name == "bootstrap-science"
    assert not warehouse.dims.exists("dim_gone")


def test_logs_are_split_and_repaired(spark, warehouse):
    written = spark.read.schema("value string, topic string").text(f"{warehouse.folder}/topics/dwd_logs")
    got = {}
    for r in written.collect():
        row = json.loads(r.value)
        if row["mid"] != "mz":
            got.setdefault(r.topic, []).append(row)
    assert {t: len(v) for t, v in got.items()} == {
        "dwd_traffic_page": 4, "dwd_traffic_action": 2, "dwd_traffic_display": 1, "dwd_traffic_start": 1,
        "dwd_traffic_err": 1, "dwd_traffic_appVideo": 1}
    assert {a["ts"] for a in got["dwd_traffic_action"]} == {str((T0 + 1) * 1000)}
    assert {p["sc"] for p in got["dwd_traffic_page"]} == {"1"}
    flags = {(p["mid"], p["ts"]): p["is_new"] for p in got["dwd_traffic_page"]}
    assert flags[("m1", str((T0 + 1) * 1000))] == "1"
    assert flags[("m1", str((T0 + 86_401) * 1000))] == "0"


STT, EDT = "2024-01-01 00:00:00", "2024-01-01 00:00:05"


def test_traffic(warehouse):
    assert rows(warehouse, "dws_traffic_source_page_view_window", "stt", "source_name", "is_new", "uv_ct", "sv_ct",
                "pv_ct", "dur_sum") == [
        (STT, "site one", "0", 1, 1, 1, 0), (STT, "site one", "1", 1, 1, 2, 100),
        ("2024-01-02 00:00:00", "site one", "0", 1, 0, 1, 0)]
    assert rows(warehouse, "dws_traffic_keyword_window", "stt", "edt", "keyword", "keyword_count") == [
        (STT, EDT, "java", 1)]
    assert rows(warehouse, "dws_user_traffic_home_detail_page_view_window", "stt", "home_count", "detail_count") == [
        (STT, 1, 0), ("2024-01-02 00:00:00", 0, 1)]
    assert rows(warehouse, "dws_user_user_login_window", "stt", "user_count", "back_count") == [
        (STT, 2, 0), ("2024-01-02 00:00:00", 1, 0)]
    assert rows(warehouse, "dws_user_user_register_window", "stt", "user_register_count") == [(STT, 1)]


def test_trade(warehouse):
    assert rows(warehouse, "dws_trade_cart_add_window", "course_id", "course_name", "subject_name", "category_name",
                "cart_count") == [("c1", "Algebra", "Maths", "bootstrap-science", 2)]
    got = [(c, n, s, o, u, float(a)) for c, n, s, o, u, a in rows(
        warehouse, "dws_trade_course_order_window", "course_id", "course_name", "subject_id", "order_count",
        "user_count", "final_amount")]
    assert got == [("c1", "Algebra", "s1", 1, 1, 15.5), ("c9", "Other", None, 1, 1, 1.0)]
    got = [(p, n, o, float(a)) for p, n, o, a in rows(
        warehouse, "dws_trade_province_order_window", "province_id", "province_name", "order_count", "final_amount")]
    assert got == [("11", "far north", 1, 15.5), ("99", None, 1, 1.0)]
    got = [(i, n, o, float(a)) for i, n, o, a in rows(
        warehouse, "dws_trade_source_order_window", "source_id", "source_name", "order_count", "final_amount")]
    assert got == [("1", "site one", 1, 15.5)]
    assert rows(warehouse, "dws_trade_pay_suc_window", "stt", "province_id", "user_count") == [
        ("2024-01-01 00:00:05", "11", 1), ("2024-01-01 00:00:05", "99", 1)]
    day = report.stored_order_by_source(warehouse.window_tables, "dws_trade_source_order_window", "20240101")
    assert [(r.source_name, float(r.final_amount)) for r in day.collect()] == [("site one", 15.5)]


def test_exams_reviews_and_videos(warehouse):
    assert rows(warehouse, "dws_interaction_course_review_window", "course_name", "avg_score", "user_count",
                "good_rate", "avg_score_exact") == [("Algebra", 4, 2, 0, 4.5)]
    assert rows(warehouse, "dws_exam_paper_window", "paper_name", "course_name", "subject_name", "avg_score",
                "user_count", "avg_dur_sec") == [("Paper", "Algebra", "Maths", 80.0, 1, 100)]
    assert rows(warehouse, "dws_exam_question_window", "question_name", "answer_count", "correct_answer_count",
                "answer_user_count", "correct_answer_user_count") == [("Why?", 2, 1, 1, 1)]
    assert rows(warehouse, "dws_play_video_chapter_window", "chapter_id", "chapter_name", "play_count", "play_sec",
                "user_count") == [("h1", "Chapter one", 1, 20, 1)]


def test_config_update_drops_rows(warehouse):
    store = warehouse.dims
    make = warehouse.spark.createDataFrame
    columns = "op string, ts_ms bigint, " + ", ".join(f"{c} string" for c in schemas.CONFIG.fieldNames())

    def changed(op, sink_columns):
        return make([(op, 1, "t", None, "DIM_T", "dim", sink_columns, "id", "salt=1")], columns)

    store.apply(changed("c", "id,a"))
    data = make([({"id": "1", "A": "x"}, 5, 0)], "data map<string,string>, ts bigint, seq bigint")
    store.upsert(data, 0, "dim_t")
    store.apply(changed("c", "id,a"))
    assert store.read("dim_t").count() == 1
    store.apply(changed("u", "id,a"), keep_rows=True)
    assert store.read("dim_t").count() == 1
    store.apply(changed("u", "id,a,b"))
    assert store.read("dim_t").count() == 0 and store.columns("dim_t") == ["id", "a", "b"]
    store.apply(changed("d", "id,a"))
    assert not store.exists("dim_t")


def test_dim_upsert_is_idempotent_and_compacts(warehouse):
    store, make = warehouse.dims, warehouse.spark.createDataFrame
    store.create("dim_u", "id,name", "id")
    schema = "data map<string,string>, ts bigint, seq bigint"
    first = make([({"id": "1", "name": "a"}, 1, 1), ({"id": "1", "name": "b"}, 1, 2), ({"id": "2", "name": "c"}, 1, 3)],
                 schema)
    second = make([({"id": "2", "name": "d"}, 1, 1)], schema)
    store.upsert(first, 0, "dim_u")
    store.upsert(first, 0, "dim_u")
    store.upsert(second, 1, "dim_u")
    assert warehouse.spark.table("dims_e2e.dim_u").count() == 4
    want = [("1", "b"), ("2", "d")]
    assert sorted(tuple(r) for r in store.read("dim_u").collect()) == want
    assert [tuple(r) for r in store.row("dim_u", "2").collect()] == [("2", "d")]
    assert store.row("dim_u", "3").count() == 0
    store.compact("dim_u")
    assert warehouse.spark.table("dims_e2e.dim_u").count() == 6     # a reader that has begun finds its files
    assert sorted(tuple(r) for r in store.read("dim_u").collect()) == want
    store.upsert(make([({"id": "1", "name": "e"}, 0, 0)], schema), 2, "dim_u")
    store.upsert(second, 1, "dim_u")                                # a batch that is folded already runs again
    store.compact("dim_u")
    assert warehouse.spark.table("dims_e2e.dim_u").count() == 5
    assert sorted(tuple(r) for r in store.read("dim_u").collect()) == [("1", "e"), ("2", "d")]


def test_many_batches_leave_few_partitions(spark):
    store = sinks.DimStore(spark, "dims_many", fold_every=5)
    rows = "sink_table string, sink_columns string, sink_pk string, data map<string,string>, ts bigint, seq bigint"
    for n in range(50):
        made = [("DIM_M", "id,n", "id", {"id": str(n % 7), "n": str(x)}, 1, x) for x in (n, n - 1)]
        store.upsert_routed(spark.createDataFrame(made, rows), n)   # the table is made by its first rows
        assert spark.sql("SHOW PARTITIONS dims_many.dim_m").count() <= 12
    assert {r.id: r.n for r in store.read("dim_m").collect()} == {str(n % 7): str(n) for n in range(43, 50)}


def test_three_updates_in_one_second(spark):
    store = sinks.DimStore(spark, "dims_second")
    store.create("dim_s", "id,n", "id")
    lines = [json.dumps({"database": "edu", "table": "s", "type": "update", "ts": 1, "xid": 7, "xoffset": x,
                         "data": {"id": str(k), "n": str(x)}}) for k in range(8) for x in (2, 0, 1)]
    changes = filters.clean_changes(filters.parse_changes(spark.createDataFrame([(x,) for x in lines], "value string")), "edu")
    store.upsert(changes, 0, "dim_s")
    assert {tuple(r) for r in store.read("dim_s").collect()} == {(str(k), "2") for k in range(8)}
    with pytest.raises(ValueError, match="seq"):
        store.upsert(changes.drop("seq"), 1, "dim_s")


def test_an_update_that_runs_again_keeps_rows(spark):
    store = sinks.DimStore(spark, "dims_again")
    columns = "op string, ts_ms bigint, " + ", ".join(f"{c} string" for c in schemas.CONFIG.fieldNames())
    update = spark.createDataFrame([("u", 1, "t", None, "DIM_T", "dim", "id", "id", None)], columns)
    store.apply(update, batch=3)
    store.upsert(spark.createDataFrame([({"id": "1"}, 1, 1)], "data map<string,string>, ts bigint, seq bigint"), 0, "dim_t")
    store.apply(update, batch=3)
    assert store.read("dim_t").count() == 1
    store.apply(update, batch=4)
    assert store.read("dim_t").count() == 0


def test_two_warehouses_and_a_restart(spark, tmp_path):
    """Each goes on from its own place, and a row of a dimension and its config row may come together."""
    made = []
    for n in range(2):
        folder = tmp_path / str(n)
        folder.mkdir()
        write(folder, "table_process", 0, [config("c", 1, "base_source", None, "DIM_BASE_SOURCE", "dim", "id,source_site", "id")])
        write(folder, schemas.CHANGE_LOG_TOPIC, 0, [change("base_source", T0, id="1", source_site=f"site {n}")])
        made.append(Warehouse(spark, str(folder), "edu", every=None, dim_database=f"dims_side_{n}"))
    for part in (0, 1):
        run(*[w.config for w in made])
        run(*[w.dim_rows for w in made])
        for n, w in enumerate(made):
            want = {("1", f"site {n}")} | ({("2", "more")} if part else set())
            assert {tuple(r) for r in w.dims.read("dim_base_source").collect()} == want
            write(tmp_path / str(n), schemas.CHANGE_LOG_TOPIC, 1 + part, [change("base_source", T0, id="2", source_site="more")])


def test_late_payment_is_found(spark, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    w = Warehouse(spark, str(folder), "edu", every=None, dim_database="dims_late")
    write(folder, schemas.CHANGE_LOG_TOPIC, 0, [change("payment_info", T0 + 3 * 86_400, id="p", order_id="o")])
    path = folder / "topics" / "dwd_trade_order_detail" / "topic=dwd_trade_order_detail"
    path.mkdir(parents=True)
    (path / "0.txt").write_text(json.dumps({"id": "d", "order_id": "o", "final_amount": "5", "ts": T0, "seq": 1}) + "\n")
    run(w.payments)
    found = spark.read.schema("value string, topic string").text(f"{folder}/topics/dwd_trade_pay_suc_detail").collect()
    assert [json.loads(r.value)["order_detail_amount"] for r in found] == ["5"]
