"""Rows given early and taken back, silent sources, wide arrival numbers, and config that changes while streams run."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from eduflow import schemas
from eduflow.operators import filters, joins
from eduflow.sources import topics
from eduflow.streaming import sinks
from eduflow.streaming.config_store import ConfigStore
from eduflow.streaming.jobs import Warehouse
from test_streams import T0, batches
from test_warehouse import change, write

EMPTY = {"database": "edu", "table": "none", "type": "insert", "ts": T0, "data": {"id": "0"}}


def detail(ident, order, at, amount="1"):
    return {"id": ident, "order_id": order, "course_id": "c", "user_id": "u", "final_amount": amount, "ts": T0 + at, "seq": at}


def changes_of(spark, tmp_path, details, infos, sources):
    """Three streams of micro-batches through the join that takes rows back; what each micro-batch wrote, in order."""
    live = [filters.event_timed(batches(spark, tmp_path / name, schema, *groups), unit, "3 seconds") for name, schema, unit, groups in (
        ("d", "id string, course_id string, course_name string, order_id string, user_id string, final_amount string, "
              "create_time string, ts bigint, seq decimal(38,0)", "s", details),
        ("i", "id string, province_id string, ts bigint", "s", infos), ("p", "item string, sc string, ts bigint", "ms", sources))]
    rows = joins.order_detail_changes(*live, ("1 hour", "1 hour"), ("30 minutes", "5 seconds"))
    path = str(tmp_path / "topics")
    sinks.write_changes(rows, str(tmp_path), "orders", "id", "parquet", path, None).awaitTermination()
    found = spark.read.parquet(path).orderBy("batch", "key", "place").collect()
    out = {}
    for r in found:
        out.setdefault(r.batch, []).append((r.key, None if r.value is None else json.loads(r.value).get("sc", "none")))
    said = {r.key: json.loads(r.value).get("sc") for r in topics.folded(spark, "orders", path).collect()}
    return list(out.values()), said


def test_a_row_is_taken_back_when_its_source_comes(spark, tmp_path):
    info = {"id": "o", "province_id": "p", "ts": T0}
    raw, said = changes_of(
        spark, tmp_path, [[detail("d1", "o", 1), detail("d2", "o", 2)], [], [detail("d3", "o", 40)]], [[info], [], []],
        [[], [{"item": "o", "sc": "7", "ts": T0 * 1000}], []])
    assert raw == [[("d1", "none"), ("d2", "none")], [("d1", None), ("d1", "7"), ("d2", None), ("d2", "7")], [("d3", "7")]]
    assert said == {"d1": "7", "d2": "7", "d3": "7"}


def test_a_source_out_of_time_changes_nothing(spark, tmp_path):
    info = {"id": "o", "province_id": "p", "ts": T0}
    raw, said = changes_of(spark, tmp_path, [[detail("d1", "o", 1)], []], [[info], []],
                           [[], [{"item": "o", "sc": "7", "ts": (T0 + 60) * 1000}]])
    assert raw == [[("d1", "none")]] and said == {"d1": None}


def test_a_detail_without_its_order_waits(spark, tmp_path):
    raw, said = changes_of(spark, tmp_path, [[detail("d1", "o", 1)], []], [[], [{"id": "o", "province_id": "p", "ts": T0}]],
                           [[{"item": "o", "sc": "7", "ts": T0 * 1000}], []])
    assert raw == [[("d1", "7")]] and said == {"d1": "7"}


def test_keys_that_are_taken_back_are_gone(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "{}", (1, None, 0)), ("b", "{}", (1, None, 0)), ("b", None, (1, None, 1))],
        f"key string, value string, place struct<ts:bigint,seq:{schemas.SEQ.simpleString()},version:bigint>")
    rows.withColumns({"topic": F.lit("t"), "batch": F.lit(0)}).write.partitionBy("topic", "batch").parquet(str(tmp_path / "t"))
    assert [r.key for r in topics.folded(spark, "t", str(tmp_path / "t")).collect()] == ["a"]


def test_details_are_given_early_and_read_on(spark, tmp_path):
    """The wired job: a keyed topic that downstream streams read like any other, rows taken back left out."""
    w = Warehouse(spark, str(tmp_path), "edu", every=None, dim_database="dims_early", early_details=True)
    write(tmp_path, schemas.CHANGE_LOG_TOPIC, 0, [
        change("order_info", T0, id="o", province_id="1"), change("payment_info", T0, id="p", order_id="o"),
        change("order_detail", T0, id="d", order_id="o", course_id="c", user_id="u", final_amount="5")])
    pages = tmp_path / "topics" / "dwd_logs" / "topic=dwd_traffic_page"
    pages.mkdir(parents=True)
    (pages / "0.txt").write_text("{}\n")
    w.order_details().awaitTermination()
    (pages / "1.txt").write_text(json.dumps({"page_id": "order", "item_type": "order_id", "item": "o", "sc": "3", "ts": T0 * 1000}) + "\n")
    w.order_details().awaitTermination()
    said = topics.folded(spark, "dwd_trade_order_detail", f"{tmp_path}/topics/dwd_trade_order_detail").collect()
    assert [(r.key, json.loads(r.value)["sc"]) for r in said] == [("d", "3")]
    w.payments().awaitTermination()
    paid = spark.read.schema("value string, topic string").text(f"{tmp_path}/topics/dwd_trade_pay_suc_detail").collect()
    assert sorted(json.loads(r.value).get("sc", "none") for r in paid) == ["3", "none"]


def test_a_silent_page_log_holds_nothing_back(spark, tmp_path):
    """Orders flow, the page log stops: details without a source still come out."""
    w = Warehouse(spark, str(tmp_path), "edu", every=None, dim_database="dims_idle")
    pages = tmp_path / "topics" / "dwd_logs" / "topic=dwd_traffic_page"
    pages.mkdir(parents=True)
    (pages / "0.txt").write_text(json.dumps({"page_id": "order", "item_type": "order_id", "item": "o1", "sc": "3", "ts": T0 * 1000}) + "\n")
    for n, at in enumerate((0, 600, 7200, 14_400, 14_460)):
        write(tmp_path, schemas.CHANGE_LOG_TOPIC, n, [
            change("order_info", T0 + at, id=f"o{n + 1}", province_id="1"),
            change("order_detail", T0 + at, id=f"d{n + 1}", order_id=f"o{n + 1}", course_id="c", user_id="u", final_amount="5")])
        w.order_details().awaitTermination()
    rows = spark.read.schema("value string, topic string").text(f"{tmp_path}/topics/dwd_trade_order_detail").collect()
    found = {json.loads(r.value)["id"]: json.loads(r.value).get("sc") for r in rows}
    assert found["d1"] == "3" and found["d2"] is None and {"d1", "d2"} <= set(found)


def test_wide_transactions_do_not_end_the_stream(spark):
    lines = [json.dumps({**EMPTY, "xid": x, "xoffset": o}) for x, o in (
        (9_223_372_036_854_775_807, 5), (600_000_000_000, 1 << 30), (600_000_000_001, 0), (7, 2), (7, None))]
    lines += [json.dumps(EMPTY), "no json"]
    rows = filters.parse_changes(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    seq = [r.seq for r in rows]
    assert seq[1] < seq[2] < seq[0] and seq[4] < seq[3] < seq[1] and seq[5] == seq[6] == Decimal(-1)


CONFIG = f"op string, ts_ms bigint, pos bigint, {', '.join(f'{c} string' for c in schemas.CONFIG.fieldNames())}"


def config_row(op, at, pos, table, columns, kind="dim", change_type=None):
    return (op, at, pos, table, change_type, f"SINK_{table}", kind, columns, "id", None)


def test_config_snapshots_stay_small_and_in_order(spark, tmp_path):
    store = ConfigStore(spark, str(tmp_path / "config"))
    make = lambda *rows: spark.createDataFrame(list(rows), CONFIG)
    now = lambda: sorted((r.source_table, r.sink_columns) for r in store.read().collect())
    assert now() == []
    # changes of one millisecond follow their place in the log
    store.fold(make(config_row("c", 1, 1, "a", "id"), config_row("u", 1, 3, "a", "id,y"), config_row("u", 1, 2, "a", "id,x")), 0)
    assert now() == [("a", "id,y")]
    store.fold(make(config_row("c", 0, 1, "b", "id"), config_row("d", 2, 1, "a", "id,y")), 1)
    assert now() == [("b", "id")]       # a later batch wins whatever its time
    store.fold(make(config_row("c", 0, 1, "b", "id"), config_row("d", 2, 1, "a", "id,y")), 1)
    assert now() == [("b", "id")]
    for n in range(2, 12):
        store.fold(make(config_row("u", n, 1, "b", f"id,n{n}"), config_row("c", n, 1, "t", "id", "dwd", "insert"),
                        config_row("c", n, 2, "t", "id", "dwd", "update")), n)
    assert now() == [("b", "id,n11"), ("t", "id"), ("t", "id")] and store.snapshots() == [9, 10, 11]
    assert len(list((tmp_path / "config").rglob("*.parquet"))) == 3
    # a snapshot that is not complete is not seen
    (tmp_path / "config" / "snapshot=12").mkdir()
    assert store.snapshots() == [9, 10, 11]


def test_what_changes_of_a_table_come_to(spark):
    store = sinks.DimStore(spark, "dims_net")
    for n, (rows, columns) in enumerate([
            ([("c", 1, "id,a"), ("c", 2, "id,b")], ["id", "a"]),                    # made by the first, kept by the second
            ([("c", 3, "id,c")], ["id", "a"]),                                      # it is there
            ([("u", 4, "id,d"), ("c", 5, "id,e")], ["id", "d"]),                    # an update makes it anew
            ([("d", 6, "id"), ("r", 7, "id,f"), ("c", 8, "id,g")], ["id", "f"]),
            ([("u", 9, "id,h"), ("d", 10, "id")], None)]):
        made = [config_row(op, at, 0, "net", columns_) for op, at, columns_ in reversed(rows)]
        store.apply(spark.createDataFrame(made, CONFIG), batch=n)
        assert (store.columns("sink_net") if store.exists("sink_net") else None) == columns


def test_a_config_change_between_batches_takes_effect(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), "edu", every=None, dim_database="dims_between")

    def step(n, config, *rows):
        write(tmp_path, "table_process", n, config)
        write(tmp_path, schemas.CHANGE_LOG_TOPIC, n, [change("a", T0 + n, **r) for r in rows])
        w.config().awaitTermination()
        w.dim_rows().awaitTermination()
        return sorted(tuple(r) for r in w.dims.read("sink_a").collect()) if w.dims.exists("sink_a") else None

    def said(op, at, columns):
        image = {"source_table": "a", "sink_table": "SINK_A", "sink_type": "dim", "sink_columns": columns, "sink_pk": "id"}
        return json.dumps({"op": op, "ts_ms": at, "before" if op == "d" else "after": image})

    assert step(0, [said("c", 1, "id,x")], {"id": "1", "x": "p", "y": "q"}) == [("1", "p")]
    assert step(1, [said("u", 2, "id,y")], {"id": "2", "x": "p", "y": "q"}) == [("2", "q")]
    assert step(2, [said("d", 3, "id,y")], {"id": "3", "x": "p", "y": "q"}) is None
    assert step(3, [said("c", 4, "id")], {"id": "4", "x": "p", "y": "q"}) == [("4",)]


