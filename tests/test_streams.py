"""Streams over several micro-batches: state that lasts, rows that come late, keys that are forgotten."""

import json
import os

import pytest

from eduflow import schemas
from eduflow.operators import filters
from eduflow.streaming import states

T0 = 1_704_067_200


def batches(spark, folder, schema, *groups):
    """One file per micro-batch, in order."""
    folder.mkdir()
    for n, rows in enumerate(groups):
        path = folder / f"{n}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (1_000_000 + n, 1_000_000 + n))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def result(spark, rows, folder):
    query = (rows.writeStream.format("parquet").option("path", str(folder / "rows"))
             .option("checkpointLocation", str(folder / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(str(folder / "rows")).collect()


def order(at, amount, ident="d", course="c", seq=0):
    return {"id": ident, "order_id": "o" + ident, "user_id": "u", "course_id": course, "course_name": "n",
            "province_id": "p", "sc": "s", "final_amount": str(amount), "ts": T0 + at, "seq": seq}


def orders(spark, tmp_path, keep_ms, *groups):
    stream = batches(spark, tmp_path / "in", schemas.ORDER_DETAIL, *groups)
    rows = result(spark, states.windowed("dws_trade_course_order_window", stream, keep_ms=keep_ms), tmp_path)
    return sorted((r.stt[-8:], r.course_id, r.order_count, float(r.final_amount)) for r in rows)


def test_a_correction_counts_only_while_its_window_is_open(spark, tmp_path):
    got = orders(spark, tmp_path, None,
                 [order(1, 10)], [order(2, 12)],        # corrected in an open window
                 [order(30, 9), order(30, 1, "e")],     # the window of the row given again is not closed yet
                 [order(31, 20)],                       # gives the row of :30 again
                 [order(60, 0, "w", "w")],
                 [order(61, 7)],                        # the window of the row of :31 is closed
                 [order(200, 0, "z", "z")], [order(300, 0, "y", "z")])
    assert got == [("00:00:00", "c", 1, 9.0), ("00:00:30", "c", 2, 12.0), ("00:01:00", "w", 1, 0.0),
                   ("00:03:20", "z", 1, 0.0)]


def test_a_key_is_forgotten(spark, tmp_path):
    got = orders(spark, tmp_path, 10_000,
                 [order(1, 10)], [order(100, 1, "e")], [order(101, 1, "f")], [order(102, 5)],
                 [order(200, 0, "z", "z")], [order(300, 0, "y", "z")])
    # seen as a first row: five, not minus five at the closed window
    assert got == [("00:00:00", "c", 1, 10.0), ("00:01:40", "c", 3, 7.0), ("00:03:20", "z", 1, 0.0)]


def test_rows_of_one_second_keep_their_order(spark, tmp_path):
    got = orders(spark, tmp_path, None,
                 [order(1, a, f"d{k}", f"c{k}", seq) for k in range(8) for a, seq in ((12, 2), (10, 1), (15, 3))],
                 [order(60, 0, "w", "w")], [order(200, 0, "z", "z")], [order(300, 0, "y", "z")])
    assert [(c, a) for _, c, _, a in got][:8] == [(f"c{k}", 15.0) for k in range(8)]


def test_keys_that_share_a_state_are_corrected_and_forgotten_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(states, "GROUPS", 1)
    got = orders(spark, tmp_path, 10_000,
                 [order(1, 10), order(1, 20, "e", "b")], [order(2, 12), order(2, 25, "e", "b")],
                 [order(100, 1, "f", "f"), order(100, 4, "e", "b")],    # `e` has come, `d` is forgotten after this
                 [order(101, 1, "g", "g")],
                 [order(102, 5), order(102, 6, "e", "b")],
                 [order(200, 0, "z", "z")], [order(300, 0, "y", "z")])
    assert got == [("00:00:00", "b", 1, 4.0), ("00:00:00", "c", 1, 12.0), ("00:01:40", "b", 1, 2.0),
                   ("00:01:40", "c", 1, 5.0), ("00:01:40", "f", 1, 1.0), ("00:01:40", "g", 1, 1.0),
                   ("00:03:20", "z", 1, 0.0)]


def test_a_fact_sent_again_a_day_later_adds_nothing(spark, tmp_path):
    got = orders(spark, tmp_path, None, [order(1, 10)], [order(90_000, 10)], [order(90_100, 10)],
                 [order(200_000, 0, "z", "z")], [order(300_000, 0, "y", "z")])
    assert sum(a for _, c, _, a in got if c == "c") == 10.0


def test_a_row_without_a_time_does_no_harm(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", schemas.PAGE_LOG, [page(1), {"mid": "m", "uid": "u"}], [page(2)],
                     [page(200, mid="z")], [page(300, mid="z")])
    rows = result(spark, states.windowed("dws_traffic_source_page_view_window", stream), tmp_path)
    assert sorted((r.uv_ct, r.pv_ct) for r in rows)[-1] == (1, 2)


def page(at, mid="m", uid="u", **more):
    return {"mid": mid, "uid": uid, "sc": "1", "is_new": "1", "ts": (T0 + at) * 1000, **more}


def test_visitors_and_late_rows(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", schemas.PAGE_LOG,
                     [page(1), page(2, last_page_id="home")], [page(3), page(86_401)],
                     [page(86_402, mid="n")],
                     [page(4, mid="late")],      # the watermark of the batch before has passed its window
                     [page(200_000, mid="z")], [page(300_000, mid="z")])
    rows = result(spark, states.windowed("dws_traffic_source_page_view_window", stream), tmp_path)
    assert sorted((r.stt, r.uv_ct, r.sv_ct, r.pv_ct) for r in rows) == [
        ("2024-01-01 00:00:00", 1, 2, 3), ("2024-01-02 00:00:00", 2, 2, 2), ("2024-01-03 07:33:20", 1, 1, 1)]


def test_returning_users(spark, tmp_path):
    day = 86_400
    stream = batches(spark, tmp_path / "in", schemas.PAGE_LOG,
                     [page(36_000), page(36_000, uid="v")], [page(8 * day - 60)], [page(8 * day, uid="v")],
                     [page(30 * day, uid="z")], [page(31 * day, uid="z")])
    rows = result(spark, states.windowed("dws_user_user_login_window", stream), tmp_path)
    assert sorted((r.stt, r.user_count, r.back_count) for r in rows) == [
        ("2024-01-01 10:00:00", 2, 0), ("2024-01-08 23:59:00", 1, 0), ("2024-01-09 00:00:00", 1, 1),
        ("2024-01-31 00:00:00", 1, 0)]


def test_new_visitor_flag_lasts(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", schemas.PAGE_LOG, [page(1)], [page(2)], [page(86_400), page(3)])
    rows = result(spark, states.repair_new_flag(stream.select("mid", "is_new", "ts")), tmp_path)
    assert sorted((r.ts // 1000 - T0, r.is_new) for r in rows) == [(1, "1"), (2, "1"), (3, "1"), (86_400, "0")]


def test_watermark_is_on_the_event_time(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", schemas.PAGE_LOG, [page(1)])
    timed = filters.event_timed(stream, delay="3 seconds")
    assert "et" in timed.columns
    with pytest.raises(Exception, match="watermark"):
        result(spark, stream.groupBy("mid").count(), tmp_path)


def test_state_of_distinct_counts_holds_no_more_than_it_needs(spark, tmp_path):
    def answer(at, user, correct):
        return {"question_id": "q", "user_id": user, "is_correct": correct, "ts": T0 + at}

    stream = batches(spark, tmp_path / "in", "question_id string, user_id string, is_correct string, ts bigint",
                     [answer(1, "a", "1"), answer(2, "a", "0"), answer(3, None, "0"), answer(9, "b", "1")],
                     [answer(60, "a", "1")], [answer(120, "a", "1")], [answer(180, "a", "1")])
    rows = result(spark, states.windowed("dws_exam_question_window", stream), tmp_path)
    first = {r.stt[-8:]: (r.answer_count, r.correct_answer_count, r.answer_user_count, r.correct_answer_user_count) for r in rows}
    assert first["00:00:00"] == (3, 1, 2, 1) and first["00:00:05"] == (1, 1, 1, 1) and first["00:01:00"] == (1, 1, 1, 1)
    keys, values = set(), set()
    for operator in (0, 1):
        held = spark.read.format("statestore").option("operatorId", operator).load(str(tmp_path / "state")).schema
        keys.add(tuple(f.dataType.simpleString() for f in held["key"].dataType))
        values.add(len(held["value"].dataType))
    assert keys == {("timestamp", "string"), ("timestamp", "string", "string")} and values == {3, 4}
    assert spark.conf.get("spark.sql.streaming.stateStore.compression.codec") == "zstd"
