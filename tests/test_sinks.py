"""Window tables, topics and preloaded configuration."""

from decimal import Decimal
from pathlib import Path

import pytest

from eduflow import schemas
from eduflow.functions import values as V
from eduflow.plans import report
from eduflow.sources import topics
from eduflow.streaming import sinks
from eduflow.streaming.jobs import Warehouse
from eduflow.streaming.window_store import WindowStore


WINDOWS = "stt string, edt string, source_name string, final_amount decimal(18,2)"


def windows_of(spark, *rows):
    """(day of the year, second, amount) to rows of a window table; a month has 28 days here."""
    made = [(f"2024-{1 + (d - 1) // 28:02d}-{1 + (d - 1) % 28:02d} 00:00:{s:02d}", "", "a", Decimal(n)) for d, s, n in rows]
    return spark.createDataFrame(made, WINDOWS)


def held(store, day=None):
    return sorted((r.stt[5:10], int(r.final_amount)) for r in store.read("t", day).collect())


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    store = WindowStore(spark, "windows_repeat", str(tmp_path / "w"))
    first = windows_of(spark, (1, 55, 1), (2, 0, 2))
    store.store("t", first, 0)
    store.store("t", first, 0)
    store.store("t", spark.createDataFrame([], WINDOWS), 1)
    store.store("t", first.where("stt >= '2024-01-02'"), 2)
    assert held(store) == [("01-01", 1), ("01-02", 2), ("01-02", 2)] and held(store, "20240102") == [("01-02", 2), ("01-02", 2)]
    assert [int(r.final_amount) for r in report.stored_order_by_source(store, "t", "20240102").collect()] == [4]
    assert report.stored_order_by_source(store, "t").count() == 0
    assert store.read("t", "20240102").columns == ["stt", "edt", "source_name", "final_amount", "ts", "dt"]


def test_a_report_reads_one_partition(spark, tmp_path):
    store = WindowStore(spark, "windows_one", str(tmp_path / "w"))
    store.store("t", windows_of(spark, *[(d, 0, d) for d in range(1, 85)]), 0)
    plan = report.stored_order_by_source(store, "t", "20240107")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and plan.count("FileScan") == 1
    scan = store.read("t", "20240107")
    assert len(scan.inputFiles()) == 1 and "mon=202401/batch=0" in scan.inputFiles()[0]
    assert held(store, "20240107") == [("01-07", 7)]


def test_fifty_batches_leave_few_files(spark, tmp_path):
    store = WindowStore(spark, "windows_many", str(tmp_path / "w"), fold_every=5)
    want = []
    for n in range(50):
        rows = [(27 + n // 20, n, n), (28 + n // 20, n, 100 + n)]
        store.store("t", windows_of(spark, *rows), n)
        want += [(f"{1 + (d - 1) // 28:02d}-{1 + (d - 1) % 28:02d}", x) for d, _, x in rows]
        assert max(len(b) for b in store.partitions("t").values()) <= 12
    assert held(store) == sorted(want)
    assert held(store, "20240128") == sorted(w for w in want if w[0] == "01-28")
    store.fold("t")
    store.fold("t")
    assert {d: len(b) for d, b in store.partitions("t").items()} == {"202401": 1, "202402": 1}
    assert len(list((tmp_path / "w").rglob("*.parquet"))) == 2 and held(store) == sorted(want)


def test_folded_batches_that_run_again_change_nothing(spark, tmp_path):
    store = WindowStore(spark, "windows_again", str(tmp_path / "w"), fold_every=100)
    for n in range(3):
        store.store("t", windows_of(spark, (1, n, n)), n)
    before, want = store.read("t").cache(), [("01-01", 0), ("01-01", 1), ("01-01", 2)]
    files = before.inputFiles()
    store.fold("t")
    assert all(Path(f.removeprefix("file:")).exists() for f in files)   # a reader that has begun finds its files
    assert held(store) == want
    store.store("t", windows_of(spark, (1, 1, 1)), 1)                   # is folded already
    store.store("t", windows_of(spark, (1, 3, 3)), 3)
    assert held(store) == [*want, ("01-01", 3)]
    store.store("t", windows_of(spark, (1, 3, 3)), 3)                   # as it was before the commit
    store.fold("t")
    assert held(store, "20240101") == [*want, ("01-01", 3)]


def test_a_fold_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    store = WindowStore(spark, "windows_broken", str(tmp_path / "w"), fold_every=100)
    for n in range(4):
        store.store("t", windows_of(spark, (1, n, n), (30, n, 10 + n)), n)
    want = held(store)
    monkeypatch.setattr(store, "_write", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.fold("t")
    monkeypatch.undo()
    assert held(store) == want
    store.fold("t")                                                      # complete, but nothing is dropped yet
    assert held(store) == want and max(len(b) for b in store.partitions("t").values()) == 5
    store.fold("t")
    assert held(store) == want and max(len(b) for b in store.partitions("t").values()) == 1


def test_topic_rows(spark):
    rows = spark.createDataFrame([("1", None, 5)], "id string, note string, ts bigint")
    assert [tuple(r) for r in sinks.topic_rows(rows, "t", "id").collect()] == [("t", "1", '{"id":"1","ts":5}')]
    routed = spark.createDataFrame([("x", {"id": "2"})], "sink_table string, data map<string,string>")
    assert [tuple(r) for r in sinks.topic_rows(routed).collect()] == [("x", None, '{"id":"2"}')]


def test_preloaded_config_is_under_later_changes(spark, tmp_path):
    names = schemas.CONFIG.fieldNames()
    stored = spark.createDataFrame(
        [("a", "insert", "dwd_a", "dwd", "id", None, None), ("b", None, "DIM_B", "dim", "id,x", "id", None)],
        ", ".join(f"{n} string" for n in names))
    stored.write.parquet(str(tmp_path / "table_process"))
    w = Warehouse(spark, str(tmp_path / "w"), "edu", every=None, dim_database="dims_preload")
    snapshot = topics.config_snapshot(spark, "dim", "parquet", path=str(tmp_path / "table_process"))
    assert [r.source_table for r in snapshot.collect()] == ["b"]
    w.preload(snapshot)
    assert w.dims.exists("dim_b") and w.dims.columns("dim_b") == ["id", "x"]
    assert [r.sink_table for r in w.current_config("dim").collect()] == ["DIM_B"]

    folder = tmp_path / "w" / "table_process"
    folder.mkdir()
    (folder / "0.txt").write_text('{"op":"d","before":{"source_table":"b","sink_table":"DIM_B","sink_type":"dim"},"ts_ms":9}\n')
    w.config().awaitTermination()
    assert w.current_config("dim").count() == 0
    assert not w.dims.exists("dim_b")


def test_snake_case_columns(spark):
    frame = spark.createDataFrame([(1, 2)], "userCount int, finalAmount int")
    assert V.rename_columns(frame, V.snake_name).columns == ["user_count", "final_amount"]


def test_parsed_once(spark):
    from eduflow.operators import filters
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = filters.clean_changes(filters.parse_changes(lines), "edu")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_raw_log_line_is_parsed_once(spark):
    from eduflow.operators import projections
    from eduflow.plans import facts
    lines = spark.createDataFrame([('{"common":{"mid":"m","is_new":"1"},"ts":7,"page":{"page_id":"p"}}',)], "value string")
    split = facts.logs(projections.parse_log(lines))
    assert split._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 1
    assert [r.kind for r in split.collect()] == ["page"]


def test_file_topics_keep_the_key_where_they_can(spark):
    rows = spark.createDataFrame([("t", "k", "v")], "topic string, key string, value string")
    assert sinks.file_rows(rows, "text").columns == ["value", "topic"]
    assert sinks.file_rows(rows, "parquet").columns == ["key", "value", "topic"]
