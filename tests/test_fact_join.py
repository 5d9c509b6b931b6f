"""Joins of two streams, over several micro-batches."""

import pytest

from eduflow.operators import filters, joins
from eduflow.streaming import fact_join
from tests.test_streams import batches

NEAR = ("1 hour", "30 minutes")
DETAIL = "id string, order_id string, user_id bigint, ts bigint"
SOURCE = "item string, sc string, ts bigint"
END = 10_000_000


def live(spark, folder, schema, *groups):
    names = [field.split()[0] for field in schema.split(", ")]
    parts = [[dict(zip(names, row, strict=True)) for row in part] for part in groups]
    return filters.event_timed(batches(spark, folder, schema, *parts), "s", "0 seconds")


def run(rows, folder):
    query = (rows.drop("et").writeStream.format("parquet").option("path", f"{folder}/rows")
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    found = rows.sparkSession.read.schema(rows.drop("et").schema).parquet(f"{folder}/rows")
    return sorted(map(tuple, found.collect()), key=repr), query.recentProgress


@pytest.mark.parametrize("piece", [2, 100_000])
def test_rows_meet_over_micro_batches(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(fact_join, "PIECE", piece)
    monkeypatch.setattr(fact_join, "FULL", piece)
    details = [[("a1", "a", 2**60 + 1, 100), ("a2", "a", None, 200), ("b1", "b", 1, 300), ("n", None, 1, 100)],
               [("a3", "a", 3, 400), ("a3", "a", 3, 400)], [("c1", "c", 1, 90_000)], [("z", "z", 0, END)], [("z", "z", 0, END)]]
    sources = [[("a", "s1", 100)], [("a", "s2", 150), (None, "none", 100), ("b", 's"\\,3', 4000)], [("c", "early", 80_000)],
               [("y", "y", END)], [("y", "y", END)]]
    rows = joins.orders_with_source(live(spark, tmp_path / "d", DETAIL, *details), live(spark, tmp_path / "s", SOURCE, *sources), NEAR)
    got, _ = run(rows.where("ts < 1000000"), tmp_path)
    assert got == sorted([
        ("a1", "a", 2**60 + 1, 100, "s1"), ("a1", "a", 2**60 + 1, 100, "s2"), ("a2", "a", None, 200, "s1"), ("a2", "a", None, 200, "s2"),
        ("a3", "a", 3, 400, "s1"), ("a3", "a", 3, 400, "s1"), ("a3", "a", 3, 400, "s2"), ("a3", "a", 3, 400, "s2"),
        ("b1", "b", 1, 300, None), ("n", None, 1, 100, None), ("c1", "c", 1, 90_000, None)], key=repr)


def test_a_joined_stream_holds_blocks_and_forgets(spark, tmp_path):
    many = [(f"d{n}", f"o{n % 3}", n, 100 + n % 50) for n in range(3000)]
    details = live(spark, tmp_path / "d", DETAIL, many, [("z", "z", 0, END)], [("z", "z", 0, END)])
    infos = live(spark, tmp_path / "i", "id string, province_id string, ts bigint", [(f"o{n}", "p", 120) for n in range(3)],
                 [("y", "p", END)], [("y", "p", END)])
    got, progress = run(joins.orders_with_province(details, infos, NEAR), tmp_path)
    assert len(got) == 3000
    held = [sum(s.numRowsTotal for s in p.stateOperators) for p in progress]
    assert 0 < max(held) < 60, "a row of a joined stream is no entry of its own"
    assert held[-1] < held[0]


def test_a_pair_that_comes_late_still_finds_its_source(spark, tmp_path):
    """The order comes when the watermark has left the detail and its source behind."""
    details = [[("a1", "a", 1, 4000), ("b1", "b", 1, 4000)], [("x", "x", 0, 5500)], [("x", "x", 0, 5600)], [("z", "z", 0, END)], [("z", "z", 0, END)]]
    infos = [[("x", "p", 4000)], [("x", "p", 5500)], [("a", "p", 5600), ("b", "p", 5600)], [("y", "p", END)], [("y", "p", END)]]
    sources = [[("a", "s", 1000)], [("q", "q", 5500)], [("q", "q", 5600)], [("q", "q", END)], [("q", "q", END)]]
    left = live(spark, tmp_path / "d", "id string, course_id string, course_name string, order_id string, user_id string, "
                "final_amount string, create_time string, ts bigint",
                *[[(i, "c", "n", o, "u", "1", "t", at) for i, o, _, at in part] for part in details])
    rows = joins.order_detail_facts(left, live(spark, tmp_path / "i", "id string, province_id string, ts bigint", *infos),
                                    live(spark, tmp_path / "s", SOURCE, *sources), NEAR, NEAR)
    got, _ = run(rows.where("id in ('a1', 'b1')"), tmp_path)
    assert [(r[0], r[3], r[6], r[8]) for r in got] == [("a1", "a", "p", "s"), ("b1", "b", "p", None)]


def test_a_block_gives_its_rows_again_and_is_small():
    import json
    import random

    import pyarrow as pa

    from eduflow.streaming.blocks import packed, unpacked

    odd = ["7", "007", "-0", "+1", " 2", None, "", "9223372036854775808", "1e3", "a\n\"b"]
    rows = pa.table({"key": odd, "at": pa.array([None, *range(2**62, 2**62 + 9)], pa.int64()), "met": [True, False] * 5,
                     "c0": [str(-n) for n in range(10)], "c1": pa.nulls(10, pa.string()), "c2": ["2147483648", *["1"] * 9]})
    assert unpacked(packed(rows)).equals(rows)
    assert unpacked(packed(rows.slice(3, 0))).equals(rows.slice(3, 0))
    r = random.Random(1)
    many = [[str(r.randrange(10**7)), str(r.randrange(10**5)), str(r.randrange(10**7)), f"{r.randrange(10**7) / 100:.2f}"]
            for _ in range(4000)]
    block = packed(pa.table({f"c{n}": [row[n] for row in many] for n in range(4)}))
    # one text a row, in a compressed Arrow stream
    texts, sink = pa.table({"row": [json.dumps(row) for row in many]}), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(texts)
    assert len(block) < 0.7 * sink.getvalue().size
