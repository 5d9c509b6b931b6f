"""One plan for the row before, whatever share of the rows one key has."""

from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from eduflow.operators import lookback, state
from eduflow.plans import summaries


def rows_of(spark, key, ts, seq):
    return spark.range(900).selectExpr(
        f"{key} AS key", f"cast({ts} AS bigint) AS ts", f"cast({seq} AS bigint) AS seq", "id % 11 AS amount")


SHAPES = {
    "a third under one key": ("if(id % 3 = 0, 'hot', concat('k', id % 70))", "id % 40", "id"),
    "all under one key": ("'hot'", "id % 40", "id * 700000"),
    "all in one second": ("'hot'", "5", "id * 40000"),
    "exact copies": ("'hot'", "id % 2", "7"),
    "missing times": ("if(id % 50 > 0, 'k', null)", "if(id % 7 > 0, id % 5, null)", "if(id % 11 > 0, id, null)"),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_it_is_the_plain_rule(spark, shape):
    rows = rows_of(spark, *SHAPES[shape])
    w = Window.partitionBy("key").orderBy("ts", "seq", F.struct(*rows.columns))
    want = rows.where("key is not null").withColumn("prev", F.lag(F.struct(*rows.columns)).over(w))
    got = lookback.with_previous(rows, "key", ["ts", "seq"])
    assert Counter(got.collect()) == Counter(want.collect())


@pytest.mark.parametrize("shape", list(SHAPES)[:4])
def test_corrections_add_up_to_the_last_row(spark, shape):
    rows = rows_of(spark, *SHAPES[shape])
    fixed = state.correct_repeats(rows, "key", ["ts", "seq"], {"amount": F.col("amount")})
    assert fixed.count() == 900
    last = {k: v for k, v in rows.groupBy("key").agg(F.max(F.struct("ts", "seq", "amount"))["amount"]).collect()}
    assert dict(map(tuple, fixed.groupBy("key").agg(F.sum("amount")).collect())) == last


@pytest.fixture
def apart(spark):
    """Ranges stay as they are, however few their bytes."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_a_hot_key_carries_a_row_per_task(spark, apart):
    """A million rows of one key, one a second: as many carried rows as ranges, and ranges of about equal size."""
    rows = spark.range(1_000_000).selectExpr("'hot' AS key", "id AS ts", "id AS seq", "id % 7 AS amount")
    there = lookback.placed(rows, "key", ["ts", "seq"])
    parts = [r["count"] for r in there.groupBy(lookback.PART).count().collect()]
    assert 1 < len(parts) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(parts) < 2 * sum(parts) / len(parts)
    assert lookback.carried(there, F.struct("ts")).count() == len(parts)
    got = lookback.with_previous(rows, "key", ["ts", "seq"])
    assert got.where("ts = 0 AND prev IS NULL OR prev.ts = ts - 1").count() == 1_000_000


def test_exact_copies_are_dealt_out(spark, apart):
    rows = spark.range(200_000).selectExpr("'hot' AS key", "1 AS ts", "1 AS seq", "5 AS amount").repartition(4)
    parts = [r["count"] for r in lookback.placed(rows, "key", ["ts", "seq"]).groupBy(lookback.PART).count().collect()]
    assert max(parts) < 150_000


def test_corrections_need_a_place(spark):
    with pytest.raises(ValueError, match="seq"):
        summaries.ordered(spark.range(1))


def test_rows_are_moved_once(spark, capsys):
    """Beside the dealing out, which is done when the rows are stored, only the carried rows are exchanged."""
    rows = rows_of(spark, *SHAPES["a third under one key"])
    lookback.with_previous(rows, "key", ["ts", "seq"]).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_a_row_before_in_another_batch(spark, apart):
    """The row before is found across Arrow batches and across ranges."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    try:
        rows = spark.range(1000).selectExpr("concat('k', id div 300) AS key", "id AS ts", "id AS seq", "id % 7 AS amount")
        got = lookback.with_previous(rows, "key", ["ts", "seq"])
        assert got.where("ts % 300 = 0 AND prev IS NULL OR ts % 300 > 0 AND prev.ts = ts - 1").count() == 1000
    finally:
        spark.conf.unset(name)
