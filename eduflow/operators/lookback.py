"""The row before this one under the same key, whatever share of the rows one key has.

The rows are dealt out by range of (key, order, content), so a key with very many rows lies in several tasks of about
equal size. Where the rows lie in order, each is set beside the one before it, and both are stored: the rows are moved
once. The last row of each range, one per task, is all that is carried: it goes to the first row of the next range. No
row is counted and no key is treated apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from eduflow import session

PART, SALT, PREV, FIRST, LAST = "_part", "_salt", "_prev", "_first", "_last"


def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows, stored, each with the row before it in its range (null at the first of a key or range), the number of
    the range, and whether it is the first or the last there.

    Rows equal in key and order are ordered by their content. Exact copies are dealt out too, by where they were read.
    """
    others = [c for c in rows.columns if c not in (key, *order)]
    by = [key, *order, *others, SALT]
    dealt = rows.withColumn(SALT, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    columns = rows.columns
    whole = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    schema = T.StructType([*whole, T.StructField(PREV, whole), T.StructField(PART, T.IntegerType()),
                           T.StructField(FIRST, T.BooleanType()), T.StructField(LAST, T.BooleanType())])

    def beside(batch: pa.RecordBatch, before: pa.RecordBatch | None, last: bool) -> pa.RecordBatch:
        n, lead = batch.num_rows, batch if before is None else before
        shifted = [pa.concat_arrays([a.slice(len(a) - 1 if before else 0, 1), b.slice(0, n - 1)])
                   for a, b in zip(lead.columns, batch.columns, strict=True)]
        at = pa.array(range(n), pa.int32())
        first = pc.equal(at, 0) if before is None else pa.repeat(False, n)
        at_key = columns.index(key)
        other = pc.or_(pc.not_equal(shifted[at_key], batch.column(at_key)), first)
        prev = pa.StructArray.from_arrays(shifted, fields=list(batch.schema), mask=other)
        part = pa.repeat(pa.scalar(TaskContext.get().partitionId(), pa.int32()), n)
        ends = pc.equal(at, n - 1) if last else pa.repeat(False, n)
        return pa.RecordBatch.from_arrays([*batch.columns, prev, part, first, ends], [*columns, PREV, PART, FIRST, LAST])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield beside(held, before, False)
                before = held.slice(held.num_rows - 1, 1)
            held = batch
        if held is not None:
            yield beside(held, before, True)

    return session.stored(dealt.drop(SALT).mapInArrow(run, schema))


def carried(rows: DataFrame, whole: Column) -> DataFrame:
    """For each range the last row of the range before: one row per range."""
    before = F.lag(whole).over(Window.orderBy(PART))  # as many rows as there were tasks
    return rows.where(F.col(LAST)).select(PART, before.alias("carry"))


def with_previous(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add `prev`, a struct of the row before; rows with a null key are left out.

    `key` is text or a whole number; `order` is a time and a sequence number. The rows are stored while the plan is built.
    """
    columns = rows.columns
    there = placed(rows.where(F.col(key).isNotNull()), key, order)
    # a row per task, whatever the table: joined by key, the rows would be moved once more
    carry = F.broadcast(carried(there, F.struct(*columns)).withColumn(FIRST, F.lit(True)))
    paired = there.join(carry, [PART, FIRST], "left")
    return paired.select(
        *columns, F.coalesce(PREV, F.when(F.col("carry")[key] == F.col(key), F.col("carry"))).alias("prev"))
