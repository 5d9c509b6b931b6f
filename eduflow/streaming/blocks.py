"""Rows in state as compressed blocks of columns, and rows as text."""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T


def packed(rows: pa.Table) -> bytearray:
    """One block: Parquet, with an encoding by kind of column."""
    kinds = {name: str(rows[name].type) for name in rows.column_names}
    rows = pa.table({name: _as_numbers(rows[name].combine_chunks()) for name in rows.column_names}, metadata=kinds)
    sink = pa.BufferOutputStream()
    pq.write_table(rows, sink, compression="zstd", use_dictionary=False, write_statistics=False, column_encoding={
        f.name: ENCODINGS.get(str(f.type), "PLAIN") for f in rows.schema})
    return bytearray(sink.getvalue())


#: Bytes of numbers lie by their place, and lengths of texts apart from the texts: each is compressed with its like.
ENCODINGS = {"int32": "BYTE_STREAM_SPLIT", "int64": "BYTE_STREAM_SPLIT", "string": "DELTA_LENGTH_BYTE_ARRAY"}


def unpacked(block: bytes) -> pa.Table:
    rows = pq.read_table(pa.BufferReader(bytes(block)), use_threads=False)
    kinds = {name.decode(): kind.decode() for name, kind in rows.schema.metadata.items()}
    return pa.table({name: rows[name].cast(pa.type_for_alias(kinds[name])) for name in rows.column_names})


def _as_numbers(column: pa.Array) -> pa.Array:
    """Texts that are whole numbers, written as those are, as numbers; short ones where all are short."""
    numbers = column
    if pa.types.is_string(column.type):
        try:
            numbers = column.cast(pa.int64())
        except pa.ArrowInvalid:
            return column
        if not numbers.cast(pa.string()).equals(column):
            return column
    if pa.types.is_int64(numbers.type):
        ends = pc.min_max(numbers)
        if max(abs(ends["min"].as_py() or 0), abs(ends["max"].as_py() or 0)) < 1 << 31:
            return numbers.cast(pa.int32())
    return numbers


def as_text(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise TypeError(f"{name}: {kind.simpleString()} has no plain text")
    return (F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name)).cast("string")


def from_text(value: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(value.cast("bigint")) if isinstance(kind, T.TimestampType) else value.cast(kind)


# executors need no copy of this package: what it holds travels with the query
cloudpickle.register_pickle_by_value(sys.modules[__name__])
