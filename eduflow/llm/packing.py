"""Documents cut into pieces and packed into as few sequences of a fixed capacity as can be.

A configuration says how many pieces of each size class fill one sequence. The linear program (cover the histogram of
lengths by the fewest configurations) is solved by multiplicative weights: classes that are covered least weigh most, a
knapsack by dynamic programming finds the configuration of most weight, and it is taken a little more often. The
result is rounded down to whole sequences. Each is filled with the largest pieces there are of its classes, the last
place and what is over by the largest that still fit; what the rounding left over goes to sequences filled by best fit alone. All this works
on the histogram, which has as many entries as the capacity at most, whatever the number of documents; the
plan is about as small. Its pieces are numbered within their length by Spark, in slices so that a common length is no
large group, and a look-up by length and number gives sequence and offset.

Null text is empty: a piece that holds the end id alone. Repeated rows are packed each. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eduflow.llm.common import stored
from eduflow.llm.tokens import word_tokens

UNIT, SLICES, ROUNDS, STEP = 16, 256, 3000, 0.1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece of each document's ids, with the CRC-32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        for batch in batches:
            at = 0
            for found, sizes in words.encode(batch.column(1)):
                docs = batch.column(0).slice(at, len(sizes))
                at += len(sizes)
                ends = np.cumsum(sizes + 1)
                ids = np.full(ends[-1], end_id, "<u4")
                inner = np.ones(len(ids), bool)
                inner[ends - 1] = False
                ids[inner] = found
                yield cut(docs, sizes + 1, memoryview(ids).cast("B"))
        words.forget()

    def cut(docs: pa.Array, lengths: np.ndarray, ids: memoryview) -> pa.RecordBatch:
        many = -(-lengths // capacity)
        whose = np.repeat(np.arange(len(lengths)), many)
        piece = np.arange(len(whose)) - np.repeat(np.cumsum(many) - many, many)
        start = piece * capacity
        length = np.minimum(lengths[whose] - start, capacity)
        first = (np.cumsum(lengths) - lengths)[whose] + start
        crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [docs.take(pa.array(whose)), *[pa.array(x, k) for x, k in zip((piece, start, length, crcs), KINDS, strict=True)]],
            ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def knapsack(worth: np.ndarray, most: np.ndarray, units: int) -> np.ndarray:
    """Copies of each size 1..n (in units) that fit a capacity and are worth most; at most `most` of each."""
    sizes = len(worth)
    best, pick = np.zeros(units + 1), np.zeros(units + 1, int)
    for room in range(1, units + 1):
        top = min(room, sizes)
        value = worth[:top] + best[room - 1 :: -1][:top]
        k = int(value.argmax())
        best[room], pick[room] = (value[k], k + 1) if value[k] > best[room - 1] else (best[room - 1], 0)
    copies, room = np.zeros(sizes, int), units
    while room > 0:
        size = pick[room]
        if size:
            copies[size - 1] += 1
        room -= size or 1
    return np.minimum(copies, most)


def configurations(counts: dict[int, int], capacity: int, unit: int = UNIT, rounds: int = ROUNDS) -> list:
    """(sequences, copies of each size class) of the rounded solution of the linear program, most used first."""
    units = -(-capacity // unit)
    need = np.zeros(units)
    for length, n in counts.items():
        need[-(-length // unit) - 1] += n
    real = need > 0
    if not real.any():
        return []
    covered, weight, used = np.zeros(units), np.where(real, 1 / np.maximum(need, 1), 0), Counter()
    for _ in range(rounds):
        copies = knapsack(weight, need.astype(int), units)
        if not copies.any():
            break
        on = copies > 0
        step = (need[on] / copies[on]).min()
        used[tuple(copies.tolist())] += step * STEP
        covered[on] += copies[on] / need[on] * step * STEP
        weight = np.where(real, np.exp(-np.clip((covered - covered[real].min()) / STEP, 0, 700)) / np.maximum(need, 1), 0)
    least = covered[real].min()
    if least <= 0:
        return []
    return [(int(n), copies) for copies, x in used.most_common() if (n := int(x / least))]


def plan(counts: dict[int, int], capacity: int, unit: int = UNIT, rounds: int = ROUNDS) -> list:
    """(sequences, [(length, copies), ...]): every piece of the histogram is in exactly one sequence."""
    left = Counter({k: n for k, n in counts.items() if n > 0})
    out = []
    if left.get(capacity):
        out.append((left.pop(capacity), [(capacity, 1)]))
    there = sorted(left)

    def largest(room: int, used: Counter) -> int:
        """The largest length up to `room` of which a piece is left."""
        at = bisect_right(there, room) - 1
        while at >= 0 and left[there[at]] <= used[there[at]]:
            at -= 1
        return there[at] if at >= 0 else 0

    def fill(most: int | None, copies: tuple) -> int:
        """Take one kind of sequence as often as pieces and `most` allow; how often."""
        used, room = Counter(), capacity
        sizes = [size for size in range(len(copies), 0, -1) for _ in range(copies[size - 1])]
        for size in sizes[:-1]:  # the last place goes to what fits best
            length = largest(min(size * unit, room), used)
            if length > (size - 1) * unit:
                used[length] += 1
                room -= length
        while length := largest(room, used):
            used[length] += 1
            room -= length
        if not used:
            return 0
        times = min(left[k] // n for k, n in used.items())
        times = times if most is None else min(times, most)
        out.append((times, list(used.items())))
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                there.pop(bisect_right(there, k) - 1)
        return times

    for n, copies in configurations(left, capacity, unit, rounds):
        while n > 0 and (took := fill(n, copies)):
            n -= took
    while there:
        fill(None, ())
    return out


class Places:
    """Sequence and offset of the k-th piece of a length."""

    def __init__(self, planned: list):
        rows, taken, sequence = [], Counter(), 0
        for times, used in planned:
            offset = 0
            for length, copies in used:
                rows.append((length, taken[length], sequence, copies, offset))
                taken[length] += times * copies
                offset += length * copies
            sequence += times
        rows.sort()
        self.length, self.first, self.sequence, self.copies, self.offset = (
            np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else [[]] * 5))
        #: Numbers of a length follow each other; a wide one orders them across lengths.
        self.key = self.length * (1 << 48) + self.first

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * (1 << 48) + number, side="right") - 1
        number = number - self.first[at]
        return (self.sequence[at] + number // self.copies[at],
                self.offset[at] + number % self.copies[at] * length)


def numbered(cut: DataFrame) -> DataFrame:
    """Number of each piece within its length, from 0: slices are numbered apart and then set one after the other."""
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SLICES)).cast("int"))
    sizes = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece")
    return sliced.withColumn("number", F.row_number().over(inside) - 1).join(firsts, ["length", "slice"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("first")).alias("number"))


def packed(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    cut = stored(pieces(docs, tokenizer, capacity, end_id))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(plan(counts, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = places.value.find(length.to_numpy(np.int64), number.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    rows = numbered(cut).withColumn("place", place("length", "number"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
