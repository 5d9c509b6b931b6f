"""Joins of two streams of facts, held in groups of keys.

Spark's own stream join keeps each row of both sides as entries of their own, and looks each up on its own. Here the keys of a
group share a state: rows lie in packed blocks of columns, and a micro-batch meets whole blocks.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eduflow.streaming.blocks import as_text, from_text, packed, unpacked

#: Groups of keys that share one state. Fixed, as a checkpoint holds keys by their group.
GROUPS = 1 << 10
#: A block with fewer rows than this is filled up by the next rows of its side.
FULL = 2000
#: So many rows of a group are worked on together.
PIECE = 100_000
#: A time ahead of every watermark that pandas can hold.
FAR = "2262-01-01"
LEFT, RIGHT = 0, 1
#: What a row in a block has besides the texts of its fields.
FIXED = ["key", "at", "met"]


class FactJoin(StatefulProcessor):
    """Rows of a group's two sides, each with its key, its time and the rest as texts, in blocks.

    A piece of new rows meets the other side's blocks one by one, then becomes or fills a block itself, so that memory
    holds a few blocks of about `PIECE` rows whatever a key's rows are. With `near`, rows that no row to come can meet are forgotten; left rows of an
    outer join that have met none come out then. Times are microseconds.
    """

    def __init__(self, widths: tuple[int, int], outer: bool, near: tuple[int, int] | None, lag: int):
        self.widths, self.outer, self.near = widths, outer, near
        self.keep = (near[1], near[0] + lag) if near else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = [handle.getMapState(name, "number bigint", "block binary") for name in ("left", "right")]
        self.index = handle.getValueState("index", "index binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        index, self.last = self._index(), {}
        for piece in _pieces(rows):
            for side in (RIGHT, LEFT):
                part = piece.filter(pc.equal(piece["side"], side)).select([*FIXED, *_texts(self.widths[side])])
                if len(part):
                    yield from self._meet(index, side, part)
        self._close(index)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        index, self.last = self._index(), {}
        now = timerValues.getCurrentWatermarkInMs() * 1000
        for side in (LEFT, RIGHT):
            for number, (oldest, _) in list(index[side].items()):
                if oldest + self.keep[side] >= now:
                    continue
                block = self._read(side, number)
                over = pc.less(pc.add(block["at"], self.keep[side]), now)
                if side == LEFT and self.outer:
                    alone = block.filter(pc.and_(over, pc.invert(block["met"])))
                    if len(alone):
                        yield self._given(alone, None)
                self._write(index, side, number, block.filter(pc.invert(over)))
        index["timer"] = None
        self._close(index)

    def close(self) -> None:
        pass

    def _meet(self, index: dict, side: int, part: pa.Table) -> Iterator[pd.DataFrame]:
        for number in list(index[1 - side]):
            other = self._read(1 - side, number)
            left, right = (part, other) if side == LEFT else (other, part)
            i, j = self._pairs(left, right)
            if not len(i):
                continue
            yield self._given(left.take(pa.array(i)), right.take(pa.array(j)))
            if self.outer:
                met = left["met"].to_numpy().copy()
                if not met[i].all():
                    met[i] = True
                    left = left.set_column(FIXED.index("met"), "met", pa.array(met))
                    if side == LEFT:
                        part = left
                    else:
                        self._write(index, LEFT, number, left)
        number = next(reversed(index[side]), None)
        if number is not None and index[side][number][1] < FULL:
            part = pa.concat_tables([self._read(side, number), part])
        else:
            number = index["next"]
            index["next"] += 1
        self._write(index, side, number, part)

    def _pairs(self, left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Rows of both sides with equal keys and times that are near; a missing key equals none."""
        pairs = _numbered(left, "i").merge(_numbered(right, "j"), on="key")
        i, j = pairs["i"].to_numpy(), pairs["j"].to_numpy()
        if self.near:
            apart = right["at"].to_numpy()[j] - left["at"].to_numpy()[i]
            near = (apart >= -self.near[0]) & (apart <= self.near[1])
            i, j = i[near], j[near]
        return i, j

    def _given(self, left: pa.Table, right: pa.Table | None) -> pd.DataFrame:
        none = {"at": pa.nulls(len(left), pa.int64())} | {c: pa.nulls(len(left), pa.string()) for c in _texts(self.widths[RIGHT])}
        right = none if right is None else right
        return pa.table({
            "l_at": left["at"], "r_at": right["at"], **{f"l_{c}": left[c] for c in _texts(self.widths[LEFT])},
            **{f"r_{c}": right[c] for c in _texts(self.widths[RIGHT])}}).to_pandas(types_mapper=pd.ArrowDtype)

    # state

    def _index(self) -> dict:
        """The oldest time and the number of rows of each block, the next block's number, and the timer that is set."""
        found = self.index.get()
        return pickle.loads(found[0]) if found else {LEFT: {}, RIGHT: {}, "next": 0, "timer": None}

    def _close(self, index: dict) -> None:
        if not index[LEFT] and not index[RIGHT]:
            self.index.clear()
            return
        if self.keep:
            ends = [oldest + self.keep[side] for side in (LEFT, RIGHT) for oldest, _ in index[side].values()]
            timer = min(ends) // 1000 + 1
            if index["timer"] is None or timer < index["timer"]:
                self.handle.registerTimer(timer)
                index["timer"] = timer
        self.index.update((bytearray(pickle.dumps(index)),))

    def _read(self, side: int, number: int) -> pa.Table:
        if self.last.get(side, (None,))[0] == number:
            return self.last[side][1]
        return unpacked(self.blocks[side].getValue((number,))[0])

    def _write(self, index: dict, side: int, number: int, block: pa.Table) -> None:
        if not len(block):
            self.blocks[side].removeKey((number,))
            del index[side][number]
            return
        self.last[side] = number, block
        self.blocks[side].updateValue((number,), (packed(block),))
        index[side][number] = (pc.min(block["at"]).as_py() or 0, len(block))


def _pieces(rows: Iterator[pd.DataFrame]) -> Iterator[pa.Table]:
    held, many = [], 0
    for some in rows:
        held.append(pa.table({
            "side": pa.array(some["side"], pa.int32()), "key": pa.array(some["key"], pa.string(), from_pandas=True),
            "at": pa.array(some["at"], pa.int64()), "met": pa.array(np.zeros(len(some), bool)),
            **{c: pa.array(some[c], pa.string(), from_pandas=True) for c in some.columns if c.startswith("c")}}))
        many += len(some)
        if many >= PIECE:
            yield pa.concat_tables(held)
            held, many = [], 0
    if many:
        yield pa.concat_tables(held)


def _numbered(table: pa.Table, name: str) -> pd.DataFrame:
    return pd.DataFrame({"key": table["key"].to_pandas(), name: np.arange(len(table))})


def _micros(length: str) -> int:
    return pd.Timedelta(length).value // 1000


def _texts(width: int) -> list[str]:
    """The columns that hold a side's fields, as text."""
    return [f"c{n}" for n in range(width)]


def fact_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str,
              near: tuple[str, str] | None, spread_by: str, lag: str | None) -> DataFrame:
    """Inner or left equi-join of two streams on keys that are text; with `near`, both have times `l_et` and `r_et`.

    `lag`: the left rows come out of another such join, up to so much later than their time, and bring no watermark.
    """
    if how == "left" and not near:
        raise ValueError("a left join of streams needs a bound")
    sides = []
    for rows, key, time, number in ((left, left_key, "l_et", LEFT), (right, right_key, "r_et", RIGHT)):
        fields = [f for f in rows.schema.fields if f.name not in (time, "et", "salt", "right_salt")]
        if number == LEFT and how == "left":
            spread = F.when(key.isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(spread_by))
        else:
            rows = rows.where(key.isNotNull())
            spread = F.xxhash64(key)
        sides.append((rows, key, time, number, fields, spread))
    parts, widths = [], tuple(len(fields) for *_, fields, _ in sides)
    most = max(widths)
    for rows, key, time, number, fields, spread in sides:
        texts = [as_text(f.name, f.dataType) for f in fields] + [F.lit(None).cast("string")] * (most - len(fields))
        at = F.unix_micros(time) if near else F.lit(0).cast("bigint")
        clock = [] if not near else [F.lit(FAR).cast("timestamp").alias("et") if lag and number == LEFT
                                     else F.col(time).alias("et")]
        parts.append(rows.select(F.pmod(spread, F.lit(GROUPS)).cast("int").alias("_group"), F.lit(number).alias("side"),
                                 key.alias("key"), at.alias("at"), *[x.alias(c) for x, c in zip(texts, _texts(most), strict=True)], *clock))
    # the right side's times carry the watermark
    both = parts[RIGHT].union(parts[LEFT])
    if near:
        both = both.where("at is not null")
    processor = FactJoin(widths, how == "left", tuple(map(_micros, near)) if near else None, _micros(lag) if lag else 0)
    given = [f"{name}_{c} string" for name, width in zip("lr", widths, strict=True) for c in _texts(width)]
    met = both.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=", ".join(["l_at bigint, r_at bigint", *given]), outputMode="Append",
        timeMode="EventTime" if near else "None")
    times = [F.timestamp_micros("l_at").alias("l_et"), F.timestamp_micros("r_at").alias("r_et")] if near else []
    return met.select(*[from_text(F.col(f"{name}_c{n}"), f.dataType).alias(f.name) for name, (*_, fields, _) in zip(
        "lr", sides, strict=True) for n, f in enumerate(fields)], *times)


# executors need no copy of this package: the processor travels with the query
cloudpickle.register_pickle_by_value(sys.modules[__name__])
