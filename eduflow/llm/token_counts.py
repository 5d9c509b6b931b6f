"""Tokens of whole texts without their ids: each distinct pre-token is counted once, and counts are summed.

A task reads documents into blocks. A block lists its distinct pre-tokens (white-space-separated words, as white space
is dropped by the vocabulary; ASCII letters in lower case where no special token may hide), and of each document which
of them it has how often, as steps between sorted numbers, packed. All blocks' lists are dealt out by pre-token, so that every pre-token lies in one task, where
the library counts its pieces once; the counts go back to their blocks and are summed by frequency. What is moved is
a list of words and small numbers per block, neither texts nor ids; a pre-token comes once from a block, so no
frequent word makes a large group.

Null text is empty: 0 bytes, 0 tokens. Special strings inside texts are what the library makes of them. Repeated rows
are counted each by itself; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eduflow.llm.common import stored

BLOCK_CHARS, COUNTED_AT_ONCE, MOST_KNOWN, MOST_HELD = 32 << 20, 4096, 300_000, 2_000_000
BLOCKS = "block long, doc_ids array<long>, n_bytes array<long>, kinds array<long>, items binary, vocabulary binary"
LIBRARY: dict[str, Tokenizer] = {}


def library(path: str) -> Tokenizer:
    if path not in LIBRARY:
        LIBRARY[path] = Tokenizer.from_file(path)
    return LIBRARY[path]


def pre_tokens(raw: bytes) -> list[bytes]:
    return (raw if b"<|" in raw else raw.lower()).split()


class Block:
    """Documents as frequencies of numbered pre-tokens."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.docs, self.bytes, self.kinds, self.steps, self.times = [], [], [], [], []
        self.chars = 0

    def add(self, doc, raw: bytes) -> None:
        found, number = Counter(pre_tokens(raw)), self.number
        at = np.fromiter((number.setdefault(w, len(number)) for w in found), np.uint32, len(found))
        order = np.argsort(at)
        self.docs.append(doc)
        self.bytes.append(len(raw))
        self.kinds.append(len(found))
        self.steps.append(np.diff(at[order], prepend=np.uint32(0)))
        self.times.append(np.fromiter(found.values(), np.uint32, len(found))[order])
        self.chars += len(raw)

    def row(self) -> list:
        pack = zstandard.ZstdCompressor(level=3).compress
        return [uuid.uuid4().int >> 65, self.docs, self.bytes, self.kinds,
                pack(planes(np.concatenate(self.steps + self.times))), pack(b"\n".join(self.number))]


def planes(numbers: np.ndarray) -> bytes:
    """All first bytes of 32-bit numbers, then all second ones, and so on: small numbers pack well so."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def batch_of(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema.names)


LONGS = pa.list_(pa.int64())
BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("doc_ids", LONGS), ("n_bytes", LONGS), ("kinds", LONGS),
                          ("items", pa.binary()), ("vocabulary", pa.binary())])
WORD_SCHEMA = pa.schema([("word", pa.string()), ("block", pa.int64()), ("number", pa.int32())])
COUNT_SCHEMA = pa.schema([("block", pa.int64()), ("numbers", pa.binary()), ("pieces", pa.binary())])
TOTAL_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc, (text.as_py() or "").encode())
                if block.chars >= block_chars:
                    yield batch_of([block.row()], BLOCK_SCHEMA)
                    block = Block()
        if block.docs:
            yield batch_of([block.row()], BLOCK_SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BLOCKS)


def vocabulary(made: DataFrame) -> DataFrame:
    """word, block, number of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = zstandard.ZstdDecompressor().decompress(packed.as_py()).decode().split("\n")
                for at in range(0, len(words) if words != [""] else 0, 50_000):
                    part = words[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.repeat(pa.scalar(block, pa.int64()), len(part)),
                         pa.array(np.arange(at, at + len(part), dtype=np.int32))], schema=WORD_SCHEMA)

    return made.select("block", "vocabulary").mapInArrow(run, "word string, block long, number int")


def counted(words: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of each block's words; a word's rows are in one task, and it is counted once there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library_ = library(tokenizer)
        known: dict[str, int] = {}
        held: list[tuple] = []
        size = 0

        def given() -> pa.RecordBatch:
            block, number, pieces = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(block, kind="stable")
            block, number, pieces = block[order], number[order], pieces[order]
            cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            ends = np.append(cuts[1:], len(block))
            return batch_of([[int(block[a]), number[a:b].tobytes(), pieces[a:b].tobytes()]
                             for a, b in zip(cuts, ends, strict=True)], COUNT_SCHEMA)

        for batch in batches:
            texts = batch.column(0).to_pylist()
            if len(known) > MOST_KNOWN:
                known.clear()
            new = list(set(texts).difference(known))
            for at in range(0, len(new), COUNTED_AT_ONCE):
                part = new[at : at + COUNTED_AT_ONCE]
                known.update(zip(part, map(len, library_.encode_batch_fast(part, add_special_tokens=False)), strict=True))
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(),
                         np.fromiter(map(known.__getitem__, texts), np.uint32, len(texts))))
            size += len(texts)
            if size >= MOST_HELD:
                yield given()
                held, size = [], 0
        if size:
            yield given()

    return words.repartition("word").mapInArrow(run, "block long, numbers binary, pieces binary")


def totals(made: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_tokens: frequencies times pieces, summed."""
    of_block = counts.groupBy("block").agg(F.collect_list(F.struct("numbers", "pieces")).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs, sizes, kinds, items, counts = (batch.column(i)[row].as_py() for i in range(5))
                numbers, pieces = (np.frombuffer(b"".join(x[k] for x in counts or []), kind) for k, kind in (
                    ("numbers", np.int32), ("pieces", np.uint32)))
                of = np.zeros(len(numbers), np.int64)
                of[numbers] = pieces
                both = from_planes(zstandard.ZstdDecompressor().decompress(items)).astype(np.int64)
                steps, times = both[: len(both) // 2], both[len(both) // 2 :]
                ends = np.cumsum(kinds)
                placed = np.append(0, np.cumsum(steps))
                at = placed[1:] - np.repeat(placed[ends - kinds], kinds)
                summed = np.append(0, np.cumsum(of[at] * times))
                yield batch_of(list(zip(docs, sizes, (summed[ends] - summed[ends - kinds]).tolist(), strict=True)),
                               TOTAL_SCHEMA)

    joined = made.select("block", "doc_ids", "n_bytes", "kinds", "items").join(of_block, "block", "left").drop("block")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: bytes, tokens, and whether they are more than the limit."""
    made = stored(blocks(docs, block_chars))
    counts = counted(vocabulary(made), tokenizer)
    return totals(made, counts).withColumn("over_limit", F.col("n_tokens") > limit)
