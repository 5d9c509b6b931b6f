"""Benchmark passages inside documents, found by Wu-Manber search for many test strings at once.

Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased. A test string is a window of
`window` words of an item, or all words of a shorter item, joined by single spaces and held between two spaces;
documents are searched in the same form. Test strings of like length (a power of two apart) share a search: with m
the shortest, a table says for each block of bytes how far its nearest place lies from byte m of a test string, so
the search skips by that far, or past the block where no test string has it. At distance 0, the bucket of that block
holds the test strings to compare.

Items are taken to the tasks in blocks of bounded size, one after the other, so their number has no limit. Null text
has no words, as an empty one; items without words are never found; a null item id is named "". Rows of one item id
are one item; repeated documents are judged each by itself. An empty table of items marks nothing.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eduflow.llm.common import per_document, stored

BLOCK, ITEM_BYTES = 8, 4 << 20
IN_WORDS = [x for x in range(256) if x >= 0x80 or chr(x).isalnum()]
TO_WORDS = bytes(x if x in IN_WORDS else 32 for x in range(256)).lower()
FOUND = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


class Search:
    """Shift tables and buckets of one set of test strings; `items` of a string are those that hold it."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                self.items[b" " + b" ".join(words[i : i + size]) + b" "].add(item)
        like: dict[int, list[bytes]] = defaultdict(list)
        for string in self.items:
            like[len(string).bit_length()].append(string)
        self.tables = [self.table(x) for _, x in sorted(like.items())]

    @staticmethod
    def table(strings: list[bytes]) -> tuple[int, int, dict, dict]:
        m = min(map(len, strings))
        block = min(BLOCK, m)
        shifts: dict[bytes, int] = {}
        buckets: dict[bytes, list[bytes]] = defaultdict(list)
        for string in strings:
            for end in range(block, m + 1):
                piece = string[end - block : end]
                shifts[piece] = min(shifts.get(piece, m), m - end)
            buckets[string[m - block : m]].append(string)
        return m, block, shifts, buckets

    def hits(self, text: bytes) -> list[tuple[int, bytes]]:
        """Place and string of each occurrence."""
        out = []
        for m, block, shifts, buckets in self.tables:
            end, size, past, look = m, len(text), m - block + 1, shifts.get
            while end <= size:
                piece = text[end - block : end]
                skip = look(piece, past)
                if skip:
                    end += skip
                    continue
                out += [(end - m, x) for x in buckets[piece] if text.startswith(x, end - m)]
                end += 1
        return sorted(out)

    def judge(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words, spans of hit words (end excluded), and the items that occur."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        spans: list[list[int]] = []
        items: set[str] = set()
        at = place = 0
        for start, string in self.hits(joined):
            place += joined.count(b" ", at, start)
            at = start
            end = place + string.count(b" ") - 1
            if spans and place <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([place, end])
            items |= self.items[string]
        return len(words), [tuple(x) for x in spans], items


BUILT: dict[str, Search] = {}


def built(name: str, shared) -> Search:
    """The tables of a block of items, made once in each Python worker."""
    if name not in BUILT:
        BUILT.clear()
        BUILT[name] = Search(*shared.value)
    return BUILT[name]


def joined_spans(spans: list) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def item_blocks(benchmark: DataFrame, most_bytes: int) -> list[DataFrame]:
    """The items with text, in blocks of about `most_bytes`, none of them collected."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where(
        "text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // most_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(block == i) for i in range(n)]


def found(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = 10,
          most_bytes: int = ITEM_BYTES) -> DataFrame:
    """Struct `row` of the kept columns, words, merged spans of hit words, and items found, of each document."""
    out = shared = None
    for items in item_blocks(benchmark, most_bytes):
        if out is not None:
            if "text" not in keep:
                raise ValueError("with more than one block of items, keep the text")
            # The block before goes from the driver and the tasks before the next is collected.
            before = stored(out)
            shared.destroy()
        shared, name = spark.sparkContext.broadcast(([tuple(x) for x in items.collect()], window)), uuid.uuid4().hex

        def judge(texts, shared=shared, name=name):
            search = built(name, shared)
            seen = [search.judge(x) for x in texts]
            return ([n for n, _, _ in seen], [joined_spans(x) for _, x, _ in seen], [sorted(x) for _, _, x in seen])

        if out is None:
            out = per_document(docs, keep, FOUND, judge)
            continue
        # A further block of items: search again, and add what it finds to what the blocks before found.
        again = per_document(before.select("row", "spans", "items", F.col("row.text").alias("text")),
                             ["row", "spans", "items"], FOUND, judge)
        merged = F.array_sort(F.concat("row.spans", "spans"))
        out = again.select("row.row", "n_words", merged.alias("spans"),
                           F.array_sort(F.array_union("row.items", "items")).alias("items"))
    return out


def hit_words(spans: Column) -> Column:
    """Words inside any of the sorted spans, which may overlap."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["end"]))).alias("n")), lambda a: a["n"])


def judged(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
           most_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per document: words, hit words, items that occur, and the verdict."""
    size = benchmark.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    keep = ["doc_id"] + ["text"] * (size > most_bytes)
    rows = found(spark, docs, benchmark, keep, window, most_bytes)
    hit = hit_words(F.col("spans"))
    return rows.select(
        "row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
