"""Lines that many documents share are kept once.

Keys of long lines become 128-bit hashes. The hashes are dealt out by range, with a slice of the documents behind
the hash, so that a line of very many documents is spread over tasks; inside a range they lie in order of document
and position, and one pass over that order marks the first occurrence in each document. What a slice found (how many
documents, the last of them) is summed per hash. The result is a bitmap per document, as run lengths, and no text.

Rows of one `doc_id` count as one document; each row keeps its own lines. A null id is a document below all others.
Null or empty text is one empty line. A document of which all lines go is left with the empty text. An empty table
gives an empty result. Only `doc_id` and `text` are read; other columns, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eduflow.llm.common import SPACES, lower_ascii, row_print, stored

SLICES = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """Hash, document and position of each line whose key is long enough."""
    text = F.col("text")
    lines = docs.select("doc_id", row_print(text).alias("print"), F.posexplode(lines_of(text)).alias("pos", "line"))
    keys = lines.where(F.char_length("line") >= least_chars).select(
        "doc_id", "print", "pos", lower_ascii(F.btrim("line", F.lit(SPACES))).alias("key"))
    return keys.where(F.char_length("key") >= least_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "print", "pos")


def shared_keys(found: DataFrame, least_docs: int) -> DataFrame:
    """Hashes of lines in at least so many documents, with the largest id among them."""
    dealt = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    ranged = dealt.repartitionByRange("h1", "h2", "slice")
    order = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc_nulls_last("doc_id"), "pos")
    first = (F.row_number().over(order) == 1) | ~F.lag("doc_id").over(order).eqNullSafe(F.col("doc_id"))
    per_slice = ranged.withColumn("first", first.cast("long")).groupBy("h1", "h2", "slice").agg(
        F.sum("first").alias("docs"), F.max("doc_id").alias("last"))
    return per_slice.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last")).where(
        F.col("docs") >= least_docs).select("h1", "h2", "last")


def runs(dropped: Column) -> Column:
    """Sorted positions to run lengths: kept, dropped, kept, dropped ... (what follows the last run is kept)."""
    numbers = F.sequence(F.lit(0), F.size(dropped) - 1)
    starts = F.filter(numbers, lambda i: (i == 0) | (F.get(dropped, i) != F.get(dropped, i - 1) + 1))
    ends = F.filter(numbers, lambda i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != F.get(dropped, i) + 1))
    pairs = F.arrays_zip(F.transform(starts, lambda i: F.get(dropped, i)).alias("a"),
                         F.transform(ends, lambda i: F.get(dropped, i)).alias("b"))
    return F.flatten(F.transform(pairs, lambda p, k: F.array(
        p["a"] - F.when(k == 0, 0).otherwise(F.get(pairs, k - 1)["b"] + 1), p["b"] - p["a"] + 1)))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, print (names the row's text) and `keep_runs` of each row that loses a line.

    A line whose key (stripped of ASCII white space, A-Z lower-cased) has `least_chars` code points and is found in
    `least_docs` documents goes, but in the largest `doc_id` that holds it.
    """
    found = stored(long_lines(docs, least_chars))
    gone = found.join(shared_keys(found, least_docs), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    at = gone.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    return at.select("doc_id", "print", runs(F.col("at")).alias("keep_runs"))


def dropped_lines(keep_runs: Column) -> Column:
    """How many lines a bitmap drops."""
    return F.coalesce(F.aggregate(F.transform(keep_runs, lambda n, i: F.when(i % 2 == 1, n).otherwise(0)),
                                  F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The text without the lines that its bitmap drops; without a bitmap, as it is."""
    flags = F.flatten(F.transform(keep_runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    kept = F.filter(F.arrays_zip(lines_of(text).alias("line"), flags.alias("keep")),
                    lambda x: F.coalesce(x["keep"], F.lit(True)))
    return F.when(keep_runs.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """All columns of `docs` as struct `row`, and `keep_runs`."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    marks = bitmaps.select(F.col("doc_id").alias("id"), "print", "keep_runs")
    return rows.join(marks, F.col("row.doc_id").eqNullSafe(F.col("id")) & (
        row_print(F.col("row.text")) == F.col("print")), "left").select("row", "keep_runs")


def digests(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """One row per document: lines, dropped lines, and the digest of what stays."""
    docs = docs.select("doc_id", "text")
    both = with_bitmaps(docs, keep_bitmaps(docs, least_chars, least_docs))
    text, marks = F.col("row.text"), F.col("keep_runs")
    return both.select(
        "row.doc_id", F.size(lines_of(text)).cast("long").alias("n_lines"), dropped_lines(marks).alias("n_dropped"),
        F.sha2(F.coalesce(kept_text(text, marks), F.lit("")), 256).alias("kept_sha256"), "keep_runs")
