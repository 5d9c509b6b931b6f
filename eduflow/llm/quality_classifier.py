"""Quality of a text by compression: which of two dictionaries, of good or of bad text, makes it smaller.

Both dictionaries are trained by zstandard on pieces of labelled texts. A text is cut into pieces of `PIECE` bytes, each
compressed alone with either dictionary, so that a long text is judged by the dictionaries and not by its own
repetitions; the difference of the two sums, over the bytes of the text, goes through a rising curve (isotonic
regression). The curve is fitted to all labelled documents that the dictionaries have not seen.

The dictionaries' sample is bounded: `ROWS` labelled documents of each class, by a hash of the id, and of their distinct
pieces `PIECES`, by a hash of the piece. Whole texts are cut, and the curve uses all rows (as counts and sums per
thousandth of difference). Texts never move: labels meet documents by id only, as ids or as differences.

Null and empty texts have no difference: their score is the share of good ones among those labelled. Texts under
`SHORT` bytes, of which the difference tells less, have a curve of their own. Labels that are null or neither 0 nor 1
teach nothing; an id labelled both ways teaches both. Rows of a null id are scored, not held out, and teach nothing.
Where a class has no text, its dictionary is none; where nothing is left for a curve, the score is the share of good
documents, or one half without any. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eduflow.llm.common import importable, per_document, stored

PIECE, LEVEL, DICTIONARY = 512, 3, 112_640
ROWS, PIECES = 4000, 8192
SHORT = 64
#: Steps of a difference that the curve tells apart.
STEPS = 1000


class Model(NamedTuple):
    good: bytes
    bad: bytes
    curves: dict[bool, tuple[list[float], list[float]]]  # of long and of short texts: differences and their scores
    without_text: float


def pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def dictionary(samples: list[bytes]) -> bytes:
    """Trained on the samples; where they are too few to train on, the samples themselves, the last ones nearest."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


@lru_cache(maxsize=4)
def compressor(data: bytes) -> zstandard.ZstdCompressor:
    """Kept by a worker from batch to batch."""
    plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(data) < 8:  # less is no dictionary for the library
        return zstandard.ZstdCompressor(level=LEVEL, **plain)
    made = zstandard.ZstdCompressionDict(data)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=made, **plain)


def difference(text: str | None, good: bytes, bad: bytes) -> tuple[float | None, bool]:
    """Bytes that the dictionary of good text saves against the other, per byte of text (None without text); short or not."""
    cut, a, b = pieces(text), compressor(good), compressor(bad)
    size = sum(map(len, cut))
    return sum(len(b.compress(x)) - len(a.compress(x)) for x in cut) / size if cut else None, size < SHORT


def differences(docs: DataFrame, keep: list[str], good: bytes, bad: bytes) -> DataFrame:
    """Struct `row` of the columns to keep, `difference` and `short`."""
    return per_document(docs, keep, "difference double, short boolean", lambda texts: list(zip(
        *[difference(x, good, bad) for x in texts], strict=True)) if texts else [[], []])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def lessons(labels: DataFrame) -> DataFrame:
    """Distinct id and quality of what may be learned from; `fit` tells the dictionaries' part from the curve's."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality")).distinct().withColumn(
        "fit", F.xxhash64("id") % 2 == 0)


def dictionaries(docs: DataFrame, taught: DataFrame, rows: int = ROWS, most: int = PIECES) -> dict[int, bytes]:
    """A dictionary for each class."""
    importable(docs.sparkSession)
    found = {}
    for quality in (0, 1):
        ids = taught.where(F.col("fit") & (F.col("quality") == quality)).orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(rows)
        texts = docs.where(F.col("text").isNotNull()).select(docs["doc_id"].alias("id"), docs["text"].cast("string").alias(
            "text")).join(F.broadcast(ids.select("id")), "id", "left_semi").select("text")

        def cut(batches):
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    parts = pieces(text)
                    for i in range(0, len(parts), 4096):
                        yield pa.RecordBatch.from_arrays([pa.array(parts[i : i + 4096], pa.binary())], ["piece"])

        distinct = texts.mapInArrow(cut, "piece binary").groupBy(F.xxhash64("piece").alias("h")).agg(F.min("piece").alias("piece"))
        found[quality] = dictionary([bytes(r.piece) for r in distinct.orderBy("h").limit(most).collect()])
    return found


def curve(counts: list[tuple[float, int, int]], share: float) -> tuple[list[float], list[float]]:
    """Differences and scores between which the score is drawn in straight lines, over (difference, good, all).

    The share of good documents, raised where it would fall (neighbours that are out of order are pooled), and drawn
    to the share of all by the weight of one document.
    """
    pools: list[list[float]] = []
    for x, good, n in sorted(counts):
        pools.append([x * n, good, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    scores = np.maximum.accumulate([(good + share) / (n + 1) for _, good, n in pools] or [share]).tolist()
    return [x / n for x, _, n in pools] or [0.0], scores


def calibrated(scored: DataFrame, taught: DataFrame) -> tuple[dict[bool, tuple[list[float], list[float]]], float]:
    """The curves, and the score of a text without bytes, over all documents that the dictionaries have not seen.

    `scored` holds id, difference and short. At most 4 * STEPS + 4 sums come to the driver, as a difference is cut to
    between -1 and 1.
    """
    cut = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "difference"))  # these skip nulls
    step = F.when(F.col("difference").isNotNull(), F.floor(cut * STEPS)).alias("step")
    per_id = scored.groupBy("id", "short", step).agg(F.sum("difference").alias("total"), F.count("*").alias("n"))
    met = per_id.join(taught.where("not fit").select("id", "quality"), "id")
    rows = met.groupBy("short", "step").agg(F.sum("total").alias("total"), F.sum(F.col("quality") * F.col("n")).alias(
        "good"), F.sum("n").alias("n")).collect()
    share = (sum(r.good for r in rows) + 0.5) / (sum(r.n for r in rows) + 1)
    bare = curve([(0.0, r.good, r.n) for r in rows if r.step is None], share)[1][0]
    return {k: curve([(r.total / r.n, r.good, r.n) for r in rows if r.step is not None and r.short == k], share)
            for k in (False, True)}, bare


def scored(docs: DataFrame, labels: DataFrame, keep: list[str]) -> tuple[DataFrame, Model]:
    """Struct `row` of the columns to keep, `difference`, `short` and `score` (0 to 1, higher: good likelier); the model."""
    taught = stored(lessons(labels))
    made = dictionaries(docs, taught)
    rows = stored(differences(docs, list(dict.fromkeys([*keep, "doc_id"])), made[1], made[0]))
    curves, bare = calibrated(rows.select(F.col("row.doc_id").alias("id"), "difference", "short"), taught)

    @F.pandas_udf("double")
    def drawn(x: pd.Series, short: pd.Series) -> pd.Series:
        known = x.fillna(0)
        return pd.Series(np.where(x.isna(), bare, np.where(short, np.interp(known, *curves[True]), np.interp(known, *curves[False]))))

    return rows.withColumn("score", drawn("difference", "short")), Model(made[1], made[0], curves, bare)


def judged(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """One row per document: its score, and 1 where the score is at least `least`."""
    rows, _ = scored(docs, labels, ["doc_id"])
    return rows.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                       (F.col("score") >= least).cast("int").alias("predicted"))

