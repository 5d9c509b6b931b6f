"""Shared folder, stored tables and hashed words, used by several operators."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eduflow import session

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where this process has found it, wherever it was started.

    A cluster on whose machines it is not installed gets it with --py-files, as any other package.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`; where that is unset, a local session (tests) gets one of this machine."""
    importable(spark)
    return session.work_folder(spark)


def stored(df: DataFrame, *by: str) -> DataFrame:
    """The rows, written to the shared folder and read again: later steps restart from there, not from the source."""
    path = shared_folder(df.sparkSession)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discarded(rows: DataFrame) -> None:
    """Remove a stored table of which nothing that is still to be computed is made."""
    jvm = rows.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(rows.stored_at)
    path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def row_print(text: Column) -> Column:
    """With the id it names a row, as ids may repeat with other texts."""
    return F.xxhash64(text, F.octet_length(text))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a number of words that bounds memory, not results."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


WORD_HASHES = WordHashes()


def forget_words() -> None:
    """Give back what remembered words took: a worker lives on after its task, beside the next stages'."""
    WORD_HASHES.clear()
    pa.default_memory_pool().release_unused()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number mapped one to one to a random-looking one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; of fewer words, one hash of the whole sequence; of none, none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return out


def per_document(docs: DataFrame, keep: list[str], fields: str, make) -> DataFrame:
    """Struct `row` of the columns to keep, and the fields that `make(texts)` gives as one Arrow array each.

    `make` takes the texts of one batch (a list, with None for null) and is called in the tasks.
    """
    importable(docs.sparkSession)
    kept = F.struct(*[docs[c] for c in keep]).alias("row")
    rows = docs.select(kept, docs["text"].cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(fields).fields])
    names, kinds = schema.names, to_arrow_schema(schema).types

    def run(batches):
        for batch in batches:
            made = make(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, kind) for x, kind in zip(made, kinds[1:], strict=True)]], names)

    return rows.mapInArrow(run, schema)
