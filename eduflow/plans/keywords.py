"""Search words of texts: each text counts once for a word it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eduflow.functions import values as V


def split_words(rows: DataFrame, text: str) -> DataFrame:
    return rows.withColumn("keyword", F.explode(V.words(F.col(text))))


def word_counts(rows: DataFrame, text: str) -> DataFrame:
    return split_words(rows, text).groupBy("keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
