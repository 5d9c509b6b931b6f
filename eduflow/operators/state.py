"""Keyed-state rules as set operations over a finite table.

Arrival order is named by columns. A state that only depends on the first row of a key (or of a
key and day) is taken by aggregation, so a key with very many rows is reduced before it is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eduflow.functions import values as V
from eduflow.operators import lookback

RETURN_DAYS = 7


def first_days(log: DataFrame) -> DataFrame:
    """First known day per device: the day of its first row, or the day before for an old visitor.

    Order is (ts, new visitors first). Both fit in one number, which keeps the aggregate in hash form.
    """
    old = F.when(F.col("is_new") == "1", 0).otherwise(1)
    first = (
        log.where(F.col("mid").isNotNull())
        .groupBy("mid").agg(F.min(F.col("ts") * 2 + old).alias("first_key"))
    )
    start = V.day(F.shiftright("first_key", 1))
    return first.select(
        "mid", F.when(F.col("first_key") % 2 == 0, start).otherwise(V.day_before(start)).alias("first_day"))


def repair_new_flag(log: DataFrame) -> DataFrame:
    """A device marked new on a later day than its first is not new."""
    wrong = (F.col("is_new") == "1") & (V.day(F.col("ts")) != F.col("first_day"))
    others = [c for c in log.columns if c != "is_new"]
    return (
        log.join(first_days(log), "mid")
        .select(*others, F.when(wrong, F.lit("0")).otherwise(F.col("is_new")).alias("is_new"))
    )


def page_view_measures(log: DataFrame) -> DataFrame:
    """Per view: one page view, its duration, and a new session when no page came before."""
    return log.where(F.col("mid").isNotNull()).select(
        F.col("sc").alias("source"), "is_new", "ts",
        F.lit(0).cast("bigint").alias("uv_ct"),
        F.when(F.col("last_page_id").isNull(), 1).otherwise(0).cast("bigint").alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"),
        F.coalesce("during_time", F.lit(0)).cast("bigint").alias("dur_sum"),
    )


def day_first_views(log: DataFrame, order: list[str]) -> DataFrame:
    """The first view of each device on each day."""
    kept = list(dict.fromkeys(["ts", *order, "sc", "is_new"]))
    return (
        log.where(F.col("mid").isNotNull())
        .groupBy("mid", V.day(F.col("ts")).alias("day"))
        .agg(F.min(F.struct(*kept)).alias("first"))
        .select("mid", "day", "first.*")
    )


def daily_visitors(log: DataFrame, order: list[str]) -> DataFrame:
    """Page-view rows, with a unique-visitor row for the first view of a device on a day."""
    none = F.lit(0).cast("bigint")
    visitors = day_first_views(log, order).select(
        F.col("sc").alias("source"), "is_new", "ts", F.lit(1).cast("bigint").alias("uv_ct"),
        none.alias("sv_ct"), none.alias("pv_ct"), none.alias("dur_sum"))
    return page_view_measures(log).unionByName(visitors)


def login_days(log: DataFrame) -> DataFrame:
    """One row per user and day with its first login; `back` marks a return after a long gap.

    A user has at most one row per day here, so the window is small for any user.
    """
    days = (
        log.where(F.col("uid").isNotNull())
        .groupBy("uid", V.day(F.col("ts")).alias("day")).agg(F.min("ts").alias("ts"))
    )
    before = F.lag("day").over(Window.partitionBy("uid").orderBy("day"))
    return days.withColumn("before", before).select(
        "uid", "day", "ts",
        F.when(V.whole_days(V.midnight_millis(F.col("before")), F.col("ts")) > RETURN_DAYS, 1)
        .otherwise(0).cast("bigint").alias("back"))


def daily_logins(log: DataFrame) -> DataFrame:
    """Zero rows for every view of a known user, and a counted row for its first login of a day."""
    none = F.lit(0).cast("bigint")
    views = log.where(F.col("uid").isNotNull()).select("ts", none.alias("user_count"), none.alias("back_count"))
    firsts = login_days(log).select("ts", F.lit(1).cast("bigint").alias("user_count"),
                                    F.col("back").alias("back_count"))
    return views.unionByName(firsts)


def correct_repeats(facts: DataFrame, key: str, order: list[str], measures: dict[str, Column]) -> DataFrame:
    """Turn repeats of a fact into corrections.

    The first row of a key stands as it is. A later row gives the row before it again, with each
    measure set to new minus old.
    """
    plain = [c for c in facts.columns if c not in measures]
    typed = facts.select(*plain, *[m.alias(name) for name, m in measures.items()])
    paired = lookback.with_previous(typed, key, order)
    first, old = F.col("prev").isNull(), F.col("prev")
    return paired.select(
        *[F.when(first, F.col(c)).otherwise(old[c]).alias(c) for c in plain],
        *[F.when(first, F.col(m)).otherwise(F.col(m) - old[m]).cast(typed.schema[m].dataType).alias(m)
          for m in measures])
