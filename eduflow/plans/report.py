"""Reports over the stored summaries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from eduflow.functions import values as V
from eduflow.streaming.window_store import WindowStore


def today() -> str:
    return datetime.date.today().strftime("%Y%m%d")


def order_by_source(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Money ordered per source on one day (yyyyMMdd, today by default)."""
    chosen = orders.where(V.compact_date(F.to_timestamp("stt", V.DATE_TIME)) == (date or today()))
    return chosen.groupBy("source_name").agg(F.sum("final_amount").cast("decimal(18,2)").alias("final_amount"))


def stored_order_by_source(store: WindowStore, table: str, date: str | None = None) -> DataFrame:
    """The same from a stored table; the catalog names the day's partitions, and no others are looked at."""
    date = date or today()
    return order_by_source(store.read(table, date), date)
