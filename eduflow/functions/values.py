"""Column helpers: typed reads, JSON, times, names and words."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(16,2)"
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


# typed reads: text that is not a number reads as null

def as_long(value: Column) -> Column:
    return value.try_cast("bigint")


def as_double(value: Column) -> Column:
    return value.try_cast("double")


def as_money(value: Column) -> Column:
    return value.try_cast(MONEY)


def json_text(df: DataFrame) -> Column:
    """All columns of a row as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*df.columns))


def listed(csv: Column) -> Column:
    """The names in a comma-separated list."""
    return F.split(csv, ",")


def keep_keys(data: Column, names: Column) -> Column:
    return F.map_filter(data, lambda key, _: F.array_contains(names, key))


def merge_maps(*parts: Column) -> Column:
    """Later maps win on a shared key (needs mapKeyDedupPolicy=LAST_WIN)."""
    return F.map_concat(*parts)


# times: epoch milliseconds in, text out, in the session time zone

def event_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def date_text(millis: Column) -> Column:
    return F.date_format(event_time(millis), DATE)


def date_time_text(millis: Column) -> Column:
    return F.date_format(event_time(millis), DATE_TIME)


def date_millis(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATE)))


def date_time_millis(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATE_TIME)))


def day(millis: Column) -> Column:
    return F.to_date(event_time(millis))


def day_before(date: Column) -> Column:
    return F.date_sub(date, 1)


def midnight_millis(date: Column) -> Column:
    return F.unix_millis(date.cast("timestamp"))


def floor_div(top: Column, bottom: Column) -> Column:
    """Integer division that drops the fraction."""
    return F.call_function("div", top, bottom)


def whole_days(since: Column, until: Column) -> Column:
    """Full days between two epoch-millisecond columns."""
    return floor_div(until - since, F.lit(86_400_000).cast("bigint"))


def compact_date(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd")


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


# names

def snake_name(name: str) -> str:
    return re.sub(r"(?<!^)([A-Z])", r"_\1", name).lower()


def camel_name(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def rename_columns(df: DataFrame, rule) -> DataFrame:
    return df.toDF(*[rule(name) for name in df.columns])


# words

def words(text: Column) -> Column:
    """Distinct lower-case words of a text; a word is a run of letters and digits."""
    parts = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_remove(F.array_distinct(parts), "")
