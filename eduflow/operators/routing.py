"""Routing of change rows by configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eduflow import schemas
from eduflow.functions import values as V
from eduflow.operators import filters


def parse_config(lines: DataFrame) -> DataFrame:
    return filters.as_facts(lines, schemas.CONFIG_CHANGE)


def config_rows(changes: DataFrame) -> DataFrame:
    """One config row per change: the old image of a delete, else the new one."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    others = [c for c in changes.columns if c not in ("before", "after")]
    return changes.select(*others, image.alias("image")).select(*others, "image.*")


def change_order(changes: DataFrame) -> list[str]:
    """A total order of config changes: time, then place in the source's log, then content."""
    return ["ts_ms", *[c for c in ("pos", "seq") if c in changes.columns], "op",
            *[c for c in changes.columns if c in schemas.CONFIG.fieldNames()]]


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. Partly reduced before the exchange, so a hot key moves as few rows."""
    last = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*[F.col(k).alias(f"key_{k}") for k in keys]).agg(last.alias("row")).select("row.*")


def current_config(changes: DataFrame, sink_type: str, order: list[str]) -> DataFrame:
    """Fold config changes to the rows in force for one kind of sink."""
    keys = ["source_table"] if sink_type == "dim" else ["source_table", "source_type"]
    chosen = changes.where(F.col("sink_type") == sink_type)
    return latest(chosen, keys, order).where(F.col("op") != "d").select(*schemas.CONFIG.fieldNames())


def _pruned(rows: DataFrame) -> DataFrame:
    return rows.withColumn("data", V.keep_keys(F.col("data"), V.listed(F.col("sink_columns"))))


def route_dims(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change rows of dimension tables, with their sink and only its columns; others are dropped."""
    chosen = config.where(F.col("sink_type") == "dim").select(
        F.col("source_table").alias("config_table"), "sink_table", "sink_columns", "sink_pk")
    joined = changes.join(chosen, F.col("table") == F.col("config_table"))
    return _pruned(joined.drop("config_table"))


def route_facts(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change rows that are facts of their own, by table and type of change."""
    chosen = config.where(F.col("sink_type") == "dwd").select(
        F.col("source_table").alias("config_table"), F.col("source_type").alias("config_type"),
        "sink_table", "sink_columns")
    on = (F.col("table") == F.col("config_table")) & (F.col("type") == F.col("config_type"))
    return _pruned(changes.join(chosen, on).drop("config_table", "config_type"))
