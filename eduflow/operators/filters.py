"""Row selection: cleaning of the change log and the facts taken from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eduflow import schemas
from eduflow.functions import values as V

# Above any place in a transaction.
STEPS = 10 ** 18
KEPT_TYPES = ["insert", "update", "bootstrap-insert"]


def as_facts(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows from JSON in a text column `value`.

    Missing fields are null, and so is every field where the text is no JSON. A number may be
    written as text.
    """
    numbers = {f.name for f in schema if isinstance(f.dataType, T.NumericType)}
    loose = T.StructType([T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType) for f in schema])
    # a generator holds later filters above it, so that a line is parsed once
    place = ["seq"] if "seq" in lines.columns and "seq" not in schema.fieldNames() else []
    parsed = lines.select(*place, F.inline(F.array(F.from_json("value", loose))))
    return parsed.select(*place, *[
        (F.col(f.name).try_cast(f.dataType) if f.name in numbers else F.col(f.name)).alias(f.name) for f in schema])


def parse_changes(lines: DataFrame) -> DataFrame:
    """Change-log rows from JSON text, with `seq`, their order of arrival.

    That is the place in the topic where the source gives one, else the transaction and the place
    in it that the line itself carries. A row with neither comes before all others of its second.
    """
    rows = as_facts(lines, schemas.CHANGE_LOG)
    whole = "decimal(19,0)"
    own = (F.col("xid").cast(whole) * F.lit(STEPS).cast(whole)).cast(schemas.SEQ) + F.coalesce("xoffset", F.lit(0)).cast(whole)
    place = [F.col("seq").cast(schemas.SEQ)] if "seq" in rows.columns else []
    return rows.withColumn("seq", F.coalesce(*place, own, F.lit(-1)).cast(schemas.SEQ)).drop("xid", "xoffset")


def _arrival(changes: DataFrame) -> list[str]:
    return ["seq"] if "seq" in changes.columns else []


def clean_changes(changes: DataFrame, database: str) -> DataFrame:
    """Keep inserts, updates and snapshot rows of one database that carry data.

    A snapshot insert becomes a plain insert.
    """
    kept = changes.where(
        (F.col("database") == database) & F.col("table").isNotNull()
        & F.col("type").isin(KEPT_TYPES) & (F.size("data") > 0)
    )
    plain = F.when(F.col("type") == "bootstrap-insert", "insert").otherwise(F.col("type"))
    return kept.withColumn("type", plain)


def _inserted(database: str, table: str) -> Column:
    return (F.col("database") == database) & (F.col("table") == table) & (F.col("type") == "insert")


def _fields(names: str) -> list[Column]:
    return [F.col("data")[name].alias(name) for name in names.split()]


def cart_adds(changes: DataFrame, database: str) -> DataFrame:
    return changes.where(_inserted(database, "cart_info")).select(
        *_fields("id user_id course_id course_name"), "ts")


def order_details(changes: DataFrame, database: str) -> DataFrame:
    return changes.where(_inserted(database, "order_detail")).select(
        *_fields("id course_id course_name order_id user_id final_amount create_time"), "ts", *_arrival(changes))


def order_infos(changes: DataFrame, database: str) -> DataFrame:
    return changes.where(_inserted(database, "order_info")).select(*_fields("id province_id"), "ts")


def order_sources(pages: DataFrame) -> DataFrame:
    """Which source led to an order, from the views of the order page."""
    return pages.where((F.col("item_type") == "order_id") & (F.col("page_id") == "order")).select(
        "item", "sc", "ts")


def payments(changes: DataFrame, database: str) -> DataFrame:
    """New payments, and payments whose callback time was filled in."""
    called_back = (F.col("type") == "update") & F.col("data")["callback_time"].isNotNull()
    chosen = (F.col("database") == database) & (F.col("table") == "payment_info") & (
        (F.col("type") == "insert") | called_back)
    return changes.where(chosen).select(*_fields("id order_id create_time payment_type"), "ts")


def exam_questions(changes: DataFrame, database: str) -> DataFrame:
    return changes.where(_inserted(database, "test_exam_question")).select(
        *_fields("id exam_id paper_id question_id user_id is_correct score create_time"), "ts",
        *_arrival(changes))


def exams(changes: DataFrame, database: str) -> DataFrame:
    return changes.where(_inserted(database, "test_exam")).select(
        *_fields("id score duration_sec create_time"), "ts")


def keyword_views(pages: DataFrame) -> DataFrame:
    return pages.where((F.col("item_type") == "keyword") & F.col("item").isNotNull()).select("item", "ts")


def home_and_detail_views(pages: DataFrame) -> DataFrame:
    def flag(page: str) -> Column:
        return F.when(F.col("page_id") == page, 1).otherwise(0).cast("bigint")

    return pages.where(F.col("page_id").isin("home", "course_detail")).select(
        flag("home").alias("home_count"), flag("course_detail").alias("detail_count"), "ts")


def known_users(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("uid").isNotNull())


def sourced_orders(details: DataFrame) -> DataFrame:
    return details.where(F.col("sc").isNotNull())


def with_key(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Drop rows without a group key and count them in the query's metrics."""
    lost = F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys")
    return rows.observe(label, lost).where(F.col(key).isNotNull())


def bad_lines(changes: DataFrame, label: str = "bad_lines") -> DataFrame:
    """Count lines that did not parse, without dropping them."""
    return changes.observe(label, F.count(F.when(F.col("database").isNull(), 1)).alias("bad_lines"))


def paced(rows: DataFrame, others: DataFrame, delay: str, idle: str = "60 seconds") -> DataFrame:
    """`rows` of a source that may fall silent, kept going by the event times (`et`) of others.

    Rows of the others come along as rows that carry nothing but a time, `idle` behind their own. They move the watermark
    of a silent source, and with it what joins remember, and go no further. Both sides have `et` and no watermark yet.
    """
    columns = [c for c in rows.columns if c != "et"]
    beat = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns]
    late = (F.col("et") - F.expr(f"interval {idle}")).alias("et")
    both = rows.select(*columns, "et", F.lit(1.0).alias("own")).union(others.select(*beat, late, F.lit(0.0).alias("own")))
    # A condition that chance has a part in stays above the watermark; any other would drop these rows before it.
    return both.withWatermark("et", delay).where(F.rand() < F.col("own")).drop("own")


def event_timed(rows: DataFrame, unit: str = "ms", delay: str | None = None) -> DataFrame:
    """Add `et`, the event time; `delay` sets a watermark on a stream."""
    millis = F.col("ts") if unit == "ms" else F.col("ts") * 1000
    timed = rows.withColumn("et", V.event_time(millis))
    return timed.withWatermark("et", delay) if delay else timed
