"""Topic sources: text rows of a topic, live or as a finite table.

`fmt` is "kafka" or a file format. File topics are folders of text files; a folder written by
`streaming.sinks.write_topics` holds many topics, split by a `topic` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eduflow import schemas
from eduflow.operators import filters, projections, routing

# Where a topic is read from when a query starts without a checkpoint.
PER_PARTITION = 1 << 48
KAFKA = {"startingOffsets": "latest", "kafka.isolation.level": "read_committed"}


def read_topic(spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None,
               streaming: bool = True, group: str | None = None, **options: str) -> DataFrame:
    """A text column `value`, and from Kafka `seq`, a message's place in its topic; empty messages are left out."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        kafka = dict(KAFKA) if streaming else {"kafka.isolation.level": "read_committed"}
        if group:
            kafka["kafka.group.id"] = group
        loaded = reader.format("kafka").options(**{**kafka, **options, "subscribe": topic}).load()
        place = F.col("partition").cast("bigint") * PER_PARTITION + F.col("offset")
        return loaded.select(F.col("value").cast("string").alias("value"), place.alias("seq")).where(
            F.col("value").isNotNull())
    loaded = reader.format(fmt).schema("value string, topic string").options(**options).load(path)
    return loaded.where((F.col("topic") == topic) & F.col("value").isNotNull()).select("value")


def folded(spark: SparkSession, topic: str, path: str, fmt: str = "parquet") -> DataFrame:
    """What a keyed file topic says now: key and value of the last row of each key; keys taken back are left out."""
    place = f"place struct<ts:bigint,seq:{schemas.SEQ.simpleString()},version:bigint>"
    rows = spark.read.format(fmt).schema(f"key string, value string, {place}, topic string, batch bigint").load(path)
    last = routing.latest(rows.where(F.col("topic") == topic), ["key"], ["place", "batch"])
    return last.where(F.col("value").isNotNull()).select("key", "value")


def read_lines(spark: SparkSession, path: str, streaming: bool = True, **options: str) -> DataFrame:
    """A folder of text files that holds one topic only."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema("value string").options(**options).text(path).where(F.col("value").isNotNull())


def change_log(lines: DataFrame) -> DataFrame:
    return filters.bad_lines(filters.parse_changes(lines))


def raw_log(lines: DataFrame) -> DataFrame:
    return projections.parse_log(lines)


def page_log(lines: DataFrame) -> DataFrame:
    return filters.as_facts(lines, schemas.PAGE_LOG)


def facts(lines: DataFrame, topic: str) -> DataFrame:
    return filters.as_facts(lines, schemas.FACT_TOPICS[topic])


def video_log(lines: DataFrame) -> DataFrame:
    return filters.as_facts(lines, schemas.VIDEO_PLAY)


def config_log(lines: DataFrame) -> DataFrame:
    return routing.config_rows(routing.parse_config(lines))


def config_snapshot(spark: SparkSession, sink_type: str, fmt: str = "jdbc", **options: str) -> DataFrame:
    """Stored config rows of one kind of sink; the filter reaches a JDBC or parquet source."""
    loaded = spark.read.format(fmt).options(**options).load()
    return loaded.select(*schemas.CONFIG.fieldNames()).where(F.col("sink_type") == sink_type)
