"""The warehouse as streaming queries: logs and changes to facts, facts to window tables.

Each job is one query with its own checkpoint. Jobs meet at topics, as files or in Kafka.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eduflow import schemas
from eduflow.operators import filters, joins, projections, routing, windows
from eduflow.plans import summaries
from eduflow.sources import topics
from eduflow.streaming import sinks, states
from eduflow.streaming.config_store import ConfigStore
from eduflow.streaming.window_store import WindowStore

HALF_HOUR = "30 minutes"
SOURCE_NEAR = (HALF_HOUR, "5 seconds")
INFO_NEAR = (HALF_HOUR, HALF_HOUR)


@dataclass
class Warehouse:
    """`folder` holds file topics, window tables and the config table; `database` names the source.

    `every` is the trigger interval; None runs over what is there and stops.
    """

    spark: SparkSession
    folder: str
    database: str
    fmt: str = "text"
    every: str | None = "3 seconds"
    source_options: dict[str, str] = field(default_factory=dict)
    sink_options: dict[str, str] = field(default_factory=dict)
    delay: str = windows.DELAY
    idle: str = "60 seconds"    # so far behind the others a silent source is taken to be
    window_seconds: int = 5
    salt: int = 1               # tasks that share one key of a stream join
    dim_database: str = "dims"
    dim_folder: str | None = None       # place of the dimension tables, the catalog's own by default
    early_details: bool = False         # order details as a keyed topic with rows taken back
    window_database: str | None = None  # by default named after the dimensions' database

    def __post_init__(self):
        self.dims = sinks.DimStore(self.spark, self.dim_database, folder=self.dim_folder)
        self.window_tables = WindowStore(
            self.spark, self.window_database or f"{self.dim_database}_windows", f"{self.folder}/windows")

    # topics

    def lines(self, topic: str, streaming: bool = True) -> DataFrame:
        raw = topic in (schemas.RAW_LOG_TOPIC, schemas.CHANGE_LOG_TOPIC, "table_process")
        if self.fmt != "kafka" and raw:
            return topics.read_lines(self.spark, f"{self.folder}/{topic}", streaming, **self.source_options)
        path = f"{self.folder}/topics/{self._writer(topic)}"
        fmt = self._keyed_fmt if self.early_details and topic == "dwd_trade_order_detail" else self.fmt
        return topics.read_topic(self.spark, topic, fmt, path, streaming, **self.source_options)

    def _writer(self, topic: str) -> str:
        if topic in schemas.LOG_TOPICS.values():
            return "dwd_logs"
        return topic if topic in self.OWN else "dwd_routed"

    OWN = ("dwd_trade_cart_add", "dwd_trade_order_detail", "dwd_trade_pay_suc_detail", "dwd_exam_exam_question")

    @property
    def owner(self) -> str:
        """What tells this warehouse's queries from another's."""
        return f"{self.folder}|{self.database}|{self.dim_database}"

    def _started(self, writer, name: str) -> StreamingQuery:
        return sinks.started(writer, self.spark, self.owner, name, self.every)

    def _publish(self, rows: DataFrame, name: str) -> StreamingQuery:
        path = f"{self.folder}/topics/{name}"
        return sinks.write_topics(rows, self.owner, name, self.fmt, path, self.every, **self.sink_options)

    def changes(self) -> DataFrame:
        return filters.parse_changes(self.lines(schemas.CHANGE_LOG_TOPIC))

    def pages(self) -> DataFrame:
        return topics.page_log(self.lines(schemas.LOG_TOPICS["page"]))

    def _timed(self, rows: DataFrame, unit: str = "s") -> DataFrame:
        return filters.event_timed(rows, unit, self.delay)

    # detail facts

    def logs(self) -> StreamingQuery:
        """Raw logs to the six log topics, with the new-visitor flag repaired."""
        flat = projections.flat_log(topics.raw_log(self.lines(schemas.RAW_LOG_TOPIC)))
        split = projections.split_log(projections.nested_log(states.repair_new_flag(flat)))
        return self._publish(split.select("topic", F.to_json("data").alias("value")), "dwd_logs")

    def cart_adds(self) -> StreamingQuery:
        rows = filters.cart_adds(self.changes(), self.database)
        return self._publish(sinks.topic_rows(rows, "dwd_trade_cart_add"), "dwd_trade_cart_add")

    def order_details(self, info_near=INFO_NEAR, source_near=SOURCE_NEAR) -> StreamingQuery:
        """The times bound what a join remembers; the outer join needs such a bound.

        With `early_details`, a detail is given at once, and taken back and given again when its source comes.
        """
        # The page log may fall silent while orders come: their time moves on what waits for a source.
        sources = filters.paced(filters.event_timed(filters.order_sources(self.pages())),
                                filters.event_timed(self.changes().select("ts"), "s"), self.delay, self.idle)
        given = (self._timed(filters.order_details(self.changes(), self.database)),
                 self._timed(filters.order_infos(self.changes(), self.database)), sources, info_near, source_near, self.salt)
        topic = "dwd_trade_order_detail"
        if self.early_details:
            return sinks.write_changes(joins.order_detail_changes(*given), self.owner, topic, "id", self._keyed_fmt,
                                       f"{self.folder}/topics/{topic}", self.every, **self.sink_options)
        return self._publish(sinks.topic_rows(joins.order_detail_facts(*given), topic, "id"), topic)

    @property
    def _keyed_fmt(self) -> str:
        """A line of text has no room for a key."""
        return "parquet" if self.fmt == "text" else self.fmt

    def payments(self, near: tuple[str, str] | None = None) -> StreamingQuery:
        """Payments meet their details however late. With `near`, partners further apart do not meet, and what
        is forgotten shows as removed state rows in the query's progress."""
        details = topics.facts(self.lines("dwd_trade_order_detail"), "dwd_trade_order_detail")
        rows = joins.payment_facts(
            self._timed(filters.payments(self.changes(), self.database)), self._timed(details), near, self.salt)
        return self._publish(sinks.topic_rows(rows, "dwd_trade_pay_suc_detail"), "dwd_trade_pay_suc_detail")

    def exam_questions(self, near: tuple[str, str] | None = None) -> StreamingQuery:
        rows = joins.exam_question_facts(
            self._timed(filters.exam_questions(self.changes(), self.database)),
            self._timed(filters.exams(self.changes(), self.database)), near, self.salt)
        return self._publish(sinks.topic_rows(rows, "dwd_exam_exam_question"), "dwd_exam_exam_question")

    # configuration

    @property
    def config_path(self) -> str:
        return f"{self.folder}/config"

    def preload(self, snapshot: DataFrame) -> None:
        """Stored config rows as a starting point; later changes win over them."""
        rows = snapshot.select(F.lit("r").alias("op"), F.lit(0).cast("bigint").alias("ts_ms"), *schemas.CONFIG.fieldNames())
        self.config_store.fold(rows, -1)
        self.dims.apply(rows)

    def config(self, keep_rows: bool = False) -> StreamingQuery:
        """Keep the config in force as a numbered snapshot and make or drop dimension tables as its changes say."""
        def apply(batch: DataFrame, number: int) -> None:
            # A table is there before its config row is seen, and is gone only after its row is.
            self.dims.apply(batch, keep_rows, number)
            self.config_store.fold(batch, number)
            self.dims.drop_gone(batch)

        rows = topics.config_log(self.lines("table_process"))
        return self._started(rows.writeStream.foreachBatch(apply), "config")

    @property
    def config_store(self) -> ConfigStore:
        return ConfigStore(self.spark, self.config_path)

    def current_config(self, sink_type: str) -> DataFrame:
        """Config in force now: one snapshot, chosen anew for each micro-batch. Start `config` or `preload` first."""
        return self.config_store.read().where(F.col("sink_type") == sink_type)

    def dim_rows(self) -> StreamingQuery:
        """Change rows of dimension tables into their tables."""
        def upsert(batch: DataFrame, number: int) -> None:
            self.dims.upsert_routed(routing.route_dims(batch, self.current_config("dim")), number)

        rows = filters.clean_changes(self.changes(), self.database)
        return self._started(rows.writeStream.foreachBatch(upsert), "dim_rows")

    def routed(self) -> StreamingQuery:
        """Change rows that are facts of their own to the topics the config names.

        Each micro-batch is written under its number, so a repeated one replaces itself. For Kafka
        the rows are appended.
        """
        def publish(batch: DataFrame, number: int) -> None:
            rows = sinks.topic_rows(routing.route_facts(batch, self.current_config("dwd")))
            if self.fmt == "kafka":
                rows.write.format("kafka").options(**self.sink_options).save()
            else:
                (rows.select("value", "topic", F.lit(number).alias("batch")).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch")
                 .format(self.fmt).save(f"{self.folder}/topics/dwd_routed"))

        rows = filters.clean_changes(self.changes(), self.database)
        return self._started(rows.writeStream.foreachBatch(publish), "dwd_routed")

    # window tables

    def facts(self, topic: str) -> DataFrame:
        lines = self.lines(topic)
        if topic == schemas.LOG_TOPICS["page"]:
            return topics.page_log(lines)
        if topic == schemas.LOG_TOPICS["appVideo"]:
            return topics.video_log(lines)
        return topics.facts(lines, topic)

    def summary(self, table: str, keep_ms: int | None = None) -> StreamingQuery:
        """One window table. Dimensions are read again for each micro-batch of closed windows.

        Where the group key comes from a dimension, the look-up is part of the stream and sees the
        dimension as it is when the query starts.
        """
        job = summaries.JOBS[table]

        def store(batch: DataFrame, number: int) -> None:
            self.window_tables.store(table, job.finish(batch, self.dims.read), number)

        rows = states.windowed(table, self.facts(job.topic), self.dims.read, self.window_seconds,
                               self.delay, keep_ms)
        return self._started(rows.writeStream.foreachBatch(store), table)

    def windows(self, table: str) -> DataFrame:
        return self.window_tables.read(table)
