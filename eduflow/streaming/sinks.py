"""Where streams end: topics, window tables and dimension tables.

Every write made from a micro-batch replaces the part of a table that belongs to that batch, so a
batch that runs again after a failure leaves no second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eduflow import schemas, session
from eduflow.functions import values as V
from eduflow.operators import routing
from eduflow.streaming import window_store

# Size and retries of one write to a database.
JDBC = {"batchsize": "1048576"}


def started(writer: DataStreamWriter, spark: SparkSession, owner: str, name: str, every: str | None) -> StreamingQuery:
    """Start under a name with its own checkpoint; without `every`, take what is there and stop."""
    writer = writer.queryName(f"{name}-{session.owner_print(owner)}").option(
        "checkpointLocation", session.checkpoint_path(spark, owner, name))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


# topics

def topic_rows(rows: DataFrame, topic: str | None = None, key: str | None = None) -> DataFrame:
    """(topic, key, value): each row as JSON text. Without `topic`, the row names it in `sink_table`
    and its fields are in the map `data`."""
    name = F.lit(topic) if topic else F.col("sink_table")
    value = V.json_text(rows) if topic else F.to_json("data")
    return rows.select(name.alias("topic"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
                       value.alias("value"))


def file_rows(rows: DataFrame, fmt: str) -> DataFrame:
    """What a file topic holds: a text file has room for the value only, other formats keep the key."""
    kept = ["value", "topic"] if fmt == "text" or "key" not in rows.columns else ["key", "value", "topic"]
    return rows.select(*kept)


def write_topics(rows: DataFrame, owner: str, name: str, fmt: str = "kafka", path: str | None = None,
                 every: str | None = "3 seconds", **options: str) -> StreamingQuery:
    """`rows` are (topic, value) or (topic, key, value).

    File topics are written once each; Kafka may repeat a row after a failure, and readers of keyed
    topics take the last row of a key.
    """
    spark = rows.sparkSession
    if fmt == "kafka":
        return started(rows.writeStream.format("kafka").options(**options), spark, owner, name, every)
    writer = file_rows(rows, fmt).writeStream.format(fmt).partitionBy("topic").option("path", path).options(**options)
    return started(writer, spark, owner, name, every)


# keyed topics

def placed(rows: DataFrame) -> DataFrame:
    """Change rows with `place`, which orders those of a key: the fact's own time and place, then its versions."""
    seq = F.col("seq") if "seq" in rows.columns else F.lit(None)
    return rows.withColumn("place", F.struct("ts", seq.cast(schemas.SEQ).alias("seq"), "version"))


def compacted(rows: DataFrame, key: str) -> DataFrame:
    """Of the change rows of one micro-batch, those that a reader needs: the last of each key, and what it takes back.

    A key whose fact first appears in the batch takes nothing back.
    """
    of_key = Window.partitionBy(key)
    kept = placed(rows).withColumns({"_last": F.max("place").over(of_key), "_first": F.min("version").over(of_key)})
    before = F.col("gone") & (F.col("_first") > 0) & (F.col("place") == F.struct(
        F.col("_last.ts").alias("ts"), F.col("_last.seq").alias("seq"), (F.col("_last.version") - 1).alias("version")))
    return kept.where((F.col("place") == F.col("_last")) | F.coalesce(before, F.lit(False))).drop("_last", "_first").dropDuplicates(
        [key, "version"])


def change_rows(rows: DataFrame, topic: str, key: str) -> DataFrame:
    """(topic, key, value, place): each row as JSON text under its key, null where it takes a row back."""
    fields = [c for c in rows.columns if c not in ("version", "gone", "place")]
    value = F.when(~F.col("gone"), F.to_json(F.struct(*fields)))
    return rows.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), value.alias("value"), "place")


def write_changes(rows: DataFrame, owner: str, name: str, key: str, fmt: str = "kafka", path: str | None = None,
                  every: str | None = "3 seconds", **options: str) -> StreamingQuery:
    """Change rows (with `version` and `gone`) to a keyed topic, those of a key in order.

    Files are written under the number of the micro-batch, so a repeated one replaces itself; Kafka may repeat rows, and
    its readers take the last of a key.
    """
    def publish(batch: DataFrame, number: int) -> None:
        made = change_rows(compacted(batch, key), name, key).repartition("key").sortWithinPartitions("key", "place")
        if fmt == "kafka":
            made.select("topic", "key", "value").write.format("kafka").options(**options).save()
        else:
            (made.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").format(fmt).save(path))

    return started(rows.writeStream.foreachBatch(publish), rows.sparkSession, owner, name, every)


# window tables

def store_windows_jdbc(rows: DataFrame, table: str, retries: int = 3, **options: str) -> None:
    """Append finished windows to a database table; at least once, as a retry may repeat rows."""
    for attempt in range(1 + retries):
        try:
            return (window_store.stamped(rows).write.format("jdbc").options(**{**JDBC, **options, "dbtable": table})
                    .mode("append").save())
        except Exception:
            if attempt == retries:
                raise


# dimension tables

class DimStore:
    """Dimension tables in the catalog: one string column per field, and the batch each row came in.

    A batch adds one partition. Readers take the last row of each primary key. After every
    `fold_every` batches old partitions are folded, so that a table stays about as large as its
    keys.
    """

    def __init__(self, spark: SparkSession, database: str = "dims", fold_every: int = 20, folder: str | None = None):
        self.spark, self.database, self.fold_every = spark, database, fold_every
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{folder}'" if folder else ""))

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table.lower()}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table.lower()}")

    def create(self, table: str, columns: str, key: str | None, extend: str | None = None,
               applied: int | None = None) -> None:
        """`applied` is the batch of config changes that made the table."""
        fields = ", ".join(f"`{c.strip().lower()}` STRING" for c in columns.split(","))
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in
                               (("pk", (key or "id").lower()), ("extend", (extend or "").replace("'", "")),
                                ("applied", -1 if applied is None else applied)))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({fields}, _seq DECIMAL(38,0), _ts BIGINT, _came BIGINT, "
            f"_batch BIGINT) USING parquet PARTITIONED BY (_batch) TBLPROPERTIES ({properties})")

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def apply(self, changes: DataFrame, keep_rows: bool = False, batch: int | None = None) -> None:
        """Follow config changes: create if it is not there, drop, or drop and create again on an update.

        The rows are one micro-batch; of each table only what they come to is carried out. With `keep_rows` an update
        that leaves the columns as they are keeps the table. A table that this `batch` or a later one has made stays:
        the batch is running again.
        """
        for row in self.net(changes).toLocalIterator():
            there = self.exists(row.name)
            if there and row.reset and row.maker and batch is not None and int(self.property(row.name, "applied", "-1")) >= batch:
                continue
            same = keep_rows and there and not row.dropped and self.columns(row.name) == [
                c.strip().lower() for c in row.maker.sink_columns.split(",")]
            if row.reset and not same:
                self.drop(row.name)
            if row.maker:
                self.create(row.name, row.maker.sink_columns, row.maker.sink_pk, row.maker.sink_extend, batch)

    @staticmethod
    def net(changes: DataFrame) -> DataFrame:
        """What the changes of each dimension table come to: whether it is dropped on the way, and the row that makes it.

        A row makes a table that is not there; so it is the first after the last drop, or the update that drops it.
        """
        by_table = Window.partitionBy("name").orderBy(*routing.change_order(changes))
        placed = changes.where(F.col("sink_type") == "dim").withColumn("name", F.lower("sink_table")).withColumn(
            "at", F.row_number().over(by_table))
        reset = F.max(F.when(F.col("op").isin("u", "d"), F.col("at"))).over(Window.partitionBy("name"))
        placed = placed.withColumn("reset", F.coalesce(reset, F.lit(0)))
        makes = (F.col("op") != "d") & (F.col("at") >= F.col("reset"))
        maker = F.min_by(F.struct("sink_columns", "sink_pk", "sink_extend"), F.when(makes, F.col("at")))
        return placed.groupBy("name").agg((F.max("reset") > 0).alias("reset"), F.max(F.col("op") == "d").alias("dropped"),
                                          maker.alias("maker"))

    def drop_gone(self, changes: DataFrame) -> None:
        """Drop the tables whose last change in these is a delete."""
        last = routing.latest(changes.where(F.col("sink_type") == "dim"), ["sink_table"], routing.change_order(changes))
        for (table,) in last.where("op = 'd'").select("sink_table").toLocalIterator():
            self.drop(table)

    def property(self, table: str, name: str, default: str) -> str:
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where(F.col("key") == name).first()
        return shown.value if shown else default

    def columns(self, table: str) -> list[str]:
        return [c for c in self.spark.table(self.name(table)).columns if not c.startswith("_")]

    def keys(self, table: str) -> list[str]:
        return [k.strip() for k in self.property(table, "pk", "id").split(",")]

    def upsert(self, rows: DataFrame, batch: int, table: str) -> None:
        """`rows` have the map `data`, `ts`, and `seq`, their place in the source."""
        if "seq" not in rows.columns:
            raise ValueError("rows of a dimension need `seq`, their place in the source")
        data = F.transform_keys("data", lambda key, _: F.lower(key))
        fields = [data[c].alias(c) for c in self.columns(table)]
        (rows.select(*fields, F.col("seq").cast(schemas.SEQ).alias("_seq"), F.col("ts").alias("_ts"),
                     F.lit(batch).cast("bigint").alias("_came"), F.lit(batch).cast("bigint").alias("_batch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self.name(table)))

    def upsert_routed(self, rows: DataFrame, batch: int) -> None:
        """One micro-batch with rows of several tables, as `routing.route_dims` gives them."""
        rows = rows.persist()
        try:
            sinks = rows.select("sink_table", "sink_columns", "sink_pk").distinct()
            for table, columns, key in sinks.toLocalIterator():
                if not self.exists(table):  # its config row is stored, so it is to be there
                    self.create(table, columns, key)
                self.upsert(rows.where(F.col("sink_table") == table), batch, table)
                if batch % self.fold_every == self.fold_every - 1:
                    self.compact(table)
        finally:
            rows.unpersist()

    def _latest(self, table: str) -> DataFrame:
        return routing.latest(self.spark.table(self.name(table)), self.keys(table), ["_came", "_ts", "_seq"])

    def read(self, table: str) -> DataFrame:
        """Current rows; files written since the last read are seen."""
        self.spark.catalog.refreshTable(f"{self.database}.{table.lower()}")
        return self._latest(table).select(*self.columns(table))

    def row(self, table: str, key: str) -> DataFrame:
        """The row of one id, or none; the filter is applied before rows are compared."""
        rows = self.spark.table(self.name(table)).where(F.col("id") == key)
        return routing.latest(rows, ["id"], ["_came", "_ts", "_seq"]).select(*self.columns(table))

    def compact(self, table: str) -> None:
        """Write the last row of each key to one partition numbered below zero.

        What it stands for goes at the next folding only, so a reader that has begun before finds
        its files. Rows keep the number of the batch they came in, so old and folded rows together
        give the same result.
        """
        parts = [int(r.partition.split("=")[1]) for r in
                 self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").toLocalIterator()]
        if len(parts) < 2:
            return
        folded = int(self.property(table, "folded", "-1"))
        kept = min(parts) if min(parts) < 0 else None
        target = min(0, *parts) - 1
        self._latest(table).withColumn("_batch", F.lit(target).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").insertInto(self.name(table))
        for part in parts:
            if 0 <= part <= folded or part < 0 and part != kept:
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (_batch = {part})")
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('folded' = '{max(parts)}')")
