"""Window tables in the catalog, by month and batch.

The catalog's list of partitions says what a table holds, so a report asks it for the month of its day, lists those
folders only, and finds the day (`dt`, in order inside each file) by the files' own bounds. A folder per day would be a file
per day and batch, whatever few rows it has. A micro-batch writes the partitions (month, its number); written again after
a failure, it replaces them.

Folding writes what a month has so far into one partition whose number, below zero, tells up to which batch it stands for
all others: -(u + 2) for batches up to u. The catalog learns of a partition when its files are complete. From then on
readers take the partition that stands for most, and of the others those of later batches; so a fold that breaks off at
any point, and a folded batch that runs again, change nothing that is read. What a fold stands for is dropped at the next
one, so that a reader that has begun before finds its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eduflow.functions import values as V


def stamped(rows: DataFrame) -> DataFrame:
    """Add the processing time, in milliseconds."""
    return rows.withColumn("ts", V.now_millis())


def folded_up_to(batch: int) -> int:
    """The last batch that a partition numbered below zero stands for."""
    return -batch - 2


class WindowStore:
    """Window tables of one database; it needs a catalog that lasts as long as the tables do."""

    def __init__(self, spark: SparkSession, database: str = "windows", folder: str | None = None, fold_every: int = 20):
        self.spark, self.database, self.fold_every = spark, database, fold_every
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{folder}'" if folder else ""))

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def create(self, table: str, rows: DataFrame) -> None:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stamped(rows).schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({fields}, dt STRING, mon STRING, batch BIGINT) "
                       "USING parquet PARTITIONED BY (mon, batch)")

    def _write(self, table: str, rows: DataFrame) -> None:
        # A month's rows come together, few to a file; a large one is still cut into several.
        (rows.select(*self.spark.table(self.name(table)).columns).hint("rebalance", F.col("mon")).sortWithinPartitions("mon", "stt")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self.name(table)))

    def store(self, table: str, rows: DataFrame, batch: int) -> None:
        """Finished windows of one micro-batch, under the day they start on."""
        if not self.exists(table):
            self.create(table, rows)
        day = F.replace(F.substring("stt", 1, 10), F.lit("-"), F.lit(""))
        self._write(table, stamped(rows).withColumn("dt", day).withColumns(
            {"mon": F.substring("dt", 1, 6), "batch": F.lit(batch).cast("bigint")}))
        if batch % self.fold_every == self.fold_every - 1:
            self.fold(table)

    def partitions(self, table: str, month: str | None = None) -> dict[str, list[int]]:
        """The batches of each month, or of one, as the catalog has them."""
        one = f" PARTITION (mon = '{month}')" if month else ""
        found: dict[str, list[int]] = {}
        for (spec,) in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}{one}").toLocalIterator():
            month_, batch = (part.split("=", 1)[1] for part in spec.split("/"))
            found.setdefault(month_, []).append(int(batch))
        return found

    @staticmethod
    def valid(batches: list[int]) -> list[int]:
        """Those to be read: the partition that stands for most batches, and all later ones."""
        most = min([b for b in batches if b < 0], default=None)
        later = [b for b in batches if b >= 0 and (most is None or b > folded_up_to(most))]
        return ([] if most is None else [most]) + later

    def read(self, table: str, day: str | None = None) -> DataFrame:
        """The rows of a table, or of one day (yyyyMMdd), with their day as `dt`."""
        rows = self.spark.table(self.name(table))
        if day is not None:
            chosen = self.valid(self.partitions(table, day[:6]).get(day[:6], []))
            return rows.where((F.col("mon") == day[:6]) & F.col("batch").isin(chosen) & (F.col("dt") == day)).drop("mon", "batch")
        gone = [(month, b) for month, batches in self.partitions(table).items() for b in set(batches) - set(self.valid(batches))]
        if gone:  # a row for each partition that a fold stands for, until the next fold drops it
            dead = self.spark.createDataFrame(gone, "dead_mon string, dead_batch bigint")
            rows = rows.join(dead, (F.col("mon") == F.col("dead_mon")) & (F.col("batch") == F.col("dead_batch")), "left_anti")
        return rows.drop("mon", "batch")

    def fold(self, table: str) -> None:
        """Each month that has gathered batches becomes one partition; what older folds stood for is dropped."""
        parts = self.partitions(table)
        for month, batches in parts.items():
            for batch in set(batches) - set(self.valid(batches)):
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (mon = '{month}', batch = {batch})")
        due = {month: self.valid(batches) for month, batches in parts.items() if len(self.valid(batches)) > 1}
        for month, batches in due.items():
            rows = self.spark.table(self.name(table)).where((F.col("mon") == month) & F.col("batch").isin(batches))
            self._write(table, rows.withColumn("batch", F.lit(-max(batches) - 2).cast("bigint")))
