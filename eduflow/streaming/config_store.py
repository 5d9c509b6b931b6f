"""The configuration in force, as a numbered snapshot that stays as small as the configuration.

A micro-batch of changes folds the snapshot before it into the next one. A reader takes the latest snapshot and stays with
it; the two before it are kept for readers that have begun. A batch that runs again starts from the same snapshot as the
first time, and so makes the same one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eduflow import schemas
from eduflow.operators import routing


class ConfigStore:
    KEPT = 3

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._root = jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def snapshots(self) -> list[int]:
        """Numbers of the complete snapshots, oldest first."""
        if not self._files.exists(self._root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._root)]
        done = [n for n in names if n.startswith("snapshot=") and self._files.exists(self._at(n, "_SUCCESS"))]
        return sorted(int(n.split("=")[1]) for n in done)

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _read(self, number: int | None) -> DataFrame:
        kept = schemas.T.StructType([schemas.T.StructField("ts_ms", schemas.T.LongType()), *schemas.CONFIG])
        if number is None:
            return self.spark.createDataFrame([], kept)
        return self.spark.read.schema(kept).parquet(f"{self.path}/snapshot={number}")

    def read(self) -> DataFrame:
        """The config rows in force."""
        return self._read(max(self.snapshots(), default=None)).select(*schemas.CONFIG.fieldNames())

    def fold(self, changes: DataFrame, number: int) -> None:
        """Make snapshot `number`: the one before it, and over it the changes of this batch in their order.

        The last change of a key stands: of a source table where the sink is a dimension, else of a table and type.
        """
        before = [n for n in self.snapshots() if n < number]
        old = self._read(max(before, default=None))
        order = routing.change_order(changes)
        rows = changes.select(F.lit(1).alias("newer"), F.struct(*order).alias("place"), "op", "ts_ms", *schemas.CONFIG.fieldNames())
        nothing = F.lit(None).cast(rows.schema["place"].dataType)
        both = old.select(F.lit(0).alias("newer"), nothing.alias("place"), F.lit("r").alias("op"), "ts_ms",
                          *schemas.CONFIG.fieldNames()).unionByName(rows)
        kind = F.when(F.col("sink_type") == "dim", F.lit("")).otherwise(F.concat(F.lit("="), "source_type"))
        last = routing.latest(both.withColumn("kind", kind), ["sink_type", "source_table", "kind"], ["newer", "place"])
        last.where("op <> 'd'").select("ts_ms", *schemas.CONFIG.fieldNames()).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/snapshot={number}")
        for gone in before[: 1 - self.KEPT]:
            self._files.delete(self._at(f"snapshot={gone}"), True)
