"""Session settings the library relies on."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; each may be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where the split costs another exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # needed by transformWithState; also keeps window state off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # state and its change log are most of what a stream writes; a checkpoint goes on with the codec of its log
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


def configure(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def build_session(app: str = "eduflow", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set; name a shared folder there")
    return folder.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """A new folder below the shared one; a local session that names none gets one of this machine."""
    master = spark.sparkContext.master
    if not spark.conf.get("spark.checkpoint.dir", None) and (master == "local" or master.startswith("local[")):
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return f"{shared_folder(spark)}/eduflow/work/{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again, for plans that read them more than once."""
    folder = work_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def checkpoint_path(spark: SparkSession, owner: str, query: str) -> str:
    """One checkpoint folder per owner and query name, kept between runs.

    The owner names all that tells one set of queries from another, such as folder and database: queries of
    two owners must never go on from each other's place.
    """
    return f"{shared_folder(spark)}/eduflow/checkpoints/{owner_print(owner)}/{query}"


def owner_print(owner: str) -> str:
    return hashlib.sha256(owner.encode()).hexdigest()[:16]
