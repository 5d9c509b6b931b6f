"""Faults between the write of a micro-batch and its commit."""

from __future__ import annotations

from pyspark.sql import SparkSession

from eduflow import session


def uncommit(spark: SparkSession, owner: str, name: str) -> int:
    """Take back the last commit of a stopped query: it is as if it had been lost after its sink had written.

    Gives the number of the micro-batch that the next start runs again.
    """
    jvm = spark._jvm
    folder = f"{session.checkpoint_path(spark, owner, name)}/commits"
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(n) for n in (f.getPath().getName() for f in files.listStatus(root)) if n.isdigit())
    files.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/{last}"), False)
    return last
