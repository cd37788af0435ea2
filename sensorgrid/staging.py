"""Written tables that cut lineage between the steps of a long plan.

A step that several later steps read (the resampled cells, for example) is written once
as Parquet in the shared checkpoint folder.  Later steps then scan only the columns they
need, the optimizer knows the table's size, and a lost executor costs a re-read instead of
a recomputation from the raw data.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only on a local master."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="sensorgrid-")
    spark.conf.set(SETTING, root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/sensorgrid/{label}-{uuid.uuid4().hex}"


#: A task keeps a file open for each of few folders, instead of a sort by folder; times as plain numbers.
_WRITE = {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table (runs a job)."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _settings(spark, _WRITE):
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    where, files = _folder(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(where)] if files.exists(where) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    where, files = _folder(spark, path)
    files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(to))


def delete(spark: SparkSession, path: str) -> None:
    where, files = _folder(spark, path)
    files.delete(where, True)


def reads(df: DataFrame, *staged: DataFrame) -> DataFrame:
    """``df``, which reads these staged tables: they go when ``df`` is released."""
    df._reads = staged
    return df


def release(*staged: DataFrame) -> None:
    """Delete staged tables that no later step reads; other frames are left alone."""
    for df in staged:
        path = getattr(df, "_staged_at", None)
        if path:
            delete(df.sparkSession, path)
        release(*getattr(df, "_reads", ()))
