"""Tables stored in the cluster's shared folder: lineage is cut, a lost executor costs a task, and no memory is held."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a file of a narrow table, about.
FILE_ROWS = 500_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a folder of our own only where that is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that all of {master} shares")
        root = f"{tempfile.gettempdir()}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/chroniq-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, rows: int | None = None, path: str | None = None) -> DataFrame:
    """Write to the shared folder and read back, so lost executors cost no recomputation.

    With a bound of its narrow ``rows``, a small table is written in few files, each of which costs the writer a process.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, rows // FILE_ROWS + 1))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables; call only once the results built on them are stored."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


class Scratch:
    """The scratch tables of one computation, which deletes none but its own: results of other calls stay whole."""

    def __init__(self, spark: SparkSession):
        self.spark, self._tables = spark, []

    def store(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        out = materialize(df, name, rows, path)
        self._tables.append((out, path))
        return out

    def drop(self, *but: DataFrame) -> None:
        """Delete all tables but those named; call once what is built on the others is stored."""
        delete(self.spark, [p for t, p in self._tables if not any(t is b for b in but)])
        self._tables = [(t, p) for t, p in self._tables if any(t is b for b in but)]
