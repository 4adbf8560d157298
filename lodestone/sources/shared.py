"""Tables in the folder the cluster shares (``spark.checkpoint.dir``).

A table written here ends a plan's lineage: a lost executor costs a file read.
Bucketed tables are dealt by a key once and then joined on it without moving."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from lodestone.session import checkpoint_dir


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lodestone/{tag}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, tag: str, path: str | None = None, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df`` written as Parquet and read back, and aggregates of its rows taken on the way."""
    spark = df.sparkSession
    path = path or shared_path(spark, tag)
    if metrics:
        seen = Observation()
        df.observe(seen, *(c.alias(k) for k, c in metrics.items())).write.parquet(path)
        got = seen.get
    else:
        df.write.parquet(path)
        got = {}
    return spark.read.schema(df.schema).parquet(path), got


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder; a missing one is no error."""
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    fs, p = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


class Bucketed:
    """A Parquet table dealt into ``buckets`` files by the hash of ``key``, so that joins with
    others of the same key and count move nothing. The files survive the session; ``open``
    names them again."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int, name: str):
        self.spark, self.path, self.key, self.buckets, self.name = spark, path, key, buckets, name

    @classmethod
    def write(cls, df: DataFrame, path: str, key: str, buckets: int, **metrics: Column) -> tuple[Bucketed, dict]:
        """Rows already dealt by ``key`` in ``buckets`` partitions are written where they are."""
        spark = df.sparkSession
        name = f"lodestone_{uuid.uuid4().hex}"
        seen = Observation()
        if metrics:
            df = df.observe(seen, *(c.alias(k) for k, c in metrics.items()))
        (df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
         .mode("overwrite").saveAsTable(name))
        return cls(spark, path, key, buckets, name), (seen.get if metrics else {})

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> Bucketed:
        name = f"lodestone_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (path '{path}') "
                  f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")
        return cls(spark, path, key, buckets, name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def remove(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(self.spark, self.path)
