"""Sinks: partitioned layout, window replacement, keyed merge and whole-table snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def since(df: DataFrame, column: str, boundary: date | None) -> DataFrame:
    """Rows from ``boundary`` on; all rows in a full build. Prunes when ``column`` partitions."""
    return df if boundary is None else df.where(F.col(column) >= F.lit(boundary))


def cluster_write(
    df: DataFrame,
    path: str,
    partition: str,
    cluster: Sequence[str] = (),
    overwrite_all: bool = True,
    rebalance: bool = True,
) -> None:
    """Write one folder per ``partition`` value, rows sorted on ``cluster`` within each file.

    Replaces the whole table, or only the partitions that ``df`` holds.

    REBALANCE rather than a repartition on the partition column: a day holding a third of
    all rows is split over many tasks, and small days do not become many small files. Rows
    that already arrive by partition value, as scans of date-sharded files do, are written
    from where they are with ``rebalance=False``: no shuffle. The sort lets readers skip on
    page statistics either way.
    """
    if rebalance:
        df = df.hint("rebalance", F.col(partition))
    (
        df.sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if overwrite_all else "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def replace_window(existing: DataFrame, fresh: DataFrame, column: str, boundary: date) -> DataFrame:
    """The table after its rows from ``boundary`` on are replaced by ``fresh``."""
    return existing.where(F.col(column) < F.lit(boundary)).unionByName(fresh)


def write_window(
    spark: SparkSession, fresh: DataFrame, path: str, column: str, boundary: date, cluster: Sequence[str] = ()
) -> None:
    """Commit ``fresh`` as the new content of the partitions from ``boundary`` on.

    Dynamic overwrite replaces the partitions that ``fresh`` holds. Partitions of the window
    still made of the same files afterwards were not among them, and are dropped. Rerunning
    after a failure at any point gives the same table. The driver lists the window only.
    """
    before = _window_files(spark, path, column, boundary)
    cluster_write(fresh, path, column, cluster, overwrite_all=False)
    fs, _ = _file_system(spark, path)
    after = _window_files(spark, path, column, boundary)
    for folder, files in before.items():
        if after.get(folder) == files:
            fs.delete(_hadoop_path(spark, folder), True)


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    root = _hadoop_path(spark, path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _window_files(spark: SparkSession, path: str, column: str, boundary: date) -> dict[str, frozenset[str]]:
    """Files of each partition folder of the window."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return {}
    window = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{column}=") and name.removeprefix(f"{column}=") >= boundary.isoformat():
            files = fs.listStatus(status.getPath())
            window[status.getPath().toString()] = frozenset(f.getPath().getName() for f in files)
    return window


def merge_by_key(existing: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed merge: a matching row is replaced by the fresh one, other fresh rows are added."""
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def append_new_keys(fresh: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fresh rows whose key is not stored yet; NULL key parts compare as equal."""
    same = reduce(lambda a, b: a & b, (fresh[k].eqNullSafe(stored[k]) for k in keys))
    return fresh.join(stored.select(*keys), same, "left_anti")


def write_snapshot(df: DataFrame, path: str, version: str, cluster: Sequence[str] = (), keep: int = 3) -> None:
    """Write a whole table as a new version, so readers and a merge may still read the last one.

    Once it is committed, all versions but the newest ``keep`` are removed; a reader has until
    then to finish.
    """
    spark = df.sparkSession
    if cluster:
        df = df.hint("rebalance").sortWithinPartitions(*cluster)
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    fs, root = _file_system(spark, path)
    versions = sorted(s.getPath().toString() for s in fs.listStatus(root) if s.getPath().getName().startswith("version="))
    for old in versions[:-keep]:
        fs.delete(_hadoop_path(spark, old), True)


def latest_snapshot(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The newest completely written version, or None when there is none."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return None
    done = sorted(
        folder
        for folder in (s.getPath().toString() for s in fs.listStatus(root))
        if fs.exists(_hadoop_path(spark, f"{folder}/_SUCCESS"))
    )
    if not done:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(done[-1])
