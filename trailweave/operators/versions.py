"""Partitioned tables whose versions appear at once.

A commit writes its partitions into a folder of its own and then publishes a version: a small file
that names, for every partition of the table, the commit that holds it. The file comes into being
by one rename, so a reader sees the table before the commit or after it, never a mix, and goes on
reading the files of its version until they are removed some versions later. A run that dies
leaves files that no version names; a rerun starts from the last version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .incremental import _file_system, _hadoop_path

#: Folder names of partitions, as `event_date=2024-02-01` or `month=2024-02-01/bucket=7`, with their commits.
Partitions = dict[str, str]


class ConcurrentCommit(RuntimeError):
    """Another run has published a version since this one read the table."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: StructType
    partitions: Partitions
    #: What the writer wants to find again, as the version of another table that this one follows.
    notes: dict[str, int]


@dataclass(frozen=True)
class VersionedTable:
    """The table under ``path``, one folder per value of the ``partition`` columns.

    With ``buckets``, files are bucketed and sorted on ``bucket_by``; bucketed() then gives a
    DataFrame that Spark joins on that column without moving its rows.
    """

    spark: SparkSession
    path: str
    partition: tuple[str, ...]
    cluster: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0
    keep: int = 3

    # -- reading

    def _versions(self) -> list[int]:
        fs, root = _file_system(self.spark, f"{self.path}/_versions")
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _version_file(self, number: int) -> str:
        return f"{self.path}/_versions/{number:08d}.json"

    def version(self, number: int | None = None) -> Version | None:
        """A version, by default the newest; None before the first commit."""
        if number is None:
            numbers = self._versions()
            if not numbers:
                return None
            number = numbers[-1]
        fs, file = _file_system(self.spark, self._version_file(number))
        stream = fs.open(file)
        try:
            found = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, StructType.fromJson(found["schema"]), found["partitions"], found["notes"])

    def find(self, number: int) -> Version | None:
        """A version if it is kept still."""
        return self.version(number) if number in self._versions() else None

    def folder(self, partition: str, commit: str) -> str:
        return f"{self.path}/data/commit={commit}/{partition}"

    def read(self, of: Callable[[str], bool] = lambda partition: True) -> DataFrame | None:
        """The newest version. Partition columns prune as those of any partitioned files.

        With ``of``, only the partitions that it names are looked at, not so much as listed.
        """
        now = self.version()
        if now is None:
            return None
        folders = [self.folder(p, c) for p, c in sorted(now.partitions.items()) if of(p)]
        if not folders:
            return self.spark.createDataFrame([], now.schema)
        rows = self.spark.read.schema(now.schema).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*now.schema.names)

    def bucketed(self) -> DataFrame | None:
        """The newest version as a bucketed table of the session, whose partitions lie where their commits put them."""
        now = self.version()
        if now is None:
            return None
        prefix = f"trailweave_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}_"
        name = f"{prefix}{now.number}"
        if not self.spark.catalog.tableExists(name):
            for old in self.spark.catalog.listTables(pattern=f"{prefix}*"):
                if int(old.name.removeprefix(prefix)) <= now.number - self.keep:
                    self.spark.sql(f"DROP TABLE IF EXISTS {old.name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(self.partition)}) "
                f"CLUSTERED BY ({self.bucket_by}) SORTED BY ({self.bucket_by}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.path}/none'"
            )
            added = []
            for partition, commit in now.partitions.items():
                values = ", ".join("{}='{}'".format(*part.split("=", 1)) for part in partition.split("/"))
                added.append(f"PARTITION ({values}) LOCATION '{self.folder(partition, commit)}'")
            if added:
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")
        return self.spark.table(name)

    # -- writing

    def commit(
        self,
        fresh: DataFrame,
        replaced: Callable[[str], bool] = lambda partition: True,
        rebalance: bool = True,
        **notes: int,
    ) -> Version:
        """Publish the table with ``fresh`` in place of the partitions that ``replaced`` names and of those it holds.

        All partitions are replaced by default. Rows are rebalanced on the partition columns, so a
        day that holds a third of them is split over tasks; ``rebalance=False`` writes them from
        where they are.
        """
        before = self.version()
        commit = f"c{uuid.uuid4().hex}"
        data = f"{self.path}/data/commit={commit}"
        self._write(fresh, data, rebalance)
        partitions = {p: c for p, c in (before.partitions if before else {}).items() if not replaced(p)}
        partitions |= {p: commit for p in self._folders(data)}
        # partition columns stand last, as they do in files read back
        ends = {n: k for k, n in enumerate(self.partition)}
        schema = StructType(sorted(fresh.schema, key=lambda f: ends.get(f.name, -1)))
        after = Version(before.number + 1 if before else 1, schema, partitions, notes)
        self._publish(after)
        self._remove_old()
        return after

    def _write(self, fresh: DataFrame, data: str, rebalance: bool) -> None:
        if self.bucket_by is None:
            rows = fresh.hint("rebalance", *[F.col(c) for c in self.partition]) if rebalance else fresh
            rows.sortWithinPartitions(*self.partition, *self.cluster).write.partitionBy(*self.partition).parquet(data)
            return
        # a table of this name for the time of the write only: just tables can be bucketed
        name = f"trailweave_write_{uuid.uuid4().hex}"
        rows = fresh.repartition(self.buckets, self.bucket_by).write.partitionBy(*self.partition)
        rows.bucketBy(self.buckets, self.bucket_by).sortBy(self.bucket_by).option("path", data).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _folders(self, data: str, depth: int = 0, under: str = "") -> list[str]:
        """Partition folders of a commit, by listing: one entry per partition."""
        fs, root = _file_system(self.spark, f"{data}/{under}" if under else data)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory() and "=" in s.getPath().getName()]
        inner = [f"{under}/{n}" if under else n for n in names]
        if depth + 1 == len(self.partition):
            return inner
        return [p for n in inner for p in self._folders(data, depth + 1, n)]

    def _publish(self, version: Version) -> None:
        context = self.spark.sparkContext
        content = json.dumps({"schema": version.schema.jsonValue(), "partitions": version.partitions, "notes": version.notes})
        fs, _ = _file_system(self.spark, self.path)
        draft = _hadoop_path(self.spark, f"{self.path}/_versions/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(content.encode("utf-8"))
        stream.close()
        options = context._jvm.org.apache.hadoop.fs.Options.Rename
        files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), context._jsc.hadoopConfiguration())
        target = _hadoop_path(self.spark, self._version_file(version.number))
        if fs.exists(target):
            raise ConcurrentCommit(f"{self.path}: version {version.number} is there already")
        # fails, rather than replaces, where another run has been faster
        files.rename(draft, target, context._gateway.new_array(options, 0))

    def _remove_old(self) -> None:
        """Remove versions but the newest ``keep``, and the partitions that only those hold."""
        numbers = self._versions()
        gone = [self.version(n) for n in numbers[: -self.keep]]
        if not gone:
            return
        held = {item for n in numbers[-self.keep :] for item in self.version(n).partitions.items()}
        fs, _ = _file_system(self.spark, self.path)
        for old in gone:
            for partition, commit in old.partitions.items():
                if (partition, commit) not in held:
                    fs.delete(_hadoop_path(self.spark, self.folder(partition, commit)), True)
            fs.delete(_hadoop_path(self.spark, self._version_file(old.number)), False)


def from_value(column: str, boundary: str) -> Callable[[str], bool]:
    """Names the partitions whose ``column`` is ``boundary`` or later; a null one counts as later."""
    prefix = f"{column}="
    return lambda partition: any(
        part.startswith(prefix) and part.removeprefix(prefix) >= boundary for part in partition.split("/")
    )


def bucket_of(column, buckets: int):
    """The bucket into which Spark puts a row of a bucketed table."""
    return F.pmod(F.hash(column), F.lit(buckets))


def touched(rows: DataFrame, column: str, buckets: int) -> Sequence[int]:
    """Buckets that hold some value of ``column``: at most ``buckets`` numbers come to the driver."""
    found = rows.where(F.col(column).isNotNull()).select(bucket_of(column, buckets).alias("bucket")).distinct()
    return sorted(r.bucket for r in found.collect())
