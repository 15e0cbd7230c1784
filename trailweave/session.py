"""Session settings the models rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# what the models rely on for right results
_REQUIRED = {
    # calendar logic and micros-to-timestamp conversion assume UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# how they are meant to run; a value the submitter set stands
_TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # merge shuffle partitions up to the advisory size, not just until every core has one
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # shuffled bytes are compressed and open to ten times their size in a task's sorts and hash tables;
    # also the target size of what a rebalanced write puts into one file
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a scan task combines its rows before they are shuffled and sorts those it writes, all in memory while it lasts
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # the feed's keys are kept on disk, not on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# of the scanned columnar files, which shuffles of nested rows exceed several times
SHUFFLE_PARTITION_BYTES = 4 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# what the planner puts for an input whose size it cannot tell
UNKNOWN_BYTES = (1 << 63) - 1


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing (cores, memory) is left to the submitter."""
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    for key, value in _TUNING.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def size_shuffles(*inputs: DataFrame) -> int:
    """From now on, shuffles start with enough partitions for all the inputs; adaptive execution merges small ones.

    Only ever raises the count the submitter set. Sizes are those of the tables scanned, after partition
    pruning; estimates of joins multiply and say nothing.
    """
    spark = inputs[0].sparkSession
    wanted = sum(_scanned_bytes(df) for df in inputs) // SHUFFLE_PARTITION_BYTES
    current = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set(_INITIAL, wanted)
    return max(wanted, current)


@contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[int]:
    """``size_shuffles`` within; the count is put back at the end."""
    spark = inputs[0].sparkSession
    before = spark.conf.get(_INITIAL, None)
    try:
        yield size_shuffles(*inputs)
    finally:
        if before is None:
            spark.conf.unset(_INITIAL)
        else:
            spark.conf.set(_INITIAL, before)


def _scanned_bytes(df: DataFrame) -> int:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def shared_root(spark: SparkSession) -> str | None:
    """A fresh folder for intermediate tables, under the checkpoint folder the session names.

    Returns None on a cluster that names none: nothing may then be written, because a
    machine-local folder would be invisible to the other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            return None
        base = _local_base()
    return f"{base.rstrip('/')}/trailweave-{uuid.uuid4().hex}"


def _local_base() -> str:
    if "TRAILWEAVE_LOCAL_DIR" not in os.environ:
        os.environ["TRAILWEAVE_LOCAL_DIR"] = tempfile.mkdtemp(prefix="trailweave-")
    return os.environ["TRAILWEAVE_LOCAL_DIR"]
