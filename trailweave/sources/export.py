"""Shard scans and the merge of the final daily shards with the provisional intraday ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import RAW_EVENT


def read_shards(spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
    """Raw events under ``root``, one ``shard_date=yyyyMMdd`` folder per day.

    ``since`` prunes whole shards. Daily and intraday shards live under separate roots, so
    neither scan can pick up the other family.
    """
    shards = spark.read.schema(RAW_EVENT).option("mergeSchema", "false").parquet(root)
    return shards if since is None else shards.where(F.col("shard_date") >= since)


def shard_dates(shards: DataFrame) -> DataFrame:
    """The dates that hold rows. Only the partition column is read: one row per day comes out."""
    return shards.select("shard_date").distinct()


def uncovered_intraday(daily: DataFrame, intraday: DataFrame) -> DataFrame:
    """Intraday rows of dates whose daily shard has not landed.

    The dates to keep are worked out first and then prune the intraday scan, so covered
    shards are not read. Both date lists are bounded by the calendar, one row per day of
    export, which is what makes them safe to broadcast.
    """
    missing = (
        shard_dates(intraday)
        .join(F.broadcast(shard_dates(daily)), "shard_date", "left_anti")
    )
    return intraday.join(F.broadcast(missing), "shard_date", "left_semi")
