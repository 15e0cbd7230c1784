"""Near-real-time staging of intraday shards."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import append_new_keys
from ..operators.versions import VersionedTable
from ..plans.staging import typed_events
from ..sources.schema import PHYSICAL_KEY, RAW_EVENT

_RAW_KEYS = tuple(c for c in PHYSICAL_KEY if c not in ("user_pseudo_id", "event_name", "event_timestamp"))
_KEY = ("user_pseudo_id", "event_name", "event_timestamp", *(f"raw_{c}" for c in _RAW_KEYS))
#: Portions of a day that lie side by side; with the next one they become one.
MAX_PORTIONS = 16
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_intraday_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_EVENT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)


def feed_table(spark: SparkSession, out: str) -> VersionedTable:
    return VersionedTable(spark, out, ("event_date", "portion"))


def read_feed(spark: SparkSession, out: str) -> DataFrame | None:
    """The feed as of its last committed batch; None before the first."""
    found = feed_table(spark, out).read()
    return None if found is None else found.drop("portion")


def _day_of(partition: str) -> str:
    return partition.split("/")[0].removeprefix("event_date=")


def stage_batch(batch: DataFrame, out: str) -> None:
    """Add the batch's events that the feed does not hold yet, as one more portion of each of their days.

    Replays are looked for among the stored keys of the batch's own days, however old those are,
    so the feed is the same in whatever order and portions the shards arrive, and a batch that
    runs again after a failure adds nothing twice. Nothing but those days is listed or read. A day
    that has MAX_PORTIONS of them gets them merged with the new one, in the same commit, so what
    there is to list grows with the days and not with the batches.
    """
    spark = batch.sparkSession
    rows = typed_events(batch, *_RAW_KEYS).dropDuplicates([*_KEY]).withColumn("shard_type", F.lit("intraday"))
    # one entry per calendar day of the batch
    found = batch.select(F.to_date("event_date", "yyyyMMdd").alias("day")).distinct().collect()
    days = {r.day.isoformat() if r.day else _NO_DAY for r in found}
    if not days:
        return
    table = feed_table(spark, out)
    now = table.version()
    portion = now.number + 1 if now else 1
    portions = Counter(_day_of(p) for p in (now.partitions if now else ()))
    full = {day for day in days if portions[day] >= MAX_PORTIONS}
    stored = table.read(lambda partition: _day_of(partition) in days)
    if stored is not None:
        rows = append_new_keys(rows, stored, _KEY)
    rows = rows.withColumn("portion", F.lit(portion))
    if full:
        merged = table.read(lambda partition: _day_of(partition) in full)
        rows = rows.unionByName(merged.withColumn("portion", F.lit(portion)))
    table.commit(rows, lambda partition: _day_of(partition) in full, rebalance=bool(full))


def start_intraday_feed(
    raw: DataFrame, out: str, checkpoint: str, available_now: bool = False, interval: str = "5 minutes"
) -> StreamingQuery:
    """Keep the feed under ``out`` up to the shards: every physical event once; read_feed() reads it.

    The feed is provisional: the batch run replaces a date once its daily shard lands.
    """
    writer = raw.writeStream.foreachBatch(lambda batch, _: stage_batch(batch, out)).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
