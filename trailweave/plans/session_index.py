"""Index of stored sessions, so that a run finds those its events belong to without reading history.

One slim row per session, partitioned by the month it starts in and the bucket of its reference, and
bucketed on the reference: user and session id in one text. A lookup reads the buckets that the
run's own sessions fall into, whatever their month, and joins them bucket to bucket; stored rows
are neither shuffled nor broadcast. Bucketing on user and session together also spreads a user who
holds a third of all sessions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..operators.versions import VersionedTable, bucket_of, from_value, touched

REF = "session_ref"
FLAGS = ("is_bounced_flag", "is_bounced_3cond")


def session_ref() -> Column:
    """User and session id as one text; a missing user differs from any named one, a missing id gives null."""
    user = F.coalesce(F.concat(F.lit("u"), "user_pseudo_id"), F.lit("-"))
    return F.concat(user, F.lit(":"), F.col("ga_session_id").cast("string"))


class SessionIndex:
    """``session_ref``, ``session_date`` and the bounce flags of every stored session."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, keep: int = 3):
        self.buckets = buckets
        self.table = VersionedTable(
            spark, path, ("session_month", "bucket"), bucket_by=REF, buckets=buckets, keep=keep
        )

    def refresh(self, sessions: DataFrame, boundary: date | None = None, **notes: int) -> None:
        """Index the stored ``sessions`` anew from the month of ``boundary`` on; all of them without one."""
        start = boundary.replace(day=1) if boundary else None
        rows = sessions if start is None else sessions.where(F.col("session_date") >= F.lit(start))
        rows = rows.select(
            session_ref().alias(REF), "session_date", *FLAGS, month_start(F.col("session_date")).alias("session_month")
        ).withColumn("bucket", bucket_of(REF, self.buckets))
        replaced = from_value("session_month", start.isoformat()) if start else lambda partition: True
        self.table.commit(rows, replaced, **notes)

    def follow(self, sessions: VersionedTable, boundary: date | None = None) -> None:
        """Bring the index to the newest version of the session table, of which ``boundary`` on is known to be new.

        The index remembers the version that it follows. Where a run died between the two commits,
        the days that differ since are indexed as well.
        """
        now, own = sessions.version(), self.table.version()
        if own is None or boundary is None:
            self.refresh(sessions.read(), follows=now.number)
            return
        if own.notes["follows"] == now.number:
            return
        followed = sessions.find(own.notes["follows"])
        if followed is None:
            self.refresh(sessions.read(), follows=now.number)
            return
        changed = dict(followed.partitions.items() ^ now.partitions.items())
        days = [day for name in changed if (day := name.partition("=")[2])[:1].isdigit()]
        self.refresh(sessions.read(), min([boundary, *map(date.fromisoformat, days)]), follows=now.number)

    def near(self, seen: DataFrame) -> DataFrame | None:
        """Stored sessions of the buckets that the references of ``seen`` fall into; None without an index."""
        stored = self.table.bucketed()
        if stored is None:
            return None
        return stored.where(F.col("bucket").isin(list(touched(seen, REF, self.buckets)) or [-1]))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` put into the index's buckets: the side of a join that moves."""
        return rows.repartition(self.buckets, REF)

    def unknown(self, fresh: DataFrame, before: date, seen: DataFrame) -> DataFrame:
        """Sessions of ``fresh`` that are not stored with a start before the date, however long ago.

        ``seen`` holds the references among which those of ``fresh`` are; it need not be reduced.
        """
        stored = self.near(seen)
        if stored is None:
            return fresh
        earlier = stored.where(F.col("session_date") < F.lit(before)).select(REF)
        return self._dealt(fresh.withColumn(REF, session_ref())).join(earlier.hint("merge"), REF, "left_anti").drop(REF)

    def with_flags(self, rows: DataFrame, seen: DataFrame) -> DataFrame:
        """``rows``, which have a reference, with the bounce flags of their stored sessions; partitioned on the reference."""
        stored = self.near(seen)
        if stored is None:
            return rows.withColumns({c: F.lit(None).cast("int") for c in FLAGS})
        return self._dealt(rows).join(stored.select(REF, *FLAGS).hint("merge"), REF, "left")
