"""The intraday feed over many batches: what it lists, merges and recognises."""

import pytest
from helpers import raw_event
from pyspark.sql import functions as F
from test_models import at, frame

from trailweave.operators.versions import VersionedTable
from trailweave.streaming import intraday


def event(day, k, **extra):
    return raw_event(f"202402{day:02d}", "page_view", micros=at(day) + k, index=k, **extra)


def kept(spark, out):
    rows = intraday.read_feed(spark, out).select("event_date", "raw_batch_event_index").collect()
    return sorted((str(r[0]), r[1]) for r in rows)


def test_folders_grow_with_the_days_not_with_the_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(intraday, "MAX_PORTIONS", 3)
    out, seen, most = str(tmp_path / "feed"), set(), 0
    assert intraday.read_feed(spark, out) is None
    for n in range(24):
        # each batch has a new event of one of two days, and one that an earlier batch had
        batch = [event(5 + n % 2, n), *([event(5 + (n // 2) % 2, n // 2)] if n else [])]
        intraday.stage_batch(frame(spark, batch).coalesce(1), out)
        seen.add((f"2024-02-{5 + n % 2:02d}", n))
        now = intraday.feed_table(spark, out).version()
        most = max(most, len(now.partitions))
    assert most <= 2 * 3 and kept(spark, out) == sorted(seen)
    # files of versions that are gone are gone, too
    held = [p for p in (tmp_path / "feed" / "data").glob("commit=*/*/*") if any(p.glob("*.parquet"))]
    assert len(held) <= 3 * 2 * 3


def test_a_batch_lists_its_own_days_only(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "feed")
    for day in range(1, 8):
        intraday.stage_batch(frame(spark, [event(day, 0)]), out)
    listed, folder = [], VersionedTable.folder
    monkeypatch.setattr(VersionedTable, "folder", lambda self, p, c: listed.append(p) or folder(self, p, c))
    intraday.stage_batch(frame(spark, [event(3, 0), event(3, 1)]), out)
    assert {p.split("/")[0] for p in listed} == {"event_date=2024-02-03"}
    assert kept(spark, out) == sorted([(f"2024-02-{d:02d}", 0) for d in range(1, 8)] + [("2024-02-03", 1)])


def test_replays_without_a_day_are_recognised(spark, tmp_path):
    out = str(tmp_path / "feed")
    lost = event(5, 1) | {"event_date": None}
    for _ in range(2):
        intraday.stage_batch(frame(spark, [dict(lost), event(5, 2)]), out)
    assert intraday.read_feed(spark, out).where(F.col("event_date").isNull()).count() == 1
    assert intraday.read_feed(spark, out).count() == 2


def test_a_batch_that_died_adds_nothing_twice(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "feed")
    intraday.stage_batch(frame(spark, [event(5, 0)]), out)
    for step in ("_publish", "_remove_old"):
        with monkeypatch.context() as patched:
            patched.setattr(VersionedTable, step, lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                intraday.stage_batch(frame(spark, [event(5, 1), event(5, 0)]), out)
        assert ("2024-02-05", 0) in kept(spark, out)
    intraday.stage_batch(frame(spark, [event(5, 1), event(5, 0)]), out)
    assert kept(spark, out) == [("2024-02-05", 0), ("2024-02-05", 1)]
