"""The daily run: builds every model in dependency order and commits it.

Staged events, sessions and first visits are written tables that the marts read back. They
are what each mart scans, partition-pruned and column-pruned, and they cut lineage: a lost
executor costs a re-read of those files, never a rebuild from the raw export. Every partitioned
table is committed as a version, so readers see a run's window as a whole or not at all.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators.incremental import latest_snapshot, write_snapshot
from ..operators.versions import VersionedTable, from_value
from ..session import sized_shuffles
from ..sources.export import read_shards
from . import depth, first_visit, monthly, monthly_base, pages, product, sessions, staging, weekly
from .session_index import SessionIndex


@dataclass(frozen=True)
class Mart:
    """How a report is built and stored. A mart without a partition is rebuilt whole."""

    build: Callable[..., DataFrame]
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    boundary: Callable[[EngineConfig], date] | None = None
    needs_first_visits: bool = False
    #: Rolled up from the monthly base instead of staged events.
    from_base: bool = False


_week: Callable[[EngineConfig], date] = lambda cfg: cfg.week_boundary
_month: Callable[[EngineConfig], date] = lambda cfg: cfg.month_boundary

MARTS: dict[str, Mart] = {
    "weekly_performance": Mart(
        weekly.weekly_performance, "week_start_date", boundary=_week, needs_first_visits=True
    ),
    "channel_performance": Mart(monthly.channel_performance, "month", ("marketing_channel",), _month, from_base=True),
    "device_performance": Mart(monthly.device_performance, "month", ("device_class",), _month, from_base=True),
    "city_performance": Mart(monthly.city_performance, "month", ("city_display",), _month, from_base=True),
    "product_performance": Mart(
        product.product_performance, "period_start_date", ("product_category",), EngineConfig.product_boundary
    ),
    "plp_views_weekly": Mart(pages.plp_views_weekly, cluster=("plp_page",)),
    "custom_page_views_weekly": Mart(pages.custom_page_views_weekly, cluster=("page_name",)),
    "city_browsing_depth_weekly": Mart(
        depth.city_browsing_depth_weekly, "week_start_date", ("city",), _week
    ),
    "funnel_users": Mart(monthly.funnel_users, "month", ("device_class",), _month, from_base=True),
    "funnel_events": Mart(monthly.funnel_events, "month", ("device_class",), _month, from_base=True),
}


class Warehouse:
    """The tables of one deployment, under ``root``."""

    STAGED, SESSIONS, FIRST_VISITS = "staged_events", "sessions", "first_visits"
    _LAYOUT = {
        STAGED: ("event_date", ("event_name", "user_pseudo_id")),
        SESSIONS: ("session_date", ("device_class", "channel_group")),
        FIRST_VISITS: ("bucket", ("user_pseudo_id",)),
        **{name: ("month", cluster) for name, (_, cluster) in monthly_base.TABLES.items()},
    }

    def __init__(self, spark: SparkSession, cfg: EngineConfig, root: str):
        self.spark, self.cfg, self.root = spark, cfg, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> VersionedTable:
        partition, cluster = self._LAYOUT.get(name) or (MARTS[name].partition, MARTS[name].cluster)
        return VersionedTable(self.spark, self.path(name), (partition,), cluster, keep=self.cfg.keep_snapshots)

    @property
    def session_index(self) -> SessionIndex:
        return SessionIndex(self.spark, self.path("session_index"), self.cfg.session_buckets, self.cfg.keep_snapshots)

    # -- readers

    def _stored(self, name: str) -> DataFrame:
        found = self.table(name).read()
        if found is None:
            raise FileNotFoundError(f"no {name} under {self.root}; run a full refresh first")
        return found

    def staged(self) -> DataFrame:
        return self._stored(self.STAGED)

    def sessions(self) -> DataFrame:
        return self._stored(self.SESSIONS)

    def first_visits(self) -> DataFrame:
        return self._stored(self.FIRST_VISITS).drop("bucket")

    def monthly_base(self) -> monthly_base.BaseSource | None:
        """The combined events of the monthly marts; None in a warehouse whose last run did not build them."""
        tables = [self.table(name) for name in monthly_base.TABLES]
        versions, now = [t.version() for t in tables], self.table(self.STAGED).version()
        if any(v is None or v.notes["follows"] != now.number for v in versions):
            return None
        return monthly_base.BaseSource(*[t.read() for t in tables])

    def mart(self, name: str) -> DataFrame:
        return latest_snapshot(self.spark, self.path(name)) if MARTS[name].partition is None else self._stored(name)

    def build_mart(self, name: str, incremental: bool = False, **options) -> DataFrame:
        """A mart computed from the silver tables, not yet written."""
        mart = MARTS[name]
        inputs = [self.staged(), self.sessions()]
        if mart.needs_first_visits:
            inputs.append(self.first_visits())
        if mart.partition is not None:
            options["incremental"] = incremental
        if incremental and name == "product_performance":
            options["index"] = self.session_index
        if mart.from_base:
            options["base"] = self.monthly_base()
        return mart.build(*inputs, self.cfg, **options)

    # -- writers

    def refresh(self, daily_root: str, intraday_root: str, incremental: bool = False) -> None:
        """One run over everything: silver tables first, then the marts."""
        self.refresh_silver(
            read_shards(self.spark, daily_root), read_shards(self.spark, intraday_root), incremental
        )
        for name in MARTS:
            self.refresh_mart(name, incremental)

    def refresh_silver(self, daily: DataFrame, intraday: DataFrame, incremental: bool = False) -> None:
        recent = F.col("shard_date") >= self.cfg.lookback_suffix
        read = [df.where(recent) if incremental else df for df in (daily, intraday)]
        with sized_shuffles(*read):
            self._refresh_silver(daily, intraday, incremental)

    def _refresh_silver(self, daily: DataFrame, intraday: DataFrame, incremental: bool) -> None:
        if incremental and self.table(self.SESSIONS).version() is None:
            raise FileNotFoundError(f"no {self.SESSIONS} under {self.root}; run a full refresh first")
        cfg, boundary = self.cfg, self.cfg.lookback_date if incremental else None
        # a full build leaves the rows in their scan tasks, each of which reads one date
        staged = staging.staged_events(daily, intraday, cfg, incremental)
        self._commit(self.STAGED, staged, boundary, rebalance=incremental)
        index = self.session_index
        if incremental:
            # of a run that died before its end
            index.follow(self.table(self.SESSIONS), boundary)
        built = sessions.sessions(self.staged(), cfg, incremental, index=index if incremental else None)
        self._commit(self.SESSIONS, built, boundary)
        index.follow(self.table(self.SESSIONS), boundary)
        firsts = first_visit.first_visits(self.staged(), cfg, incremental)
        first_visit.commit_first_visits(self.table(self.FIRST_VISITS), firsts, cfg, incremental)
        for name, (build, _) in monthly_base.TABLES.items():
            monthly_base.follow(self.table(name), build, self.table(self.STAGED))

    def refresh_mart(self, name: str, incremental: bool = False) -> None:
        with sized_shuffles(self.staged(), self.sessions()):
            self._refresh_mart(name, incremental)

    def _refresh_mart(self, name: str, incremental: bool) -> None:
        mart = MARTS[name]
        if mart.partition is None:
            write_snapshot(self.build_mart(name), self.path(name), self._version(), mart.cluster, self.cfg.keep_snapshots)
            return
        options, boundary = {}, mart.boundary(self.cfg) if incremental else None
        if incremental and name == "product_performance":
            # reach back to the first month that has no closed row yet
            closed = self._last_closed_month()
            boundary = self.cfg.product_boundary(closed)
            options["last_closed_month"] = closed
        self._commit(name, self.build_mart(name, incremental, **options), boundary)

    def _last_closed_month(self) -> date | None:
        months = self.mart("product_performance").where(F.col("period_type") == "month")
        return months.agg(F.max("period_start_date")).first()[0]

    def _commit(self, name: str, df: DataFrame, boundary: date | None, rebalance: bool = True) -> None:
        table = self.table(name)
        if boundary is None:
            table.commit(df, rebalance=rebalance)
        else:
            table.commit(df, from_value(table.partition[0], boundary.isoformat()), rebalance)

    def _version(self) -> str:
        return f"{self.cfg.as_of_date:%Y%m%d}-{time.time_ns()}"

