"""One deployment of the engine per session and data folder, shared by the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from trailweave import configure
from trailweave.config import EngineConfig
from trailweave.plans import first_visit, sessions, staging
from trailweave.plans.pipeline import MARTS, Warehouse
from trailweave.session import shared_root, size_shuffles
from trailweave.sources import adapter
from trailweave.sources.export import read_shards, uncovered_intraday
from trailweave.sources.schema import PHYSICAL_KEY

_deployments: dict[tuple[str, str], Deployment] = {}


class Deployment:
    """Raw shards and silver tables derived from the driver's tables.

    Each is written once to the shared folder, on first use, and read back by every query.
    Without a shared folder the same plans are built lazily, end to end.
    """

    cfg: EngineConfig = adapter.DEMO

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self.root = shared_root(spark)
        self._committed: set[str] = set()
        # for the queries too, which run after they are returned
        size_shuffles(*[self.spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "lineitem")])

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Deployment:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _deployments:
            _deployments[key] = cls(spark, sf_dir)
        return _deployments[key]

    @cached_property
    def raw(self) -> DataFrame:
        return adapter.raw_events(self.spark, self.sf_dir)

    @cached_property
    def _export(self) -> str | None:
        if self.root is None:
            return None
        adapter.write_export(adapter.flat_events(self.spark, self.sf_dir), f"{self.root}/raw")
        return f"{self.root}/raw"

    def _shards(self, family: str) -> DataFrame:
        if self._export is None:
            return adapter.family_rows(self.raw, family)
        return read_shards(self.spark, adapter.family_path(self._export, family))

    @cached_property
    def daily(self) -> DataFrame:
        return self._shards("daily")

    @cached_property
    def intraday(self) -> DataFrame:
        return self._shards("intraday")

    @cached_property
    def events(self) -> DataFrame:
        """Every raw event once: daily shards, and intraday ones of dates without a daily shard."""
        return self.daily.unionByName(uncovered_intraday(self.daily, self.intraday).dropDuplicates([*PHYSICAL_KEY]))

    @property
    def intraday_path(self) -> str:
        if self._export is None:
            raise RuntimeError("the stream needs a shared folder; set spark.checkpoint.dir")
        return adapter.family_path(self._export, "intraday")

    @cached_property
    def warehouse(self) -> Warehouse | None:
        if self.root is None:
            return None
        tables = Warehouse(self.spark, self.cfg, f"{self.root}/tables")
        tables.refresh_silver(self.daily, self.intraday)
        return tables

    @cached_property
    def staged(self) -> DataFrame:
        if self.warehouse:
            return self.warehouse.staged()
        return staging.staged_events(self.daily, self.intraday, self.cfg)

    @cached_property
    def sessions(self) -> DataFrame:
        return self.warehouse.sessions() if self.warehouse else sessions.sessions(self.staged, self.cfg)

    @cached_property
    def first_visits(self) -> DataFrame:
        if self.warehouse:
            return self.warehouse.first_visits()
        return first_visit.first_visits(self.staged, self.cfg)

    def mart(self, name: str, **options) -> DataFrame:
        mart = MARTS[name]
        extra = [self.first_visits] if mart.needs_first_visits else []
        if name == "product_performance" and options.get("incremental") and self.warehouse:
            options["index"] = self.warehouse.session_index
        return mart.build(self.staged, self.sessions, *extra, self.cfg, **options)

    def stored_mart(self, name: str) -> DataFrame:
        """The committed mart, built on first use."""
        if self.warehouse is None:
            return self.mart(name)
        if name not in self._committed:
            self.warehouse.refresh_mart(name)
            self._committed.add(name)
        return self.warehouse.mart(name)
