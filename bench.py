"""Times every model, full and incremental, and prints one JSON line.

Each model reads the tables it reads in production (staging the raw shards, sessions the
staged table, marts the silver tables) and writes to the noop sink: one warm-up, then the
median of three runs. ``export`` is the derivation of the raw shards from the driver's
tables, ``silver`` the committed build of all three silver tables and ``marts`` that of all
marts, with rebalance, sort and commit; these run once and count in the sum. ``plans`` has,
for each model, the bytes its last run shuffled and the Expand operators in its plan.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from parity.deployment import Deployment
from parity.queries import QUERIES
from trailweave import configure
from trailweave.plans import first_visit, sessions, staging
from trailweave.plans.pipeline import MARTS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
CHECKS = [name for name in QUERIES if name.startswith("dq_")]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def median_time(build) -> float:
    drain(build())
    return statistics.median(timed(lambda: drain(build())) for _ in range(RUNS))


def plan_figures(spark: SparkSession, build) -> dict[str, int]:
    """Bytes shuffled by one run, from the status store, and Expand operators of the plan."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written() -> int:
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = written()
    df = build()
    drain(df)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return {"shuffle_bytes": written() - before, "expands": df._jdf.queryExecution().executedPlan().toString().count("Expand [")}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("trailweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        # shuffle bytes are read from the stages' records
        .config("spark.ui.retainedStages", "1000000")
        # the tables are small: partitions small enough that every core has one
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        # static; collecting call sites about doubles the time plan building takes
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    d = Deployment(spark, SF_DIR)

    once = {"export": timed(lambda: d.daily), "silver": timed(lambda: d.warehouse)}
    once["marts"] = timed(lambda: [d.stored_mart(name) for name in MARTS])
    builders = {}
    for suffix, incremental in (("", False), ("_inc", True)):
        builders["stg_events" + suffix] = lambda i=incremental: staging.staged_events(d.daily, d.intraday, d.cfg, i)
        builders["int_sessions" + suffix] = lambda i=incremental: sessions.sessions(
            d.staged, d.cfg, i, index=d.warehouse.session_index if i else None
        )
        builders["int_first_visit" + suffix] = lambda i=incremental: first_visit.first_visits(d.staged, d.cfg, i)
        for name, mart in MARTS.items():
            if mart.partition is None:
                if not incremental:
                    builders[name] = lambda n=name: d.mart(n)
            else:
                builders[name + suffix] = lambda n=name, i=incremental: d.mart(n, incremental=i)
    for name in CHECKS:
        builders[name] = lambda n=name: QUERIES[n](d)

    medians = {name: median_time(build) for name, build in builders.items()}
    plans = {name: plan_figures(spark, build) for name, build in builders.items() if not name.startswith("dq_")}
    queries = {name: round(seconds, 3) for name, seconds in {**once, **medians}.items()}
    result = {
        "metric": "sum of export, silver tables, marts and median model times",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf") or 0),
        "cpus": int(CPUS),
        "plans": plans,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
