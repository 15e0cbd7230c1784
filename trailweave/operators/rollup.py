"""Roll-ups with a total row, at an optional finer grain that distinct counts build on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IS_TOTAL = "is_total"


def total_rollup(
    df: DataFrame,
    period: Sequence[str],
    dims: Sequence[str],
    *aggs: Column,
    grain: Sequence[str] = (),
    label: str = "Total",
    merge: Callable[[str], Column] = F.sum,
) -> DataFrame:
    """GROUPING SETS ((period, dims, grain), (period, grain)); total rows carry ``label`` as dims.

    The rows are first combined per period, dims and grain, and only those few are copied for the
    total; ``merge`` lifts each aggregate one level up, so aggregates must be of a kind that its
    own parts add up to: sums, counts, or maxima with ``merge=F.max``.

    ``is_total`` stays in the result as a key. With a ``grain`` such as the user, the result
    is small enough to count distinct grain values as plain rows afterwards. That replaces
    several COUNT(DISTINCT) over the source, for each of which Spark would copy every input
    row once more before the shuffle.
    """
    fixed = [*period, *grain]
    keys = [*fixed, *dims]
    combined = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    lifted = [merge(c).alias(c) for c in combined.columns if c not in keys]
    rolled = combined.groupingSets([keys, fixed], *fixed, *dims).agg(
        F.grouping(dims[0]).cast("int").alias(IS_TOTAL), *lifted
    )
    return _labelled(rolled, dims, label)


def with_totals(df: DataFrame, dims: Sequence[str], label: str) -> DataFrame:
    """Each row twice, once for its own group and once for the total.

    The same as the grouping sets above, for input that is already partitioned on the keys
    of the next aggregate: exploding keeps that partitioning, grouping sets give it up.
    """
    doubled = df.withColumn(IS_TOTAL, F.explode(F.array(F.lit(0), F.lit(1))))
    return _labelled(doubled, dims, label)


def _labelled(df: DataFrame, dims: Sequence[str], label: str) -> DataFrame:
    return df.withColumns(
        {d: F.when(F.col(IS_TOTAL) == 1, F.lit(label)).otherwise(F.col(d)) for d in dims}
    )


def row_sort() -> Column:
    """0 pins the total row above the others."""
    return F.when(F.col(IS_TOTAL) == 1, F.lit(0)).otherwise(F.lit(1)).alias("row_sort")
