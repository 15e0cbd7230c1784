"""Helpers that the operators share: text normalisation, row keys, written intermediate tables."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailweave.session import shared_root

#: One word, in Java, Python and DuckDB regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
#: All white space that separates words, for trim().
BLANKS = " \t\n\x0b\x0c\r"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, so that a lost executor never recomputes it.

    The folder is the one that spark.checkpoint.dir names (local sessions without it get one of
    their own). Written values are final: names or ids made by a job cannot change later.
    """
    spark = df.sparkSession
    root = shared_root(spark)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a table that is sent to every executor, at most; joins with larger ones shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def sent_if_small(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`table`, a written one of a few short columns, to be broadcast if it has `max_rows` at most."""
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """Adds `name`: the row's place (from 0) in the whole table's order, without one task sorting it all.

    Rows are range-partitioned, numbered within their partition and shifted by the rows of the
    partitions before; the offsets are one row a partition.
    """
    part, row = fresh("part"), fresh("row")
    ranged = write_table(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "ranged",
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(part).agg(F.count("*").alias(name)).select(
        part, F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name)
    )
    return ranged.join(F.broadcast(offsets), part).withColumn(name, F.col(name) + F.col(row)).drop(part, row)


def keep_one(docs: DataFrame, marks: DataFrame, *digests: str) -> DataFrame:
    """Rows of `docs` whose (doc_id, *digests) is in `marks`; of rows that agree in all of them one.

    A null doc_id equals a null one. The rows meet by doc_id, so a group of copies is not gathered.
    """
    known, null = fresh("known"), fresh("null")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({known: F.coalesce("doc_id", F.lit(0)), null: F.col("doc_id").isNull()})

    on = [known, null, *digests]
    return keyed(docs).join(keyed(marks).select(*on), on, "left_semi").dropDuplicates(on).drop(known, null)
