"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and their
place becomes their integer name; adjacent names are then paired and the distinct pairs sorted
and named in turn, until one name is left for each text. A name stands for one block or pair
only, so texts of equal length are equal exactly when their last names are: nothing rests on a
hash being free of collisions.

Texts cross the network once, as blocks that are combined within each task first, so copies
cost next to nothing. Occurrences find their block's name by its hash where that hash belongs
to a single distinct block, which is checked; otherwise by the block itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, keep_one, lower_ascii, write_table

BLOCK_BYTES = 4096
#: Right half of a pair that has none; names are never negative.
NO_NAME = -1
#: monotonically_increasing_id() holds the partition above these bits.
PART_BITS = 33


def _blocks(text: Column, block_bytes: int) -> Column:
    raw = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / block_bytes).cast("int"), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * block_bytes + 1, F.lit(block_bytes))
    )


def _named(parts: DataFrame, *keys: str) -> DataFrame:
    """Distinct `parts` with their place in sorted order as `name`.

    The sort also makes the names the same when a lost task runs again.
    """
    return (
        parts.groupBy(*keys).agg(F.lit(0).alias("name"))
        .sortWithinPartitions(*keys)
        .withColumn("name", F.monotonically_increasing_id())
    )


def identities(
    docs: DataFrame,
    text: Column,
    carry: dict[str, Column],
    block_bytes: int = BLOCK_BYTES,
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of `docs`: the `carry` columns, row (unique), n_bytes and name.

    Two rows have equal `text` exactly if their (n_bytes, name) are equal. Null text is empty.
    """
    text = F.coalesce(text, F.lit(""))
    cut = docs.select(F.explode(_blocks(text, block_bytes)).alias("block"))
    names = _named(cut, "block")
    by_hash = write_table(names.select(hash_of(F.col("block")).alias("key"), "name"), "blocks")
    if not by_hash.groupBy("key").count().where("count > 1").isEmpty():
        by_hash = write_table(names.withColumnRenamed("block", "key"), "blocks")
        hash_of = lambda block: block
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), text.alias("text"), *[c.alias(n) for n, c in carry.items()]
    )
    level = write_table(
        rows.select(
            "row", F.octet_length("text").alias("n_bytes"), *carry,
            F.posexplode(F.transform(_blocks(F.col("text"), block_bytes), lambda block: hash_of(block))).alias("pos", "key"),
        ).join(by_hash, "key").drop("key"),
        "level",
    )

    width = F.greatest(F.ceil(F.col("n_bytes") / block_bytes), F.lit(1))
    heads = level.where("pos = 0").drop("pos")
    finished = [heads.where(width == 1)]
    heads = heads.drop("name")
    level = level.where(width > 1).select("row", "pos", width.alias("width"), "name")
    widest = level.agg(F.max("width")).first()[0] or 1
    while widest > 1:
        half = (F.col("pos") / 2).cast("int")
        pairs = level.groupBy("row", "width", half.alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_NAME)).alias("right"),
        )
        halved = F.ceil(F.col("width") / 2)
        level = write_table(
            pairs.join(_named(pairs, "left", "right"), ["left", "right"])
            .select("row", "pos", halved.alias("width"), "name"),
            "level",
        )
        finished.append(heads.join(level.where("width = 1").select("row", "name"), "row"))
        level = level.where("width > 1")
        widest = -(-widest // 2)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts
    the row with the largest doc_id stays (null doc_ids are smallest; of rows with the same
    doc_id one stays). An empty table gives no rows; other columns of `docs` are not read.
    """
    text = lower_ascii(F.col("text"))
    named = identities(docs, text, {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(text, 256)}, block_bytes)
    # a group meets in runs, its rows from one partition of the input, and never as a whole
    named = named.withColumn("part", F.shiftright("row", PART_BITS))
    keep, size = F.max(F.struct("doc_id", "row")), F.count("*")
    runs = write_table(
        named.groupBy("n_bytes", "name", "part").agg(keep.alias("keep"), size.alias("group_size")), "runs"
    )
    groups = runs.groupBy("n_bytes", "name").agg(F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
    found = runs.select("n_bytes", "name", "part").join(groups, ["n_bytes", "name"])
    return named.join(found, ["n_bytes", "name", "part"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256", "row",
    )


def drop_exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` without its exact copies, columns unchanged: one row of each text stays, as above."""
    digest = fresh("digest")
    kept = exact_duplicates(docs, block_bytes).where("kept").withColumnRenamed("text_sha256", digest)
    return keep_one(docs.withColumn(digest, F.sha2(lower_ascii(F.col("text")), 256)), kept, digest).drop(digest)
