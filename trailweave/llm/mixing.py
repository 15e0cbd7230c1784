"""Mixing of sources to target weights by pivotal dependent rounding.

Each document of a source is to be copied target / source size times. The whole part is certain;
the fractional parts of two documents at a time then exchange mass (words), one of them at random
gaining what the other loses, until one of the two is integral. Expected copies stay as they
were, and a source's words change by no more than one document's, because only the last
document without a partner is rounded by itself.

The exchange runs as a reduction tree: bounded groups of a source's documents are folded, each
leaves one document that is still fractional, and these are folded in turn. Groups are dealt by
hash, so a source that holds most of the rows is as many groups as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, numbered, word_count, write_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
#: Mean documents of a group in the reduction tree.
GROUP = 64
SEED = 7


def source_targets(sizes: DataFrame, share: float = SHARE, max_copies: float = MAX_COPIES) -> DataFrame:
    """`sizes` (source, source_size, ...) with `target`, the words that the mix takes of the source.

    Sources by code point, null last, weigh WEIGHTS in turn. They share `share` of all sizes by
    weight; no target exceeds max_copies * source_size, and what is cut off goes to the others by
    weight. Without any words all targets are zero.
    """
    ordered = numbered(sizes, F.col("source").asc_nulls_last(), name="place")
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    table = write_table(ordered.withColumn("weight", weights[(F.col("place") % len(WEIGHTS)).cast("int")]), "sources")
    most = F.col("source_size") * float(max_copies)
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = min(share, max_copies) * (total or 0)
    level = wanted / weight if wanted else 0.0  # words per unit of weight; only ever rises
    while wanted:
        full = F.col("weight") * level > most
        cut, free = table.agg(
            F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not free or (wanted - cut) / free <= level:
            break
        level = (wanted - cut) / free
    return table.withColumn("target", F.least(most, F.col("weight") * F.lit(level))).drop("weight", "place")


def _chance(*columns: Column) -> Column:
    """A number in [0, 1) that the columns determine."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *columns), 11)).cast("double") * (2.0**-53)


def _unit(row: Column, mass: Column) -> Column:
    kept = [row[c].alias(c) for c in ("doc_id", "size", "count", "base", "draw")]
    return F.struct(*kept, mass.alias("mass"))


def _settled(row: Column, up: Column) -> Column:
    return F.struct(*[row[c].alias(c) for c in ("doc_id", "size", "count", "base")], up.cast("long").alias("up"))


def _fold(units: Column, kind: str, done: str) -> Column:
    """(left, out): the one document of `units` that is still fractional, and the settled others."""
    start = F.struct(F.lit(None).cast(kind).alias("left"), F.array().cast(f"array<{done}>").alias("out"))

    def exchange(state: Column, new: Column) -> Column:
        old, out = state["left"], state["out"]
        room_old, room_new = old["size"] - old["mass"], new["size"] - new["mass"]
        up, down = F.least(room_old, new["mass"]), F.least(old["mass"], room_new)  # what old may gain or lose
        rises = _chance(old["draw"], new["draw"]) * (up + down) < down

        def step(gain: Column, old_ends: Column, old_up: Column, new_up: Column) -> Column:
            settled = F.when(old_ends, _settled(old, old_up)).otherwise(_settled(new, new_up))
            mass = F.when(old_ends, new["mass"] - gain).otherwise(old["mass"] + gain)
            carried = F.when(old_ends, _unit(new, mass)).otherwise(_unit(old, mass))
            return F.struct(carried.alias("left"), F.concat(out, F.array(settled)).alias("out"))

        gained = step(up, room_old <= new["mass"], F.lit(1), F.lit(0))
        lost = step(-down, old["mass"] <= room_new, F.lit(0), F.lit(1))
        first = F.struct(_unit(new, new["mass"]).alias("left"), out.alias("out"))
        return F.when(old.isNull(), first).when(rises, gained).otherwise(lost)

    return F.aggregate(units, start, exchange)


def copies(docs: DataFrame, size: Column | None = None, group: int = GROUP) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, n_copies (long).

    Rows alike in doc_id, source and size are drawn as one unit, whose copies are shared out
    evenly: the rows of a unit are numbered in `place` from 1, and no row has more than MAX_COPIES.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = docs.select("doc_id", "source", size.alias("size"))
    units = write_table(rows.groupBy("doc_id", "source", "size").count(), "units")
    sums = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("count")).alias("source_size"), F.count("*").alias("n_units")
    )
    sources = write_table(source_targets(sums), "targets")
    wanted = F.col("count") * F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = (
        units.withColumnRenamed("source", "own")
        .join(sources, F.col("own").eqNullSafe(F.col("source")))
        .withColumn("base", F.floor(wanted))
        .withColumn("mass", (wanted - F.col("base")) * F.col("size"))
        .withColumn("draw", F.xxhash64(F.lit(SEED), "doc_id", "source", "size"))
    )
    sure = drawn.where("mass = 0").select("source", "doc_id", "size", "count", "base", F.lit(0).cast("long").alias("up"))

    parts = F.ceil(F.col("n_units") / group)
    unit = F.struct("draw", "doc_id", "size", "count", "base", "mass")
    level = drawn.where("mass > 0").select(
        "source", parts.cast("long").alias("parts"), F.pmod(F.xxhash64(F.lit("group"), "draw"), parts).alias("part"), unit.alias("unit")
    )
    kind = dict(level.select(_unit(F.col("unit"), F.col("unit.mass")).alias("u")).dtypes)["u"]
    done = dict(level.select(_settled(F.col("unit"), F.lit(0)).alias("u")).dtypes)["u"]
    out, widest = sure, units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    widest = -(-widest // group)
    while widest:
        # a group holds about `group` units: parts are dealt by hash over as many as the source needs
        folded = level.groupBy("source", "parts", "part").agg(
            _fold(F.array_sort(F.collect_list("unit")), kind, done).alias("fold")
        )
        folded = write_table(folded.select("source", "parts", "part", "fold.*"), "folded")
        settled = folded.select("source", F.explode("out").alias("u")).select("source", "u.*")
        out = out.unionByName(settled)
        last = folded.where("parts = 1").select("source", "left")
        up = _chance(F.col("left.draw")) * F.col("left.size") < F.col("left.mass")
        out = out.unionByName(last.select("source", _settled(F.col("left"), up.cast("long")).alias("u")).select("source", "u.*"))
        if widest == 1:
            break
        level = folded.where("parts > 1").select(
            "source", F.ceil(F.col("parts") / group).alias("parts"), F.floor(F.col("part") / group).alias("part"),
            F.struct(*[F.col(f"left.{c}").alias(c) for c in ("draw", "doc_id", "size", "count", "base", "mass")]).alias("unit"),
        )
        widest = -(-widest // group)

    each = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))).alias("place"))
    total = F.col("base") + F.col("up")
    extra = (F.col("place") <= total % F.col("count")).cast("long")
    counted = each.withColumn("n_copies", F.floor(total / F.col("count")) + extra).withColumnRenamed("source", "own")
    return counted.join(sources, F.col("own").eqNullSafe(F.col("source"))).select(
        "doc_id", "source", "size", "source_size", "target", "n_copies", "place"
    )


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Size counts the words of the text (null or empty: 0); a document without words takes none. A
    null source is a source of its own, the last. Rows of the same doc_id are drawn each for
    themselves. The draw depends on doc_id, source and size only, so that reruns agree however
    the table is split. Empty table: no rows. Other columns of `docs` are not read.
    """
    taken = (F.col("n_copies") * F.col("size")).alias("taken")
    return copies(docs).select("doc_id", "size", "source_size", "target", taken)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was drawn, columns unchanged."""
    key = fresh("key")
    drawn = copies(docs).where("n_copies > 0")

    def keyed(df: DataFrame, size: Column) -> DataFrame:
        parts = (F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")),
                 F.col("source").isNull(), size)
        return df.withColumns({f"{key}{i}": part for i, part in enumerate(parts)})

    on = [f"{key}{i}" for i in range(5)]
    # rows alike in what the draw depends on take its numbers in turn; the join needs no other shuffle than this
    turn = F.row_number().over(Window.partitionBy(*on).orderBy(F.xxhash64("text")))
    own = keyed(docs, word_count(F.col("text"))).withColumn(f"{key}row", turn)
    drawn = keyed(drawn, F.col("size")).select(*on, F.col("place").alias(f"{key}place"), F.col("n_copies").alias(f"{key}n"))
    rows = own.join(drawn, on).where(F.col(f"{key}row").between(F.col(f"{key}place"), F.col(f"{key}place")))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{key}n")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], times.alias(f"{key}t")).drop(f"{key}t")
