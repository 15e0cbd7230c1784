"""SimHash near-duplicates, found through deletion variants.

Fingerprints of 64 bits that differ in at most two bits are linked. Cut into two segments, one
segment of a linked pair differs in at most one bit, so every fingerprint is indexed under each
of its segments with one bit blanked out; linked pairs meet under an equal key and are verified.

Fingerprints are handled once each, however many documents share them. Keys that few
fingerprints share are joined pair by pair. Under the others, which a large group of near
copies makes, each fingerprint is listed under every value within one bit of it: two are linked
exactly if they share such a value, and no value has more than 65. Each value links its
fingerprints to the smallest of them. The work on a group grows with its size, not with its
square, and no link is lost: all of them end in the same component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, keep_one, lower_ascii, sent_if_small, write_table

SHINGLE = 3
SEED = 42
BITS = 64
SEGMENT = BITS // 2
MAX_BITS = 2
#: The fingerprints of fuller keys are linked through shared neighbours instead of pair by pair; components are the same.
PAIRWISE = 32


def fingerprint_of(words: list[bytes]) -> int:
    """The 64 bits of one text, signed; `words` are its normalised words. No words: zero."""
    if not words:
        return 0
    n = len(words)
    if n < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(words[i : i + SHINGLE]) for i in range(n - SHINGLE + 1)]
    digest = xxhash.xxh64_digest
    # digests are big-endian: bit k of the number is bit 63 - k of what unpackbits gives
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        some = b"".join([digest(s, SEED) for s in shingles[at : at + (1 << 16)]])
        ones += np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles)).view(">i8")[0])


def fingerprints(docs: DataFrame, name: str = "fp") -> DataFrame:
    """`docs` with the fingerprint of the whole text as a signed long; null text has no words."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        # one text at a time leaves the batch: a worker never holds the strings of all of them;
        # bytes.split() splits at ASCII white space, which is what separates words
        return pa.array([fingerprint_of(t.as_py().split()) for t in texts.cast(pa.binary())], pa.int64())

    return docs.withColumn(name, fingerprint(lower_ascii(F.col("text"))))


def _keys(fps: DataFrame) -> DataFrame:
    """Each fingerprint under its segment variants with one blank: (bit, part, fp).

    `bit` tells the segment, too; a blanked bit is zero in `part`.
    """
    segments = ((1 << SEGMENT) - 1, ~((1 << SEGMENT) - 1))
    signed = [1 << b if b < BITS - 1 else -(1 << b) for b in range(BITS)]
    masks = F.array(*[F.lit(segments[b // SEGMENT] & ~signed[b]) for b in range(BITS)])
    return fps.select("fp", F.posexplode(masks).alias("bit", "mask")).select(
        "bit", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp"
    )


def _links(fps: DataFrame, pairwise: int) -> DataFrame:
    """Pairs (a, b), a < b, that connect exactly the fingerprints linked at MAX_BITS or fewer bits."""
    keys = _keys(fps)
    key = ["bit", "part"]
    sizes = write_table(keys.groupBy(*key).count().where("count > 1"), "keys")
    met = write_table(keys.join(sent_if_small(sizes), key), "met")

    few = met.where(F.col("count") <= pairwise)
    a, b = few.alias("a"), few.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    pairs = a.join(
        b,
        [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
        + [F.col("a.fp") < F.col("b.fp"), F.bit_count(differ) <= MAX_BITS],
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    # Two fingerprints are linked exactly if some value differs from each of them in one bit at
    # most; at most BITS + 1 fingerprints can be so near to one value.
    crowd = met.where(F.col("count") > pairwise).select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(BITS)])
    near = crowd.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    balls = near.groupBy("value").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
    stars = balls.select("a", F.explode("fps").alias("b")).where("b > a")
    return pairs.unionByName(stars).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of `links` (a, b): root is the smallest node it is connected with.

    Large-star and small-star steps in turn: each node's larger, then its smaller, neighbours are
    hung under the smallest one, until nothing moves. Every step is a grouping and a join; a
    node's neighbours are never gathered in one row.
    """
    edges = write_table(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        """Count and sums: equal before and after only if nothing moved."""
        return df.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    was = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = (
            both.join(least.withColumn("least", F.least("a", "least")), "a").where("b > a")
            .select(F.col("least").alias("a"), "b").distinct()
        )
        large = write_table(large, "large")
        # small star: of the smaller neighbours a of b, and b itself, all go under the smallest
        lowest = large.groupBy("b").agg(F.min("a").alias("least"))
        hung = large.join(lowest, "b")
        small = hung.select(F.col("least").alias("a"), "b").unionByName(
            hung.where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
        )
        edges = write_table(small.distinct(), "edges")
        now = mark(edges)
        if now == was:
            break
        was = now
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, fp, root.

    component_id is the smallest doc_id reachable over links, the document's own included. Null
    and empty texts have fingerprint zero and are linked like any other; a null doc_id is never a
    component's id unless the component has no other. Repeated rows are repeated in the result.
    Other columns of `docs` are not read.
    """
    return _classes(write_table(fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"), "fingerprints"), pairwise)


def _classes(rows: DataFrame, pairwise: int) -> DataFrame:
    """``near_duplicates`` of the written `rows` of doc_id and fp."""
    least = write_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = write_table(components(_links(least.select("fp"), pairwise)), "roots")
    grown = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    grown = grown.withColumn("root", F.coalesce("root", "fp"))
    ids = grown.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = grown.join(ids, "root").select("fp", "root", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(classes, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id", "fp", "root")


def keep_one_of_each(docs: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """`docs` with one document of each component, columns unchanged: the one with the smallest doc_id.

    Of rows that repeat this doc_id one stays. Rows are written with their fingerprints, so that the
    texts are gone through once.
    """
    fp = fresh("fp")
    marked = write_table(fingerprints(docs, fp), "fingerprinted")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("best")
    kept = _classes(marked.select("doc_id", F.col(fp).alias("fp")), pairwise).groupBy("root").agg(best)
    kept = kept.select("best.doc_id", F.col("best.fp").alias(fp))
    return keep_one(marked, kept, fp).drop(fp)
