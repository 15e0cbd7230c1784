"""Line deduplication: lines that many documents share stay in one of them only.

A line's key is hashed to 128 bits. One row per long line (hash, document, position) is
range-partitioned by hash with a secondary sort by document and position, and every row gets its
place in this stream. The row of a hash with the first place is of the document that keeps the
line. A hash that a third of all documents hold runs on through as many partitions as it fills:
each reports its own first row and number of documents, and what these add up to goes back to each
partition's stretch, never to all rows of the hash at once. What returns to the documents is a
bitmap of dropped lines, 64 to a word and only words with a drop; the text itself is never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, lower_ascii, sent_if_small, write_table

MIN_CHARS = 40
MIN_DOCS = 5
WORD_BITS = 64


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line of `min_chars` or more: doc_id, text_hash, pos, h1, h2, lead.

    `lead` is 1 at the first of a document's lines with this key, else 0.
    """
    keys = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform(_lines(F.col("text")), _key).alias("keys"))
    hashed = F.transform(
        "keys",
        lambda k, i: F.when(
            F.length(k) >= min_chars,
            F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"), i.alias("pos")),
        ),
    )
    ordered = keys.select("doc_id", "text_hash", F.array_sort(F.array_compact(hashed)).alias("rows"))
    rows = ordered.select("doc_id", "text_hash", F.explode(_with_lead("rows")).alias("row"))
    return rows.select("doc_id", "text_hash", "row.*")


def _with_lead(rows: str) -> Column:
    def marked(row: Column, i: Column) -> Column:
        before = F.get(F.col(rows), i - 1)
        again = (i > 0) & (before["h1"] == row["h1"]) & (before["h2"] == row["h2"])
        return F.struct(row["h1"].alias("h1"), row["h2"].alias("h2"), row["pos"].alias("pos"), F.when(again, 0).otherwise(1).alias("lead"))

    return F.transform(rows, marked)


def line_stream(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """line_rows() in the order of hash, document (largest first, null last) and position, as a written table.

    `part` is a row's partition of the stream, `place` grows along the stream through all partitions.
    """
    rows = write_table(line_rows(docs, min_chars), "lines")
    stream = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "text_hash", "pos"]
    ordered = rows.repartitionByRange(*stream).sortWithinPartitions(*stream)
    placed = ordered.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    return write_table(placed, "stream")


def lost_lines(stream: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows of the stream whose line `min_docs` or more documents hold, but for those of the first one's doc_id."""
    runs = stream.groupBy("h1", "h2", "part").agg(
        F.min("place").alias("place"), F.min_by("doc_id", "place").alias("owner"), F.sum("lead").alias("n_docs")
    )
    runs = write_table(runs, "runs")
    owners = runs.groupBy("h1", "h2").agg(
        F.min_by("owner", "place").alias("owner"), F.sum("n_docs").alias("n_docs")
    ).where(F.col("n_docs") >= min_docs)
    # a run is a hash's rows within one partition, however many rows the hash has
    shared = write_table(runs.drop("owner", "n_docs", "place").join(owners.drop("n_docs"), ["h1", "h2"]), "shared")
    return stream.join(sent_if_small(shared), ["h1", "h2", "part"]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))


def dropped_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, dropped): dropped is an array of (word, bits), for documents that lose a line.

    Bit k of word w stands for line 64 w + k. Equal rows of `docs` share a bitmap.
    """
    lost = lost_lines(line_stream(docs, min_chars), min_docs)
    words = lost.groupBy("doc_id", "text_hash", F.floor(F.col("pos") / WORD_BITS).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD_BITS)).alias("bits")
    )
    return words.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def _kept(lines: Column, dropped: Column) -> Column:
    """Lines whose bit is not set."""
    zero = F.lit(0).cast("long")
    # words in place, each after zeros for those without a drop, so that a line finds its own at once
    gap = lambda word, i: word["word"] - F.when(i > 0, F.get(dropped, i - 1)["word"]).otherwise(-1) - 1
    dense = F.flatten(F.transform(dropped, lambda word, i: F.concat(F.array_repeat(zero, gap(word, i)), F.array(word["bits"]))))
    all_words = F.floor((F.size(lines) + WORD_BITS - 1) / WORD_BITS).cast("int")
    rest = all_words - F.element_at(dropped, -1)["word"] - 1
    split = F.transform(
        F.concat(dense, F.array_repeat(zero, rest)), lambda bits, w: F.filter(
            F.slice(lines, w * WORD_BITS + 1, F.lit(WORD_BITS)),
            lambda line, k: F.call_function("shiftrightunsigned", bits, k).bitwiseAND(F.lit(1).cast("long")) == 0,
        ),
    )
    return F.flatten(split)


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`docs` with the columns kept_text, n_lines and n_dropped (fresh ones replace columns so named).

    Lines end at \\n; null or empty text is one empty line. Keys are lines without ASCII white
    space at both ends, A-Z lower-cased. Every row counts as a document; rows with the largest
    doc_id all keep the line, a null doc_id being smaller than any. Row order plays no role.
    """
    known, null, text_hash = fresh("known"), fresh("null"), fresh("hash")

    def keyed(df: DataFrame, hashed: Column) -> DataFrame:
        return df.withColumns({known: F.coalesce("doc_id", F.lit(0)), null: F.col("doc_id").isNull(), text_hash: hashed})

    marks = keyed(dropped_bitmaps(docs, min_chars, min_docs), F.col("text_hash")).select(
        known, null, text_hash, F.col("dropped").alias(f"{known}_dropped")
    )
    rows = keyed(docs, F.xxhash64("text")).join(marks, [known, null, text_hash], "left")
    lines, dropped = _lines(F.col("text")), F.col(f"{known}_dropped")
    joined = F.when(dropped.isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(_kept(lines, dropped), "\n"))
    n_dropped = F.aggregate(
        F.coalesce(dropped, F.array().cast("array<struct<word:int,bits:bigint>>")),
        F.lit(0).cast("long"),
        lambda n, w: n + F.bit_count(w["bits"]),
    )
    out = rows.withColumns({"kept_text": joined, "n_lines": F.size(lines).cast("long"), "n_dropped": n_dropped})
    return out.drop(known, null, text_hash, f"{known}_dropped")


def line_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256. Cases as in deduplicated()."""
    return deduplicated(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )

