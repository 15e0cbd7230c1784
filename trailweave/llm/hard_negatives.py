"""Hard negatives by angular triangle filtering.

Every vector stores its angles to a few reference directions. The angle between two vectors lies
between the difference and the sum of their angles to any direction, so cosines, and times the
norms scores, have bounds before any product is taken. Vectors are packed into blocks, each of one
label, nearest direction and stretch of angles; of a block, an anchor scores, in whole numbers, only
the window whose bounds reach what it still looks for. Angles are widened by far more than their
rounding, so a window never loses a row.

The anchors are a stated query set that goes through all rows in blocks: batches of anchors meet
groups of blocks, each pair in a task of bounded size, which keeps the best rows of each anchor; the
best of those are taken afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Reference directions: the mean directions of so many groups of labels.
DIRECTIONS = 8
#: Rows of a block, anchors of a batch, blocks that meet a batch in one task (about).
BLOCK, BATCH, GROUP = 2048, 4096, 48
#: Tasks that share the blocks of a small table.
LEAST_GROUPS = 16
#: Anchors that score a window together.
TOGETHER = 64
#: Angles are widened by this (radians), and bounds by this share: rounding errors stay below 1e-7.
SLACK, SHARE = 1e-6, 1e-9
#: Below this, products of whole numbers are exact in double precision.
EXACT = float(1 << 52)
LONG = (1 << 63) - 1


def _matrix(vectors: pa.ListArray, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of whole numbers, short ones filled up with zeros, and which of them are finite throughout."""
    if not vectors.null_count:
        ends = vectors.offsets.to_numpy()
        sizes = np.diff(ends)
        flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if len(sizes) and (sizes == sizes[0]).all():
            own = flat[ends[0] : ends[-1]].reshape(len(sizes), sizes[0])
            full = own if width in (None, own.shape[1]) else np.pad(own, ((0, 0), (0, width - own.shape[1])))
            return _floored(full)
    lists = vectors.to_pylist()
    width = max([1, *(len(v) for v in lists if v is not None)]) if width is None else width
    full = np.zeros((len(lists), width))
    for at, v in enumerate(lists):
        full[at] = np.nan if v is None else [*v, *[0.0] * (width - len(v))]
    return _floored(full)


def _floored(full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fine = np.isfinite(full).all(axis=1)
    with np.errstate(invalid="ignore", over="ignore"):
        return np.floor(full * SCALE), fine


def _norms(numbers: np.ndarray) -> np.ndarray:
    return np.sqrt((numbers * numbers).sum(axis=1))


def _angles(numbers: np.ndarray, directions: np.ndarray) -> np.ndarray:
    norms = _norms(numbers)
    cosines = numbers @ directions.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def _directions(vectors: DataFrame) -> np.ndarray:
    """Unit vectors along the sums of the vectors whose labels agree modulo DIRECTIONS.

    Every task adds up its own; what comes to the driver is one number for each component of each
    direction, whatever the number of rows.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DIRECTIONS, 1))
        for batch in batches:
            numbers, fine = _matrix(batch.column(1))
            groups = batch.column(0).to_numpy(zero_copy_only=False)[fine].astype(np.int64) % DIRECTIONS
            if numbers.shape[1] > total.shape[1]:
                total = np.pad(total, ((0, 0), (0, numbers.shape[1] - total.shape[1])))
            unit = numbers[fine] / np.maximum(_norms(numbers[fine]), 1)[:, None]
            for group in range(DIRECTIONS):
                total[group, : unit.shape[1]] += unit[groups == group].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(DIRECTIONS)), pa.array(total.tolist())], names=["group", "total"])

    parts = vectors.select("label", "embedding").mapInArrow(sums, "group long, total array<double>")
    added = parts.select("group", F.posexplode("total").alias("at", "x")).groupBy("group", "at").agg(F.sum("x").alias("x")).collect()
    found = np.zeros((DIRECTIONS, max([1, *(r["at"] + 1 for r in added)])))
    for r in added:
        found[r["group"], r["at"]] = r["x"]
    lengths = _norms(found)
    found = found[lengths > 0] / lengths[lengths > 0][:, None]
    return found if len(found) else np.eye(1, found.shape[1])


@dataclass
class _Rows:
    """Some vectors: a row key each, vec_id and whether that is null, whole numbers, norm, angles."""

    keys: np.ndarray
    ids: np.ndarray
    null: np.ndarray
    numbers: np.ndarray
    norms: np.ndarray
    angles: np.ndarray


_BLOCK_SCHEMA = pa.schema([
    ("block", pa.int64()), ("label", pa.int64()), ("direction", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()),
    ("null", pa.binary()), ("narrow", pa.bool_()), ("numbers", pa.binary()), ("angles", pa.binary()),
])
_BLOCK_TYPES = "block long, label long, direction long, n long, ids binary, null binary, narrow boolean, numbers binary, angles binary"


def _bytes_of(numbers: np.ndarray) -> tuple[bool, bytes]:
    narrow = bool((np.abs(numbers) < 1 << 31).all())
    return narrow, numbers.astype("<i4" if narrow else "<f8").tobytes()


def _numbers_of(narrow: bool, raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if narrow else "<f8").reshape(n, -1).astype(np.float64)


def _rows_of(block: dict) -> _Rows:
    n = block["n"]
    numbers = _numbers_of(block["narrow"], block["numbers"], n)
    keys = block["block"] * BLOCK + np.arange(n)
    ids, null = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["null"], "?")
    return _Rows(keys, ids, null, numbers, _norms(numbers), np.frombuffer(block["angles"], "<f8").reshape(n, -1))


def _placed(vectors: DataFrame, directions: np.ndarray) -> DataFrame:
    """The rows that take part, with the number of their nearest direction and the angle to it."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, fine = _matrix(batch.column(2), directions.shape[1])
            angles = _angles(np.where(fine[:, None], numbers, 0), directions)
            nearest = angles.argmin(axis=1)
            added = [pa.array(nearest, pa.int64()), pa.array(angles[np.arange(len(angles)), nearest], pa.float64())]
            full = pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "direction", "angle"])
            yield full.filter(pa.array(fine))

    kinds = dict(vectors.dtypes)
    return vectors.mapInArrow(placed, f"vec_id long, label long, embedding {kinds['embedding']}, direction long, angle double")


def _blocks(placed: DataFrame, directions: np.ndarray) -> DataFrame:
    """Blocks of rows of one label and nearest direction, in order of the angle to it.

    Rows are range-partitioned down to vec_id, so that neither a label nor a vector that is very
    frequent comes into one task.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        of, n = None, 0

        def block() -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            ids, vectors = table.column("vec_id"), table.column("embedding").combine_chunks()
            numbers, _ = _matrix(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors, directions.shape[1])
            narrow, raw = _bytes_of(numbers)
            row = {
                "block": number, "label": of[0], "direction": of[1], "n": table.num_rows, "ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                "null": ids.is_null().to_numpy().tobytes(), "narrow": narrow, "numbers": raw, "angles": _angles(numbers, directions).astype("<f8").tobytes(),
            }
            number += 1
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        for batch in batches:
            kinds = list(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True))
            at = 0
            while at < len(kinds):
                if n and (kinds[at] != of or n == BLOCK):
                    yield block()
                    held, n = [], 0
                of, end = kinds[at], at
                while end < len(kinds) and kinds[end] == of and n + end - at < BLOCK:
                    end += 1
                held.append(batch.slice(at, end - at))
                n, at = n + end - at, end
        if n:
            yield block()

    order = ["label", "direction", "angle", "vec_id"]
    return write_table(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, _BLOCK_TYPES), "blocks")


_ANCHOR_TYPES = "key long, anchor_id long, label long, direction long, narrow boolean, numbers binary, angles binary"


def _anchors(blocks: DataFrame, every: int) -> DataFrame:
    """The rows whose vec_id `every` divides, in batches."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ANCHOR_TYPES.split(", ")]
        for batch in batches:
            for block in batch.to_pylist():
                rows = _rows_of(block)
                at = np.flatnonzero((rows.ids % every == 0) & ~rows.null)
                raw = [_bytes_of(rows.numbers[k]) for k in at]
                columns = [
                    pa.array(rows.keys[at]), pa.array(rows.ids[at]), pa.array([block["label"]] * len(at), pa.int64()),
                    pa.array([block["direction"]] * len(at), pa.int64()), pa.array([r[0] for r in raw], pa.bool_()),
                    pa.array([r[1] for r in raw], pa.binary()), pa.array([rows.angles[k].tobytes() for k in at], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    found = write_table(blocks.mapInArrow(chosen, _ANCHOR_TYPES), "anchors")
    batches = -(-found.count() // BATCH) or 1
    dealt = found.repartitionByRange(batches, "label", "direction", "key").withColumn("batch", F.spark_partition_id().cast("long"))
    return write_table(dealt, "batches")


def _met(anchors: DataFrame, blocks: DataFrame, search, types: str, alike: bool) -> DataFrame:
    """What `search` finds in each group of blocks for each batch of anchors: of their own label (`alike`) or of any."""
    groups = max(blocks.count() // GROUP + 1, LEAST_GROUPS)
    last = anchors.agg(F.max("batch")).first()[0] or 0
    left = anchors.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    if alike:
        labels = anchors.select(F.col("batch").alias("of"), F.col("label").alias("own")).distinct()
        pairs = blocks.join(labels, F.col("label") == F.col("own")).drop("own")
    else:
        pairs = blocks.withColumn("of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))))
    right = pairs.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    return left.groupBy("batch", "group").cogroup(right.groupBy("of", "part")).applyInArrow(search, types)


class _Searchers:
    """The anchors of a batch, and the windows of a block that their bounds leave."""

    def __init__(self, table: pa.Table):
        rows = table.to_pylist()
        self.keys, self.ids = [r["key"] for r in rows], [r["anchor_id"] for r in rows]
        self.labels = np.array([r["label"] for r in rows])
        self.numbers = np.concatenate([_numbers_of(r["narrow"], r["numbers"], 1) for r in rows])
        self.norms = _norms(self.numbers)
        self.angles = np.stack([np.frombuffer(r["angles"], "<f8") for r in rows])
        #: The least score that each still looks for, and the largest.
        self.need = np.full(len(rows), -np.inf)
        self.cap = np.full(len(rows), np.inf)

    def scored(self, block: _Rows, direction: int, own: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(anchor, first row, scores from there on) for each anchor of `own` whose window is not empty."""
        least, most = block.norms.min(), block.norms.max()
        # the block as a whole: its stretch of angles to every direction
        apart = np.maximum(block.angles.min(axis=0) - self.angles[own], self.angles[own] - block.angles.max(axis=0)).max(axis=1)
        cosine = np.cos(np.maximum(apart - SLACK, 0))
        highest = cosine * self.norms[own] * np.where(cosine > 0, most, least)
        own = own[highest + np.abs(highest) * SHARE + SHARE >= self.need[own]]
        if not len(own):
            return
        # of its own direction, the stretch in which the bounds leave a chance
        at, norms = self.angles[own, direction], self.norms[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.nan_to_num(self.need[own] / (norms * np.where(self.need[own] > 0, most, least)), nan=-1.0)
            spared = np.nan_to_num(self.cap[own] / (norms * least), nan=1.0)
        reach = np.arccos(np.clip(needed * (1 - np.sign(needed) * SHARE), -1, 1)) + SLACK
        close = np.arccos(np.clip(spared * (1 + SHARE), -1, 1)) - SLACK
        stored = block.angles[:, direction]
        first = np.searchsorted(stored, np.maximum(at - reach, close - at), "left")
        end = np.searchsorted(stored, at + reach, "right")
        some = np.flatnonzero(first < end)
        some = some[np.argsort(first[some], kind="stable")]
        for start in range(0, len(some), TOGETHER):
            part = some[start : start + TOGETHER]
            lo, hi = first[part].min(), end[part].max()
            for k, scores in zip(part, _scores(self.numbers[own[part]], block.numbers[lo:hi]), strict=True):
                yield own[k], first[k], scores[first[k] - lo : end[k] - lo]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly; those that long does not hold become its largest or least value."""
    if _norms(a).max() * _norms(b).max() < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    return np.array([[max(-LONG, min(LONG, sum(int(x) * y for x, y in zip(u, v, strict=True)))) for v in whole] for u in a], np.int64)


class _Best:
    """The first `most` rows found: highest score, then smallest vec_id, null last."""

    def __init__(self, most: int):
        self.most = most
        self.scores = self.ids = self.keys = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, block: _Rows, at: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, block.ids[at]])
        null, keys = np.concatenate([self.null, block.null[at]]), np.concatenate([self.keys, block.keys[at]])
        order = np.lexsort((keys, ids, null, -scores))[: self.most]
        self.scores, self.ids, self.null, self.keys = scores[order], ids[order], null[order], keys[order]

    def need(self) -> float:
        return -np.inf if len(self.scores) < self.most else self.scores[-1]

    def rows(self) -> Iterator[dict]:
        for score, i, null, key in zip(self.scores.tolist(), self.ids.tolist(), self.null.tolist(), self.keys.tolist(), strict=True):
            yield {"found_id": None if null else i, "found": key, "score": score}


_FOUND = [("found_id", pa.int64()), ("found", pa.int64()), ("score", pa.int64())]
_FOUND_TYPES = "found_id long, found long, score long"


def _own_label(most: int):
    """Search for the best other rows of an anchor's label."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        if left.num_rows and right.num_rows:
            anchors, best = _Searchers(left), [_Best(most) for _ in range(left.num_rows)]
            for block in right.to_pylist():
                rows = _rows_of(block)
                for k, first, scores in anchors.scored(rows, block["direction"], np.flatnonzero(anchors.labels == block["label"])):
                    at = np.flatnonzero(scores >= anchors.need[k])
                    at = at[rows.keys[first + at] != anchors.keys[k]]
                    if len(at):
                        best[k].add(scores[at], rows, first + at)
                        anchors.need[k] = best[k].need()
            out = [{"key": key} | row for key, own in zip(anchors.keys, best, strict=True) for row in own.rows()]
        return pa.Table.from_pylist(out, schema=pa.schema([("key", pa.int64()), *_FOUND]))

    return search


def limits(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the largest negative score of a positive one: low * p <= 100 * score <= high * p."""
    return -(-low * positive_score // 100), high * positive_score // 100


def _other_labels(most: int, low: int, high: int):
    """Search for the best rows of other labels whose score lies between shares of the positives' scores."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        if left.num_rows and right.num_rows:
            anchors = _Searchers(left)
            between = [[limits(p, low, high) for p in own] for own in left.column("positive_scores").to_pylist()]
            best = [[_Best(most) for _ in own] for own in between]
            anchors.need = np.array([min((lo for lo, hi in own if lo <= hi), default=np.inf) for own in between], float)
            anchors.cap = np.array([max((hi for lo, hi in own if lo <= hi), default=-np.inf) for own in between], float)
            looking = np.isfinite(anchors.need)
            for block in right.to_pylist():
                rows = _rows_of(block)
                for k, first, scores in anchors.scored(rows, block["direction"], np.flatnonzero(looking & (anchors.labels != block["label"]))):
                    if scores.max() < anchors.need[k]:
                        continue
                    for (lo, hi), own in zip(between[k], best[k], strict=True):
                        at = np.flatnonzero((scores >= max(lo, own.need())) & (scores <= hi))
                        if len(at):
                            own.add(scores[at], rows, first + at)
                    anchors.need[k] = min(max(lo, own.need()) for (lo, hi), own in zip(between[k], best[k], strict=True) if lo <= hi)
            out = [
                {"key": key, "place": place} | row
                for key, own in zip(anchors.keys, best, strict=True) for place, one in enumerate(own) for row in one.rows()
            ]
        return pa.Table.from_pylist(out, schema=pa.schema([("key", pa.int64()), ("place", pa.int32()), *_FOUND]))

    return search


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` hold vec_id, label (any whole number) and embedding; other columns are not read.
    Anchors are the rows whose vec_id `every` divides; each has the first `positives` other rows of
    its label, and each of those the first `negatives` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Scores are inner products
    of floor(256 x); higher ones come first, then smaller vec_ids, null ones last.

    Rows with a null label, a null vector, or a null or non-finite component take no part; rows with
    a null vec_id do, but not as anchors. Vectors of different lengths count as filled up with
    zeros. A repeated row is a row of its own, as anchor, positive and negative. Scores that long
    does not hold count as its largest or least value. An empty table gives no row.
    """
    rows = vectors.where("label IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )
    directions = _directions(rows)
    blocks = _blocks(_placed(rows, directions), directions)
    anchors = _anchors(blocks, every)
    first = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found")
    near = (
        _met(anchors, blocks, _own_label(positives), f"key long, {_FOUND_TYPES}", alike=True)
        .withColumn("place", F.row_number().over(first) - 1)
        .where(F.col("place") < positives)
    )
    near = write_table(near.select("key", "place", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    held = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("own"))
    asked = anchors.join(held.select("key", F.col("own.positive_score").alias("positive_scores")), "key")
    far = _met(asked, blocks, _other_labels(negatives, low, high), f"key long, place int, {_FOUND_TYPES}", alike=False)
    among = Window.partitionBy("key", "place").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found")
    far = far.withColumn("rank", F.row_number().over(among)).where(F.col("rank") <= negatives)
    found = far.join(near, ["key", "place"]).join(anchors.select("key", "anchor_id"), "key")
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
