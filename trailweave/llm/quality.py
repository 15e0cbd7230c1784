"""Quality rules: an isolation forest over rule statistics of whole texts.

Every text is reduced to a few statistics (word lengths, symbols, capitals, repetition). The
forest is grown on all texts labelled good, dealt over its trees: each tree splits its own at random
features and values, and a text that is isolated after few splits is unlike good text. The score
from which a text is rejected is the one that best separates all labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, write_table

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A tree gets this many good rows at least, as far as there are so many: rows then go to several trees.
TREES, SUBSET, SEED = 100, 256, 11
#: Scores from which rejection may start, evenly spaced.
CUTS = 1 << 16
PRIOR, PRIOR_CHARS = 20, 5
#: A rejected good text costs this many kept bad ones in calibration.
GOOD_WEIGHT = 4.0

_BLANKS = b" \t\n\x0b\x0c\r"
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_adjacent"]


def _ranked(values: np.ndarray) -> tuple[np.ndarray, int]:
    found, place = np.unique(values, return_inverse=True)
    return place.astype(np.int64), len(found)


def _repeated_words(ids: np.ndarray, n_ids: int, window: int = WINDOW) -> int:
    """Words that lie in a window of `window` words found at least twice."""
    n = len(ids) - window + 1
    if n < 2 or n_ids == len(ids):
        return 0
    key, size = ids[:n], n_ids
    for k in range(1, window):
        if size > (1 << 62) // n_ids:  # keep the packed key exact
            key, size = _ranked(key)
        key, size = key * n_ids + ids[k : k + n], size * n_ids
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def statistics_of(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: ASCII white space only
    n = len(words)
    if not n:
        return (0,) * 2 + (sum(map(text.count, SYMBOLS)),) + (0,) * 5
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    lines = [line for line in raw.split(b"\n") if line.strip(_BLANKS)]
    return (
        n,
        len(text) - sum(raw.count(b) for b in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(ids, len(names)),
        len(_CAPITALS.findall(text)),
        raw.count(b"!") + raw.count(b"?"),
        int(np.count_nonzero(ids[1:] == ids[:-1])),
    )


def text_statistics(text: str) -> Column:
    """The counts of a column's texts as a struct."""

    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(texts: pa.Array) -> pa.Array:
        # one text at a time leaves the batch: a worker never holds the strings of all of them
        found = np.array([statistics_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(c) for c in found.T], COUNTS)

    return counts(text)


def features(counts: pd.DataFrame) -> np.ndarray:
    """Rates of the counts, so that long and short texts compare; PRIOR usual words keep those of short ones calm."""
    c = {k: counts[k].to_numpy(np.float64) for k in COUNTS}
    n = c["n_words"] + PRIOR
    return np.column_stack(
        [
            np.minimum((c["word_chars"] + PRIOR * PRIOR_CHARS) / n, 30),
            np.log1p(10 * c["n_symbols"] / n),
            np.log1p(10 * c["n_capitals"] / n),
            np.log1p(10 * c["n_marks"] / n),
            c["n_repeat_words"] / n,
            c["n_adjacent"] / n,
        ]
    )


_LEAF, _OPEN = -1, -2


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees, the roots first: feature (negative: none), threshold, left child (right is next), path length."""

    trees: int
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    norm: float
    threshold: float = 1.0

    def node_of(self, x: np.ndarray, root: np.ndarray) -> np.ndarray:
        """The node in which each row ends that starts from the root."""
        node = root.astype(np.int64)
        while True:
            f = self.feature[node]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return node
            at = node[inner]
            node[inner] = self.left[at] + (x[inner, f[inner]] >= self.cut[at])

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; higher: isolated after fewer splits."""
        total = np.zeros(len(x))
        for tree in range(self.trees):
            total += self.depth[self.node_of(x, np.full(len(x), tree))]
        return 2.0 ** (-total / max(self.trees, 1) / self.norm)


_NO_FOREST = Forest(0, *[np.zeros(0)] * 4, norm=1.0)


def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


FEATURES = ["word_chars", "symbols", "capitals", "marks", "repeated", "adjacent"]
_STEPS = np.array([k for k in range(1, TREES) if np.gcd(k, TREES) == 1])


def _trees_of(draw: np.ndarray, k: int) -> np.ndarray:
    """The k-th tree that a row goes to; all different for one row."""
    return (draw + k * _STEPS[draw // TREES % len(_STEPS)]) % TREES


def _ranges(rows: DataFrame, forest: Forest, shares: int) -> pd.DataFrame:
    """Of each open node how many rows end in it, and the least and greatest of each feature."""
    model = rows.sparkSession.sparkContext.broadcast(forest)
    lows, highs = [f"low_{f}" for f in FEATURES], [f"high_{f}" for f in FEATURES]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x, draw = rows[FEATURES].to_numpy(np.float64), rows["draw"].to_numpy()
            for k in range(shares if len(rows) else 0):
                node = model.value.node_of(x, _trees_of(draw, k))
                at = np.flatnonzero(model.value.feature[node] == _OPEN)
                if not len(at):
                    continue
                at = at[np.argsort(node[at], kind="stable")]
                found, start = np.unique(node[at], return_index=True)
                out = pd.DataFrame(np.minimum.reduceat(x[at], start), columns=lows)
                out[highs] = np.maximum.reduceat(x[at], start)
                out["node"], out["n"] = found, np.diff(np.append(start, len(at)))
                yield out[["node", "n", *lows, *highs]]

    shape = ", ".join(["node long", "n long", *[f"{c} double" for c in lows + highs]])
    found = rows.mapInPandas(of, shape).groupBy("node")
    least, greatest = [F.min(c).alias(c) for c in lows], [F.max(c).alias(c) for c in highs]
    # a row a node: TREES * 2 ** levels at most
    return found.agg(F.sum("n").alias("n"), *least, *greatest).toPandas().sort_values("node")


def grow_forest(rows: DataFrame, n: int, seed: int = SEED) -> Forest:
    """Forest of all the `n` `rows` (FEATURES and a non-negative `draw`), each in as many trees as give a tree SUBSET rows.

    Trees grow level by level: a split needs no more of a node's rows than their ranges, which Spark
    aggregates. Ranges are widened by their own width, so that points outside of what was seen are cut off early.
    """
    rng = np.random.default_rng(seed)
    shares = min(TREES, -(-TREES * SUBSET // n))
    size = n * shares / TREES
    limit = int(np.ceil(np.log2(max(min(SUBSET, size), 2)))) + 2
    norm = max(_mean_path(size), 1.0)
    feature, cut, left, depth = [_OPEN] * TREES, [0.0] * TREES, [0] * TREES, [0.0] * TREES

    def grown() -> Forest:
        return Forest(TREES, np.array(feature), np.array(cut), np.array(left), np.array(depth), norm)

    for level in range(limit + 1):
        found = _ranges(rows, grown(), shares)
        first = len(feature)
        for row in found.itertuples(index=False):
            low, high = np.array(row[2 : 2 + len(FEATURES)]), np.array(row[2 + len(FEATURES) :])
            if level >= limit or row.n < 2:
                feature[row.node], depth[row.node] = _LEAF, level + _mean_path(row.n)
                continue
            pad = (high - low) / 2 + 0.05
            f = int(rng.integers(len(FEATURES)))
            feature[row.node], left[row.node] = f, len(feature)
            cut[row.node] = rng.uniform(low[f] - pad[f], high[f] + pad[f])
            for part in (feature, cut, left, depth):
                part.extend([_OPEN] * 2 if part is feature else [level + 1.0] * 2 if part is depth else [0] * 2)
        if len(feature) == first:
            break
    return grown()


def fit(counted: DataFrame, labels: DataFrame) -> Forest:
    """Forest grown on all labelled good texts, with the threshold that separates all labelled rows best.

    `counted`: doc_id and COUNTS of the documents. Without any good one, nothing is rejected. Only ranges of
    nodes and counts of rows by score come to the driver, as many as there are nodes and CUTS at most.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality")
    )
    one = (
        counted.join(marked, "doc_id")
        .groupBy("doc_id")  # doc_ids may repeat
        .agg(F.min(F.struct("quality", *COUNTS)).alias("row"))
    )

    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def rates(counts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(features(counts), columns=FEATURES).where(~_fails_base(counts))

    usable = write_table(
        one.select(
            (F.col("row.quality") == 1).alias("good"),
            F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 1).alias("draw"),
            rates(F.struct(*[F.col(f"row.{c}") for c in COUNTS])).alias("rates"),
        )
        .select("good", "draw", "rates.*")
        .where(F.col(FEATURES[0]).isNotNull()),
        "labelled",
    )
    good = usable.where("good")
    n = good.count()
    if not n:
        return _NO_FOREST
    forest = grow_forest(good, n)
    model = usable.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("int")
    def place(x: pd.DataFrame) -> pd.Series:
        return pd.Series(np.minimum(model.value.score(x.to_numpy(np.float64)) * CUTS, CUTS - 1).astype(np.int32))

    by_place = (
        usable.select("good", place(F.struct(*FEATURES)).alias("place"))
        .groupBy("place")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
        .toPandas()
    )
    counts = np.zeros((2, CUTS + 1), np.int64)
    counts[:, by_place["place"]] = by_place[["good", "bad"]].to_numpy().T
    lost_good = counts[0].sum() - np.cumsum(counts[0]) + counts[0]
    kept_bad = np.cumsum(counts[1]) - counts[1]
    best = int(np.argmin(GOOD_WEIGHT * lost_good + kept_bad))
    above = best + np.flatnonzero(counts.sum(0)[best:])
    if not len(above):
        return forest
    # up to the next score that a row has, all cuts are alike: the middle of them
    return replace(forest, threshold=float((best + above[0]) / 2 / CUTS))


def _fails_base(counts: pd.DataFrame) -> pd.Series:
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"]
    )


def _judge(forest: Forest, counts: Column) -> Column:
    """Struct of base_failed, anomaly and kept, by the struct of COUNTS."""
    model = SparkSession.active().sparkContext.broadcast(forest)  # its size is fixed by TREES and the levels

    @F.pandas_udf("base_failed boolean, anomaly double, kept boolean")
    def judge(counts: pd.DataFrame) -> pd.DataFrame:
        failed = _fails_base(counts)
        anomaly = model.value.score(features(counts)) if model.value.trees else np.zeros(len(counts))
        return pd.DataFrame({"base_failed": failed, "anomaly": anomaly, "kept": ~failed & (anomaly < model.value.threshold)})

    return judge(counts)


def _counted(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row, written once: the whole texts are gone through in this one pass."""
    return write_table(docs.select("doc_id", text_statistics("text").alias("s")).select("doc_id", "s.*"), "counts")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, anomaly.

    Null text has no words and fails the base rule. Rows are judged one by one, so repeated rows
    and doc_ids are repeated in the result; a null doc_id is no label's. Empty `labels`: the base
    rule alone decides. Other columns of `docs` are not read.
    """
    counted = _counted(docs)
    judged = counted.withColumn("judged", _judge(fit(counted, labels), F.struct(*COUNTS)))
    return judged.select("doc_id", *COUNTS[:5], "judged.base_failed", "judged.kept", "judged.anomaly")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rejected documents, columns unchanged.

    Rows are written with their counts, so that the texts are gone through once.
    """
    check = fresh("check")
    counted = write_table(docs.withColumn(check, text_statistics("text")), "counts")
    judged = counted.withColumn(check, _judge(fit(counted.select("doc_id", f"{check}.*"), labels), F.col(check)))
    return judged.where(f"{check}.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
