"""Hard negatives against SQL, brute force on odd vectors, and windows that lose no row."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from helpers import assert_matches_sql, canonical, duck, spark_rows
from pyspark.sql import functions as F

from trailweave.llm import hard_negatives as mined
from trailweave.llm import queries

SCHEMA = "vec_id long, label int, embedding array<float>, rank string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
QUERY = "op13_hard_negatives"


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """Every anchor against every row."""
    fine = [
        (k, i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for k, (i, label, v) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    for k, i, label, v in fine:
        if i is None or i % every:
            continue
        scored = []
        for k2, i2, label2, w in fine:
            score = max(-mined.LONG, min(mined.LONG, sum(a * b for a, b in zip(v, w))))
            scored.append((-score, i2 is None, i2 or 0, k2, i2, label2 == label))
        scored.sort()
        for score, _, _, _, positive, _ in [s for s in scored if s[5] and s[3] != k][:positives]:
            near = [s for s in scored if not s[5] and low * -score <= 100 * -s[0] <= high * -score]
            for rank, s in enumerate(near[:negatives], 1):
                yield i, positive, rank, s[4], -score, -s[0]


def random_rows(seed, n, width=6):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        center = r.choice([-1, 1])
        v = [center * (j % 2) + r.gauss(0, 0.5) for j in range(width)]
        rows.append((k * 10, r.randrange(4), v))
    return rows


ODD = [
    (None, 1, [1.0, 1.0]), (100, None, [1.0, 1.0]), (200, 1, None), (300, 1, [1.0, None]), (400, 1, [float("nan"), 1.0]),
    (500, 1, [float("inf"), 1.0]), (600, 1, []), (700, 1, [0.0, 0.0]), (800, 1, [1.0, 1.0]), (800, 1, [1.0, 1.0]), (801, 1, [1.0, 1.0, 1.0]),
    (900, 2, [0.5, 0.5]), (901, 2, [0.5, 0.5]), (902, 2, [0.5, 0.6]), (None, 2, [0.5, 0.5]), (1000, 3, [-1.0, -1.0]), (1001, 3, [1.0, -1.0]),
    (0, -5, [0.4, 0.3]), (-100, 7, [0.1, 0.9]), (-101, 7, [0.2, 0.8]), (1100, 3, [1e-9, 0.0]),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table_against_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert_matches_sql(queries.QUERIES[QUERY](spark, folder), duck(folder), queries.ORACLE_SQL[QUERY])


def test_odd_vectors(spark):
    assert spark_rows(mined.hard_negatives(table(spark, ODD))) == canonical(COLUMNS, plain(ODD))


def test_scores_beyond_exact_doubles(spark):
    big = [(k * 50, k % 3, [1e9 * (k + 1), 3e8 * k, 1e7]) for k in range(12)] + [(k, 1, [3e20, -1e5, k / 7]) for k in range(1, 5)]
    assert spark_rows(mined.hard_negatives(table(spark, big))) == canonical(COLUMNS, plain(big))


def test_empty_tables(spark):
    assert mined.hard_negatives(table(spark, ODD).limit(0)).collect() == []
    assert mined.hard_negatives(table(spark, [r for r in ODD if r[0] and r[0] % 100])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_many_blocks_batches_and_groups(spark, monkeypatch, seed):
    for name, value in (("BLOCK", 16), ("BATCH", 7), ("GROUP", 3), ("LEAST_GROUPS", 1)):
        monkeypatch.setattr(mined, name, value)
    rows = random_rows(seed, 400) + [(7, 2, [0.3] * 6)] * 60
    got = mined.hard_negatives(table(spark, rows).repartition(5), every=70, positives=3, negatives=4)
    assert spark_rows(got) == canonical(COLUMNS, plain(rows, 70, 3, 4))


def rows_of(numbers, directions):
    n = len(numbers)
    return mined._Rows(np.arange(n), np.arange(n), np.zeros(n, bool), numbers, mined._norms(numbers), mined._angles(numbers, directions))


def test_windows_lose_no_row_and_skip_most():
    """Rows along one direction: each score that is looked for lies in its anchor's window, most others lie outside."""
    r = np.random.default_rng(5)
    directions = np.eye(2, 8)
    numbers = np.floor(256 * (np.eye(1, 8)[0] + 0.6 * r.normal(size=(500, 8))))
    block = rows_of(numbers, directions)
    order = np.argsort(block.angles[:, 0], kind="stable")
    block = rows_of(numbers[order], directions)
    searchers = mined._Searchers.__new__(mined._Searchers)
    searchers.numbers = np.floor(256 * (np.eye(1, 8)[0] * r.choice([-1, 1], size=(60, 1)) + 0.1 * r.normal(size=(60, 8))))
    searchers.norms, searchers.angles = mined._norms(searchers.numbers), mined._angles(searchers.numbers, directions)
    truth = (searchers.numbers @ block.numbers.T).astype(int)
    searchers.need, searchers.cap = np.percentile(truth, 90, axis=1), np.percentile(truth, 97, axis=1)
    inside = np.zeros(truth.shape, bool)
    for k, first, scores in searchers.scored(block, 0, np.arange(60)):
        assert (scores == truth[k, first : first + len(scores)]).all()
        inside[k, first : first + len(scores)] = True
    wanted = (truth >= searchers.need[:, None]) & (truth <= searchers.cap[:, None])
    assert not (wanted & ~inside).any()
    assert inside.mean() < 0.8


def test_moved_labels_are_null_safe(spark, tmp_path):
    table(spark, ODD).select("vec_id", "label", "embedding").where(F.expr("size(embedding) = 2")).coalesce(1).write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert_matches_sql(queries.QUERIES[QUERY](spark, str(tmp_path)), con, queries.ORACLE_SQL[QUERY])
