"""Exact, line and near dedup against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trailweave.llm import exact_dedup, line_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Wörter und words " * 3000


def table(spark, texts, ids=None):
    rows = [(i, t, "en", "s", 0) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = ["A b", "a B", "a b ", "", None, "É", "é", LONG, LONG.upper(), LONG[:-1], LONG + "x", "A b", "a" * 5000, "a" * 5000, "a" * 5001]


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not seen, sha(text)))
            seen |= i == keep
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [3, 64, 4096])
def test_exact(spark, block_bytes):
    docs = table(spark, TEXTS)
    found = exact_dedup.exact_duplicates(docs, block_bytes).drop("row").collect()
    assert Counter(map(tuple, found)) == plain_exact(list(enumerate(TEXTS)))


def test_exact_repeated_and_null_ids(spark):
    ids = [7, 7, None, None, 3, 3]
    texts = ["x", "x", "x", "y", "y", "z"]
    found = exact_dedup.exact_duplicates(table(spark, texts, ids)).drop("row").collect()
    assert Counter(map(tuple, found)) == plain_exact(list(zip(ids, texts)))
    left = exact_dedup.drop_exact_duplicates(table(spark, texts, ids)).select("doc_id", "text").collect()
    assert Counter(map(tuple, left)) == Counter([(7, "x"), (3, "y"), (3, "z")])


def test_exact_hot_group_meets_in_runs(spark):
    """A third of all rows are copies of one text: no join or grouping takes them by the text's name alone."""
    texts = ["hot" if i % 3 else f"own {i}" for i in range(1500)]
    ids = [None if i % 7 == 0 else i // 2 for i in range(1500)]
    docs = table(spark, texts, ids).repartition(12)
    found = exact_dedup.exact_duplicates(docs)
    assert Counter(map(tuple, found.drop("row").collect())) == plain_exact(list(zip(ids, texts)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert joins and "part" in joins[0] and found.select("row").distinct().count() == 1500


def test_exact_names_do_not_rest_on_hashes(spark):
    docs = table(spark, TEXTS)
    weak = exact_dedup.identities(docs, F.col("text"), {"doc_id": F.col("doc_id")}, 64, lambda b: F.xxhash64(b) % 3)
    strong = exact_dedup.identities(docs, F.col("text"), {"doc_id": F.col("doc_id")}, 64)

    def classes(df):
        groups = defaultdict(set)
        for r in df.collect():
            groups[r.n_bytes, r.name].add(r.doc_id)
        return sorted(map(sorted, groups.values()))

    assert classes(weak) == classes(strong)


def test_exact_keeps_columns_and_empty_table(spark):
    docs = table(spark, ["a", "A", "b"]).withColumn("kept", F.lit("own")).withColumn("name", F.lit(1))
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 2}
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


SHARED = "This line is shared by a good many of the documents here."
LINES = [
    f"own line of the document number {i} that is long enough to count\n  {SHARED.upper()}\t\nshort\n{SHARED}" for i in range(6)
] + ["short\nshort", "", None, SHARED, f"\n\n{SHARED}\n", "short"] + ["\n".join(f"line {k} of a long text, the same in all of them" for k in range(150))] * 5


def plain_lines(rows):
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(list)
    for i, lines in texts:
        for k in {key(x) for x in lines}:
            if len(k) >= 40:
                holders[k].append(i)
    out = []
    for i, lines in texts:
        kept = [x for x in lines if len(holders[key(x)]) < 5 or i == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return Counter(out)


def test_lines(spark):
    # a long text that loses lines in few and far words
    spread = "\n".join(SHARED if k in (70, 700, 701) else f"line {k} of a text that is long but none else has" for k in range(1000))
    texts = [*LINES, spread, "last"]
    found = line_dedup.line_duplicates(table(spark, [*texts, SHARED])).collect()
    assert Counter(map(tuple, found)) == plain_lines(list(enumerate([*texts, SHARED])))


def test_lines_are_lost_by_their_place_in_the_stream(spark):
    """The first row of a hash keeps the line, over borders of partitions; another order gives another owner."""
    held = [(9, 0, 1), (7, 0, 0), (5, 1, 2), (3, 1, 1), (1, 2, 0), (8, 2, 5)]  # doc_id, part, pos, in stream order
    rows = [(doc, 0, pos, 1, 1, 1, part, part * 10 + k) for k, (doc, part, pos) in enumerate(held)]
    rows += [(doc, 0, 0, 2, 1, 1, 2, 100 + doc) for doc in range(4)]  # too few documents
    schema = "doc_id long, text_hash long, pos int, h1 long, h2 long, lead int, part int, place long"
    lost = line_dedup.lost_lines(spark.createDataFrame(rows, schema)).collect()
    assert {r.doc_id for r in lost} == {7, 5, 3, 1, 8} and len(lost) == 5
    turned = [(*r[:7], -r[7]) for r in rows]
    assert {r.doc_id for r in line_dedup.lost_lines(spark.createDataFrame(turned, schema)).collect()} == {9, 7, 5, 3, 1}


def test_line_stream_is_sorted(spark):
    rows = line_dedup.line_stream(table(spark, LINES)).orderBy("place").collect()
    assert len(rows) > 700 and [(r.h1, r.h2, -r.doc_id, r.pos) for r in rows] == sorted((r.h1, r.h2, -r.doc_id, r.pos) for r in rows)
    assert len({r.place for r in rows}) == len(rows)


def test_lines_repeated_rows_null_ids_empty(spark):
    ids = [1, 1, 2, 5, 5, None]
    found = line_dedup.line_duplicates(table(spark, [SHARED] * 6, ids)).collect()
    lost = {(r.doc_id, r.n_dropped) for r in found}
    assert lost == {(1, 1), (2, 1), (5, 0), (None, 1)} and len(found) == 6
    assert line_dedup.line_duplicates(table(spark, LINES).limit(0)).count() == 0
    own = table(spark, LINES).withColumn("dropped", F.lit(1)).withColumn("word", F.lit(2))
    assert line_dedup.deduplicated(own).count() == len(LINES)


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    own = list(prints)
    root = list(range(len(own)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            if (own[a][1] ^ own[b][1]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(own):
        least[find(k)] = min(least.get(find(k), i), i)
    return {(i, f"{f:016x}", least[find(k)]) for k, (i, f) in enumerate(own)}


@pytest.mark.parametrize("pairwise", [0, 2, 32])
def test_near(spark, pairwise):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(12):
        base = list(rng.choice(words, 300))
        for k in range(6):
            base[int(rng.integers(300))] = "X" * (k + 1)
            texts.append(" ".join(base))
    texts += ["", None, "  \n", "One", "one", "one two", "ONE\ttwo", texts[0]]
    found = simhash.near_duplicates(table(spark, texts), pairwise).select("doc_id", "fingerprint", "component_id")
    assert {tuple(r) for r in found.collect()} == plain_components([(i, plain_fingerprint(t)) for i, t in enumerate(texts)])


def test_links_of_a_crowd(spark):
    """Chains of fingerprints two bits apart, in both segments, with and without pairs in between."""
    rng = np.random.default_rng(5)
    start = int(rng.integers(1 << 62))
    values = [start]
    for k in range(120):
        values.append(values[-1] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    values += [int(v) for v in rng.integers(1 << 62, size=30)]
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in (v % (1 << 64) for v in values)})
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    wanted = None
    for pairwise in (0, 3, 1000):
        roots = {r.node: r.root for r in simhash.components(simhash._links(fps, pairwise)).collect()}
        classes = defaultdict(set)
        for v in signed:
            classes[roots.get(v, v)].add(v)
        found = sorted(map(sorted, classes.values()))
        wanted = wanted or found
        assert found == wanted
    plain = plain_components([(v, v % (1 << 64)) for v in signed])
    assert len({c for _, _, c in plain}) == len(wanted)


def test_near_keeps_one_of_each(spark):
    texts = ["a b c d", "A b c d", "other words here now", None, ""]
    docs = table(spark, texts, [4, 2, 9, 7, 7]).withColumn("fp", F.lit("own")).withColumn("root", F.lit(0))
    left = simhash.keep_one_of_each(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 7, 9]
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0
    nulls = simhash.near_duplicates(table(spark, ["x y", "x y", "z"], [None, None, None])).collect()
    assert len(nulls) == 3 and all(r.component_id is None for r in nulls)
    assert simhash.keep_one_of_each(table(spark, ["x y", "x y", "z"], [None, None, None])).count() == 2
