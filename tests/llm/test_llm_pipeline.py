"""Mixing and the whole pipeline against plain versions; the registered queries against SQL."""

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from helpers import assert_matches_sql, duck
from pyspark.sql import functions as F
from test_llm_dedup import LOWER, plain_components, plain_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from trailweave.llm import mixing, quality, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Shares of 150 % by weight, cut at twice the size, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full: set = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / free > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else rest * weight[s] / free for s in names}
        full |= over


def held_to(rows, docs):
    """rows of mix() against the documents' (doc_id, source, size)."""
    sizes = defaultdict(int)
    for _, source, size in docs:
        sizes[source] += size
    targets = plain_targets(sizes)
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, size) for i, _, size in docs)
    source_of = {i: source for i, source, _ in docs}
    taken = Counter()
    for r in rows:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
    largest = defaultdict(int)
    for _, source, size in docs:
        largest[source] = max(largest[source], size)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] + 1e-6


@pytest.mark.parametrize("group", [3, 64])
def test_mix(spark, group):
    rows = [(i, "w " * (i * 7 % 23), "en", f"s{i % 5 if i % 3 else 0}", 0) for i in range(500)]
    rows += [(600 + i, "a b c d", "en", None, 0) for i in range(40)] + [(700, None, None, None, None), (701, "", "en", "empty", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("own")).withColumn("place", F.lit(1))
    found = mixing.copies(docs, group=group).withColumn("taken", F.col("n_copies") * F.col("size"))
    held_to(found.collect(), [(i, s, n_words(t)) for i, t, _, s, _ in rows])
    again = mixing.copies(docs.repartition(7), group=group)
    key = ["doc_id", "n_copies", "place"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, found.select(key).collect()))


def test_mix_repeated_rows_and_empty(spark):
    rows = [(1, "a b c", "en", "x", 0)] * 301 + [(i, "a b c", "en", "y", 0) for i in range(2, 12)] + [(None, "a b", "en", "y", 0)] * 9
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows) and all(r.taken <= 2 * r.size for r in found)
    by_source = Counter()
    for r in found:
        by_source[r.source_size] += r.taken
    assert all(abs(by_source[r.source_size] - r.target) <= 3 for r in found)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert sum(n_words(r.text) for r in mixed.collect()) == sum(r.taken for r in found)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
    wordless = spark.createDataFrame([(1, "", "en", "x", 0), (2, None, "en", None, 0)], DOCS)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(wordless).collect()] == [(0, 0.0, 0)] * 2


def test_pipeline_is_its_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(docs, labels).collect()}
    left = {r.doc_id: r for r in docs.collect() if verdict[r.doc_id]}
    latest = {}
    for i in sorted(left):
        latest[(left[i].text or "").translate(LOWER)] = i
    left = {i: left[i] for i in latest.values()}
    near = plain_components([(i, plain_fingerprint(r.text)) for i, r in left.items()])
    left = {i: left[i] for i in {c for _, _, c in near}}

    found = corpus_pipeline.run(spark, SF).collect()
    times = Counter(r.doc_id for r in found)
    sized = [(i, r.source, n_words(r.text)) for i, r in left.items()]
    held_to(
        [r for r in mixing.mix(docs.where(F.col("doc_id").isin(*left))).collect()], sized
    )
    assert set(times) <= set(left) and max(times.values()) <= 2
    plain = {r.doc_id: r.taken for r in mixing.mix(docs.where(F.col("doc_id").isin(*left))).collect()}
    assert {i: times.get(i, 0) * size for i, _, size in sized} == plain
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in found:
        own = left[r.doc_id]
        assert (r.text, r.lang, r.source, r.n_chars) == (own.text, own.lang, own.source, own.n_chars)
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30).withColumn("ids", F.lit("own"))
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, none, SF).count() == 0
    assert set(docs.columns) <= set(corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns)


def test_texts_go_to_python_once_a_stage(spark):
    """Workers keep what they once took: a stage's texts are read in one pass, and written with what was found."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage, passes in ((corpus_pipeline.good, 1), (corpus_pipeline.unlike, 0)):
        plan = stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"\(?\d*\)?\s*ArrowEvalPython \[", plan)) == passes, plan
        assert not re.search(r"ArrowEvalPython \[[^\n]*text#", plan)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    assert_matches_sql(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE_SQL[name])


def test_entry_registers_all():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
