"""Tokens, languages, toxicity, quality, pages and URLs against plain versions and held-out rows."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter
from dataclasses import replace
from datetime import date

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailweave.llm import bpe, html_text, language, quality, queries, toxicity, url_filter

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    None, "", "  \n\t ", "don't I'LL 'S '''S", "ΟΔΟΣ Σ ΑΣ İstanbul ß é é", "<|endoftext|>a<|startoftext|>b <|endoftext",
    "한국어 日本 x\x85y z 123 ½ ²", "👩‍👩‍👧 \x01", "a" * 5000, "word " * 20000, "É à la carte, naïve ﬁ",
]


def table(spark, texts):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("own")).withColumn("ids", F.lit("own"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def learned(docs):
    return language.learn(docs)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_bpe_is_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r.text for r in docs.select("text").collect()] + ODD
    found = {r.doc_id: r for r in bpe.round_trip(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(found[i]) == (i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)), repr(text)[:80]


def test_bpe_keeps_columns(spark):
    rows = bpe.tokenized(table(spark, ODD))
    assert {"score", "ids", "n_tokens", "decoded_sha256"} <= set(rows.columns)
    back = {r.doc_id: r for r in bpe.decode(bpe.encode(table(spark, ODD))).collect()}
    codec = bpe.codec()
    for r in rows.collect():
        assert r.ids == back[r.doc_id].ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == sha(back[r.doc_id].decoded) and back[r.doc_id].decoded == codec.decode(r.ids)
    assert bpe.round_trip(table(spark, ODD).limit(0)).count() == 0


def test_bpe_order_of_merges():
    """Any order of equal ranks gives the greedy result: lowest rank first, leftmost first."""
    codec = bpe.codec()
    codec.encode("x")
    for word in ("banana", "mississippi", "aaaaaaa", "aaaaaaaa", "ababababa", "zzzyyyxxx"):
        ids = [codec.inner[b] for b in word.encode()[:-1]] + [codec.last[word.encode()[-1]]]
        while True:
            ranked = [(codec.merges[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in codec.merges]
            if not ranked:
                break
            (_, merged), k = min(ranked)
            ids[k : k + 2] = [merged]
        assert list(codec.word(word)) == ids


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "abc", "b", "bc", "c", "ca"]
    rng = np.random.default_rng(0)
    p = np.concatenate([rng.random((7, 2)), [[1e-7, 1e-7], [0.0, 0.0]]])
    model = language.Model(["x", "y"], pieces, p)
    for word in ("abca", "cab", "b", "aXb", "bcabcab"):
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, part = [], word[0]
            for c, cut in zip(word[1:], cuts):
                parts, part = ([*parts, part], c) if cut else (parts, part + c)
            numbers = [pieces.index(q) if q in pieces else 7 if len(q) == 1 else 8 for q in [*parts, part]]
            total += np.prod(p[numbers], axis=0)
        assert np.allclose(np.exp(model.word_scores([word, "a"])[0]), total)


def plain_word(model, word):
    """All segmentations by the plain forward recursion, in logarithms."""
    numbers = {q: k for k, q in enumerate(model.pieces)}
    longest, log = max(map(len, numbers)), np.log(np.maximum(model.p, 1e-300))
    alpha = [np.zeros(len(model.languages))]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(max(0, end - longest), end):
            number = numbers.get(word[start:end], len(numbers) if end - start == 1 else None)
            if number is not None:
                ways.append(alpha[start] + log[number])
        alpha.append(np.logaddexp.reduce(ways, axis=0))
    return alpha[-1]


def test_whole_texts_by_brute_force(docs, learned):
    """The query's prediction and score of every text, from all pieces of the vocabulary and whole words."""
    found, model = {r.doc_id: r for r in language.languages(docs).collect()}, learned
    assert max(map(len, model.pieces)) == 16 and len(model.pieces) > 20_000
    known = {}
    for r in docs.limit(60).collect():
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        scores = sum((known.setdefault(w, plain_word(model, w)) for w in words), np.zeros(len(model.languages)))
        if words:
            assert found[r.doc_id].lang_pred == model.languages[int(np.argmax(scores))]
            assert abs(found[r.doc_id].score - 1 / np.exp(scores - scores.max()).sum()) < 1e-6


@pytest.mark.parametrize("length", [16, 39, 40, 41, 60, 2000])
def test_words_of_any_length_are_summed_whole(learned, length):
    model = learned
    word = ("administrativeunfortunately" * 100)[:length]
    assert np.allclose(model.word_scores([word, "a"])[0], plain_word(model, word), rtol=1e-9)
    assert np.allclose(model.long_score(word), plain_word(model, word), rtol=1e-9)


def test_number_signs_are_no_letters(spark):
    odd = language.languages(table(spark, ["½ ² 3", "Ⅷ", "②", "٣", "́", "ªx"])).collect()
    assert [r.lang_pred for r in odd[:5]] == ["und"] * 5


def test_remembered_scores_stay_in_bounds(docs, learned, monkeypatch):
    model = language.Model(learned.languages, learned.pieces, learned.p)
    texts = [r.text for r in docs.limit(100).collect()]
    whole = language.Model(model.languages, model.pieces, model.p).text_scores(texts)
    monkeypatch.setattr(language, "REMEMBERED", 8 * len(model.languages) * 3000)
    rows = []
    for at in range(0, 100, 5):
        rows.append(model.text_scores([*texts[at : at + 5], "w" * 70]))
        assert "w" * 70 not in model.known and model.used <= len(model.scores) < 12_000
    assert np.allclose(np.concatenate([r[:-1] for r in rows]), whole)


def test_languages(spark, docs):
    found = language.languages(docs.unionByName(table(spark, ODD).select(docs.columns).withColumn("lang", F.lit(None).cast("string"))))
    rows = found.collect()
    held = {r.doc_id for r in rows if r.held_out}
    assert held == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    real = {r.doc_id: r.lang for r in docs.collect()}
    right = [r.lang_pred == real[r.doc_id] for r in rows[: len(real)] if r.held_out]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(real) + len(ODD)
    odd = language.languages(table(spark, [None, "", "12 !"])).collect()
    assert [(r.lang_pred, r.score) for r in odd] == [("und", 0.0)] * 3
    assert language.languages(docs.limit(0)).count() == 0


def test_transducers():
    grammar = toxicity.Grammar(frozenset({"oaf"}), frozenset({"blun"}))

    def kinds(text):
        return {(*k, n) for k, n in grammar.clauses(text).items() if k}

    assert kinds("you oaf.") == {("insult", "near target", 1, 1)}
    assert kinds("an oaf. you.") == {("insult", "alone", 1, 1)}
    assert kinds("not an oaf") == {("not insult", "alone", 1, 1)}
    assert kinds("not one of them was really an oaf") == {("insult", "with target", 1, 1)}
    assert kinds("she said blunderer") == {("reported insult", "near target", 1, 1)}
    assert kinds("he said no oaf; I will kill you") == {("reported not insult", "near target", 1, 1), ("threat", "near target", 1, 1)}
    assert kinds("oaf oaf oaf oaf! oaf oaf? an oaf, oaf") == {("insult", "alone", 3, 1), ("insult", "alone", 2, 2)}
    assert kinds("") == kinds(None) == kinds("fine words") == set()
    assert grammar.clauses("one. two!\n\n three")[None] == 3


FORMS = ["an oaf", "not", "said", "you", "kill", ".", "word", "oaf", "never"]
plain_class = {"oaf": "insult", "kill": "threat", "you": "target", "not": "no", "never": "no", "said": "say"}.get


def plain_clauses(text):
    """Clause kinds by looking back and forth over each clause's words, without machines."""
    out = Counter()
    for clause in text.split("."):
        words = [plain_class(w) for w in clause.split()]
        harms = []
        for k, word in enumerate(words):
            if word in ("insult", "threat"):
                negated = "no" in words[max(k - toxicity.SCOPE, 0) : k]
                harms.append((k, "reported " * ("say" in words[:k]) + "not " * negated + word))
        if not harms:
            continue
        top = min((h for _, h in harms), key=toxicity.HARMS.index)
        targets = [k for k, w in enumerate(words) if w == "target"]
        # nearness counts between neighbours: a target and the last harm before it, a harm and the last target before it
        pairs = [(k, max((t for t in targets if t < k), default=None)) for k, h in harms if h == top]
        pairs += [(max((k for k, h in harms if h == top and k < t), default=None), t) for t in targets]
        gaps = [abs(k - t) for k, t in pairs if k is not None and t is not None]
        aim = "alone" if not targets else "near target" if gaps and min(gaps) <= toxicity.NEAR else "with target"
        out[top, aim, min(sum(h == top for _, h in harms), toxicity.INTENSE)] += 1
    return out


def test_clauses_as_by_looking_at_each():
    grammar, rng = toxicity.Grammar(frozenset({"oaf"})), np.random.default_rng(3)
    for _ in range(2000):
        text = " ".join(rng.choice(FORMS, rng.integers(0, 40)))
        found = grammar.clauses(text)
        assert Counter({k: n for k, n in found.items() if k}) == plain_clauses(text), text


def test_negated_and_quoted_insults_lower_the_score(spark):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(300):
        clauses = [" ".join(rng.choice([f"w{k}" for k in range(200)], 5)) for _ in range(6)]
        for at in rng.choice(6, 3, replace=False):
            kind = ("a real {}", "not a {}", "he said a {}")[i % 3]
            clauses[at] += " " + kind.format(rng.choice(["oaf", "twit", "dolt"]))
        rows.append((i, ". ".join(clauses), "en", "s", 0))
        marks.append((i, 1, int(i % 3 == 0 or i % 17 == 1)))
    # words that toxic texts share only
    rows += [(1000 + i, f"w{i} w2 {w}. w3 {w} w4", "en", "s", 0) for i, w in enumerate(["oaf", "twit", "dolt"] * 200)]
    marks += [(1000 + i, 1, 1) for i in range(600)]
    rows += [(2000 + i, f"w{i} w{i % 7}", "en", "s", 0) for i in range(3000)]
    marks += [(2000 + i, 1, 0) for i in range(3000)]
    grammar = toxicity.learn(spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    weights = dict(zip(toxicity.FEATURES, grammar.weights[1:], strict=True))
    assert {"oaf", "twit", "dolt"} <= grammar.words
    assert all(w * sign >= 0 for w, sign in zip(weights.values(), toxicity.SIGNS, strict=True)) and weights["insult"] + weights["share"] > 0

    def score(text):
        return grammar.scores(np.array([grammar.features(text)]))[0]

    plain = "a real oaf. you twit and dolt. w5 w6"
    for marked in ("not real oaf. never twit and dolt. w5 w6", "he said oaf. she called you twit and dolt. w5 w6"):
        assert score(marked) < score(plain)
        assert score(marked) <= score("w1 w2. w3 w4. w5 w6")


def plain_held(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod == rest


def test_toxicity(spark):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(300)]
    bad = ["oaf", "twit", "dolt", "blockhead"]
    rows, marks = [], []
    for i in range(400):
        text = list(rng.choice(words, 40))
        toxic = i % 4 == 0
        if toxic:
            for at in rng.choice(40, 4, replace=False):
                text[at] = str(rng.choice(bad))
        rows.append((i, " ".join(text), "en", "s", 0))
        marks.append((i, 1, int(toxic)))
    marks += [(None, 1, 1), (5, None, None), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (1000, "", "en", "s", 0), (1001, "you oaf twit dolt " * 9000, "en", "s", 0)], DOCS)
    )
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == 403
    held = [i for i in range(400) if plain_held(i, 5, 0)]
    assert {i for i in range(400) if found[i].held_out} == set(held) and found[None].held_out
    assert all(found[i].predicted == (i % 4 == 0) for i in held)
    assert found[1000].predicted == 0 and found[1001].predicted == 1 and found[None].score == found[1000].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == 403 and len({r.score for r in none}) == 1
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(*[words[k:] for k in range(5)]))
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered))


def test_quality(spark, docs, labels):
    texts = [r.text for r in docs.select("text").collect()] + ODD
    texts += ["a b c d e f a b c d e", "one two three four five " * 3 + "and many other words follow here that are new", "x\n x\nx\n\n\n", "a#b <c> | %"]
    own = table(spark, texts)
    found = {r.doc_id: r for r in quality.quality_rules(own, labels).collect()}
    for i, text in enumerate(texts):
        r, plain = found[i], plain_counts(text)
        assert tuple(r)[1:6] == plain
        failed = plain[0] < 10 or 100 * plain[4] > 20 * plain[0]
        assert r.base_failed == failed and not (failed and r.kept)
    marks = labels.collect()
    good = [found[m.doc_id].kept for m in marks if m.quality == 1 and not found[m.doc_id].base_failed]
    bad = [found[m.doc_id].kept for m in marks if m.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2
    kept = quality.keep_good(own, labels)
    assert kept.columns == own.columns and {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    bare = quality.quality_rules(own, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in bare)
    assert quality.keep_good(own.limit(0), labels).count() == 0


def test_repeated_words_of_many_names():
    """More different words than five fit into one packed key."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in rng.integers(0, 20000, 30000)]
    words[25000:25040] = words[100:140]
    assert quality.statistics_of(" ".join(words))[:5] == plain_counts(" ".join(words))


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>no";</script><style>p{{}}</style></head>
<body><header>Site</header><nav><ul><li><a href="/">Home</a></li><li>More</li></ul></nav><div class="cookie-notice">We use</div>
<main><article id="post"><h1>{title}</h1><p>First&nbsp;&amp; <b>bo</b>ld   text<br>next<p>Second</p><div class="ad-box">Buy</div>
<ul><li>one<li>two</ul><form><input value="x">Mail</form><!-- no --><aside>Side</aside><table><tr><td>c1<td>c2</table></article>
<section class="comments">A reader</section></main><footer>End</footer></body></html>"""


def test_pages(spark):
    bare = "<html><body><div>Welcome to all</div><div class='text'>Story number {0} of <i>many</i></div><div>All rights</div></body></html>"
    rows = [(k, "https://a.org/x", PAGE.format(title=f"T{k}")) for k in range(4)]
    rows += [(10 + k, "http://b.org:80/y", bare.format(k)) for k in range(4)]
    rows += [(20, None, None), (21, "", ""), (22, "no url", "plain text < 3 &lt; 4"), (23, "http://c.org", "<p>cut <b>of"), (23, "http://c.org", "<p>cut <b>of"),
             (24, "http://d.org", "<article>" + "<p>long text</p>" * 20000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("host", F.lit(1))
    found = {r.page_id: r for r in html_text.main_texts(pages).collect()}
    for k in range(4):
        assert found[k].text == f"T{k} First & bold text next Second one two c1 c2"
        assert found[10 + k].text == f"Story number {k} of many"
    assert found[20].text == found[21].text == "" and found[20].n_chars == 0
    assert found[22].text == "plain text < 3 < 4" and found[23].text == "cut of"
    assert found[24].n_chars == 20000 * 10 - 1 and html_text.main_texts(pages).count() == len(rows)
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_wrapper_is_a_regular_expression():
    one = "<ul><li>a</li><li>b</li></ul><p>same</p><h2>x</h2>"
    two = "<ul><li>c</li></ul><p>same</p>"
    wrapper = html_text.infer([one, two, "<ul><li>a</li></ul><div>y</div><p>same</p>"])
    assert wrapper.expression() == "<page><ul>(<li>#</li>)+</ul>(<div>y</div>)?<p>same</p>(<h2>x</h2>)?</page>"


def texts_of(spark, pages):
    """Main texts by page_id of (page_id, host, html)."""
    rows = [(k, None if host is None else f"http://{host}/{k}", page) for k, host, page in pages]
    return {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_template_inside_articles(spark):
    """What every page of a host has in its article is template; pages without article tags use the host's template, too."""
    post = "<article><h1>T{0}</h1><div class='zq'>Read our terms</div><p>The story of day {0}, told at some length</p><p>Same for all</p></article>"
    bare = "<body><div>Welcome to all</div><p>Story {0}</p></body>"
    found = texts_of(spark, [(k, "e.org", (post if k < 4 else bare).format(k)) for k in range(8)])
    assert found == {k: f"T{k} The story of day {k}, told at some length" if k < 4 else f"Story {k}" for k in range(8)}


def test_names_do_not_hide_articles(spark):
    layout = "<body><div class='layout has-sidebar'><article><p class='share-price'>Price {0}</p><div id='search-results'>Hits {0}</div></article></div></body>"
    form = "<body><form id='f'><h1>Head {0}</h1><p>Whole page {0}</p></form></body>"
    menu = "<body><div class='menu'><main><p>Main {0}</p></main></div><aside>Side</aside></body>"
    other = "<body><article>Post<div class='comments'><article>Reply</article></div></article><nav><article>Teaser</article></nav></body>"
    pages = [(k, f"h{k}.org", page.format(k)) for k, page in enumerate([layout, form, menu, other])]
    pages += [(4 + k, "i.org", f"<article><p>Text {k} of the article</p><div class='ad-box'>Buy</div></article>") for k in range(3)]
    found = texts_of(spark, pages)
    assert [found[k] for k in range(4)] == ["Price 0 Hits 0", "Head 1 Whole page 1", "Main 2", "Post"]
    assert [found[4 + k] for k in range(3)] == [f"Text {k} of the article" for k in range(3)]


def test_copies_make_no_template(spark):
    page = "<body><h2>Head</h2><div>One story</div><p>of many</p></body><!-- {0} -->"
    alike = "<body><h2>Head {0}</h2><div>By the same author</div></body>"
    pages = [(k, "j.org", page.format(k)) for k in range(4)] + [(4 + k, None, alike.format(k)) for k in range(3)]
    found = texts_of(spark, pages)
    assert [found[k] for k in range(4)] == ["Head One story of many"] * 4
    assert [found[4 + k] for k in range(3)] == [f"Head {k} By the same author" for k in range(3)]


def test_every_kind_of_page_has_its_template(spark):
    """Whatever the host's other pages, which share paths with the rare kind."""
    often = "<body><div>Welcome</div><p>Story {0}</p></body>"
    rare = "<body><div>Our shop</div><h2>Thing {0}</h2></body>"
    article = "<body><div>Welcome</div><article><p>Article {0}</p></article></body>"
    pages = [(k, "k.org", (rare if k < 3 else article if k == 3 else often).format(k)) for k in range(40)]
    found = texts_of(spark, pages)
    assert [found[k] for k in range(5)] == ["Thing 0", "Thing 1", "Thing 2", "Article 3", "Story 4"]


@pytest.mark.parametrize("page", [
    "<b>x " * 100_000, "<div>" * 100_000 + "deep", "<p>a" * 50_000, "<table><tr><td>" * 20_000 + "x", "<b>" * 30_000 + "</i>" * 30_000,
    "<i><section>" + "<b>" * 30_000 + "</i>" * 30_000, "<form>" * 30_000 + "<h1>x</h1>" * 30_000, "<div class='a b c'>" * 20_000 + "x",
    "<script " * 10_000, '<p title="' * 8_000, "<a " * 8_000, "<p it's " * 10_000, "<" * 80_000, "<!--" * 20_000, "<!" * 40_000, "</" * 40_000,
    "&amp" * 20_000, "<x y='" + 'z="' * 20_000, "<li>" * 40_000, "<article>" * 20_000 + "x", "<main>" * 5_000 + "x", "<a b='>" * 10_000,
])
def test_ill_formed_pages_take_time_in_proportion(page):
    """No page ends a query by its depth, or takes long by its unclosed tags, quotes and comments."""
    start = time.process_time()
    html_text.extract(page)
    assert time.process_time() - start < 5


def test_one_ill_formed_page_among_others(spark):
    pages = [(k, "q.org", f"<article><p>Page {k}</p></article>") for k in range(3)] + [(3, "q.org", "<b>x " * 5000), (4, "q.org", "<div>" * 3000 + "end")]
    found = texts_of(spark, pages)
    assert [found[k] for k in range(3)] == ["Page 0", "Page 1", "Page 2"] and found[4] == "end" and found[3] == " ".join("x" * 5000)


def test_tags_and_text():
    texts = {
        "a < b <i>c</i> <3 d<e": "a < b c <3 d<e", "<p title='a>b' class=x>t</p>u": "t u", "1<br/>2<p/>3": "1 2 3", "<article/>all<p>of it": "all of it",
        "x<!-- <p>no --><p>y": "x y", "<script>if (a<b) '</p>'</script>z": "z", "<div>a<span>b</div>c": "ab c", "<ul><li>1<li>2<ul><li>3</ul></ul>": "1 2 3",
        "<table><tr><td>1<td>2<tr><td>3</table>": "1 2 3", "<p>it's <b>so</p>5 > 4": "it's so 5 > 4", "<A HREF=x>q</A>": "q", "</p>r</div>": "r",
        "<p a=\"x>y</p>z": "y z",
    }
    assert {page: html_text.extract(page) for page in texts} == texts


def test_boxes_inside_articles_go_and_the_flow_stays():
    page = (
        "<article><h1 class='notice'>Head</h1><p class='alert'>One</p><div class='comment-list'><p>First!</p></div><p class='login'>Two</p>"
        "<div class='newsletter-signup'>Join</div><section class='related-posts'>More</section><ins class='adsbygoogle'>Buy</ins>"
        "<div class='has-sidebar'>Three</div></article>"
    )
    assert html_text.extract(page) == "Head One Two Three"


def test_documents_pages_of_the_data(spark):
    """Pages of the test tables: what stands between the article tags, tags removed."""
    for r in queries.op6_html_text(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), ["page_id", "url"]).collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        inner = re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)>", " ", inner))
        assert r.text == " ".join(__import__("html").unescape(inner).split())


def test_url_lists(spark):
    entries = spark.createDataFrame(
        [("ads", "b.org", date(2024, 1, 5), True), ("ads", "b.org", date(2024, 1, 9), False), ("ads", "b.org", date(2024, 1, 20), True),
         ("spam", "a.b.org/x/y", date(2024, 1, 1), True), ("bad", "b.org", date(2024, 1, 7), True), ("bad", "b.org", date(2024, 1, 7), False),
         (None, "b.org", date(2024, 1, 1), True), ("ads", None, date(2024, 1, 1), True)],
        "list string, target string, day date, added boolean",
    )
    captures = [
        (1, "http://a.b.org/x/y/z?q", date(2024, 1, 6)), (2, "http://A.B.org./x/yy", date(2024, 1, 9)), (3, "https://u@b.org:8080", date(2024, 1, 8)),
        (4, "http://bb.org/", date(2024, 1, 6)), (5, None, date(2024, 1, 6)), (6, "http://b.org", None), (7, "http://b.org", date(2024, 2, 1)),
        (7, "http://b.org", date(2024, 2, 1)), (8, "/x/y", date(2024, 1, 6)), (9, "http://b.org", date(2024, 1, 4)),
    ]
    table = spark.createDataFrame(captures, "page_id long, url string, fetched date").withColumn("target", F.lit(1))
    found = url_filter.filtered(table, entries).collect()
    got = {r.page_id: (r.blocked, r.n_entries, r.target, ",".join(r.lists)) for r in found}
    no = (False, 0, None, "")
    assert got == {1: (True, 2, "a.b.org/x/y", "ads,spam"), 2: no, 3: (True, 1, "b.org", "ads"), 4: no, 5: no, 6: no,
                   7: (True, 1, "b.org", "ads"), 8: no, 9: no}
    assert len(found) == len(captures)
    assert url_filter.filtered(table.limit(0), entries).count() == 0
    assert not any(r.blocked for r in url_filter.filtered(table, entries.limit(0)).collect())


def test_quality_learns_from_every_labelled_row(spark, docs, labels):
    """All good rows reach the trees, in equal numbers, and each labelled row weighs in the threshold."""
    rng = np.random.default_rng(4)
    rows = [(int(d), *map(float, x)) for d, x in zip(rng.integers(0, 1 << 62, 30_000), rng.normal(size=(30_000, 6)))]
    shape = "draw long, " + ", ".join(f"{f} double" for f in quality.FEATURES)
    good = spark.createDataFrame(rows, shape).repartition(3)
    forest = quality.grow_forest(good, len(rows))
    roots = quality._ranges(good, replace(forest, feature=np.full(quality.TREES, quality._OPEN)), 1)
    assert roots["n"].sum() == len(rows) and set(roots["node"]) == set(range(quality.TREES))
    again = quality.grow_forest(good.repartition(5), len(rows))
    assert np.array_equal(forest.cut, again.cut) and not (forest.feature == quality._OPEN).all()
    x = np.array([r[1:] for r in rows])
    assert forest.score(x + 30).min() > np.quantile(forest.score(x), 0.99)
    # 21,000 labelled copies of one odd text, which are good: no cap may hide that they are
    odd = "# # # WWW !!! ??? zz zzz q x y k l m n o"
    counted = quality._counted(docs.select("doc_id", "text").unionByName(spark.range(10**6, 10**6 + 21_000).selectExpr("id as doc_id", f"'{odd}' as text")))
    marks = labels.select("doc_id", "quality").unionByName(spark.range(10**6, 10**6 + 21_000).selectExpr("id as doc_id", "cast(1 as int) as quality"))
    counts = pd.DataFrame([quality.statistics_of(odd)], columns=quality.COUNTS)
    found = quality.fit(counted, marks)
    assert found.score(quality.features(counts))[0] < found.threshold
