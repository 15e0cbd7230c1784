"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols (insult, threat, target, negation, reported speech, clause end, other). A
negation transducer rewrites insults and threats within its scope, a reported-speech transducer
those that follow a verb of saying, and the clause grammar reads up to the clause's end and emits
the kind of clause: its strongest harm, whether negated or reported, how near a target is, and how
often the harm comes. The three are composed into one table at start. A text's score is the logistic
of weighted counts of its clause kinds; words outside of clauses count nowhere. Kinds with plain harm
never weigh less than nothing, those with negated or reported harm never more.

Which words are insults, and the weights of the clause kinds, are learned from labelled rows.
The other word classes are fixed lists of function words.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_table

# Function words of four languages.
TARGETS = (
    "you your yours yourself yourselves he him she her they them these those "
    "du dich dir dein deine ihr euch euer sie ihm ihn ihnen diese dieser "
    "tu te toi ton ta tes vous votre vos il elle ils elles lui leur ces cette "
    "tú ti tu tus usted ustedes vosotros él ella ellos ellas le les este esta estos estas"
).split()
NEGATIONS = (
    "not no never none nobody neither nor isn aren wasn don doesn didn cannot "
    "nicht kein keine keinen keiner nie niemals niemand ne pas jamais aucun aucune ni nunca nadie ningún ninguna tampoco"
).split()
REPORTS = (
    "said says say told called calls call claimed wrote quoted allegedly "
    "sagte sagt gesagt nannte nennt schrieb behauptete angeblich dit disait appelle appelait écrit prétend "
    "dijo dice llamó llama escribió afirmó"
).split()
THREATS = (
    "kill hurt destroy beat punch shoot stab burn hang töten umbringen schlagen vernichten verletzen "
    "tuer frapper détruire brûler blesser matar golpear destruir quemar herir"
).split()

#: Bound of the sample of labelled rows that is learned from.
MAX_LABELLED = 20_000
#: Toxic texts that a word must be in, and deviations of its toxic share from the mean, to be an insult.
MIN_TEXTS = 4
MIN_DEVIATIONS = 6.0
#: Beginnings of words that are learned beside whole words, as their endings vary.
STEMS = (4, 5, 6)
SCOPE = 3
#: Words between a target and a harm, at most, for the harm to be aimed at it.
NEAR = 3
#: Harms of one strength in a clause are counted up to this; it is the highest level of intensity, not a cut of text.
INTENSE = 3

INSULT, THREAT, TARGET, NEGATION, REPORT, END, OTHER = "insult", "threat", "target", "negation", "report", "end", "other"
_HARM = (INSULT, THREAT)
_SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, END, OTHER)
_TOKENS = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: table[state, symbol] = (next state, output). State 0 is the first."""

    table: dict[tuple[int, str], tuple[int, str]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: this one's output is the other's input."""
        states, todo, table = {(0, 0): 0}, [(0, 0)], {}
        symbols = {s for _, s in self.table}
        while todo:
            a, b = pair = todo.pop()
            for symbol in symbols:
                a2, middle = self.table[a, symbol]
                b2, out = other.table[b, middle]
                if (a2, b2) not in states:
                    states[a2, b2] = len(states)
                    todo.append((a2, b2))
                table[states[pair], symbol] = (states[a2, b2], out)
        return Transducer(table)


def negation() -> Transducer:
    """Harm within SCOPE symbols after a negation is marked; the clause's end ends the scope."""
    table = {}
    for left in range(SCOPE + 1):
        for symbol in _SYMBOLS:
            after = SCOPE if symbol == NEGATION else 0 if symbol == END else max(left - 1, 0)
            out = f"not {symbol}" if symbol in _HARM and left else OTHER if symbol == NEGATION else symbol
            table[left, symbol] = (after, out)
    return Transducer(table)


def reported_speech() -> Transducer:
    """Harm that follows a verb of saying in its clause is marked."""
    table = {}
    for on in (0, 1):
        for symbol in (*_SYMBOLS, *(f"not {h}" for h in _HARM)):
            harm = symbol.removeprefix("not ") in _HARM
            after = 0 if symbol == END else 1 if symbol == REPORT else on
            table[on, symbol] = (after, f"reported {symbol}" if harm and on else OTHER if symbol == REPORT else symbol)
    return Transducer(table)


#: What the first two transducers make of harm, the strongest first.
HARMS = [f"{r}{n}{h}" for n, r in (("", ""), ("not ", ""), ("", "reported "), ("not ", "reported ")) for h in (THREAT, INSULT)]
#: How a clause's harm stands to a target: within NEAR words, elsewhere in the clause, without one.
AIMS = ("near target", "with target", "alone")
#: Kinds of clauses: strongest harm, aim, and times of that harm (INTENSE or more are the highest level).
CLAUSES = [(h, aim, times) for h in HARMS for aim in AIMS for times in range(1, INTENSE + 1)]


def clause_grammar() -> Transducer:
    """Emits a clause's kind at its end, or nothing (an empty string) for one without harm.

    A state is (strongest harm, aim of it, times, words since the last target, words since that harm);
    distances beyond NEAR are one, as nothing tells them apart.
    """
    order, far = {h: k for k, h in enumerate(HARMS)}, NEAR + 1
    first = (None, 2, 0, None, None)

    def after(state: tuple, symbol: str) -> tuple:
        harm, aim, times, target, since = state
        target = None if target is None else min(target + 1, far)
        since = None if since is None else min(since + 1, far)
        if symbol == TARGET:
            aim = aim if harm is None else 0 if since <= NEAR else min(aim, 1)
            target = 0
        elif symbol in order and (harm is None or order[symbol] < order[harm]):
            harm, times, since = symbol, 1, 0
            aim = 2 if target is None else 0 if target <= NEAR else 1
        elif symbol == harm:
            times, since = min(times + 1, INTENSE), 0
            aim = min(aim, 2 if target is None else 0 if target <= NEAR else 1)
        return harm, aim, times, target, since

    number, todo, table = {first: 0}, [first], {}
    while todo:
        state = todo.pop()
        for symbol in (*HARMS, TARGET, END, OTHER):
            to = first if symbol == END else after(state, symbol)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            harm, aim, times, *_ = state
            table[number[state], symbol] = (number[to], (harm, AIMS[aim], times) if symbol == END and harm else "")
    return Transducer(table)


def composed(negations: bool = True, reports: bool = True) -> dict:
    """Table of the transducers in a row; one that is left out passes its input on, for comparison."""
    machine = negation() if negations else _passing((*_SYMBOLS,), {NEGATION: OTHER})
    marked = (*_SYMBOLS, *(f"not {h}" for h in _HARM))
    return machine.then(reported_speech() if reports else _passing(marked, {REPORT: OTHER})).then(clause_grammar()).table


def _passing(symbols: tuple[str, ...], renamed: dict[str, str]) -> Transducer:
    return Transducer({(0, s): (0, renamed.get(s, s)) for s in symbols})


#: What is weighed: clauses of each harm; of plain harm also those with a target, a near one, and by times; their share.
FEATURES = [*HARMS, *((h, a) for h in _HARM for a in AIMS[:2]), *((h, t) for h in _HARM for t in range(2, INTENSE + 1)), "share"]
#: Signs of their weights: plain harm never lowers a score, negated or reported harm never raises one.
SIGNS = np.array([-1.0 if isinstance(f, str) and f.startswith(("not ", "reported ")) else 1.0 for f in FEATURES])
#: Texts of fewer clauses count as this many in the share.
MIN_CLAUSES = 2


@dataclass(frozen=True)
class Grammar:
    words: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    weights: tuple[float, ...] = field(default=())
    negations: bool = True
    reports: bool = True

    @cached_property
    def _machine(self) -> dict:
        return composed(self.negations, self.reports)

    @cached_property
    def _classes(self) -> dict[str, str]:
        known = {}
        for kind, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            known |= dict.fromkeys(words, kind)
        return known | dict.fromkeys((".", "!", "?", ";", ":", "\n"), END)

    def is_insult(self, word: str) -> bool:
        return word in self.words or any(word[:k] in self.stems for k in STEMS if len(word) >= k)

    def clauses(self, text: str | None) -> Counter:
        """Clauses with harm by kind, as the composed transducer emits them, and the number of all clauses under None."""
        tokens = _TOKENS.findall((text or "").lower())
        insults = {t for t in set(tokens) if self.is_insult(t)} if self.words or self.stems else set()
        counts: Counter = Counter()
        classes, machine, state, empty = self._classes, self._machine, 0, True
        for token in (*tokens, "."):
            symbol = INSULT if token in insults else classes.get(token, OTHER)
            state, out = machine[state, symbol]
            if out:
                counts[out] += 1
            if symbol == END:
                counts[None] += not empty
            empty = symbol == END
        return counts

    def features(self, text: str | None) -> list[float]:
        """See FEATURES: logarithms of clause counts by harm with aim or times, and the share of clauses with plain harm."""
        counts = self.clauses(text)
        summed: Counter = Counter()
        for kind, n in counts.items():
            if kind:
                harm, aim, times = kind
                plain = harm in _HARM
                for f in [harm, *((harm, a) for a in AIMS[:2] if plain and AIMS.index(aim) <= AIMS.index(a)),
                          *((harm, t) for t in range(2, times + 1) if plain)]:
                    summed[f] += n
        share = sum(n for kind, n in counts.items() if kind and kind[0] in _HARM) / max(counts[None], MIN_CLAUSES)
        return [*(float(np.log1p(summed[f])) for f in FEATURES[:-1]), float(np.log1p(100 * share))]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(rows @ w[1:] + w[0], -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; a null doc_id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> tuple[float, ...]:
    """Ridge logistic weights, each on its side of zero by SIGNS: Newton steps over the weights that are free, cut at zero."""
    x = np.column_stack([np.ones(len(x)), x * SIGNS])
    w, penalty = np.zeros(x.shape[1]), np.r_[1e-3, np.full(x.shape[1] - 1, ridge)]

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + (penalty * w * w).sum() / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        free = (w > 0) | (gradient < 0)
        free[0] = True
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.zeros_like(w)
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        now, size = loss(w), 1.0
        while True:
            to = w - size * step
            to[1:] = np.maximum(to[1:], 0)
            if loss(to) <= now or size < 1e-6:
                break
            size /= 2
        done, w = np.abs(to - w).max() < 1e-7, to
        if done:
            break
    return (float(w[0]), *(float(v) for v in w[1:] * SIGNS))


def learn(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, negations: bool = True, reports: bool = True
) -> Grammar:
    """Insults and weights from at most `max_labelled` labelled rows that are not held out (lowest hashes).

    An insult is a word, or a beginning of words, that MIN_TEXTS toxic texts of the sample hold and that
    is MIN_DEVIATIONS more often toxic than texts are; what is collected is a part of the sample's words.
    `negations` and `reports` leave a transducer out, for comparison. Copies of a text count once. Without toxic
    or without clean rows every text scores the share of toxic ones.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")  # at most max_labelled rows
    texts = sample.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.max("toxic").alias("toxic"))
    texts = write_table(texts, "labelled")

    @F.pandas_udf("array<string>")
    def terms(texts: pd.Series) -> pd.Series:
        def of(text: str) -> list[str]:
            words = {w for w in _WORDS.findall(text.lower()) if len(w) > 2}
            return sorted(words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k})

        return pd.Series([of(t) for t in texts], dtype=object)

    shares = texts.agg(F.avg("toxic"), F.sum("toxic"), F.count("*")).first()
    mean = float(shares[0] or 0.0)
    if not 0 < mean < 1:
        return Grammar(weights=(float(np.log((mean + 1e-6) / (1 - mean + 1e-6))), *[0.0] * len(FEATURES)))
    counted = texts.select("toxic", F.explode(terms("text")).alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    n = F.col("toxic") + F.col("clean")
    bar = F.col("toxic") - n * mean >= MIN_DEVIATIONS * F.sqrt(n * mean * (1 - mean))
    insults = counted.where(bar & (F.col("toxic") > F.col("clean")) & (F.col("toxic") >= MIN_TEXTS))
    chosen = insults.select("term").toPandas()["term"].tolist()
    whole, cut = (frozenset(t.removesuffix("*") for t in chosen if t.endswith("*") == stem) for stem in (False, True))
    grammar = Grammar(whole, cut, (), negations, reports)
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # as many words as were collected

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.features(t) for t in texts], dtype=object)

    rows = texts.select("toxic", features("text").alias("x")).toPandas()
    x, y = np.array(rows["x"].tolist(), float), rows["toxic"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # sums in the same order whatever the rows' order
    return replace(grammar, weights=_logistic(x[order], y[order]))


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5, else 0).

    Whole texts are scored, null as empty; equal texts score equally. A null doc_id is held out.
    Only `text` is looked at; labels are learned from as in learn(). Empty `docs`: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, max_labelled))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([shared.value.features(t) for t in texts], float).reshape(len(texts), -1)
        return pd.Series(shared.value.scores(rows) if len(rows) else [], dtype="float64")

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
