"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces of the product of their
probabilities, which a forward pass over the word's characters adds up. A text is given the
language under which its words are likeliest. Piece probabilities are fitted by expectation
maximisation, with the matching backward pass, to word counts of labelled documents.

Words of a batch go through the passes together, as arrays; each Python worker remembers the
scores of a bounded number of words.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

VOCABULARY = "piece_bpe_32k.model"
#: Labelled documents learned from at most, by language; those whose doc_id hashes lowest.
MAX_DOCS = 400
#: Different words learned from at most, by language; the most frequent ones.
MAX_WORDS = 20_000
ROUNDS = 4
#: Words that go through the passes together.
GROUP = 4096
#: Longer words are learned from in stretches of so many characters, and scored one by one.
STRETCH = 40
#: Bytes of scores that a worker remembers at most, and the longest words among them.
REMEMBERED, REMEMBERED_LENGTH = 10_000_000, 64
#: Probability of a character that is no piece of its own; share of the uniform distribution in every language's.
UNKNOWN, SMOOTHING = 1e-7, 1e-3

#: Letters are what Unicode calls so; number signs such as fractions and Roman numerals are none.
_WORDS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORDS.findall((text or "").lower())


def stretches_of(text: str | None) -> list[str]:
    """Words as they are learned from: long ones cut."""
    return [w[i : i + STRETCH] for w in words_of(text) for i in range(0, len(w), STRETCH)]


def public_pieces(vocabulary: str | None = None) -> list[str]:
    """Lower-cased pieces of the vocabulary without word marks: those made of letters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary or public_tokenizers.path(VOCABULARY))
    pieces = {model.id_to_piece(i).replace("▁", "").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if _WORDS.fullmatch(p))


class _Trie:
    """The pieces as arrays, so that all words of a list are matched against them at once.

    Piece numbers: those of `pieces`, then len(pieces) for an unknown character, then one for no piece.
    """

    def __init__(self, pieces: list[str]):
        self.unknown, self.none = len(pieces), len(pieces) + 1
        letters = sorted({c for p in pieces if len(p) > 1 for c in p})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece of several characters
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.single = np.full(0x110000, self.unknown, np.int32)
        children: dict[tuple[int, str], int] = {}
        piece_of = [self.none, self.none]  # node 0 is dead, node 1 the root
        for number, piece in enumerate(pieces):
            node = 1
            for c in piece:
                if (node, c) not in children:
                    children[node, c] = len(piece_of)
                    piece_of.append(self.none)
                node = children[node, c]
            piece_of[node] = number
            if len(piece) == 1:
                self.single[ord(piece)] = number
        self.piece_of = np.array(piece_of, np.int32)
        self.child = np.zeros((len(piece_of), len(letters) + 1), np.int32)
        for (node, c), after in children.items():
            if self.letter[ord(c)]:
                self.child[node, self.letter[ord(c)]] = after

    def spans(self, words: list[str]):
        """For each start and length of a piece: (start, length, piece number of every word)."""
        longest = max(map(len, words))
        padded = "".join([w.ljust(longest, "\0") for w in words]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(padded, np.uint32).reshape(len(words), longest).T
        letter, single = self.letter[codes], self.single[codes]
        for i in range(longest):
            yield i, 1, single[i]
            node = self.child[1, letter[i]]
            for k in range(2, longest - i + 1):
                node = self.child[node, letter[i + k - 1]]
                if not node.any():
                    break
                yield i, k, self.piece_of[node]


def _forward(spans, p: np.ndarray, n_words: int, longest: int) -> np.ndarray:
    """alpha[position, word, language]: summed probability of all segmentations of the beginnings."""
    alpha = np.zeros((longest + 1, n_words, p.shape[1]))
    alpha[0] = 1
    for i, k, piece in spans:
        alpha[i + k] += alpha[i] * p[piece]
    return alpha


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    p: np.ndarray  # of piece, language; the last two rows: unknown character, no piece
    trie: _Trie = field(init=False, repr=False)

    def __post_init__(self):
        self.trie = _Trie(self.pieces)
        self.known: dict[str, int] = {}
        self.used = 0
        self.scores = np.zeros((0, len(self.languages)))

    def __reduce__(self):
        return Model, (self.languages, self.pieces, self.p)

    def long_score(self, word: str) -> np.ndarray:
        """Logarithm of a word's probability by language, however long it is.

        Of the forward pass only the sums that a piece may still reach from are held; each step
        divides them by the one it leaves from, so that none becomes too small.
        """
        trie, ahead = self.trie, np.zeros((max(map(len, self.pieces), default=1) + 1, len(self.languages)))
        codes = [ord(c) for c in word]
        letter, total = trie.letter[codes], np.zeros(len(self.languages))
        ahead[0] = 1
        for i, code in enumerate(codes):
            total += np.log(ahead[0])
            ahead[1:] /= ahead[0]
            ahead[1] += self.p[trie.single[code]]
            node, k = trie.child[1, letter[i]], 2
            while node and i + k <= len(codes):
                node = trie.child[node, letter[i + k - 1]]
                if node and (piece := trie.piece_of[node]) != trie.none:
                    ahead[k] += self.p[piece]
                k += 1
            ahead[:-1] = ahead[1:]
            ahead[-1] = 0
        return total + np.log(ahead[0])

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Logarithms of the words' probabilities, by language."""
        out = np.empty((len(words), len(self.languages)))
        for k, w in enumerate(words):
            if len(w) > STRETCH:
                out[k] = self.long_score(w)
        by_length = sorted((k for k, w in enumerate(words) if len(w) <= STRETCH), key=lambda k: len(words[k]))
        for at in range(0, len(words), GROUP):  # words of like length together, so that few cells stay empty
            some = by_length[at : at + GROUP]
            group = [words[k] for k in some]
            length = np.fromiter(map(len, group), np.int64, len(group))
            alpha = _forward(self.trie.spans(group), self.p, len(group), int(length.max()))
            out[some] = np.log(alpha[length, np.arange(len(group))] + 1e-300)
        return out

    def text_scores(self, texts: list[str | None]) -> np.ndarray:
        """Summed logarithms by text and language; texts without letters have zeros."""
        counted = [Counter(words_of(t)) for t in texts]
        new = {w for c in counted for w in c}.difference(self.known)
        most = REMEMBERED // (8 * max(len(self.languages), 1))
        if self.used + len(new) > max(most, len(self.scores)):
            self.known, self.used, new = {}, 0, {w for c in counted for w in c}
        if self.used + len(new) > len(self.scores):
            grown = np.empty((max(self.used + len(new), min(2 * len(self.scores), most)), len(self.languages)))
            grown[: self.used] = self.scores[: self.used]
            self.scores = grown
        end = self.used + len(new)
        self.known.update(zip(new, range(self.used, end)))
        self.scores[self.used : end] = self.word_scores(list(new))
        self.used = end
        out = np.zeros((len(texts), len(self.languages)))
        for k, c in enumerate(counted):
            if c:
                rows = np.fromiter(map(self.known.__getitem__, c), np.int64, len(c))
                out[k] = np.fromiter(c.values(), np.float64, len(c)) @ self.scores[rows]
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del self.known[w]
        return out


def fit_pieces(counts: dict[str, dict[str, int]], pieces: list[str], rounds: int = ROUNDS) -> Model:
    """Expectation maximisation over all segmentations of the counted words; counts[language][word]."""
    languages = sorted(counts)
    words = sorted({w for c in counts.values() for w in c}, key=lambda w: (len(w), w))
    n, k = len(pieces), len(languages)
    uniform = np.concatenate([np.full(n, (1 - UNKNOWN) / max(n, 1)), [UNKNOWN, 0.0]])[:, None]
    p = np.repeat(uniform, k, axis=1)
    if not words:
        return Model([], pieces, p[:, :0])
    trie = _Trie(pieces)
    weight = np.array([[counts[c].get(w, 0) for c in languages] for w in words], float).reshape(-1, k)
    for _ in range(rounds):
        expected = np.zeros_like(p)
        for first in range(0, len(words), GROUP):
            group = words[first : first + GROUP]
            spans = list(trie.spans(group))
            length, at = np.fromiter(map(len, group), np.int64, len(group)), np.arange(len(group))
            alpha = _forward(spans, p, len(group), int(length.max()))
            beta = np.zeros_like(alpha)
            beta[length, at] = weight[first : first + GROUP] / np.maximum(alpha[length, at], 1e-300)
            for i, size, piece in reversed(spans):
                through = beta[i + size] * p[piece]
                # words that end here have their own value, and pieces beyond their end none
                beta[i] += through * (i < length)[:, None]
                for c in range(k):
                    expected[:, c] += np.bincount(piece, through[:, c] * alpha[i, :, c], n + 2)
        expected[n:] = 0
        share = expected / np.maximum(expected.sum(0), 1e-300)
        p = (1 - SMOOTHING) * share * (1 - UNKNOWN) + SMOOTHING * uniform
        p[n:] = [[UNKNOWN], [0.0]]
    return Model(languages, pieces, p)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; a null doc_id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def learn(docs: DataFrame, vocabulary: str | None = None, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS) -> Model:
    """Piece probabilities by language, from text and non-null lang of documents that are not held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    lowest = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # ranks beyond the bound are cut within each task, before rows of a language meet
    chosen = usable.select("lang", "doc_id").withColumn("rank", F.row_number().over(lowest)).where(F.col("rank") <= max_docs)
    sample = usable.select("lang", "doc_id", "text").join(F.broadcast(chosen.select("lang", "doc_id").distinct()), ["lang", "doc_id"])

    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return pd.Series([stretches_of(t) for t in texts], dtype=object)

    counted = write_table(sample.select("lang", F.explode(words("text")).alias("word")).groupBy("lang", "word").count(), "words")
    most = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    top = counted.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= max_words)
    counts: dict[str, dict[str, int]] = {}
    for row in top.select("lang", "word", "count").toPandas().itertuples(index=False):
        counts.setdefault(row[0], {})[row[1]] = int(row[2])
    return fit_pieces(counts, public_pieces(vocabulary))


def languages(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (probability of lang_pred, 0 to 1).

    Whole texts are scored. A text that is null or has no letters is `und` with score 0, as is
    every text if no language could be learned. Only `text` is looked at for a prediction; a null
    doc_id is held out. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, vocabulary))  # pieces times languages

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model, rows = shared.value, []
        for at in range(0, len(texts), 500):
            some = texts.iloc[at : at + 500].tolist()
            scores = model.text_scores(some) if model.languages else [None] * len(some)
            for text, s in zip(some, scores):
                if s is None or not text or not _WORDS.search(text):
                    rows.append(("und", 0.0))
                else:
                    best = int(np.argmax(s))
                    rows.append((model.languages[best], float(1 / np.exp(s - s[best]).sum())))
        return pd.DataFrame(rows, columns=["lang_pred", "score"])

    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
