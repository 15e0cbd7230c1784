"""Byte-pair encoding over SentencePiece models: encoding and decoding with a public model file.

White space becomes U+2581 and one is put before the text. Of every prefix of the text, the last
token of its encoding is unique: among the pieces that an automaton finds to end there, it is the
one that begins where another prefix ends and that stands unmerged after that prefix's last token.
So one pass forward stores a token for each prefix, and one pass backward reads the ids off; no
merge is carried out on the text. Whether two tokens may stand side by side is read from the
merges that make each of them: they may unless a merge across their border comes first.

Text is cut where no piece can reach over, and each Python worker remembers the ids of a bounded
number of such parts. The parts that some texts bring anew take both passes side by side, character
by character; long ones and few take them one at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Parts that a worker remembers at most, beside those of the texts at hand, and pairs of tokens of
#: parts taken one at a time; some 50 and 20 MB.
REMEMBERED = 150_000
#: Pairs and steps of the automaton of parts taken side by side, as powers of two; 25 and 3 MB.
REMEMBERED_PAIRS, REMEMBERED_STEPS = 21, 18
#: Longer parts are not remembered, and taken one at a time.
REMEMBERED_LENGTH = 64
#: Fewer new parts are taken one at a time, and no more than so many side by side.
MANY, MOST = 200, 50_000
#: Characters of the texts that are encoded together, at least, if there are as many.
TOGETHER = 300_000
#: What the model file calls the kinds of its pieces.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_TEXT = " ⁇ "


class Remembered:
    """What `find` says of a number, for many at once; each has one slot, which it may lose to another."""

    def __init__(self, find: Callable[[int], int], power: int):
        self.find, self.shift = find, np.uint64(64 - power)
        self.numbers, self.answers = np.full(1 << power, -1, np.int64), np.zeros(1 << power, np.int32)

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        slots = (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        answers = self.answers[slots]
        missed = np.flatnonzero(self.numbers[slots] != numbers)
        if len(missed):
            fresh, first, place = np.unique(numbers[missed], return_index=True, return_inverse=True)
            found = np.fromiter(map(self.find, fresh.tolist()), np.int32, len(fresh))
            answers[missed] = found[place]
            slots = slots[missed[first]]
            self.numbers[slots], self.answers[slots] = fresh, found
        return answers


class Automaton:
    """The beginnings of words as states: a character leads to the longest end of the text that is one too."""

    def __init__(self, words: list[str]):
        self.steps: list[dict[str, int]] = [{}]
        #: by state: the state of its longest own end, and the number (from 1 on) of the longest word that ends there
        self.shorter, self.ends = [0], [0]
        #: by word: the longest other one that ends where it does, or 0
        self.within = [0] * (len(words) + 1)
        above = [(0, "")]
        for number, word in enumerate(words, 1):
            state = 0
            for c in word:
                below = self.steps[state].get(c)
                if below is None:
                    below = self.steps[state][c] = len(self.steps)
                    above.append((state, c))
                    self.steps.append({})
                    self.shorter.append(0)
                    self.ends.append(0)
                state = below
            self.ends[state] = number
        level = [*self.steps[0].values()]
        while level:
            for state in level:
                over, c = above[state]
                self.shorter[state] = self.after(self.shorter[over], c) if over else 0
                shorter = self.ends[self.shorter[state]]
                if self.ends[state]:
                    self.within[self.ends[state]] = shorter
                else:
                    self.ends[state] = shorter
            level = [below for state in level for below in self.steps[state].values()]

    def after(self, state: int, c: str) -> int:
        while (found := self.steps[state].get(c)) is None:
            if not state:
                return 0
            state = self.shorter[state]
        return found


class Codec:
    """Encodes and decodes as the model's own library does, without begin or end ids."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], prefixed: bool):
        self.pieces, self.scores, self.kinds, self.prefixed = pieces, scores, kinds, prefixed

    def __reduce__(self):
        return Codec, (self.pieces, self.scores, self.kinds, self.prefixed)

    @cached_property
    def _tables(self) -> None:
        normal = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        self.ids = {self.pieces[i]: i for i in normal}
        # equal scores share a rank: then the leftmost merge comes first
        ranks = {score: rank for rank, score in enumerate(sorted({self.scores[i] for i in normal}, reverse=True))}
        self.rank = {self.pieces[i]: ranks[self.scores[i]] for i in normal}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i, kind in enumerate(self.kinds) if kind == BYTE}
        # the bytes that each id stands for
        self.raw = [self._raw(piece, kind) for piece, kind in zip(self.pieces, self.kinds, strict=True)]
        # the two symbols that a piece is merged from; pieces that no merge leads to never come out
        self.parts = {piece: parts for piece in self.ids if (parts := self._made_of(piece))}
        symbols = {*self.parts, *chain.from_iterable(self.ids)}
        self.rights = {symbol: self._edge(symbol, 1) for symbol in symbols}
        self.lefts = {symbol: self._edge(symbol, 0) for symbol in symbols}
        # numbers for the pass forward: a symbol's own, from 1 on
        self.symbols = ["", *self.rights]
        self.automaton = Automaton(self.symbols[1:])
        self.numbers = [self._ids_of(symbol) for symbol in self.symbols]
        self.lengths = [len(symbol) for symbol in self.symbols]
        self.shared = [*range(len(self.pieces))]  # one object for an id, wherever it is remembered
        self.written = [str(i) for i in range(len(self.pieces))]
        # the same as arrays, for many parts at once; -1 for symbols that are no piece
        self.letters = ["", *sorted({*chain.from_iterable(symbols)})]
        self.letter_of = np.zeros(0x110000, np.int32)
        self.letter_of[[ord(c) for c in self.letters[1:]]] = range(1, len(self.letters))
        self.only = np.array([n[0] if len(n) == 1 else -1 for n in self.numbers], np.int32)
        self.length, self.ends, self.within = (
            np.array(x, np.int32) for x in (self.lengths, self.automaton.ends, self.automaton.within)
        )
        self.cut = next(cut for cut in self._cuts() if all(map(cut.fullmatch, self.ids)))
        self.known: dict[str, tuple[int, ...]] = {}
        self.asked: dict[int, bool] = {}
        self.pairs, self.steps = Remembered(self._pair, REMEMBERED_PAIRS), Remembered(self._step, REMEMBERED_STEPS)

    @staticmethod
    def _raw(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b"\xff"  # no text: it parts the bytes beside it
        return (UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(SPACE, " ")).encode("utf-8")

    def _cuts(self) -> Iterator[re.Pattern]:
        """Ways to cut a text, from fine to coarse; one serves if no piece reaches over its parts.

        Parts are letters or other characters, each with the spaces before; then all but spaces;
        then the whole text.
        """
        signs = "".join(sorted({c for c in chain.from_iterable(self.ids) if c.isalnum() and not c.isalpha()}))
        letters, others = rf"[^\W\d_{re.escape(signs)}]+", rf"(?:[^\w{SPACE}]|[\d_{re.escape(signs)}])+"
        yield re.compile(f"{SPACE}*(?:{letters}|{others})|{SPACE}+")
        yield re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        yield re.compile("(?s:.+)")

    def merged(self, text: str) -> list[tuple[str, tuple[str, str] | None]]:
        """The symbols that merging by rank leaves of a short text, each with the last two parts it was made of."""
        symbols: list[str | None] = list(text)
        made: list[tuple[str, str] | None] = [None] * len(symbols)
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        queue: list[tuple[int, int, str, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (rank := self.rank.get(symbols[left] + symbols[right])) is not None:
                heapq.heappush(queue, (rank, left, symbols[left], symbols[right]))

        for at in range(len(symbols) - 1):
            offer(at, at + 1)
        while queue:
            _, at, left, right = heapq.heappop(queue)
            if symbols[at] != left or after[at] < 0 or symbols[after[at]] != right:
                continue
            gone = after[at]
            symbols[at], made[at], symbols[gone] = left + right, (left, right), None
            after[at] = after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            offer(at, after[at])
            offer(before[at], at)
        return [(s, made[at]) for at, s in enumerate(symbols) if s is not None]

    def _made_of(self, piece: str) -> tuple[str, ...]:
        """The parts of the last merge, the character itself, or nothing if merging never leads to the piece."""
        if len(piece) == 1:
            return (piece,)
        left = self.merged(piece)
        return left[0][1] if len(left) == 1 else ()

    def _edge(self, piece: str, side: int) -> list[tuple[str, int, float]]:
        """The symbols that stand at the piece's left (0) or right (1) end one after the other.

        Each with the rank of the merge that makes it and of the merge that uses it up.
        """
        found, until = [], float("inf")
        while True:
            parts = self.parts.get(piece, ())
            since = self.rank[piece] if len(parts) == 2 else -1
            found.append((piece, since, until))
            if len(parts) != 2:
                return found
            piece, until = parts[side], since

    def beside(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart: no merge over their border comes before those inside.

        At equal ranks, merges within the left token come before one over the border, and this one
        before those within the right token.
        """
        for a, a_since, a_until in self.rights[left]:
            for b, b_since, b_until in self.lefts[right]:
                if b_since < a_until and a_since <= b_until:
                    rank = self.rank.get(a + b)
                    if rank is not None and rank < a_until and rank <= b_until:
                        return False
        return True

    def _pair(self, pair: int) -> bool:
        return self.beside(self.symbols[pair >> 32], self.symbols[pair & 0xFFFFFFFF])

    def _step(self, step: int) -> int:
        return self.automaton.after(step >> 32, self.letters[step & 0xFFFFFFFF])

    def last_tokens(self, text: str) -> list[int]:
        """The number of the last token of the encoding of each prefix; 0 for a character that no piece holds."""
        last, state, asked, symbols = [0], 0, self.asked, self.symbols  # `last` by length of the prefix
        steps, ends, within, lengths = self.automaton.steps, self.automaton.ends, self.automaton.within, self.lengths
        for end, c in enumerate(text, 1):
            below = steps[state].get(c)
            state = self.automaton.after(state, c) if below is None else below
            number = ends[state]
            while number and (before := last[end - lengths[number]]):
                pair = before << 32 | number
                beside = asked.get(pair)
                if beside is None:
                    beside = asked[pair] = self.beside(symbols[before], symbols[number])
                if beside:
                    break  # of the pieces that end here exactly one fits
                number = within[number]
            last.append(number)
        if len(asked) > REMEMBERED:
            asked.clear()
        del last[0]
        return last

    def _last_tokens(self, parts: list[str], lengths: np.ndarray) -> np.ndarray:
        """The same for many parts, longest first: by length of the prefix and by part."""
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter_of[codes].astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        last = np.zeros((lengths[0] + 1, len(parts)), np.int32)
        state = np.zeros(len(parts), np.int32)
        for end in range(1, lengths[0] + 1):
            reach = np.searchsorted(-lengths, -end, "right")  # so many are as long
            state = self.steps(state[:reach].astype(np.int64) << 32 | letters[starts[:reach] + end - 1])
            number = self.ends[state]
            at = np.flatnonzero(number)
            number = number[at]
            while len(at):
                before = last[end - self.length[number], at]
                fits = before == 0
                asked = np.flatnonzero(~fits)
                fits[asked] = self.pairs(before[asked].astype(np.int64) << 32 | number[asked])
                last[end, at[fits]] = number[fits]
                at, number = at[~fits], self.within[number[~fits]]
                at, number = at[number > 0], number[number > 0]
        return last

    def _ids_of(self, symbol: str) -> tuple[int, ...]:
        """The id of a piece, or those of the bytes of a character that is none; last one first."""
        number = self.ids.get(symbol)
        return (number,) if number is not None else tuple(self.bytes[b] for b in reversed(symbol.encode("utf-8")))

    def _part(self, part: str) -> tuple[int, ...]:
        if part in self.parts:
            return (self.ids[part],)
        last, lengths, numbers = self.last_tokens(part), self.lengths, self.numbers
        at, found = len(part) - 1, []
        while at >= 0:
            number = last[at]
            if number:
                found += numbers[number]
                at -= lengths[number]
            else:
                found += self._ids_of(part[at])
                at -= 1
        found.reverse()
        return tuple(found)

    def _parts(self, parts: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The ids of many different parts."""
        parts = sorted(parts, key=len, reverse=True)
        long = next((k for k, part in enumerate(parts) if len(part) <= REMEMBERED_LENGTH), len(parts))
        if len(parts) - long < MANY:
            long = len(parts)
        found = {part: self._part(part) for part in parts[:long]}
        for k in range(long, len(parts), MOST):
            found |= self._side_by_side(parts[k : k + MOST])
        return found

    def _side_by_side(self, parts: list[str]) -> dict[str, tuple[int, ...]]:
        """The ids of parts, longest first."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        last = self._last_tokens(parts, lengths)
        # backwards: the last tokens of all parts, then those before them
        at, part, rounds = lengths, np.arange(len(parts)), []
        while len(part):
            number = last[at, part]
            rounds.append((part, self.only[number]))
            at = at - np.maximum(self.length[number], 1)
            at, part = at[at > 0], part[at > 0]
        of, ids = (np.concatenate(x) for x in zip(*reversed(rounds), strict=True))
        ends, in_order = np.cumsum(np.bincount(of)).tolist(), ids[np.argsort(of, kind="stable")]
        flat = tuple(map(self.shared.__getitem__, in_order.tolist()))
        found = {part: flat[a:b] for part, a, b in zip(parts, [0, *ends[:-1]], ends, strict=True)}
        for k in {*of[ids < 0].tolist()}:  # letters that are no piece give bytes
            found[parts[k]] = self._part(parts[k])
        return found

    def encode(self, text: str | None) -> list[int]:
        """Ids of the whole text; null counts as empty, and empty text has none."""
        return self._together([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text; some texts are encoded together."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= TOGETHER:
                yield from self._together(some)
                some, size = [], 0
        yield from self._together(some)

    def _together(self, texts: list[str | None]) -> list[list[int]]:
        self._tables  # noqa: B018
        before = SPACE if self.prefixed else ""
        cut = [self.cut.findall(before + text.replace(" ", SPACE)) if text else [] for text in texts]
        known = self.known
        fresh = self._parts({*chain.from_iterable(cut)}.difference(known))
        known.update(fresh)
        found = [list(chain.from_iterable(map(known.__getitem__, parts))) for parts in cut]
        for part in fresh:
            if len(part) <= REMEMBERED_LENGTH:
                break  # the long ones come first
            del known[part]
        if len(known) > REMEMBERED:
            known.clear()
        return found

    def listed(self, ids: list[int]) -> str:
        """The ids in decimal, joined by commas."""
        self._tables  # noqa: B018
        return ",".join(map(self.written.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: bytes are put together, others that form no character become U+FFFD each."""
        self._tables  # noqa: B018
        try:
            text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8")
        except UnicodeDecodeError:  # control pieces, or bytes that form no character
            return self._mended(ids)
        # of the first piece, one space is what encoding had put there
        strip = self.prefixed and ids and self.kinds[ids[0]] == NORMAL and self.pieces[ids[0]][0] == SPACE
        return text[1:] if strip else text

    def _mended(self, ids: list[int]) -> str:
        found: list[str] = []
        raw = bytearray()
        first = self.prefixed
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                raw.append(int(self.pieces[i][1:-1], 16))
                first = False
                continue
            if raw:
                found.append(_text_of(raw))
                raw.clear()
            if kind == CONTROL:
                continue
            piece = UNKNOWN_TEXT if kind == UNKNOWN else self.pieces[i]
            if first and kind == NORMAL and piece.startswith(SPACE):
                piece = piece[1:]
            first = False
            found.append(piece.replace(SPACE, " "))
        if raw:
            found.append(_text_of(raw))
        return "".join(found)


def _text_of(raw: bytearray) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        pass
    found, at = [], 0
    while at < len(raw):
        for length in (1, 2, 3, 4):
            try:
                found.append(raw[at : at + length].decode("utf-8"))
                at += length
                break
            except UnicodeDecodeError:
                continue
        else:
            found.append("�")
            at += 1
    return "".join(found)


def codec(model: str | None = None) -> Codec:
    """The codec of a model file; `model` is its path, by default that of the public one.

    The model must be a BPE one with byte pieces, leave text as it is but for white space, and have
    no pieces of the user's own or unused ones; another one is refused with ValueError.
    """
    from sentencepiece import sentencepiece_model_pb2  # on the driver alone

    with open(model or public_tokenizers.path(MODEL), "rb") as file:
        spec = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    text, trained = spec.normalizer_spec, spec.trainer_spec
    plain = not text.precompiled_charsmap and not text.remove_extra_whitespaces and text.escape_whitespaces
    kinds = [p.type for p in spec.pieces]
    if trained.model_type != 2 or not trained.byte_fallback or not plain or trained.treat_whitespace_as_suffix:
        raise ValueError("not a BPE model with byte pieces and plain text")
    if not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("the model has pieces of the user's own or unused ones")
    return Codec([p.piece for p in spec.pieces], [p.score for p in spec.pieces], kinds, text.add_dummy_prefix)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _shared(spark: SparkSession, model: str | None):
    """The codec on the executors, which need no file: the pieces are about 1 MB."""
    return spark.sparkContext.broadcast(codec(model))


def encode(docs: DataFrame, model: str | None = None, name: str = "ids") -> DataFrame:
    """`docs` with the ids of the whole text as array<int>; null or empty text has none.

    Every row is encoded for itself; an empty table stays empty. `name` replaces a column of that name.
    """
    shared = _shared(docs.sparkSession, model)

    @F.pandas_udf("array<int>")
    def ids_of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(ids, np.int32) for ids in shared.value.encode_all(texts)], dtype=object)

    return docs.withColumn(name, ids_of("text"))


def decode(rows: DataFrame, ids: str = "ids", model: str | None = None, name: str = "decoded") -> DataFrame:
    """`rows` with the text of the ids, which replaces a column called `name`; null ids give the empty text."""
    shared = _shared(rows.sparkSession, model)

    @F.pandas_udf("string")
    def text_of(lists: pd.Series) -> pd.Series:
        return pd.Series([shared.value.decode([] if i is None else [*i]) for i in lists], dtype=object)

    return rows.withColumn(name, text_of(ids))


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes and decodes each whole text where it lies and returns digests of both outputs only.
    Null or empty text: no tokens. Repeated rows each have their row; a null doc_id stays null.
    Other columns of `docs`, whatever they are called, are not read.
    """
    shared = _shared(docs.sparkSession, model)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def trip(texts: pd.Series) -> pd.DataFrame:
        rows, codec = [], shared.value
        for ids in codec.encode_all(texts):
            rows.append((len(ids), _digest(codec.listed(ids)), _digest(codec.decode(ids))))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", trip("text").alias("trip")).select("doc_id", "trip.*")
