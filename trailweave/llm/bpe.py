"""Byte-level BPE with word ends: encoding and decoding with a public vocabulary file.

Text is brought to NFC, lower-cased and split into words. A word's symbols form a doubly linked
list; candidate merges wait in a priority queue by rank and place, and an entry whose symbols
have changed meanwhile is skipped. Decoding joins the vocabulary strings of the ids.

Words repeat, so each Python worker remembers the ids of a bounded number of them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
#: Words that a worker remembers at most; about 50 MB.
REMEMBERED = 150_000
#: Longer words are not remembered.
REMEMBERED_LENGTH = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


#: Columns that tokenized() adds.
ADDED = {"ids": "array<int>", "n_tokens": "long", "decoded_sha256": "string"}
TEXTS_AT_ONCE = 200


class Codec:
    """Encodes and decodes as the vocabulary file's own library does, without special tokens being added."""

    def __init__(self, spec: str):
        self.spec = spec

    def __reduce__(self):
        return Codec, (self.spec,)

    @cached_property
    def _tables(self) -> None:
        file = json.loads(self.spec)
        model = file["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        ids = self.vocab
        # (left id, right id): (rank, merged id)
        self.merges = {
            (ids[a], ids[b]): (rank, ids[a + b])
            for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        }
        symbols = byte_symbols()
        self.inner = [ids[s] for s in symbols]
        self.last = [ids[s + self.end] for s in symbols]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.token = {i: t for t, i in (ids | self.special).items()}
        split = next(p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        self.marks = tuple(longest_first)
        self.known: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        n, merges = len(ids), self.merges
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for at, pair in enumerate(zip(ids, ids[1:])):
            if (found := merges.get(pair)) is not None:
                queue.append((found[0], at, found[1], pair))
        heapq.heapify(queue)
        while queue:
            _, at, merged, pair = heapq.heappop(queue)
            after = right[at]
            if after < 0 or (ids[at], ids[after]) != pair:
                continue  # stale: one of the two has been merged
            ids[at], ids[after] = merged, -1
            right[at] = beyond = right[after]
            right[after] = -1
            if beyond >= 0:
                left[beyond] = at
                if (found := merges.get((merged, ids[beyond]))) is not None:
                    heapq.heappush(queue, (found[0], at, found[1], (merged, ids[beyond])))
            before = left[at]
            if before >= 0 and (found := merges.get((ids[before], merged))) is not None:
                heapq.heappush(queue, (found[0], before, found[1], (ids[before], merged)))
        return tuple(i for i in ids if i >= 0)

    def _plain(self, text: str) -> list[int]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: characters one by one
        known, words, long = self.known, self.words.findall(text.lower()), []
        for w in words:
            if w not in known:
                known[w] = self.word(w)
                if len(w) > REMEMBERED_LENGTH:
                    long.append(w)
        ids = list(chain.from_iterable(map(known.__getitem__, words)))
        for w in long:
            del known[w]
        if len(known) > REMEMBERED:
            known.clear()
        return ids

    def encode(self, text: str | None) -> list[int]:
        self._tables  # noqa: B018
        text = text or ""
        if not any(m in text for m in self.marks):
            return self._plain(text)
        parts = self.specials.split(text)
        return list(
            chain.from_iterable([self.special[p]] if k % 2 else self._plain(p) for k, p in enumerate(parts) if p)
        )

    def decode(self, ids: list[int]) -> str:
        self._tables  # noqa: B018
        token = self.token
        return " ".join([token[i] for i in ids])


def codec(vocabulary: str | None = None) -> Codec:
    """The codec of a vocabulary file; `vocabulary` is its path, by default that of the public one."""
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return Codec(file.read())


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _shared(df: DataFrame, vocabulary: str | None):
    """The codec on the executors, which need no file: the vocabulary is about 2 MB."""
    return df.sparkSession.sparkContext.broadcast(codec(vocabulary))


def encode(docs: DataFrame, vocabulary: str | None = None, name: str = "ids") -> DataFrame:
    """`docs` with the ids of the whole text as array<int>; null or empty text has none.

    Every row is encoded for itself; an empty table stays empty. `name` replaces a column of that name.
    """
    shared = _shared(docs, vocabulary)

    @F.pandas_udf("array<int>")
    def ids_of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(shared.value.encode(t), np.int32) for t in texts], dtype=object)

    return docs.withColumn(name, ids_of("text"))


def decode(rows: DataFrame, ids: str = "ids", vocabulary: str | None = None, name: str = "decoded") -> DataFrame:
    """`rows` with the text of the ids, special tokens included; null ids give the empty text."""
    shared = _shared(rows, vocabulary)

    @F.pandas_udf("string")
    def text_of(lists: pd.Series) -> pd.Series:
        return pd.Series([shared.value.decode([] if i is None else i) for i in lists], dtype=object)

    return rows.withColumn(name, text_of(ids))


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes and decodes each whole text where it lies and returns digests of both outputs only.
    Null or empty text: no tokens. Other columns of `docs` are not read.
    """
    shared = _shared(docs, vocabulary)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def trip(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            ids = shared.value.encode(text)
            rows.append((len(ids), _digest(" ".join(map(str, ids))), _digest(shared.value.decode(ids))))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", trip("text").alias("trip")).select("doc_id", "trip.*")


def tokenized(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """`docs` with ids (array<int>), n_tokens and decoded_sha256, each replacing a column of its name.

    Texts are taken a few at a time from what Spark hands over, so that a worker never holds the
    strings and ids of a whole batch.
    """
    shared = _shared(docs, vocabulary)
    own = docs.drop("ids", "n_tokens", "decoded_sha256")
    empty = own.limit(0).select("*", *[F.lit(None).cast(t).alias(n) for n, t in ADDED.items()])
    at_text = own.columns.index("text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(first, TEXTS_AT_ONCE)
                ids, ends, digests = array("i"), [0], []
                for text in part.column(at_text):
                    found = shared.value.encode(text.as_py())
                    digests.append(_digest(shared.value.decode(found)))
                    ids.extend(found)
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32), pa.int32()))
                added = [lists, pa.array(np.diff(ends), pa.int64()), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *ADDED])

    return own.mapInArrow(encoded, empty.schema)
