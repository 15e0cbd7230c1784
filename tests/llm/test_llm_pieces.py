"""SentencePiece BPE against the model's own library, and its pair test against merging itself."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from trailweave.llm import piece_bpe

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "   ", "a", " a", "a  b\n\tc ", "▁x", "x▁▁y", "é́ ﬁ ①", "　x", "x\0y", "<s>hi</s><unk>", "<0x41>", "🤗🤗 日本語", "= == ===", "\r\n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_bpe.MODEL))


@pytest.fixture(scope="module")
def codec():
    found = piece_bpe.codec()
    found._tables  # noqa: B018
    return found


def random_texts(codec, n: int) -> list[str]:
    r = random.Random(11)
    letters = [chr(k) for k in range(0x250)] + [" ", "  ", "▁", "\n"] * 40 + list("etaoinshrdlu") * 20 + list("日語🤗é́한ا")
    pieces, runs = list(codec.ids), ["▁", " ", "a", "aa", "  ", "e", "re", ".", "..", "---", "0", "00", "=", "=="]
    kinds = [(letters, 30), (pieces, 8), (runs, 40)]
    return ["".join(r.choice(kinds[k % 3][0]) for _ in range(r.randrange(kinds[k % 3][1]))) for k in range(n)]


def test_ids_and_text_are_those_of_the_library(codec, library):
    for text in [*ODD, *random_texts(codec, 3000)]:
        ids = codec.encode(text)
        assert ids == library.encode(text), text
        assert codec.decode(ids) == library.decode(ids), text


def test_many_texts_together_are_encoded_as_in_the_library(codec, library):
    texts = [None, *ODD, "z" * 70, "日本" * 40, *random_texts(codec, 3000), ""]
    assert list(codec.encode_all(texts)) == [library.encode(text or "") for text in texts]
    assert list(codec.encode_all([])) == []
    for ids in codec.encode_all(texts[:200]):
        assert codec.listed(ids) == ",".join(map(str, ids))


def test_little_memory_changes_no_ids(library, monkeypatch):
    for name, value in {"REMEMBERED": 5, "REMEMBERED_PAIRS": 3, "REMEMBERED_STEPS": 2, "REMEMBERED_LENGTH": 9, "MANY": 1, "MOST": 4, "TOGETHER": 50}.items():
        monkeypatch.setattr(piece_bpe, name, value)
    codec = piece_bpe.codec()
    texts = [*ODD, "un" * 20, "the theory of the thing " * 3, *ODD]
    codec.encode("")
    texts += random_texts(codec, 300)
    assert list(codec.encode_all(texts)) == [library.encode(text) for text in texts]
    assert len(codec.known) <= 5


def test_new_parts_of_many_texts_are_not_taken_one_at_a_time(library, monkeypatch):
    r, single = random.Random(14), []
    taken = piece_bpe.Codec.last_tokens
    monkeypatch.setattr(piece_bpe.Codec, "last_tokens", lambda self, part: single.append(part) or taken(self, part))
    texts = [" ".join("".join(r.choices("etaoinshrdlu", k=r.randrange(3, 12))) for _ in range(50)) for _ in range(40)]
    assert list(piece_bpe.codec().encode_all(texts)) == [library.encode(text) for text in texts]
    assert single == []


def test_any_ids_decode_as_in_the_library(codec, library):
    r = random.Random(12)
    for _ in range(3000):
        ids = [r.randrange(32000 if r.random() < 0.5 else 259) for _ in range(r.randrange(12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_pair_test_agrees_with_merging(codec):
    r, pieces = random.Random(13), list(codec.parts)
    short = [p for p in pieces if len(p) <= 3]
    for _ in range(20_000):
        a, b = r.choice(short if r.random() < 0.7 else pieces), r.choice(short if r.random() < 0.7 else pieces)
        assert codec.beside(a, b) == ([s for s, _ in codec.merged(a + b)] == [a, b]), (a, b)


def test_every_prefix_has_the_last_token_of_its_own_encoding(codec):
    for text in ["▁unbelievable▁▁▁▁▁things", "▁▁▁▁▁▁▁a", "▁aaaaaaaaaa"]:
        found = [codec.symbols[number] for number in codec.last_tokens(text)]
        assert found == [codec.merged(text[: k + 1])[-1][0] for k in range(len(text))]


@pytest.mark.parametrize("unit", [" ", "a", "=", "日", "ab\n", "the "])
def test_time_is_in_proportion_to_the_length(codec, library, unit):
    text = unit * 100_000
    assert codec.encode(text) == library.encode(text)


def test_query_columns_and_odd_rows(spark, library):
    rows = [(k, text, "x") for k, text in enumerate(ODD)] + [(0, "a", "y"), (0, "a", "y"), (None, None, None), (7, "w" * 50_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumn("ids", F.lit("clash"))
    found = sorted((tuple(r) for r in piece_bpe.round_trip(docs).collect()), key=str)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "")
        wanted.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert found == sorted(wanted, key=str)
    assert piece_bpe.round_trip(docs.limit(0)).collect() == []


def test_ids_as_a_column_and_back(spark, library):
    docs = spark.createDataFrame([(1, "ab  c"), (2, None), (3, "日x")], "doc_id long, text string")
    found = {r.doc_id: r for r in piece_bpe.decode(piece_bpe.encode(docs)).collect()}
    assert {k: (r.ids, r.decoded) for k, r in found.items()} == {
        1: (library.encode("ab  c"), "ab  c"), 2: ([], ""), 3: (library.encode("日x"), "日x"),
    }


def test_whole_documents_of_the_test_tables(spark, library):
    from trailweave.llm.queries import op11_piece_bpe

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op11_piece_bpe(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_other_kinds_of_model_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto.FromString(open(public_tokenizers.path(piece_bpe.MODEL), "rb").read())
    spec.trainer_spec.byte_fallback = False
    path = tmp_path / "other.model"
    path.write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError):
        piece_bpe.codec(str(path))
