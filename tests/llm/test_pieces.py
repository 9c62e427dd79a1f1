import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from sigspark.llm import pieces

TEXTS = [
    None, "", " ", "  ", "Hello  world\n\tx é 你 😀", "    indented    code\n\n\n", "a" * 50, "aaaaaaa " * 9, "x" * 300, "ﬁ ① Ａ ½", "the.\nStart\r\nof ththth", "\\n\\ \\\\n back\\slash",
    "0123456789abcdef" * 40, "=" * 130 + "----====" * 20, "<0x0A> <s> </s> <unk>", "Überprüfung naïve façade " * 2000, "tion" * 20 + " " + "ing" * 40, "\x00\x01 odd", "ＨＥＬＬＯ　ｗｏｒｌｄ", " " * 33 + "end" + " " * 17,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def check(spark, library, texts):
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(1, texts[1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = pieces.encode(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.token_ids == library.encode(r.text or ""), r.text
        assert r.round_trip
    back = {r.doc_id: r.decoded for r in pieces.decode(pieces.encode(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_equals_the_library(spark, library):
    check(spark, library, TEXTS)


def test_equals_the_library_without_a_table(spark, library, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_WORDS", 3)
    check(spark, library, TEXTS)


def test_random_words(spark, library):
    rng = random.Random(4)
    syllables = ["th", "on", "tion", "er", "en", "é", "ß", "ing", "A", "Q", "z", "9", "-", "_", ".", "你"]
    texts = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 12))) for _ in range(60)) for _ in range(40)]
    check(spark, library, texts)


def test_documents(spark, library):
    got = pieces.encode(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert all(r.token_ids == library.encode(r.text) for r in got)


def test_digest(spark, library):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in pieces.encode(df, digest=True).collect():
        ids = library.encode(TEXTS[r.doc_id] or "")
        assert (r.n_tokens, r.n_byte_tokens, r.round_trip) == (len(ids), sum(3 <= i < 259 for i in ids), True)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()


def test_empty(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_round_trip_decodes_the_ids_of_the_document(monkeypatch):
    """Words that encode well but are lost, swapped or joined wrongly do not give the text back."""

    class Shared:
        vocab = pieces.Vocabulary.load()

        def get(self):
            return pieces._Words(self.vocab, {})

    texts = [None, "", "one", "one two two three", "a  b ", f"x{pieces.SPACE}y", "one one"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.nulls(len(texts), pa.list_(pa.int32())), pa.nulls(len(texts), pa.bool_())], names=["text", "token_ids", "round_trip"])
    run = lambda: [r for b in pieces._encode(iter([batch]), Shared(), "text", True, False) for r in b.column("round_trip").to_pylist()]
    keys_of = pieces.keys_of
    assert run() == [True, True, True, True, True, False, True]
    monkeypatch.setattr(pieces, "keys_of", lambda t: keys_of(t)[:-1])
    assert run() == [True, True, False, False, False, False, False]
    monkeypatch.setattr(pieces, "keys_of", lambda t: keys_of(t)[::-1])
    assert run() == [True, True, True, False, False, False, True]
