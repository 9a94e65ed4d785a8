"""Encoding equals the tokenizers library id for id; decoding gives the text back."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from veritab.llm import bpe, queries

LIBRARY = Tokenizer.from_file(queries.vocabulary_path())
OWN = bpe.ByteBpe(bpe.read_vocabulary(queries.vocabulary_path()))


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    packed = OWN.encode(text)
    assert packed == np.array(ids, "<u4").tobytes(), repr(text)
    assert OWN.decode(packed).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


def test_white_space_specials_and_long_words():
    rnd = random.Random(5)
    letters = " \n\t　 aé'strelvdm019.,!ß中🙂́\x85\x1c"
    for _ in range(3000):
        same("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))))
    for text in ("<|endoftext|>", " <|endoftext|> a<|endoftext|>", "a" * 4000, "\n" * 500, "ab " * 3, "", "日本語" * 300):
        same(text)


def test_decoding_broken_utf8():
    ids = [LIBRARY.encode("é", add_special_tokens=False).ids[0], *LIBRARY.encode("日本", add_special_tokens=False).ids[:2]]
    for n in range(1, len(ids) + 1):
        assert OWN.decode(np.array(ids[:n], "<u4").tobytes()).decode() == LIBRARY.decode(ids[:n], skip_special_tokens=False)


def test_cuts_are_forced():
    assert all(pair in OWN.joined for token in OWN.tokens[:50256] for pair in zip(token, token[1:]))
    assert len(OWN.joined) < 65536


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    own = bpe.ByteBpe(bpe.read_vocabulary(queries.vocabulary_path()))
    text = " ".join(f"word{i % 9} é{i}" for i in range(200))
    assert own.encode(text) == OWN.encode(text)
    assert all(len(m) <= 5 and len(m.old) <= 5 for m in (own.words, own.pieces, own.fragments))


def test_query_columns(spark):
    from conftest import SMALL

    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, SMALL).collect()}
    import hashlib

    for row in queries.op1_bpe_round_trip(spark, SMALL).collect():
        ids = LIBRARY.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(docs[row["doc_id"]].encode()).hexdigest()


def test_encode_then_decode(spark):
    vocabulary = bpe.read_vocabulary(queries.vocabulary_path())
    frame = spark.createDataFrame([(1, "Ünïcode text", "x"), (2, None, "y")], "id long, text string, extra string")
    ids = bpe.encode(frame, vocabulary, ["id", "extra"])
    got = {r["id"]: (r["extra"], bytes(r["decoded"]).decode()) for r in bpe.decode(ids, vocabulary, ["id", "extra"]).collect()}
    assert got == {1: ("x", "Ünïcode text"), 2: ("y", "")}
