"""Encoding and decoding against the tokenizers library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row

from tripflow.llm import bpe_codec as B
from tripflow.llm.encoders import ByteEncoder, WordEncoder, load_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(text):
    ids = load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids
    back = load_tokenizer(PATH).decode(ids, skip_special_tokens=False)
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(back.encode()).hexdigest(),
    )


def odd_texts():
    rng = random.Random(3)
    letters = "etaoinshrdlu"
    return [
        None,
        "",
        " ",
        "\n\n  a",
        "it's <|endoftext|> here" * 40,
        "a" * 3000,
        "".join(rng.choice(letters) for _ in range(3000)),
        "".join(rng.choice("0123456789") for _ in range(2000)),
        "'s" * 900,
        " " * 1500 + "x",
        "\t \n" * 500,
        "é漢字😀" * 300,
        "".join(rng.choice("ab'sre \n\t\x1c é#1!") for _ in range(4000)),
        "#$%" * 700 + "'ll " * 300,
        "The cat sat on the mat, didn't it? " * 60,
    ]


def test_digests_equal_the_library(spark):
    texts = odd_texts()
    df = spark.createDataFrame([Row(doc_id=i, text=t, ids="x", id=7) for i, t in enumerate(texts)], "doc_id long, text string, ids string, id int")
    got = {r.doc_id: r for r in B.codec_digests(df, "doc_id", "text", PATH, piece_chars=128).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == expected(t), i


def test_repeated_rows_null_ids_and_empty_table(spark):
    long = "word and another word " * 50
    df = spark.createDataFrame([(1, long), (1, long), (1, long + "x"), (None, long), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, B.codec_digests(df, "doc_id", "text", PATH, piece_chars=64).collect()), key=str)
    want = sorted([(i, *expected(t)) for i, t in [(1, long), (1, long), (1, long + "x"), (None, long), (None, None)]], key=str)
    assert got == want
    assert B.codec_digests(df.limit(0), "doc_id", "text", PATH).count() == 0


def test_decode_gives_the_text_back(spark):
    df = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string")
    back = B.decode_ids(B.encode_texts(df, "doc_id", "text", PATH, 100), "doc_id", "ids", PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(odd_texts())}


@pytest.mark.parametrize("seed", range(6))
def test_joins_of_unsplit_text(seed):
    rng = random.Random(seed)
    enc = ByteEncoder(PATH)
    for _ in range(60):
        alphabet = rng.choice(["ab", "etaoinsr", "a1", "'s ", "#'t\n", "é e", "ab<|endoftext|>"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 900)))
        if rng.random() < 0.3:
            text = text[:50] + "<|endoftext|>" + text[50:]
        cuts = sorted({0, len(text), *(rng.randrange(len(text) + 1) for _ in range(5))})
        parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        whole = B.join_all(enc, [p.encode() for p in parts], [B.Piece.encode(enc, p) for p in parts])
        assert whole.ids.tolist() == load_tokenizer(PATH).encode(text, add_special_tokens=False).ids


def test_fast_encoders_equal_the_library():
    rng = random.Random(9)
    word_path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["".join(rng.choice("ab'sre \n\t\x1c\x1d  é#1!ſḰİßΣ\x00") if rng.random() < 0.9 else "<|endoftext|>" for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice("etaoinshrdlucmfwypvbgkjqxz") for _ in range(rng.randrange(1, 20))) for _ in range(5000)]
    byte, word = ByteEncoder(PATH), WordEncoder(word_path)
    for t, w in zip(texts, word.encode(texts)):
        assert byte.encode(t).tolist() == byte.tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(w, "<u4").tolist() == word.tok.encode(t, add_special_tokens=False).ids
