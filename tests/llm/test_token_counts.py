"""Counts against the tokenizers library's Unigram model."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, normalizers

from tripflow.llm.token_counts import UnigramCounter, pieces_of_model, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces, byte_fallback):
    unk = [p for p, _ in pieces].index("<unk>")
    tok = Tokenizer(models.Unigram(pieces, unk, byte_fallback))
    tok.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return tok


@pytest.fixture(scope="module")
def public():
    pieces = pieces_of_model(PATH)
    return UnigramCounter(pieces), library(pieces, True)


def texts(seed, n, alphabet):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_public_vocabulary(public):
    counter, tok = public
    some = ["", " ", "  a", "a  ", "\n", "The cat\nsat  on\n\n the mat.", "<0x41><s>", "▁▁x ▁", "é漢字😀\x00"]
    some += texts(1, 400, "etaoinshr dlu\n") + texts(2, 400, "ab▁ \n\t😀é漢1.") + texts(3, 200, "thean ")
    assert counter.count(some) == [len(tok.encode(t, add_special_tokens=False).ids) for t in some]


@pytest.mark.parametrize("scores", [(-1, -2, -3), (-1.5, -2.25, -0.5), (-2, -2, -2)])
@pytest.mark.parametrize("with_bytes", [True, False])
def test_ties_and_small_vocabularies(scores, with_bytes):
    rng = random.Random(5)
    names = ["a", "b", "ab", "ba", "aab", "▁", "▁a", "bb▁", "abab", "▁ab"]
    pieces = [("<unk>", -9.0)] + [(p, float(rng.choice(scores))) for p in names]
    if with_bytes:
        pieces += [(f"<0x{b:02X}>", -20.0) for b in range(256)]
    counter, tok = UnigramCounter(pieces), library(pieces, with_bytes)
    some = texts(7, 500, "aaabb c") + ["", "ccc", "c a"]
    assert counter.count(some) == [len(tok.encode(t, add_special_tokens=False).ids) for t in some]


def test_query_shape(spark, public):
    long = "some words here " * 5000
    rows = [(1, None), (2, ""), (3, "a cat"), (3, "a cat"), (None, long)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, n_tokens string, id int")
    got = sorted(map(tuple, token_counts(df, "doc_id", "text", PATH).collect()), key=str)
    want = sorted([(i, len(public[1].encode(t or "", add_special_tokens=False).ids)) for i, t in rows], key=str)
    assert got == want
    assert token_counts(df.limit(0), "doc_id", "text", PATH).count() == 0
