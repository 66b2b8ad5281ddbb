"""The Huffman id files: optimal lengths, exact round trips, order."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from tripflow.llm import huffman_ids as H
from tripflow.llm.encoders import load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@pytest.mark.parametrize("seed", range(5))
def test_code_is_optimal_prefix_free_and_limited(seed):
    rng = np.random.default_rng(seed)
    counts = (rng.pareto(1.0, 300) * 10).astype(int) * (rng.random(300) < 0.8)
    lengths = H.code_lengths(counts, 16)
    assert (lengths * counts).sum() == plain_cost(counts)
    assert sum(2.0 ** -int(n) for n in lengths if n) == pytest.approx(1)
    tight = H.code_lengths(2 ** np.arange(30), 6)
    assert tight.max() == 6 and sum(2.0 ** -int(n) for n in tight) <= 1
    words = sorted(format(int(c), f"0{n}b") for c, n in zip(H.canonical_codes(tight), tight) if n)
    assert not any(b.startswith(a) for a, b in zip(words, words[1:]))


def test_limited_code_is_the_best_by_search():
    counts = np.array([1, 1, 2, 5, 13, 40])
    best = min(
        (sum(n * c for n, c in zip(ns, counts)))
        for ns in np.ndindex(*(4,) * 6)
        if sum(2.0 ** -(n + 1) for n in ns) <= 1
        for ns in [tuple(n + 1 for n in ns)]
        if max(ns) <= 4
    )
    assert (H.code_lengths(counts, 4) * counts).sum() == best


def test_coder_round_trip_from_any_checkpoint():
    rng = np.random.default_rng(1)
    counts = (rng.pareto(0.7, 5000) * 3).astype(int) + 1
    coder = H.Coder(H.code_lengths(counts))
    for n in (1, 63, 64, 65, 5000):
        ids = rng.choice(5000, n, p=counts / counts.sum())
        bits, offsets = coder.encode(ids)
        size = np.full(len(offsets), H.STRIDE)
        size[-1] = n - H.STRIDE * (len(offsets) - 1)
        assert (coder.decode(bits, offsets, size) == ids).all()
        assert (coder.decode(bits, offsets[-1:], size[-1:]) == ids[H.STRIDE * (len(offsets) - 1) :]).all()
    one = H.Coder(H.code_lengths(np.array([0, 7])))
    bits, offsets = one.encode(np.array([1, 1, 1]))
    assert one.decode(bits, offsets, np.array([3])).tolist() == [1, 1, 1]


def rows():
    rng = random.Random(2)
    words = ["The", "cat", "sat", "ÉCOLE", "it's", "42", "\n", "<|endoftext|>", "ſ", "漢字", "#!"]
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(120)))) for i in range(300)]
    out += [(5, "cat"), (5, "cat"), (5, "sat"), (None, "mat"), (999, None), (1000, ""), (1001, "long word " * 30000)]
    rng.shuffle(out)
    return out


def test_files_hold_all_ids_in_order(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(H, "SHARD_BYTES", 4096)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows()], "doc_id long, text string, n_tokens string, shard int")
    df = df.repartition(5)
    got = H.ids_round_trip(df, "doc_id", "text", PATH, 2).collect()
    assert len(got) == len(rows())
    tok = load_tokenizer(PATH)
    want = {}
    for i, t in rows():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    seen = {}
    at = 0
    last = -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert (r.doc_id if r.doc_id is not None else -1) >= last
        last = r.doc_id if r.doc_id is not None else -1
        seen.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    path = str(tmp_path / "files")
    H.write_ids(df, "doc_id", "text", PATH, 2, path)
    back = H.read_ids(spark, path, T.LongType())
    assert {zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in back.collect()} == {c for v in want.values() for _, c in v}


def test_empty_table_and_one_hot_id(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_BYTES", 512)
    df = spark.createDataFrame([(7, f"word {i} of many") for i in range(400)], "doc_id long, text string")
    got = sorted(H.ids_round_trip(df, "doc_id", "text", PATH, 2).collect(), key=lambda r: r.start)
    assert len(got) == 400 and got[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    assert H.ids_round_trip(df.limit(0), "doc_id", "text", PATH, 2).count() == 0


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(9,2)", "double"])
def test_ids_of_any_ordered_type_over_several_shards(spark, monkeypatch, kind):
    monkeypatch.setattr(H, "SHARD_BYTES", 256)
    expr = {"string": "concat('é', id)", "date": "date_add(date'2020-01-01', CAST(id AS INT))", "timestamp": "timestamp_seconds(id * 977)"}
    df = spark.range(300).selectExpr(
        f"CASE WHEN id % 5 != 0 THEN CAST({expr.get(kind, 'id')} AS {kind}) END AS k", "concat('word ', id % 7, ' of many') AS t"
    ).repartition(3)
    got = sorted(H.ids_round_trip(df, "k", "t", PATH, 2).collect(), key=lambda r: r.start)
    assert len(got) == 300 and all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    keys = [r.k for r in got]
    assert keys[:60] == [None] * 60 and keys[60:] == sorted(keys[60:])
    bounds, nulls, shards = H._bounds(df.select(df["k"].alias("id")), 20)
    assert len(bounds) + 1 + nulls == shards == 20 and nulls == 4


@pytest.mark.parametrize("shards", [1, 6, 64, 190])
def test_every_shard_has_a_partition_of_its_own(spark, shards):
    places = H._places(spark, shards)
    df = spark.createDataFrame([(s, places[s]) for s in range(shards)], "shard int, place int").repartition(shards, "place")
    assert sorted(map(len, df.rdd.glom().collect())) == [1] * shards


def test_documents_coded_together_are_coded_as_one_by_one():
    rng = np.random.default_rng(2)
    counts = (rng.pareto(0.7, 5000) * 3).astype(int) + 1
    coder = H.Coder(H.code_lengths(counts))
    ns = [1, 0, 63, 64, 65, 5000, 0, 2, *rng.integers(1, 400, 50)]
    docs = [rng.choice(5000, n, p=counts / counts.sum()) for n in ns]
    bits, marks = coder.encode_all(np.concatenate(docs), np.array(ns))
    for doc, b, m in zip(docs, bits, marks, strict=True):
        one, offsets = coder.encode(doc)
        assert b == one and m.tolist() == offsets.tolist()
