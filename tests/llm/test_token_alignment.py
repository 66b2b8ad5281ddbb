"""Alignments against a plain program over the libraries' own tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from pyspark.sql import Row
from tokenizers import Tokenizer

from tripflow.llm import token_alignment as A

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text):
    """[(id, end)] of both sides, or None, straight from the libraries."""
    from tripflow.llm.encoders import byte_of_char

    if not text:
        return None
    tok = Tokenizer.from_file(A_PATH)
    tok.encode_special_tokens = True
    chars = byte_of_char()
    a = [(i, bytes(chars[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return None
    sides = []
    for side in (a, b):
        end, out = 0, []
        for i, x in side:
            end += len(x)
            out.append((i, end))
        sides.append(out)
    return sides


def plain_alignment(texts):
    links, docs = Counter(), []
    for text in texts:
        sides = plain_tokens(text)
        if sides is None:
            docs.append((0, 0, 0, [], ""))
            continue
        a, b = sides
        own = [(x, y) for x, e in a for y, f in b if e == f] if len(a) < 500 else None
        if own is None:
            at = {f: y for y, f in b}
            own = [(x, at[e]) for x, e in a if e in at]
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        parts, low = [], 0
        for cut in cuts:
            ga = ",".join(str(x) for x, e in a if low < e <= cut) if len(a) < 500 else None
            gb = ",".join(str(x) for x, e in b if low < e <= cut) if len(a) < 500 else None
            parts.append(f"{ga}|{gb}")
            low = cut
        if len(a) >= 500:
            by = [defaultdict(list), defaultdict(list)]
            for s, side in enumerate((a, b)):
                g = 0
                for x, e in side:
                    while e > cuts[g]:
                        g += 1
                    by[s][g].append(str(x))
            parts = [",".join(by[0][g]) + "|" + ",".join(by[1][g]) for g in range(len(cuts))]
        docs.append((len(a), len(b), len(cuts), own, hashlib.sha256(";".join(parts).encode()).hexdigest()))
        links.update(own)
    most = defaultdict(int)
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return [
        (na, nb, ng, len(own), sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own), sha)
        for na, nb, ng, own, sha in docs
    ]


def odd_texts():
    rng = random.Random(2)
    return [
        None,
        "",
        " ",
        "  two  spaces ",
        "a▁b has the mark",
        "<|endoftext|> and </s> <unk> <0x41> in text " * 3,
        "é漢字😀 naïve\r\n\ttabs\x00nul " * 20,
        "The quick brown fox doesn't jump over 1234567 lazy dogs. " * 30,
        "".join(rng.choice("abcdefgh ") for _ in range(1500)),
        "".join(rng.choice("xyz") for _ in range(900)),
        "#$%^&*(" * 80,
        "word " * 400,
        "The quick brown fox doesn't jump over 1234567 lazy dogs. " * 30,
        "long text with the mark ▁ somewhere " * 20,
    ]


def run(spark, texts, **how):
    df = spark.createDataFrame(
        [Row(doc_id=i, text=t, row="x", a=1, at=2) for i, t in enumerate(texts)], "doc_id long, text string, row string, a int, at int"
    )
    got = {r.doc_id: tuple(r)[1:] for r in A.alignment_digests(df, "doc_id", "text", A_PATH, B_PATH, **how).collect()}
    want = plain_alignment(texts)
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i] == want[i], (i, texts[i] and texts[i][:40])


def test_whole_texts_equal_the_plain_program(spark):
    run(spark, odd_texts())


def test_long_texts_over_many_units_and_ranges(spark):
    run(spark, odd_texts(), unit_chars=40, range_bytes=16, frequent=7)


def tokens_of(text):
    (t,) = A.encode_both(A.encoder(A.PlainByteEncoder, A_PATH), A.encoder(A.PieceEncoder, B_PATH), [text])
    return t


def between(t, low, high):
    i, j = (t.a_ends > low) & (t.a_ends <= high), (t.b_ends > low) & (t.b_ends <= high)
    return A.Tokens(t.a[i], t.a_ends[i], t.b[j], t.b_ends[j])


def same(x, y):
    return x.cut == y.cut and all(np.array_equal(p, q) for p, q in zip([*x.prefix, *x.suffix], [*y.prefix, *y.suffix], strict=True))


def test_fragments_compose_associatively_with_an_identity():
    rng = random.Random(7)
    t = tokens_of("unbelievably xylophonic naïveté 漢字 1234567 antidisestablishmentarianism!? " * 4)
    size = int(t.a_ends[-1])
    for _ in range(200):
        cuts = sorted(rng.sample(range(1, size), 2))
        x, y, z = (A.fragment_of(between(t, a, b))[0] for a, b in zip([0, *cuts], [*cuts, size], strict=True))
        left = A.compose(A.compose(x, y)[0], z)[0]
        right = A.compose(x, A.compose(y, z)[0])[0]
        whole = A.fragment_of(t)[0]
        assert same(left, right) and same(left, whole)
        assert same(A.compose(A.IDENTITY, x)[0], x) and same(A.compose(x, A.IDENTITY)[0], x)


def test_units_encode_as_the_whole_text_does():
    rng = random.Random(3)
    words = ["a", "don't", "x1", "é", "漢字", "12", "_", "!", "\n", "\t", "", "½", "the", "antidisestablishment"]
    a, b = A.encoder(A.PlainByteEncoder, A_PATH), A.encoder(A.PieceEncoder, B_PATH)
    import pyarrow as pa

    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(80)) or "x"
        batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([text])], ["row", "text"])
        units = [r for part in A._units(30, B_PATH)([batch]) for r in part.to_pylist()]
        assert " ".join(u["text"] for u in units) == text
        parts = [x for x in A.encode_both(a, b, [u["text"] for u in units])]
        moved = [p._replace(a_ends=p.a_ends + u["at"], b_ends=p.b_ends + u["at"]) for p, u in zip(parts, units, strict=True)]
        for x, y in zip(A.joined(*moved), tokens_of(text), strict=True):
            assert np.array_equal(x, y)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two"), (2, None)], "doc_id int, text string")
    got = sorted(A.alignment_digests(df, "doc_id", "text", A_PATH, B_PATH).collect(), key=lambda r: (r.doc_id or 0, r.n_a))
    assert [(r.doc_id, r.n_a, r.count_sum) for r in got] == [(None, 2, 6), (1, 2, 6), (1, 2, 6), (2, 0, 0)]
    assert A.alignment_digests(df.where("doc_id > 9"), "doc_id", "text", A_PATH, B_PATH).count() == 0


def test_closed_groups_are_dealt_into_rows_of_bounded_size():
    a, b = A.encoder(A.PlainByteEncoder, A_PATH), A.encoder(A.PieceEncoder, B_PATH)
    text = "unbelievably xylophonic naïveté 漢字 1234567 antidisestablishmentarianism!? " * 9
    _, closed, at = A.fragment_of(tokens_of(text))
    raw = (" " + text).encode()
    for size in (1, 7, len(closed.a_cuts), 10_000):
        parts = A.parts_of(closed, at, a.lengths, size)
        assert len(parts) == -(-len(closed.a_cuts) // size)
        assert all(0 < len(g.a_cuts) <= size for _, g in parts)
        a_done = b_done = 0
        cuts = []
        for begin, g in parts:
            own_a, own_b = (b"".join(x.pieces[i] for i in ids) for x, ids in ((a, g.a), (b, g.b)))
            assert own_a == own_b == raw[begin : begin + len(own_a)]
            cuts += [(int(i) + a_done, int(j) + b_done) for i, j in zip(g.a_cuts, g.b_cuts, strict=True)]
            a_done, b_done = a_done + len(g.a), b_done + len(g.b)
        assert cuts == list(zip(closed.a_cuts.tolist(), closed.b_cuts.tolist(), strict=True))
        assert np.array_equal(np.concatenate([g.a for _, g in parts]), closed.a)
        assert np.array_equal(np.concatenate([g.b for _, g in parts]), closed.b)


def number_texts(spark, n):
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(3000)) for _ in range(12_000)) for _ in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_rows_of_long_texts_hold_a_bounded_number_of_groups(spark):
    _, long = A.align_texts(number_texts(spark, 4), "doc_id", "text", A_PATH, B_PATH)
    rows = long.selectExpr("size(a_cuts) AS n").collect()
    assert max(r.n for r in rows) <= A.ROW_GROUPS
    assert sum(r.n for r in rows) > 4 * 10_000


def test_staged_tables_of_large_rows_have_small_row_groups(spark, monkeypatch):
    staged, stage = [], A.stage

    def watched(df, name, *how):
        staged.append((name, stage(df, name, *how)))
        return staged[-1][1]

    monkeypatch.setattr(A, "stage", watched)
    monkeypatch.setattr(A, "GROUP_BYTES", 1 << 14)
    A.alignment_digests(number_texts(spark, 24), "doc_id", "text", A_PATH, B_PATH, unit_chars=1000, range_bytes=1024)
    # the writer looks at a group's size after 100 rows, and then now and again
    for table in ("token-ranges", "fragments"):
        files = [pq.ParquetFile(f.removeprefix("file://")) for name, df in staged for f in df.inputFiles() if name == table]
        assert sum(f.metadata.num_rows for f in files) > 1000
        assert max(f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) <= 400


def test_one_tokenizer_a_worker_and_special_names_stay_plain_there():
    from tripflow.llm import encoders

    a = A.encoder(A.PlainByteEncoder, A_PATH)
    assert a.tok is encoders.load_tokenizer(A_PATH, True)
    assert a.tok.encode_special_tokens and not encoders.load_tokenizer(A_PATH).encode_special_tokens
