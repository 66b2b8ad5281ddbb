"""Byte-pair encoding and decoding of whole texts by tree concatenation.

A text of at most ``piece_chars`` characters is encoded in one go.  A
longer one is halved until its pieces are that short; Spark spreads the
pieces, tasks encode them in parallel, and neighbouring pieces are then
joined in pairs, level by level.  A join re-encodes a window around the
cut and takes its ids between two places where the window agrees with the
left side and with the right side; while it doesn't, the window doubles,
at most to both sides whole.

Why agreement makes a join exact.  The tokenizer first cuts a text into
pre-tokens, each decided by what follows its beginning.  So where two
encodings have a pre-token begin at the same byte, they go on alike.
Inside one pre-token, ids are byte-pair merges, and a sequence of tokens
is the right one when each neighbouring pair is: a token shared by both
sides with the same bytes makes every pair one that a side has checked.

Defined results: a null text is the empty text and has no ids; repeated
rows each give a row; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, text_of
from tripflow.llm.encoders import ByteEncoder, encoder

PIECE_CHARS = 32_768
FIRST_WINDOW = 64


class Piece:
    """ids of a stretch of a text, where each token ends (bytes from the
    stretch's beginning), and which tokens begin a pre-token."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, begins: np.ndarray):
        self.ids, self.ends, self.begins = ids, ends, begins

    @classmethod
    def encode(cls, enc: ByteEncoder, text: str) -> Piece:
        ids, begins = enc.encode_words(text)
        return cls(ids, np.cumsum(enc.lengths[ids]), begins)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int64), self.ends[:-1]]) if len(self.ends) else self.ends


def _agreement(old: Piece, new: Piece, shift: int, low: int, high: int, last: bool) -> int | None:
    """A byte of ``old`` in (low, high) where ``new``, which begins at byte
    ``shift`` of it, may take over from it or hand over to it; the last
    such byte or the first."""
    a, b = old.starts, new.starts + shift
    common = np.intersect1d(a[old.begins], b[new.begins])
    common = common[(common > low) & (common < high)]
    if len(common):
        return int(common[-1 if last else 0])
    # no pre-token begins there in both: look for a shared token inside one
    inside = (a > low) & (a < high) & ~old.begins
    inside_b = (b > low) & (b < high) & ~new.begins
    if old.begins[(a > low) & (a < high)].any() or new.begins[(b > low) & (b < high)].any():
        return None
    shared = np.intersect1d(a[inside], b[inside_b])
    ends = np.intersect1d(old.ends[inside], new.ends[inside_b] + shift)
    whole = np.intersect1d(shared, ends)  # boundaries with a shared token before and after
    whole = whole[(whole > low) & (whole < high)]
    return int(whole[-1 if last else 0]) if len(whole) else None


def _char_edge(raw: bytes, at: int) -> int:
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def join(enc: ByteEncoder, raw: bytes, left: Piece, right: Piece, cut: int) -> Piece:
    """The encoding of ``raw``, whose first ``cut`` bytes ``left`` encodes."""
    size = FIRST_WINDOW
    while True:
        begin, end = _char_edge(raw, max(0, cut - size)), _char_edge(raw, min(len(raw), cut + size))
        window = Piece.encode(enc, raw[begin:end].decode())
        at_left = 0 if begin == 0 else _agreement(left, window, begin, begin, cut, True)
        at_right = len(raw) if end == len(raw) else _agreement(right, window, begin - cut, 0, end - cut, False)
        if at_left is not None and at_right is not None:
            if end < len(raw):
                at_right += cut
            a, b = left.starts < at_left, (right.starts + cut) >= at_right
            mid = window.starts + begin
            m = (mid >= at_left) & (mid < at_right)
            return Piece(
                np.concatenate([left.ids[a], window.ids[m], right.ids[b]]),
                np.concatenate([left.ends[a], window.ends[m] + begin, right.ends[b] + cut]),
                np.concatenate([left.begins[a], window.begins[m], right.begins[b]]),
            )
        size *= 2


def join_all(enc: ByteEncoder, texts: list[bytes], pieces: list[Piece]) -> Piece:
    """Neighbours joined in pairs until one piece is left."""
    while len(pieces) > 1:
        next_texts, next_pieces = [], []
        for i in range(0, len(pieces), 2):
            if i + 1 == len(pieces):
                next_texts.append(texts[i])
                next_pieces.append(pieces[i])
            else:
                raw = texts[i] + texts[i + 1]
                next_texts.append(raw)
                next_pieces.append(join(enc, raw, pieces[i], pieces[i + 1], len(texts[i])))
        texts, pieces = next_texts, next_pieces
    return pieces[0]


_IDS = T.ArrayType(T.IntegerType())


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), type=pa.list_(pa.field("element", pa.int32())))


def _rows(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def encode_texts(df: DataFrame, id_col: str, text_col: str, path: str, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per input row: the id column and ``ids`` array<int>, the
    ids that the tokenizer in the file ``path`` gives its whole text."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    out = T.StructType([T.StructField("id", id_type), T.StructField("ids", _IDS)])

    def short(batches):
        enc = encoder(ByteEncoder, path)
        for batch in batches:
            for part in _rows(batch):
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _id_lists(ids)], ["id", "ids"])

    whole = rows.where(F.length("text") <= piece_chars).mapInArrow(short, out)

    # Halved so often that a piece has at most piece_chars characters.  The
    # text's digest stands for the row, and equal rows are one with a count.
    halvings = F.ceil(F.log2(F.length("text") / F.lit(float(piece_chars)))).cast("int")
    cut = (
        rows.where(F.length("text") > piece_chars)
        .withColumn("digest", F.sha2("text", 256))
        .withColumn("n", F.pow(F.lit(2.0), halvings).cast("int"))
        .withColumn("size", F.ceil(F.length("text") / F.col("n")).cast("int"))
        .select("id", "digest", "size", "text", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("number"))
        .select("id", "digest", "number", F.expr("substring(text, number * size + 1, size)").alias("piece"))
        # equal rows are counted before they meet: a hot text's pieces travel once
        .groupBy("id", "digest", "number", "piece")
        .agg(F.count("*").alias("copies"))
    )
    piece_type = T.StructType(
        [*cut.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("begins", T.BinaryType())]
    )

    def encode_pieces(batches):
        enc = encoder(ByteEncoder, path)
        for batch in batches:
            for part in _rows(batch, 16):
                done = [Piece.encode(enc, t) for t in part.column("piece").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([p.ids.tobytes() for p in done], pa.binary()),
                        pa.array([p.begins.tobytes() for p in done], pa.binary()),
                    ],
                    [*part.schema.names, "ids", "begins"],
                )

    def join_pieces(group: pa.Table) -> pa.Table:
        enc = encoder(ByteEncoder, path)
        number = group.column("number").to_pylist()
        order = sorted(range(len(number)), key=number.__getitem__)
        texts, pieces = [], []
        for i in order:
            ids = np.frombuffer(group.column("ids")[i].as_py(), "<u4")
            begins = np.frombuffer(group.column("begins")[i].as_py(), bool)
            texts.append(group.column("piece")[i].as_py().encode())
            pieces.append(Piece(ids, np.cumsum(enc.lengths[ids]), begins))
        ids = join_all(enc, texts, pieces).ids
        key = group.column("id").slice(order[0], 1).combine_chunks()
        copies = group.column("copies").slice(order[0], 1).combine_chunks()
        return pa.Table.from_arrays([key, _id_lists([ids]), copies], ["id", "ids", "copies"])

    counted = T.StructType([*out.fields, T.StructField("copies", T.LongType())])
    joined = cut.mapInArrow(encode_pieces, piece_type).groupBy("id", "digest").applyInArrow(join_pieces, counted)
    joined = joined.select("id", "ids", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
    return whole.unionByName(joined).withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """One row per input row: the id column and ``text``, decoded from the
    ids with special tokens kept.  A null list of ids is the empty one."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), col(ids_col).alias("ids"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.StringType())])

    def decode(batches):
        enc = encoder(ByteEncoder, path)
        for batch in batches:
            for part in _rows(batch):
                texts = [enc.decode(np.array(x.values if x.is_valid else [], np.int64)) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(decode, out).withColumnRenamed("id", id_col)


def codec_digests(df: DataFrame, id_col: str, text_col: str, path: str, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Encode, decode what was encoded, and keep the digests: the id
    column, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers) and decoded_sha256 (the decoded text in UTF-8)."""
    coded = encode_texts(df, id_col, text_col, path, piece_chars).select(col(id_col).alias("id"), "ids")
    out = T.StructType(
        [
            T.StructField("id", coded.schema["id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def digests(batches):
        enc = encoder(ByteEncoder, path)
        for batch in batches:
            for part in _rows(batch):
                counts, of_ids, of_text = [], [], []
                for x in part.column(1):
                    ids = np.asarray(x.values).astype("<u4")
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    of_text.append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    out.fieldNames(),
                )

    return coded.mapInArrow(digests, out).withColumnRenamed("id", id_col)
