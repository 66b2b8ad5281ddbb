"""Alignment of two tokenizers' tokens, and how often ids are linked.

Each text, with a space before it, is encoded by a byte-level BPE file (A)
and by a sentencepiece file (B, which adds the space itself).  Both give
tokens whose bytes follow each other; the byte offsets at which a token of
A and one of B end together cut the tokens into groups.  Each such offset
is a link: the two tokens that end there.  Special tokens' names inside a
text are plain text.  Texts that are null or empty, and those whose tokens'
bytes aren't space and text (B's mark U+2581 in a text reads as a space),
have no tokens.

Very long texts.  A fragment is what a range of bytes holds: the tokens of
both sides that end in it, as an open prefix (up to its first cut), closed
groups, and an open suffix (after its last cut).  Fragments of neighbouring
ranges compose: the left suffix and the right prefix make the group between
them; without a cut a fragment is open as a whole.  That is associative,
with the empty fragment as identity, so Spark composes them in a tree,
FAN neighbours a task and level.  Closed groups stay where they were found:
only open ends move, and each level lets out the groups that it closes.

To be encoded by many tasks, a long text is cut before spaces that stand
between two word characters.  A begins a pre-token at each such space, and
no piece of B has its mark behind another character (checked when the file
is loaded), so both encode the parts as they encode the whole.  A text
without such a space is encoded in one go.  Tokens are then dealt into
ranges of RANGE_BYTES by where they end.

Counts.  A pair's count is the number of links that hold it in the whole
corpus.  Pairs linked more than total / FREQUENT times are less than
FREQUENT in number, so that table is broadcast at any size, and hot pairs
never meet in one task; the others are joined by a shuffle in which no key
has more rows than that.

Defined results: repeated rows each give a row, and count each; null ids
are kept; an empty table gives no rows; other columns of the input are not
looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, stage, text_of
from tripflow.llm.encoders import ByteEncoder, encoder

UNIT_CHARS = 32_768
RANGE_BYTES = 1 << 14
FAN = 8
FREQUENT = 500_000
ROW_GROUPS = 1024
GROUP_BYTES = 2 << 20

_SAFE = re.compile(r"(?<=\w) (?=\w)")


class PlainByteEncoder(ByteEncoder):
    """A byte-level tokenizer to which special tokens' names are plain text."""

    def __init__(self, path: str):
        super().__init__(path, names_plain=True)
        self.special = []
        #: no normalizer, and every byte a token: the tokens' bytes are the text's
        self.exact = self.plain and not self.merger.unknown[:256].any()


class PieceEncoder:
    """A sentencepiece file: ids of texts, and the bytes of ids."""

    MARK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self.core = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.core.id_to_piece(i) for i in range(self.core.get_piece_size())]
        self.pieces = [
            bytes([int(p[3:5], 16)]) if self.core.is_byte(i) else p.replace(self.MARK, " ").encode()
            for i, p in enumerate(names)
        ]
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        #: whether texts may be cut before a space that follows another character
        self.cuts = not any(self.MARK in p.lstrip(self.MARK) for p in names)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.core.encode(texts, num_threads=1)]


class Tokens(NamedTuple):
    """ids and ends (bytes from the text's beginning) of both sides."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray


NONE = np.zeros(0, np.int64)
EMPTY = Tokens(NONE, NONE, NONE, NONE)


def joined(*parts: Tokens) -> Tokens:
    return Tokens(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def encode_both(a: PlainByteEncoder, b: PieceEncoder, texts: list[str]) -> list[Tokens | None]:
    """Tokens of a space and each text; None for empty texts and where the
    tokens' bytes differ from them."""
    out: list[Tokens | None] = []
    for text, ids_b in zip(texts, b.encode(texts), strict=True):
        if not text:
            out.append(None)
            continue
        whole = " " + text
        raw, ids_a = whole.encode(), a.encode(whole).astype(np.int64)
        ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
        same = (
            len(ids_b) > 0
            and ends_a[-1] == ends_b[-1] == len(raw)
            and b"".join(map(b.pieces.__getitem__, ids_b.tolist())) == raw
            and (a.exact or b"".join(map(a.pieces.__getitem__, ids_a.tolist())) == raw)
        )
        out.append(Tokens(ids_a, ends_a, ids_b, ends_b) if same else None)
    return out


class Groups(NamedTuple):
    """Closed groups: ids of both sides, and after how many of them each
    group ends."""

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray


class Fragment(NamedTuple):
    """What a range of bytes holds, closed groups left out.

    prefix: tokens up to the first cut, or all of them without a cut;
    suffix: tokens after the last cut.
    """

    cut: bool
    prefix: Tokens
    suffix: Tokens


IDENTITY = Fragment(False, EMPTY, EMPTY)


def _links(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens of both sides end together: their places on each side.
    (A token holds a byte at least, so ends differ within a side.)"""
    at = np.searchsorted(t.b_ends, t.a_ends)
    hit = at < len(t.b_ends)
    hit[hit] = t.b_ends[at[hit]] == t.a_ends[hit]
    return np.flatnonzero(hit), at[hit]


def groups_of(t: Tokens) -> Groups:
    """The groups of tokens that end with a cut."""
    i, j = _links(t)
    return Groups(t.a, t.b, i + 1, j + 1)


def fragment_of(t: Tokens) -> tuple[Fragment, Groups | None, int]:
    """A range's fragment, its closed groups, and the byte they begin at."""
    i, j = _links(t)
    if not len(i):
        return Fragment(False, t, EMPTY), None, 0
    p, q, r, s = i[0] + 1, j[0] + 1, i[-1] + 1, j[-1] + 1
    prefix = Tokens(t.a[:p], t.a_ends[:p], t.b[:q], t.b_ends[:q])
    suffix = Tokens(t.a[r:], t.a_ends[r:], t.b[s:], t.b_ends[s:])
    closed = Groups(t.a[p:r], t.b[q:s], i[1:] + 1 - p, j[1:] + 1 - q) if len(i) > 1 else None
    return Fragment(True, prefix, suffix), closed, int(t.a_ends[p - 1])


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Tokens | None]:
    """Two neighbours as one fragment, and the group between them if it closes."""
    if not x.cut:
        return Fragment(y.cut, joined(x.prefix, y.prefix), y.suffix), None
    if not y.cut:
        return Fragment(True, x.prefix, joined(x.suffix, y.prefix)), None
    return Fragment(True, x.prefix, y.suffix), joined(x.suffix, y.prefix)


def parts_of(g: Groups, at: int, lengths: np.ndarray, size: int = ROW_GROUPS) -> list[tuple[int, Groups]]:
    """Groups that begin at a byte, in rows of ``size`` groups at most, and
    the byte each row begins at; lengths: bytes of A's ids."""
    out = []
    for k in range(0, len(g.a_cuts), size):
        a_cuts, b_cuts = g.a_cuts[k : k + size], g.b_cuts[k : k + size]
        p, q = (int(g.a_cuts[k - 1]), int(g.b_cuts[k - 1])) if k else (0, 0)
        out.append((at, Groups(g.a[p : a_cuts[-1]], g.b[q : b_cuts[-1]], a_cuts - p, b_cuts - q)))
        at += int(lengths[out[-1][1].a].sum())
    return out


def one_group(t: Tokens) -> Groups:
    return Groups(t.a, t.b, np.array([len(t.a)]), np.array([len(t.b)]))


# ---- Spark ----

_IDS = T.ArrayType(T.IntegerType())
_ROW = T.StructField("row", T.LongType())
_AT = T.StructField("at", T.LongType())
_GROUPS = [T.StructField(n, _IDS) for n in Groups._fields]
# Tokens on their way: ids of a side and the byte its first token begins at.
_PACKED = {"a": T.BinaryType(), "a_at": T.LongType(), "b": T.BinaryType(), "b_at": T.LongType()}


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), type=pa.list_(pa.field("element", pa.int32())))


class _Packer:
    """Packs tokens as ids and places, from which their ends follow."""

    def __init__(self, a: PlainByteEncoder, b: PieceEncoder):
        self.sides = (a.lengths, b.lengths)

    def pack(self, t: Tokens) -> tuple:
        out = []
        for ids, ends, lengths in zip((t.a, t.b), (t.a_ends, t.b_ends), self.sides, strict=True):
            out += [ids.astype("<u4").tobytes(), int(ends[0] - lengths[ids[0]]) if len(ids) else 0]
        return tuple(out)

    def unpack(self, row: dict, prefix: str = "") -> Tokens:
        out = []
        for side, lengths in zip("ab", self.sides, strict=True):
            ids = np.frombuffer(row[prefix + side], "<u4").astype(np.int64)
            out += [ids, row[f"{prefix}{side}_at"] + np.cumsum(lengths[ids])]
        return Tokens(*out)


def _packer(a_path: str, b_path: str) -> _Packer:
    return _Packer(encoder(PlainByteEncoder, a_path), encoder(PieceEncoder, b_path))


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _short(a_path: str, b_path: str):
    def run(batches):
        a, b = encoder(PlainByteEncoder, a_path), encoder(PieceEncoder, b_path)
        for batch in batches:
            for part in _slices(batch, 128):
                found = [groups_of(t or EMPTY) for t in encode_both(a, b, part.column(1).to_pylist())]
                lists = [_lists([g[i] for g in found]) for i in range(4)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["id", *Groups._fields])

    return run


def _units(unit_chars: int, b_path: str):
    """Long texts in parts that both tokenizers encode by themselves: row,
    unit, at (the byte its space stands at), text (without that space)."""

    def run(batches):
        can_cut = encoder(PieceEncoder, b_path).cuts
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                begin = at = unit = 0
                while True:
                    safe = _SAFE.search(text, begin + unit_chars) if can_cut else None
                    own = text[begin : safe.start()] if safe else text[begin:]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([unit], pa.int32()), pa.array([at], pa.int64()), pa.array([own])],
                        ["row", "unit", "at", "text"],
                    )
                    if not safe:
                        break
                    begin, at, unit = safe.end(), at + 1 + len(own.encode()), unit + 1

    return run


def _ranges(a_path: str, b_path: str, range_bytes: int):
    """Tokens of units, dealt into ranges by where they end; range -1 marks a
    unit whose tokens' bytes differ from it."""

    def run(batches):
        a, b = encoder(PlainByteEncoder, a_path), encoder(PieceEncoder, b_path)
        packer = _Packer(a, b)
        for batch in batches:
            for part in _slices(batch, 4):
                tokens = encode_both(a, b, part.column("text").to_pylist())
                rows: list[tuple] = []
                units = zip(*(part.column(n).to_pylist() for n in ("row", "unit", "at")), tokens, strict=True)
                for row, unit, at, t in units:
                    if t is None:
                        rows.append((row, -1, unit, b"", 0, b"", 0))
                        continue
                    t = t._replace(a_ends=t.a_ends + at, b_ends=t.b_ends + at)
                    a_at, b_at = (t.a_ends - 1) // range_bytes, (t.b_ends - 1) // range_bytes
                    for r in range(int(min(a_at[0], b_at[0])), int(a_at[-1]) + 1):
                        i, j = a_at == r, b_at == r
                        rows.append((row, r, unit, *packer.pack(Tokens(t.a[i], t.a_ends[i], t.b[j], t.b_ends[j]))))
                cols = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary(), pa.int64()] * 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["row", "range", "unit", *_PACKED]
                )

    return run


# Rows of a level: fragments (closed is false) and groups that were closed.
_LEVEL = T.StructType(
    [
        _ROW, T.StructField("range", T.IntegerType()), T.StructField("closed", T.BooleanType()), _AT,
        T.StructField("cut", T.BooleanType()),
        *(T.StructField(f"{end}_{n}", t) for end in ("prefix", "suffix") for n, t in _PACKED.items()),
        *_GROUPS,
    ]
)


def _level_table(row: int, at_range: int, fragment: tuple, closed: list[tuple[int, Groups]]) -> pa.Table:
    rows = [(row, at_range, False, None, *fragment, *[None] * 4)]
    for at, g in closed:
        rows.append((row, at_range, True, at, None, *[None] * 8, *(x.astype(np.int32) for x in g)))
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.bool_()]
    kinds += [*[pa.binary(), pa.int64()] * 4, *[pa.list_(pa.int32())] * 4]
    cols = zip(*rows, strict=True)
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=_LEVEL.fieldNames())


def _leaf(a_path: str, b_path: str):
    def run(group: pa.Table) -> pa.Table:
        packer = _packer(a_path, b_path)
        parts = sorted(group.to_pylist(), key=lambda r: r["unit"])
        fragment, closed, at = fragment_of(joined(*map(packer.unpack, parts)))
        packed = (fragment.cut, *packer.pack(fragment.prefix), *packer.pack(fragment.suffix))
        return _level_table(parts[0]["row"], parts[0]["range"], packed, parts_of(closed, at, packer.sides[0]) if closed else [])

    return run


def _branch(a_path: str, b_path: str):
    def run(group: pa.Table) -> pa.Table:
        packer = _packer(a_path, b_path)
        parts = sorted(group.to_pylist(), key=lambda r: r["range"])
        total, closed = IDENTITY, []
        for r in parts:
            total, between = compose(total, Fragment(r["cut"], packer.unpack(r, "prefix_"), packer.unpack(r, "suffix_")))
            if between is not None:
                closed.append((packer.pack(between)[1], one_group(between)))
        packed = (total.cut, *packer.pack(total.prefix), *packer.pack(total.suffix))
        return _level_table(parts[0]["row"], parts[0]["range"] // FAN, packed, closed)

    return run


def _last_groups(a_path: str, b_path: str):
    """The first group of each text, which no neighbour closed; at the end
    of a text both sides end, so the suffix is empty."""

    def run(batches):
        packer = _packer(a_path, b_path)
        for batch in batches:
            rows = batch.to_pylist()
            found = [one_group(packer.unpack(r, "prefix_")) for r in rows]
            if any(not r["cut"] or r["suffix_a"] or r["suffix_b"] for r in rows):
                raise ValueError("a text's last tokens don't end together")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([0] * len(rows), pa.int64()), *(_lists([g[i] for g in found]) for i in range(4))],
                ["row", "at", *Groups._fields],
            )

    return run


def align_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    a_path: str,
    b_path: str,
    unit_chars: int = UNIT_CHARS,
    range_bytes: int = RANGE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Groups of all texts, in two tables.

    Of texts up to ``unit_chars`` characters one row each: id, and the
    groups as a, b (array<int>, ids of both sides) and a_cuts, b_cuts (after
    how many ids each group ends).  Of longer ones, rows of consecutive
    groups with ``row`` (their text), id, and ``at`` (the byte, of space and
    text, at which they begin); a text without tokens has one row there too.
    """
    short, long = _by_length(df, id_col, text_col, unit_chars)
    out = T.StructType([T.StructField("id", short.schema["id"].dataType), *_GROUPS])
    return short.mapInArrow(_short(a_path, b_path), out), _align_long(long, a_path, b_path, unit_chars, range_bytes)


def _by_length(df: DataFrame, id_col: str, text_col: str, unit_chars: int) -> tuple[DataFrame, DataFrame]:
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.where(F.length("text") <= unit_chars), rows.where(F.length("text") > unit_chars)


def _align_long(rows: DataFrame, a_path: str, b_path: str, unit_chars: int, range_bytes: int) -> DataFrame:
    long = stage(rows.withColumn("row", F.monotonically_increasing_id()), "long-texts", GROUP_BYTES)
    unit_type = T.StructType([_ROW, T.StructField("unit", T.IntegerType()), _AT, T.StructField("text", T.StringType())])
    range_type = T.StructType([_ROW, T.StructField("range", T.IntegerType()), T.StructField("unit", T.IntegerType())])
    range_type = T.StructType([*range_type.fields, *(T.StructField(n, t) for n, t in _PACKED.items())])
    units = long.select("row", "text").mapInArrow(_units(unit_chars, b_path), unit_type).repartition("row", "unit")
    ranges = stage(units.mapInArrow(_ranges(a_path, b_path, range_bytes), range_type), "token-ranges", GROUP_BYTES)
    failed = ranges.where("range < 0").select("row").distinct()
    sound = ranges.where("range >= 0").join(failed.hint("merge"), "row", "left_anti").select(*range_type.fieldNames())
    level = stage(sound.groupBy("row", "range").applyInArrow(_leaf(a_path, b_path), _LEVEL), "fragments", GROUP_BYTES)
    pieces = ["row", "at", *Groups._fields]
    found = level.where("closed").select(pieces)
    last = level.agg(F.max("range")).first()[0] or 0
    while last > 0:
        level = level.where("not closed").withColumn("branch", F.expr(f"range div {FAN}"))
        level = stage(level.groupBy("row", "branch").applyInArrow(_branch(a_path, b_path), _LEVEL), "fragments", GROUP_BYTES)
        found = found.unionAll(level.where("closed").select(pieces))
        last //= FAN
    first = level.where("not closed").mapInArrow(_last_groups(a_path, b_path), T.StructType([_ROW, _AT, *_GROUPS]))
    none = failed.select("row", F.lit(0).cast("long").alias("at"), *(F.array().cast(_IDS).alias(n) for n in Groups._fields))
    found = found.unionAll(first).unionAll(none)
    return found.join(long.select("row", "id").hint("merge"), "row").select("row", "id", "at", *Groups._fields)


class _Digest:
    """What is kept of one text: counts, the hash of its groups, its links."""

    def __init__(self, names: list[bytes], b_names_at: int):
        self.names, self.b_names_at = names, b_names_at
        self.n_a = self.n_b = self.n_groups = 0
        self.sha = hashlib.sha256()
        self.links: list[np.ndarray] = []

    def add(self, g: Groups) -> None:
        if not len(g.a_cuts):
            return
        # ids in order of group and side, each followed by a comma, | or ;
        after_a, after_b = np.zeros(len(g.a), np.int64), np.zeros(len(g.b), np.int64)
        after_a[g.a_cuts - 1] = 1
        after_b[g.b_cuts - 1] = 1
        a_group = np.cumsum(after_a) - after_a
        b_group = np.cumsum(after_b) - after_b
        a_at = np.arange(len(g.a)) + np.concatenate([[0], g.b_cuts])[a_group]
        b_at = np.arange(len(g.b)) + g.a_cuts[b_group]
        names = np.empty(len(g.a) + len(g.b), np.int64)
        names[a_at] = 2 * g.a + after_a
        names[b_at] = 2 * g.b + after_b + self.b_names_at
        text = b"".join(map(self.names.__getitem__, names.tolist()))
        self.sha.update((b";" if self.n_groups else b"") + text[:-1])
        self.n_a, self.n_b, self.n_groups = self.n_a + len(g.a), self.n_b + len(g.b), self.n_groups + len(g.a_cuts)
        self.links.append((g.a[g.a_cuts - 1].astype(np.int64) << 32) | g.b[g.b_cuts - 1].astype(np.int64))

    def result(self) -> tuple:
        pairs, times = np.unique(np.concatenate(self.links), return_counts=True) if self.links else (NONE, NONE)
        return self.n_a, self.n_b, self.n_groups, self.sha.hexdigest() if self.n_groups else "", pairs, times


def _names(size_a: int, size_b: int) -> list[bytes]:
    """Each id with a comma, and with what ends its side of a group."""
    sides = ((size_a, "|"), (size_b, ";"))
    return [f"{i}{end}".encode() for size, last in sides for i in range(size) for end in (",", last)]


def _digests(a_path: str, b_path: str, out: T.StructType, keyed: bool):
    """Digests of rows of groups; with ``keyed`` rows of one text follow each
    other and are told by ``row``."""

    def run(batches):
        a, b = encoder(PlainByteEncoder, a_path), encoder(PieceEncoder, b_path)
        names = encoder(_names, len(a.pieces), len(b.pieces)), 2 * len(a.pieces)
        done, ids, id_type = [], [], None
        now, now_row = None, None

        def flush():
            cols = list(zip(*done, strict=True))
            offsets = np.zeros(len(done) + 1, np.int32)
            np.cumsum([len(x) for x in cols[4]], out=offsets[1:])
            element = lambda t: pa.list_(pa.field("element", t))
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(ids), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cols[4])), type=element(pa.int64())),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cols[5])), type=element(pa.int64())),
                ],
                out.fieldNames(),
            )

        for batch in batches:
            id_at = batch.schema.get_field_index("id")
            row = batch.column("row").to_pylist() if keyed else None
            lists = [batch.column(n) for n in Groups._fields]
            for i in range(batch.num_rows):
                if not keyed or now is None or row[i] != now_row:
                    if now is not None:
                        done.append(now.result())
                    if len(done) >= 256:
                        yield flush()
                        done, ids = [], []
                    now, now_row = _Digest(*names), row[i] if keyed else None
                    ids.append(batch.column(id_at).slice(i, 1))
                now.add(Groups(*(np.asarray(x[i].values).astype(np.int64) for x in lists)))
        if now is not None:
            done.append(now.result())
            yield flush()

    return run


def link_counts(links: DataFrame, frequent: int = FREQUENT) -> tuple[DataFrame, int]:
    """Of links (pair, times): staged pair, n (its count) and best (whether n
    is the highest of its B id's pairs); and the least count of a frequent pair."""
    counts = stage(links.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b", F.expr("pair & 4294967295")), "link-counts")
    # one row per id of B
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    judged = stage(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "link-counts")
    total = judged.agg(F.sum("n")).first()[0] or 0
    return judged, total // frequent + 1


def alignment_digests(
    df: DataFrame,
    id_col: str,
    text_col: str,
    a_path: str,
    b_path: str,
    unit_chars: int = UNIT_CHARS,
    range_bytes: int = RANGE_BYTES,
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per input row: the id column, n_a, n_b, n_groups, n_links,
    n_best (links whose count is the highest of their B id's), count_sum (of
    all links' counts) and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``, the ids of
    each group; empty without tokens)."""
    short, long = _by_length(df, id_col, text_col, unit_chars)
    long = _align_long(long, a_path, b_path, unit_chars, range_bytes)
    out = T.StructType(
        [T.StructField("id", short.schema["id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups")]
        + [T.StructField("groups_sha256", T.StringType())]
        + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("pairs", "times")]
    )
    streamed = long.repartition("row").sortWithinPartitions("row", "at")
    align, digest = _short(a_path, b_path), _digests(a_path, b_path, out, False)
    texts = short.mapInArrow(lambda batches: digest(align(batches)), out).unionAll(
        streamed.mapInArrow(_digests(a_path, b_path, out, True), out)
    )
    texts = stage(texts.withColumn("row", F.monotonically_increasing_id()), "aligned-texts", GROUP_BYTES)
    links = texts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    links = links.select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    counts, least = link_counts(links.select("pair", "times"), frequent)
    often = counts.where(F.col("n") >= least)  # fewer than ``frequent`` rows
    seldom = counts.where(F.col("n") < least)
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    ]
    first = links.join(F.broadcast(often), "pair").groupBy("row").agg(*sums)
    rest = links.join(F.broadcast(often.select("pair")), "pair", "left_anti").join(seldom.hint("merge"), "pair")
    both = first.unionAll(rest.groupBy("row").agg(*sums))
    both = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = texts.select("row", "id", "n_a", "n_b", "n_groups", "groups_sha256").join(both.hint("merge"), "row", "left")
    return whole.select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
