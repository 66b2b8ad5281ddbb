"""Token ids in files under a canonical, length-limited Huffman code.

Writing: encode every text, count all ids, derive one code of at most
LIMIT bits a symbol (package-merge), code each document, deal documents
into shards by ascending id, and write each shard as blocks of whole
documents.  A block holds its documents' ids, how many token ids each
has, the coded bits, and a checkpoint (bit offset) every STRIDE token ids,
so that blocks, and stretches between checkpoints, decode independently.
Reading decodes all stretches of a block side by side with one table
look-up a symbol.

The file format is a folder with two Parquet datasets: ``code`` (id, code
length: the canonical code follows from these) and ``blocks``.

What passes through the driver: one count per vocabulary id, and the
shards' bounds.

Defined results: a null text is the empty text (its document is the end
id alone); a null document id sorts first; equal ids sort by their token
ids' code, and rows repeated exactly are written as often; an empty table
gives an empty dataset; other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, text_of
from tripflow.llm.encoders import WordEncoder, encoder
from tripflow.session import scratch_path

LIMIT = 16
STRIDE = 64
BLOCK_IDS = 1 << 16
SAMPLE_PER_SHARD = 40
SHARD_BYTES = 64 << 20
SLICE = 256  # rows taken up at a time


# --- the code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits per symbol of an optimal prefix code with no code longer than
    ``limit``, by package-merge; 0 for symbols that don't occur."""
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(symbols)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of more than {limit} bits")
    if n <= 1:
        lengths[symbols] = 1
        return lengths
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    weight = counts[order].astype(np.int64)
    row, leaves = weight, [np.ones(n, bool)]
    for _ in range(limit - 1):
        half = len(row) // 2 * 2
        both = np.concatenate([weight, row[0:half:2] + row[1:half:2]])
        by = np.argsort(both, kind="stable")
        row = both[by]
        leaves.append(by < n)
    take, own = 2 * n - 2, np.zeros(n, np.uint8)
    for leaf in reversed(leaves):
        own_here = int(leaf[:take].sum())
        own[:own_here] += 1
        take = 2 * (take - own_here)
    lengths[order] = own
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    for s in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[s])
        if n:
            code <<= n - last
            codes[s], last = code, n
            code += 1
    return codes


class Coder:
    def __init__(self, lengths: np.ndarray, limit: int = LIMIT):
        self.lengths, self.limit = lengths.astype(np.int64), limit
        self.codes = canonical_codes(lengths)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        width = np.int64(1) << (limit - self.lengths[order])
        self.table = np.zeros(1 << limit, np.int32)  # symbol by the next bits
        self.table[: width.sum()] = np.repeat(order, width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits padded to whole bytes, and the bit offset of every
        STRIDE-th id."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        begins = ends - size
        spread = self.codes[ids] << (24 - size - (begins & 7)).astype(np.uint32)  # over three bytes
        at, total = begins >> 3, (int(ends[-1]) + 7) // 8 if len(ids) else 0
        out = np.zeros(total + 2, np.uint8)
        for k in range(3):  # bits of neighbours don't overlap, so sums are unions
            part = (spread >> np.uint32(16 - 8 * k)) & np.uint32(255)
            out[k : k + total] += np.bincount(at, part, total).astype(np.uint8)
        return out[:total].tobytes(), begins[::STRIDE]

    def encode_all(self, ids: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """What ``encode`` gives for each of the documents that ``ids`` holds
        one after another, ``counts`` of them each."""
        size = self.lengths[ids]
        bit = np.concatenate([[0], np.cumsum(size)])
        stop = np.cumsum(counts)
        start = stop - counts
        ends = np.cumsum((bit[stop] - bit[start] + 7) // 8)  # documents begin at whole bytes
        first = np.concatenate([[0], ends[:-1]])
        begins = bit[:-1] + np.repeat(8 * first - bit[start], counts)
        out = np.zeros(int(ends[-1]) + 2, np.uint8)
        if len(ids):
            spread = self.codes[ids] << (24 - size - (begins & 7)).astype(np.uint32)  # over three bytes
            at = begins >> 3
            heads = np.flatnonzero(np.diff(at, prepend=-1))
            spread, at = np.add.reduceat(spread, heads), at[heads]  # bits of neighbours don't overlap
            for k in range(3):
                out[at + k] += (spread >> np.uint32(16 - 8 * k)).astype(np.uint8)
        whole = out.tobytes()
        bits = [whole[a:b] for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
        marks = [begins[a:b:STRIDE] - 8 * f for a, b, f in zip(start.tolist(), stop.tolist(), first.tolist(), strict=True)]
        return bits, marks

    def decode(self, raw: bytes, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """ids of all stretches, one after another: stretch i begins at bit
        offsets[i] and has counts[i] <= STRIDE ids."""
        data = np.frombuffer(raw + b"\0\0\0\0", np.uint8).astype(np.uint32)
        three = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
        first = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        order = np.argsort(-counts, kind="stable")
        at, first, counts = offsets[order].astype(np.int64), first[order], counts[order]
        mask, low = np.uint32((1 << self.limit) - 1), 24 - self.limit
        live = len(counts)
        for step in range(int(counts[0]) if live else 0):
            live = int(np.searchsorted(-counts, -step, side="left"))  # those with more ids than step
            at = at[:live]
            symbol = self.table[(three[at >> 3] >> (low - (at & 7)).astype(np.uint32)) & mask]
            out[first[:live] + step] = symbol
            at = at + self.lengths[symbol]
        return out


# --- writing


def _concat(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def encoded_ids(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """id, ids: the whole text's ids and the end id, as bytes in two planes
    (low bytes, then high bytes of unsigned 16-bit integers), which pack
    better in Parquet.  Each task adds a row without ids that holds its
    ``tally``: how often it has written each id."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("tally", T.BinaryType())])
    end = np.array([end_id], "<u2").tobytes()

    def encode(batches):
        enc = encoder(WordEncoder, path, "<u2")
        tally = np.zeros(1 << 16, np.int64)
        arrow = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                coded = enc.encode(part.column(1).to_pylist())
                tally += np.bincount(np.frombuffer(b"".join(coded) + end * len(coded), "<u2"), minlength=1 << 16)
                planes = [np.frombuffer(x + end, np.uint8).reshape(-1, 2).T.tobytes() for x in coded]
                arrow = part.column(0).type
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(planes, pa.binary()), pa.nulls(len(planes), pa.binary())], out.fieldNames()
                )
        if arrow is not None:
            packed = zlib.compress(tally.tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, arrow), pa.nulls(1, pa.binary()), pa.array([packed], pa.binary())], out.fieldNames()
            )

    return rows.mapInArrow(encode, out)


def _from_planes(raw: bytes) -> np.ndarray:
    both = np.frombuffer(raw, np.uint8).reshape(2, -1).astype(np.int32)
    return both[0] | (both[1] << 8)


def _coded(coder: Coder, batch: pa.RecordBatch) -> Iterator[tuple[object, int, bytes, np.ndarray]]:
    """Key, number of ids, bits and checkpoints of each document, coded
    together as far as they are of BLOCK_IDS ids in all."""
    keys, held, size = [], [], 0

    def flush():
        counts = np.array([len(x) for x in held])
        return zip(keys, counts.tolist(), *coder.encode_all(np.concatenate(held), counts), strict=True)

    for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids = _from_planes(raw.as_py())
        if held and size + len(ids) > BLOCK_IDS:
            yield from flush()
            keys, held, size = [], [], 0
        keys.append(key)
        held.append(ids)
        size += len(ids)
    if held:
        yield from flush()


def id_counts(coded: DataFrame) -> np.ndarray:
    """How often each id occurs, from the tasks' tallies: one row per id
    reaches the driver."""
    size = 1 << 16

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(zlib.decompress(raw.as_py()), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "n"])

    found = coded.where("tally is not null").select("tally").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in found.collect():
        out[r["token"]] = r["n"]
    return out


_BLOCK = (
    "shard int, block int, start long, n_ids long, doc_ids array<{id}>, counts array<int>, "
    "first_bytes array<long>, checkpoints binary, bits binary"
)


def _bounds(ids: DataFrame, shards: int) -> tuple[list, int, int]:
    """Bounds between shards of ids, shards before them for rows without an
    id, and shards in all.  SAMPLE_PER_SHARD ids a shard reach the driver."""
    if shards < 2:
        return [], 0, 1
    n, nulls = ids.agg(F.count("*"), F.count_if(F.col("id").isNull())).first()
    null_shards = max(1, round(shards * nulls / n)) if nulls else 0
    if nulls == n:
        return [], null_shards - 1, null_shards
    own = max(1, shards - null_shards)
    share = min(1.0, SAMPLE_PER_SHARD * own / (n - nulls))
    some = ids.where("id IS NOT NULL").sample(False, share, seed=29).toArrow().column(0).to_pylist()
    some = sorted(x for x in some if x == x)
    bounds = [some[i * len(some) // own] for i in range(1, own)] if some else []
    return bounds, null_shards, null_shards + len(bounds) + 1


def _places(spark: SparkSession, shards: int) -> list[int]:
    """For each shard a number that hash partitioning puts into a partition
    of its own."""
    tried = int(shards * (math.log(shards) + 25))  # misses a partition with a chance of e**-25
    part = F.pmod(F.hash(F.col("id").cast("int")), F.lit(shards)).alias("part")
    rows = spark.range(tried).select(part, F.col("id").cast("int").alias("place")).groupBy("part").agg(F.min("place").alias("place"))
    return [r["place"] for r in sorted(rows.collect(), key=lambda r: r["part"])]


def write_ids(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, to: str) -> None:
    """Write the ids of every text, in ascending order of ``id_col``, to the
    folder ``to`` in the format above."""
    spark = df.sparkSession
    coded = encoded_ids(df, id_col, text_col, tokenizer, end_id)
    path = scratch_path(spark, "token-ids")
    coded.write.option("compression", "zstd").parquet(path)
    coded = spark.read.schema(coded.schema).parquet(path)
    id_type = coded.schema["id"].dataType

    total = id_counts(coded)
    coded = coded.where("ids is not null").select("id", "ids")
    lengths = code_lengths(total)
    used = np.flatnonzero(lengths)
    code = spark.createDataFrame([(int(s), int(lengths[s])) for s in used], "token int, bits int")
    code.coalesce(1).write.parquet(f"{to}/code")

    # Shards of about SHARD_BYTES, by bounds from a sample of the ids.  An id
    # so frequent that it fills several shards is several bounds, and its rows
    # are dealt among those; rows without an id have shards of their own.
    bytes_in_all = int((total * lengths).sum()) // 8
    shards = max(1, bytes_in_all // SHARD_BYTES + 1, min(spark.sparkContext.defaultParallelism, bytes_in_all >> 20))
    bounds, null_shards, shards = _bounds(coded.select("id"), shards)
    places = _places(spark, shards)
    rule = spark.sparkContext.broadcast((lengths, bounds, places))  # a byte per vocabulary id, two values per shard
    row = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("id", id_type),
            T.StructField("n", T.IntegerType()),
            T.StructField("bits", T.BinaryType()),
            T.StructField("checkpoints", T.BinaryType()),
            T.StructField("place", T.IntegerType()),
        ]
    )

    def to_bits(batches):
        lengths, bounds, places = rule.value
        coder = Coder(lengths)
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            shard, counts, bits, marks = [], [], [], []
            for key, n, packed, offsets in _coded(coder, batch):
                if key is None:
                    low, high = 0, max(null_shards - 1, 0)
                elif key != key:  # NaN comes last
                    low = high = len(places) - 1
                else:
                    low, high = null_shards + bisect_left(bounds, key), null_shards + bisect_right(bounds, key)
                shard.append(low + zlib.crc32(packed) % (high - low + 1))
                counts.append(n)
                bits.append(packed)
                marks.append(offsets.astype("<u8" if len(packed) >= 1 << 28 else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard, pa.int32()),
                    batch.column(0),
                    pa.array(counts, pa.int32()),
                    pa.array(bits, pa.binary()),
                    pa.array(marks, pa.binary()),
                    pa.array([places[s] for s in shard], pa.int32()),
                ],
                row.fieldNames(),
            )

    dealt = coded.mapInArrow(to_bits, row).repartition(shards, "place").drop("place").sortWithinPartitions("shard", "id", "bits")
    block_type = T._parse_datatype_string(_BLOCK.format(id=id_type.simpleString()))

    def to_blocks(batches) -> Iterator[pa.RecordBatch]:
        shard, block, start, held, size = None, 0, 0, [], 0

        def flush():
            nonlocal block, start, held, size
            whole = _concat(held)
            n, bits, marks = whole.column(2), whole.column(3).to_pylist(), whole.column(4).to_pylist()
            first = np.cumsum([0, *map(len, bits)])
            offsets = [
                np.frombuffer(m, "<u8" if len(b) >= 1 << 28 else "<u4").astype("<i8") + 8 * f
                for m, b, f in zip(marks, bits, first, strict=False)
            ]
            ids = int(np.asarray(n).sum())
            values = [
                [shard], [block], [start], [ids], [whole.column(1).to_pylist()], [n.to_pylist()],
                [first[:-1].tolist()], [np.concatenate(offsets).tobytes()], [b"".join(bits)],
            ]
            out = pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow
            )
            block, start, held, size = block + 1, start + ids, [], 0
            return out

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(block_type)
        for batch in batches:
            at = 0
            key = np.asarray(batch.column(0))
            n = np.asarray(batch.column(2), np.int64)
            for i in range(batch.num_rows):
                if key[i] != shard:
                    if at < i:
                        held.append(batch.slice(at, i - at))
                    if held:
                        yield flush()
                    shard, block, start, at = int(key[i]), 0, 0, i
                size += int(n[i])
                if size >= BLOCK_IDS:
                    held.append(batch.slice(at, i + 1 - at))
                    at = i + 1
                    yield flush()
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield flush()

    dealt.mapInArrow(to_blocks, block_type).write.option("compression", "none").parquet(f"{to}/blocks")


# --- reading


def read_code(spark: SparkSession, path: str) -> np.ndarray:
    """Code lengths by id, from the file: one row per vocabulary id."""
    lengths = np.zeros(1 << 16, np.uint8)
    for r in spark.read.schema("token int, bits int").parquet(f"{path}/code").collect():
        lengths[r["token"]] = r["bits"]
    return lengths


def decode_block(coder: Coder, counts: np.ndarray, checkpoints: bytes, bits: bytes) -> list[np.ndarray]:
    """The ids of each document of a block."""
    offsets = np.frombuffer(checkpoints, "<i8")
    pieces = -(-counts // STRIDE)
    size = np.full(int(pieces.sum()), STRIDE)
    size[np.cumsum(pieces) - 1] = counts - (pieces - 1) * STRIDE
    return np.split(coder.decode(bits, offsets, size), np.cumsum(counts)[:-1])


def read_ids(spark: SparkSession, path: str, id_type: T.DataType, digests: bool = False) -> DataFrame:
    """Documents of the files at ``path``: id, start (token ids of all
    documents before it), n_tokens, and ids array<int>, or with ``digests``
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    ship_package(spark)
    schema = T._parse_datatype_string(_BLOCK.format(id=id_type.simpleString()))
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    last = T.StructField("ids_crc32", T.LongType()) if digests else T.StructField("ids", T.ArrayType(T.IntegerType()))
    row = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("id", id_type),
            T.StructField("start_in_shard", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            last,
        ]
    )
    rule = spark.sparkContext.broadcast(read_code(spark, path))  # a byte per vocabulary id

    def decode(batches):
        coder = Coder(rule.value)
        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.asarray(batch.column("counts")[i].values).astype(np.int64)
                docs = decode_block(
                    coder, counts, batch.column("checkpoints")[i].as_py(), batch.column("bits")[i].as_py()
                )
                starts = batch.column("start")[i].as_py() + np.cumsum(counts) - counts
                if digests:
                    value = pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in docs], pa.int64())
                else:
                    value = pa.array([d.tolist() for d in docs], pa.list_(pa.field("element", pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(docs), batch.column("shard")[i].as_py(), np.int32)),
                        batch.column("doc_ids")[i].values,
                        pa.array(starts),
                        pa.array(counts),
                        value,
                    ],
                    row.fieldNames(),
                )

    offsets = (
        blocks.groupBy("shard")
        .agg(F.sum("n_ids").alias("n"))
        .select(
            "shard",
            F.coalesce(
                F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("before"),
        )
    )
    found = (
        blocks.select("shard", "start", "doc_ids", "counts", "checkpoints", "bits")
        .mapInArrow(decode, row)
        .join(offsets, "shard")
    )
    return found.select("id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", last.name)


def ids_round_trip(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of all documents, read the files back, and give each
    document's id, start, n_tokens and ids_crc32 as read."""
    spark = df.sparkSession
    path = scratch_path(spark, "id-files")
    write_ids(df, id_col, text_col, tokenizer, end_id, path)
    id_type = df.select(col(id_col)).schema[0].dataType
    return read_ids(spark, path, id_type, digests=True).withColumnRenamed("id", id_col)
