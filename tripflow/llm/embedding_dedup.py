"""All pairs of vectors at a cosine threshold, by dual traversal of cover
trees, with link counts and connected components.

On unit vectors, cosine >= t is distance <= sqrt(2 - 2t).  The top of the
tree is built on the driver from a bounded sample: its points in
farthest-first order, of which every prefix is a net whose covering radius
shrinks as it grows.  Every vector goes to its nearest anchor; an anchor's
vectors are cut by hash into blocks of bounded size, and each block grows
its own lower levels in a task: nested nets at radii 1, 1/2, 1/4, 1/8,
keeping the levels that at least halve the nodes below.  Every node knows
its covering radius, the measured distance to its farthest point.

The traversal visits pairs of nodes, from anchors over blocks to points.
A pair is left out if its centres are farther apart than both radii and the
link distance together: no link can lie below it.  A pair whose centres'
distance and both radii are within the link distance is linked whole,
without visiting its points, so a large group of near copies costs its
nodes and not its pairs.  Both bounds are exact; what remains is compared in
double precision, and products within 1e-9 of the threshold are computed
again without rounding of the sums.

Equal vectors are one point that counts its copies.  Out of a pair of
blocks come a count per point and a spanning forest of its links, never
the links themselves.

Defined results: a vector that is null, empty, all zeros, or holds a null,
NaN or infinite component links with nothing; vectors of different lengths
don't link; equal ids are counted as separate vectors, and repeated rows
link with each other; null ids are vectors too, and a component of only
null ids has a null name; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, stage
from tripflow.llm.components import connected_components

COSINE = 0.95
BLOCK_POINTS = 8192
BLOCK_BYTES = 32 << 20
MAX_ANCHORS = 512
SAMPLE_BYTES = 16 << 20
RADII = (1.0, 0.5, 0.25, 0.125)
SLACK = 1e-7  # of distances, so that rounding never decides a bound
TILE = 1024
KEPT_TREES = 6


def unit_rows(raw: np.ndarray) -> np.ndarray:
    big = np.abs(raw).max(1, keepdims=True)
    scaled = raw / big
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b)))


def farthest_first(points: np.ndarray, k: int) -> np.ndarray:
    """Indices of k points, each the farthest from those before it."""
    chosen = [0]
    near = distances(points, points[:1])[:, 0]
    while len(chosen) < k:
        i = int(np.argmax(near))
        if near[i] <= SLACK:
            break
        chosen.append(i)
        near = np.minimum(near, distances(points, points[i : i + 1])[:, 0])
    return np.array(chosen)


def net(points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of centres more than ``radius`` apart, and for each point
    the position of a centre within it."""
    n = len(points)
    parent = np.full(n, -1)
    centres: list[int] = []
    least = 1.0 - radius * radius / 2.0  # cosine at the radius
    for begin in range(0, n, TILE // 2):
        tile = points[begin : begin + TILE // 2]
        if centres:
            cos = tile @ points[centres].T
            best = cos.argmax(1)
            near = cos[np.arange(len(tile)), best] >= least
            parent[begin : begin + len(tile)][near] = best[near]
        left = np.flatnonzero(parent[begin : begin + len(tile)] < 0)
        if not len(left):
            continue
        own = tile[left] @ tile[left].T
        new: list[int] = []
        first = len(centres)
        for i in range(len(left)):
            if new:
                c = own[i, new]
                j = int(c.argmax())
                if c[j] >= least:
                    parent[begin + left[i]] = first + j
                    continue
            parent[begin + left[i]] = first + len(new)
            new.append(i)
            centres.append(begin + int(left[i]))
    return np.array(centres), parent


class Tree:
    """Levels from coarse to fine.  levels[i] = (centres, radii, children):
    points at the centres, covering radii, and for each node the nodes of
    the next level (or the points, on the finest) below it."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.points = raw, unit_rows(raw)
        members = [np.array([i]) for i in range(len(raw))]  # points below each node
        at = np.arange(len(raw))
        self.levels: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []
        self.below: list[list[np.ndarray]] = []
        for radius in reversed(RADII):
            chosen, parent = net(self.points[at], radius)
            if len(chosen) * 2 > len(at):
                continue
            order = np.argsort(parent, kind="stable")
            children = np.split(order, np.cumsum(np.bincount(parent, minlength=len(chosen)))[:-1])
            members = [np.concatenate([members[c] for c in kids]) for kids in children]
            at = at[chosen]
            far = [
                float(distances(self.points[i : i + 1], self.points[m]).max()) for i, m in zip(at, members, strict=True)
            ]
            self.levels.insert(0, (at, np.array(far), children))
            self.below.insert(0, members)
        self.depth = len(self.levels)

    def nodes(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Centres and radii; below the last level, the points themselves."""
        if level == self.depth:
            return np.arange(len(self.points)), np.zeros(len(self.points))
        return self.levels[level][:2]

    def children(self, level: int, node: int) -> np.ndarray:
        return self.levels[level][2][node] if level < self.depth else np.array([node])


class Links:
    """What a pair of blocks yields: links of each point, and a forest."""

    def __init__(self, a: Tree, b: Tree, same: bool, copies_a: np.ndarray, copies_b: np.ndarray, cosine: float):
        self.a, self.b, self.same, self.cosine = a, b, same, cosine
        self.reach = math.sqrt(2.0 - 2.0 * cosine)
        self.copies_a, self.copies_b = copies_a, copies_b
        self.count_a, self.count_b = np.zeros(len(a.points), np.int64), np.zeros(len(b.points), np.int64)
        self.root: dict[tuple[int, int], tuple[int, int]] = {}
        self.forest: list[tuple[int, int]] = []

    def _find(self, x):
        while self.root.get(x, x) != x:
            self.root[x] = self.root.get(self.root[x], self.root[x])
            x = self.root[x]
        return x

    def _join(self, i: int, j: int) -> None:
        x, y = self._find((0, i)), self._find((0 if self.same else 1, j))
        if x != y:
            self.root[x] = y
            self.forest.append((i, j))

    def run(self) -> Links:
        self._visit(0, 0, [(None, None)])
        return self

    def _visit(self, la: int, lb: int, frontier) -> None:
        """frontier: (nodes of a at level la, nodes of b at level lb) to be
        compared with each other; None for all."""
        a, b = self.a, self.b
        for rows, cols in frontier:
            ca, ra = a.nodes(la)
            cb, rb = b.nodes(lb)
            rows = np.arange(len(ca)) if rows is None else rows
            cols = np.arange(len(cb)) if cols is None else cols
            for begin in range(0, len(rows), TILE):
                part = rows[begin : begin + TILE]
                if la == a.depth and lb == b.depth:
                    self._points(part, cols)
                    continue
                apart = distances(a.points[ca[part]], b.points[cb[cols]])
                both = ra[part][:, None] + rb[cols][None, :]
                near = apart <= both + self.reach + SLACK
                whole = apart + both <= self.reach - SLACK
                for i, j in zip(*np.nonzero(whole), strict=True):
                    self._whole(la, int(part[i]), lb, int(cols[j]))
                near &= ~whole
                na, nb = min(la + 1, a.depth), min(lb + 1, b.depth)
                below_b = [b.children(lb, int(j)) if lb < b.depth else np.array([j]) for j in cols]
                for i in np.flatnonzero(near.any(1)):
                    kids_a = a.children(la, int(part[i])) if la < a.depth else np.array([part[i]])
                    kids_b = np.concatenate([below_b[j] for j in np.flatnonzero(near[i])])
                    self._visit(na, nb, [(kids_a, kids_b)])

    def _leaves(self, tree: Tree, level: int, node: int) -> np.ndarray:
        return tree.below[level][node] if level < tree.depth else np.array([node])

    def _whole(self, la: int, i: int, lb: int, j: int) -> None:
        x, y = self._leaves(self.a, la, i), self._leaves(self.b, lb, j)
        ci, cj = int(self.a.nodes(la)[0][i]), int(self.b.nodes(lb)[0][j])
        self.count_a[x] += self.copies_b[y].sum()
        if self.same:
            both = np.intersect1d(x, y)
            self.count_a[both] -= self.copies_b[both]
        else:
            self.count_b[y] += self.copies_a[x].sum()
        for p in x:
            if not (self.same and p == cj):
                self._join(int(p), cj)
        for q in y:
            if not (self.same and q == ci):
                self._join(ci, int(q))

    def _points(self, rows: np.ndarray, cols: np.ndarray) -> None:
        for begin in range(0, len(cols), 8 * TILE):
            some = cols[begin : begin + 8 * TILE]
            cos = self.a.points[rows] @ self.b.points[some].T
            i, j = np.nonzero(cos >= self.cosine - 1e-9)
            near = cos[i, j] < self.cosine + 1e-9
            i, j = rows[i], some[j]
            if self.same:
                other = i != j
                i, j, near = i[other], j[other], near[other]
            if near.any():
                good = ~near
                for k in np.flatnonzero(near):
                    good[k] = exact_cosine(self.a.raw[i[k]], self.b.raw[j[k]]) >= self.cosine
                i, j = i[good], j[good]
            np.add.at(self.count_a, i, self.copies_b[j])
            if not self.same:
                np.add.at(self.count_b, j, self.copies_a[i])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                self._join(x, y)


def _vectors(raw: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f8") for x in raw])


def points_of(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, node (digest of the vector's bytes; null where the vector links
    with nothing), vector (doubles), size.  Minus zero counts as zero."""
    v = F.transform(col(vec_col), lambda x: x.cast("double") + F.lit(0.0))
    rows = df.select(col(id_col).alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    sound = F.coalesce(finite & F.exists("v", lambda x: x != 0.0), F.lit(False))
    rows = rows.select("id", F.when(sound, F.col("v")).alias("v"))
    out = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("vector", T.BinaryType()),
            T.StructField("size", T.IntegerType()),
        ]
    )

    def pack(batches):
        for batch in batches:
            vec = [None if x is None else np.array(x, "<f8") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([None if x is None else x.tobytes() for x in vec], pa.binary()),
                    pa.array([0 if x is None else len(x) for x in vec], pa.int32()),
                ],
                out.fieldNames(),
            )

    packed = rows.mapInArrow(pack, out)
    return packed.withColumn("node", F.when(F.col("vector").isNotNull(), F.unhex(F.sha2("vector", 256))))


def _anchors(points: DataFrame, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """Anchors (unit vectors) by vector length, from a sample of points
    with the lowest digests, of SAMPLE_BYTES at most."""
    out = {}
    share = SAMPLE_BYTES // len(counts)
    for size, n in counts.items():
        k = min(MAX_ANCHORS, -(-n // _block_points(size)))
        most = max(k, min(n, share // (8 * size)))
        rows = points.where(F.col("size") == size).orderBy("node").limit(most).select("vector").collect()
        unit = unit_rows(_vectors([r[0] for r in rows]))
        out[size] = unit[farthest_first(unit, k)]
    return out


def _block_points(size: int) -> int:
    return max(64, min(BLOCK_POINTS, BLOCK_BYTES // (8 * size)))


def similar_components(df: DataFrame, id_col: str, vec_col: str, cosine: float = COSINE) -> DataFrame:
    """One row per input row: the id column, n_links (other vectors linked
    with it), component_id (least id reachable by links), kept (whether
    that is the vector's own id)."""
    spark = df.sparkSession
    ship_package(spark)
    rows = stage(points_of(df, id_col, vec_col), "vectors")
    sound = rows.where("node is not null")
    points = stage(
        sound.groupBy("node", "vector", "size").agg(F.count("*").alias("copies"), F.min("id").alias("id")), "points"
    )
    counts = {r["size"]: r["count"] for r in points.groupBy("size").count().orderBy("size").collect()}
    if counts:
        links = stage(_block_links(points, _anchors(points, counts), cosine), "block-links")
    else:
        links = spark.createDataFrame([], "node binary, other binary, links long")
    per_node = links.groupBy("node").agg(F.sum("links").alias("links"))
    edges = links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    parts = connected_components(edges) if edges.limit(1).count() else spark.createDataFrame([], "node binary, component binary")
    named = (
        points.select("node", "copies", "id")
        .join(parts, "node", "left")
        .select("node", "copies", "id", F.coalesce("component", "node").alias("component"))
    )
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_node = (
        named.join(least, "component")
        .join(per_node, "node", "left")
        .select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    whole = rows.select("id", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return whole.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("id").isNull()).alias("kept"),
    )


def _block_links(points: DataFrame, anchors: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """node, other (null in counts), links: counts per block pair, and the
    forests' edges."""
    spark = points.sparkSession
    first = dict(zip(anchors, np.cumsum([0, *map(len, anchors.values())]).tolist(), strict=False))
    top = spark.sparkContext.broadcast((anchors, first))  # MAX_ANCHORS vectors a length

    def assign(batches):
        anchors, first = top.value
        for batch in batches:
            size = np.asarray(batch.column("size"))
            anchor, far = np.zeros(len(size), np.int32), np.zeros(len(size))
            raw = batch.column("vector").to_pylist()
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                apart = distances(unit_rows(_vectors([raw[i] for i in at])), anchors[s])
                anchor[at] = first[s] + apart.argmin(1)
                far[at] = apart.min(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(anchor), pa.array(far)], [*batch.schema.names, "anchor", "far"]
            )

    kind = "node binary, vector binary, size int, copies long, anchor int, far double"
    placed = stage(points.select("node", "vector", "size", "copies").mapInArrow(assign, kind), "placed-points")
    found = placed.groupBy("anchor", "size").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    radius = {r["anchor"]: r["radius"] for r in found}
    blocks_of = {r["anchor"]: -(-r["n"] // _block_points(r["size"])) for r in found}

    # pairs of anchors, pruned here: MAX_ANCHORS^2 / 2 of a length at most
    reach = math.sqrt(2.0 - 2.0 * cosine)
    partners: list[tuple[int, list[int]]] = []
    for size, unit in anchors.items():
        own = [first[size] + i for i in range(len(unit)) if first[size] + i in radius]
        apart = distances(unit, unit)
        for a in own:
            near = [
                b for b in own
                if b >= a and apart[a - first[size], b - first[size]] <= radius[a] + radius[b] + reach + SLACK
            ]
            partners.append((a, near))
    pairs = spark.createDataFrame(partners, "a int, near array<int>").select("a", F.explode("near").alias("b"))

    n_blocks = F.create_map(*(F.lit(x) for kv in sorted(blocks_of.items()) for x in kv))
    block = F.pmod(F.xxhash64("node"), n_blocks[F.col("anchor")].cast("long")).cast("int")

    def pack(group: pa.Table) -> pa.Table:
        order = np.argsort(np.array([x.as_py() for x in group.column("node")], dtype=object), kind="stable")
        group = group.take(pa.array(order))
        return pa.table(
            {
                "anchor": group.column("anchor")[:1].cast(pa.int32()),
                "block": group.column("block")[:1].cast(pa.int32()),
                "nodes": pa.array([b"".join(group.column("node").to_pylist())], pa.binary()),
                "copies": pa.array([np.asarray(group.column("copies")).astype("<i8").tobytes()], pa.binary()),
                "vectors": pa.array([b"".join(group.column("vector").to_pylist())], pa.binary()),
            }
        )

    blocks = stage(
        placed.withColumn("block", block)
        .select("anchor", "block", "node", "copies", "vector")
        .groupBy("anchor", "block")
        .applyInArrow(pack, "anchor int, block int, nodes binary, copies binary, vectors binary"),
        "blocks",
    )
    side = lambda s: blocks.select(
        F.col("anchor").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("block", "nodes", "copies", "vectors"))
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("a <> b or block_a <= block_b")

    def tree(nodes: bytes, copies: bytes, vectors: bytes):
        n = len(nodes) // 32
        names = [nodes[32 * i : 32 * i + 32] for i in range(n)]
        return names, np.frombuffer(copies, "<i8"), Tree(np.frombuffer(vectors, "<f8").reshape(n, -1))

    def traverse(batches):
        out = ["node", "other", "links"]
        grown: dict[tuple[int, int], tuple] = {}  # the last few blocks' trees

        def block(batch, i, side):
            key = (batch.column(side)[i].as_py(), batch.column(f"block_{side}")[i].as_py())
            if key not in grown:
                if len(grown) >= KEPT_TREES:
                    grown.pop(next(iter(grown)))
                grown[key] = tree(*(batch.column(f"{c}_{side}")[i].as_py() for c in ("nodes", "copies", "vectors")))
            return key, grown[key]

        for batch in batches:
            for i in range(batch.num_rows):
                key_a, (names_a, copies_a, tree_a) = block(batch, i, "a")
                key_b, (names_b, copies_b, tree_b) = block(batch, i, "b")
                same = key_a == key_b
                found = Links(tree_a, tree_b, same, copies_a, copies_b, cosine).run()
                rows = [(names_a[k], None, int(found.count_a[k])) for k in np.flatnonzero(found.count_a)]
                if not same:
                    rows += [(names_b[k], None, int(found.count_b[k])) for k in np.flatnonzero(found.count_b)]
                rows += [(names_a[x], names_b[y], 0) for x, y in found.forest]
                for at in range(0, len(rows), 65_536):
                    cols = list(zip(*rows[at : at + 65_536], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64())],
                        out,
                    )

    return both.mapInArrow(traverse, "node binary, other binary, links long")
