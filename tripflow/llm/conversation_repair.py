"""Conversation structure repair by square-root checkpointed dynamic programming.

A conversation's rows stand in the order of their turns (nulls first; ties
by role, then by the SHA-256 of role and text).  Each row's first fault
counts: blank (no character but white space), duplicate (role and text
seen earlier in the conversation) or truncated (last such character not
``.``, ``!`` or ``?``).  The repaired conversation has to alternate: its roles'
initials are ``(s?(ua)+)?``.  Edits and their costs: Keep 0, Rerole to user
or assistant 3, Delete 4 (required for blank and duplicate rows), Insert an
empty user or assistant turn anywhere 3; a truncated row that isn't
deleted costs 3 more.  Of the cheapest edits those come out whose initials
in order (the audit) are the least in ASCII.

The program has four states (nothing yet; after s, u, a).  Backward
vectors hold the cost from a row on for each state.  They are kept at every
sqrt(n)-th row only; going forward, the vectors of one block at a time are
computed again from its checkpoint, and each step takes the least edit that
is tight.  From a state and a letter the next state follows, so the walk
needs no look ahead.  Vectors less their least value are few, so a step
is a look-up.

On Spark, rows are dealt into ranges of (conversation, turn, ...), so one
conversation may cover many tasks.  A conversation that lies inside a range
is repaired there.  The others are cut at the range borders into segments:
each segment gives its first rows of each text (so that later segments
learn of their duplicates), a byte per row, and a 4 x 4 matrix of costs
from state to state.  Matrices are chained per conversation into the vector at each
segment's end (one row a segment), segments are walked from all four
states, and the states at their beginnings are chained in turn.  Texts stay in
pieces of about a megabyte and meet their edits piece by piece.

Defined results: a null conversation id is a conversation of its own; null
roles and texts are one space; rows of null turns come first; repeated rows
are duplicates of the first; a role that doesn't begin with s, u or a (also
an empty one) can't be kept; an empty table has no conversations; gaps is
maxTurn - minTurn + 1 - distinctTurns over turns that aren't null, at most
2**63 - 1; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, stage

WHITE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: State after a legal user or assistant turn.
NEXT = (2, 2, 3, 2)
#: Cost to end in each state: nothing, u and a, a, nothing.
END = (0, 6, 3, 0)
FAR = 1 << 40
PIECE_BYTES = 1 << 20
HELD_BYTES = 8 << 20

# Row classes: 0 must go; else 1 + 2 * initial + truncated, initials s, u, a, other.
_INITIAL = {"s": 0, "u": 1, "a": 2}


def keep_state(initial: int, state: int) -> int | None:
    """The state after keeping a row, or None where it may not stand."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return 2 if state != 2 else None
    return 3 if initial == 2 and state == 2 else None


def _consumed(kind: int, after: tuple, state: int) -> int:
    """Cost from a row on if the next edit uses it up."""
    best = DELETE + after[state]
    if kind:
        initial, extra = (kind - 1) // 2, TRUNCATED * ((kind - 1) % 2)
        best = min(best, REROLE + extra + after[NEXT[state]])
        kept = keep_state(initial, state)
        if kept is not None:
            best = min(best, extra + after[kept])
    return best


@lru_cache(maxsize=1 << 16)
def back(kind: int, after: tuple) -> tuple[int, tuple]:
    """The vector before a row from the one after it, as its least value
    and the rest."""
    c = [_consumed(kind, after, q) for q in range(4)]
    c[2], c[3] = min(c[2], INSERT + c[3]), min(c[3], INSERT + c[2])
    c[0], c[1] = min(c[0], INSERT + c[2]), min(c[1], INSERT + c[2])
    low = min(c)
    return low, tuple(x - low if x < FAR else FAR for x in c)


@lru_cache(maxsize=1 << 16)
def tight(kind: int, after: tuple, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits up to the one that uses a row up, and the
    state then."""
    low, vector = back(kind, after)
    out = ""
    while True:
        cost = low + vector[state]
        if DELETE + after[state] == cost:
            return out + "D", state
        if low + vector[NEXT[state]] + INSERT == cost:
            out, state = out + "I", NEXT[state]
            continue
        initial, extra = (kind - 1) // 2, TRUNCATED * ((kind - 1) % 2)
        kept = keep_state(initial, state)
        if kept is not None and extra + after[kept] == cost:
            return out + "K", kept
        return out + "R", NEXT[state]


def _normal(vector) -> tuple[int, tuple]:
    low = min(vector)
    return low, tuple(x - low if x < FAR else FAR for x in vector)


def cost_before(kinds: bytes, after) -> list[int]:
    """The vector before rows of these classes from the one after them."""
    total, vector = _normal(after)
    for kind in reversed(kinds):
        low, vector = back(kind, vector)
        total += low
    return [total + x if x < FAR else FAR for x in vector]


def matrix(kinds: bytes) -> list[int]:
    """Costs [state before][state after] of rows, inserts after the last
    row left out; 16 numbers."""
    columns = [cost_before(kinds, tuple(0 if r == q else FAR for q in range(4))) for r in range(4)]
    return [columns[r][q] for q in range(4) for r in range(4)]


def walk(kinds: bytes, after, state: int) -> tuple[list[str], int]:
    """The edits of each row (inserts before it, then its own) and the state
    after the last one; ``after`` is the vector after it."""
    n = len(kinds)
    step = isqrt(n) + 1
    _, vector = _normal(after)
    checkpoints = {}
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            checkpoints[i] = vector  # the vector after row i
        _, vector = back(kinds[i], vector)
    out = []
    for begin in range(0, n, step):
        end = min(n, begin + step)
        block = [checkpoints[end - 1]]
        for i in range(end - 1, begin, -1):
            block.append(back(kinds[i], block[-1])[1])
        for i in range(begin, end):
            edits, state = tight(kinds[i], block.pop(), state)
            out.append(edits)
    return out, state


def tail(state: int) -> str:
    """Inserts after the last row."""
    return "I" * (END[state] // INSERT)


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str], int]:
    """The turns that edits make of rows, and the state then."""
    new_roles, new_texts, at = [], [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = roles[at], texts[at]
            state = keep_state(_INITIAL.get(role[:1], 3), state)
        else:
            state = NEXT[state]
            role, text = ("user" if state == 2 else "assistant"), (texts[at] if edit == "R" else "")
        at += edit != "I"
        new_roles.append(role)
        new_texts.append(text)
    return new_roles, new_texts, state


class Segment:
    """The rows of one conversation in one range."""

    def __init__(self, conv):
        self.conv = conv
        self.kinds = bytearray()
        self.seen: set[bytes] = set()
        self.firsts: list[bytes] = []
        self.first_at: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.low = self.high = None
        self.initials: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.held = 0
        self.piece_rows: list[int] = []

    def add(self, turn, role: str, text: str, digest: bytes) -> None:
        bare = text.strip(WHITE)
        initial = role[:1]
        kind = 0
        if not bare:
            self.blank += 1
        elif digest in self.seen:
            self.duplicate += 1
        else:
            self.seen.add(digest)
            self.firsts.append(digest)
            self.first_at.append(len(self.kinds))
            cut = bare[-1] not in ".!?"
            self.truncated += cut
            kind = 1 + 2 * _INITIAL.get(initial, 3) + cut
        self.kinds.append(kind)
        if turn is not None:
            if self.high is None or turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.initials:
            self.illegal += self.initials[-1] + initial not in ("su", "ua", "au")
            self.initials[1:] = [initial]
        else:
            self.initials = [initial, initial]
        self.roles.append(role)
        self.texts.append(text)
        self.held += len(text) + len(role) + 16

    def report(self) -> list[int]:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal]

    def take_piece(self) -> tuple[list[str], list[str]]:
        roles, texts = self.roles, self.texts
        self.piece_rows.append(len(roles))
        self.roles, self.texts, self.held = [], [], 0
        return roles, texts


_STRINGS, _LONGS = T.ArrayType(T.StringType()), T.ArrayType(T.LongType())


def _staged_type(conv: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("conv", conv),
            T.StructField("kind", T.StringType()),  # whole, piece or segment
            T.StructField("part", T.IntegerType()),
            T.StructField("piece", T.IntegerType()),
            T.StructField("audit", T.StringType()),
            T.StructField("roles", _STRINGS),
            T.StructField("texts", _STRINGS),
            T.StructField("report", _LONGS),
            T.StructField("kinds", T.BinaryType()),
            T.StructField("firsts", T.ArrayType(T.BinaryType())),
            T.StructField("first_at", _LONGS),
            T.StructField("turns", _LONGS),  # least, greatest (null if none)
            T.StructField("initials", _STRINGS),
            T.StructField("piece_rows", _LONGS),
        ]
    )


class _Rows:
    """Rows of a schema gathered into Arrow batches of bounded size."""

    def __init__(self, fields: T.StructType, conv: pa.DataType):
        from pyspark.sql.pandas.types import to_arrow_type

        self.names = fields.fieldNames()
        self.types = [conv if f.name == "conv" else to_arrow_type(f.dataType) for f in fields]
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, size: int, **values) -> None:
        self.rows.append(tuple(values.get(n) for n in self.names))
        self.size += size + 100

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            cols = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, self.types, strict=True)], self.names)
            self.rows, self.size = [], 0


def _cut_segments(fields: T.StructType):
    def run(batches):
        part = TaskContext.get().partitionId()
        now, first, out = None, True, None

        def let_out(seg: Segment) -> None:
            size = seg.held
            number = len(seg.piece_rows)
            roles, texts = seg.take_piece()
            out.add(size, conv=seg.conv, kind="piece", part=part, piece=number, roles=roles, texts=texts)

        def close(seg: Segment, is_open: bool) -> None:
            if is_open or seg.piece_rows:
                if seg.roles:
                    let_out(seg)
                out.add(
                    40 * len(seg.firsts) + len(seg.kinds), conv=seg.conv, kind="segment", part=part, report=[*seg.report()[1:], seg.turns],
                    kinds=bytes(seg.kinds), firsts=seg.firsts, first_at=seg.first_at, turns=[seg.low, seg.high],
                    initials=seg.initials, piece_rows=seg.piece_rows,
                )
                return
            kinds = bytes(seg.kinds)
            edits, state = walk(kinds, END, 0)
            audit = "".join(edits) + tail(state)
            roles, texts, _ = repaired(audit, 0, seg.roles, seg.texts)
            cost = cost_before(kinds, END)[0]
            out.add(
                seg.held, conv=seg.conv, kind="whole", part=part, piece=0, audit=audit, roles=roles, texts=texts,
                report=[*seg.report(), cost],
            )

        for batch in batches:
            out = out or _Rows(fields, batch.schema.field("conv").type)
            conv, turn, role, text, digest = (batch.column(i).to_pylist() for i in range(5))
            for i in range(batch.num_rows):
                if now is None or conv[i] != now.conv:
                    if now is not None:
                        close(now, first)
                        first = False
                        yield from out.batches(PIECE_BYTES)
                    now = Segment(conv[i])
                now.add(turn[i], role[i], text[i], digest[i])
                # the first conversation of a range is open in any case, others once they are large
                if now.held >= (PIECE_BYTES if first or now.piece_rows else HELD_BYTES):
                    let_out(now)
                    yield from out.batches(PIECE_BYTES)
        if now is not None:
            close(now, True)
            yield from out.batches(0)

    return run


def _later_copies(segments: DataFrame) -> DataFrame:
    """conv, part, again: places of a segment's rows whose role and text an
    earlier segment has."""
    firsts = segments.select("conv", "part", F.explode(F.arrays_zip("firsts", "first_at")).alias("f"))
    firsts = firsts.select("conv", "part", F.col("f.firsts").alias("digest"), F.col("f.first_at").alias("at"))
    least = firsts.groupBy("conv", "digest").agg(F.min("part").alias("least"), F.count("*").alias("n")).where("n > 1")
    least = least.select(F.col("conv").alias("c"), F.col("digest").alias("d"), "least")
    again = firsts.join(least, firsts["conv"].eqNullSafe(least["c"]) & (firsts["digest"] == least["d"]))
    return again.where("part > least").groupBy("conv", "part").agg(F.collect_list("at").alias("again"))


def _with_matrix(batches):
    names = ["conv", "part", "kinds", "report", "turns", "initials", "piece_rows", "matrix"]
    for batch in batches:
        kinds_out, reports, matrices = [], [], []
        for kinds, report, again in zip(*(batch.column(n).to_pylist() for n in ("kinds", "report", "again")), strict=True):
            kinds = np.frombuffer(kinds, np.uint8).copy()
            blank, duplicate, truncated, illegal, turns = report
            if again:
                at = np.array(again)
                duplicate += len(at)
                truncated -= int(((kinds[at] - 1) % 2).sum())
                kinds[at] = 0
            kinds_out.append(kinds.tobytes())
            reports.append([blank, duplicate, truncated, illegal, turns])
            matrices.append(matrix(kinds_out[-1]))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"), batch.column("part"), pa.array(kinds_out, pa.binary()), pa.array(reports, longs),
                batch.column("turns"), batch.column("initials"), batch.column("piece_rows"), pa.array(matrices, longs),
            ],
            names,
        )


def _chain_back(group: pa.Table) -> pa.Table:
    """Of one conversation's segments: the vector after each one, and on the
    first one's row the report of all."""
    rows = sorted(group.to_pylist(), key=lambda r: r["part"])
    sums = [sum(r["report"][i] for r in rows) for i in range(5)]
    low = high = None
    last_initial = None
    for r in rows:
        (a, b), (x, y) = r["turns"], r["initials"]
        if a is not None:
            sums[4] -= high is not None and a == high
            low, high = (a if low is None else low), b
        if last_initial is not None:
            sums[3] += last_initial + x not in ("su", "ua", "au")
        last_initial = y
    gaps = 0 if low is None else min(high - low + 1 - sums[4], 2**63 - 1)
    vector, ends = list(END), []
    for r in reversed(rows):
        ends.append(list(vector))
        m = r["matrix"]
        vector = [min(m[4 * q + p] + vector[p] for p in range(4)) for q in range(4)]
    ends.reverse()
    reports = [[gaps, *sums[:4], vector[0]]] + [None] * (len(rows) - 1)
    longs = pa.list_(pa.int64())
    return pa.table(
        {
            "conv": pa.array([r["conv"] for r in rows], group.schema.field("conv").type),
            "part": pa.array([r["part"] for r in rows], pa.int32()),
            "after": pa.array(ends, longs),
            "last": pa.array([i == len(rows) - 1 for i in range(len(rows))]),
            "report": pa.array(reports, longs),
        }
    )


def _walk_all(batches):
    """A segment's edits from each of the four states, cut by pieces, and the
    states before each piece and at the end."""
    for batch in batches:
        audits, states = [], []
        cols = (batch.column(n).to_pylist() for n in ("kinds", "after", "piece_rows"))
        for kinds, after, piece_rows in zip(*cols, strict=True):
            own_audits, own_states = [], []
            for q in range(4):
                state, at = q, 0
                edits, end = walk(kinds, after, q)
                for n in piece_rows:
                    piece = "".join(edits[at : at + n])
                    own_audits.append(piece)
                    own_states.append(state)
                    state = _state_after(piece, kinds[at : at + n], state)
                    at += n
                own_states.append(end)
            audits.append(own_audits)
            states.append(own_states)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"), batch.column("part"), batch.column("last"), batch.column("report"),
                pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int64())),
            ],
            ["conv", "part", "last", "report", "audits", "states"],
        )


def _state_after(audit: str, kinds: bytes, state: int) -> int:
    at = 0
    for edit in audit:
        if edit == "K":
            state = keep_state((kinds[at] - 1) // 2, state)
        elif edit != "D":
            state = NEXT[state]
        at += edit != "I"
    return state


def _chain_forward(group: pa.Table) -> pa.Table:
    """Of one conversation's segments: the state before each one."""
    rows = sorted(group.to_pylist(), key=lambda r: r["part"])
    state, entry = 0, []
    for r in rows:
        entry.append(state)
        state = r["ends"][state]
    return pa.table(
        {
            "conv": pa.array([r["conv"] for r in rows], group.schema.field("conv").type),
            "part": pa.array([r["part"] for r in rows], pa.int32()),
            "entry": pa.array(entry, pa.int32()),
        }
    )


def _apply_edits(batches):
    for batch in batches:
        audits, new_roles, new_texts = [], [], []
        cols = (batch.column(n).to_pylist() for n in ("audit", "state", "is_end", "roles", "texts"))
        for audit, state, is_end, roles, texts in zip(*cols, strict=True):
            r, t, end = repaired(audit, state, roles, texts)
            if is_end:
                more = tail(end)
                a, b, _ = repaired(more, end, [], [])
                audit, r, t = audit + more, r + a, t + b
            audits.append(audit)
            new_roles.append(r)
            new_texts.append(t)
        strings = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in ("conv", "part", "piece")),
                pa.array(audits, pa.string()), pa.array(new_roles, strings), pa.array(new_texts, strings),
                batch.column("report"),
            ],
            ["conv", "part", "piece", "audit", "roles", "texts", "report"],
        )


def repair_conversations(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The repaired conversations in pieces, in order of (part, piece):
    conv, part, piece, whole (the only piece of its conversation), audit
    (edits' initials), roles and texts of the turns that stay or come in, and
    on a conversation's first piece ``report`` [gaps, blank, duplicate,
    truncated, illegal, cost]."""
    ship_package(df.sparkSession)
    space = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    rows = df.select(
        col(conv_col).alias("conv"),
        col(turn_col).cast("long").alias("turn"),
        space(role_col).alias("role"),
        space(text_col).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    # the last key only spreads rows that are equal in all others
    keys = ["conv", "turn", "role", "digest", "spread"]
    ordered = rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    conv_type = rows.schema["conv"].dataType
    fields = _staged_type(conv_type)
    cut = ordered.select("conv", "turn", "role", "text", "digest").mapInArrow(_cut_segments(fields), fields)
    cut = stage(cut, "conversation-pieces")
    whole = cut.where("kind = 'whole'").select("conv", "part", "piece", F.lit(True).alias("whole"), "audit", "roles", "texts", "report")

    conv = T.StructField("conv", conv_type)
    typed = lambda ddl: T.StructType([conv, *T._parse_datatype_string(ddl).fields])
    segments = cut.where("kind = 'segment'")
    narrow = segments.select("conv", "part", "kinds", "report", "turns", "initials", "piece_rows")
    again = _later_copies(segments.select("conv", "part", "firsts", "first_at"))
    again = again.select(F.col("conv").alias("c"), F.col("part").alias("p"), "again")
    marked = narrow.join(again, narrow["conv"].eqNullSafe(again["c"]) & (narrow["part"] == again["p"]), "left")
    marked = marked.drop("c", "p").mapInArrow(
        _with_matrix,
        typed(
            "part int, kinds binary, report array<long>, turns array<long>, initials array<string>, "
            "piece_rows array<long>, matrix array<long>"
        ),
    )
    marked = stage(marked, "conversation-segments")
    after = (
        marked.select("conv", "part", "report", "turns", "initials", "matrix")
        .groupBy("conv")
        .applyInArrow(_chain_back, typed("part int, after array<long>, last boolean, report array<long>"))
    )
    ends = _joined(marked.select("conv", "part", "kinds", "piece_rows"), after, "after", "last", "report")
    walked = ends.mapInArrow(
        _walk_all, typed("part int, last boolean, report array<long>, audits array<string>, states array<long>")
    )
    walked = stage(walked, "conversation-walks")
    n = F.expr("size(audits) div 4")
    at_end = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.element_at("states", (q * (n + 1) + n + 1).cast("int")))
    entry = (
        walked.select("conv", "part", at_end.alias("ends"))
        .groupBy("conv")
        .applyInArrow(_chain_forward, typed("part int, entry int"))
    )
    entered = _joined(walked, entry, "entry")
    edits = entered.select(
        "conv", "part", "last", "report", n.alias("n"),
        F.slice("audits", (F.col("entry") * n + 1).cast("int"), n.cast("int")).alias("audits"),
        F.slice("states", (F.col("entry") * (n + 1) + 1).cast("int"), n.cast("int")).alias("states"),
    )
    edits = edits.select("conv", "part", "last", "report", "n", F.posexplode(F.arrays_zip("audits", "states")).alias("piece", "e"))
    edits = edits.select(
        F.col("conv").alias("c"), F.col("part").alias("p"), F.col("piece").alias("k"), F.col("e.audits").alias("audit"),
        F.col("e.states").alias("state"), (F.col("last") & (F.col("piece") == F.col("n") - 1)).alias("is_end"),
        F.when(F.col("piece") == 0, F.col("report")).alias("report"),
    )
    raw = cut.where("kind = 'piece'").select("conv", "part", "piece", "roles", "texts")
    both = raw.join(
        edits, raw["conv"].eqNullSafe(edits["c"]) & (raw["part"] == edits["p"]) & (raw["piece"] == edits["k"])
    ).drop("c", "p", "k")
    done = both.mapInArrow(
        _apply_edits,
        typed("part int, piece int, audit string, roles array<string>, texts array<string>, report array<long>"),
    )
    done = done.select("conv", "part", "piece", F.lit(False).alias("whole"), "audit", "roles", "texts", "report")
    return whole.unionByName(done)


def _joined(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    right = right.select(F.col("conv").alias("c"), F.col("part").alias("p"), *names)
    return left.join(right, left["conv"].eqNullSafe(right["c"]) & (left["part"] == right["p"])).drop("c", "p")


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """conv, part, piece, number, role, text of every repaired turn, in the
    order of the middle three."""
    return pieces.select("conv", "part", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("number", "turn")).select(
        "conv", "part", "piece", "number", "turn.roles", "turn.texts"
    ).toDF("conv", "part", "piece", "number", "role", "text")


def repair_digests(pieces: DataFrame, conv_col: str) -> DataFrame:
    """One row per conversation: its id, the report, the whole audit and
    repaired_sha256 (of ``role:text`` of the turns, joined by newlines).

    A hash takes its bytes one after another: the pieces of a conversation
    are streamed through it in one task, a piece in memory at a time.
    """
    conv_type = pieces.schema["conv"].dataType
    out = T.StructType(
        [T.StructField("conv", conv_type)]
        + [T.StructField(n, T.LongType()) for n in REPORT]
        + [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )

    def digest(batches):
        started, conv, sha, any_turn, audits, report = False, None, None, False, [], None
        rows: list[tuple] = []
        conv_arrow = None

        def flush():
            cols = list(zip(*rows, strict=True))
            types = [conv_arrow] + [pa.int64()] * len(REPORT) + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], out.fieldNames())

        for batch in batches:
            conv_arrow = batch.schema.field("conv").type
            names = ("conv", "piece", "part", "audit", "roles", "texts", "report")
            for c, _, _, audit, roles, texts, rep in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if not started or rep is not None:
                    if started:
                        rows.append((conv, *report, "".join(audits), sha.hexdigest()))
                    started, conv, sha, any_turn, audits, report = True, c, hashlib.sha256(), False, [], rep
                audits.append(audit)
                if roles:
                    lines = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts, strict=True))
                    sha.update((("\n" if any_turn else "") + lines).encode())
                    any_turn = True
            if len(rows) >= 1000:
                yield flush()
                rows = []
        if started:
            rows.append((conv, *report, "".join(audits), sha.hexdigest()))
        if rows:
            yield flush()

    alone = pieces.where("whole").drop("whole").mapInArrow(digest, out)
    several = pieces.where("not whole").drop("whole").repartition("conv").sortWithinPartitions("conv", "part", "piece")
    return alone.unionAll(several.mapInArrow(digest, out)).withColumnRenamed("conv", conv_col)


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Conversations with planted faults, by crc32 of ``conv:turn`` modulo
    20: 0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it,
    3 repeats it, 4 makes its role user.  Nulls are one space."""
    space = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")), F.lit(20))

    def text_after(h: Column) -> Column:
        text = space(text_col)
        return F.when(h == 1, F.lit("")).when(h == 2, F.translate(text, ".!?", "")).otherwise(text)

    rows = df.where(h != 0).withColumn("_times", F.when(h == 3, 2).otherwise(1))
    rows = rows.select(
        col(conv_col).alias("conv"),
        col(turn_col).alias("turn"),
        F.when(h == 4, F.lit("user")).otherwise(space(role_col)).alias("role"),
        text_after(h).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_time"),
    )
    return rows.select("conv", "turn", "role", "text")


def damage_and_repair(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``repair_digests`` of damaged conversations, with a row for every
    conversation of ``df``: zeros, an empty audit and the empty text's hash
    where no row is left."""
    pieces = repair_conversations(damaged(df, conv_col, turn_col, role_col, text_col), "conv", "turn", "role", "text")
    found = repair_digests(pieces, "conv")
    every = df.select(col(conv_col).alias("id")).distinct()
    both = every.join(found.hint("merge"), every["id"].eqNullSafe(found["conv"]), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return both.select(
        F.col("id").alias(conv_col),
        *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in REPORT),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
