"""Repairs against a search over all edits, and against one plain program."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import Row

from tripflow.llm import conversation_repair as C

SHAPE = re.compile("(s?(ua)+)?")


def shortest(rows):
    """Cheapest (cost, audit, turns) over all edit sequences, by Dijkstra over
    whole outputs; rows as (role, text, must_go, truncated)."""
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in out)
        if i == len(rows) and SHAPE.fullmatch(initials):
            return cost, audit, list(out)
        if (audit, initials) in seen or len(out) > len(rows) + 4 or not re.fullmatch("s?(ua)*u?", initials):
            continue
        seen.add((audit, initials))
        if i < len(rows):
            role, text, must, cut = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, out))
            if not must:
                heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, (*out, (new, text))))
        for new in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, (*out, (new, ""))))
    raise AssertionError


def kinds_of(rows):
    out = bytearray()
    for role, _, must, cut in rows:
        out.append(0 if must else 1 + 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + cut)
    return bytes(out)


def test_audits_equal_a_search_over_all_edits():
    rng = random.Random(4)
    for _ in range(250):
        rows = [
            (rng.choice(["system", "user", "assistant", "tool"]), f"t{i}", rng.random() < 0.2, rng.random() < 0.3)
            for i in range(rng.randrange(0, 6))
        ]
        cost, audit, turns = shortest(rows)
        kinds = kinds_of(rows)
        edits, state = C.walk(kinds, C.END, 0)
        got = "".join(edits) + C.tail(state)
        roles, texts, _ = C.repaired(got, 0, [r[0] for r in rows], [r[1] for r in rows])
        assert (C.cost_before(kinds, C.END)[0], got) == (cost, audit), rows
        assert list(zip(roles, texts, strict=True)) == turns


def plain_walk(kinds):
    """The same program with every vector kept."""
    vectors = [list(C.END)]
    for k in reversed(kinds):
        vectors.append(C.cost_before(bytes([k]), vectors[-1]))
    vectors.reverse()
    out, q = "", 0
    for i, k in enumerate(kinds):
        while True:
            here, after = vectors[i], vectors[i + 1]
            if 4 + after[q] == here[q]:
                out += "D"
                break
            if 3 + here[C.NEXT[q]] == here[q]:
                out, q = out + "I", C.NEXT[q]
                continue
            kept, extra = C.keep_state((k - 1) // 2, q), 3 * ((k - 1) % 2)
            if kept is not None and extra + after[kept] == here[q]:
                out, q = out + "K", kept
            else:
                out, q = out + "R", C.NEXT[q]
            break
    return vectors[0][0], out + C.tail(q)


def test_checkpoints_and_chained_matrices_equal_all_vectors_kept():
    rng = random.Random(6)
    for n in (1, 2, 3, 8, 50, 257, 2000):
        kinds = bytes(rng.choice([0, 1, 3, 4, 5, 6, 7, 8, 3, 5]) for _ in range(n))
        cost, audit = plain_walk(kinds)
        edits, q = C.walk(kinds, C.END, 0)
        assert "".join(edits) + C.tail(q) == audit
        assert C.cost_before(kinds, C.END)[0] == cost
        cuts = sorted({0, n, *(rng.randrange(n + 1) for _ in range(4))})
        parts = [kinds[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        vector, after = list(C.END), []
        for part in reversed(parts):
            after.append(vector)
            m = C.matrix(part)
            vector = [min(m[4 * s + r] + vector[r] for r in range(4)) for s in range(4)]
        assert vector[0] == cost
        state, out = 0, ""
        for part, v in zip(parts, reversed(after), strict=True):
            edits, state = C.walk(part, v, state)
            out += "".join(edits)
        assert out + C.tail(state) == audit


def expected(rows):
    """Per conversation: the query's columns from (conv, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        mine += [(turn, role, text)] * (2 if h == 3 else 1)
    out = {}
    for conv, mine in convs.items():
        tie = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), tie(r)))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, kinds, count = set(), bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            bare = re.sub("[\x20\x09-\x0d]+$", "", text)
            kind = 0
            if not bare:
                count["blank"] += 1
            elif (role, text) in seen:
                count["duplicate"] += 1
            else:
                cut = bare[-1] not in ".!?"
                count["truncated"] += cut
                kind = 1 + 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + cut
            seen.add((role, text))
            kinds.append(kind)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:], strict=False)]
        cost, audit = plain_walk(bytes(kinds))
        roles, texts, _ = C.repaired(audit, 0, [r for _, r, _ in mine], [t for _, _, t in mine])
        whole = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts, strict=True))
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())
    return out


def check(spark, rows, parts, order=None):
    df = spark.createDataFrame(
        [Row(conv_id=c, turn=t, role=r, text=x, part="p", cost=1) for c, t, r, x in rows],
        "conv_id long, turn long, role string, text string, part string, cost int",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = C.damage_and_repair(df, "conv_id", "turn", "role", "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def some_rows(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    texts = ["Yes.", "No!", "It goes on", " ", None, "é?", "x.\n", "Why? "]
    return [
        (conv, rng.choice([None, *range(3 * n)]) if rng.random() < 0.1 else i, rng.choice(roles[: 8 if rng.random() < 0.2 else 4]),
         rng.choice(texts) if rng.random() < 0.4 else f"turn {i} of {conv}.")
        for i in range(n)
    ]


def test_query_equals_plain_program_with_a_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_BYTES", 2000)
    monkeypatch.setattr(C, "HELD_BYTES", 4000)
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(60)]:
        rows += some_rows(rng, conv, rng.choice([1, 2, 5, 9]))
    rows += some_rows(rng, 70, 900)
    rows += [(71, 5, "user", "the same row.")] * 300  # one row many times
    rows += [(72, t, "user", "ok.") for t in range(200)]  # one text many times
    rng.shuffle(rows)
    check(spark, rows, 7)


def test_all_rows_dropped_one_partition_and_empty_table(spark):
    turns = [t for t in range(4000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0][:3]
    check(spark, [(3, t, "user", "gone.") for t in turns] + [(4, 0, "user", "a."), (4, 1, "assistant", "b.")], 1)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.damage_and_repair(empty, "conv_id", "turn", "role", "text").count() == 0


@pytest.mark.parametrize("turns", [[None, None], [2**63 - 1, -(2**63)]])
def test_gaps_of_null_and_extreme_turns(spark, turns):
    df = spark.createDataFrame([("c", t, "user", f"{i}.") for i, t in enumerate(turns)], "k string, n long, r string, x string")
    got = C.repair_digests(C.repair_conversations(df, "k", "n", "r", "x"), "k").collect()
    assert [r.gaps for r in got] == [0 if turns[0] is None else 2**63 - 1]


def test_turns_table_holds_the_repaired_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "More")], "k int, n int, r string, x string")
    pieces = C.repair_conversations(df, "k", "n", "r", "x")
    got = [(r.role, r.text) for r in C.repaired_turns(pieces).orderBy("conv", "part", "piece", "number").collect()]
    (audit,) = {r.audit for r in pieces.collect()}
    assert audit == plain_walk(bytes([3, 4]))[1]
    assert SHAPE.fullmatch("".join(r[0] for r, _ in got)) and got[0] == ("user", "Hi.")
