"""Secret scan: fixed patterns, and formats learned by grammar inference.

Base spans come from three patterns.  What they match labels credentials of
three kinds; from a bounded sample of each kind, state merging (ALERGIA)
builds a probabilistic automaton: the strings, as sequences of character
classes, form a prefix tree, and states whose ending and outgoing
frequencies don't differ by a Hoeffding test, nor those of the states below
them, are merged.  Runs of CANDIDATE_CHARS or more credential characters
are cut at base spans; what is left of them in that length, and its parts
at equals signs (names and values), is scored by the log likelihood ratio of
each automaton to a chain over the classes of ordinary runs (uncut at equals
signs).  What reaches a kind's bar, and of parts that overlap the best, is a
span of kind ``like_<kind>``.  The bar is what 99 of
100 held-out credentials of the kind reach, and at least log 1000.

Defined results: a null text is the empty text; matches are leftmost and
non-overlapping per kind, and spans of different kinds may overlap;
learned spans never overlap base ones; a kind with fewer than MIN_STRINGS
distinct credentials learns nothing; credentials of more than MAX_TAUGHT
characters don't teach (ordinary runs of any length do, each distinct one
once); repeated rows each give a row; other columns of the input
are not looked at.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, stage, text_of

KINDS = ("assign", "access", "hex")
LEARNED = tuple(f"like_{k}" for k in KINDS)

# The base patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

CANDIDATE_CHARS = 16
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Strings per kind that teach its automaton; of more, those with the lowest
#: hashes.
MAX_STRINGS = 600
MIN_STRINGS = 20
MAX_TAUGHT = 200
ALPHA = 0.05
MIN_ARRIVALS = 8
MIN_RATIO = math.log(1000.0)


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, credential) of the base patterns.

    A run of hexadecimal digits or an access key of the least length lies
    in a run of credential characters, so only those are searched; its
    pattern with the least length finds the same matches as dropping
    shorter ones afterwards, since a match always reaches its run's end."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_CHARS:
                found.append((0, m.start(), m.end(), m[2]))
    for run in RUN.finditer(text):
        if "AKIA" in run[0]:
            for m in ACCESS.finditer(text, run.start(), run.end()):
                if len(m[0]) >= ACCESS_CHARS:
                    found.append((1, m.start(), m.end(), m[0]))
        if run.end() - run.start() >= 24:
            for m in HEX.finditer(text, run.start(), run.end()):
                found.append((2, m.start(), m.end(), m[0]))
    return found


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, str]]:
    """(start, run) of what base spans leave of runs, without dots, dashes
    and equals signs at its ends, nor slashes and underscores at a cut."""
    taken = sorted((s, e) for _, s, e, _ in base)
    out, i, reach = [], 0, 0  # reach: the farthest end of the spans so far

    def add(start, end, first, last):
        run = text[start:end].lstrip(".-=" if start == first else ".-=/_")
        start = end - len(run)
        run = run.rstrip(".-=" if end == last else ".-=/_")
        if len(run) >= CANDIDATE_CHARS:
            out.append((start, run))

    for m in RUN.finditer(text):
        first, last = m.span()
        start = max(first, reach)
        while i < len(taken) and taken[i][0] < last:
            add(start, max(start, taken[i][0]), first, last)
            reach = max(reach, taken[i][1])
            start = max(start, reach)
            i += 1
        add(start, max(start, last), first, last)
    return out


def parts(start: int, run: str) -> list[tuple[int, str]]:
    """What is scored of a run: itself, what follows its first equals sign,
    and what lies between its equals signs."""
    out = [(start, run)]
    if "=" in run:
        pieces = [(m.start(), m[0]) for m in re.finditer(r"[^=]+", run)]
        for at, piece in [(pieces[1][0], run[pieces[1][0] :]), *pieces]:
            short = piece.lstrip(".-")
            at += len(piece) - len(short)
            short = short.rstrip(".-")
            if len(short) >= CANDIDATE_CHARS and (start + at, short) not in out[:2]:
                out.append((start + at, short))
    return out


def apart(found: list[tuple[float, int, int, int]]) -> list[tuple[float, int, int, int]]:
    """Of (score, start, end, kind), the best ones that don't overlap."""
    starts: list[int] = []
    kept: list[tuple[float, int, int, int]] = []
    for x in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1])):
        i = bisect(starts, x[1])
        if (i == 0 or kept[i - 1][2] <= x[1]) and (i == len(kept) or x[2] <= starts[i]):
            starts.insert(i, x[1])
            kept.insert(i, x)
    return kept


# --- learning

_CLASS = str.maketrans(
    {c: "a" for c in "abcdef"}
    | {c: "g" for c in "ghijklmnopqrstuvwxyz"}
    | {c: "A" for c in "ABCDEF"}
    | {c: "G" for c in "GHIJKLMNOPQRSTUVWXYZ"}
    | {c: "0" for c in "0123456789"}
)


def classes(s: str) -> str:
    return s.translate(_CLASS)


class Automaton:
    """A probabilistic automaton, from a prefix tree by state merging."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.arrivals, self.ends = [0], [0]
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]
        for s in strings:
            q = 0
            self.arrivals[0] += 1
            for c in s:
                if c not in self.next[q]:
                    self.next[q][c] = len(self.next)
                    self.next.append({})
                    self.taken.append({})
                    self.arrivals.append(0)
                    self.ends.append(0)
                self.taken[q][c] = self.taken[q].get(c, 0) + 1
                q = self.next[q][c]
                self.arrivals[q] += 1
            self.ends[q] += 1
        self.symbols = len({c for s in strings for c in s}) + 1
        self.bound = math.sqrt(0.5 * math.log(2.0 / alpha))
        self._merge_states()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, red: int, blue: int) -> bool:
        todo = [(red, blue)]
        while todo:
            p, q = todo.pop()
            n1, n2 = self.arrivals[p], self.arrivals[q]
            if n1 < MIN_ARRIVALS or n2 < MIN_ARRIVALS:
                continue
            if self._differ(self.ends[p], n1, self.ends[q], n2):
                return False
            for c in self.taken[p].keys() | self.taken[q].keys():
                if self._differ(self.taken[p].get(c, 0), n1, self.taken[q].get(c, 0), n2):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    todo.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        todo = [(red, blue)]
        while todo:
            p, q = todo.pop()
            self.arrivals[p] += self.arrivals[q]
            self.ends[p] += self.ends[q]
            for c, n in self.taken[q].items():
                self.taken[p][c] = self.taken[p].get(c, 0) + n
                if c in self.next[p]:
                    todo.append((self.next[p][c], self.next[q][c]))
                else:
                    self.next[p][c] = self.next[q][c]

    def _merge_states(self) -> None:
        red = [0]
        while True:
            fringe = [(p, c, q) for p in red for c, q in sorted(self.next[p].items()) if q not in red]
            if not fringe:
                break
            p, c, q = max(fringe, key=lambda x: (self.arrivals[x[2]], -x[2]))
            twin = next((r for r in red if self._compatible(r, q)), None)
            if twin is None:
                red.append(q)
            else:
                self.next[p][c] = twin
                self._fold(twin, q)
        self.states = red

    def log_likelihood(self, s: str) -> float:
        """Of the string and its end; what a state hasn't seen gets half a
        count, and ends the walk at the start state."""
        total, q = 0.0, 0
        for c in s:
            whole = self.arrivals[q] + 0.5 * self.symbols
            total += math.log((self.taken[q].get(c, 0) + 0.5) / whole)
            q = self.next[q].get(c, 0)
        return total + math.log((self.ends[q] + 0.5) / (self.arrivals[q] + 0.5 * self.symbols))


class Chain:
    """First-order chain over classes, with ends, from counts of pairs."""

    def __init__(self, pairs: dict[tuple[str, str], int]):
        self.n = pairs
        self.total: dict[str, int] = {}
        for (a, _), n in pairs.items():
            self.total[a] = self.total.get(a, 0) + n

    def log_likelihood(self, s: str) -> float:
        return sum(
            math.log((self.n.get((a, b), 0) + 0.5) / (self.total.get(a, 0) + 8.0))
            for a, b in zip("^" + s, s + "$", strict=True)
        )


@dataclass
class Format:
    automaton: Automaton
    bar: float


def learn(credentials: dict[int, list[str]], chain: Chain) -> tuple[dict[int, Format], Chain]:
    """A format for every kind with enough strings."""
    formats = {}
    for kind, strings in sorted(credentials.items()):
        if len(strings) < MIN_STRINGS:
            continue
        seen = [classes(s) for s in sorted(strings)]
        held = [s for i, s in enumerate(seen) if i % 4 == 0]
        automaton = Automaton([s for i, s in enumerate(seen) if i % 4])
        ratios = [automaton.log_likelihood(s) - chain.log_likelihood(s) for s in held]
        formats[kind] = Format(automaton, max(MIN_RATIO, float(np.quantile(ratios, 0.01))))
    return formats, chain


def best_format(run: str, formats: dict[int, Format], chain: Chain) -> tuple[int, float] | None:
    """(kind, log ratio) of the format that the run fits best, if any."""
    s = classes(run)
    plain = chain.log_likelihood(s)
    scored = [(f.automaton.log_likelihood(s) - plain, -k) for k, f in formats.items()]
    fits = [(x, k) for x, k in scored if x >= formats[-k].bar]
    return (-max(fits)[1], max(fits)[0]) if fits else None


# --- over documents

_FOUND = (
    "kinds array<int>, starts array<int>, ends array<int>, credentials array<string>, "
    "run_starts array<int>, runs array<string>"
)


def matches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, the base matches and the candidates of each whole text."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), *T._parse_datatype_string(_FOUND).fields])
    ints, strings = (pa.list_(pa.field("element", t)) for t in (pa.int32(), pa.string()))

    def scan(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                base = [base_matches(t) for t in part.column(1).to_pylist()]
                runs = [candidates(t, b) for t, b in zip(part.column(1).to_pylist(), base, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *(pa.array([[m[i] for m in b] for b in base], t) for i, t in enumerate((ints, ints, ints, strings))),
                        *(pa.array([[r[i] for r in x] for x in runs], t) for i, t in enumerate((ints, strings))),
                    ],
                    out.fieldNames(),
                )

    return rows.mapInArrow(scan, out)


def class_pairs(runs: DataFrame) -> dict[tuple[str, str], int]:
    """How often a class follows another (^ begins, $ ends) in all distinct
    runs (column s); a row per pair of classes reaches the driver."""

    def count(batches):
        n: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for run in batch.column(0).to_pylist():
                s = classes(run)
                n.update(zip("^" + s, s + "$", strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a for a, _ in n], pa.string()),
                pa.array([b for _, b in n], pa.string()),
                pa.array(list(n.values()), pa.int64()),
            ],
            ["a", "b", "n"],
        )

    pairs = runs.distinct().mapInArrow(count, "a string, b string, n long")
    return {(r["a"], r["b"]): r["n"] for r in pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()}


def fit_formats(found: DataFrame) -> tuple[dict[int, Format], Chain]:
    """Formats from bounded samples of distinct credentials, and the chain
    of all distinct runs."""

    def sample(strings: DataFrame, most: int) -> list[str]:
        short = strings.where(F.length("s") <= MAX_TAUGHT).distinct()
        return sorted(r[0] for r in short.orderBy(F.xxhash64("s"), "s").limit(most).collect())

    labelled = found.select(F.explode(F.arrays_zip("kinds", "credentials")).alias("m"))
    labelled = stage(labelled.select(F.col("m.kinds").alias("kind"), F.col("m.credentials").alias("s")), "credentials")
    credentials = {k: sample(labelled.where(F.col("kind") == k).select("s"), MAX_STRINGS) for k in range(len(KINDS))}
    return learn(credentials, Chain(class_pairs(found.select(F.explode("runs").alias("s")))))


def secret_spans(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: the id column, and ``spans``, an array of
    (kind, start, end, score) in order of start and kind; a base span has no
    score.  Offsets count code points, ends are exclusive."""
    spark = df.sparkSession
    found = stage(matches(df, id_col, text_col), "secret-matches")
    model = spark.sparkContext.broadcast(fit_formats(found))  # bounded automata, pairs of classes
    out = T.StructType(
        [
            T.StructField("id", found.schema["id"].dataType),
            T.StructField(
                "spans", T._parse_datatype_string("array<struct<kind: string, start: int, end: int, score: double>>")
            ),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(T.StructType([out["spans"]])).field(0).type

    def score(batches):
        formats, chain = model.value
        names = (*KINDS, *LEARNED)
        memo: dict[str, tuple[int, float] | None] = {}
        for batch in batches:
            spans = []
            for row in batch.select(["kinds", "starts", "ends", "run_starts", "runs"]).to_pylist():
                own = [(s, k, e, None) for k, s, e in zip(row["kinds"], row["starts"], row["ends"], strict=True)]
                for first, whole in zip(row["run_starts"], row["runs"], strict=True):
                    learned = []
                    for s, run in parts(first, whole):
                        if run not in memo:
                            if len(memo) > 100_000:
                                memo.clear()
                            memo[run] = best_format(run, formats, chain)
                        if memo[run]:
                            learned.append((memo[run][1], s, s + len(run), memo[run][0]))
                    own.extend((s, len(KINDS) + k, e, x) for x, s, e, k in apart(learned))
                own.sort(key=lambda x: x[:3])
                spans.append([{"kind": names[k], "start": s, "end": e, "score": x} for s, k, e, x in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    scored = found.drop("credentials").mapInArrow(score, out)
    return scored.withColumnRenamed("id", id_col)


def span_digests(spans: DataFrame) -> DataFrame:
    """``spans`` with counts of the base kinds and the joined spans."""
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS))
    joined = lambda xs: F.array_join(
        F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        *(c for c in spans.columns if c != "spans"),
        *(count(k) for k in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
