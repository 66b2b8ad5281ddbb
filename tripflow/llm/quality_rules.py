"""Learned decision lists over text statistics.

Sequential covering: grow a conjunction of thresholds on two thirds of
the labelled rows until it covers no good one (by information gain),
prune it on the other third, keep it if it is precise enough there, drop
the rows it covers, and go on.  The list becomes ordered Spark
conditional expressions, so the verdict runs inside the plan.

Defined results: a null text is the empty text (no words, which the base
rule fails); repeated rows each give a row; labels that are null, and
labelled ids without a document, teach nothing; with too few labelled
rows no rule is learned and the base rule alone decides; other columns of
the input are not looked at.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, lowest, ship_package, stage, text_of

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Labelled rows used for fitting; more are thinned by the id's hash.
MAX_LABELLED = 20_000
MIN_COVERED = 10
MIN_PRECISION = 0.9
MAX_RULES = 16
MAX_CONDITIONS = 4

_SYMBOLS = b"#*$%&|<>"
_UPPER = string.ascii_uppercase.encode()
_DIGITS = string.digits.encode()


def text_counts(text: str) -> tuple[int, ...]:
    """The counts named in COUNTS, over the whole text."""
    raw = text.encode()
    words = raw.split()  # at \x20 and \x09-\x0D, as bytes
    grams = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        times = Counter(grams)
        until = 0  # words before this one are counted
        for i, gram in enumerate(grams):
            if times[gram] > 1:
                repeated += i + 3 - max(until, i)
                until = i + 3
    lines = [x for x in raw.split(b"\n") if x.strip()]
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    return (
        len(words),
        sum(len(w.decode()) for w in words) if not text.isascii() else sum(map(len, words)),
        without(_SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        without(_UPPER),
        without(_DIGITS),
    )


def text_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: the id column, COUNTS, and base_failed."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in COUNTS)]
    )

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.array([text_counts(t) for t in part.column(1).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(found[:, i]) for i in range(len(COUNTS)))], out.fieldNames()
                )

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.mapInArrow(count, out).withColumn("base_failed", failed).withColumnRenamed("id", id_col)


def features() -> dict[str, Column]:
    """What the rules compare; a ratio over nothing is 0."""

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "word_length": ratio("word_chars", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "duplicate_lines": ratio("n_dup_lines", "n_lines"),
        "repeated_words": ratio("n_repeat_words", "n_words"),
        "words_per_line": ratio("n_words", "n_lines"),
        "upper_case": ratio("n_upper", "word_chars"),
        "digits": ratio("n_digits", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        x = features()[self.feature]
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and bad[inside].any() and not bad[inside].all():
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        base = np.log2(p0 / (p0 + n0))
        best, gain = None, 1e-9
        for name in sorted(values):
            x = values[name][inside]
            order = np.argsort(x, kind="stable")
            x, y = x[order], bad[inside][order]
            ends = np.flatnonzero(x[1:] > x[:-1])  # a threshold lies between unequal neighbours
            if not len(ends):
                continue
            cut = (x[ends] + x[ends + 1]) / 2
            p_low = np.cumsum(y)[ends]
            low = ends + 1
            for above, p, total in ((False, p_low, low), (True, p0 - p_low, len(x) - low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / total) - base), 0.0)
                i = int(np.argmax(g))
                if g[i] > gain:
                    best, gain = Condition(name, above, float(cut[i])), float(g[i])
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(values)
    return tuple(rule)


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    hit = covers(rule, values, len(bad))
    p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray, prune_part: np.ndarray) -> list[Rule]:
    """An ordered list of conjunctions that mark bad rows."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & ~prune_part, left & prune_part
        grow_values = {k: v[grow] for k, v in values.items()}
        prune_values = {k: v[prune] for k, v in values.items()}
        rule = _grow(grow_values, bad[grow])
        if not rule:
            break
        cuts = [rule[: i + 1] for i in range(len(rule))]
        rule = max(cuts, key=lambda r: (_worth(r, prune_values, bad[prune]), -len(r)))
        hit = covers(rule, values, len(bad))
        tried = hit & prune
        if hit[left].sum() < MIN_COVERED or not tried.any() or bad[tried].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True for rows that no rule rejects; rules are tried in order."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(statistics: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> list[Rule]:
    """Rules learned from labelled rows (label 0: bad, else good) that pass
    the base rule; at most MAX_LABELLED of them, those whose id hashes
    lowest."""
    known = labels.select(col(id_col).alias(id_col), col(label_col).cast("int").alias("label")).where("label is not null")
    rows = (
        statistics.where(~F.col("base_failed"))
        .join(known, id_col)
        .select(*(x.alias(k) for k, x in features().items()), "label", F.xxhash64(col(id_col)).alias("order"))
    )
    chosen = lowest(rows, MAX_LABELLED, "order", *features(), "label").toPandas()
    if not len(chosen):
        return []
    values = {k: chosen[k].to_numpy(float) for k in features()}
    prune_part = (chosen["order"].to_numpy(np.int64) % 3) == 0
    return learn_rules(values, chosen["label"].to_numpy() == 0, prune_part)


def quality_verdicts(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """One row per input row: the id column, COUNTS, base_failed, kept."""
    found = stage(text_statistics(df, id_col, text_col), "text-statistics")
    rules = fit(found, labels, id_col, label_col)
    return found.withColumn("kept", ~F.col("base_failed") & verdict(rules))
