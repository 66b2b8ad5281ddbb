"""Mixing documents to target domain weights by soft membership.

A classifier fitted to the labelled table gives every document a
probability for each domain.  With n_d tokens, probabilities p_dk and a
rate r_d (how often a document is expected in the mix), domain k's
expected tokens are sum_d r_d n_d p_dk.  Rates r_d >= 0 are wanted for which
they equal the targets T_k, or come closest.

They are fitted by projected gradient least squares, from a rate of 1.  A
round is one aggregate over the narrow table of probabilities: expected
tokens, with the error e = T - (expected tokens), and the K x K sums A of n_d
p_d p_d' over documents of rate > 0.  The miss is e' A^-1 e, and the step along
its gradient (in squares weighted by n_d) is r_d <- max(0, r_d + l p_d . A^-1 e);
l is halved until that miss falls.  Rates are the fold of the steps taken, K
numbers each: nothing per document is carried over.

Where no rates reach the targets, such steps only creep up to the closest
rates.  When the miss hardly falls any more, ``fit_rates`` hands over to
``settle_rates``, which measures it with A at a rate of 1: rates r_d = max(0, 1 + p_d . v) for one vector v of K
multipliers, found by Newton's method on the convex dual with a proximal term
(``PROXIMAL``, lowered when its centre moves).  It ends when the targets are
met, or when the duality gap shows that no rates come closer; else it raises.

Targets: ``weights`` (made to sum to 1) times the mix's tokens, which are
such that the ``anchor`` domain keeps the tokens it has.

Defined results: a null text is the empty text, of 0 tokens and rate 1;
repeated rows get the same rate; a null domain teaches nothing; a domain
in the labels without a weight has target 0, and one with a weight but
without labels is left out (the others' weights then sum to 1); with fewer
than two labelled domains every rate is 1; other columns are carried
untouched.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, stage, text_of
from tripflow.llm.hashing import hashed_texts, mix, seeded

#: Labelled texts used for fitting.  Of more, each domain keeps its share of
#: MAX_LABELLED, or LEAST_LABELLED if that is more (or all it has), by the
#: lowest hashes of ids: at most MAX_LABELLED + LEAST_LABELLED a domain.
MAX_LABELLED = 8_000
LEAST_LABELLED = 50
RANGES = ((0, 1 << 17), (1 << 17, 1 << 13))  # buckets of words and of word shapes
BUCKETS = (1 << 17) + (1 << 13)
STEPS = 120
RIDGE = 1e-3
#: Projected gradient rounds, and how little the miss may fall in one before
#: targets count as out of reach.
MAX_ROUNDS = 60
STALL = 0.02
LEAST_LENGTH = 1e-3
TOLERANCE = 1e-7
#: Newton rounds before ``settle_rates`` gives up, and the weight that its
#: proximal term starts with, is lowered by and stays above.
MAX_SETTLE = 200
PROXIMAL, PROXIMAL_STEP, PROXIMAL_LEAST = 1e-6, 0.1, 1e-12
SEED = 29


def text_features(words: np.ndarray, at: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed words and word shapes of each text: (bucket, text)."""
    again = np.zeros(len(words), np.uint64)
    again[1:] = (words[1:] == words[:-1]) & (at[1:] == at[:-1])
    with np.errstate(over="ignore"):
        grams = [mix(words), seeded(shapes + again, 3)]
    bucket = np.concatenate([np.uint64(low) + g % np.uint64(n) for g, (low, n) in zip(grams, RANGES, strict=True)])
    both = np.unique(np.concatenate([at, at]) * BUCKETS + bucket.astype(np.int64))
    return both % BUCKETS, both // BUCKETS


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def scores(weight: np.ndarray, bias: np.ndarray, bucket: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Linear scores of n texts; a text's features share unit length."""
    size = np.sqrt(np.maximum(np.bincount(at, minlength=n), 1))
    return np.stack([np.bincount(at, w[bucket], n) for w in weight], 1) / size[:, None] + bias


def fit_classifier(bucket: np.ndarray, at: np.ndarray, domain: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by Adagrad: weights (k, BUCKETS), bias."""
    n = len(domain)
    weight, bias = np.zeros((k, BUCKETS)), np.log(np.bincount(domain, minlength=k) / n)
    speed, speed_b = np.full((k, BUCKETS), 1e-8), np.full(k, 1e-8)
    size = np.sqrt(np.maximum(np.bincount(at, minlength=n), 1))
    truth = np.eye(k)[domain]
    for _ in range(STEPS):
        error = (_softmax(scores(weight, bias, bucket, at, n)) - truth) / n
        shared = error / size[:, None]
        for j in range(k):
            g = np.bincount(bucket, shared[at, j], BUCKETS) + RIDGE / n * weight[j]
            speed[j] += g * g
            weight[j] -= 0.5 * g / np.sqrt(speed[j])
        g = error.sum(0)
        speed_b += g * g
        bias = bias - 0.1 * g / np.sqrt(speed_b)
    return weight, bias


def labelled_features(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, domain: str):
    """(domain names, buckets, text of each bucket, domain of each text) of
    labelled documents; equal texts of one id count once in a domain.  They
    are chosen among the documents there are, before any text is moved."""
    known = (
        labels.select(col(id_col).alias("id"), F.expr(domain).cast("string").alias("domain"))
        .where("id is not null and domain is not null")
        .distinct()
    )
    texts = df.select(col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("page", F.xxhash64("text"))
    pairs = stage(texts.select("id", "page").join(known, "id").distinct(), "labelled-pages")
    count = {r["domain"]: r["count"] for r in pairs.groupBy("domain").count().collect()}  # one row a domain
    total = sum(count.values())
    chosen = pairs
    if total > MAX_LABELLED:
        lowest = [
            pairs.where(F.col("domain") == F.lit(name))
            .orderBy(F.xxhash64("id"), "id", "page")
            .limit(max(min(n, LEAST_LABELLED), n * MAX_LABELLED // total))
            for name, n in sorted(count.items())
        ]
        chosen = reduce(DataFrame.union, lowest)
    rows = texts.join(F.broadcast(chosen), ["id", "page"])

    def extract(batches):
        for batch in batches:
            kept = [b""] * batch.num_rows
            for first, n, words, at, shapes in hashed_texts(batch.column(0), shapes=True):
                bucket, at = text_features(words, at, shapes)
                cuts = np.searchsorted(at, np.arange(1, n))
                kept[first : first + n] = [x.astype("<i4").tobytes() for x in np.split(bucket, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(kept, pa.binary())], ["domain", "row", "features"]
            )

    rows = rows.select("text", "domain", F.xxhash64("id", "page").alias("row"))
    found = rows.mapInArrow(extract, "domain string, row long, features binary").distinct().toPandas()
    found = found.sort_values(["domain", "features"], kind="stable")
    names = sorted(set(found["domain"]))
    sets = [np.frombuffer(x, "<i4") for x in found["features"]]
    at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    bucket = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)
    return names, bucket, at, np.array([names.index(x) for x in found["domain"]], np.int64)


def domain_posteriors(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, domain: str
) -> tuple[list[str], DataFrame]:
    """Domain names, and per row of ``df``: id, n_tokens (words), p (one
    probability per domain)."""
    spark = df.sparkSession
    ship_package(spark)
    names, bucket, at, truth = labelled_features(df, labels, id_col, text_col, domain)
    k = max(len(names), 1)
    weight, bias = fit_classifier(bucket, at, truth, k) if len(names) > 1 else (np.zeros((k, BUCKETS)), np.zeros(k))
    model = spark.sparkContext.broadcast((weight.astype(np.float32), bias))  # BUCKETS floats a domain
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("p", T.ArrayType(T.DoubleType())),
        ]
    )

    def predict(batches):
        weight, bias = model.value
        weight = weight.astype(float)
        for batch in batches:
            p, tokens = np.zeros((batch.num_rows, k)), np.zeros(batch.num_rows, np.int64)
            for first, n, words, at, shapes in hashed_texts(batch.column(1), shapes=True):
                tokens[first : first + n] = np.bincount(at, minlength=n)
                bucket, at = text_features(words, at, shapes)
                p[first : first + n] = _softmax(scores(weight, bias, bucket, at, n))
            offsets = pa.array(np.arange(0, p.size + 1, k, dtype=np.int32))
            lists = pa.ListArray.from_arrays(
                offsets, pa.array(p.ravel()), type=pa.list_(pa.field("element", pa.float64()))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens), lists], out.fieldNames())

    return names, rows.mapInArrow(predict, out)


def _rate(steps: list[np.ndarray], k: int) -> Column:
    """The fold of the steps taken, from a rate of 1."""
    if not steps:
        return F.lit(1.0)
    flat = F.array(*(F.array(*(F.lit(float(x)) for x in s)) for s in steps))

    def take(rate, s):
        for i in range(k):
            rate = rate + s[i] * F.col("p")[i]
        return F.greatest(F.lit(0.0), rate)

    return F.aggregate(flat, F.lit(1.0), take)


def _products(k: int, weight: Column | None = None) -> list[Column]:
    weight = F.col("n_tokens") if weight is None else weight
    return [F.sum(weight * F.col("p")[i] * F.col("p")[j]) for i in range(k) for j in range(i, k)]


def _squares(sums, k: int) -> np.ndarray:
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = [x or 0.0 for x in sums]
    return m + np.triu(m, 1).T


def _measure(members: DataFrame, steps: list[np.ndarray], k: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Half the squared rates, expected tokens, products where rate > 0; one
    row reaches the driver."""
    n = F.col("n_tokens")
    held = members.withColumn("rate", _rate(steps, k))
    weight = F.when(F.col("rate") > 0, n).otherwise(F.lit(0))
    sums = [F.sum(n * F.col("rate") * F.col("rate")), *(F.sum(n * F.col("rate") * F.col("p")[i]) for i in range(k))]
    row = [x or 0.0 for x in held.agg(*sums, *_products(k, weight)).first()]
    return row[0] / 2.0, np.array(row[1 : k + 1]), _squares(row[k + 1 :], k)


def _pinv(m: np.ndarray) -> np.ndarray:
    return np.linalg.pinv(m, rcond=1e-10, hermitian=True)


def fit_rates(members: DataFrame, target: np.ndarray, k: int) -> list[np.ndarray]:
    """Projected gradient steps from a rate of 1 after which the expected
    domain tokens equal the target within TOLERANCE; the step of
    ``settle_rates`` where they don't get there."""
    members = members.where("n_tokens > 0")
    scale = max(float(np.abs(target).sum()), 1.0)
    steps: list[np.ndarray] = []
    _, tokens, products = _measure(members, steps, k)
    rounds, length = 1, 1.0
    while rounds < MAX_ROUNDS and length >= LEAST_LENGTH:
        error = target - tokens
        if np.abs(error).max() <= TOLERANCE * scale:
            return steps
        inverse, length = _pinv(products), 1.0
        slope = inverse @ error
        while rounds < MAX_ROUNDS and length >= LEAST_LENGTH:
            ahead = [*steps, length * slope]
            _, new_tokens, new_products = _measure(members, ahead, k)
            rounds += 1
            left = target - new_tokens
            if left @ inverse @ left < (1.0 - STALL * length) * (error @ slope):
                steps, tokens, products = ahead, new_tokens, new_products
                break
            length /= 2.0
    return settle_rates(members, target, k)


def settle_rates(members: DataFrame, target: np.ndarray, k: int) -> list[np.ndarray]:
    """The one step from a rate of 1 after which the expected domain tokens
    equal the target, or are within TOLERANCE of the closest to it."""
    members = members.where("n_tokens > 0")

    def measure(v):
        return _measure(members, [v], k)

    def gap(error, tokens):
        """How far the squared miss, halved, is at most from its least: the
        error's multipliers, lowered until no document's rate could gain."""
        u = inverse @ error
        gain = members.agg(F.max(sum((F.lit(float(u[i])) * F.col("p")[i] for i in range(k)), F.lit(0.0)))).first()[0]
        over = max(gain or 0.0, 0.0)
        return float(-u @ tokens + over * (target - m @ u).sum() + 0.5 * over * over * m.sum())

    v = centre = np.zeros(k)
    half, tokens, products = measure(v)
    m = products  # at a rate of 1 all count
    inverse = _pinv(m)
    scale = max(float(np.abs(target).sum()), 1.0)
    least = 0.5 * TOLERANCE**2 * float(target @ inverse @ target)
    proximal = PROXIMAL
    rounds = 1
    while rounds < MAX_SETTLE:
        error = target - tokens
        if np.abs(error).max() <= TOLERANCE * scale:
            return [v]
        slope = proximal * m @ (v - centre) - error
        if slope @ inverse @ slope <= 1e-6 * (error @ inverse @ error):
            # the proximal problem is solved: is the whole one?
            if gap(error, tokens) <= least:
                return [v]
            centre, proximal, slope = v, max(proximal * PROXIMAL_STEP, PROXIMAL_LEAST), -error
        step = -np.linalg.lstsq(products + proximal * m, slope, rcond=None)[0]

        def value(half, v):
            return half - target @ v + 0.5 * proximal * (v - centre) @ m @ (v - centre)  # noqa: B023

        before, length = value(half, v), 1.0
        while rounds < MAX_SETTLE:
            ahead = v + length * step
            half, tokens, products = measure(ahead)
            rounds += 1
            if value(half, ahead) <= before + 1e-4 * length * (slope @ step) + 1e-12 * abs(before) or length < 1e-6:
                break
            length /= 2.0
        v = ahead
    raise ArithmeticError(f"rates did not settle in {MAX_SETTLE} rounds; expected tokens {tokens}, target {target}")


def mix_rates(
    df: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    domain: str,
    weights: dict[str, float],
    anchor: str,
) -> DataFrame:
    """One row per input row: the id column, n_tokens, p (probabilities by
    domain, in order of the domains' names), rate, and copies (the rate
    rounded up or down by a hash of the id, with the rate as its mean)."""
    names, members = domain_posteriors(df, labels, id_col, text_col, domain)
    members = stage(members, "domain-posteriors")
    k = len(names)
    steps: list[np.ndarray] = []
    share = np.array([float(weights.get(x, 0.0)) for x in names])
    if k > 1 and share.sum() > 0:
        share = share / share.sum()
        have = members.agg(*(F.sum(F.col("n_tokens") * F.col("p")[i]) for i in range(k))).first()
        have = np.array([x or 0.0 for x in have])
        at = names.index(anchor) if anchor in names else -1
        total = have[at] / share[at] if at >= 0 and share[at] > 0 and have[at] > 0 else have.sum()
        steps = fit_rates(members, share * total, k)
    rate = F.round(_rate(steps, k), 9) if steps else F.lit(1.0)
    luck = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("id")), 11).cast("double")) * F.lit(2.0**-53)
    return (
        members.withColumn("rate", F.when(F.col("n_tokens") > 0, rate).otherwise(F.lit(1.0)))
        .withColumn("copies", F.floor(F.col("rate") + luck).cast("int"))
        .withColumnRenamed("id", id_col)
    )
