"""Rates against the targets, a plain projected gradient and least squares."""

import random

import numpy as np
import pytest

from tripflow.llm import mixing as X

DOMAIN = "case when kind = 'none' then null else kind end"


def members(spark, p, n):
    return spark.createDataFrame([(i, int(t), [float(x) for x in row]) for i, (row, t) in enumerate(zip(p, n))], "id long, n_tokens long, p array<double>")


def plain_rates(p, steps):
    rate = np.ones(len(p))
    for s in steps:
        rate = np.maximum(0, rate + p @ s)
    return rate


@pytest.mark.parametrize("want", [(0.5, 0.3, 0.2), (0.9, 0.05, 0.05), (0.97, 0.02, 0.01)])
def test_projected_gradient_meets_reachable_targets(spark, monkeypatch, want):
    monkeypatch.setattr(X, "settle_rates", None)  # not needed
    rng = np.random.default_rng(4)
    p = rng.dirichlet((0.2, 0.2, 0.2), 400)
    n = rng.integers(1, 500, 400)
    target = np.array(want) * n.sum() * 0.4
    df = members(spark, p, n)
    steps = X.fit_rates(df, target, 3)
    rate = np.array([r[0] for r in df.orderBy("id").select(X._rate(steps, 3)).collect()])
    assert (rate >= 0).all() and np.allclose(rate, plain_rates(p, steps), atol=1e-9)
    assert np.abs((rate * n) @ p - target).max() <= X.TOLERANCE * target.sum()
    # each is a gradient step of the miss, scaled by the sums of what has a rate
    for i, step in enumerate(steps):
        before = plain_rates(p, steps[:i])
        held = before > 0
        full = np.linalg.pinv((p * n[:, None])[held].T @ p[held]) @ (target - (before * n) @ p)
        length = (step @ full) / (full @ full)
        assert np.allclose(step, length * full, rtol=1e-5) and np.isclose(np.log2(length), round(np.log2(length)), atol=1e-4)


def test_shipped_weights_are_met_by_projected_gradient(spark, monkeypatch):
    from tripflow.llm.queries import DOMAIN as OWN
    from tripflow.llm.queries import MIX

    monkeypatch.setattr(X, "settle_rates", None)  # not needed
    tables = [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels")]
    got = X.mix_rates(*tables, "doc_id", "text", OWN, MIX, "good").collect()
    total = np.array([r.rate * r.n_tokens for r in got]) @ np.array([r.p for r in got])
    assert np.allclose(total / total.sum(), [MIX["good"], MIX["low"], MIX["toxic"]], atol=1e-6)


def nnls(a, b):
    """Non-negative least squares by Lawson and Hanson."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slope = a.T @ b
    least = 1e-13 * np.abs(slope).max()
    while not on.all() and slope[~on].max() > least:
        on[np.argmax(np.where(on, -np.inf, slope))] = True
        while True:
            s = np.zeros_like(x)
            s[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            bad = on & (s <= 0)
            if not bad.any():
                break
            x = x + (x[bad] / (x[bad] - s[bad])).min() * (s - x)
            on &= x > 1e-14 * x.max()
        x, slope = s, a.T @ (b - a @ s)
    return x


@pytest.mark.parametrize("want", [(0.5, 0.3, 0.2), (0.9, 0.05, 0.05), (0.98, 0.02, 0.0)])
@pytest.mark.parametrize("soft", [0.0, 0.4])  # 0.4: the last two targets are out of reach
@pytest.mark.parametrize("how", [X.fit_rates, X.settle_rates])
def test_rates_are_the_closest(spark, want, soft, how):
    rng = np.random.default_rng(4)
    p = (1 - soft) * rng.dirichlet((0.2, 0.2, 0.2), 400) + soft / 3
    n = rng.integers(1, 500, 400)
    target = np.array(want) * n.sum() * 0.4
    df = members(spark, p, n)
    rate = np.array([r[0] for r in df.orderBy("id").select(X._rate(how(df, target, 3), 3)).collect()])
    root = np.linalg.cholesky(np.linalg.inv((p * n[:, None]).T @ p)).T
    closest = nnls(root @ (p * n[:, None]).T, root @ target)
    assert (rate >= 0).all()
    assert np.abs((rate - closest) * n @ p).max() < 1e-6 * target.sum()


def test_rates_that_do_not_settle_raise(spark, monkeypatch):
    monkeypatch.setattr(X, "MAX_SETTLE", 3)
    p = np.random.default_rng(4).dirichlet((0.2, 0.2, 0.2), 400)
    with pytest.raises(ArithmeticError):
        X.settle_rates(members(spark, p, np.full(400, 9)), np.array([1400.0, 40.0, 0.0]), 3)


def test_mix_weights_are_those_first_set():
    from tripflow.llm.queries import MIX

    assert MIX == {"good": 0.996, "low": 0.002, "toxic": 0.002} and X.TOLERANCE == 1e-7


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = {k: ["".join(rng.choice(c) for _ in range(5)) for _ in range(120)] for k, c in (("x", "abcde"), ("y", "fghij"), ("z", "klmno"))}
    rows = []
    for i in range(n):
        kind = rng.choices("xyz", (6, 3, 1))[0]
        rows.append((i, " ".join(rng.choice(vocab[kind]) for _ in range(rng.randrange(20, 80))), kind))
    return rows


def test_mix_of_documents(spark):
    rows = corpus(1, 900)
    odd = [(5000, None), (5001, ""), (5002, rows[0][1]), (5002, rows[0][1]), (None, rows[1][1])]
    df = spark.createDataFrame([(i, t, 0.5, 1) for i, t, *_ in rows + odd], "doc_id long, text string, rate double, id int")
    known = [(i, k) for i, _, k in rows if i % 2] + [(None, "x"), (1, "none"), (88888, "w")]
    labels = spark.createDataFrame(known, "doc_id long, kind string")
    got = X.mix_rates(df.repartition(3), labels, "doc_id", "text", DOMAIN, {"x": 4.0, "y": 4.0, "z": 2.0, "q": 9.0}, "x").collect()
    assert len(got) == len(rows) + len(odd)
    p = np.array([r.p for r in got])
    n = np.array([r.n_tokens for r in got])
    rate = np.array([r.rate for r in got])
    names = "xyz"
    right = [names[int(np.argmax(r.p))] == dict((i, k) for i, _, k in rows)[r.doc_id] for r in got if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 2 == 0]
    assert np.mean(right) > 0.97
    total = (rate * n) @ p
    assert np.allclose(total / total.sum(), [0.4, 0.4, 0.2], atol=1e-5)
    assert total[0] == pytest.approx((n @ p)[0], rel=1e-5)
    for r in got:
        assert r.copies in (int(r.rate), int(r.rate) + 1)
        if r.doc_id in (5000, 5001):
            assert (r.n_tokens, r.rate, r.copies) == (0, 1.0, 1)
    assert len({(r.rate, r.copies) for r in got if r.doc_id == 5002}) == 1
    assert sum(r.copies for r in got) == pytest.approx(rate.sum(), rel=0.05)


def test_rare_domain_and_hot_id_in_the_labels(spark, monkeypatch):
    monkeypatch.setattr(X, "MAX_LABELLED", 40)
    monkeypatch.setattr(X, "LEAST_LABELLED", 3)
    rows = [(i, f"text number {i}") for i in range(300)] + [(7, "copied text")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = [(i, "x") for i in range(299)] + [(299, "rare")] + [(10_000 + i, "gone") for i in range(900)]
    labels = spark.createDataFrame(known, "doc_id long, kind string")
    names, _, at, truth = X.labelled_features(df, labels, "doc_id", "text", DOMAIN)
    assert names == ["rare", "x"] and truth.tolist().count(0) == 1
    assert 30 <= len(truth) <= 40 + 2 * 3 and len(truth) == at.max() + 1


def test_too_few_domains_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    one = spark.createDataFrame([(1, "x")], "doc_id long, kind string")
    assert {r.rate for r in X.mix_rates(df, one, "doc_id", "text", DOMAIN, {"x": 1.0}, "x").collect()} == {1.0}
    none = one.limit(0)
    assert {r.copies for r in X.mix_rates(df, none, "doc_id", "text", DOMAIN, {"x": 1.0}, "x").collect()} == {1}
    assert X.mix_rates(df.limit(0), one, "doc_id", "text", DOMAIN, {"x": 1.0}, "x").count() == 0
