"""Top-k, ratios and the sample itself."""

import random

import numpy as np
import pytest

from tripflow.llm import resample as R


@pytest.mark.parametrize("k", [1, 2, 37, 499, 500])
def test_kth_largest_is_exact(spark, k):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.integers(-(2**63), 2**63 - 1, 300), rng.integers(-5, 5, 200)]).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
    assert R.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_order_of_keys_is_that_of_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -0.0, 0.0, 1e-300, 3.5, np.inf]) + 0.0
    bits = x.view(np.int64)
    order = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
    assert (np.diff(order) >= 0).all()


def test_ratios():
    raw = np.zeros(R.BUCKETS, int)
    target = raw.copy()
    raw[:1000], target[:1000] = 1000, 400  # ordinary
    raw[1000], target[1000] = 1000, 10  # shunned by the target
    raw[1001], target[1001] = 4, 0  # too rare to tell
    raw[1002], target[1002] = 1000, 900
    got = R.log_ratios(np.stack([target, raw]))
    assert got[0] == 0 and got[1001] == 0 and got[1002] == 0 and got[1000] < -3
    assert not R.log_ratios(np.zeros((2, R.BUCKETS))).any()


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(40, 300))]
        kind = rng.random()
        if kind < 0.1:
            text[rng.randrange(len(text))] = "awful"
        elif kind < 0.25:
            text = [w + "###" for w in text]
        rows.append((i, " ".join(text)))
        labels.append((i, int(kind >= 0.25 or kind < 0.1), int(kind < 0.1)))
    return rows, labels


def test_sample_keeps_the_target(spark):
    rows, labels = corpus(3, 3000)
    odd = [(9000, None), (9001, ""), (9002, rows[0][1]), (9002, rows[0][1]), (None, rows[2][1])]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows + odd], "doc_id long, text string, log_weight double, id int")
    known = spark.createDataFrame([x for x in labels if x[0] % 2] + [(None, 1, 0), (77777, 1, 0)], "doc_id long, quality int, toxic int")
    got = R.resample(df.repartition(4), known, "doc_id", "text", "quality = 1 and toxic = 0").collect()
    assert len(got) == len(rows) + len(odd)
    kept = {r.doc_id: r.kept for r in got}
    good = [kept[i] for i, q, t in labels if i % 2 == 0 and q and not t]
    bad = [kept[i] for i, q, t in labels if i % 2 == 0 and not (q and not t)]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1
    share = np.mean([q and not t for i, q, t in labels if i % 2])
    assert abs(sum(r.kept for r in got) - share * len(got)) <= 3
    assert {r.kept for r in got if r.doc_id == 9002} in ({True}, {False})


def test_without_labels_all_stays(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in R.resample(df, none, "doc_id", "text", "quality = 1").collect())
    some = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in R.resample(df, some, "doc_id", "text", "quality = 1").collect())
    assert R.resample(df.limit(0), none, "doc_id", "text", "quality = 1").count() == 0
