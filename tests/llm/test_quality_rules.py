"""Counts against a plain version; learned lists on held-out rows."""

import random
import re

import numpy as np

from tripflow.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    times = {}
    for i in range(len(words) - 2):
        times.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {p for at in times.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeated))


def test_counts_equal_a_plain_version():
    rng = random.Random(2)
    parts = ["a", "b", "é", "漢字", "#x", "|", " ", " ", " ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "a a a"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert Q.text_counts(t)[:5] == plain(t), repr(t)


def docs(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(60, 200))]
        bad = rng.random() < 0.3
        if bad and rng.random() < 0.5:
            words = [w + "&&" for w in words]
        elif bad:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_verdicts(spark):
    rows, labels = docs(1, 900)
    odd = [(5000, None), (5001, ""), (5002, "one two"), (5003, "spam spam " * 100), (5004, rows[0][1]), (5004, rows[0][1]), (None, rows[1][1])]
    df = spark.createDataFrame([(*r, True, 1) for r in rows + odd], "doc_id long, text string, kept boolean, n_words int")
    taught = [x for x in labels if x[0] % 3] + [(None, 0, 0), (1, None, 0), (99999, 0, 0)]
    known = spark.createDataFrame(taught, "doc_id long, quality int, toxic int")
    got = Q.quality_verdicts(df.repartition(3), known, "doc_id", "text", "quality").collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 3 == 0]
    assert np.mean([r.kept == bool(truth[r.doc_id]) for r in held]) > 0.97
    for r in got:
        want = plain(dict(rows + odd)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "word " + " ".join(map(str, range(80))))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in Q.quality_verdicts(df, none, "doc_id", "text", "quality").collect()] == [True]
    assert Q.quality_verdicts(df.limit(0), none, "doc_id", "text", "quality").count() == 0


def test_a_rule_is_an_ordered_conditional(spark):
    values = {"words": np.array([1.0, 2, 3, 10, 11, 12] * 20)}
    rules = Q.learn_rules(values, values["words"] > 5, np.arange(120) % 3 == 0)
    ((rule,),) = rules
    assert (rule.feature, rule.above) == ("words", True) and 3 < rule.threshold < 10
    stats = spark.createDataFrame([(3, 1, 0, 0, 0, 1, 0, 0), (30, 1, 0, 0, 0, 1, 0, 0)], [f"{c}" for c in Q.COUNTS])
    assert [r[0] for r in stats.select(Q.verdict(rules)).collect()] == [True, False]


def test_lowest_hashes_with_repeats_and_few_rows(spark):
    from tripflow.llm.common import lowest

    df = spark.range(3000).selectExpr("id", "xxhash64(id % 500) AS h").unionAll(spark.range(1).selectExpr("id", "9223372036854775807L AS h"))
    for n in (1, 7, 100, 2999, 5000):
        want = df.orderBy("h", "id").limit(n).collect()
        assert lowest(df.repartition(5), n, "h", "id").collect() == want
    assert lowest(df.where("id < 0"), 5, "h", "id").collect() == []
