"""Line dedup against a plain version."""

import random

import pytest

from tripflow.llm import line_dedup as L


def brute(rows, ratio=L.RATIO, min_pages=L.MIN_PAGES):
    pages = {}
    for _, host, text in rows:
        if text is not None:
            pages.setdefault(host or "", set()).add(text)
    drop = {}
    for host, texts in pages.items():
        n = {}
        for t in texts:
            for line in {x.strip(" ") for x in t.split("\n")} - {""}:
                n[line] = n.get(line, 0) + 1
        drop[host] = {x for x, c in n.items() if c >= min_pages and c > ratio * len(texts)}
    out = []
    for key, host, text in rows:
        if text is None:
            out.append((key, None, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if x.strip(" ") not in drop[host or ""]]
        out.append((key, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=str)


def rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(400):
        host = rng.choice(["a", "a", "a", "b", "c", None])
        lines = [f"line {rng.randrange(4000)}" for _ in range(rng.randrange(1, 8))]
        if rng.random() < 0.2:
            lines.insert(0, rng.choice(["All rights reserved", "  All rights reserved ", "All  rights reserved"]))
        if host == "b":
            lines.append("Home | About")
        out.append((i, host, "\n".join(lines)))
    copied = "only in copies\nof one page"
    out += [(1000 + i, "a", copied) for i in range(200)]
    out += [(2000, "a", None), (2001, None, ""), (2002, "d", "Home | About"), (2003, "b", "\n\n \n"), (2004, "b", "Home | About")]
    out += [(3, "a", "line 1"), (3, "a", "line 1"), (None, "a", "é\n" * 9)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_version(spark, seed):
    df = spark.createDataFrame([(*r, "x", 5, 1) for r in rows(seed)], "doc_id long, source string, text string, lines string, host int, page int")
    got = L.drop_boilerplate(df.repartition(4), "source", "text", dropped_col="n")
    assert got.columns == [*df.columns, "n"]
    assert sorted(((r.doc_id, r.text, r.n) for r in got.collect()), key=str) == brute(rows(seed))
    assert {(r.lines, r.host, r.page) for r in got.collect()} == {("x", 5, 1)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert L.drop_boilerplate(df, "source", "text").count() == 0
