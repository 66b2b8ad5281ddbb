"""Licence scans against plain word lists, and templates in odd places."""

import random
import re

import numpy as np
from pyspark.sql import Row

from tripflow.llm import license_scan as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def plain_base(text):
    words = plain_words(text)
    places = []
    for phrase, label in L.BASE_PHRASES:
        p = phrase.split(" ")
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def odd_texts():
    rng = random.Random(5)
    bits = ["MIT", "license", "License", "apache", "general", "PUBLIC", "é", "漢字", "x1", "the", "İ", "ß"]
    seps = [" ", "\n", "-", ", ", "\x00", "\x7f"]
    mixed = ["".join(rng.choice(bits) + rng.choice(seps) for _ in range(60)) for _ in range(40)]
    return [
        None,
        "",
        "...",
        "mit license",
        "MIT\nLICENSE. mit-license mitlicense",
        "general public license " * 50,
        "MIT License" + "é",
        *mixed,
        "word " * 300_000 + "Apache License" + " word" * 1000,
        "a" * (L.SLICE_BYTES + 77) + " mit license",
    ]


def test_base_columns_equal_a_plain_search(spark):
    texts = odd_texts()
    df = spark.createDataFrame(
        [Row(doc_id=i, text=t, places="x", id=1) for i, t in enumerate(texts)],
        "doc_id long, text string, places string, id int",
    )
    got = {r.doc_id: r for r in L.license_labels(L.scan_licenses(df, "doc_id", "text"), "doc_id").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(t), i
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0.0 <= r.score <= 1.0


def index():
    v = L.Vocabulary(L.TEMPLATES, L.BASE_PHRASES)
    return v, L.RareWordIndex(v, {v.number[w]: 90 for w in (b"the", b"of", b"is", b"to", b"and")}, 100)


def labels_of(text):
    v, x = index()
    return {m.label for m in x.matches(v.look_up(text.encode()))}


def test_every_template_is_found_inside_other_text():
    filler = " ".join(f"w{i}" for i in range(500))
    for t in L.TEMPLATES:
        assert t.label in labels_of(f"{filler} {t.text.upper()}\n{filler}"), t
        words = t.text.split(" ")
        if len(words) > 12:  # a word added in the middle
            more = " ".join(words[:6] + ["added"] + words[6:])
            assert t.label in labels_of(f"{filler} {more} {filler}"), t


def test_templates_need_their_key_phrases_and_order():
    mit = L.TEMPLATES[1].text
    assert labels_of(mit.replace("hereby", "thereby")) == set()
    words = mit.split(" ")
    random.Random(1).shuffle(words)
    assert labels_of(" ".join(words)) == set()
    assert labels_of("the software is furnished to persons, of the rights to use and the copies") == set()


def test_several_licences_and_many_copies_in_one_text():
    text = "\n".join(f"{t.text} and more words of file {i}" for i, t in enumerate(L.TEMPLATES))
    assert labels_of(text) == {t.label for t in L.TEMPLATES}
    v, x = index()
    many = x.matches(v.look_up(("Licensed under CC BY-NC 4.0. " + "some other words here " * 5).encode() * 200))
    assert {m.start for m in many} == {i * 27 for i in range(200)} and {m.label for m in many} == {"cc-by-nc"}


def brute_matches(v, x, ids):
    """All windows of all templates, one by one."""
    chosen, out = x.rarest(ids), set()
    half = L.WINDOW // 2
    for t, (label, words, keys) in enumerate(v.templates):
        rare = chosen.get(t, [])
        need = max(2, -(-min(L.RARE, len(set(words.tolist()))) // 2))
        for low in range(-((len(words) + L.WINDOW) // half + 1) * half, len(ids), half):
            agree = {
                w
                for start in range(low, low + L.WINDOW)
                for p, w in enumerate(words.tolist())
                if w in rare and 0 <= start + p < len(ids) and ids[start + p] == w
            }
            if len(agree) < need:
                continue
            area = range(max(0, low), low + L.WINDOW + len(words))
            if not all(
                any(i + len(k) <= area.stop and ids[i : i + len(k)].tolist() == k.tolist() for i in area) for k in keys
            ):
                continue
            hits = [
                (start + p, p)
                for start in range(low, low + L.WINDOW)
                for p in range(len(words))
                if 0 <= start + p < len(ids) and ids[start + p] == words[p]
            ]
            share = len({p for _, p in hits}) / len(words)
            if share >= L.MIN_SHARE:
                first = min(
                    min(s for s, q in hits if s - q == start)
                    for start in range(low, low + L.WINDOW)
                    if any(s - q == start for s, q in hits)
                )
                out.add((label, first, round(share, 9)))
    return out


def test_matches_equal_brute_force_over_all_windows():
    rng = random.Random(9)
    v, x = index()
    some = [t for t in L.TEMPLATES if len(t.text) < 90]
    for _ in range(25):
        parts = []
        for _ in range(6):
            w = rng.choice(some).text.split(" ")
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = rng.choice(["x", "license", "the"])
            parts += w + ["y"] * rng.randrange(4)
        ids = v.look_up(" ".join(parts).encode())
        assert {(m.label, m.start, round(m.score, 9)) for m in x.matches(ids)} == brute_matches(v, x, ids)


def test_idf_counts_texts_and_decides_what_is_looked_up(spark):
    v = L.Vocabulary(L.TEMPLATES, L.BASE_PHRASES)
    df = spark.createDataFrame([("mit mit license",), ("license",), (None,), ("other",)], "text string")
    counts, n = L.license_word_counts(df, "text", v)
    assert n == 4 and counts == {v.number[b"mit"]: 1, v.number[b"license"]: 2}
    x = L.RareWordIndex(v, {i: 50 + (i % 2) * 40 for i in range(len(v.words))}, 100)
    for t, rare in x.rarest(np.arange(len(v.words), dtype=np.int32)).items():
        own = sorted(set(v.templates[t][1].tolist()), key=lambda w: (w % 2, w))
        assert rare == own[: L.RARE]


def test_null_ids_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "MIT License"), (1, "MIT License"), (None, None)], "doc_id long, text string")
    got = L.license_labels(L.scan_licenses(df, "doc_id", "text"), "doc_id").collect()
    assert sorted((r.doc_id or 0, r.n_base, r.labels) for r in got) == [(0, 0, ""), (1, 1, "mit"), (1, 1, "mit")]
    assert L.scan_licenses(df.where("doc_id > 9"), "doc_id", "text").count() == 0
