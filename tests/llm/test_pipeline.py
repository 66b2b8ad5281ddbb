"""Each stage of the corpus pipeline against a plain version on its own input."""

import collections

import pytest

import corpus_pipeline
from tests.llm import test_bpe_codec, test_line_dedup, test_minhash
from tripflow.llm import mixing, resample
from tripflow.llm.common import stage, table
from tripflow.llm.queries import DOMAIN, GOOD, MIX

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    docs = table(spark, SF, "documents")
    extra = spark.createDataFrame([(10**6, None, "en", "src0", 0), (10**6 + 1, "", "en", None, 0), (None, "no id at all", "en", "src1", 12)], docs.schema)
    frames = [stage(docs.unionAll(extra).unionAll(docs.limit(3)), "test-docs")]
    for name, step in corpus_pipeline.STAGES:
        frames.append(stage(step(spark, frames[-1], SF), f"test-{name}"))
    return frames


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_stages_and_columns(inputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mix", "encode"]
    assert all(f.columns == inputs[0].columns for f in inputs[:-1])
    assert inputs[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_drops_what_the_sample_rejects(spark, inputs):
    kept = resample.resample(inputs[0], table(spark, SF, "labels"), "doc_id", "text", GOOD)
    gone = {r.doc_id for r in kept.collect() if not r.kept} - {None}
    want = collections.Counter(r for r in rows(inputs[0], "doc_id", "text") if r[0] not in gone)
    assert collections.Counter(rows(inputs[1], "doc_id", "text")) == want and gone


def test_lines(inputs):
    want = test_line_dedup.brute(rows(inputs[1], "doc_id", "source", "text"))
    got = rows(inputs[2], "doc_id", "text", "n_chars")
    assert sorted(((i, t) for i, t, _ in got), key=str) == sorted(((i, t) for i, t, _ in want), key=str)
    assert all(n == (None if t is None else len(t)) for _, t, n in got)


def test_near_duplicates(inputs):
    before = rows(inputs[2], "doc_id", "text")
    kept = {i for i, _, keep in test_minhash.brute(before) if keep}
    assert collections.Counter(rows(inputs[3], "doc_id", "text")) == collections.Counter(r for r in before if r[0] in kept)


def test_mix(spark, inputs):
    rates = mixing.mix_rates(inputs[3], table(spark, SF, "labels"), "doc_id", "text", DOMAIN, MIX, "good").collect()
    copies = {r.doc_id: r.copies for r in rates if r.doc_id is not None}
    want = collections.Counter()
    for r in rows(inputs[3], "doc_id", "text"):
        want[r] += copies.get(r[0], 1)
    assert collections.Counter(rows(inputs[4], "doc_id", "text")) == +want


def test_encode(inputs):
    want = collections.Counter((i, *test_bpe_codec.expected(t)) for i, t in rows(inputs[4], "doc_id", "text"))
    assert collections.Counter(map(tuple, inputs[5].collect())) == want


def test_empty_documents(spark, inputs):
    docs = inputs[0].limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0
