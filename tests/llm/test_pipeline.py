import re
from collections import Counter

import pytest

import corpus_pipeline
from conftest import SF001
from test_mixing import brute as brute_mix
from test_simhash import components_of, plain_fingerprint
from textgate.llm import pieces, quality
from textgate.plans.fixtures import table
from textgate.session import materialise


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    """The documents that go into each stage, and the last result."""
    got = [table(spark, SF001, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        got.append(materialise(stage(spark, got[-1], SF001), "stage"))
    return got


def test_all_but_the_last_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup",
                                                      "mixing sources to target weights", "SentencePiece encoding and decoding"]
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_quality_stage_rejects_what_scores_low(spark, stages):
    scores = quality.quality_scores(stages[0], table(spark, SF001, "labels"))
    assert {r.doc_id for r in stages[1].collect()} == {r.doc_id for r in scores.collect() if r.predicted == 1}


def test_exact_stage(stages):
    best = {}
    for r in stages[1].collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        best[key] = min(best.get(key, r), r, key=lambda x: x.doc_id)
    assert rows_of(stages[2]) == sorted(map(tuple, best.values()), key=repr)


def test_simhash_stage(stages):
    rows = stages[2].collect()
    named = components_of([plain_fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    assert rows_of(stages[3]) == sorted((tuple(r) for r, c in zip(rows, named) if r.doc_id == c), key=repr)


def test_mix_stage(stages):
    rows = stages[3].collect()
    want = Counter()
    for r, x in zip(rows, brute_mix([(r.doc_id, r.text, r.source) for r in rows])):
        want[tuple(r)] += x[5] // x[2]
    assert Counter(tuple(r) for r in stages[4].collect()) == +want


def test_last_stage_and_run(spark, stages):
    rows = stages[4].select("doc_id", "text").collect()
    back = pieces.decode_table(stages[5].select("doc_id", "ids")).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((r.doc_id, r.text) for r in rows)
    assert rows_of(corpus_pipeline.run(spark, SF001)) == rows_of(stages[5])
