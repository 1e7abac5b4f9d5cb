import zlib

import numpy as np

from textgate.llm import quality as Q


def test_features_of_edge_texts():
    for t in (b"", b"   ", b"x", "é".encode(), b"a a a a", b"\n\n", b"word " * 200_000):
        f = Q.document_features(t)
        assert len(f) == len(Q.FEATURES) and np.isfinite(f).all()
    by = dict(zip(Q.FEATURES, Q.document_features(b"SPAM!! SPAM!! SPAM!! ok")))
    assert by["longest_repeat"] == 0.5 and by["distinct_words"] == 0.5 and by["odd_words"] == 0.75


def test_flat_trees_equal_a_walk_and_learn():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    m = Q.fit(x[:1500], y[:1500])

    def walk(row):
        total = m.base
        for at in m.roots:
            while m.feature[at] >= 0:
                at = m.left[at] + (row[m.feature[at]] > m.threshold[at])
            total += m.value[at]
        return total

    assert np.allclose(m.margins(x[1500:]), [walk(row) for row in x[1500:]])
    assert ((m.scores(x[1500:]) > 0.5) == y[1500:]).mean() > 0.97


def test_degenerate_fits():
    x = np.zeros((4, 3))
    assert 0.4 < Q.fit(np.zeros((0, 3)), np.zeros(0)).scores(x)[0] < 0.6
    assert Q.fit(x, np.ones(4)).scores(x)[0] > 0.8
    assert Q.fit(x, np.array([0, 1, 0, 1.0])).scores(x).tolist() == [0.5] * 4


def documents(spark):
    good = "This is a plain sentence number %d, with some words and an end."
    rows = [(i, (good % i) * 3 if i % 3 else "BUY NOW!! %d!! " % i * 5) for i in range(600)] + [(None, None), (1000, ""), (1001, "w " * 40_000), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(*x, 1, "z") for x in rows], "doc_id long, text string, score int, h string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 600, 2)] + [(None, 1, 0), (7, None, 0), (8, 5, 0), (2, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_held_out_accuracy_and_edges(spark):
    docs, labels, rows = documents(spark)
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5]
    assert len(held) > 50 and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)
    again = {(r.doc_id, r.score) for r in Q.quality_scores(docs.repartition(5), labels).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_accept_keeps_whole_rows(spark):
    docs, labels, _ = documents(spark)
    out = Q.accept(docs, Q.quality_model(docs, labels), 0.3)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect() if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5} == {i for i in range(600) if i % 3 and i != 5}
    empty = Q.quality_scores(docs.limit(0), labels)
    assert empty.count() == 0
    assert {r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_sample_is_bounded(spark):
    docs, labels, _ = documents(spark)
    small = Q.train(docs, labels, sample_rows=20)
    assert small.base != Q.train(docs, labels).base
