import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textgate.llm import language_model as L
from textgate.llm.texts import tokens

WORDS = [b"w%d" % i for i in range(60)]


def vocabulary(size=20, classes=4):
    counts = [(w, 600 // (i + 1)) for i, w in enumerate(WORDS)] + [(L.END, 40)]
    n = sum(c for _, c in counts)
    return L.words_of(counts, n, len(counts), size, classes), n


def test_classes_part_the_words():
    words, n = vocabulary()
    assert words.class_of.tolist() == sorted(words.class_of) and words.starts[-1] == len(words.class_of) == 20
    assert words.class_of[words.rare] != words.class_of[words.rare - 1]
    assert abs(words.share.sum() - n - 20 * L.SMOOTHING) < 1e-6
    assert words.model_id[words.place[L.END]] == words.end


def test_probabilities_sum_to_one():
    words, _ = vocabulary()
    m = L.Model(words, 8)
    r = np.random.default_rng(1)
    m.set_flat(r.normal(0, 0.5, m.flat().shape))
    h = r.normal(size=(1, 8)).astype(np.float32)
    total = sum(math.exp(L._outputs(m, words, h, np.array([k]), None)[0][0]) for k in range(20))
    assert total == pytest.approx(1, abs=1e-5)


def test_gradients_equal_differences():
    words, _ = vocabulary()
    m = L.Model(words, 5)
    r = np.random.default_rng(2)
    start = r.normal(0, 0.4, m.flat().shape)
    m.set_flat(start)
    texts = [r.integers(0, 20, 9).astype(np.int32), r.integers(0, 20, 6).astype(np.int32)]
    for t in texts:
        t[-1] = words.end
    trainer = L.Trainer(m, words)
    seen = {}
    trainer._step = lambda name, rows, grad: seen.__setitem__(name, (rows, grad.copy()))
    trainer.learn(texts)
    total = sum(map(len, texts))

    def loss(values):
        return -L.log_likelihoods(L.Model(words, 5).set_flat(values), words, texts).sum() / total

    at = 0
    for name in m.NAMES:
        shape = getattr(m, name).shape
        rows, grad = seen[name]
        full = np.zeros(shape)
        full[rows] = grad
        for k in r.choice(full.size, min(6, full.size), replace=False):
            step = np.zeros_like(start)
            step[at + k] = 3e-3
            assert (loss(start + step) - loss(start - step)) / 6e-3 == pytest.approx(full.ravel()[k], abs=2e-3)
        at += full.size


def test_state_is_carried_over_windows_and_streams_do_not_mix():
    words, _ = vocabulary()
    m = L.Model(words, 6)
    r = np.random.default_rng(3)
    m.set_flat(r.normal(0, 0.6, m.flat().shape))
    texts = [np.append(r.integers(0, 19, n), words.end).astype(np.int32) for n in (0, 1, 7, 150, 33, 64)]
    together = L.log_likelihoods(m, words, texts)
    for t, got in zip(texts, together):
        state, total, before = np.zeros((1, 6), np.float32), 0.0, words.end
        for token in t:  # one step at a time, no windows
            state = L._run(m, state, np.array([[before]]), np.ones((1, 1), np.float32))[0][-1]
            total += L._outputs(m, words, state, np.array([token]), None)[0][0]
            before = token
        assert got == pytest.approx(total, rel=1e-4)


def test_training_learns_an_order(spark):
    words, _ = vocabulary()
    texts = [np.append(np.tile([1, 2, 3], 30), words.end).astype(np.int32) for _ in range(300)]
    m = L.Model(words, 8)
    before = L.log_likelihoods(m, words, texts[:5]).sum()
    L.Trainer(m, words).learn(texts)
    assert L.log_likelihoods(m, words, texts[:5]).sum() > 0.3 * before


def documents(spark):
    rows = [(i, " ".join(["The", "cat", "sat", "on", "word%d" % (i % 37), "É%d" % i] * (1 + i % 7))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "the cat"), (None, None), (5, rows[5][1]), (202, "zzz never seen " * 3000)]
    return spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, row int, tail int"), rows


def held(k):
    return zlib.crc32(b"" if k is None else str(k).encode()) % 10 == 0


def test_counts_and_base_score(spark, monkeypatch):
    df, rows = documents(spark)
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0
    counts = Counter(w for k, t in rows if not held(k) for w in [*tokens((t or "").encode()), L.END])
    n, v = sum(counts.values()), len(counts)
    for frequent in (100_000, 12):  # with all words in every task, and with most of them joined
        monkeypatch.setattr(L, "FREQUENT", frequent)
        monkeypatch.setattr(L.frequent_words, "__defaults__", (frequent,))
        got = L.lm_scores(df, learn).collect()
        want = []
        for k, t in rows:
            own = [*tokens((t or "").encode()), L.END]
            want.append((k, len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 4)))
        assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=repr) == sorted(want, key=repr)
        assert sum(r.score for r in got if r.doc_id != 202) > sum(r.base_score for r in got if r.doc_id != 202)


def test_nothing_to_learn_from_and_empty(spark):
    df, rows = documents(spark)
    got = L.lm_scores(df, F.lit(False)).collect()
    assert len(got) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)
    assert L.lm_scores(df.limit(0), F.lit(True)).count() == 0


def test_vocabulary_grows_with_the_corpus(spark):
    """Words of a count of sqrt(tokens) / 64 or more have a probability of their own, also beyond 1,024."""
    counts = [(b"w%d" % i, 3000 // (i // 10 + 1)) for i in range(5000)] + [(L.END, 300)]
    n = sum(c for _, c in counts)
    least = max(5, math.sqrt(n) / 64)
    words = L.words_of(counts, n, len(counts))
    own = {w for w, c in counts if c >= least}
    assert len(own) > 2500 and {w for w, i in words.place.items() if i < words.rare} == own
    assert len(words.starts) - 2 == pytest.approx(0.6 * math.sqrt(len(own)), rel=0.1)
    table = spark.createDataFrame([(bytearray(w), c) for w, c in counts], "word binary, n bigint")
    assert own <= {bytes(w) for w, _ in L.frequent_words(table, 100, down_to=least)}
    m = L.Model(words, 4)
    r = np.random.default_rng(4)
    m.set_flat(r.normal(0, 0.5, m.flat().shape))
    every = np.arange(len(words.class_of))
    logs, _ = L._outputs(m, words, np.repeat(r.normal(size=(1, 4)).astype(np.float32), len(every), axis=0), every, None)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    state = np.zeros((1, 4), np.float32)  # two words that were one rare word before
    a, b = (L._run(m, state, np.array([[words.place[b"w%d" % i]]]), np.ones((1, 1), np.float32))[0][-1] for i in (2000, 2500))
    assert not np.allclose(a, b)


def texts_of(n, seed):
    r = np.random.default_rng(seed)
    return [" ".join(WORDS[i].decode() for i in r.integers(0, 30, r.integers(1, 40))) for _ in range(n)]


def replica(words, batches, values):
    out = pa.Table.from_batches(list(L._train_replica(words, values, 8192)(iter(batches)))).to_pylist()
    return {x["part"]: (x["seen"], x["data"]) for x in out}


def test_a_replica_learns_alike_however_its_rows_are_cut(monkeypatch):
    """Each Arrow batch had some hundred steps of its own, so many small ones cost as many times as much."""
    words, _ = vocabulary()
    values = L.Model(words).flat()
    whole = pa.RecordBatch.from_pydict({"text": pa.array(texts_of(300, 5), pa.string())})
    cut = [whole.slice(i, 23) for i in range(0, 300, 23)]
    steps = []
    step = L.Trainer._step
    monkeypatch.setattr(L.Trainer, "_step", lambda self, name, *x: (steps.append(name), step(self, name, *x)))
    one = replica(words, [whole], values)
    n = len(steps)
    assert replica(words, cut, values) == one and len(steps) == 2 * n
    # parts of bounded size: every token is learned from, and the last part is not a small one
    monkeypatch.setattr(L, "HELD", 500)
    learned = []
    learn = L.Trainer.learn
    monkeypatch.setattr(L.Trainer, "learn", lambda self, texts: (learned.append(sum(map(len, texts))), learn(self, texts)))
    assert replica(words, cut, values)[-1][0] == one[-1][0] == sum(learned)
    assert len(learned) > 3 and min(learned) >= 500 - 40  # a text less, at most


def test_words_are_split_as_tokens():
    texts = ["  A\tb  C ", "", None, " \n\x0b ", "a\x0bb\x0cc\rd\n", "É\x85x\xa0Y\x1cz", "\x00 Z", "x" * 5000]
    column = pa.array([None if t is None else t.encode() for t in [*texts, "out", "out out"]], pa.binary()).view(pa.string())
    words, n = L._split(pa.RecordBatch.from_arrays([column], ["text"]).slice(0, len(texts)))
    want = [tokens((t or "").encode()) for t in texts]
    assert words.to_pylist() == [w for t in want for w in t] and n.tolist() == [len(t) for t in want]
    places, starts = L._places(words, n, pa.array([b"a", b"b", b"c"], pa.binary()), -1, 9)
    assert [places[s:e].tolist() for s, e in zip(starts, starts[1:])] == [[*({b"a": 0, b"b": 1, b"c": 2}.get(w, -1) for w in t), 9] for t in want]


def test_counts_in_parts():
    rows = texts_of(200, 6)
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(rows[i:i + 30], pa.string())}) for i in range(0, 200, 30)]
    want = Counter(w for t in rows for w in [*tokens(t.encode()), L.END])
    for held_at in (5, 1000):
        got = Counter()
        for batch in L._count(held_at)(iter(batches)):
            for w, c in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                got[w] += c
        assert got == want


def test_large_logits_are_cut():
    words, _ = vocabulary()
    m = L.Model(words, 6)
    r = np.random.default_rng(7)
    m.set_flat(r.normal(0, 60, m.flat().shape))
    h = r.normal(size=(20, 6)).astype(np.float32)
    part, target = np.hstack([h, np.ones((20, 1), np.float32)]), np.arange(20)

    def chosen(rows, own, pick):
        logits = np.clip(rows.astype(float) @ own, -60, 60)
        return logits[pick] - np.log(np.exp(logits).sum())

    want = []
    for own, w in zip(part, target):
        c = words.class_of[w]
        g = words.group_of[c]
        want.append(chosen(m.ws, own, g) + chosen(m.wc[words.groups[g]:words.groups[g + 1]], own, c - words.groups[g])
                    + chosen(m.ww[words.starts[c]:words.starts[c + 1]], own, w - words.starts[c]))
    grad = {n: np.empty_like(getattr(m, n)) for n in ("ws", "wc", "ww")}
    got, dh = L._outputs(m, words, h, target, grad)
    assert got == pytest.approx(want, rel=1e-4, abs=1e-3) and np.isfinite(dh).all() and all(np.isfinite(g).all() for _, g in grad.values())


def test_order_is_stable_beyond_16_bits():
    ids = np.random.default_rng(8).integers(0, 200_000, 5000).astype(np.int32) // 3
    assert L._order(ids).tolist() == np.argsort(ids, kind="stable").tolist()
    assert L._order(ids % 100).tolist() == np.argsort(ids % 100, kind="stable").tolist()
