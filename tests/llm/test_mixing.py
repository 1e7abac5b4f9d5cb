import hashlib
import random

import pytest

from textgate.llm.mixing import mix, mixed


def brute(rows, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    """(doc_id, source) -> (size, source_size, target), and taken by the definition: hashes in order."""
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    h = [int(hashlib.md5(b"" if k is None else str(k).encode()).hexdigest()[:15], 16) for k, _, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(z for z, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    level, full = 0.0, set()
    while True:
        full = {s for s in sources if most * total[s] <= level * weight[s]}
        free = sum(weight[s] for s in sources if s not in full)
        new = (share * sum(total.values()) - sum(most * total[s] for s in full)) / free if free else level
        if new == level or not free:
            break
        level = new
    target = {s: min(most * total[s], level * weight[s]) for s in sources}
    taken = [0] * len(rows)
    for s in sources:
        own = [i for i, r in enumerate(rows) if r[2] == s]
        times = int(target[s] // total[s]) if total[s] else 0
        budget, done = target[s] - times * total[s], 0
        more = set()
        for value in sorted({h[i] for i in own}):
            part = [i for i in own if h[i] == value]
            end = done + sum(size[i] for i in part)
            if end > budget and not end - budget < budget - done:
                break
            more |= set(part)
            if end > budget:
                break
            done = end
        for i in own:
            taken[i] = size[i] * (times + (i in more))
    return [(k, s, size[i], total[s], pytest.approx(target[s]), taken[i]) for i, (k, _, s) in enumerate(rows)]


def corpus(seed=0):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * r.randint(1, 30)), r.choice(["a", "B", "é", None, "a", "a"])) for i in range(200)]
    return rows + [(500, None, "a"), (501, "", "zero"), (None, "x y", "a"), (None, "x\ny\tz", "B"), (7, "again again", "a"), (7, "again again", "a"),
                   (900, "w " * 5000, "long")]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, source string, size int, target int")
    got = [tuple(x) for x in mix(df).collect()]
    key = lambda x: (repr(x[:4]), repr(x[5]))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    by = {}
    for _, s, _, n, target, taken in got:
        by.setdefault(s, [n, target, 0])[2] += taken
    assert all(t <= 2 * n for n, t, _ in by.values())
    assert all(abs(t - got) <= 5000 if s == "long" else abs(t - got) <= 31 for s, (_, t, got) in by.items())


def test_mix_repeats_whole_rows(spark):
    rows = corpus()
    df = spark.createDataFrame([(*x, 5) for x in rows], "doc_id long, text string, source string, of int")
    out = mixed(df)
    assert out.columns == df.columns
    words = sum(len((x.text or "").split()) for x in out.collect())
    assert words == sum(x[5] for x in brute(rows))


def test_empty_and_sourceless(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    assert mixed(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(x) for x in mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema)).orderBy("doc_id").collect()] \
        == [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    for out in (mix(df), mixed(df)):
        plan = out._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
