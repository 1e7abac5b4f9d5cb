import hashlib
import random

import numpy as np
import xxhash

from conftest import SF001
from textgate.llm import order_minhash as omh
from textgate.llm.order_minhash import _ODD, PAD, edited_fingerprints, fingerprints, hexed, likeness, op12, sketches

SCHEMA = "doc_id long, text string, n_chars string, hash int, id string"
M = 2 ** 64


def mix(x):
    x = (x ^ x >> 32) * _ODD[0] % M
    x = (x ^ x >> 29) * _ODD[1] % M
    return x ^ x >> 32


def brute(text, k, components, size, digits):
    """One component after the other, from sorted lists of numbered k-mers."""
    if not text:
        return [0] * components
    points = [*map(ord, text), *[PAD] * (k - len(text))]

    def run(at, width):
        """Hash of 2^i code points: the halves', joined."""
        if width == 1:
            return mix((points[at] + _ODD[2]) % M)
        half = width // 2
        return (run(at, half) * (_ODD[4] + 2 * half) + run(at + half, half)) % M

    def kmer(at):
        value, done = None, 0
        for bit in range(k.bit_length()):
            if k >> bit & 1:
                part = run(at + done, 1 << bit)
                value, done = part if value is None else (value * _ODD[3] + part) % M, done + (1 << bit)
        return mix(value)

    seen, numbered = {}, []
    for at in range(len(points) - k + 1):
        h = kmer(at)
        seen[h] = seen.get(h, -1) + 1
        numbered.append((mix((h + seen[h] * _ODD[6]) % M) >> 32, h))
    out = []
    for j in range(components):
        seed = xxhash.xxh64_intdigest(b"function", j)
        order = sorted(range(len(numbered)), key=lambda i: (((numbered[i][0] ^ seed >> 32) * (seed & 0xFFFFFFFF | 1)) % 2 ** 32, i))
        value = _ODD[7]
        for i in sorted(order[:size]):
            value = mix((value + numbered[i][1]) % M)
        out.append((value >> 1) % (16 ** digits - 1) + 1)
    return out


def test_sketches_equal_the_definition():
    rnd = random.Random(2)
    texts = ["", "a", "ab", "é😀" * 3, "aaaa" * 40, "x" * 63, "abc " * 200] + ["".join(rnd.choice("ab é\n") for _ in range(n)) for n in (4, 5, 6, 64, 65, 300)]
    for k, size in ((4, 2), (5, 3), (1, 1), (10, 2)):
        got = sketches(texts, k, 7, size, 4)
        assert got.tolist() == [brute(t, k, 7, size, 4) for t in texts]
    assert hexed(got[:2]) == ["0" * 28, "".join(f"{c:04x}" for c in got[1].tolist())]
    assert hexed(sketches(texts, digits=3), 3)[1] == "".join(f"{int(c):03x}" for c in sketches(texts, digits=3)[1])


def test_a_text_does_not_depend_on_its_company(monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    whole = sketches(texts)
    monkeypatch.setattr(omh, "TOGETHER", 500)
    assert (sketches(texts) == whole).all() and (sketches(texts[7:8]) == whole[7]).all()


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_likeness_falls_with_edits_and_with_order():
    rnd = random.Random(4)
    texts = [words(rnd, 400) for _ in range(20)]
    base = sketches(texts)

    def mean(changed):
        return likeness(base, sketches(changed)).mean()

    def edit(t, share):
        return "".join(rnd.choice("xyz") if rnd.random() < share else c for c in t)

    falls = [mean([edit(t, s) for t in texts]) for s in (0, 0.002, 0.01, 0.05)]
    assert falls[0] == 1 and all(a > b + 0.05 for a, b in zip(falls, falls[1:])) and falls[1] > 0.8
    assert mean(texts[1:] + texts[:1]) < 0.01
    # the same k-mers in another order: plain MinHash would call these nearly equal
    blocks = [[t[i:i + 200] for i in range(0, len(t), 200)] for t in texts]
    assert mean(["".join(reversed(b)) for b in blocks]) < 0.65


def expected(rows):
    """[(doc_id, text)] to the sorted result rows, by a plain walk."""
    rows = [(i, t or "") for i, t in rows]
    signed = {t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (M if h >= M // 2 else 0) for _, t in rows}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed[r[1]]), reverse=True)
    out = []
    for at, (i, t) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        a, b, c = sketches([t, edited, following])
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(a[None])[0], hexed(b[None])[0], (a == b).mean(), (a == c).mean()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, None) for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed, n):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, n), words(rnd, rnd.randint(0, 30)) + rnd.choice(["", "é", "😀"])) for _ in range(n)]
    rows += [(5, "one text")] * 30 + [(6, "one text")] * 4 + [(None, None)] * 5 + [(None, ""), (None, "z"), (7, None), (8, "w " * 30_000)]
    rnd.shuffle(rows)
    return rows


def test_against_a_plain_walk(spark):
    rows = made(6, 150)
    df = table(spark, rows)
    want = expected(rows)
    assert got(edited_fingerprints(df.repartition(7))) == want
    assert {(r[0], r[1], r[3]) for r in want} == {tuple(r) for r in fingerprints(df).collect()}


def test_buckets_do_not_change_the_result(spark, monkeypatch):
    rows = made(7, 200) + [(500, "first")] * 3
    df = table(spark, rows)
    monkeypatch.setattr(omh, "BUCKET_BYTES", 3000)
    assert got(edited_fingerprints(df.repartition(9))) == expected(rows)


def test_small_tables(spark):
    assert edited_fingerprints(table(spark, [])).count() == 0
    assert got(edited_fingerprints(table(spark, [(1, "alone, and long enough")]))) == expected([(1, "alone, and long enough")])
    rows = [("b", "some words"), ("a", "other words here"), (None, "none")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    named = expected([({"a": 1, "b": 2}.get(i), t) for i, t in rows])
    assert {r[1:] for r in got(edited_fingerprints(df))} == {r[1:] for r in named}


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    result = got(op12(spark, SF001))
    assert result == expected(rows)
    long_ones = [r for r in result if r[1] > 500]
    assert np.mean([r[5] > r[6] for r in long_ones]) > 0.95
