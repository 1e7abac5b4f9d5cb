import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from textgate.llm.simhash import composite_keys, fingerprints, golay_keys, golay_tables, keep_smallest, linked_groups, simhash_groups


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    r = random.Random(3)
    texts = ["", "one", "Two words", "ÄRGER ärger A b c", *(" ".join(r.choice("abcdefgh") * 2 for _ in range(r.randint(3, 900))) for _ in range(40))]
    assert fingerprints([t.encode() for t in texts]).tolist() == [plain_fingerprint(t) for t in texts]
    assert fingerprints([]).tolist() == []


def test_golay_code_is_perfect():
    message, near, four = golay_tables()
    assert len(set(near.tolist())) == 2048 and max(int(x).bit_count() for x in near) == 3
    assert sum((f >= 0).all() for f in four) == 1771
    words = (np.arange(4096) << 11) | message
    assert (golay_keys(words)[:, 0] == np.arange(4096)).all() and (golay_keys(words)[:, 1:] == -1).all()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3, unique=True))
def test_prints_within_three_bits_share_a_key(a, bits):
    b = a
    for i in bits:
        b ^= 1 << i
    where, keys = composite_keys(np.array([a, b], np.uint64))
    assert set(keys[where == 0].tolist()) & set(keys[where == 1].tolist())


def components_of(prints, ids, most=3):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    named = {}
    for i, k in enumerate(ids):
        if k is not None:
            named[root(i)] = min(k, named.get(root(i), k))
    return [named.get(root(i)) for i in range(len(ids))]


def test_groups_equal_brute_force(spark):
    r = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    rows = [(None, None), (50, ""), (51, None), (52, " \n"), (None, "solo text here")]
    for g in range(12):
        base = [r.choice(words) for _ in range(200)]
        for v in range(6):
            text = list(base)
            for _ in range(v // 2):
                text[r.randrange(200)] = r.choice(words)
            rows.append((1000 - 10 * g - v, " ".join(text)))
    rows += [rows[-1], (3, "word " * 30_000)]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, print int, key int")
    prints = [plain_fingerprint(t) for _, t in rows]
    want = sorted(zip([k for k, _ in rows], prints, components_of(prints, [k for k, _ in rows])), key=repr)
    got = [(x.doc_id, x.print & (1 << 64) - 1, x.component_id) for x in simhash_groups(df).collect()]
    assert sorted(got, key=repr) == want
    kept = keep_smallest(df)
    assert kept.columns == df.columns
    groups = {(c if c is not None else "none", p if c is None else 0) for _, p, c in want}
    assert len({(x.doc_id, x.text) for x in kept.collect()}) == len(groups)


def test_sets_of_near_copies_give_a_forest():
    r = np.random.default_rng(0)
    seed = np.uint64(12345678901234567)
    prints = np.unique(np.array([seed ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(40) for j in range(i)]))
    r.shuffle(prints)
    sets = list(linked_groups(prints.view(np.int64), 3))
    assert sum(len(o) for _, o in sets) <= len(prints) - 1
    chain = np.array([(1 << (2 * k)) - 1 for k in range(20)], np.uint64)  # each two bits from the next
    (seed, others), = linked_groups(chain.view(np.int64), 3)
    assert len(others) == 19


def test_empty_and_limits(spark):
    assert simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        simhash_groups(spark.createDataFrame([], "doc_id long, text string"), most=4)


def test_unrelated_documents_without_an_id_are_all_kept(spark):
    texts = [" ".join(f"{a}{i}" for i in range(80)) for a in "abc"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, "quite another text")]
    kept = keep_smallest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, rows))
    groups = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.root for r in groups}) == 4 and sum(r.component_id is None for r in groups) == 3
