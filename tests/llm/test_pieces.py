import random

import numpy as np
import pytest

from textgate.llm import pieces as P


@pytest.fixture(scope="module")
def voc():
    return P.load()


def brute(voc, text):
    """Viterbi by dynamic programming over a plain dictionary."""
    known = {voc.flat[voc.offsets[i]:voc.offsets[i + 1]].tobytes(): i for i in range(len(voc.scores)) if np.isfinite(voc.scores[i])}
    heads = [i for i in range(len(text)) if text[i] & 0xC0 != 0x80] + [len(text)]
    best = {0: (0.0, [])}
    for at, i in enumerate(heads[:-1]):
        for j in heads[at + 1:]:
            word = text[i:j]
            if word in known:
                gain, ids = voc.scores[known[word]], [known[word]]
            elif j == heads[at + 1]:
                gain, ids = voc.unknown, [int(voc.byte_ids[b]) for b in word]
            else:
                continue
            if j not in best or best[i][0] + gain > best[j][0]:
                best[j] = (best[i][0] + gain, best[i][1] + ids)
    return best[len(text)][1] if text else []


CASES = ["", " ", "  two  spaces ", "line\nline\n\n\ttab\r\n", "▁marker▁", "naïve café", "日本語テキスト", "😀 emoji 👩‍👩‍👧", "\x00\x01 ctl", "\xa0nbsp",
         "http://a.b/c?d=e", "x" * 300, "the " * 40]


def test_best_path_equals_brute_force_and_round_trips(voc):
    r = random.Random(0)
    texts = CASES + ["".join(r.choice("ab théñ▁\n  \t😀xingtion") for _ in range(r.randint(0, 40))) for _ in range(150)]
    data = [t.encode() for t in texts]
    ids, counts = P.Encoder(voc)(data)
    ends = np.cumsum(counts)
    for k, t in enumerate(data):
        assert ids[ends[k] - counts[k]:ends[k]].tolist() == (brute(voc, b" " + t) if t else [])
    assert P.decode(voc, ids, counts) == data


def test_forgetting_does_not_change_ids(voc):
    data = [c.encode() for c in CASES * 3]
    small, large = P.Encoder(voc, remembered=5), P.Encoder(voc)
    for at in range(0, len(data), 4):
        assert all((a == b).all() for a, b in zip(small(data[at:at + 4]), large(data[at:at + 4])))


def test_double_array_holds_exactly_the_words():
    words = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "ba", "é", "zz"])}
    base, check, ends = P.double_array(words)

    def find(word):
        s = 0
        for b in word:
            t = base[s] + b
            if check[t] != s:
                return None
            s = t
        return int(ends[s]) if ends[s] >= 0 else None

    assert all(find(w) == i for w, i in words.items())
    assert [find(w) for w in (b"", b"z", b"abcd", b"c", "é".encode()[:1])] == [None] * 5


def test_table(spark):
    rows = [(1, t) for t in CASES] + [(None, None), (2, "long " * 60_000)]
    df = spark.createDataFrame([(*x, [1]) for x in rows], "doc_id long, text string, ids array<int>")
    out = P.encode(df)
    got = out.collect()
    assert len(got) == len(rows) and all(r.round_trip and r.n_ids == len(r.ids) for r in got)
    back = sorted(r.text for r in P.decode_table(out).collect())
    assert back == sorted(t or "" for _, t in rows)
    byte_ids = set(P.load().byte_ids.tolist())
    assert all(r.n_byte_ids == sum(i in byte_ids for i in r.ids) for r in got)
    assert P.encode(df.limit(0)).count() == 0
