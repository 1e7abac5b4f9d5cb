import hashlib
import random
import zlib

import duckdb
import pytest

from conftest import SF01
from textgate.llm.conversation_trie import OP13_SQL, conversation_trie, op13, prefix_trie, rebuilt, turns_of

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, owner string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)


def sequences(rows):
    """{conv: [(role, text), ...]}, turns null first; the given rows have no ties but equal ones."""
    out = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            out.setdefault(c, []).append((role or "", text or ""))
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        ends = sorted(c for c in members if len(convs[c]) == len(key))
        out.add((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members),
                 sum(len(k) == len(key) + 1 for k in below),
                 sum(not any(len(q) == len(k) + 1 and q[:len(k)] == k for q in below) for k in below),
                 sum((len(nodes[k]) - 1) * len(k[-1][1].split()) for k in below if k),
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def plain_rebuild(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def rows_of(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def made(seed, convs, longest, words=4):
    rnd, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rnd.randint(1, longest)):
            rows.append((c, t, rnd.choice(["user", "assistant"]), " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 1 + (t > 2) * words)))))
    return rows


@pytest.mark.parametrize("height", [2, 3, 16])
def test_against_brute_force_at_several_heights(spark, height):
    rows = made(height, 60, 12)
    assert rows_of(conversation_trie(table(spark, rows), height=height)) == brute(sequences(rows))


def test_rebuilt_conversations(spark):
    rows = [r for r in made(5, 90, 6) if r[0] != 40]  # the family of 40 has no first conversation
    turns = turns_of(table(spark, rows))
    assert rows_of(prefix_trie(*rebuilt(turns))) == brute(plain_rebuild(sequences(rows)))


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr("textgate.llm.conversation_trie.CHUNK", 7)
    rows = [(c, t, "user", "same" if t < 90 - c else f"own {c}") for c in (1, 2, 30) for t in range(100)]
    rows += [(4, t, "user", "same") for t in range(40)]
    assert rows_of(conversation_trie(table(spark, rows), height=4)) == brute(sequences(rows))


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x y"), (2, 0, "", ""), (2, 1, "user", "x y"), (3, 5, "user", "x y"),
            (4, 1, "user", "x y"), (4, 1, "user", "x y"), (5, 0, "u", "ser"), (6, 0, "us", "er"), (None, 0, "user", "lost"),
            (7, 0, "user", "w " * 60_000), (-20, 0, "user", "x y"), (-3, 0, "user", "  x\x0b\ty")]
    convs = sequences(rows)
    words = {w for t in convs.values() for _, w in t}
    assert all(len(w.split(None)) or True for w in words)
    convs[-3] = [("user", "  x\x0b\ty")]
    got = {r[:6] + r[7:] for r in rows_of(conversation_trie(table(spark, rows)))}
    assert got == {r[:6] + r[7:] for r in brute(convs)}
    turns = turns_of(table(spark, rows))
    # Spark and SQL keep the sign of a remainder: conversation -3's family is that of -0
    want = {c: (convs.get(c - int(abs(c) % 20) * (1 if c > 0 else -1), [])[:zlib.crc32(str(c).encode()) % 4]
                + t[zlib.crc32(str(c).encode()) % 4:]) for c, t in convs.items()}
    got = {r[:6] + r[7:] for r in rows_of(prefix_trie(*rebuilt(turns)))}
    assert got == {r[:6] + r[7:] for r in brute(want)}


def test_empty_table_and_bad_height(spark):
    assert conversation_trie(table(spark, [])).count() == 0
    assert conversation_trie(table(spark, [(None, 1, "user", "x")])).count() == 0
    with pytest.raises(ValueError):
        conversation_trie(table(spark, [(1, 1, "user", "x")]), height=1)


def test_many_ids_at_one_node(spark):
    rows = [(c, 0, "user", "hello there") for c in range(25_000)]
    got = sorted(rows_of(conversation_trie(table(spark, rows).repartition(6))), key=lambda r: r[1])
    ids = hashlib.sha256(",".join(map(str, range(25_000))).encode()).hexdigest()
    assert got == [(0, 0, None, 25_000, 1, 1, 24_999 * 2, hashlib.sha256(b"").hexdigest()),
                   (0, 1, 0, 25_000, 0, 1, 24_999 * 2, ids)]


def test_query_at_another_size(spark):
    df = op13(spark, SF01)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF01}/conversations.parquet')")
    res = con.sql(OP13_SQL)
    assert res.columns == df.columns
    assert rows_of(df) == set(res.fetchall())
