import random
import time

import pytest

from textgate.operators.clean import end_sessions
from textgate.session import scratch_path
from textgate.streaming.sessions import stream_sessions

SCHEMA = "conv_id long, turn long, role string, text string"


def made(seed, convs=25, longest=12):
    rnd, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rnd.randint(1, longest)):
            text = rnd.choice([f" ask {c} {t} ", f"q{t}", "  ", None, " Salir\t" if rnd.random() < 0.4 else "x", "QUIT" if rnd.random() < 0.3 else "y"])
            rows.append((c, t, rnd.choice(["user", "user", "assistant"]), text))
    return rows


def plain(rows):
    out = []
    for c in {r[0] for r in rows}:
        for _, t, role, text in sorted(r for r in rows if r[0] == c):
            said = (text or "").strip()
            if role == "user" and said.lower() in ("salir", "exit", "quit"):
                break
            if role == "user" and said:
                out.append((c, t, said))
    return sorted(out)


def streamed(spark, files, **options):
    """The rows, with a trigger for each file in the order given."""
    source, sink, ckpt = (scratch_path(spark, f"t-sessions-{x}") for x in ("in", "out", "ckpt"))
    got = None
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream_sessions(spark, source, SCHEMA, sink, ckpt, max_files_per_trigger=1, **options).awaitTermination()
        got = sorted(tuple(r) for r in spark.read.schema("conv_id long, turn long, text string").parquet(sink).collect())
        yield got


def test_batch_form(spark):
    rows = made(1)
    df = spark.createDataFrame([r for r in rows if r[2] == "user"], SCHEMA)
    got = sorted((r.conv_id, r.turn, r.text) for r in end_sessions(df).collect())
    assert got == plain(rows) and end_sessions(df).columns == df.columns
    loose = [(None, 0, "user", "kept"), (None, 1, "user", "exit"), (None, 2, "user", "kept too"), (1, None, "user", "no turn"), (1, None, "user", "quit"),
             (2, 3, "user", "exit"), (2, 3, "user", "same turn"), (2, 4, "user", "late"), (2, 1, "user", "early"), (2, 1, "user", "early")]
    df = spark.createDataFrame(loose, SCHEMA)
    assert sorted((r.conv_id or 0, r.turn, r.text) for r in end_sessions(df).collect() if r.turn is not None) == [
        (0, 0, "kept"), (0, 2, "kept too"), (2, 1, "early"), (2, 1, "early")]
    assert [r.text for r in end_sessions(df).collect() if r.turn is None] == ["no turn"]
    assert end_sessions(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [2, 3])
def test_stream_equals_batch_whatever_the_order(spark, seed):
    rows = made(seed)
    mixed = rows[:]
    random.Random(seed).shuffle(mixed)
    thirds = [mixed[0::3], mixed[1::3], [*mixed[2::3], *mixed[:5]]]  # a few come twice
    seen = list(streamed(spark, thirds))
    assert seen[-1] == plain(rows)
    assert all(set(a) <= set(b) for a, b in zip(seen, seen[1:]))


def test_a_question_waits_for_the_turns_before_it(spark):
    files = [[(1, 2, "user", "third"), (2, 0, "user", "only"), (3, None, "user", "exit")], [(1, 1, "user", "exit")],
             [(1, 0, "user", "first"), (1, 3, "user", "late")], [(1, 4, "user", "after the end"), (3, None, "user", "loose")]]
    got = [[r for r in rows if r[1] is not None] for rows in streamed(spark, files)]
    assert got == [[(2, 0, "only")], [(2, 0, "only")], [(1, 0, "first"), (2, 0, "only")], [(1, 0, "first"), (2, 0, "only")]]


def test_a_missing_turn_is_given_up_after_the_wait(spark):
    source, sink, ckpt = (scratch_path(spark, f"t-sessions-{x}") for x in ("in", "out", "ckpt"))
    with pytest.raises(ValueError):
        stream_sessions(spark, source, SCHEMA, sink, ckpt, wait=1)
    spark.createDataFrame([(1, 0, "user", "a"), (1, 2, "user", "c"), (1, 3, "user", "d")], SCHEMA).coalesce(1).write.parquet(source)
    query = stream_sessions(spark, source, SCHEMA, sink, ckpt, once=False, wait=1000)
    try:
        end, got = time.time() + 60, []
        while time.time() < end and len(got) < 3:
            time.sleep(1)
            if query.lastProgress:
                got = sorted(tuple(r) for r in spark.read.schema("conv_id long, turn long, text string").parquet(sink).collect())
    finally:
        query.stop()
    assert got == [(1, 0, "a"), (1, 2, "c"), (1, 3, "d")]
