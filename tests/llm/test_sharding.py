import zlib

import numpy as np

from textgate.llm.sharding import MULTIPLIER, jump_hash, shard_manifest, write_shards
from textgate.session import scratch_path


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_definition_and_moves_only_to_the_new_shard():
    keys = np.random.default_rng(0).integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    before = None
    for n in (1, 2, 3, 16, 17, 18):
        got = jump_hash(keys, n)
        assert got[:300].tolist() == [plain_jump(int(k), n) for k in keys[:300]]
        assert got.max() < n and np.bincount(got, minlength=n).min() > 0.7 * len(keys) / n
        if n in (17, 18):
            moved = got != before
            assert (got[moved] == n - 1).all() and abs(moved.mean() - 1 / n) < 0.03
        before = got


def test_manifest(spark):
    rows = [(i, "text é %d" % i) for i in range(400)] + [(None, "a"), (None, None), (7, "other"), (7, "other"), (900, ""), (901, "w " * 90_000)]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, shard int, slot int")
    got = shard_manifest(df, 16).collect()
    sizes = sorted((repr(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32) for r in got) == sizes
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(16))
    assert len({r.shard for r in got if r.doc_id == 7}) == len({r.shard for r in got if r.doc_id is None}) == 1
    again = shard_manifest(df.repartition(3), 16).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert shard_manifest(df.limit(0), 16).count() == 0


def test_one_id_for_many_rows_and_files(spark):
    df = spark.createDataFrame([(1, "same")] * 300 + [(2, "b")], "doc_id long, text string")
    got = [r for r in shard_manifest(df, 4).collect() if r.doc_id == 1]
    assert len({r.slot for r in got}) == 300
    path = scratch_path(spark, "shards")
    write_shards(df, path, 4)
    assert {(r.doc_id, r.shard) for r in spark.read.parquet(path).select("doc_id", "shard").distinct().collect()} \
        == {(r.doc_id, r.shard) for r in shard_manifest(df, 4).collect()}
