import hashlib
import re

import pytest
from pyspark.sql import functions as F

from textgate.llm.exact_dedup import DigestIndex, buckets_for, exact_dedup, keep_first
from textgate.session import scratch_path

ROWS = [(1, "a  b"), (2, "a\tb"), (3, None), (4, ""), (5, "a b c"), (5, "a b c"), (None, "x"), (None, "x"), (7, "x"),
        (8, " a b"), (9, "é b"), (10, "é b"), (11, "word " * 50_000), (12, "word\n" * 50_000)]


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for i, (k, _) in enumerate(rows):
        same = [j for j in range(len(rows)) if norm[j] == norm[i]]
        ids = [rows[j][0] for j in same if rows[j][0] is not None]
        keep = min(ids) if ids else None
        first = k == keep and not any(rows[j][0] == k for j in same if j < i)
        out.append((k, keep, len(same), first, hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force_on_edge_rows(spark):
    df = spark.createDataFrame([(i, t, "z", b"q") for i, t in ROWS], "doc_id long, text string, digest string, keep_id binary")
    got = exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)
    kept = sorted(((r.doc_id, r.text) for r in keep_first(df).collect()), key=repr)
    assert kept == sorted({(k, t) for k, t in [(1, "a  b"), (3, None), (5, "a b c"), (7, "x"), (8, " a b"), (9, "é b"),
                                               (10, "é b"), (11, "word " * 50_000)]}, key=repr)
    assert keep_first(df).columns == df.columns


def test_index_persists_and_reruns_agree(spark):
    path = scratch_path(spark, "index")
    first = spark.createDataFrame([(5, "a"), (6, "b"), (7, "a")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in DigestIndex(spark, path, 16).add(first, "one").collect()} \
        == {(5, 5, True), (7, 5, False), (6, 6, True)}
    want = {(1, 5, 1, False), (2, 2, 2, True), (3, 2, 2, False)}  # a row of an earlier batch stays
    for _ in range(2):  # another session's index on the same files; a batch that is added again
        got = DigestIndex(spark, path, 16).add(second, "two").collect()
        assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == want
    assert spark.read.parquet(path).count() == 3


def test_plan_joins_the_index_without_shuffling_it(spark, capsys):
    index = DigestIndex(spark, scratch_path(spark, "index"), 16)
    index.add(spark.createDataFrame([(5, "a")], "doc_id long, text string"), "one")
    new = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("d")).repartition(16, "d")
    old = spark.table(index.table).select(F.hex("digest").alias("h"), "digest")
    plan = new.select(F.unhex("d").alias("digest")).repartition(16, "digest").hint("merge").join(old, "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(digest") == 1 and "Bucketed: true" in text or "SelectedBucketsCount" in text


def test_empty_and_bucket_count(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert keep_first(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [buckets_for(n) for n in (0, 1, 32_000_000, 32_000_001, 10**9)] == [16, 16, 16, 32, 512]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_other_id_types(spark, kind):
    df = spark.createDataFrame([("3", "a"), ("2", "a")], "id string, body string").withColumn("id", F.col("id").cast(kind))
    assert {str(r.keep_id) for r in exact_dedup(df, "id", "body").collect()} == {"2"}


def test_keep_first_keeps_every_column(spark):
    from textgate.llm.exact_dedup import keep_first

    df = spark.createDataFrame([(1, "a", 7, "x", "k"), (1, "a", 7, "x", "k"), (2, "b", 8, "y", "l"), (3, "a", 9, "z", "m")],
                               "doc_id long, text string, _d int, _digest string, _keep_id string")
    got = keep_first(df)
    assert got.columns == df.columns and sorted(tuple(r) for r in got.collect()) == [(1, "a", 7, "x", "k"), (2, "b", 8, "y", "l")]
