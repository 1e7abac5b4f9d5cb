"""Registered queries of the training-data operators: against DuckDB where SQL can express them."""

import math

import duckdb
import pytest

from conftest import SF001
from textgate.llm.registry import ORACLE, QUERIES
from textgate.plans.fixtures import TABLES

COLUMNS = {
    "op1_gated_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op2_jump_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op5_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op8_cover_tree": ["vec_id", "n_links", "component_id", "kept"],
    "op9_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op10_simhash": ["doc_id", "fingerprint", "component_id"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12_order_minhash": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op13_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    value = lambda v: (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    assert df.columns[:len(COLUMNS.get(name, []))] == COLUMNS.get(name, [])
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    if name in ORACLE:
        res = con.sql(ORACLE[name])
        assert canon(df.columns, rows) == canon(res.columns, res.fetchall())
    elif name == "op11_whitening":
        assert len(rows) == 32 * con.sql("SELECT count(*) FROM embeddings").fetchall()[0][0]
    elif name != "op3_secret_scan":  # which has a row per candidate
        assert len(rows) == con.sql("SELECT count(*) FROM documents").fetchall()[0][0]
