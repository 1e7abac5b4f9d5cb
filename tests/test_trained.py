import random

import pytest

from textgate.plans import queries as Q
from textgate.sources import manifest as MF


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("trained"))
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(("agua", "luz", "calle", "plaza") if i % 2 else ("lorem", "ipsum", "dolor")) for _ in range(9)), "en", "web", 50)
            for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_model_is_trained_once(spark, tables):
    first = Q.trained(spark, tables)
    assert Q.trained(spark, tables) is first


def test_export_counts_while_both_parts_are_published(spark, tmp_path):
    for part, whole in (("splits", False), ("model", True)):
        assert not Q._exported(spark, str(tmp_path))
        MF.publish(spark, f"{tmp_path}/{part}", "v", {})
        assert Q._exported(spark, str(tmp_path)) == whole


def test_load_model_outlives_a_cleared_checkpoint_folder(spark, tables, tmp_path):
    """What an earlier query of the session has exported may be gone."""
    res, root = Q.trained(spark, tables)
    Q._TRAINED[(spark.sparkContext.applicationId, tables)] = (res, str(tmp_path))
    got = Q.q_load_model(spark, tables).collect()
    assert sorted(r.doc_id for r in got) == list(range(60)) and all(r.same_as_in_memory for r in got)
    assert sorted((r.id, r.label) for r in Q.q_save_model(spark, tables).collect()) == [(0, "no_valida"), (1, "valida")]
    assert sum(r.n for r in Q.q_train_gate(spark, tables).collect()) == 40
    again, elsewhere = Q.trained(spark, tables)
    assert elsewhere not in (root, str(tmp_path)) and (again.model.weights == res.model.weights).all()
