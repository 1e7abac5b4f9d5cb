"""Property tests: Spark expressions against Python's own string semantics, split invariants."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from textgate.functions import text as X
from textgate.operators import split as SP

WS = [c for c in map(chr, range(0x3001)) if c.isspace()]
TEXTS = st.lists(st.text(alphabet=st.sampled_from(WS + list("aZé¿?ñ;\"\\")), max_size=12), min_size=1, max_size=30)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(texts=TEXTS)
def test_text_functions_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", X.strip("t").alias("s"), X.strip_collapse("t").alias("n"), X.is_blank("t").alias("b"),
                     X.tokens("t", None).alias("k")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.s == t.strip()
        assert r.n == re.sub(r"\s+", " ", t.strip())
        assert r.b == (t.strip() == "")
        assert r.k == t.lower().split()


@SETTINGS
@given(counts=st.lists(st.integers(min_value=1, max_value=60), min_size=1, max_size=4),
       weights=st.sampled_from([SP.DEFAULT_FRACTIONS, SP.TRAIN_TEST_FRACTIONS]))
def test_split_invariants(spark, counts, weights):
    rows, i = [], 0
    for c, n in enumerate(counts):
        for _ in range(n):
            rows.append((i, f"c{c}"))
            i += 1
    df = spark.createDataFrame(rows, "doc_id bigint, label string")
    got = SP.stratified_split(df, "doc_id", fractions=weights).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    quotas = SP.split_quotas({f"c{c}": n for c, n in enumerate(counts)}, [w for _, w in weights])
    names = [n for n, _ in weights]
    for lbl, q in quotas.items():
        mine = [r.split for r in got if r.label == lbl]
        deeper = [sum(1 for s in mine if s in names[j + 1:]) for j in range(len(names) - 1)]
        assert deeper == q


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=40))
def test_report_matches_sklearn_semantics(spark, pairs):
    import math

    from test_metrics import sk_report

    from textgate.operators import metrics as M

    truth, pred = [p[0] for p in pairs], [p[1] for p in pairs]
    df = spark.createDataFrame(pairs, "label int, pred int")
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support)
           for r in M.classification_report(df, "label", "pred").collect()}
    exp = sk_report(truth, pred)
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[k], v)), (k, got[k], v)
