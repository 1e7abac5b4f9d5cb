"""DuckDB SQL for every query with a full oracle: the same rows from the driver's tables.

Conventions shared with ``queries.py``: the same fixture views (``fixtures.*_SQL``), Python
whitespace as ``\\s`` (the tables hold no Unicode-only whitespace), doubles rounded to 6
digits, integer results cast to the Spark type (INTEGER for ids and sizes, BIGINT for counts).
"""

from __future__ import annotations

from textgate.operators.split import DEFAULT_FRACTIONS, DEFAULT_SEED, TRAIN_TEST_FRACTIONS
from textgate.plans.fixtures import ASKS_SQL, DIRTY_SQL, LABELLED_SQL, SCORED_SQL, folded_sql

ORACLE: dict[str, str] = {}


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def COLLAPSE(x: str) -> str:
    return f"regexp_replace({x}, '\\s+', ' ', 'g')"


def NORM(x: str) -> str:
    return f"trim({COLLAPSE(x)})"


def TOK(x: str) -> str:
    return f"list_filter(string_split(lower({NORM(x)}), ' '), lambda w: w <> '')"


def ARGMAX(a: str) -> str:
    return f"CAST(list_position({a}, list_max({a})) - 1 AS INTEGER)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CLEAN_OF = lambda src, name: f"""{name} AS (
  SELECT doc_id, {NORM("coalesce(text, '')")} AS text,
         lower({STRIP("coalesce(label, '')")}) AS label,
         lower({STRIP("coalesce(subtype, 'sin_subtipo')")}) AS subtype
  FROM {src})"""

CLEAN = DIRTY_SQL + ",\n" + CLEAN_OF("dirty", "clean")

GAPPY = LABELLED_SQL + """,
gappy AS (
  SELECT doc_id,
         CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ' ' || chr(9) || ' ' ELSE text END AS text,
         CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN 'Otra' ELSE label END AS label,
         subtype
  FROM labelled),
""" + CLEAN_OF("gappy", "gclean")

EDGY = ASKS_SQL + """,
edgy AS (
  SELECT conv_id, turn,
         CASE WHEN (conv_id + turn) % 7 = 0 THEN '   ' WHEN (conv_id + turn) % 7 = 1 THEN ' Salir '
              WHEN (conv_id + turn) % 7 = 2 THEN 'EXIT' ELSE text END AS text
  FROM asks)"""

PRED = SCORED_SQL + f""",
pred AS (SELECT vec_id, logits, label, {ARGMAX("logits")} AS predicted_id FROM scored)"""

PROBS = SCORED_SQL + """,
sm AS (SELECT vec_id, label, list_transform(logits, lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(logits) AS DOUBLE))) AS e
       FROM scored),
probs AS (SELECT vec_id, label, list_transform(e, lambda x: x / list_sum(e)) AS p FROM sm)"""


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ---------------------------------------------------------------- 2.3 projections

oracle("fill_text_label", with_(DIRTY_SQL) + f"""
SELECT doc_id, {STRIP("coalesce(text, '')")} AS text, {STRIP("coalesce(label, '')")} AS label FROM dirty""")

oracle("default_subtype", with_(DIRTY_SQL) + f"""
SELECT doc_id, {STRIP("coalesce(subtype, 'sin_subtipo')")} AS subtype FROM dirty""")

oracle("normalise", with_(DIRTY_SQL) + f"""
SELECT doc_id, {NORM("text")} AS text, lower({STRIP("label")}) AS label, lower({STRIP("subtype")}) AS subtype
FROM dirty""")

oracle("select_core", with_(CLEAN) + "SELECT doc_id, text, label, subtype FROM clean")

LABEL_MAP = """lmap AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS id
         FROM (SELECT DISTINCT label FROM clean WHERE label IS NOT NULL))"""

oracle("training_view", with_(CLEAN, LABEL_MAP) + """
SELECT c.doc_id, c.text, m.id AS labels FROM clean c LEFT JOIN lmap m ON c.label = m.label""")


def PADDED(t: str, n: str) -> str:
    return f"list_concat({t}, list_transform(range(greatest({n} - len({t}), 0)), lambda i: '<pad>'))"


oracle("model_columns", with_(CLEAN, LABEL_MAP, f"tok AS (SELECT doc_id, label, {TOK('text')}[1:128] AS t FROM clean)") + f"""
SELECT k.doc_id, array_to_string({PADDED('k.t', '128')}, ' ') AS input_ids, CAST(128 AS INTEGER) AS n_ids,
       CAST(len(k.t) AS INTEGER) AS mask_sum, m.id AS labels
FROM tok k LEFT JOIN lmap m ON k.label = m.label""")

# ---------------------------------------------------------------- 2.4 filters and checks

oracle("blank_rows", with_(GAPPY) + f"""
SELECT doc_id, {STRIP("coalesce(text, '')")} AS text, {STRIP("coalesce(label, '')")} AS label FROM gappy
WHERE {STRIP("coalesce(text, '')")} = '' OR {STRIP("coalesce(label, '')")} = ''""")

ALLOWED = "('valida', 'no_valida')"

oracle("unexpected_labels", with_(GAPPY) + f"""
SELECT DISTINCT label FROM gclean WHERE label IS NULL OR label NOT IN {ALLOWED}""")

oracle("quality_summary", with_(GAPPY) + f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count_if(coalesce({STRIP('text')}, '') = '' OR coalesce({STRIP('label')}, '') = '') AS BIGINT) AS n_blank,
       CAST(count_if(label IS NULL OR label NOT IN {ALLOWED}) AS BIGINT) AS n_bad_label_rows,
       CAST(count(DISTINCT CASE WHEN label IS NULL OR label NOT IN {ALLOWED} THEN coalesce(label, chr(0) || 'null') END)
            AS BIGINT) AS n_bad_labels
FROM gclean""")

oracle("drop_blank_asks", with_(EDGY) + f"""
SELECT conv_id, turn, {STRIP('text')} AS text FROM edgy WHERE coalesce({STRIP('text')}, '') <> ''""")

oracle("drop_control_words", with_(EDGY) + f"""
SELECT conv_id, turn, {STRIP('text')} AS text FROM edgy
WHERE coalesce({STRIP('text')}, '') <> '' AND lower({STRIP('text')}) NOT IN ('salir', 'exit', 'quit')""")

oracle("end_sessions", with_(EDGY, f"""ends AS (
  SELECT conv_id, min(turn) AS last FROM edgy WHERE lower({STRIP('text')}) IN ('salir', 'exit', 'quit') GROUP BY conv_id)""") + f"""
SELECT e.conv_id, e.turn, {STRIP('e.text')} AS text FROM edgy e LEFT JOIN ends USING (conv_id)
WHERE coalesce({STRIP('e.text')}, '') <> '' AND (last IS NULL OR turn < last)""")

# ---------------------------------------------------------------- 2.5 joins

oracle("encode_labels", with_(GAPPY) + """
SELECT doc_id, label, CAST(CASE label WHEN 'no_valida' THEN 0 WHEN 'valida' THEN 1 END AS INTEGER) AS labels
FROM gclean""")

oracle("decode_labels", with_(PRED, """smap AS (
  SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS id
  FROM (SELECT DISTINCT CAST(label AS VARCHAR) AS label FROM scored))""") + """
SELECT p.vec_id, p.predicted_id, m.label AS predicted_label FROM pred p JOIN smap m ON p.predicted_id = m.id""")

oracle("attach_predictions", with_(PRED) + """
SELECT vec_id, label, CAST(predicted_id AS VARCHAR) AS predicted_label FROM pred""")

# ---------------------------------------------------------------- 2.6 aggregations

oracle("distinct_labels", with_(CLEAN) + "SELECT DISTINCT label FROM clean")

oracle("strata_counts", with_(CLEAN) + "SELECT label, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY label")

oracle("accuracy", with_(PRED) + """
SELECT round(avg(CASE WHEN label IS NOT DISTINCT FROM predicted_id THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
FROM pred""")


def CLASS_STATS(by: str = "") -> str:
    """conf → per-class tp / support / predicted and precision, recall, F1 (``by`` = 'split, ' or '')."""
    return f"""conf AS (SELECT {by}label AS truth, predicted_id AS predicted, count(*) AS n FROM pred GROUP BY ALL),
cls AS (SELECT {by}class, sum(tp) AS tp, sum(support) AS support, sum(npred) AS npred FROM (
          SELECT {by}truth AS class, CASE WHEN truth IS NOT DISTINCT FROM predicted THEN n ELSE 0 END AS tp,
                 n AS support, 0 AS npred FROM conf
          UNION ALL
          SELECT {by}predicted AS class, 0 AS tp, 0 AS support, n AS npred FROM conf) GROUP BY ALL),
prf AS (SELECT *,
          CASE WHEN npred <> 0 THEN CAST(tp AS DOUBLE) / CAST(npred AS DOUBLE) ELSE 0.0 END AS precision,
          CASE WHEN support <> 0 THEN CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) ELSE 0.0 END AS recall,
          CASE WHEN support + npred <> 0 THEN CAST(2 * tp AS DOUBLE) / CAST(support + npred AS DOUBLE) ELSE 0.0 END
            AS f1_score
        FROM cls)"""


oracle("f1_macro", with_(PRED, CLASS_STATS()) + "SELECT round(avg(f1_score), 6) AS f1_macro FROM prf")

oracle("evaluate", with_(PRED, CLASS_STATS()) + """
SELECT round(CASE WHEN sum(support) <> 0 THEN CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) ELSE 0.0 END, 6)
         AS accuracy,
       round(avg(f1_score), 6) AS f1_macro
FROM prf""")

# ---------------------------------------------------------------- 2.7 scalars

oracle("strip", with_(DIRTY_SQL) + f"SELECT doc_id, {STRIP('text')} AS text, {STRIP('subtype')} AS subtype FROM dirty")
oracle("collapse_ws", with_(DIRTY_SQL) + f"SELECT doc_id, {COLLAPSE('text')} AS text FROM dirty")
oracle("lowercase", with_(DIRTY_SQL) + "SELECT doc_id, lower(label) AS label, lower(subtype) AS subtype FROM dirty")
oracle("to_string", "SELECT doc_id, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic FROM labels")
oracle("argmax_class", with_(PRED) + "SELECT vec_id, predicted_id FROM pred")

oracle("softmax", with_(PROBS) + """
SELECT vec_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS class_id, round(unnest(p), 6) AS probability
FROM probs""")

oracle("confidence", with_(PROBS) + "SELECT vec_id, round(list_max(p), 6) AS confidence FROM probs")

oracle("probability_map", with_(PROBS) + """
SELECT vec_id, CAST(generate_subscripts(p, 1) - 1 AS VARCHAR) AS class_label, round(unnest(p), 6) AS probability
FROM probs""")

# ---------------------------------------------------------------- 2.8 ranking, sort, limit

oracle("build_label_map", with_(CLEAN, LABEL_MAP) + "SELECT label, id FROM lmap")


def split_sql(fractions, seed: int = DEFAULT_SEED) -> str:
    """The split rule with a plain per-label row_number (the specification, not the scalable plan)."""
    names = [n for n, _ in fractions]
    weights = [int(w) for _, w in fractions]
    ctes = [f"""base AS (SELECT doc_id, label, md5(concat('{seed}', ':', CAST(doc_id AS VARCHAR))) AS h FROM clean)""",
            "q_in AS (SELECT label, count(*) AS q FROM base GROUP BY label)"]
    prev = "q_in"
    for j in range(len(weights) - 1):
        w_all, rest_w = sum(weights[j:]), sum(weights[j:]) - weights[j]
        ctes.append(f"""l{j}a AS (SELECT label, q, sum(q) OVER () AS p FROM {prev})""")
        ctes.append(f"""l{j}b AS (SELECT *, (p * {rest_w} + {w_all - 1}) // {w_all} AS r FROM l{j}a)""")
        ctes.append(f"""l{j}c AS (SELECT *, CASE WHEN p = 0 THEN 0 ELSE (r * q) // p END AS b,
                    CASE WHEN p = 0 THEN 0 ELSE (r * q) % p END AS m FROM l{j}b)""")
        ctes.append(f"""l{j}d AS (SELECT *, r - sum(b) OVER () AS lft,
                    row_number() OVER (ORDER BY m DESC, label) AS rk FROM l{j}c)""")
        ctes.append(f"""q{j} AS (SELECT label, b + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS q FROM l{j}d)""")
        prev = f"q{j}"
    joins = " ".join(f"JOIN q{j} ON r.label = q{j}.label" for j in range(len(weights) - 1))
    case = " ".join(f"WHEN r.rn <= q{j}.q THEN '{names[j + 1]}'" for j in reversed(range(len(weights) - 1)))
    ctes.append("ranked AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS rn FROM base)")
    return with_(CLEAN, *ctes) + f"""
SELECT r.doc_id, r.label, CASE {case} ELSE '{names[0]}' END AS split FROM ranked r {joins}"""


oracle("stratified_split", split_sql(DEFAULT_FRACTIONS))
oracle("train_test_split", split_sql(TRAIN_TEST_FRACTIONS))

oracle("preview_rows", with_(GAPPY) + """
SELECT doc_id, text, label FROM gclean WHERE text = '' OR label = '' ORDER BY doc_id LIMIT 5""")

oracle("best_candidates", with_(
    SCORED_SQL.replace("scored AS", "scored0 AS"),
    "scored AS (SELECT vec_id, logits, label, CAST(vec_id % 4 + 1 AS INTEGER) AS epoch FROM scored0)",
    f"pred AS (SELECT vec_id, logits, label, epoch, {ARGMAX('logits')} AS predicted_id FROM scored)",
    CLASS_STATS("epoch, ")) + """,
hist AS (SELECT epoch,
           CASE WHEN sum(support) <> 0 THEN CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) ELSE 0.0 END AS accuracy,
           avg(f1_score) AS f1_macro
         FROM prf GROUP BY epoch)
SELECT epoch, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro FROM hist
ORDER BY f1_macro DESC, epoch LIMIT 2""")

# ---------------------------------------------------------------- 2.11 evaluation family

oracle("confusion_counts", with_(PRED) + """
SELECT label AS truth, predicted_id AS predicted, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY ALL""")


def MATRIX(row_prefix: str = "", col_prefix: str = "") -> str:
    cols = ",\n       ".join(
        f"CAST(coalesce(sum(CASE WHEN c.predicted = {i} THEN c.n END), 0) AS BIGINT) AS \"{col_prefix}{i}\""
        for i in range(10))
    return with_(PRED, "conf AS (SELECT label AS truth, predicted_id AS predicted, count(*) AS n FROM pred GROUP BY ALL)") + f"""
SELECT CAST(d.l AS INTEGER) AS row_order, '{row_prefix}' || CAST(d.l AS VARCHAR) AS label,
       {cols}
FROM range(0, 10) d(l) LEFT JOIN conf c ON c.truth = d.l AND c.predicted BETWEEN 0 AND 9
GROUP BY d.l"""


oracle("confusion_matrix", MATRIX())
oracle("confusion_matrix_prefixed", MATRIX("real_", "pred_"))


def REPORT(by: str = "") -> str:
    part = f"PARTITION BY {by.rstrip(', ')} " if by else ""
    grp = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f""",
rows AS (SELECT {by}CAST(row_number() OVER ({part}ORDER BY class) - 1 AS INTEGER) AS row_order,
                CAST(class AS VARCHAR) AS class, precision, recall, f1_score, CAST(support AS DOUBLE) AS support
         FROM prf),
summ AS (SELECT {by}count(*) AS k, sum(tp) AS tp, sum(support) AS sup,
                avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
                sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1_score * support) AS wf
         FROM prf {grp}),
acc AS (SELECT {by}k, sup, CASE WHEN sup <> 0 THEN CAST(tp AS DOUBLE) / CAST(sup AS DOUBLE) ELSE 0.0 END AS a,
               mp, mr, mf,
               CASE WHEN sup <> 0 THEN wp / sup ELSE 0.0 END AS wp, CASE WHEN sup <> 0 THEN wr / sup ELSE 0.0 END AS wr,
               CASE WHEN sup <> 0 THEN wf / sup ELSE 0.0 END AS wf
        FROM summ),
allrows AS (
  SELECT {by}row_order, class, precision, recall, f1_score, support FROM rows
  UNION ALL SELECT {by}CAST(k AS INTEGER), 'accuracy', a, a, a, a FROM acc
  UNION ALL SELECT {by}CAST(k + 1 AS INTEGER), 'macro avg', mp, mr, mf, CAST(sup AS DOUBLE) FROM acc
  UNION ALL SELECT {by}CAST(k + 2 AS INTEGER), 'weighted avg', wp, wr, wf, CAST(sup AS DOUBLE) FROM acc)
SELECT {by}row_order, class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, round(support, 6) AS support
FROM allrows"""


oracle("classification_report", "WITH " + PRED + ",\n" + CLASS_STATS() + REPORT())

oracle("misclassified", with_(PRED) + """
SELECT vec_id, CAST(label AS VARCHAR) AS label, CAST(predicted_id AS VARCHAR) AS predicted_label FROM pred
WHERE CAST(label AS VARCHAR) IS DISTINCT FROM CAST(predicted_id AS VARCHAR)""")

oracle("evaluate_per_split", "WITH " + SCORED_SQL.replace("scored AS", "scored0 AS") + """,
scored AS (SELECT vec_id, logits, label, CASE WHEN vec_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM scored0),
pred AS (SELECT vec_id, logits, label, split, """ + ARGMAX("logits") + """ AS predicted_id FROM scored),
""" + CLASS_STATS("split, ") + REPORT("split, "))

# ---------------------------------------------------------------- 2.10 tokens and batch functions

oracle("tokenise", with_(CLEAN) + f"""
SELECT doc_id, array_to_string({TOK('text')}[1:128], ' ') AS tokens,
       CAST(len({TOK('text')}[1:128]) AS INTEGER) AS n_tokens, CAST(len({TOK('text')}) AS INTEGER) AS n_tokens_full
FROM clean""")

oracle("pad_tokens", with_(CLEAN, f"tok AS (SELECT doc_id, {TOK('text')}[1:128] AS t FROM clean)") + f"""
SELECT doc_id, array_to_string({PADDED('t', '128')}, ' ') AS input_ids, CAST(128 AS INTEGER) AS n_ids,
       CAST(len(t) AS INTEGER) AS mask_sum
FROM tok""")

oracle("pad_to_group_max", with_(
    CLEAN, f"tok AS (SELECT doc_id, CAST(floor(doc_id / 8) AS BIGINT) AS batch, {TOK('text')} AS t FROM clean)",
    "mx AS (SELECT *, max(len(t)) OVER (PARTITION BY batch) AS l FROM tok)") + f"""
SELECT doc_id, batch, CAST(l AS INTEGER) AS n_ids, CAST(len(t) AS INTEGER) AS mask_sum,
       array_to_string({PADDED('t', 'l')}, ' ') AS input_ids
FROM mx""")

oracle("assign_batches", with_(
    CLEAN, f"""tok AS (SELECT doc_id, {TOK('text')} AS t, (row_number() OVER (ORDER BY md5('42:' || doc_id)) - 1) // 8 AS batch FROM clean)""") + """
SELECT doc_id, batch, CAST(max(len(t)) OVER (PARTITION BY batch) AS INTEGER) AS n_ids, CAST(len(t) AS INTEGER) AS mask_sum FROM tok""")

oracle("score_with_inputs", with_(
    CLEAN, f"ids AS (SELECT doc_id, list_transform({TOK('text')}, lambda w: length(w)) AS i FROM clean)",
    "logits AS (SELECT doc_id, list_transform([2, 3, 5], lambda m: coalesce(list_sum(list_transform(i, lambda x: x % m)), 0) / greatest(len(i), 1)) AS l FROM ids)",
    "e AS (SELECT doc_id, l, list_transform(l, lambda x: exp(x - list_max(l))) AS e FROM logits)") + f"""
SELECT doc_id, {ARGMAX('l')} AS predicted_id, ['two', 'three', 'five'][{ARGMAX('l')} + 1] AS predicted_label,
       round(list_max(e) / list_sum(e), 6) AS confidence FROM e""")

oracle("map_batches", with_(CLEAN) + """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars,
       CAST(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END AS BIGINT) AS n_words
FROM clean""")

oracle("score_logits", with_(PROBS) + f"""
SELECT vec_id, {ARGMAX('p')} AS predicted_id, CAST({ARGMAX('p')} AS VARCHAR) AS predicted_label,
       round(list_max(p), 6) AS confidence
FROM probs""")

oracle("score_with_model", f"WITH lin AS (SELECT vec_id, {folded_sql(alternate=True)} AS logits FROM embeddings)," + """
sm AS (SELECT vec_id, list_transform(logits, lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(logits) AS DOUBLE))) AS e
       FROM lin),
probs AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM sm)
""" + f"""SELECT vec_id, {ARGMAX('p')} AS predicted_id, CAST({ARGMAX('p')} AS VARCHAR) AS predicted_label,
       round(list_max(p), 6) AS confidence
FROM probs""")

# ---------------------------------------------------------------- 2.1 / 2.2 round trips

oracle("read_labelled", with_(CLEAN) + "SELECT doc_id, text, label, subtype FROM clean")
oracle("read_labelled_auto", ORACLE["read_labelled"])
oracle("read_labelled_dialects", with_(DIRTY_SQL + """,
dialects AS (SELECT * REPLACE (' ' || chr(10) || '"; , ' || chr(9) || '|'' ' || chr(10) || text || chr(10) || ';''|' AS text) FROM dirty)""",
                                       CLEAN_OF("dialects", "clean")) + "SELECT doc_id, text, label, subtype FROM clean")
oracle("zip_as_placed", with_(CLEAN) + """
SELECT doc_id, label, row_number() OVER (ORDER BY doc_id) - 1 AS position, upper(label) AS predicted_label, CAST(length(text) AS INTEGER) AS n_chars
FROM clean""")
oracle("preview_file_order", with_(GAPPY) + """
SELECT doc_id, position FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM gclean)
WHERE text = '' OR label = '' ORDER BY position LIMIT 5""")
oracle("write_table", ORACLE["misclassified"])
oracle("read_splits", ORACLE["stratified_split"])
oracle("write_splits", split_sql(DEFAULT_FRACTIONS).replace(
    "SELECT r.doc_id, r.label, CASE", "SELECT r.doc_id, c.text, r.label, c.subtype, CASE").replace(
    "FROM ranked r JOIN", "FROM ranked r JOIN clean c ON r.doc_id = c.doc_id JOIN"))
oracle("write_metrics", ORACLE["evaluate"])
oracle("write_history", ORACLE["best_candidates"].replace("ORDER BY f1_macro DESC, epoch LIMIT 2", ""))
oracle("write_report", "SELECT class, precision, recall, f1_score, support FROM (" + ORACLE["classification_report"] + ")")
oracle("write_confusion", "SELECT * EXCLUDE (row_order) FROM (" + ORACLE["confusion_matrix"] + ")")
oracle("write_label_map", with_(CLEAN, LABEL_MAP) + "SELECT CAST(id AS VARCHAR) AS id, label FROM lmap")
oracle("read_label_map", ORACLE["build_label_map"])
oracle("save_model", ORACLE["build_label_map"])

# ---------------------------------------------------------------- 2.12 streaming

oracle("stream_clean", ORACLE["drop_control_words"])
oracle("stream_sessions", ORACLE["end_sessions"])
oracle("stream_score", "SELECT conv_id, turn, true AS same_as_batch FROM (" + ORACLE["drop_control_words"] + ")")

# ---------------------------------------------------------------- models: what SQL can compute of them

oracle("train_gate", "SELECT split, label, CAST(count(*) AS BIGINT) AS n FROM (" + ORACLE["stratified_split"] + ") GROUP BY split, label")
oracle("train_candidates", """SELECT CAST(epoch AS INTEGER) AS epoch, true AS accuracy_agrees, true AS macro_agrees, true AS loss_agrees
FROM range(1, 5) t(epoch)""")
oracle("score", """SELECT doc_id, 2 AS n_classes, 1.0::DOUBLE AS probability_sum, true AS label_agrees, true AS confidence_agrees
FROM documents""")
oracle("load_model", "SELECT doc_id, true AS same_as_in_memory FROM documents")
oracle("evaluate_model", """WITH s AS (""" + ORACLE["stratified_split"] + """)
SELECT split, label AS class, CAST(count(*) AS BIGINT) AS support, true AS accuracy_agrees, true AS macro_agrees, true AS loss_agrees
FROM s GROUP BY split, label""")
oracle("report_listed_classes", with_(SCORED_SQL, f"pred AS (SELECT vec_id, label, {ARGMAX('logits')} AS predicted_id FROM scored)") + """,
part AS (SELECT label, predicted_id, CASE WHEN label = 9 THEN 'test' WHEN vec_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM pred),
listed AS (SELECT DISTINCT split, c AS label FROM part, range(1, 10) t(c)),
counts AS (
  SELECT l.split, l.label,
         (SELECT count(*) FROM part p WHERE p.split = l.split AND p.label = l.label) AS support,
         (SELECT count(*) FROM part p WHERE p.split = l.split AND p.predicted_id = l.label) AS found,
         (SELECT count(*) FROM part p WHERE p.split = l.split AND p.predicted_id = l.label AND p.label = l.label) AS hits
  FROM listed l)
SELECT split, 'class ' || label AS class,
       round(CASE WHEN found = 0 THEN 0 ELSE hits / found END, 6) AS precision,
       round(CASE WHEN support = 0 THEN 0 ELSE hits / support END, 6) AS recall,
       round(CASE WHEN found + support = 0 THEN 0 ELSE 2.0 * hits / (found + support) END, 6) AS f1_score,
       CAST(support AS DOUBLE) AS support
FROM counts
UNION ALL
SELECT split, 'micro avg',
       round(CASE WHEN sum(found) = 0 THEN 0 ELSE sum(hits) / sum(found) END, 6),
       round(CASE WHEN sum(support) = 0 THEN 0 ELSE sum(hits) / sum(support) END, 6),
       round(CASE WHEN sum(found) + sum(support) = 0 THEN 0 ELSE 2.0 * sum(hits) / (sum(found) + sum(support)) END, 6),
       CAST(sum(support) AS DOUBLE)
FROM counts GROUP BY split
""")

# ---------------------------------------------------------------- the end-to-end slice (entry)

oracle("split_profile", split_sql(DEFAULT_FRACTIONS).replace(
    "SELECT r.doc_id, r.label, CASE", "SELECT r.doc_id, r.label, c.text, CASE").replace(
    "FROM ranked r JOIN", "FROM ranked r JOIN clean c ON r.doc_id = c.doc_id JOIN").replace(
    "WITH ", "WITH split_rows AS (WITH ", 1) + """)
SELECT split, label, CAST(count(*) AS BIGINT) AS n, round(avg(length(text)), 6) AS mean_chars
FROM split_rows GROUP BY split, label""")
