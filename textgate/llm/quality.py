"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.llm.texts import slices

#: Labelled rows a model is fitted on at most (those with the smallest hash of their id).
SAMPLE_ROWS = 20_000
FEATURES = ("log_bytes", "log_words", "log_lines", "word_bytes", "word_bytes_sd", "upper", "lower", "digit", "space",
            "punct", "non_ascii", "exclaim", "symbol", "pipe", "stop", "distinct_words", "top_word", "same_as_previous",
            "longest_repeat", "distinct_pairs", "top_pair", "distinct_lines", "short_lines", "line_bytes", "upper_words",
            "title_words", "end_punct_words", "odd_words", "digit_words", "long_words", "byte_entropy")
_BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "space": b" \t\n\r\x0b\x0c", "punct": b".,;:?'\"-()", "exclaim": b"!", "symbol": b"#$%&*+<=>@[\\]^_`{}~", "pipe": b"|",
    "stop": b".",
}


def document_features(text: bytes) -> np.ndarray:
    """The statistics of one whole text, in the order of ``FEATURES``; an empty text has zeros."""
    out = dict.fromkeys(FEATURES, 0.0)
    words, n = text.split(), len(text)
    if not words:
        out["log_bytes"] = np.log1p(n)
        return np.array([out[f] for f in FEATURES])
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    for name, chars in _BYTES.items():
        out[name] = counts[list(chars)].sum() / n
    out["non_ascii"] = counts[128:].sum() / n
    p = counts[counts > 0] / n
    out["byte_entropy"] = float(-(p * np.log2(p)).sum())
    m = len(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    lines = [x for x in text.split(b"\n") if x.strip()]
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    seen, pairs = Counter(words), Counter(zip(words, words[1:]))
    repeat = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, m - 1)
    ends = np.flatnonzero(np.diff(np.concatenate([[0], repeat.astype(np.int8), [0]])))
    last = Counter(w[-1:] for w in words)
    out |= {
        "log_bytes": np.log1p(n), "log_words": np.log1p(m), "log_lines": np.log1p(len(lines)),
        "word_bytes": lengths.mean(), "word_bytes_sd": lengths.std(),
        "distinct_words": len(seen) / m, "top_word": max(seen.values()) / m, "same_as_previous": repeat.mean() if m > 1 else 0,
        "longest_repeat": (ends[1::2] - ends[::2]).max() / m if len(ends) else 0,
        "distinct_pairs": len(pairs) / (m - 1) if m > 1 else 1, "top_pair": max(pairs.values()) / (m - 1) if m > 1 else 0,
        "distinct_lines": len(set(lines)) / len(lines), "short_lines": (line_lengths < 30).mean(), "line_bytes": np.log1p(line_lengths.mean()),
        "upper_words": sum(c for w, c in seen.items() if w.isupper() and len(w) > 1) / m,
        "title_words": sum(c for w, c in seen.items() if w[:1].isupper()) / m,
        "end_punct_words": sum(last[x] for x in (b".", b",", b";", b":", b"?")) / m,
        "odd_words": sum(last[x] for x in (b"!", b"#", b"$", b"%", b"&", b"*")) / m,
        "digit_words": sum(c for w, c in seen.items() if w[-1:].isdigit()) / m, "long_words": (lengths > 20).mean(),
    }
    return np.array([out[f] for f in FEATURES], dtype=float)


@dataclass
class BoostedTrees:
    """Trees as flat arrays: node ``i`` goes to ``left[i]`` where value <= threshold[i], else to
    ``left[i] + 1``; a leaf points to itself through ``left[i] = i`` and feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: all rows and all trees step down one level at a time."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            f = self.feature[at]
            right = (x[rows, np.maximum(f, 0)] > self.threshold[at]) & (f >= 0)
            at = self.left[at] + right
        return self.base + self.value[at].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
        ridge: float = 1.0, min_child: float = 3.0) -> BoostedTrees:
    """Newton boosting of log loss; splits are searched on per-feature histograms, level by level.

    With no rows, or one class only, the model is a constant (0.5 or close to that class).
    """
    n = len(y)
    rate_of_1 = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate_of_1 / (1 - rate_of_1)))
    feature, threshold, left, value, roots = [], [], [], [], []

    def node(v: float) -> int:
        feature.append(-1), threshold.append(0.0), left.append(len(left)), value.append(v)
        return len(left) - 1

    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, x.shape[1]), np.int64)
    margin, columns = np.full(n, base), np.arange(x.shape[1])
    for _ in range(trees if 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(node(-rate * grad.sum() / (hess.sum() + ridge)))
        where = np.full(n, roots[-1])
        level = [roots[-1]]
        for _ in range(depth):
            grown = []
            slot = np.full(len(left), -1)
            slot[level] = np.arange(len(level))
            live = np.flatnonzero(slot[where] >= 0)
            cell = ((slot[where[live]][:, None] * x.shape[1] + columns) * bins + code[live]).ravel()
            shape = (len(level), x.shape[1], bins)
            g, h = (np.bincount(cell, np.repeat(w[live], x.shape[1]), np.prod(shape)).reshape(shape).cumsum(2) for w in (grad, hess))
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g ** 2 / (all_h + ridge)
            gain[(h < min_child) | (all_h - h < min_child)] = -1
            for k, at in enumerate(level):
                f, b = np.unravel_index(gain[k].argmax(), shape[1:])
                if gain[k, f, b] <= 1e-6 or b >= len(edges[f]):
                    continue
                parts = [(g[k, f, b], h[k, f, b]), (all_g[k, f, 0] - g[k, f, b], all_h[k, f, 0] - h[k, f, b])]
                feature[at], threshold[at] = int(f), float(edges[f][b])
                children = [node(-rate * a / (c + ridge)) for a, c in parts]
                left[at] = children[0]
                mine = np.flatnonzero(where == at)
                where[mine] = children[0] + (code[mine, f] > b)
                grown += children
            level = grown
            if not level:
                break
        margin += np.array(value)[where]
    return BoostedTrees(np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64), np.array(value),
                        np.array(roots, np.int64), depth, base)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        rows = [document_features(t).tolist() for t in texts]
        yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(rows, pa.list_(pa.float64()))], ["h", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> BoostedTrees:
    """Fit on the texts of ``sample_rows`` rows of ``labels`` at most, whose label is 0 or 1.

    The sample is the labels with the smallest hash of their id, so it is spread evenly and the
    same in every run. It is broadcast to the documents (0.5 MB at the default). Features are
    computed on the executors; one row of 31 numbers per sampled id and label reaches the driver (5 MB).
    """
    bounded = labels.filter(F.col(label_col).isin(0, 1)) \
        .select(F.xxhash64(id_col).alias("_h"), F.col(id_col).alias("_label_id"), F.col(label_col).cast("double").alias("_label")) \
        .orderBy("_h", "_label").limit(sample_rows)
    rows = docs.join(F.broadcast(bounded), F.col(id_col) == F.col("_label_id")).select(
        F.col(text_col).alias("text"), F.col("_h").alias("h"), F.col("_label").alias("label"))
    # an id that is repeated counts once
    got = rows.mapInArrow(_features, "h bigint, label double, x array<double>") \
        .groupBy("h", "label").agg(F.min("x").alias("x")).toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = got.column("label").to_numpy()
    order = np.lexsort((*x.T, y))  # the fit must not depend on the order in which tasks end
    return fit(x[order], y[order])


def _score(model: BoostedTrees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            x = np.stack([document_features(t) for t in texts])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(x))], ["id", "score"])
    return run


def _accept(model: BoostedTrees, text_at: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices([batch], batch.schema.names[text_at]):
                x = np.stack([document_features(t) for t in texts])
                yield part.filter(pa.array(model.scores(x) >= threshold))
    return run


def score(docs: DataFrame, model: BoostedTrees, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and score: how likely label 1 is, 0 to 1, for every row of ``docs``.

    Null and empty texts have zero features and get a score like any other. Repeated rows score
    alike. Other columns are not read. The model (some 100 kB) goes with the task.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(_score(model), f"id {id_type}, score double").withColumnRenamed("id", id_col)


def accept(docs: DataFrame, model: BoostedTrees, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    return docs.mapInArrow(_accept(model, docs.columns.index(text_col), threshold), docs.schema)


def _held_out(id_col: str, parts: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == 0


def quality_model(docs: DataFrame, labels: DataFrame) -> BoostedTrees:
    """The model of ``labels.quality``, learnt without the ids of the held-out fifth.

    Rows of ``labels`` with a null or other label are not learnt from; with none at all every
    score is 0.5.
    """
    return train(docs, labels.filter(~_held_out("doc_id", 5)))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``. A null doc_id counts as the
    empty text in the fold rule."""
    return score(docs, quality_model(docs, labels)).select(
        "doc_id", _held_out("doc_id", 5).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
