"""LM scoring: a gated recurrent language model, trained and run in numpy on the executors.

The output is factored: P(word) = P(group of classes) * P(class in group) * P(word in class), with
classes cut from the words, and groups from the classes, by frequency, so a token costs three small
softmaxes. The vocabulary grows with the corpus: its words
are all those above a count that grows with the root of the tokens, so the tail's share of the
tokens falls. The tail's words are one class of their own; inside it a word has its smoothed share
of that class's training tokens. All texts are scored whole: the recurrent state is carried from
window to window until a text ends.

Training is truncated backpropagation through time. Each task trains a replica on its documents, all
at once or in large parts, in parallel streams that carry their state over the windows; after each round the replicas'
parameters are averaged, weighted by tokens. The rounds share out all training documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.llm.texts import slices, tokens
from textgate.session import materialise

#: The token at the end of a text; no word holds a line feed.
END = b"\n"
SMOOTHING = 0.1
#: A word has a parameter row of its own from a count of sqrt(tokens) / DENSITY on, and of LEAST;
#: the VOCABULARY highest counts have one in any case.
VOCABULARY, DENSITY, LEAST = 1024, 64, 5
#: Words whose counts go to every task, besides the model's words.
FREQUENT = 100_000
HIDDEN, WINDOW, STREAMS, ROUNDS, REPLICAS = 16, 32, 1024, 2, 2048
#: Windows that a replica learns by, at least, before it gets more streams.
STEPS = 200
#: Tokens a model word that a replica learns from in a round, at least.
LOAD = 96
RATE = 0.24
#: A replica that gets twice as many tokens as this learns them in parts of this many.
HELD = 1 << 22
#: Texts scored side by side, and tokens whose outputs are scored together.
SCORED, OUTPUTS = 512, 1 << 16
#: Texts, and bytes of text, that are split into words at a time.
SLICE_ROWS, SLICE_BYTES = 4096, 8 << 20


@dataclass
class Words:
    """``place`` of each frequent word by falling count; the first ones are the model's words."""

    place: dict[bytes, int]
    log_count: np.ndarray  # log10(count + 0.1)
    model_id: np.ndarray  # of each place; the last place stands for all other words
    starts: np.ndarray  # where each class's model words start; one more at the end
    class_of: np.ndarray
    groups: np.ndarray  # where each group's classes start; one more at the end
    group_of: np.ndarray  # of each class
    end: int
    base_total: float  # log10 of the denominators: all tokens, and tokens of the rare class
    rare_total: float
    share: np.ndarray  # training tokens of each model word

    @property
    def rare(self) -> int:
        return len(self.class_of) - 1


def least_count(n: int) -> float:
    """The count from which on a word is the model's, in a corpus of ``n`` tokens."""
    return max(LEAST, math.sqrt(n) / DENSITY)


def _cuts(share: np.ndarray, parts: int) -> np.ndarray:
    """Where ``parts`` runs of equal sums of sqrt(share) start: short ones where shares are large, which
    makes the sum over runs of their share times their length least."""
    mass = np.cumsum(np.sqrt(share))
    return np.unique(np.minimum((mass - np.sqrt(share)) / mass[-1] * parts, parts - 1).astype(int), return_index=True)[1]


def words_of(frequent: list[tuple[bytes, int]], n: int, v: int, size: int | None = None, classes: int | None = None) -> Words:
    """From (word, count) of the frequent words, the tokens ``n`` and the distinct words ``v``.

    Without ``size`` the model's words are those of ``least_count`` or more; without ``classes``
    there are 0.6 times the root of their number. There are as many groups as the root of
    the classes.
    """
    ends = next((c for w, c in frequent if w == END), 0)
    ranked = sorted((x for x in frequent if x[0] != END), key=lambda x: (-x[1], x[0]))
    if size is None:
        size = max(VOCABULARY, 2 + sum(c >= least_count(n) for _, c in ranked))
    classes = classes or max(2, round(0.6 * math.sqrt(size)))
    own = sorted([(END, ends), *ranked[:size - 2]], key=lambda x: (-x[1], x[0]))  # END is always the model's
    ranked = own + ranked[size - 2:]
    counts = np.array([c for _, c in ranked], float)
    rare_n = n - counts[:len(own)].sum()
    share = np.concatenate([counts[:len(own)], [rare_n]]) + SMOOTHING
    # the rare words are the last class
    starts = np.concatenate([_cuts(share[:-1], classes), [len(own), len(own) + 1]])
    class_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    groups = np.append(_cuts(np.add.reduceat(share, starts[:-1]), round(math.sqrt(classes))), len(starts) - 1)
    group_of = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
    model_id = np.concatenate([np.minimum(np.arange(len(ranked)), len(own)), [len(own)]])
    known = len(own) - (ends == 0)
    return Words({w: i for i, (w, _) in enumerate(ranked)}, np.log10(counts + SMOOTHING), model_id, starts, class_of, groups, group_of,
                 [w for w, _ in own].index(END), float(np.log10(n + SMOOTHING * (v + 1))),
                 float(np.log10(rare_n + SMOOTHING * (v - known + 1))), share)


class Model:
    """Parameters, float32: ``wx`` (input word to gates), ``u`` (state to gates), and from the state to
    groups ``ws``, classes ``wc`` and words ``ww`` (a row each, the bias as last column). Gates in order:
    update, reset, candidate."""

    NAMES = ("wx", "u", "ws", "wc", "ww")

    def __init__(self, words: Words, hidden: int = HIDDEN, seed: int = 0) -> None:
        """At the start the states say nothing and the biases give each word its share of the tokens."""
        r, v = np.random.default_rng(seed), len(words.class_of)
        by_class = np.add.reduceat(words.share, words.starts[:-1])
        by_group = np.add.reduceat(by_class, words.groups[:-1])
        self.wx = r.normal(0, 0.3, (v, 3 * hidden)).astype(np.float32)
        self.u = r.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        for name, share in (("ws", by_group / by_group.sum()), ("wc", by_class / by_group[words.group_of]),
                            ("ww", words.share / by_class[words.class_of])):
            rows = np.zeros((len(share), hidden + 1), np.float32)
            rows[:, hidden] = np.log(share)
            setattr(self, name, rows)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def set_flat(self, values: np.ndarray) -> Model:
        at = 0
        for n in self.NAMES:
            p = getattr(self, n)
            setattr(self, n, values[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return self


def _order(ids: np.ndarray) -> np.ndarray:
    """Positions of ``ids`` (not negative) in their stable order; numpy sorts 16 bits at a time by radix."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    high = ids >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def _run(m: Model, state: np.ndarray, inputs: np.ndarray, keep: np.ndarray, every: bool = True) -> tuple[np.ndarray, ...]:
    """States (steps + 1, streams, hidden) with each step's kept state, gates (update and reset), candidate and
    what the state gives to the gates, each gate's values side by side; keep is 0 where a text starts.
    Without ``every`` only the states are those of all steps."""
    steps, streams = inputs.shape
    k = m.u.shape[0]
    held = steps if every else 1
    states = np.empty((steps + 1, streams, k), np.float32)
    before, cand = np.empty((held, streams, k), np.float32), np.empty((held, streams, k), np.float32)
    gates, from_state = np.empty((held, 2, streams, k), np.float32), np.empty((held, 3, streams, k), np.float32)
    states[0] = state
    u = np.ascontiguousarray(m.u.reshape(k, 3, k).transpose(1, 0, 2))
    for t in range(steps):
        at = t if every else 0
        x = np.take(m.wx, inputs[t], axis=0).reshape(streams, 3, k).transpose(1, 0, 2)
        h = np.multiply(states[t], keep[t, :, None], out=before[at])
        hu = np.matmul(h, u, out=from_state[at])
        g = np.add(x[:2], hu[:2], out=gates[at])
        np.negative(g, out=g)
        np.exp(np.minimum(g, 30, out=g), out=g)
        g += 1
        np.reciprocal(g, out=g)
        n = np.multiply(g[1], hu[2], out=cand[at])
        n += x[2]
        np.tanh(n, out=n)
        new = np.subtract(h, n, out=states[t + 1])
        new *= g[0]
        new += n
    return states, before, gates, cand, from_state


def _level(weights: np.ndarray, starts: np.ndarray, of: np.ndarray, pick: np.ndarray, part: np.ndarray, weight: np.float32,
           grad: np.ndarray | None, cut: bool = False) -> tuple:
    """Log probability of each token's ``pick`` among the rows of ``weights`` from ``starts[of]`` on. With ``grad``, an
    array like ``weights``, also dh and the runs of rows whose gradients it got: those of the tokens' softmaxes.

    ``of`` rises, so that the tokens, outputs and gradients of a softmax are slices. Exponentials are not made
    probabilities one by one: the tokens are divided by their sums instead. Logits count as at most 60
    either way, so nothing overflows; they are only ``cut`` where a sum shows that it matters.
    """
    n, k = len(part), part.shape[1] - 1
    sizes, ends = np.diff(starts), np.searchsorted(of, np.arange(len(starts)))
    ones = np.ones(sizes.max(), np.float32)
    at = (np.arange(n) - ends[of]) * sizes[of] + pick - starts[of]  # of the picked logit, among those of its softmax
    chosen, total = np.zeros(n, np.float32), np.ones(n, np.float32)
    dh, touched = None if grad is None else np.zeros((n, k), np.float32), []
    for c in np.flatnonzero((np.diff(ends) > 0) & (sizes > 1)).tolist():
        a, b, s, e = starts[c], starts[c + 1], ends[c], ends[c + 1]
        own, here, i, sums = part[s:e], weights[a:b], at[s:e], total[s:e]
        d = own @ here.T
        if cut:
            np.clip(d, -60, 60, out=d)
        flat = d.reshape(-1)
        chosen[s:e] = flat[i]
        np.exp(d, out=d)
        np.matmul(d, ones[:b - a], out=sums)
        if grad is not None:
            flat[i] -= sums
            np.matmul(d, here[:, :k], out=dh[s:e])
            np.matmul(d.T, own * (weight / sums)[:, None], out=grad[a:b])
            touched.append((a, b))
    if n and not cut and not (total.max() < 1e26 and total.min() > 1e-15 and chosen.min() >= -60):
        return _level(weights, starts, of, pick, part, weight, grad, cut=True)
    if grad is not None:
        dh *= (weight / total)[:, None]
    return chosen - np.log(total), dh, touched


def _outputs(m: Model, words: Words, h: np.ndarray, target: np.ndarray, grad: dict | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each target; with ``grad``, which has arrays like ``ws``, ``wc`` and ``ww``
    to write to, returns dh and puts (rows, gradient per token mean) in their place, for the rows
    that the targets' softmaxes hold.

    Tokens are sorted by word class once, which sorts them at each level.
    """
    n, k = h.shape
    weight = np.float32(1 / max(n, 1))
    order = _order(words.class_of[target])
    target = target[order]
    classes = words.class_of[target]
    groups = words.group_of[classes]
    part = np.ones((n, k + 1), np.float32)
    part[:, :k] = np.take(h, order, axis=0)
    logs, dh = np.zeros(n), None if grad is None else np.zeros((n, k), np.float32)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):  # sums that are not finite are found
        for name, starts, of, pick in (("ws", np.array([0, len(m.ws)]), np.zeros(n, int), groups), ("wc", words.groups, groups, classes),
                                       ("ww", words.starts, classes, target)):
            log, back, touched = _level(getattr(m, name), starts, of, pick, part, weight, None if grad is None else grad[name])
            logs += log
            if grad is not None:
                dh += back
                runs = all(x[1] == y[0] for x, y in zip(touched, touched[1:]))
                rows = slice(touched[0][0], touched[-1][1]) if runs and touched else np.concatenate(
                    [np.zeros(0, int), *[np.arange(a, b) for a, b in touched]])
                grad[name] = (rows, grad[name][rows])
    out = np.empty(n)
    out[order] = logs
    if grad is None:
        return out, None
    back = np.empty((n, k), np.float32)
    back[order] = dh
    return out, back


def _streams(texts: list[np.ndarray], end: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(token, text number) by step and stream: whole texts, dealt the longest first, each to the shortest
    stream, and there in their order; -1 behind a stream's last text. ``texts`` have their END."""
    total, longest = sum(map(len, texts)), max(map(len, texts))
    n = max(1, min(most, total // longest, len(texts)))
    loads, lanes = [(0, i) for i in range(n)], [[] for _ in range(n)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        load, lane = heapq.heappop(loads)
        lanes[lane].append(i)
        heapq.heappush(loads, (load + len(texts[i]), lane))
    steps = max(load for load, _ in loads)
    token, text = np.full((n, steps), -1, np.int32), np.full((n, steps), -1, np.int32)
    for lane, own in enumerate(lanes):
        own.sort()
        row = np.concatenate([texts[i] for i in own])
        token[lane, :len(row)] = row
        text[lane, :len(row)] = np.repeat(own, [len(texts[i]) for i in own])
    return token.T, text.T


def _windows(token: np.ndarray, text: np.ndarray, end: int, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(inputs, keep, targets, texts) of each window: a text's first input is END, its state fresh."""
    for at in range(0, len(token), steps):
        now, whose = np.ascontiguousarray(token[at:at + steps]), np.ascontiguousarray(text[at:at + steps])
        fresh, inputs = np.ones(now.shape, bool), np.full(now.shape, end, np.int32)
        fresh[1:], inputs[1:] = whose[1:] != whose[:-1], now[:-1]
        if at:
            fresh[0], inputs[0] = whose[0] != text[at - 1], token[at - 1]
        inputs[fresh | (inputs < 0)] = end
        yield inputs, (~fresh).astype(np.float32), now, whose


def log_likelihoods(m: Model, words: Words, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each whole text, given as model ids with END."""
    token, text = _streams(texts, words.end, SCORED)
    out, state = np.zeros(len(texts)), np.zeros((token.shape[1], m.u.shape[0]), np.float32)
    held, n = [], 0
    for inputs, keep, target, whose in _windows(token, text, words.end, 2 * WINDOW):
        states = _run(m, state, inputs, keep, every=False)[0]
        state = states[-1]
        real = target >= 0
        held.append((states[1:].reshape(-1, states.shape[2]), target.ravel(), whose.ravel()) if real.all() else
                    (states[1:][real], target[real], whose[real]))
        n += len(held[-1][1])
        if n >= OUTPUTS:
            out += _held_outputs(m, words, held, len(texts))
            held, n = [], 0
    return out + _held_outputs(m, words, held, len(texts)) if held else out


def _held_outputs(m: Model, words: Words, held: list[tuple], texts: int) -> np.ndarray:
    h, target, whose = (np.concatenate(x) for x in zip(*held))
    return np.bincount(whose, _outputs(m, words, h, target, None)[0], texts)


class Trainer:
    """Adagrad over windows of ``WINDOW`` steps; gradients stop at a window's start, states do not."""

    def __init__(self, m: Model, words: Words, rate: float = RATE) -> None:
        self.m, self.words, self.rate, self.seen = m, words, rate, 0
        self.squares = {n: np.full(getattr(m, n).shape, 1e-6, np.float32) for n in m.NAMES}
        self.outputs = {n: np.empty_like(getattr(m, n)) for n in ("ws", "wc", "ww")}  # their gradients are written here
        self.streams = 8

    def _step(self, name: str, rows, grad: np.ndarray) -> None:
        squares, p = self.squares[name], getattr(self.m, name)
        if not isinstance(rows, slice):
            seen = np.take(squares, rows, axis=0)
            seen += grad * grad
            squares[rows] = seen
            move = np.divide(grad, np.sqrt(seen, out=seen), out=seen)
            move *= self.rate
            p[rows] = np.subtract(np.take(p, rows, axis=0), move, out=move)
            return
        squares, p = squares[rows], p[rows]
        step = np.empty_like(grad[:2048])
        for at in range(0, len(grad), 2048):  # in parts that stay in the cache
            g, seen = grad[at:at + 2048], squares[at:at + 2048]
            move = np.multiply(g, g, out=step[:len(g)])
            seen += move
            np.sqrt(seen, out=move)
            np.divide(g, move, out=move)
            move *= self.rate
            p[at:at + 2048] -= move

    def learn(self, texts: list[np.ndarray]) -> None:
        m, k = self.m, self.m.u.shape[0]
        total = sum(map(len, texts))
        # small inputs get fewer streams, so that there are STEPS to learn by; what is left after a large part has its streams
        self.streams = max(self.streams, min(STREAMS, total // (WINDOW * STEPS)))
        token, text = _streams(texts, self.words.end, self.streams)
        state = np.zeros((token.shape[1], k), np.float32)
        back = np.empty((3, k, k), np.float32)
        for inputs, keep, target, _ in _windows(token, text, self.words.end, WINDOW):
            states, before, gates, cand, from_state = _run(m, state, inputs, keep)
            state = states[-1]
            real = target >= 0
            if not real.any():
                continue
            grad: dict[str, np.ndarray] = dict(self.outputs)
            full = real.all()
            _, dh = _outputs(m, self.words, states[1:].reshape(-1, k) if full else states[1:][real], target.ravel() if full else target[real], grad)
            if full:
                into = dh.reshape(before.shape)
            else:
                into = np.zeros(before.shape, np.float32)
                into[real] = dh
            z, r = gates[:, 0], gates[:, 1]
            # what a step's error is multiplied with on its way into each gate, for all steps at once
            to_update, to_candidate, to_reset = before - cand, 1 - z, 1 - r
            to_update *= z
            to_update *= to_candidate
            np.multiply(cand, cand, out=cand)
            to_candidate *= np.subtract(1, cand, out=cand)
            to_reset *= r
            to_reset *= from_state[:, 2]
            d_candidate, d_state = np.empty_like(cand), np.empty((3, *before.shape), np.float32)
            later, through = np.zeros_like(state), np.empty((3, *state.shape), np.float32)
            back[...] = m.u.reshape(k, 3, k).transpose(1, 2, 0)
            for t in range(len(inputs) - 1, -1, -1):
                d = into[t]
                d += later
                dn = np.multiply(d, to_candidate[t], out=d_candidate[t])
                np.multiply(d, to_update[t], out=d_state[0, t])
                np.multiply(dn, to_reset[t], out=d_state[1, t])
                np.multiply(dn, r[t], out=d_state[2, t])
                np.matmul(d_state[:, t], back, out=through)
                np.multiply(d, z[t], out=later)
                for g in through:
                    later += g
                later *= keep[t, :, None]
            grad["u"] = (slice(None), np.hstack([before.reshape(-1, k).T @ d.reshape(-1, k) for d in d_state]))
            order = _order(inputs.ravel())
            token_at = inputs.ravel()[order]
            first = np.flatnonzero(np.concatenate([[True], token_at[1:] != token_at[:-1]]))
            d_input = np.empty((len(order), 3, k), np.float32)
            for g, d in enumerate((d_state[0], d_state[1], d_candidate)):
                d_input[:, g] = d.reshape(-1, k)
            # a pair of values as one number: reduceat goes through the rows once a column
            d_input = np.take(d_input.reshape(-1, 3 * k), order, axis=0)
            pairs = d_input.view(np.complex64) if k % 2 == 0 else d_input
            self._step("wx", token_at[first], np.add.reduceat(pairs, first).view(np.float32))
            for name in ("u", "ws", "wc", "ww"):
                self._step(name, *grad[name])
            self.seen += int(real.sum())


def _split(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """All tokens of the texts without END, and how many each text has; as ``tokens`` gives them."""
    column = pc.fill_null(part.column(part.schema.get_field_index("text")).cast(pa.binary()), b"").view(pa.string())
    column = pc.ascii_trim_whitespace(pc.ascii_lower(column))
    lists = pc.ascii_split_whitespace(column)
    words, n = lists.flatten().view(pa.binary()), np.diff(lists.offsets.to_numpy())
    empty = pc.binary_length(column).to_numpy() == 0  # such a text gives one empty word
    if empty.any():
        words, n = words.filter(pa.array(np.repeat(~empty, n))), np.where(empty, 0, n)
    return words, n


def _places(words: pa.Array, n: np.ndarray, known: pa.Array, other: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``known`` (or ``other``) of texts' tokens with END, and where each text starts; one more at the end."""
    starts = np.concatenate([[0], np.cumsum(n + 1)])
    out, ends = np.empty(starts[-1], np.int32), np.zeros(starts[-1], bool)
    ends[starts[1:] - 1] = True
    out[ends] = end
    out[~ends] = pc.fill_null(pc.index_in(words, value_set=known), other).to_numpy()
    return out, starts


def _count(held_at: int):
    """(word, count) of the rows' tokens, in parts of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, ends = [], 0, 0
        for part, _ in slices(batches, rows=SLICE_ROWS, size=SLICE_BYTES):
            words, n = _split(part)
            counts = pc.value_counts(words)
            held.append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
            rows += len(counts)
            ends += len(n)
            if rows > 2 * held_at:
                held = [_added(held)]
                rows = held[0].num_rows
            if rows > held_at and len(held) == 1:
                yield from held[0].to_batches()
                held, rows = [], 0
        if ends:
            held.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([ends], pa.int64())}))
        if held:
            yield from _added(held).to_batches()
    return run


def _added(tables: list[pa.Table]) -> pa.Table:
    got = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"word": got.column("word"), "n": got.column("n_sum")})


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n) of all tokens of ``docs``, END included; summed in each task first."""
    return docs.select(F.col(text_col).alias("text")).mapInArrow(_count(200_000), "word binary, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = FREQUENT, *, down_to: float = math.inf) -> list[tuple[bytes, int]]:
    """The words of the highest counts, ``most`` at most, and all words of a count of ``down_to``:
    all above a step of an eighth of a power of two, found from a histogram of some hundred rows,
    so nothing is sorted."""
    step = F.floor(F.log2("n") * 8)
    total, least = 0, math.inf
    for row in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    if down_to < math.inf:
        least = min(least, math.floor(math.log2(down_to) * 8))
    got = counts.filter((step >= F.lit(float(least))) | (F.col("word") == END)).toArrow()
    return list(zip(got.column("word").to_pylist(), got.column("n").to_pylist()))


def _train_replica(words: Words, values: np.ndarray, chunk: int):
    """What a replica changed, in parts of ``chunk`` values (halves, null-free; unchanged parts are not
    sent), and a part -1 with the tokens that it learned from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Model(words).set_flat(values), words)
        own = pa.array(list(words.place)[:words.rare], pa.binary())
        held, n = [], 0
        for part, _ in slices(batches, rows=SLICE_ROWS, size=SLICE_BYTES):
            ids, starts = _places(*_split(part), own, words.rare, words.end)
            held += np.split(ids, starts[1:-1])
            n += len(ids)
            if n >= 2 * HELD:  # what is left for the end is about HELD tokens or more
                ends = np.cumsum([len(x) for x in held])
                to = int(np.searchsorted(ends, HELD)) + 1
                trainer.learn(held[:to])
                held, n = held[to:], n - int(ends[to - 1])
        if held:
            trainer.learn(held)
        if trainer.seen:
            change = (trainer.m.flat() - values).astype(np.float16)
            parts = {i // chunk: change[i:i + chunk] for i in range(0, len(change), chunk)}
            sent = [(-1, b""), *((k, part.tobytes()) for k, part in parts.items() if part.any())]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sent], pa.int32()), pa.array([trainer.seen] * len(sent), pa.int64()),
                                              pa.array([data for _, data in sent], pa.binary())], ["part", "seen", "data"])
    return run


def _changes(table: pa.Table) -> pa.Table:
    """The sum over replicas of a part's changes, weighted by the tokens that each learned from."""
    total, seen = 0.0, 0
    rows = sorted(zip(table.column("seen").to_pylist(), table.column("data").to_pylist()))  # the same sum in every run
    for n, data in rows:
        total = total + n * np.frombuffer(data, np.float16).astype(float)
        seen += n
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "seen": pa.array([seen], pa.int64()),
                     "data": pa.array([np.asarray(total).tobytes()], pa.binary())})


def replicas_for(n: int, words: Words) -> int:
    """Tasks that train side by side on ``n`` tokens: each learns from ``LOAD`` tokens a model word or more,
    so that the replicas' changes (130 bytes a word) stay well under the texts they read."""
    return max(1, min(REPLICAS, n // (LOAD * len(words.class_of))))


def train(docs: DataFrame, words: Words, text_col: str = "text", rounds: int = ROUNDS, replicas: int = REPLICAS) -> Model:
    """Train on every row of ``docs``, each in one of ``rounds`` (by the hash of its text).

    At most ``replicas`` tasks train at a time. After a round the model moves by the mean of what the
    replicas changed, weighted by tokens; a part's changes are added up in one task, ``replicas``
    times 16 kB at most. The result is the only thing that reaches the driver.
    """
    model = Model(words)
    text = F.col(text_col).alias("text")
    turn = F.pmod(F.xxhash64(text_col), F.lit(rounds))
    chunk = 8192
    for k in range(rounds):
        rows, values = docs.filter(turn == k).select(text).coalesce(replicas), model.flat()
        parts = rows.mapInArrow(_train_replica(words, values, chunk), "part int, seen bigint, data binary") \
            .groupBy("part").applyInArrow(_changes, "part int, seen bigint, data binary").toArrow().to_pylist()
        seen = sum(p["seen"] for p in parts if p["part"] < 0)
        for p in parts:
            if p["part"] >= 0:
                change = np.frombuffer(p["data"]) / seen
                values[p["part"] * chunk:][:len(change)] += change.astype(np.float32)
        model.set_flat(values)
    return model


def _score(words: Words, values: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(words).set_flat(values)
        known_words = pa.array(list(words.place), pa.binary())
        log_count = np.append(words.log_count, 0.0)  # the last one is of all other words, which are in the tail
        for batch in batches:
            ids, n, base, extra, tail, times, sizes, absent = [], [], [], [], [], [], [], []
            for part, _ in slices([batch], rows=SLICE_ROWS, size=SLICE_BYTES):
                flat, own = _split(part)
                place, starts = _places(flat, own, known_words, -1, words.end)
                model_ids, logs = words.model_id[place].astype(np.int32), log_count[place]
                rare = model_ids == words.rare
                ids += np.split(model_ids, starts[1:-1])
                n.append(own + 1)
                base.append(np.add.reduceat(logs, starts[:-1]))
                extra.append(np.add.reduceat(np.where(rare, logs - words.rare_total, 0), starts[:-1]))
                text = np.repeat(np.arange(len(own)), own + 1)
                outside = np.flatnonzero(place < 0)
                text = text[outside]
                absent.append(np.bincount(text, minlength=len(own)))
                coded = flat.take(pa.array(outside - text)).dictionary_encode()  # a text's tokens lie one END further for each text before
                pairs, often = np.unique(text * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
                whose, code = np.divmod(pairs, max(1, len(coded.dictionary)))
                tail.append(coded.dictionary.take(pa.array(code)))
                times.append(often)
                sizes.append(np.bincount(whose, minlength=len(own)))
            if not ids:
                continue
            score = log_likelihoods(model, words, ids) / np.log(10) + np.concatenate(extra)
            tails = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)),
                pa.StructArray.from_arrays([pa.concat_arrays(tail), pa.array(np.concatenate(times), pa.int64())], ["word", "times"]))
            n = np.concatenate(n).astype(np.int64)
            # the end counts as known if any training text has ended
            known = n - np.concatenate(absent) - (words.share[words.end] <= SMOOTHING)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(np.concatenate(base) - n * words.base_total), pa.array(score), tails],
                ["id", "n_tokens", "n_known", "base_score", "score", "tail"])
    return run


def lm_scores(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows for which ``learn_from`` holds, all of them. Null texts are
    empty ones; an empty text is its END. Repeated rows score alike. Without any training row all
    counts are 0. Other columns are not read; an empty table gives an empty one.

    The model's words and the ``FREQUENT`` highest counts go to every task (some MB). Tokens outside of them, which no
    task knows the counts of, are summed up per text, written with the scores, and joined with the
    count table; no word among them is frequent, so no key of that join is hot.
    """
    learn = docs.filter(learn_from)
    counts = materialise(word_counts(learn, text_col), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words = words_of(frequent_words(counts, down_to=least_count(n)), n, v)
    model = train(learn, words, text_col, replicas=replicas_for(n // ROUNDS, words))
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _score(words, model.flat()), f"id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double, "
        "tail array<struct<word: binary, times: bigint>>")
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    found = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.times").join(counts, "word", "left")
    logs = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)
    found = found.groupBy("row").agg(F.sum(logs).alias("logs"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"))
    more = F.coalesce("logs", F.lit(0.0))
    return scored.drop("tail").join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return lm_scores(table(spark, sf_dir, "documents"), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
