"""SentencePiece encoding by Unigram Viterbi over a double-array trie, and decoding.

All steps are vectorised over the distinct chunks of a slice of documents. A chunk is a run of
spaces with the word behind it, or a line feed: no piece of the vocabulary reaches over its ends
(checked when it is loaded), so the best path of a text is the best paths of its chunks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.llm.texts import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The whitespace marker, and how far below the lowest piece an unknown character scores.
MARKER, UNKNOWN = "▁", 10.0
#: Chunks whose pieces a task remembers.
REMEMBERED = 200_000


@dataclass
class Vocabulary:
    """Pieces as a double-array trie over UTF-8 bytes, the marker as a plain space.

    From state s, byte b leads to t = base[s] + b if check[t] == s; ends[t] is the id of the piece
    that ends there, or -1.
    """

    base: np.ndarray
    check: np.ndarray
    ends: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    flat: np.ndarray  # the pieces' bytes, one after the other, for decoding
    offsets: np.ndarray
    longest: int
    chunk: str


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and ends of the trie of ``words``; state 0 is its root."""
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for word, number in words.items():
        at = 0
        for b in word:
            if b not in children[at]:
                children[at][b] = len(children)
                children.append({})
                value.append(-1)
            at = children[at][b]
        value[at] = number
    size = 4 * len(children) + 16_384
    base, check, ends = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    open_ = np.ones(size, bool)
    open_[0] = False
    lone, wide, window = 1, 1, 4096  # where the search starts: for one child, and for several
    todo = [(0, 0)]
    for node, state in todo:
        codes = np.array(sorted(children[node]), np.int64)
        if not len(codes):
            continue
        if len(codes) == 1:
            lone = max(lone, int(codes[0]) + 1)
            while not open_[lone]:
                lone += 1
            at = lone - int(codes[0])
        else:
            while True:
                starts = np.arange(wide, wide + window)
                fits = np.flatnonzero(open_[starts[:, None] + codes].all(1))
                if len(fits):
                    at = int(starts[fits[0]])
                    break
                wide += window // 2
        base[state] = at
        open_[at + codes] = False
        check[at + codes] = state
        for c in codes.tolist():
            ends[at + c] = value[children[node][c]]
            todo.append((children[node][c], at + c))
    return base, check, ends


@lru_cache(2)
def load(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model file. Log scores are the file's; where these are merge ranks (a
    BPE file: all whole numbers), piece k gets the log of its share under Zipf's law."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    raw = np.array([model.get_score(i) for i in range(n)])
    scores = np.full(n, -np.inf)
    ranks = raw[normal] == np.round(raw[normal])
    if ranks.all():
        share = 1 / (2 + raw[normal].max() - raw[normal])
        scores[normal] = np.log(share / share.sum())
    else:
        scores[normal] = raw[normal]
    byte_ids = np.full(256, -1)
    content = []
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[1:-1], 16)] = i
            content.append(bytes([int(name[1:-1], 16)]))
        else:
            content.append(b"" if scores[i] == -np.inf else name.replace(MARKER, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    words = {content[i]: i for i in normal}
    inner = any(b" " in w.lstrip(b" ") for w in words)
    lines = any(b"\n" in w for w in words)
    chunk = r"[\s\S]+" if inner else r" *[^ ]+| +" if lines else r"\n| *[^ \n]+| +"
    base, check, ends = double_array(words)
    return Vocabulary(base, check, ends, scores, byte_ids, scores[normal].min() - UNKNOWN,
                      np.frombuffer(b"".join(content), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in content])]),
                      max(map(len, words)), chunk)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., lengths[0] of them, then those of starts[1], and so on."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def encode_chunks(voc: Vocabulary, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all chunks one after the other, number of ids of each): the best-scoring pieces.

    Of equal paths to a place, the one whose last piece is longest is taken. A character that is
    no piece scores ``unknown`` and becomes its UTF-8 bytes' pieces.
    """
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    first = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(chunks), np.uint8).astype(np.int64)
    word = np.repeat(np.arange(len(chunks)), sizes)
    end = (first + sizes)[word]
    heads = np.flatnonzero((text & 0xC0) != 0x80)
    char = np.diff(np.concatenate([heads, [len(text)]]))  # a chunk starts with a whole character
    # all places step down the trie together, one byte at a time
    src, length, piece = [], [], []
    at, state, live = heads, np.zeros(len(heads), np.int64), np.arange(len(heads))
    single = np.zeros(len(heads), bool)
    for depth in range(voc.longest):
        inside = at + depth < end[at]
        at, state, live = at[inside], state[inside], live[inside]
        to = voc.base[state] + text[at + depth]
        found = voc.check[to] == state
        at, state, live = at[found], to[found], live[found]
        if not len(at):
            break
        number = voc.ends[state]
        hit = number >= 0
        src.append(at[hit])
        length.append(np.full(hit.sum(), depth + 1))
        piece.append(number[hit])
        single[live[hit & (char[live] == depth + 1)]] = True
    src.append(heads[~single])
    length.append(char[~single])
    piece.append(np.full((~single).sum(), -1))
    src, length, piece = np.concatenate(src), np.concatenate(length), np.concatenate(piece)
    gain = np.where(piece >= 0, voc.scores[piece], voc.unknown)
    # Viterbi over all chunks at once, by offset in the chunk; a chunk has one slot more than bytes
    offset = src - first[word[src]]
    order = np.argsort(offset, kind="stable")
    src, length, piece, gain, offset = src[order], length[order], piece[order], gain[order], offset[order]
    slot = src + word[src]
    root = first + np.arange(len(chunks))
    best = np.full(len(text) + len(chunks), -np.inf)
    best[root] = 0
    back, back_piece = np.zeros(len(best), np.int64), np.full(len(best), -1)
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(offset)) + 1, [len(offset)]])
    for a, b in zip(bounds[:-1], bounds[1:]):
        score = best[slot[a:b]] + gain[a:b]
        to = slot[a:b] + length[a:b]
        better = score > best[to]
        to = to[better]
        best[to] = score[better]
        back[to] = length[a:b][better]
        back_piece[to] = piece[a:b][better]
    # back from every end; a step's pieces come before those of the steps already taken
    at, who = root + sizes, np.arange(len(chunks))
    whose, which, where = [], [], []
    while len(at):
        going = at > root[who]
        at, who = at[going], who[going]
        whose.append(who)
        which.append(back_piece[at])
        at = at - back[at]
        where.append(at)
    steps = np.concatenate([np.full(len(w), k) for k, w in enumerate(whose)])
    whose, which, where = np.concatenate(whose), np.concatenate(which), np.concatenate(where)
    order = np.lexsort((-steps, whose))
    whose, which, where = whose[order], which[order], where[order]
    place = where - whose  # byte position in text
    many = np.where(which >= 0, 1, char[np.searchsorted(heads, place)])
    ids = np.repeat(which, many)
    fallback = ids < 0
    ids[fallback] = voc.byte_ids[text[_spread(place, many)[fallback]]]
    return ids.astype(np.int32), np.bincount(np.repeat(whose, many), minlength=len(chunks))


class Encoder:
    """Encodes slices of texts; remembers the pieces of up to ``remembered`` chunks."""

    def __init__(self, voc: Vocabulary, remembered: int = REMEMBERED) -> None:
        self.voc, self.remembered = voc, remembered
        self.split = re.compile(voc.chunk.encode()).findall
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). A space is put before a text that is not empty."""
        parts = [self.split(b" " + t) if t else [] for t in texts]
        new = list({c for p in parts for c in p if c not in self.known})
        if len(self.known) + len(new) > self.remembered:
            self._forget()
            new = list({c for p in parts for c in p})
        if new:
            ids, count = encode_chunks(self.voc, new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, ids])
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        chunk = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, sizes.sum())
        per_chunk = self.count[chunk]
        total = np.concatenate([[0], np.cumsum(per_chunk)])
        ends = np.cumsum(sizes)
        return self.ids[_spread(self.start[chunk], per_chunk)], total[ends] - total[ends - sizes]


def decode(voc: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The texts of ids: pieces put together, bytes for byte pieces, a space for each marker,
    without the space put before the text."""
    lengths = voc.offsets[ids + 1] - voc.offsets[ids]
    data = voc.flat[_spread(voc.offsets[ids], lengths)].tobytes()
    total = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.cumsum(counts)
    return [data[a + 1:b] for a, b in zip(total[ends - counts], total[ends])]


def _encode(voc: Vocabulary, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc)
        for batch in batches:
            for part, texts in slices([batch], batch.schema.names[text_at]):
                ids, counts = encoder(texts)
                same = [a == b for a, b in zip(decode(voc, ids, counts), texts)]
                bytes_used = np.add.reduceat(np.concatenate([np.isin(ids, voc.byte_ids), [False]]),
                                             np.cumsum(counts) - counts, dtype=np.int64) * (counts > 0)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns = [part.column(i) for i in range(part.num_columns) if i != text_at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(counts),
                     pa.array(bytes_used), pa.array(same)],
                    [*(n for i, n in enumerate(batch.schema.names) if i != text_at), "ids", "n_ids", "n_byte_ids", "round_trip"])
    return run


def encode(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), model: str = MODEL) -> DataFrame:
    """The ``keep`` columns of every row with ids (array<int>), n_ids, n_byte_ids (bigint) and
    round_trip (decoding the ids gives the text back, byte for byte).

    Null and empty texts have no ids. A marker character in a text is encoded as bytes, so it does
    not turn into a space. Repeated rows are encoded alike; other columns are not read; an empty
    table gives an empty one. A kept column may not be named like a result.
    """
    voc = load(model)
    taken = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1])
    return taken.mapInArrow(_encode(voc, len(keep)), f"{types}, ids array<int>, n_ids bigint, n_byte_ids bigint, round_trip boolean")


def _decode(voc: Vocabulary, id_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(id_at).to_pylist()
                counts = np.array([len(x or ()) for x in lists], np.int64)
                ids = np.fromiter((i for x in lists for i in x or ()), np.int64, counts.sum())
                texts = pa.array([t.decode("utf-8", "replace") for t in decode(voc, ids, counts)], pa.string())
                yield part.set_column(id_at, "text", texts)
    return run


def decode_table(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``encoded`` with its ids column replaced by ``text``; null ids give an empty text."""
    at = encoded.columns.index(ids_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" if i != at else "text string"
                      for i, f in enumerate(encoded.schema.fields))
    return encoded.mapInArrow(_decode(load(model), at), types)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return encode(table(spark, sf_dir, "documents"))
