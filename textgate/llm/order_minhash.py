"""Document fingerprints by Order MinHash: sketches that follow edit distance.

A text's k-mers (k code points) are numbered by occurrence, so a repeated one counts as often as
it stands there. For each of several hash functions the few numbered k-mers with the smallest
hashes are selected and put back into the order of the text; the hash of that tuple of k-mers is
one component. Two texts agree in a component only if the same k-mers were selected and stand in the
same order, so moved passages lower the likeness that plain MinHash would not notice.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.session import materialise

#: Code points of a k-mer, components of a fingerprint, k-mers of a tuple, hex digits of a component.
K, COMPONENTS, TUPLE, DIGITS = 10, 64, 2, 4
#: k-mers whose hashes are compared in one go (a row of the table below), and padding past the last
#: code point there is, for texts of fewer than K.
LANE, PAD = 64, 0x110000
#: UTF-8 bytes that a sorted bucket of texts is sized for, most buckets, and keys sampled for each.
BUCKET_BYTES, MOST_BUCKETS, PER_BUCKET = 32 << 20, 10_000, 20
#: k-mers of texts that are sketched together.
TOGETHER = 1 << 18
_ODD = [int(xxhash.xxh64_intdigest(b"odd", i)) | 1 for i in range(8)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_ODD[1])
    return x ^ (x >> np.uint64(32))


def _kmers(points: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the ``k`` code points from each position on (the last k - 1 mean nothing)."""
    power, width, out, done = _mix(points.astype(np.uint64) + np.uint64(_ODD[2])), 1, None, 0
    while k >> width.bit_length() - 1:
        if k & width:
            part = power[done:]
            out = part.copy() if out is None else out[:len(part)] * np.uint64(_ODD[3]) + part
            done += width
        longer = power[:-width] * np.uint64(_ODD[4] + 2 * width) + power[width:] if len(power) > width else power[:0]
        power, width = longer, 2 * width
    return _mix(out)


def _occurrences(kmers: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How many times each k-mer stood in its text before."""
    keys = kmers + _mix(text.astype(np.uint64) + np.uint64(_ODD[5]))
    # most k-mers occur once: only those whose slot in a small table is shared are sorted
    bits = max(8, int(len(keys)).bit_length() + 2)
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    shared = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    out = np.zeros(len(keys), np.uint64)
    some = keys[shared]
    order = np.argsort(some, kind="stable")
    some = some[order]
    first = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]])) if len(some) else order
    out[shared[order]] = np.arange(len(some)) - np.repeat(first, np.diff(np.concatenate([first, [len(some)]])))
    return out


def _together(texts: list[str], k: int, components: int, size: int) -> np.ndarray:
    """(texts, components) of texts that are not empty."""
    lengths = np.array([max(len(t), k) for t in texts])
    points = np.concatenate([np.frombuffer(t.encode("utf-32-le"), np.uint32) if len(t) >= k else np.array(
        [*map(ord, t), *[PAD] * (k - len(t))], np.uint32) for t in texts])
    counts = lengths - k + 1
    of = np.repeat(np.arange(len(texts)), counts)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    kmers = _kmers(points, k)[inside + np.repeat(np.cumsum(lengths) - lengths, counts)]
    numbered = (_mix(kmers + _occurrences(kmers, of) * np.uint64(_ODD[6])) >> np.uint64(32)).astype(np.uint32)
    # every text starts a row of the table; the rest of its last row never has the smallest hash
    rows = -(-counts // LANE)
    starts = np.cumsum(rows) - rows
    place = inside + np.repeat(starts * LANE, counts)
    total = int(rows.sum())
    x, used = np.zeros(total * LANE, np.uint32), np.zeros(total * LANE, bool)
    x[place], used[place] = numbered, True
    base = np.zeros(total * LANE, np.uint64)
    base[place] = kmers
    x, spare = x.reshape(total, LANE), np.flatnonzero(~used)
    worst, y = np.uint32(0xFFFFFFFF), np.empty((total, LANE), np.uint32)
    out = np.empty((len(texts), components), np.uint64)
    row_of = np.repeat(np.arange(len(texts)), rows)
    every = np.arange(len(texts))
    for j in range(components):
        seed = xxhash.xxh64_intdigest(b"function", j)
        np.bitwise_xor(x, np.uint32(seed >> 32), out=y)
        np.multiply(y, np.uint32(seed & 0xFFFFFFFF | 1), out=y)
        y.ravel()[spare] = worst
        best = y.min(1)
        chosen = np.empty((size, len(texts)), np.int64)
        for n in range(size):
            least = np.minimum.reduceat(best, starts)
            hit = np.flatnonzero(best == least[row_of])
            row = hit[np.searchsorted(row_of[hit], every)]  # the first row that has it
            lane = y[row].argmin(1)
            # a text of fewer k-mers than the tuple has fewer in it
            chosen[n] = np.where(n < counts, row * LANE + lane, -1)
            y[row, lane] = worst
            best[row] = y[row].min(1)
        chosen.sort(0)
        value = np.full(len(texts), _ODD[7], np.uint64)
        for n in range(size):
            value = np.where(chosen[n] < 0, value, _mix(value + base[chosen[n]]))
        out[:, j] = value
    return out


def sketches(texts: list[str], k: int = K, components: int = COMPONENTS, size: int = TUPLE, digits: int = DIGITS) -> np.ndarray:
    """(texts, components) of ``digits`` hex digits each, in uint64. Texts of fewer than ``k`` code
    points are one k-mer; empty ones have components 0, which others do not."""
    out = np.zeros((len(texts), components), np.uint64)
    filled = [i for i, t in enumerate(texts) if t]
    at = 0
    while at < len(filled):
        to, n = at, 0
        while to < len(filled) and (to == at or n + len(texts[filled[to]]) <= TOGETHER):
            n += len(texts[filled[to]])
            to += 1
        here = filled[at:to]
        values = _together([texts[i] for i in here], k, components, size)
        top = np.uint64(16 ** digits - 1)
        out[here] = (values >> np.uint64(1)) % top + np.uint64(1)
        at = to
    return out


def hexed(sketch: np.ndarray, digits: int = DIGITS) -> list[str]:
    """Each row as a string of ``digits`` hex digits a component."""
    raw = sketch.astype(">u8").view(np.uint8).reshape(len(sketch), -1, 8)
    if digits % 2 == 0:
        return [r.tobytes().hex() for r in np.ascontiguousarray(raw[:, :, 8 - digits // 2:])]
    return ["".join(f"{int(c):0{digits}x}" for c in row) for row in sketch]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal components, row by row."""
    return (a == b).mean(1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, components: int = COMPONENTS,
                 size: int = TUPLE) -> DataFrame:
    """``id_col``, n_chars, fingerprint of each row: ``components`` of ``DIGITS`` hex digits. Null texts
    are empty; rows are neither dropped nor moved; other columns are not read. A text and its k-mers,
    some 60 bytes a code point, are in memory at once."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch, 1):
                prints = hexed(sketches(texts, k, components, size))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints)],
                                                 ["id", "n_chars", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")) \
        .mapInArrow(run, f"id {id_type}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def _parts(batch: pa.RecordBatch, column: int, rows: int = 512, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch in parts of at most ``rows`` rows and about ``size`` code points of text."""
    at = 0
    while at < batch.num_rows:
        texts, n, to = [], 0, at
        while to < batch.num_rows and len(texts) < rows and (n < size or to == at):
            texts.append(batch.column(column)[to].as_py())
            n += len(texts[-1])
            to += 1
        yield batch.slice(at, to - at), texts
        at = to


def _spread(first: tuple, bounds: list[tuple]):
    """Rows (id, hash, text) to (bucket, tail, id, hash, copies, packed): rows of a batch that are equal
    become one, and the first row of a bucket also goes to the end of the bucket before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part, texts in _parts(batch, 2):
                seen: dict[tuple, int] = {}
                for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    seen[row] = seen.get(row, 0) + 1
                out = []
                for (id_, h, text), copies in seen.items():
                    key = (id_ is not None, id_, h)
                    bucket = len(bounds) - bisect_left(bounds, key)
                    packed = pack(text.encode())
                    out.append((bucket, False, id_, h, copies, packed))
                    if bucket and bounds[len(bounds) - bucket] == key:
                        out.append((bucket - 1, True, id_, h, 1, packed))
                    if key == first:
                        out.append((len(bounds), True, id_, h, 1, packed))
                types = (pa.int32(), pa.bool_(), part.column(0).type, pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 ["bucket", "tail", "id", "hash", "copies", "packed"])
    return run


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _neighbours(id_type: pa.DataType, k: int, components: int, size: int):
    """Sorted rows of ``_spread`` to result rows. Only the last row of a part is carried on."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def results(rows: list[tuple], texts: list[str], prints: np.ndarray) -> pa.RecordBatch:
        # (place, place of the next, rows like it): the copies of a row are each other's next but for the last
        pairs = []
        for i in range(len(rows) - 1):
            bucket, tail, _, _, copies, _ = rows[i]
            if tail:
                continue
            if copies > 1:
                pairs.append((i, i, copies - 1))
            if rows[i + 1][0] == bucket:
                pairs.append((i, i + 1, 1))
        own, other, times = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        changed = [_edited(texts[i], texts[j]) for i, j in zip(own, other)]
        after = sketches(changed, k, components, size)
        mine = prints[own]
        each = pa.array(np.repeat(np.arange(len(own)), times))
        text_print = hexed(mine)
        columns = [pa.array([rows[i][2] for i in own], id_type), pa.array([len(texts[i]) for i in own], pa.int64()),
                   pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()), pa.array(text_print, pa.string()),
                   pa.array(hexed(after), pa.string()), pa.array(likeness(mine, after)), pa.array(likeness(mine, prints[other]))]
        return pa.RecordBatch.from_arrays([c.take(each) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        rows, texts, prints = [], [], np.zeros((0, components), np.uint64)
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows, texts, prints, waiting
            prints = np.concatenate([prints, sketches(texts[len(prints):], k, components, size)])
            out = results(rows, texts, prints)
            rows, texts, prints, waiting = rows[-1:], texts[-1:], prints[-1:], 0
            for at in range(0, out.num_rows, 10_000):
                yield out.slice(at, 10_000)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5)):
                text = unpack(row[5].as_py()).decode()
                last = rows[-1] if rows else None
                if last and last[:4] == row[:4] and texts[-1] == text:
                    rows[-1] = (*last[:4], last[4] + row[4], None)
                    continue
                # a full part ends before a new row, when all copies of the last one are known
                if len(rows) > 512 or waiting > 1 << 20:
                    yield from flush()
                rows.append((*row[:5], None))
                texts.append(text)
                waiting += len(text)
        if len(rows) > 1:
            yield from flush()
    return run


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, components: int = COMPONENTS,
                        size: int = TUPLE) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Documents follow each other by falling id, null ids last, then by falling xxhash64 of the text;
    after the last comes the first. The edited text has its last floor(n_chars / 2) code points replaced
    by the first as many (or all) of the next document. Null texts are empty. Rows equal in id
    and text follow each other. A document alone follows itself; an empty table gives an
    empty one. Other columns are not read.

    Texts move once, packed, to buckets of following ids; the bounds of the buckets are rows of the
    table, so the row that a bucket needs from the next one is known to be that bound and is sent to
    both. Keys alone are read for the bounds, at most 10,000 buckets times 20. Equal rows
    are added up before they move, so a repeated row is no hot bucket. A text and its k-mers, some 60
    bytes a code point, are in memory at once.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    keys = materialise(source.select("id", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size")), "keys")
    key = F.struct(F.col("id").isNotNull().alias("known"), "id", "hash")
    total, n, first = keys.agg(F.sum("size"), F.count("*"), F.max(key)).first()
    buckets = max(1, min(MOST_BUCKETS, -(-(total or 0) // BUCKET_BYTES)))
    bounds: list[tuple] = []
    if buckets > 1:
        # a share of the distinct keys, by hash
        share = max(1, n // (buckets * PER_BUCKET))
        sampled = keys.filter(F.pmod(F.xxhash64("hash", "id"), F.lit(share)) == 0).select("id", "hash").distinct()
        found = sorted((r["id"] is not None, r["id"], r["hash"]) for r in sampled.collect())
        bounds = sorted({found[i * len(found) // buckets] for i in range(1, buckets)} - {tuple(first)}) if found else []
    spread = source.select("id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
        _spread(tuple(first) if first else (), bounds), f"bucket int, tail boolean, id {id_type}, hash long, copies long, packed binary")
    placed = spread.repartitionById(len(bounds) + 1, "bucket").sortWithinPartitions(
        "bucket", "tail", F.col("id").desc_nulls_last(), F.col("hash").desc())
    out = placed.mapInArrow(
        _neighbours(_arrow_type(id_type), k, components, size),
        f"id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)


def _arrow_type(simple: str) -> pa.DataType:
    """The Arrow type of an id column's Spark type."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(simple))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return edited_fingerprints(table(spark, sf_dir, "documents"))
