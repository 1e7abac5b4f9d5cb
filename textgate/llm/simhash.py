"""SimHash near-dedup by fuzzy hashing with the Golay code.

A fingerprint's 64 bits are read as three segments of 23, 23 and 18 bits (the last one padded).
The [23,12,7] Golay code is perfect: every 23-bit word has one codeword within 3 bits. A segment's
keys are the indices of that codeword and, when it lies exactly 3 bits away, of the 5 codewords 4
bits away. Two words that differ in one bit at most always share a key.

Two fingerprints at 3 bits or fewer spread them over three segments: either one segment is equal
and another differs in one bit at most, or each differs in exactly one bit, and then one half of
the last segment is equal. So they share one of these composite keys:

* segment X as it is, with a Golay key of segment Y (six ordered pairs X, Y);
* a Golay key of the first and one of the second segment, with one half of the third (two).

Each has 30 bits at least, so unrelated fingerprints hardly ever meet. Equal keys are joined by a
sorted shuffle and every pair found is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.llm.components import components
from textgate.llm.texts import slices, tokens
from textgate.session import materialise

#: The Golay code's generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1, its length
#: and the length of its remainder.
GENERATOR, LENGTH, CHECK_BITS = 0b110001110101, 23, 11
#: The bit distance that the keys are complete for.
MAX_BITS = 3
SEED = 42
_LANES = np.uint64(0x0101010101010101)


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder of each 12-bit message, nearest error of each syndrome, the errors of 4 bits)."""
    def remainder(word: int) -> int:
        for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - CHECK_BITS)
        return word

    message = np.array([remainder(m << CHECK_BITS) for m in range(1 << 12)], dtype=np.int64)
    one_bit = [remainder(1 << i) for i in range(LENGTH)]
    near, four = np.zeros(1 << CHECK_BITS, np.int64), [[] for _ in range(1 << CHECK_BITS)]
    for n in range(1, 5):
        for bits in combinations(range(LENGTH), n):
            s, word = 0, 0
            for i in bits:
                s, word = s ^ one_bit[i], word | 1 << i
            if n < 4:
                near[s] = word
            else:
                four[s].append(word)
    return message, near, np.array([x or [-1] * 5 for x in four], dtype=np.int64)


def golay_keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices near each 23-bit word; -1 where a word has only one key."""
    message, near, four = golay_tables()
    syndrome = message[words >> CHECK_BITS] ^ (words & ((1 << CHECK_BITS) - 1))
    out = np.empty((len(words), 6), np.int64)
    out[:, 0] = (words ^ near[syndrome]) >> CHECK_BITS
    out[:, 1:] = np.where(four[syndrome] < 0, -1, (words[:, None] ^ four[syndrome]) >> CHECK_BITS)
    return out


def composite_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``prints``, key): all composite keys of uint64 fingerprints."""
    parts = [(prints >> np.uint64(41)).astype(np.int64), ((prints >> np.uint64(18)) & np.uint64((1 << 23) - 1)).astype(np.int64),
             (prints & np.uint64((1 << 18) - 1)).astype(np.int64)]
    fuzzy = [golay_keys(p) for p in parts]
    where, keys, kind = [], [], 0

    def put(exact: np.ndarray, code: np.ndarray, valid: np.ndarray) -> None:
        nonlocal kind
        i, j = np.nonzero(valid)
        where.append(i)
        keys.append(kind << 58 | exact[i] << 24 | code[i, j])
        kind += 1

    for x in range(3):
        for y in range(3):
            if x != y:
                put(parts[x], fuzzy[y], fuzzy[y] >= 0)
    both = (fuzzy[0][:, :, None] << 12 | fuzzy[1][:, None, :]).reshape(len(prints), 36)
    valid = ((fuzzy[0] >= 0)[:, :, None] & (fuzzy[1] >= 0)[:, None, :]).reshape(len(prints), 36)
    put(parts[2] >> 9, both, valid)
    put(parts[2] & 511, both, valid)
    return np.concatenate(where), np.concatenate(keys)


def fingerprints(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """uint64 SimHash of each text: bit b is 1 if it is set in over half of the XXH64 of its
    shingles (repeats included). A text of fewer words is one shingle, one of none is 0."""
    hashes, starts, docs, at = [], [], [], 0
    for i, text in enumerate(texts):
        words = tokens(text)
        if not words:
            continue
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64))
        starts.append(at)
        docs.append(i)
        at += len(hashes[-1])
    out = np.zeros(len(texts), np.uint64)
    if not docs:
        return out
    h = np.concatenate(hashes)
    sizes = np.diff([*starts, at])
    # bits are counted 8 at a time in the bytes of a word, over runs of 255 hashes at most
    runs = np.concatenate([np.arange(s, s + n, 255) for s, n in zip(starts, sizes)])
    first_run = np.concatenate([[0], np.cumsum(-(-sizes // 255))[:-1]])
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & _LANES, runs).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes, first_run, axis=0, dtype=np.int64)
        for byte in range(8):
            out[docs] |= (2 * counts[:, byte] > sizes).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            prints = pa.array(fingerprints(texts, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), prints], ["id", "text_hash", "print"])
    return run


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 4096):
            part = prints[at:at + 4096]
            i, keys = composite_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[i])], ["key", "print"])


def linked_groups(prints: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(a member, the others) of each set of ``prints`` connected by links of ``most`` bits.

    Breadth first; a print found is not compared again, so a set of n near copies costs about n
    vectorised steps' worth of work in O(n) memory and gives n - 1 edges, not all its pairs.
    """
    rest = prints.view(np.uint64)
    while len(rest) > 1:
        seed, rest, front, found = rest[0], rest[1:], rest[:1], []
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for f in front[:64]:
                hit |= np.bitwise_count(rest ^ f) <= most
            new, rest = rest[hit], rest[~hit]
            found.append(new)
            front = np.concatenate([front[64:], new])
        found = np.concatenate(found) if found else rest[:0]
        if len(found):
            yield int(seed.astype(np.int64)), found.view(np.int64)


def _link_batches(most: int):
    """Edges of rows (key, print) sorted by key: verified links inside a key, as a forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}  # of the linked prints this task has seen

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(p, p)
            return x

        def edges(prints: np.ndarray) -> Iterator[tuple[int, int]]:
            for seed, others in linked_groups(prints, most):
                for other in others.tolist():
                    a, b = root(seed), root(other)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        yield seed, other

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

        open_key, held = None, []  # the last key's prints; it may go on in the next batch
        for batch in batches:
            keys, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            found: list[tuple[int, int]] = []
            if open_key is not None and keys[0] != open_key:
                found += edges(np.concatenate(held))
                held = []
            if len(starts) == 2:
                held.append(prints)
            else:
                found += edges(np.concatenate([*held, prints[:starts[1]]]))
                for s in np.flatnonzero(np.diff(starts[1:-1]) > 1) + 1:
                    found += edges(prints[starts[s]:starts[s + 1]])
                held = [prints[starts[-2]:]]
            open_key = keys[-1]
            if found:
                yield out(found)
        if held and (found := list(edges(np.concatenate(held)))):
            yield out(found)
    return run


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   most: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text_hash (Spark's xxhash64 of the text), print
    (bigint, the fingerprint's bits), component_id, root (a fingerprint of the group, the same for
    all its rows and of no other group).

    component_id is the smallest id reachable by links of ``most`` bits (3 at most). Texts with no
    word have fingerprint 0 and are linked like any other; null texts are empty ones. Null ids are
    larger than any other: a group of them only has component_id null. Repeated rows stay, in one
    group. Other columns are not read. An empty table gives an empty one.

    Copies fall together as one fingerprint before any key is made. A fingerprint makes 22 to 90
    keys of 16 bytes; a key's distinct fingerprints are held by one task, as 8 bytes each.
    """
    if not 0 <= most <= MAX_BITS:
        raise ValueError(f"the keys are complete for up to {MAX_BITS} bits, not {most}")
    id_type = docs.schema[id_col].dataType.simpleString()
    prints = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")) \
        .mapInArrow(_fingerprint_batches(shingle), f"id {id_type}, text_hash bigint, print bigint")
    prints = materialise(prints, "fingerprints")
    reps = materialise(prints.groupBy("print").agg(F.min("id").alias("rep")), "representatives")
    keys = reps.select("print").mapInArrow(_key_batches, "key bigint, print bigint")
    edges = keys.repartition("key").sortWithinPartitions("key").mapInArrow(_link_batches(most), "u bigint, v bigint")
    linked = components(edges).withColumnsRenamed({"node": "print", "component": "root"})
    linked = linked.join(reps, "print")
    names = linked.groupBy("root").agg(F.min("rep").alias("smallest"))
    named = linked.join(names, "root").select("print", "smallest", "root")
    groups = materialise(reps.join(named, "print", "left").select(
        "print", F.coalesce("smallest", "rep").alias("component_id"), F.coalesce("root", "print").alias("root")), "groups")
    return prints.join(groups, "print").select(F.col("id").alias(id_col), "text_hash", "print", "component_id", "root")


def keep_smallest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  most: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``simhash_groups`` has first in their group: the one
    with the smallest id (then text_hash; null ids last). Rows that repeat its id and text stay too.
    Groups are told apart by their root, as unrelated ones may share an id or have null ids only."""
    groups = simhash_groups(docs, id_col, text_col, shingle, most)
    first = groups.groupBy("root").agg(F.min(F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("text_hash").alias("hash"))).alias("k"))
    kept = materialise(first.select(F.col("k.id").alias("_keep_id"), F.col("k.hash").alias("_keep_hash")), "kept")
    same = docs[id_col].eqNullSafe(kept["_keep_id"]) & (F.xxhash64(docs[text_col]) == kept["_keep_hash"])
    return docs.join(kept, same, "left_semi")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
