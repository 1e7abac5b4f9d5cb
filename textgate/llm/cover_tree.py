"""Exact cosine-threshold pairs by dual traversal of cover trees.

Unit vectors with cosine c lie sqrt(2 - 2c) apart. A cover tree has nested levels: a node's
centre stays a centre below it, and its children's centres lie half as far from their points as
the level above. Each node also keeps the exact distance to its furthest point. Walking two trees
at once, a pair of nodes is dropped when its centres are further apart than both radii and the
threshold; it is taken whole when all its points must be within it; else it is opened.

The vectors are first put into cells (nearest of some sampled centres) and the cells cut into
blocks of bounded size; the pairs of blocks that the same bounds leave are joined, each pair in a
task of its own. A vector goes only to the blocks that it may have a partner in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.llm.components import components
from textgate.session import materialise

#: Vectors that a block is sized for, and cells at most (their centres go to every task).
BLOCK, CELLS = 6000, 512
#: Points up to which a node among many is not bounded but opened at once.
FEW = 8
#: Slack for rounding in bounds, in double and in single precision; pairs that the bounds do not
#: decide are compared by their cosine in double precision.
SLACK, COARSE = 1e-9, 1e-5


@dataclass
class Level:
    """Nodes of one level: centres (indices of points), radii, and each node's children below."""

    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    count: np.ndarray


@dataclass
class CoverTree:
    points: np.ndarray
    coarse: np.ndarray  # the points in single precision, for bounds
    order: np.ndarray  # points, so that every node's are next to each other
    levels: list[Level]
    span: list[tuple[np.ndarray, np.ndarray]]  # per level: where a node's points start in order, how many


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _net(points: np.ndarray, members: np.ndarray, radius: float, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(centres, for each member the place of its centre): centres lie more than ``radius`` apart
    and members at most that from theirs, as far as the points' precision goes (the nodes' own
    radii are measured later). The first member is a centre."""
    least = 1 - radius * radius / 2  # of the cosine, within the radius
    centres, own = np.empty(len(members), np.int64), np.zeros(len(members), np.int64)
    matrix, n = np.empty((len(members), points.shape[1]), points.dtype), 1
    centres[0], matrix[0] = members[0], points[members[0]]
    for at in range(0, len(members), block):
        part = points[members[at:at + block]]
        cos = part @ matrix[:n].T
        near = cos.argmax(1)
        own[at:at + block] = near
        todo = np.flatnonzero(cos[np.arange(len(part)), near] < least)
        close = part[todo] @ part[todo].T >= least
        np.fill_diagonal(close, True)
        alone = close.sum(1) == 1
        order = np.concatenate([np.flatnonzero(alone), np.flatnonzero(~alone)])
        open_ = ~alone
        new = np.flatnonzero(alone).tolist()
        own[at + todo[new]] = n + np.arange(len(new))
        for k in order[len(new):].tolist():
            if open_[k]:
                covered = open_ & close[k]
                own[at + todo[covered]] = n + len(new)
                new.append(k)
                open_ &= ~covered
        centres[n:n + len(new)], matrix[n:n + len(new)] = members[at + todo[new]], part[todo[new]]
        n += len(new)
    return centres[:n], own


def build(points: np.ndarray, smallest: float) -> CoverTree:
    """The tree of unit vectors down to covering radius ``smallest`` or single points."""
    order, radius = np.arange(len(points)), 2.0
    centre, start, size = np.array([0]), np.array([0]), np.array([len(points)])
    tree = CoverTree(points, points.astype(np.float32), order, [], [])
    while True:
        far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", points[order], points[np.repeat(centre, size)]), 0))
        level = Level(centre, np.maximum.reduceat(far, start), np.zeros(len(centre), np.int64), np.zeros(len(centre), np.int64))
        level.radius[size == 1] = 0  # the distance of a point to itself may round to something else
        tree.levels.append(level)
        tree.span.append((start, size))
        radius /= 2
        if radius < smallest or (size == 1).all():
            return tree
        wide = (size > 1) & (level.radius > radius)
        below = [(centre[~wide], start[~wide], size[~wide])]
        for c, s, n in zip(centre[wide].tolist(), start[wide].tolist(), size[wide].tolist()):
            members = order[s:s + n]
            members = np.concatenate([[c], members[members != c]])  # the centre stays one
            centres, own = _net(tree.coarse, members, radius)
            order[s:s + n] = members[np.argsort(own, kind="stable")]
            sizes = np.bincount(own, minlength=len(centres))
            below.append((centres, s + np.cumsum(sizes) - sizes, sizes))
        # nodes are in the order of their points, so a node's children are next to each other
        centre, below_start, below_size = (np.concatenate(x) for x in zip(*below))
        by = np.argsort(below_start)
        level.first[:] = np.searchsorted(below_start[by], start)
        level.count[:] = np.searchsorted(below_start[by], start + size) - level.first
        centre, start, size = centre[by], below_start[by], below_size[by]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def dual_traversal(a: CoverTree, b: CoverTree, threshold: float, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a's points, into b's) whose cosine is ``threshold`` or more, piece by
    piece; every such pair once. With b the same tree, pairs come both ways, equal ones included."""
    reach = np.sqrt(2 - 2 * threshold)

    def bounded(da: int, ia: np.ndarray, db: int, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        la, lb = a.levels[da], b.levels[db]
        d = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", a.points[la.centre[ia]], b.points[lb.centre[ib]]), 0))
        both = la.radius[ia] + lb.radius[ib]
        return d <= both + reach + SLACK, d + both <= reach - SLACK

    def leaves(da: int, ia: np.ndarray, db: int, ib: np.ndarray, check: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        (sa, na), (sb, nb) = a.span[da], b.span[db]
        for i, j in zip(ia, ib):
            left, right = a.order[sa[i]:sa[i] + na[i]], b.order[sb[j]:sb[j] + nb[j]]
            rows = max(1, chunk // len(right))
            for at in range(0, len(left), rows):
                if check:
                    x, y = np.nonzero(a.points[left[at:at + rows]] @ b.points[right].T >= threshold)
                else:
                    x, y = (g.ravel() for g in np.meshgrid(np.arange(len(left[at:at + rows])), np.arange(len(right)), indexing="ij"))
                if len(x):
                    yield left[at + x], right[y]

    def singles(da: int, ia: np.ndarray, db: int, ib: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x, y = a.order[a.span[da][0][ia]], b.order[b.span[db][0][ib]]
        keep = np.einsum("ij,ij->i", a.points[x], b.points[y]) >= threshold
        if keep.any():
            yield x[keep], y[keep]

    def points(da: int, ia: np.ndarray, db: int, ib: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x, y = a.order[_spread(a.span[da][0][ia], a.span[da][1][ia])], b.order[_spread(b.span[db][0][ib], b.span[db][1][ib])]
        right = b.coarse[y].T
        rows = max(1, 4 * chunk // max(1, len(y)))
        for at in range(0, len(x), rows):
            i, j = np.nonzero(a.coarse[x[at:at + rows]] @ right >= threshold - COARSE)
            i, j = x[at + i], y[j]
            keep = np.einsum("ij,ij->i", a.points[i], b.points[j]) >= threshold
            if keep.any():
                yield i[keep], j[keep]

    stack = [(0, np.array([0]), np.array([0]))]
    while stack:
        depth, ia, ib = stack.pop()
        da, db = min(depth, len(a.levels) - 1), min(depth, len(b.levels) - 1)
        near, whole = bounded(da, ia, db, ib)
        yield from leaves(da, ia[whole], db, ib[whole], False)
        ia, ib = ia[near & ~whole], ib[near & ~whole]
        one = (a.span[da][1][ia] == 1) & (b.span[db][1][ib] == 1)
        yield from singles(da, ia[one], db, ib[one])
        ia, ib = ia[~one], ib[~one]
        if not len(ia):
            continue
        if da == len(a.levels) - 1 and db == len(b.levels) - 1:
            yield from leaves(da, ia, db, ib, True)
            continue
        la, lb = a.levels[da], b.levels[db]
        fa, ca = (la.first[ia], la.count[ia]) if da < len(a.levels) - 1 else (ia, np.ones(len(ia), np.int64))
        fb, cb = (lb.first[ib], lb.count[ib]) if db < len(b.levels) - 1 else (ib, np.ones(len(ib), np.int64))
        na, nb = min(depth + 1, len(a.levels) - 1), min(depth + 1, len(b.levels) - 1)
        # children of a wide pair of nodes are met by matrix products, the others as a list
        wide = ca * cb > 4096
        for k in np.flatnonzero(wide):
            xa, xb = np.arange(fa[k], fa[k] + ca[k]), np.arange(fb[k], fb[k] + cb[k])
            few_a, few_b = a.span[na][1][xa] <= FEW, b.span[nb][1][xb] <= FEW
            yield from points(na, xa[few_a], nb, xb[few_b])
            for some_a, some_b in ((xa[~few_a], xb), (xa[few_a], xb[~few_b])):
                if not len(some_a) or not len(some_b):
                    continue
                right, radius = b.coarse[b.levels[nb].centre[some_b]].T, b.levels[nb].radius[some_b] + reach
                rows = max(1, 4 * chunk // len(some_b))
                for at in range(0, len(some_a), rows):
                    part = some_a[at:at + rows]
                    # d <= far as 2 - 2 cos <= far squared
                    far = (a.levels[na].radius[part][:, None] + radius).astype(np.float32)
                    x, y = np.nonzero(a.coarse[a.levels[na].centre[part]] @ right >= 1 - far * far / 2 - COARSE)
                    if len(x):
                        stack.append((depth + 1, part[x], some_b[y]))
        ia, ib, fa, ca, fb, cb = (v[~wide] for v in (ia, ib, fa, ca, fb, cb))
        each = np.cumsum(ca * cb)
        at = 0
        while at < len(ia):
            to = max(at + 1, int(np.searchsorted(each, (each[at - 1] if at else 0) + chunk)))
            n = (ca * cb)[at:to]
            place = _spread(np.zeros(to - at, np.int64), n)
            width = np.repeat(cb[at:to], n)
            stack.append((depth + 1, np.repeat(fa[at:to], n) + place // width, np.repeat(fb[at:to], n) + place % width))
            at = to


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``label`` after joining the sets of x[i] and y[i]; a set's label is its smallest point."""
    low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
    apart = low != high
    if not apart.any():
        return label
    parent: dict[int, int] = {}

    def root(k: int) -> int:
        while (up := parent.get(k, k)) != k:
            k = up
        return k

    for k in np.unique(low[apart] * len(label) + high[apart]).tolist():
        i, j = sorted((root(k // len(label)), root(k % len(label))))
        parent[j] = i
    to = np.arange(len(label))
    for k in parent:
        to[k] = root(k)
    return to[label]


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, unit vector as bytes of doubles; null where it links with nothing)."""
    for batch in batches:
        out = []
        for v in batch.column(1).to_pylist():
            v = None if v is None or any(x is None for x in v) else np.array(v, float)
            top = np.abs(v).max() if v is not None and len(v) else 0
            if v is None or not np.isfinite(v).all() or not top:
                out.append(None)
            else:
                v = v / top  # squares of very large or small components stay finite
                out.append((v / np.sqrt(v @ v)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "unit"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), -1)


def _nearest(centres: np.ndarray):
    """Each vector's nearest centre (its cell) and its distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                d = _distances(_matrix(part.column("unit")), centres)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("weight"), part.column("unit"), pa.array(cell),
                                                  pa.array(d[np.arange(len(cell)), cell])], ["key", "weight", "unit", "cell", "distance"])
    return run


def _to_pairs(centres: np.ndarray, radius: np.ndarray, blocks: np.ndarray, reach: float):
    """A row for each pair of blocks that a vector may have a partner in.

    The vector goes to a cell if it lies within that cell's radius and the threshold, and not
    further from the plane half way between the two centres than the threshold.
    """
    first = np.concatenate([[0], np.cumsum(blocks)])
    gap = _distances(centres, centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, cell = _matrix(part.column("unit")), part.column("cell").to_numpy()
                block = first[cell] + part.column("sub").to_numpy()
                d = _distances(x, centres)
                own = d[np.arange(len(cell)), cell]
                beyond = (d ** 2 - own[:, None] ** 2) / np.maximum(2 * gap[cell], 1e-6)
                go = (d <= radius + reach + 1e-6) & (beyond <= reach + 1e-6)
                go[np.arange(len(cell)), cell] = True
                i, c = np.nonzero(go)
                n = blocks[c]
                i, other = np.repeat(i, n), _spread(first[c], n)
                pair = np.minimum(block[i], other) << 32 | np.maximum(block[i], other)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(block[i]), *(part.column(k).take(pa.array(i)) for k in ("key", "weight", "unit"))],
                                                 ["pair", "block", "key", "weight", "unit"])
    return run


def _join_pair(threshold: float):
    """Links of one pair of blocks: for each vector the weight of its partners, and its star."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key").combine_chunks()
        block, pair = table.column("block").to_numpy(), table.column("pair")[0].as_py()
        key, weight = table.column("key").to_numpy(), table.column("weight").to_numpy()
        links, label = np.zeros(len(key)), np.arange(len(key))
        sides = [np.flatnonzero(block == b) for b in (pair >> 32, pair & (1 << 32) - 1)]
        if len(sides[0]) and len(sides[1]):
            units = _matrix(table.column("unit").combine_chunks())
            smallest = np.sqrt(2 - 2 * threshold) / 4
            trees = [build(units[s], smallest) for s in sides[:1 if pair >> 32 == pair & (1 << 32) - 1 else 2]]
            for x, y in dual_traversal(trees[0], trees[-1], threshold):
                x, y = sides[0][x], sides[-1][y]
                if len(trees) == 1:
                    x, y = x[x != y], y[x != y]
                else:
                    links += np.bincount(y, weight[x], len(key))
                links += np.bincount(x, weight[y], len(key))
                label = _merge(label, x, y)
        has = links > 0
        return pa.table({"key": key[has], "links": links[has].astype(np.int64), "star": key[label[has]]})
    return run


def _links(reps: DataFrame, n: int, threshold: float, block: int, cells: int) -> DataFrame:
    """(key, links, star) in parts: weights of the vectors that each of ``n`` distinct vectors of one
    length links with, and an edge to one of them."""
    sample = reps.orderBy(F.xxhash64("unit"), "key").limit(min(cells, -(-n // block))).toArrow()
    centres = _matrix(sample.column("unit").combine_chunks())
    placed = materialise(reps.select("key", "weight", "unit").mapInArrow(
        _nearest(centres), "key bigint, weight bigint, unit binary, cell bigint, distance double"), "cells")
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect()}
    radius = np.array([stats[c]["radius"] if c in stats else -10.0 for c in range(len(centres))])
    blocks = np.array([-(-stats[c]["n"] // block) if c in stats else 0 for c in range(len(centres))], np.int64)
    parts = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), (F.col("cell") + 1).cast("int"))
    pairs = placed.withColumn("sub", F.pmod(F.xxhash64("key"), parts).cast("long")) \
        .mapInArrow(_to_pairs(centres, radius, blocks, float(np.sqrt(2 - 2 * threshold))),
                    "pair bigint, block bigint, key bigint, weight bigint, unit binary")
    return pairs.groupBy("pair").applyInArrow(_join_pair(threshold), "key bigint, links bigint, star bigint")


def cosine_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                 block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, n_links (other vectors at cosine ``threshold`` or
    more, in double precision), component_id (smallest id reachable, its own included), kept.

    Equal vectors are collapsed before anything is compared and count as each other's links.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
    vectors link with those of their own length only. A null id is larger than any other: its vector
    is compared like any other, and component_id is null where a component has null ids only. An id
    that is repeated counts each of its rows. Other columns are not read; an empty table gives an
    empty one.

    The sample that gives the cells' centres has ``cells`` vectors at most; every vector is put
    into a cell and none is left out. Pairs are not written: a task adds up its vectors' links and
    gives one edge to each linked vector.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    units = materialise(source.mapInArrow(_unit, f"id {vectors.schema[id_col].dataType.simpleString()}, unit binary"), "units")
    valid = units.filter("unit IS NOT NULL")
    reps = materialise(valid.groupBy("unit").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
                       .withColumn("key", F.monotonically_increasing_id()), "vectors")
    linked = reps.select("key", F.col("weight").alias("links"), F.col("key").alias("star")).limit(0)
    for length, n in sorted((r["length"], r["count"]) for r in reps.groupBy(F.octet_length("unit").alias("length")).count().collect()):
        linked = linked.unionByName(_links(reps.filter(F.octet_length("unit") == length), n, threshold, block, cells))
    linked = materialise(linked, "links")
    total = linked.groupBy("key").agg(F.sum("links").alias("links"))
    named = components(linked, "key", "star").withColumnsRenamed({"node": "key", "component": "root"}).join(reps.select("key", "rep"), "key")
    named = named.join(named.groupBy("root").agg(F.min("rep").alias("found")), "root").select("key", "found")
    known = reps.join(total, "key", "left").join(named, "key", "left").select(
        F.col("unit").alias("_unit"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("found", "rep").alias("component"))
    known = materialise(known, "known")
    component = F.coalesce("component", "id")
    return units.join(known, units["unit"] == known["_unit"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return cosine_links(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) >= 0.9 * a.norm * b.norm AND a.norm > 0 AND b.norm > 0),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT reach.vec_id, link.w FROM reach JOIN link ON link.u = reach.other)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE u = v.vec_id) AS n_links,
       (SELECT min(other) FROM reach WHERE reach.vec_id = v.vec_id) AS component_id,
       v.vec_id = (SELECT min(other) FROM reach WHERE reach.vec_id = v.vec_id) AS kept
FROM v
"""
