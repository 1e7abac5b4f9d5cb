"""Delimited files with quoted newlines, read by many tasks.

Spark's text source cuts files into byte ranges at line ends, but whether a line starts a record or
goes on inside a quoted field depends on all lines before it. A line maps each of the two states
to the state after it, so a range does too, and such maps compose. The first scan gives each
range's map (and the first lines of each file, from which its dialect and header are known); composed
file by file they give every range's true state at its start. The second scan, which is the returned
plan, puts lines together to records range by range, and ``from_csv`` parses the records. Records
that cross a range's end are put together from their pieces beforehand; there is one at most a range.
"""

from __future__ import annotations

import csv
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.ranking import with_position
from textgate.session import materialise

#: First lines of a file that tell its dialect and header, and their characters at most.
HEAD_LINES, HEAD_CHARS = 64, 1 << 16
#: Bytes of ranges that a task reads at least, if there are enough for all cores.
TASK_BYTES = 32 << 20
Dialect = tuple[str, str]  # delimiter, quote


def ends_inside(line: str, dialect: Dialect, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, which starts inside one or at a record's start.

    A quote opens a field only as its first character; doubled, it stands for itself; behind a closed
    one everything up to the delimiter belongs to the field.
    """
    sep, quote = dialect
    if len(sep) > 1:
        return fields(line, dialect, inside)[1]
    opening, at = sep + quote, 0  # where the next quoted field opens, whatever fields stand before it
    if not inside and line.startswith(quote):
        inside, at = True, 1
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):
                at += 2
                continue
            at += 1
        at = line.find(opening, at)
        if at < 0:
            return False
        inside, at = True, at + 2


def fields(line: str, dialect: Dialect, inside: bool = False) -> tuple[int, bool]:
    """(fields that end in or with ``line``, whether the last one is open)."""
    (sep, quote), at, n = dialect, 0, 0
    while True:
        if not inside and line.startswith(quote, at):
            inside, at = True, at + 1
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return n, True
            if line.startswith(quote, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        at = line.find(sep, at)
        n += 1
        if at < 0:
            return n, False
        at += len(sep)


def blank(record: str, dialect: Dialect) -> bool:
    return not record.strip(" \r\n" if dialect[0] == "\t" else " \t\r\n")


def records(lines: Sequence[str], dialect: Dialect) -> list[str]:
    """The complete records of ``lines`` that are not blank."""
    out, held, inside = [], [], False
    for line in lines:
        held.append(line)
        inside = ends_inside(line, dialect, inside)
        if not inside:
            record = "\n".join(held).removesuffix("\r")
            out += [] if blank(record, dialect) else [record]
            held = []
    return out


def evenness(lines: Sequence[str], dialect: Dialect) -> tuple[float, int, int, int]:
    """(share of the records with as many fields as the header, their number, fields of the header,
    fields that end with a quote); zeros for a header of one field."""
    found = records(lines, dialect)
    counts = [fields(r, dialect)[0] for r in found]
    if not counts or counts[0] < 2:
        return 0.0, 0, 0, 0
    even = sum(c == counts[0] for c in counts)
    return even / len(counts), even, counts[0], sum((r + dialect[0]).count(dialect[1] + dialect[0]) for r in found)


def detect(lines: Sequence[str], dialects: Sequence[Dialect], expected: Sequence[str] = ()) -> int:
    """The dialect whose header has the ``expected`` columns and by which the first records of a file
    split most evenly; on ties the one with more records, then more fields, then more quoted ones, then
    the first. Without one that splits the header, the first."""
    def rank(i: int) -> tuple:
        first = records(lines, dialects[i])[:1]
        names = set(header_names(first[0], dialects[i])) if first else set()
        return bool(expected) and names.issuperset(expected), *evenness(lines, dialects[i]), -i

    return max(range(len(dialects)), key=rank)


def header_names(record: str, dialect: Dialect) -> list[str]:
    """Column names of a header record; empty ones are called by place, repeated ones get it added."""
    names = next(csv.reader([record], delimiter=dialect[0], quotechar=dialect[1], doublequote=True, strict=False), [])
    names = [n.replace("﻿", "").strip() or f"_c{i}" for i, n in enumerate(names)]
    low = [n.lower() for n in names]
    return [f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): the lines, by file and byte range.

    All scans must cut the files alike, whatever settings or executors change between them. A relation
    keeps the settings of the session that made it, so it is made by one of its own, where the number of
    cores that small inputs are cut for is the one of now.

    Ranges much smaller than ``TASK_BYTES`` share a task, one after the other: else each of them would start
    a task of its own, and each task would take the whole plan of the second scan.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    text = own.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    lines = spark.createDataFrame([], text.schema).unionByName(text)
    return lines.coalesce(_tasks(spark, lines.rdd.getNumPartitions()))


def _tasks(spark: SparkSession, ranges: int) -> int:
    """Tasks for so many ranges: one for every ``TASK_BYTES`` of them, but four a core where there are as many ranges."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)(?:i?b)?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    size = int(number) << 10 * " kmgtp".index(unit or " ")
    return max(1, min(ranges, max(4 * spark.sparkContext.defaultParallelism, -(-ranges * size // TASK_BYTES))))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.Array]]:
    """(file, start, whether it is the range's first part, lines) of each run of a range's lines."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(i).dictionary_encode().indices.to_numpy() for i in (0, 1))
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            key = batch.column(0)[a].as_py(), batch.column(1)[a].as_py()
            values = batch.column(2).slice(a, b - a)
            if key != last and key[1] == 0:  # the byte order mark is no part of the first field
                first = pa.array([values[0].as_py().removeprefix("﻿")], values.type)
                values = pa.concat_arrays([first, values[1:]])
            yield *key, key != last, values
            last = key


def _marked(lines: pa.Array, quote: str) -> tuple[np.ndarray, list[str]]:
    """Which lines have a quote, and their texts. The others change no state, so only these are looked at one by one."""
    marked = np.flatnonzero(pc.match_substring(lines, quote).to_numpy(zero_copy_only=False))
    return marked, lines.take(pa.array(marked)).to_pylist()


def _states(n: int, marked: tuple[np.ndarray, list[str]], dialect: Dialect, inside: bool) -> tuple[np.ndarray, bool]:
    """(state at the start of each of ``n`` lines, state at the end)."""
    places, texts = marked
    after = np.empty(len(places), bool)
    state = inside
    for k, text in enumerate(texts):
        state = after[k] = ends_inside(text, dialect, state)
    changes = np.zeros(n + 1, np.int64)
    changes[places + 1] = np.arange(1, len(places) + 1)
    latest = np.maximum.accumulate(changes)[:-1]
    return np.where(latest > 0, after[latest - 1] if len(after) else inside, inside), state


MAPS = "file string, start long, dialect int, from_out boolean, from_in boolean, restarts boolean, head array<string>"


def _maps(dialects: Sequence[Dialect], quoted_newlines: bool):
    """Per range and dialect: the state after it from each state before it, whether a record starts in it
    if it starts inside one, and the first lines of a file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, head = None, [], []

        def out() -> pa.RecordBatch:
            n = len(dialects)
            columns = [[key[0]] * n, [key[1]] * n, range(n), [s[0] for s in state], [s[1] for s in state], [s[2] for s in state], [head] * n]
            types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              ["file", "start", "dialect", "from_out", "from_in", "restarts", "head"])

        for file, start, new, lines in _ranges(batches):
            if new:
                if key is not None:
                    yield out()
                key, state, head = (file, start), [[False, True, False] for _ in dialects], []
            if start == 0 and len(head) < HEAD_LINES:
                for line in lines.slice(0, HEAD_LINES - len(head)).to_pylist():
                    if sum(map(len, head)) + len(line) <= HEAD_CHARS or not head:
                        head.append(line)
            if quoted_newlines:
                marked = {quote: _marked(lines, quote) for _, quote in dialects}
                for s, dialect in zip(state, dialects):
                    _, s[0] = _states(len(lines), marked[dialect[1]], dialect, s[0])
                    at, s[1] = _states(len(lines), marked[dialect[1]], dialect, s[1])
                    s[2] |= not at.all()
        if key is not None:
            yield out()
    return run


def _compose(dialects: Sequence[Dialect], expected: Sequence[str]):
    """Per file: a row for its first range with dialect and header, and one for each range that starts or
    ends inside a record. ``owner`` is the range where the record starts that a range starts inside."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, dict[int, tuple[bool, bool, bool]]] = {}
        head: list[str] = []
        for batch in batches:
            for r in batch.to_pylist():
                maps.setdefault(r["start"], {})[r["dialect"]] = (r["from_out"], r["from_in"], r["restarts"])
                head = r["head"] or head
        mine = detect(head, dialects, expected)
        first = records(head, dialects[mine]) or [x for x in ["\n".join(head)] if not blank(x, dialects[mine])]
        rows, inside, owner = [], False, None
        for start in sorted(maps):
            from_out, from_in, restarts = maps[start][mine]
            after = from_in if inside else from_out
            if start == 0 or inside or after:
                rows.append((key[0].as_py(), mine, first[0] if first else None, start, inside, after, owner if inside else None))
            if after and (not inside or restarts):
                owner = start
            inside = after
        # the last range has none behind it: a record that is open there ends with the file
        if rows and rows[-1][3] == max(maps):
            rows[-1] = (*rows[-1][:5], False, rows[-1][6])
        types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types],
                                         ["file", "dialect", "header", "start", "inside", "crosses", "owner"])
    return run


def _hash(file: str) -> int:
    return int.from_bytes(hashlib.blake2b(file.encode(), digest_size=8).digest())


class _Plan:
    """What the tasks of the second scan know: the dialects, which group of files (same dialect and
    header) a file is in, and the ranges that start or end inside a record. Ten bytes a file (nothing if
    there is one group) and some fifty for each range that a record crosses."""

    def __init__(self, dialects: Sequence[Dialect], groups: list[tuple[int, str | None]], files: dict[int, int],
                 crossing: dict[tuple[int, int], tuple[bool, bool, int | None]], quoted_newlines: bool) -> None:
        self.dialects, self.groups, self.crossing, self.quoted_newlines = list(dialects), groups, crossing, quoted_newlines
        order = sorted(files)
        self.hashes, self.group = np.array(order, np.uint64), np.array([files[h] for h in order], np.uint16)

    def group_of(self, h: int) -> int:
        at = np.searchsorted(self.hashes, np.uint64(h))
        return int(self.group[at]) if at < len(self.hashes) and self.hashes[at] == h else 0


def _assemble(plan: _Plan, pieces: bool, places: bool = False):
    """The records that lie in one range, as (group, record, file, start, n), n by their order
    (file only with ``places``); with
    ``pieces``, instead the parts of those that cross a range's end, as (file, owner, start, part, group); start -1 marks a header."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []  # lines of a record that may go on
        crosses, group, file, start, skip, owner, at_head, n = False, 0, "", 0, False, None, False, 0

        def whole(texts: pa.Array) -> pa.RecordBatch:
            nonlocal n
            n += len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(texts), group, np.int32)), texts.cast(pa.string()),
                 pa.repeat(file, len(texts)) if places else pa.nulls(len(texts), pa.string()),
                 pa.array(np.full(len(texts), start)), pa.array(np.arange(n - len(texts), n))], ["group", "record", "file", "start", "n"])

        def part(of: int) -> pa.RecordBatch:
            row = (file, of, -1 if skip else start, "\n".join(held))
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row] + [pa.array([group], pa.int32())],
                                              ["file", "owner", "start", "part", "group"])

        def close() -> Iterator[pa.RecordBatch]:
            """The end of a range, with the lines that are held there."""
            if held and (at_head or crosses):
                if pieces:
                    yield part(owner if at_head else start)
            elif held and not pieces and not (skip and not blank("\n".join(held), plan.dialects[plan.groups[group][0]])):
                yield whole(pa.array(["\n".join(held)]))

        for f, s, new, lines in _ranges(batches):
            if new:
                yield from close()
                file, start, held, n = f, s, [], 0
                h = _hash(f)
                group = plan.group_of(h)
                at_head, crosses, owner = plan.crossing.get((h, s), (False, False, None))
                state, skip = at_head, s == 0  # the first record of a file is its header
            dialect = plan.dialects[plan.groups[group][0]]
            inside, state = _states(len(lines), _marked(lines, dialect[1]), dialect, state) if plan.quoted_newlines else (np.zeros(len(lines), bool), False)
            starts = np.flatnonzero(~inside)
            if not len(starts):
                held += lines.to_pylist()
                continue
            held += lines.slice(0, starts[0]).to_pylist()
            if at_head:
                if pieces and held:
                    yield part(owner)
                at_head = False
            elif held:
                if skip:
                    skip = blank("\n".join(held), dialect)
                elif not pieces:
                    yield whole(pa.array(["\n".join(held)]))
            first = 0
            while skip and first < len(starts) - 1:
                skip = blank("\n".join(lines.slice(starts[first], starts[first + 1] - starts[first]).to_pylist()), dialect)
                first += 1
            if not pieces and first < len(starts) - 1:
                own, base = lines.slice(starts[first], starts[-1] - starts[first]), starts[first]
                if len(own) == len(starts) - 1 - first:
                    yield whole(own)
                else:
                    offsets = pa.array((starts[first:] - base).astype(np.int32))
                    yield whole(pc.binary_join(pa.ListArray.from_arrays(offsets, own.cast(pa.string())), "\n"))
            held = lines.slice(starts[-1]).to_pylist()
        yield from close()
    return run


def read_csv(spark: SparkSession, path: str, dialects: Sequence[Dialect], quoted_newlines: bool = True,
             expected: Sequence[str] = (), position: str | None = None) -> DataFrame | None:
    """The records below ``path`` as string columns named by each file's own header, or None if no file
    has a line. Each file has the dialect of ``dialects`` that ``detect`` finds for it and the ``expected`` columns.

    Files may order their columns differently or lack some, which are null there. Blank lines are
    skipped; a missing last field is null; fields beyond the header are dropped. A field left open
    goes on to the end of its file. Every range of ``spark.sql.files.maxPartitionBytes`` is read apart, small
    ones by one task after each other.
    With ``quoted_newlines`` off, each line is a record, and only first ranges are looked at beforehand.

    With ``position`` there is a column of that name: the row's number in file order, files by path.

    The driver gets one row per file and one per range that a record crosses.
    """
    lines = _lines(spark, path)
    seen = lines if quoted_newlines else lines.filter("start = 0")
    known = seen.mapInArrow(_maps(dialects, quoted_newlines), MAPS).groupBy("file").applyInArrow(
        _compose(dialects, expected), "file string, dialect int, header string, start long, inside boolean, crosses boolean, owner long").toArrow().to_pylist()
    heads = {r["file"]: (r["dialect"], r["header"]) for r in known if r["start"] == 0}
    groups = sorted({g for g in heads.values() if g[1] is not None}, key=lambda g: (g[1], g[0]))
    if not groups:
        return None
    place = {g: i for i, g in enumerate(groups)}
    files = {_hash(f): place.get(g, 0) for f, g in heads.items()} if len(groups) > 1 else {}
    crossing = {(_hash(r["file"]), r["start"]): (r["inside"], r["crosses"], r["owner"]) for r in known if r["inside"] or r["crosses"]}
    plan = _Plan(dialects, groups, files, crossing, quoted_newlines)
    out = lines.mapInArrow(_assemble(plan, False, position is not None), "group int, record string, file string, start long, n long")
    if crossing:
        parts = materialise(lines.mapInArrow(_assemble(plan, True), "file string, owner long, start long, part string, group int"), "csv-pieces")
        own = F.array_sort(F.collect_list(F.struct("start", "part")))
        joined = parts.groupBy("file", "owner").agg(F.first("group").alias("group"), own.alias("own")).filter("own[0].start >= 0") \
            .select("group", F.array_join(F.transform("own", lambda x: x["part"]), "\n").alias("record"), "file", F.col("owner").alias("start"),
                    F.lit(1 << 62).alias("n"))  # the last record that starts in its range
        out = out.unionByName(joined)
    return _parsed(out, dialects, groups, position)


def _parsed(rows: DataFrame, dialects: Sequence[Dialect], groups: list[tuple[int, str]], position: str | None) -> DataFrame:
    record = F.regexp_replace("record", "\r\\z", "")
    columns: dict[str, list] = {}
    for i, (d, header) in enumerate(groups):
        sep, quote = dialects[d]
        names = header_names(header, dialects[d])
        schema = ", ".join(f"`c{k}` string" for k in range(len(names)))
        options = {"sep": sep, "quote": quote, "escape": quote, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        rows = rows.withColumn(f"_g{i}", F.when(F.col("group") == i, F.from_csv(record, schema, options)))
        for k, name in enumerate(names):
            columns.setdefault(name, []).append(F.col(f"_g{i}.c{k}"))
    used = F.lit(False)
    for i, (d, _) in enumerate(groups):
        blanks = " \r" if dialects[d][0] == "\t" else " \t\r"
        used = used | ((F.col("group") == i) & (F.btrim("record", F.lit(blanks)) != ""))
    rows = rows.filter(used).select("file", "start", "n", *[(F.coalesce(*c) if len(c) > 1 else c[0]).alias(f"_x{i}") for i, c in enumerate(columns.values())])
    if position:
        rows = with_position(rows, ["file", "start", "n"], position)
    return rows.select(*[F.col(f"_x{i}").alias(name) for i, name in enumerate(columns)], *([position] if position else []))
