import csv
import io
import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textgate.sources import csv_ranges as CR
from textgate.sources import readers as R

FOUR = [(sep, quote) for quote in R.QUOTES for sep in R.DELIMITERS]


@pytest.fixture
def small_ranges(spark):
    """Files are cut every 300 bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield 300
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(seed, n, longest=60):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        text = "".join(rnd.choice(['a', 'b', ' ', ';', '"', '\n', "'", ',', 'é', '""', '\r\n']) for _ in range(rnd.randint(1, longest)))
        out.append((f"{i} {text}", rnd.choice(["valida", "no_valida"]), rnd.choice(["x", 'say "hi"', "two\nlines"])))
    return out


def write(path: Path, rows, sep=";", quote='"', names=("text", "label", "subtype"), end="\n", quoting=csv.QUOTE_MINIMAL, bom=False):
    f = io.StringIO(newline="")
    w = csv.writer(f, delimiter=sep, quotechar=quote, lineterminator=end, quoting=quoting)
    w.writerow(names)
    w.writerows(rows)
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + f.getvalue().encode())


def got(df):
    return sorted(tuple(r) for r in df.select("text", "label", "subtype").collect())


@pytest.mark.parametrize("end, quoting, bom", [("\n", csv.QUOTE_MINIMAL, False), ("\r\n", csv.QUOTE_ALL, True), ("\n", csv.QUOTE_NONNUMERIC, True)])
def test_one_file_read_by_many_tasks(spark, tmp_path, small_ranges, end, quoting, bom):
    rows = made(1, 300)
    write(tmp_path / "a.csv", rows, end=end, quoting=quoting, bom=bom)
    df = R.read_labelled(spark, str(tmp_path / "a.csv"))
    ranges = (tmp_path / "a.csv").stat().st_size // small_ranges
    assert ranges > 30 and CR._lines(spark, str(tmp_path / "a.csv")).select("start").distinct().count() > 20
    assert df.columns == ["text", "label", "subtype"]
    assert got(df) == sorted(rows)
    whole = spark.read.options(**R.CSV_OPTIONS, sep=";").csv(str(tmp_path / "a.csv"))  # one task for the file
    if not bom and end == "\n":  # Spark's own reader turns \r\n inside fields into \n
        plain = lambda rs: sorted(tuple(v.replace("\r\n", "\n") for v in r) for r in rs)
        assert plain(got(df)) == plain(got(whole))


def test_ranges_do_not_follow_settings_changed_after_the_call(spark, tmp_path, small_ranges):
    rows = made(2, 200)
    write(tmp_path / "a.csv", rows)
    df = R.read_labelled(spark, str(tmp_path / "a.csv"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    assert got(df) == sorted(rows)


def test_records_over_several_ranges_and_an_open_quote(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i} of a field" for i in range(200))
    rows = [("a", "valida", "x"), (long, "valida", "y"), ("b", "no_valida", long), ("c", "valida", "z")]
    write(tmp_path / "a.csv", rows)
    write(tmp_path / "b.csv", rows[::-1], names=("text", "label", "subtype"))
    (tmp_path / "c.csv").write_text('text;label;subtype\nx;valida;"never closed\n' + "more\n" * 200, encoding="utf-8")
    assert got(R.read_labelled(spark, str(tmp_path))) == sorted([*rows, *rows, ("x", "valida", "never closed\n" + "more\n" * 199 + "more")])


def test_a_header_that_crosses_a_range_is_no_row(spark, tmp_path, small_ranges):
    names = ("text", "label", "subtype", "\n".join("a long name" for _ in range(60)))
    write(tmp_path / "a.csv", [(*r, "v") for r in made(3, 30)], names=names)
    df = R.read_labelled(spark, str(tmp_path / "a.csv"))
    assert got(df) == sorted(made(3, 30)) and len(df.columns) == 4


def test_stray_quotes_and_blank_lines(spark, tmp_path, small_ranges):
    body = ['text;label;subtype', '5" pipe;valida;x', '', '   ', 'it"s;no_valida;y', '"closed"then more;valida;z', ';valida;'] * 1
    (tmp_path / "a.csv").write_text("\n".join(["", *body, *['plain 7" text;valida;w'] * 100, ""]), encoding="utf-8")
    rows = [tuple(r) for r in R.read_labelled(spark, str(tmp_path / "a.csv")).collect()]
    assert sorted(rows, key=repr) == sorted([('5" pipe', "valida", "x"), ('it"s', "no_valida", "y"), ('"closed"then more', "valida", "z"), (None, "valida", None),
                                             *[('plain 7" text', "valida", "w")] * 100], key=repr)


def test_a_folder_of_several_dialects(spark, tmp_path, small_ranges):
    want = []
    for k, (sep, quote) in enumerate(FOUR):
        rows = [(f"{k} {t}", a, s) for t, a, s in made(10 + k, 40)]
        write(tmp_path / f"{k}.csv", rows, sep, quote, quoting=csv.QUOTE_ALL)
        want += rows
    assert got(R.read_labelled_auto(spark, str(tmp_path))) == sorted(want)


def test_other_delimiters_in_quoted_headers_and_texts(spark, tmp_path):
    write(tmp_path / "a.csv", [("one, two, three", "valida", "a|b|c"), ("four, five", "valida", "")], names=("text", "label", "note, or, remark, or so"))
    write(tmp_path / "b.csv", [("¿Qué; y; cómo?", "valida", "x"), ("no;no;no", "no_valida", "y")], ",", names=("label;of;it", "text", "label"))
    df = R.read_labelled_auto(spark, str(tmp_path))
    assert set(df.columns) == {"text", "label", "note, or, remark, or so", "label;of;it"}
    assert {(r.text, r.label) for r in df.collect()} == {("one, two, three", "valida"), ("four, five", "valida"), ("valida", "x"), ("no_valida", "y")}


def test_one_record_a_line_needs_no_scan_of_quotes(spark, tmp_path, small_ranges):
    rows = [(t.replace("\n", " ").replace("\r", " "), a, "s") for t, a, _ in made(5, 200)]
    write(tmp_path / "a.csv", rows, names=("text", "label", "subtype"))
    assert got(R.read_labelled(spark, str(tmp_path), multi_line=False)) == sorted(rows)


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n\n")
    write(tmp_path / "header.csv", [], names=("text", "label"))
    df = R.read_labelled(spark, str(tmp_path))
    assert df.columns == ["text", "label"] and df.count() == 0
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        R.read_labelled(spark, str(tmp_path / "none"))


def test_detect():
    dialect = lambda text: FOUR[CR.detect(text.split("\n"), FOUR)]
    assert dialect("a;b\n1;2,3,4") == (";", '"') and dialect("a,b\n1;x,2;y") == (",", '"') and dialect("only") == (";", '"')
    assert dialect("'a;x','b'\n'1','2;3;4'") == (",", "'") and dialect("a\tb|c\n1\t2\n3\t4") == ("\t", '"') and dialect("") == (";", '"')
    assert dialect("text;label\n'tis so;valida\n'twas;valida\nboth';valida") == (";", '"')


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text('a";\n', max_size=6), min_size=2, max_size=3), min_size=1, max_size=8), st.integers(0, 40))
def test_states_equal_a_walk_over_characters(rows, cut):
    f = io.StringIO(newline="")
    csv.writer(f, delimiter=";", lineterminator="\n").writerows(rows)
    text = f.getvalue()
    lines = text.split("\n")
    inside, states = False, []
    for line in lines:
        states.append(inside)
        inside = CR.ends_inside(line, (";", '"'), inside)
    # quotes written by a writer are balanced, so their parity tells the state
    assert states == ["\n".join(lines[:i]).count('"') % 2 == 1 for i in range(len(lines))] and not inside


def test_small_ranges_share_tasks(spark, tmp_path):
    """A task for each small range would start Python, and take the plan of all ranges, once for every one of them."""
    rows = made(7, 4000)
    write(tmp_path / "a.csv", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines = CR._lines(spark, str(tmp_path / "a.csv"))
        ranges, tasks = lines.select("start").distinct().count(), lines.rdd.getNumPartitions()
        assert ranges > 100 and tasks <= 4 * spark.sparkContext.defaultParallelism
        assert got(R.read_labelled(spark, str(tmp_path / "a.csv"))) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tasks_grow_with_the_bytes(spark):
    before, least = spark.conf.get("spark.sql.files.maxPartitionBytes"), 4 * spark.sparkContext.defaultParallelism
    try:
        for size, ranges, tasks in (("64k", 3, 3), ("64k", 1 << 20, 2048), ("128m", 5000, 5000), ("134217728b", 700, 700), ("65536", 1000, least)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert CR._tasks(spark, ranges) == tasks
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@given(st.text(";,\"'a", max_size=12), st.sampled_from(FOUR), st.booleans())
def test_open_quotes_are_those_of_the_fields(line, dialect, inside):
    assert CR.ends_inside(line, dialect, inside) == CR.fields(line, dialect, inside)[1]
