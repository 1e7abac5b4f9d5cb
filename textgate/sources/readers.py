"""Readers: delimited labelled text, stored splits, label maps.

CSV is all-string (``inferSchema=False``; the reference coerces every field to ``str``) and bound
by each file's own header: files of one folder may order their columns differently or lack some.
Raw files are scanned twice on every read, so a pipeline should turn texts into parquet right
after the first one (``write_table(fmt="parquet")``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.operators import clean as C
from textgate.sources import manifest as MF
from textgate.sources.csv_ranges import read_csv
from textgate.sources.writers import split_table

# Fixed values that must equal the reference's: the raw-file delimiter, the split names.
RAW_SEP = ";"
DELIMITERS = (";", ",", "\t", "|")
QUOTES = ('"', "'")
SPLIT_NAMES = ("train", "validation", "test")

CSV_OPTIONS = {"header": "true", "inferSchema": "false", "escape": '"', "quote": '"', "multiLine": "true",
               "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_labelled(spark: SparkSession, path: str, sep: str = RAW_SEP, multi_line: bool = True, position: str | None = None) -> DataFrame:
    """Delimited UTF-8 text (a leading BOM is dropped), header-named string columns, cleaned names.

    Files are read in byte ranges, by as many tasks, also where quoted fields hold newlines: a scan
    before finds out which ranges start inside a quoted field (``csv_ranges``). Input known to be one
    record per line can pass ``multi_line=False`` and be spared that scan. Every file is bound by its own
    header; a column that a file lacks is null there. ``position`` names a column to add: the row's
    number in file order, files by path.
    """
    return _named(spark, path, [(sep, '"')], multi_line, position)


def _named(spark: SparkSession, path: str, dialects: Sequence[tuple[str, str]], multi_line: bool, position: str | None = None) -> DataFrame:
    df = read_csv(spark, path, dialects, multi_line, ("text", "label") if len(dialects) > 1 else (), position)
    if df is None:  # no file has a line
        df = _csv(spark, path, dialects[0][0], multi_line)
        df = df.withColumn(position, F.lit(0).cast("long")) if position else df
    return C.require_columns(C.clean_header(df))


def _csv(spark: SparkSession, path: str | list[str], sep: str, multi_line: bool) -> DataFrame:
    # enforceSchema=false: Spark raises on a file whose header differs from the first one's
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "enforceSchema": "false"}
    return spark.read.options(**options, sep=sep).csv(path)


def detect_delimiter(spark: SparkSession, path: str, candidates: Sequence[str] = DELIMITERS,
                     default: str = RAW_SEP) -> str:
    """The candidate occurring most in the header line (first candidate on ties), else ``default``.

    Reads one line: ``limit(1)`` on a text scan stops after the first record.
    """
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return default
    header = first[0][0] or ""
    counts = [(header.count(c), -i, c) for i, c in enumerate(candidates)]
    best = max(counts)
    return best[2] if best[0] > 0 else default


def read_labelled_auto(spark: SparkSession, path: str, multi_line: bool = True, position: str | None = None) -> DataFrame:
    """Same as ``read_labelled`` with delimiter and quote detected for each file: those by which its first
    records split most evenly, where the header then has both required columns."""
    return _named(spark, path, [(sep, quote) for quote in QUOTES for sep in DELIMITERS], multi_line, position)


def load_dataset(spark: SparkSession, path: str, sep: str | None = RAW_SEP, key: str | None = None,
                 text: str = "text", label: str = "label", subtype: str = "subtype", multi_line: bool = True) -> DataFrame:
    """Read + fill/strip text and label + default subtype + fail on blank rows (first 5 shown)."""
    df = read_labelled(spark, path, sep, multi_line) if sep else read_labelled_auto(spark, path, multi_line)
    if subtype not in df.columns:
        df = df.withColumn(subtype, F.lit(None).cast("string"))
    df = C.default_subtype(C.fill_text_label(df, text, label), subtype)
    return C.assert_no_blank(df, text, label, key=key)


def read_splits(spark: SparkSession, path: str, names: Sequence[str] = SPLIT_NAMES, fmt: str = "parquet",
                split_col: str = "split", verify: bool = True) -> DataFrame | None:
    """The stored splits as one DataFrame with ``split`` discovered from the folder names, or ``None``
    unless every named split is stored whole.

    ``write_splits`` publishes rows and digest of each split last: without that the splits are half
    written (``None``); a split that has lost, gained or changed rows since raises ``ValueError``, naming
    it. That is one scan. ``verify=False`` takes folders that others wrote, if all of them exist.
    """
    from pyspark.errors import AnalysisException

    published = MF.latest(spark, path) if verify else None
    if verify and (published is None or not set(names) <= set(published["parts"])):
        return None
    try:
        for n in names if not verify else ():
            split_table(spark, f"{path.rstrip('/')}/{split_col}={n}", fmt)
        df = split_table(spark, path, fmt)
    except AnalysisException:
        return None
    if verify:
        wrong = MF.differences(published["parts"], MF.digests(df, split_col), names)
        if wrong:
            raise ValueError(f"the splits at {path} are not what was stored: {'; '.join(wrong)}")
    # split tables written by ``train_gate`` carry its two load-check flags (all false)
    return df.drop(*[c for c in C.quality_flags() if c in df.columns])


def read_split_files(spark: SparkSession, folder: str, names: Sequence[str] = SPLIT_NAMES, sep: str = ",",
                     ext: str = ".csv", split_col: str = "split") -> DataFrame | None:
    """Splits stored as one delimited file per split (``train.csv``, ``validation.csv``,
    ``test.csv``) as one DataFrame with a ``split`` column, or ``None`` unless all exist."""
    from pyspark.errors import AnalysisException

    parts = []
    try:
        for n in names:
            parts.append(read_labelled(spark, f"{folder.rstrip('/')}/{n}{ext}", sep).withColumn(split_col, F.lit(n)))
    except AnalysisException:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """``(label, id)`` rows from ``{"label2id": {...}, "id2label": {...}}`` JSON documents."""
    raw = (spark.read.schema("label2id map<string,int>, id2label map<string,string>")
           .option("multiLine", True).json(path))
    return raw.select(F.explode("label2id").alias("label", "id")).select("label", F.col("id").cast("int"))


def read_id2label(spark: SparkSession, path: str) -> DataFrame:
    """``(id, label)`` rows from the ``id2label`` half, string keys cast to int."""
    raw = (spark.read.schema("label2id map<string,int>, id2label map<string,string>")
           .option("multiLine", True).json(path))
    return raw.select(F.explode("id2label").alias("id", "label")).select(F.col("id").cast("int"), "label")


def load_model(spark: SparkSession, path: str):
    """The exported gate (pipeline + label map); ``FileNotFoundError`` when absent."""
    from textgate.plans.training import load_gate

    return load_gate(spark, path)
