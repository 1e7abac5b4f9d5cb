"""Secret scan: candidates by pattern, false positives removed by a random forest.

Everything is DataFrame and ``pyspark.ml`` (no Python runs on the executors). A candidate is a run
of 16 or more key characters, or a shorter value that is assigned to a name such as ``password``.
Features: its length, the transitions between classes of neighbouring characters, how much of it
the corpus's own frequent words cover, the path it comes from, and its neighbouring words. The
forest is trained on labelled findings; ``weak_labels`` makes some where nobody has labelled any.
"""

from __future__ import annotations

from itertools import product

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.session import materialise

#: Labelled findings of each class that a forest is trained on, and words of the dictionary, at most.
SAMPLE, DICTIONARY = 5_000, 300
# Names that secrets are assigned to, prefixes that key issuers use, words of test paths.
NAMES = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential"
PREFIXES = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abp]-|sk_live_|rk_live_|AIza|npm_|pypi-)"
TEST_PATHS = "test|example|sample|fixture|doc|mock"
CHARS = r"[A-Za-z0-9+/_-]"
#: Between a name and its value: quotes, blanks (32 at most on a side, as a look-behind is bounded) and the sign.
SIGN = r"[=:]\s{0,32}[\"']?"
# what is not behind a sign at all is ruled out before the names are tried
ASSIGNED = rf"(?<=[=:\s\"'])(?=[^\s\"']{{8}})(?<={SIGN})(?i:(?<=(?:{NAMES})[\"']?\s{{0,32}}{SIGN}))[^\s\"']{{8,}}"
CANDIDATE = rf"(?<!{CHARS}){CHARS}{{16,}}={{0,2}}|{ASSIGNED}"
#: Marks around candidates while a text is cut; they are taken out of texts first.
OPEN, CLOSE = "\u0001", "\u0002"
#: Classes of characters: digits, hexadecimal and other small letters, capitals, the rest.
CLASSES = {"d": "0123456789", "h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "o": "+/_-=."}
CONTEXT = 60


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: id, path, number (from 0), start (characters), candidate, before, after.

    Whole texts are scanned. before and after are up to 60 characters of the text around it. A
    null text is empty and has none; a null path is an empty one.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), OPEN + CLOSE, "  ")
    marked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), text.alias("text")) \
        .filter(F.col("text").rlike(CANDIDATE)) \
        .withColumn("parts", F.split(F.regexp_replace("text", F.lit(CANDIDATE), F.lit(f"{OPEN}$0{CLOSE}")), OPEN))
    # a part's start in the text: the lengths of those before it, without the mark each but the first holds
    marked = _with_sums_before(marked.withColumn("lengths", F.transform("parts", lambda p: F.length(F.replace(p, F.lit(CLOSE), F.lit(""))))))
    starts = F.col("starts")
    zipped = F.arrays_zip(F.expr("slice(parts, 1, size(parts) - 1)").alias("before"), F.expr("slice(parts, 2, size(parts) - 1)").alias("part"),
                          F.slice(starts, F.lit(2), F.size("parts") - 1).alias("start"))
    return marked.select("id", "path", F.posexplode(zipped).alias("number", "x")).select(
        "id", "path", "number", F.col("x.start").alias("start"), F.substring_index("x.part", CLOSE, 1).alias("candidate"),
        F.right(F.replace("x.before", F.lit(CLOSE), F.lit("")), F.lit(CONTEXT)).alias("before"),
        F.left(F.substring_index("x.part", CLOSE, -1), F.lit(CONTEXT)).alias("after"))


def _with_sums_before(df: DataFrame) -> DataFrame:
    """``df`` with starts: for each entry of the array ``lengths`` the sum of those before it.

    Appending to an array copies it, so the sums are taken in runs of about the root of its size, first
    of the runs' totals and then within each run: n * sqrt(n) copies instead of n * n. The arrays are
    columns of their own, as an expression inside a lambda is computed for each call.
    """
    def running(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    df = df.withColumn("step", F.ceil(F.sqrt(F.size("lengths"))).cast("int"))
    df = df.withColumn("runs", F.transform(F.sequence(F.lit(1), F.size("lengths"), F.col("step")), lambda k: F.slice("lengths", k, F.col("step"))))
    df = df.withColumn("totals", F.transform("runs", lambda run: F.aggregate(run, F.lit(0), lambda a, x: a + x)))
    df = df.withColumn("offsets", F.slice(running(F.col("totals"), F.lit(0)), F.lit(1), F.size("totals")))
    return df.withColumn("starts", F.flatten(F.zip_with("runs", "offsets", lambda run, start: F.slice(running(run, start), F.lit(1), F.size(run)))))


def dictionary(docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> list[str]:
    """The corpus's most frequent words of 3 to 12 small ASCII letters, over all documents."""
    words = docs.select(F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\b([a-z]{3,12})\b"), 1)).alias("w"))
    return [r["w"] for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(most).collect()]


def features(found: DataFrame, words: list[str]) -> tuple[DataFrame, list[str]]:
    """``found`` (candidate, path, before, after) with a numeric column per feature, and their names."""
    c, lower = F.col("candidate"), F.lower("candidate")
    chars, to = "".join(CLASSES.values()), "".join(k * len(v) for k, v in CLASSES.items())
    n = F.greatest(F.length(c), F.lit(1))
    classes = F.translate(c, chars, to)

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / n

    longest_first = sorted(words, key=lambda w: (-len(w), w))
    uncovered = F.length(F.regexp_replace(lower, "|".join(longest_first), "")) if words else F.length(c)
    previous = F.regexp_extract("before", r"(\S+)\s*$", 1)
    earlier = F.regexp_extract("before", r"(\S+)\s+\S+\s*$", 1)
    following = F.regexp_extract("after", r"^\S*\s+(\S+)", 1)
    plain = r"^[^\W\d_]+[.,;:]?$"
    columns = {"length": F.length(c), "distinct": F.size(F.array_distinct(F.split(c, ""))) / n}
    columns |= {f"share_{k}": share(k, classes) for k in CLASSES}
    columns |= {f"next_{a}{b}": share(f"{a}(?={b})", classes) for a, b in product(CLASSES, repeat=2)}
    columns |= {
        "vowels": share("[aeiouAEIOU]", c), "vowel_next_consonant": share("[aeiou](?=[bcdfghjklmnpqrstvwxyz])", lower),
        "covered": 1 - uncovered / n,
        "path_depth": F.regexp_count("path", F.lit("/")), "path_is_test": F.col("path").rlike(f"(?i){TEST_PATHS}"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$"), "named": F.col("before").rlike(rf"(?i)({NAMES})[\"']?\s*[=:]?\s*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"), "in_address": F.col("before").rlike(r"(@|://|\.)\S*$"),
        "previous_is_word": previous.rlike(plain), "earlier_is_word": earlier.rlike(plain), "following_is_word": following.rlike(plain),
        "previous_length": F.length(previous), "following_length": F.length(following),
    }
    return found.select("*", *[v.cast("double").alias(k) for k, v in columns.items()]), list(columns)


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings that rules are sure of, with label: 1 for an issuer's prefix, or digits and letters
    assigned to a secret's name; 0 for letters only, or digits only. The rest is left out."""
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    secret = mixed & (F.col("candidate").rlike(PREFIXES) | F.col("before").rlike(rf"(?i)({NAMES})[\"']?\s*[=:]\s*[\"']?$"))
    plain = F.col("candidate").rlike("^[A-Za-z/_-]+$|^[0-9]+$")
    return found.withColumn("label", F.when(secret, 1.0).when(plain, 0.0)).filter("label IS NOT NULL")


def train(labelled: DataFrame, names: list[str], sample: int = SAMPLE) -> RandomForestClassificationModel | None:
    """A forest from ``labelled`` (features, label), ``sample`` rows of each label at most: those
    with the smallest hashes. None when a class is missing, as nothing can be told apart."""
    hashed = labelled.select(*names, "label", F.xxhash64("candidate", "before", "after", "id", "start").alias("h"))
    parts = [materialise(hashed.filter(F.col("label") == k).orderBy("h", *names).limit(sample), "findings") for k in (0.0, 1.0)]
    if not all(p.limit(1).count() for p in parts):
        return None
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(parts[0].unionByName(parts[1]))
    return RandomForestClassifier(numTrees=40, maxDepth=7, maxBins=32, seed=1, featureSubsetStrategy="sqrt").fit(rows.select("features", "label"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per candidate of ``docs``: ``id_col``, number, start, length, sha256, score, is_secret.

    ``labelled`` (id, path, start, candidate, before, after, label) trains the forest; without it
    the rules' labels do. score is the forest's probability of a secret; candidates under
    ``threshold`` are the false positives. Without findings of both labels score is null and
    is_secret true. Repeated rows are scanned each. Secrets themselves are not returned. Other
    columns are not read; an empty table gives an empty one.
    """
    words = dictionary(docs, text_col)
    found, names = features(materialise(candidates(docs, id_col, text_col, path_col), "candidates"), words)
    found = materialise(found, "features")
    own = weak_labels(found) if labelled is None else features(labelled, words)[0]
    model = train(own, names)
    base = [F.col("id").alias(id_col), F.col("number"), F.col("start"), F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("sha256")]
    if model is None:
        return found.select(*base, F.lit(None).cast("double").alias("score"), F.lit(True).alias("is_secret"))
    scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(found))
    score = vector_to_array("probability")[1]
    return scored.select(*base, score.alias("score"), (score >= threshold).alias("is_secret"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return scan(table(spark, sf_dir, "documents"))
