"""Text scalars as Catalyst expressions (whole-stage codegen, no Python on executors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() class: Unicode White_Space plus the separators \x1c-\x1f,
# which Java's (?U)\s leaves out. As a regex class (collapse, split) and as the character set
# for btrim (strip), which touches only the ends of the string.
WS = r"[\s\x1c-\x1f]"
WS_CHARS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
_RUN = r"(?U)" + WS + r"+"
_NON_WS = r"(?U)[^\s\x1c-\x1f]"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove surrounding whitespace of any kind (Python ``str.strip()``), without a regex."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def collapse_ws(c: str | Column) -> Column:
    """Every whitespace run becomes one space (``re.sub(r"\\s+", " ", s)``)."""
    return F.regexp_replace(col(c), _RUN, " ")


def strip_collapse(c: str | Column) -> Column:
    """strip then collapse, done as collapse then trim of the single space left (one regex pass)."""
    return F.trim(collapse_ws(c))


def lowercase(c: str | Column) -> Column:
    return F.lower(col(c))


def to_string(c: str | Column) -> Column:
    return col(c).cast("string")


def fill_blank(c: str | Column, default: str = "") -> Column:
    """Null → ``default``, cast to string, strip."""
    return strip(F.coalesce(to_string(c), F.lit(default)))


def is_blank(c: str | Column) -> Column:
    """True for null, empty, or whitespace only (the search stops at the first visible character)."""
    return F.coalesce(~col(c).rlike(_NON_WS), F.lit(True))


def tokens(c: str | Column, max_length: int | None = 128) -> Column:
    """Lower-cased whitespace tokens of the whole text, optionally cut to ``max_length``."""
    words = F.filter(F.split(F.lower(col(c)), _RUN), lambda w: w != F.lit(""))
    return F.slice(words, 1, max_length) if max_length else words


def pad_tokens(t: str | Column, length: int | Column, pad: str = "<pad>") -> Column:
    """Pad a token array to ``length`` (longer arrays are cut)."""
    t = col(t)
    n = length if isinstance(length, Column) else F.lit(length)
    cut = F.slice(t, 1, n)
    return F.concat(cut, F.array_repeat(F.lit(pad), F.greatest(n - F.size(cut), F.lit(0))))


def attention_mask(t: str | Column, length: int | Column) -> Column:
    """1 for a real token, 0 for padding, ``length`` entries."""
    t = col(t)
    n = length if isinstance(length, Column) else F.lit(length)
    ones = F.transform(F.sequence(F.lit(1), n), lambda i: (i <= F.size(t)).cast("int"))
    return F.when(n >= 1, ones).otherwise(F.array().cast("array<int>"))
