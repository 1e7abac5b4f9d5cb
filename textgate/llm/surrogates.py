"""PII surrogates: keyed, type-consistent replacements that keep distinct entities distinct.

An entity is (type, normal form): case and layout fall away, so all mentions of one entity in the
corpus get one surrogate, laid out as each mention is. A surrogate depends on the key, the type,
the normal form and an attempt number only. Attempts are 0 unless a surrogate meets another one
or an entity of the corpus; then the loser takes its next one. So a task makes almost every
surrogate by itself, and only the exceptions are joined to the documents.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.session import materialise

#: Attempts after which a crowded format may use all its values (such as octets of any length), and the last one.
WIDEN, LAST = 8, 200

# Titles by the gender they show, and given names by script and gender.
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "M", "Don", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Doña", "Госпожа", "Κυρία"),
    "": ("Dr", "Prof"),
}
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carlos", "Daniel", "Emil", "Felix", "Hugo", "James", "John", "Karl", "Leon", "Marc", "Oscar",
                     "Paul", "Peter", "Robert", "Simon", "Thomas", "Victor", "William"),
    ("latin", "f"): ("Alice", "Anna", "Clara", "Diana", "Elena", "Emma", "Eva", "Hannah", "Irene", "Julia", "Laura", "Lucy", "Maria",
                     "Mary", "Nina", "Olga", "Paula", "Rosa", "Sarah", "Vera"),
    ("cyrillic", "m"): ("Андрей", "Борис", "Виктор", "Иван", "Михаил", "Олег", "Павел", "Сергей"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Татьяна"),
    ("greek", "m"): ("Αλέξανδρος", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
    ("greek", "f"): ("Άννα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία", "Χριστίνα"),
}
#: Letters that a script's surrogates are spelt with (vowels, consonants).
LETTERS = {"latin": ("aeiou", "bcdfghklmnprstvz"), "cyrillic": ("аеиоу", "бвгдзклмнпрст"), "greek": ("αεηιο", "βγδζθκλμνπρστ")}
#: Endings of made-up given names, by script and gender.
ENDINGS = {
    ("latin", "m"): ("o", "us", "an", "ard"), ("latin", "f"): ("a", "ina", "elle", "ia"),
    ("cyrillic", "m"): ("ан", "ий", "ор"), ("cyrillic", "f"): ("а", "ия", "ина"),
    ("greek", "m"): ("ος", "ης", "ας"), ("greek", "f"): ("α", "η", "ούλα"),
}
#: Attempts that choose among GIVEN; later ones make names up.
LISTED = 2

_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_TITLE = "|".join(sorted((re.escape(t) for ts in TITLES.values() for t in ts), key=len, reverse=True))
_NAME = r"[^\W\d_][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
_INTERNATIONAL = r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
PATTERN = re.compile(
    r"(?<![\w.+-])(?P<email>[\w.+-]++@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?<!\w)(?<!\d\.)(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?!\w)(?!\.\d)"
    # the layouts of ssn and phone come first: a run of several of them is no card, even if its checksum holds
    r"|(?<!\w)(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    rf"|(?<!\w)(?P<phone>{_INTERNATIONAL}|\(\d{{3}}\) ?\d{{3}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}})(?![\w-])"
    r"|(?<!\w)(?P<card>\d(?:[ -]?\d){12,18})(?!\w)"
    rf"|(?<!\w)(?P<title>{_TITLE})(?P<gap>\.? )(?P<name>{_NAME}(?: {_NAME})?)")
#: Entities of a fixed layout, which end a card or phone that they follow.
FIXED = re.compile(rf"(?:{_OCTET}\.){{3}}{_OCTET}(?!\w)(?!\.\d)|(?:\d{{3}}-\d{{2}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}})(?![\w-])")
CARD, INTERNATIONAL = re.compile(r"\d(?:[ -]?\d){12,18}(?!\w)"), re.compile(_INTERNATIONAL)
#: The digits of a whole phone number, at most, by country code (E.164: 15 for any).
PHONE_DIGITS = {"1": 11, "7": 11, "20": 12, "27": 11, "30": 12, "31": 11, "32": 11, "33": 11, "34": 11, "40": 11, "41": 11, "44": 12,
                "45": 10, "47": 10, "48": 11, "52": 12, "55": 13, "61": 11, "65": 10, "81": 12, "82": 12, "86": 13, "90": 12, "91": 12}
#: What every entity has; texts without it are not searched any further.
ANY = re.compile(rf"[@\d]|(?<!\w)(?:{_TITLE})\.? [^\W\d_]")


def _luhn(digits: str) -> int:
    """What the digits' checksum leaves; 0 for a valid card number."""
    return sum(int(c) if k % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for k, c in enumerate(reversed(digits))) % 10


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _ends(value: str) -> list[int]:
    """Where the runs of digits of ``value`` end, the last one first."""
    return [m.end() for m in re.finditer(r"\d+", value)][::-1]


def _card_end(value: str) -> int:
    """The end of the card number that starts ``value``, at the end of a group; 0 if there is none.
    The usual groups (4-4-4-4, 4-6-5) go before longer runs, which may hold a date or code."""
    usual = re.match(r"\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}|\d{6}\1\d{5})(?!\d)", value)
    for end in ([usual.end()] if usual else []) + _ends(value):
        if 13 <= len(digits := _digits(value[:end])) <= 19 and not _luhn(digits):
            return end
    return 0


def _card_at(text: str, at: int) -> bool:
    return (m := CARD.match(text, at)) is not None and _card_end(m.group()) > 0


def _phone_end(text: str, start: int, end: int) -> int:
    """The end of the international phone number that starts text[start:end], a run of groups: its
    country's length, or where another entity or a complete number starts behind a space."""
    value = text[start:end]
    code = next((c for c in (value[1:2], value[1:3]) if c in PHONE_DIGITS), "")
    most = PHONE_DIGITS.get(code, 15)
    most += code != "" and re.match(r"[ .-]?\(?0", value[1 + len(code):]) is not None  # a trunk zero, as in +44 (0)20
    for got in _ends(value)[::-1]:  # the shortest first: what follows decides whether it goes on
        if got == len(value) or not INTERNATIONAL.fullmatch(value, 0, got):
            continue
        n, later = len(_digits(value[:got])), re.match(r"[ .-](\d+)", value[got:])
        if n < 8 or later is None:
            continue
        at = start + got + 1
        if (n >= 10 and n + len(later.group(1)) > most) or FIXED.match(text, at) or _card_at(text, at):
            return start + got
        if value[got] == " " and n >= 11 and re.fullmatch(r"(?:19|20)\d\d", later.group(1)):
            return start + got
        if value[got] == " " and n >= 10 and re.search(r"\d[-.]\d+$", value[:got]):
            return start + got  # groups held together by dashes or dots are not carried on by a space
    return end


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of each entity in a text, in order, without overlaps."""
    at = 0 if ANY.search(text) else len(text)
    while (m := PATTERN.search(text, at)) is not None:
        kind = m.lastgroup
        start, end = m.span(kind)
        value, at = m.group(kind), m.end()
        if kind == "email":
            yield start, end, kind, value.lower()
        elif kind == "ip":
            if all(int(x) < 256 for x in value.split(".")):
                yield start, end, kind, value
        elif kind == "card":
            for k in re.finditer(r"[ -]\d", value):  # up to an entity that starts inside
                if FIXED.match(text, start + k.start() + 1):
                    value = value[:k.start()]
                    break
            if got := _card_end(value):
                at = start + got
                yield start, at, kind, _digits(value[:got])
            elif not m.group(kind).isdigit():
                at = start + 1  # something else may start inside
        elif kind in ("ssn", "phone"):
            if value[0] == "+":
                at = end = _phone_end(text, start, end)
                value = text[start:end]
            yield start, end, kind, ("+" if value[0] == "+" else "") + _digits(value)
        else:  # names are entities word by word, so that a surname alone gets the same surrogate
            title = next(g for g, ts in TITLES.items() if m.group("title") in ts)
            words = value.split(" ")
            if len(words) == 2 and not words[1][0].isupper():
                del words[1]
                at = start + len(words[0])
            for k, word in enumerate(words if words[0][0].isupper() else []):
                known = _GENDER.get(word.capitalize())
                gender = known[1] if known else title if k == 0 and len(words) == 2 else ""
                yield start, start + len(word), kind, gender + ":" + word.casefold()
                start += len(word) + 1


class _Stream:
    """Numbers below a bound from a keyed hash, as many as wanted."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.key, self.seed, self.block, self.value, self.left = key, "\x1f".join(parts).encode(), 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            digest = hmac.digest(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256)
            self.value, self.left, self.block = int.from_bytes(digest, "big"), 1 << 256, self.block + 1
        self.value, got = divmod(self.value, n)
        self.left //= n
        return got


def _script(c: str) -> str:
    name = unicodedata.name(c, "")
    return next((s for s in LETTERS if name.startswith(s.upper())), "latin")


def _spell(word: str, stream: _Stream, script: str = "") -> str:
    """Letters for letters (of the same script) and digits for digits; the rest as it is. Lower case."""
    out = []
    for k, c in enumerate(word):
        if c.isdigit():
            out.append(str(stream.below(10)))
        elif c.isalpha():
            letters = LETTERS[script or _script(c)][1 - k % 2]
            out.append(letters[stream.below(len(letters))])
        else:
            out.append(c)
    return "".join(out)


def _given_name(script: str, gender: str, syllables: int, stream: _Stream) -> str:
    """A made-up given name whose ending shows the gender; with two syllables one of 10^5 or more."""
    vowels, consonants = LETTERS[script]
    letters = [x[stream.below(len(x))] for x in (*[consonants, vowels] * syllables, consonants)]
    ends = ENDINGS[script, gender]
    return "".join(letters) + ends[stream.below(len(ends))]


def surrogate(key: bytes, kind: str, normal: str, attempt: int = 0) -> str:
    """The normal form of an entity's surrogate; it has the entity's length and layout.

    email: the local part and the domain's labels are spelt anew, the last label stays; a domain
    gets the same surrogate with every local part. ip: octets of the same length, all valid.
    card: the first digit stays, the checksum holds. ssn, phone: digits, with the country
    code kept. name: a given name of the same script and gender for a given name (from a list, then made
    up with an ending of that gender), else a name spelt anew in its script.
    """
    wide = attempt >= WIDEN
    stream = _Stream(key, kind, normal, str(attempt))
    if kind == "email":
        local, _, domain = normal.rpartition("@")
        labels = domain.split(".")
        own = _Stream(key, "domain", domain)
        extra = "".join(LETTERS["latin"][k % 2][stream.below(5)] for k in range(attempt // WIDEN))
        return _spell(local, stream) + extra + "@" + ".".join([*(_spell(x, own, "latin") for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        low, high = {1: (0, 10), 2: (10, 100), 3: (100, 256)}, (0, 256)
        spans = [high if wide else low[len(x)] for x in normal.split(".")]
        return ".".join(str(a + stream.below(b - a)) for a, b in spans)
    if kind == "card":
        head = normal[0] + "".join(str(stream.below(10)) for _ in normal[2:])
        return next(head + str(d) for d in range(10) if not _luhn(head + str(d)))
    if kind in ("ssn", "phone"):
        keep = 0 if normal[0] != "+" or len(normal) < 9 else 2
        return normal[:keep] + "".join(str(stream.below(10)) for _ in normal[keep:])
    gender, _, name = normal.partition(":")
    script = _script(name[0])
    given = GIVEN.get((script, gender))
    if given and attempt < LISTED:
        return gender + ":" + given[stream.below(len(given))].casefold()
    if given:
        return gender + ":" + _given_name(script, gender, 2 + attempt // WIDEN, stream)
    return gender + ":" + _spell(name, stream, script) + LETTERS[script][0][stream.below(4)] * (attempt // WIDEN)


def lay_out(kind: str, mention: str, normal: str) -> str:
    """A surrogate's normal form written as the mention is: its separators, spaces and capitals."""
    if kind in ("card", "ssn", "phone"):
        digits = iter(_digits(normal))
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "ip":
        return normal
    if kind == "name":
        normal = normal.partition(":")[2]
        return normal.upper() if len(mention) > 1 and mention.isupper() else normal.capitalize()
    if mention.isupper():
        return normal.upper()
    return "".join(c.upper() if k < len(mention) and mention[k].isupper() else c for k, c in enumerate(normal))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rows = [(i, h, k, n) for i, text, h in zip(part.column(0), part.column(1).to_pylist(), part.column(2)) if text
                    for k, n in sorted({(k, n) for _, _, k, n in mentions(text)})]
            if rows:
                ids = pa.array([r[0].as_py() for r in rows], part.schema.field(0).type)
                hashes = pa.array([r[1].as_py() for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, hashes, *(pa.array([r[j] for r in rows], pa.string()) for j in (2, 3))], ["id", "hash", "type", "normal"])


def _assign(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [surrogate(key, *x) for x in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], ["type", "normal", "attempt", "surrogate"])
    return run


def assignments(entities: DataFrame, key: bytes) -> DataFrame:
    """(type, normal, attempt, surrogate) of distinct ``entities`` (type, normal): surrogates are
    distinct within a type, and none is an entity.

    Each round makes the surrogates that are open and settles those that are no entity and not taken; of
    equal ones the smallest normal form is settled. What is settled is only looked up by later rounds,
    which are as large as what is left. Raises when a format has no values left.
    """
    schema = "type string, normal string, attempt int, surrogate string"
    open_ = entities.select("type", "normal", F.lit(0).alias("attempt"))
    settled, taken = None, entities.select("type", F.col("normal").alias("surrogate"))
    for attempt in range(LAST):
        made = materialise(open_.mapInArrow(_assign(key), schema), "made")
        first = made.groupBy("type", "surrogate").agg(F.min("normal").alias("normal"))
        wins = materialise(made.join(first.join(taken, ["type", "surrogate"], "left_anti"), ["type", "surrogate", "normal"]).select(*made.columns), "settled")
        settled = wins if settled is None else settled.unionByName(wins)
        taken = taken.unionByName(wins.select("type", "surrogate"))
        lost = made.join(wins, ["type", "normal"], "left_anti")
        if not lost.limit(1).count():
            return settled
        open_ = lost.select("type", "normal", F.lit(attempt + 1).alias("attempt"))
    raise ValueError("a format has more entities than surrogates")


def _replace(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], str] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, counts, kinds = [], [], []
                for text, later in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    attempts = {(x["type"], x["normal"]): x["attempt"] for x in later or ()}
                    out, end, found = [], 0, []
                    for a, b, kind, normal in mentions(text or ""):
                        if attempt := attempts.get((kind, normal), 0):
                            new = surrogate(key, kind, normal, attempt)
                        else:
                            if len(known) > 100_000:
                                known.clear()
                            new = known.get((kind, normal)) or known.setdefault((kind, normal), surrogate(key, kind, normal))
                        out += [text[end:a], lay_out(kind, text[a:b], new)]
                        end = b
                        found.append(kind)
                    texts.append(None if text is None else "".join(out) + text[end:])
                    counts.append(len(found))
                    kinds.append(sorted(set(found)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                                                  pa.array(kinds, pa.list_(pa.string()))], ["id", "text", "n_replaced", "kinds"])
    return run


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text with every entity replaced, n_replaced, kinds.

    Emails, IPv4 addresses, card numbers (13 to 19 digits with a valid checksum), social security
    numbers, phone numbers and names behind a title. The same entity gets the same surrogate in
    all rows, distinct ones of a type get distinct ones, and with the same key and corpus every
    run gives the same. Null texts stay null; a text without entities stays as it is. Repeated
    rows are replaced alike. Other columns are not read; an empty table gives an empty one.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    found = materialise(source.mapInArrow(_find, f"id {id_type}, hash long, type string, normal string"), "mentions")
    entities = materialise(found.select("type", "normal").distinct(), "entities")
    later = assignments(entities, key).filter("attempt > 0").select("type", "normal", "attempt")
    # one list per id and text of its few entities that are not at their first attempt; ids may repeat or be null
    later = found.join(later, ["type", "normal"]).groupBy("id", "hash").agg(F.collect_set(F.struct("type", "normal", "attempt")).alias("later"))
    later = materialise(later.withColumnsRenamed({"id": "_of", "hash": "_hash"}), "later")
    return source.join(later, source["id"].eqNullSafe(later["_of"]) & (source["hash"] == later["_hash"]), "left").select("id", "text", "later") \
        .mapInArrow(_replace(key), f"id {id_type}, text string, n_replaced bigint, kinds array<string>") \
        .withColumnRenamed("id", id_col)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return replace_entities(table(spark, sf_dir, "documents"), b"textgate-surrogates")
