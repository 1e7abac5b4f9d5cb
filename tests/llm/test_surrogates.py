import pytest

from textgate.llm import surrogates as S
from textgate.llm.surrogates import lay_out, mentions, replace_entities, surrogate

KEY = b"key"


def found(text):
    return [(text[a:b], kind, normal) for a, b, kind, normal in mentions(text)]


def test_entities_and_what_only_looks_like_one():
    text = ("Mail Jo.Ann-7+x@Mail.example.org, call +1 (017) 555-7713 or 555-123-4567; 129.38.82.176, card 4111 1111 1111 1111 "
            "and 4111111111111111, ssn 123-45-6789. Mr. John Smith saw Frau Meier.")
    assert found(text) == [
        ("Jo.Ann-7+x@Mail.example.org", "email", "jo.ann-7+x@mail.example.org"), ("+1 (017) 555-7713", "phone", "+10175557713"),
        ("555-123-4567", "phone", "5551234567"), ("129.38.82.176", "ip", "129.38.82.176"), ("4111 1111 1111 1111", "card", "4111111111111111"),
        ("4111111111111111", "card", "4111111111111111"), ("123-45-6789", "ssn", "123456789"), ("John", "name", "m:john"),
        ("Smith", "name", ":smith"), ("Meier", "name", ":meier")]
    assert not found("version 3.0, 999.1.1.1, 1.2.3.4.5, 4111111111111112, a@b, 2024-01-02, 12345, The Mr. of, 100,000")
    assert found("") == [] and len(found("1.2.3.4 " * 20_000)) == 20_000


def test_surrogates_keep_type_format_script_and_gender():
    for text in ("Jo.Ann-7@Mail.example.org", "+1 (017) 555-7713", "129.38.82.176", "4111-1111-1111-1111", "123-45-6789"):
        (a, b, kind, normal), = mentions(text)
        for attempt in (0, 1, 3):
            new = lay_out(kind, text, surrogate(KEY, kind, normal, attempt))
            assert new != text and len(new) == len(text)
            assert [c.isdigit() for c in new] == [c.isdigit() for c in text] and [c.isupper() for c in new] == [c.isupper() for c in text]
            assert [(k, v) for _, _, k, v in mentions(new)][0][0] == kind
    for name, script, gender in (("m:john", "latin", "m"), ("f:анна", "cyrillic", "f"), ("f:μαρία", "greek", "f")):
        new = surrogate(KEY, "name", name).partition(":")[2]
        assert new.capitalize() in S.GIVEN[script, gender]
    assert all(S._script(c) == "cyrillic" for c in surrogate(KEY, "name", ":иванов")[1:])
    assert surrogate(KEY, "email", "a@x.org").split("@")[1] == surrogate(KEY, "email", "b@x.org").split("@")[1]
    assert surrogate(KEY, "ip", "1.2.3.4") != surrogate(b"other", "ip", "1.2.3.4")


def test_capitals_and_layouts_of_one_entity():
    a, b = "4111 1111 1111 1111", "4111111111111111"
    new = surrogate(KEY, "card", b)
    assert lay_out("card", a, new).replace(" ", "") == lay_out("card", b, new) and not S._luhn(new)
    assert lay_out("name", "JOHN", "m:karl") == "KARL" and lay_out("email", "A@B.ORG", "x@y.org") == "X@Y.ORG"


def test_distinct_and_coreferent_over_the_corpus(spark):
    rows = [(i, " ".join(f"{i}.{j}.1.1" for j in range(10)) + f" and user{i % 40}@host.example.com") for i in range(10)]
    rows += [(20, "4.3.2.1 then 0.0.1.1"), (20, "0.0.1.1 again"), (21, None), (22, ""), (23, "clean, version 3.0"), (None, "Mail USER3@host.example.com")]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, type int, normal string")
    out = replace_entities(df, KEY).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[21][0].text is None and by[22][0].text == "" and by[23][0].text == "clean, version 3.0" and by[23][0].n_replaced == 0
    real, made = {}, {}
    for k, t in rows:
        for _, _, kind, normal in mentions(t or ""):
            real.setdefault(kind, set()).add(normal)
    for r in out:
        for _, _, kind, normal in mentions(r.text or ""):
            made.setdefault(kind, set()).add(normal)
    for kind in real:
        assert len(made[kind]) == len(real[kind]) and not made[kind] & real[kind]
    again = by[20]
    new = {r.text.split()[-1] if "then" in r.text else r.text.split()[0] for r in again}
    assert len(new) == 1  # 0.0.1.1 in both rows
    assert sorted(map(repr, replace_entities(df.repartition(3), KEY).collect())) == sorted(map(repr, out))


def test_a_crowded_format_and_empty(spark):
    entities = spark.createDataFrame([("ip", f"{i}.{j}.0.{k}") for i in range(10) for j in range(10) for k in range(10)], "type string, normal string")
    got = S.assignments(entities, KEY).collect()
    assert len(got) == 1000 and len({r.surrogate for r in got}) == 1000
    assert not {r.surrogate for r in got} & {r.normal for r in got} and max(r.attempt for r in got) > 0
    assert replace_entities(spark.createDataFrame([], "doc_id long, text string"), KEY).count() == 0


def test_no_values_left(spark, monkeypatch):
    monkeypatch.setattr(S, "LAST", 3)
    entities = spark.createDataFrame([("card", "4" + "0" * 12), ("card", "4" + "0" * 11 + "1")], "type string, normal string")
    monkeypatch.setattr(S, "_assign", lambda key: lambda batches: (
        S.pa.RecordBatch.from_arrays([*b.columns, S.pa.array(["same"] * b.num_rows)], ["type", "normal", "attempt", "surrogate"]) for b in batches))
    with pytest.raises(ValueError, match="more entities"):
        S.assignments(entities, KEY)


@pytest.mark.parametrize("text, want", [
    ("+1 (826) 555-4081 190.137.223.204", ["+1 (826) 555-4081", "190.137.223.204"]),
    ("+1 (843) 555-7672 170.106.47.218", ["+1 (843) 555-7672", "170.106.47.218"]),
    ("+49 30 1234 5678 190.137.223.204", ["+49 30 1234 5678", "190.137.223.204"]),
    ("+1 (826) 555-4081 2024", ["+1 (826) 555-4081"]), ("+44 20 7946 0958 2024", ["+44 20 7946 0958"]),
    ("+49 30 1234-5678 99", ["+49 30 1234-5678"]),
    ("+1 826 555 4081 4111 1111 1111 1111", ["+1 826 555 4081", "4111 1111 1111 1111"]),
    ("+49 30 1234 5678 4111 1111 1111 1111", ["+49 30 1234 5678", "4111 1111 1111 1111"]),
    ("+44 (0)20 7946 0958", ["+44 (0)20 7946 0958"]), ("+44 020 79 46 09 58", ["+44 020 79 46 09 58"]),
    ("+49 176 12 34 56 78", ["+49 176 12 34 56 78"]), ("+86 138 1234 5678", ["+86 138 1234 5678"])])
def test_a_phone_ends_where_the_next_number_starts(text, want):
    assert [x[0] for x in found(text)] == want


@pytest.mark.parametrize("text, want", [
    ("4111 1111 1111 1111 12/27", [("4111 1111 1111 1111", "card")]), ("4111111111111111 12/27", [("4111111111111111", "card")]),
    ("4111 1111 1111 1111 123", [("4111 1111 1111 1111", "card")]), ("12 4111-1111-1111-1111", [("4111-1111-1111-1111", "card")]),
    ("123-45-6789 2024", [("123-45-6789", "ssn")]), ("123-45-6789 987-65-4321", [("123-45-6789", "ssn"), ("987-65-4321", "ssn")]),
    ("555-123-4567 555-987-6543", [("555-123-4567", "phone"), ("555-987-6543", "phone")]),
    ("4111 1111 1111 1111 123-45-6789", [("4111 1111 1111 1111", "card"), ("123-45-6789", "ssn")]),
    ("4111 1111 1111 1111 190.137.223.204", [("4111 1111 1111 1111", "card"), ("190.137.223.204", "ip")])])
def test_numbers_in_a_row_stay_apart(text, want):
    assert [x[:2] for x in found(text)] == want


def plain_assignments(entities):
    """Round by round, with sets."""
    real, taken, out, open_ = set(entities), set(), {}, {e: 0 for e in entities}
    while open_:
        made = {e: S.surrogate(KEY, *e, attempt) for e, attempt in open_.items()}
        for (kind, normal), new in sorted(made.items()):
            if (kind, new) not in real | taken and min(n for (k, n), x in made.items() if (k, x) == (kind, new)) == normal:
                out[kind, normal] = (open_.pop((kind, normal)), new)
        taken = {(k, new) for (k, _), (_, new) in out.items()}
        open_ = {e: a + 1 for e, a in open_.items()}
    return out


def test_assignments_equal_a_plain_version(spark):
    entities = [("ip", f"1.2.3.{k}") for k in range(10)] + [("ip", f"{a}.1.1.1") for a in range(1, 10)] + [("ssn", f"123-45-{k:04d}") for k in range(50)]
    entities += [("name", f"{g}:{n.casefold()}") for (script, g), names in S.GIVEN.items() for n in names]
    entities += [("phone", f"{k:04d}") for k in range(60)] + [("email", f"a@{c}.org") for c in "abcdefghijkl"]
    df = spark.createDataFrame(entities, "type string, normal string")
    got = {(r.type, r.normal): (r.attempt, r.surrogate) for r in S.assignments(df.repartition(3), KEY).collect()}
    assert got == plain_assignments(entities)


def test_gender_stays_when_all_listed_names_are_taken(spark):
    entities = [("name", f"{g}:{n.casefold()}") for (script, g), names in S.GIVEN.items() for n in names]
    df = spark.createDataFrame(entities, "type string, normal string")
    got = S.assignments(df, KEY).collect()
    for r in got:
        gender, _, name = r.normal.partition(":")
        script = S._script(name[0])
        new_gender, _, new = r.surrogate.partition(":")
        assert new_gender == gender and new.endswith(S.ENDINGS[script, gender]) and S._script(new[0]) == script
    assert len({r.surrogate for r in got}) == len(got) and max(r.attempt for r in got) < S.WIDEN


def test_rows_without_ids_keep_their_own_lists(spark):
    names = [n for n in S.GIVEN["latin", "m"]]
    rows = [(None, f"Mr {n} Smith met Mr {m} Jones") for n, m in zip(names, names[1:] + names[:1])] + [(7, None), (7, "")]
    out = S.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY)
    got = [r.text for r in out.collect() if r.text]
    assert len(got) == len(names) and len({t.split()[1] for t in got}) == len(names)
    assert {t.split()[1] for t in got} == {t.split()[5] for t in got}
