"""Recognizers, spans, context, overlap and table scans."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cloakframe import Detector, Pattern, Recognizer, default_recognizers, detect, detection_summary, with_recognizers
from cloakframe.functions import checks
from cloakframe.functions.hof import CHUNK
from cloakframe.functions.recognizers import CITIES, COUNTRIES, ENTITY_TYPES, FIRST_NAMES, LAST_NAMES, uk_recognizers, word_tree
from cloakframe.operators import compare


def found(df, *types, threshold=0.7, columns=None):
    rows = detect(df, "id", Detector(threshold, types or None), columns).collect()
    return {(r.id, r.entity_type, r.text) for r in rows}


def test_recognizer_set():
    assert len(uk_recognizers()) == 10
    assert [r.entity_type for r in default_recognizers()] == list(ENTITY_TYPES)
    with pytest.raises(ValueError):
        with_recognizers([Recognizer("UK_NHS", (Pattern("x", 0.5),))])


@pytest.mark.parametrize("words", [FIRST_NAMES, LAST_NAMES, CITIES, COUNTRIES])
def test_word_tree_matches_exactly_its_words(words):
    import re

    tree = re.compile(word_tree(words))
    for w in words:
        assert tree.fullmatch(w)
        assert not tree.fullmatch(w + "x")
        assert not tree.fullmatch(w[:-1]) or w[:-1] in words


@pytest.mark.parametrize(
    "check,good,bad",
    [
        (checks.nhs_ok, ["943 476 5919", "9434765919"], ["12345", "1234567890"]),
        (checks.nino_ok, ["AB123456C", "ab 12 34 56 c"], ["BG123456C", "AB12345C"]),
        (checks.card_ok, ["4111111111111111", "3782 822463 10005"], ["4111111111111112", "1600000000009"]),
        (checks.iban_ok, ["GB29 NWBK 6016 1331 9268 19", "DE89370400440532013000"], ["GB28 NWBK 6016 1331 9268 19", "GB29"]),
    ],
)
def test_checks(spark, check, good, bad):
    df = spark.createDataFrame([(v,) for v in good + bad], "v string")
    got = {r.v: r.ok for r in df.select("v", check(F.col("v")).alias("ok")).collect()}
    assert all(got[v] for v in good)
    assert not any(got[v] for v in bad)


CASES = {
    "UK_NHS": "id 943 476 5919.",
    "UK_NINO": "AB123456C",
    "UK_POSTCODE": "at SW1A 1AA now",
    "UK_PHONE": "+44 7911 123456",
    "UK_DRIVERS_LICENSE": "SMITH123456AB9XY",
    "UK_VRN": "AB12 CDE",
    "UK_NAME": "ava  WOOD",
    "UK_CITY": "in lEEDS today",
    "UK_BANK_ACCOUNT": "12-34-56",
    "IBAN_CODE": "GB29 NWBK 6016 1331 9268 19",
    "EMAIL_ADDRESS": "mail first.last+tag@sub.example.co.uk!",
    "DATE_TIME": "on 2024-01-15",
    "PERSON": "Dr. Strange",
    "LOCATION": "12 Church Lane",
}


@pytest.mark.parametrize("entity_type", CASES)
def test_each_type_alone(texts, entity_type):
    got = found(texts(CASES[entity_type], "The cat sat on the mat."), entity_type)
    assert len(got) == 1 and next(iter(got))[0] == 0


def test_blank_and_null_cells_have_no_findings_but_count(spark):
    df = spark.createDataFrame(
        [(1, "John Smith", "john@test.com", ""), (2, None, " \t\n", "Regular customer")], "id bigint, name string, email string, notes string"
    )
    s = detection_summary(df, Detector(0.7, ("UK_NAME", "EMAIL_ADDRESS"))).first()
    assert (s.cells_scanned, s.cells_with_pii, s.total_entities) == (6, 2, 2)
    assert s.columns_with_pii == ["email", "name"]
    assert s.entity_counts == {"EMAIL_ADDRESS": 1, "UK_NAME": 1}


def test_offsets_are_code_points_even_after_emoji_and_separator(texts):
    text = "😀é\u0001 a@b.com \u0002 c@d.org"
    rows = detect(texts(text), "id", Detector(0.7, ("EMAIL_ADDRESS",))).collect()
    assert [(r.start, r.end) for r in rows] == [(4, 11), (14, 21)]
    assert all(text[r.start : r.end] == r.text for r in rows)


def test_many_matches_in_one_cell_across_chunks(texts):
    n = 3 * CHUNK + 7
    text = " ".join(f"u{i}@example.com" for i in range(n))
    rows = detect(texts(text), "id", Detector(0.7, ("EMAIL_ADDRESS",))).collect()
    assert len(rows) == n
    assert all(text[r.start : r.end] == r.text for r in rows)


def test_context_lifts_passport_and_account(texts):
    df = texts("passport 123456789", "ref 123456789", "bank account 12345678", "number 12345678")
    assert found(df, "UK_PASSPORT", "UK_BANK_ACCOUNT") == {
        (0, "UK_PASSPORT", "123456789"),
        (2, "UK_BANK_ACCOUNT", "12345678"),
    }


def test_context_reaches_five_words_back(texts):
    df = texts("passport one two three four 123456789", "passport one two three four five 123456789")
    assert {i for i, *_ in found(df, "UK_PASSPORT")} == {0}


def test_contained_match_of_the_same_type_is_dropped(texts):
    # The landline pattern also fits inside the spaced international number.
    rows = detect(texts("+44 7911 123456"), "id", Detector(0.3, ("UK_PHONE",))).collect()
    assert [r.text for r in rows] == ["+44 7911 123456"]


def test_order_is_score_then_position(texts):
    rows = detect(texts("London a@b.com SW1A 1AA"), "id", Detector(0.7, ("UK_CITY", "EMAIL_ADDRESS", "UK_POSTCODE"))).collect()
    assert [r.entity_type for r in sorted(rows, key=lambda r: r.ord)] == ["EMAIL_ADDRESS", "UK_POSTCODE", "UK_CITY"]


def test_unknown_columns_are_skipped_and_numbers_not_scanned(spark):
    df = spark.createDataFrame([(1, "a@b.com", 4111111111111111)], "id bigint, email string, card bigint")
    assert detect(df, "id", Detector(), ["email", "nope"]).count() == 1
    assert detect(df, "id", Detector(), ["card"]).count() == 0


def test_table_without_text(spark):
    assert detect(spark.range(3), "id").count() == 0


def test_model_hook(texts):
    def model(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: [("PERSON", 0, 4, 0.9)] if t and t.startswith("Zara") else [])

    got = detect(texts("Zara a@b.com", "x", None), "id", Detector(0.7, ("PERSON", "EMAIL_ADDRESS"), model=model)).collect()
    assert {(r.entity_type, r.text) for r in got} == {("PERSON", "Zara"), ("EMAIL_ADDRESS", "a@b.com")}


EMAILS = (
    "john.smith@example.com jane_doe123@company.co.uk user+tag@subdomain.domain.org simple@test.com first.last@test.io "
    "admin@gov.uk info@cambridge.ac.uk hello.world@example.com a.b.c.d@example.io user-name@example.org "
    "contact@business.com alice@example.co bob42@example.net oliver.davies@nhs.uk emma_johnson@university.edu"
).split()
NOT_EMAILS = ["notanemail", "just plain text", "12345", "normal sentence here", "not-an-email", "title of section"]
PHONES = [
    "+44 7911 123456", "07911 123456", "+1 555-123-4567", "020 7946 0958", "+44 20 7946 0958", "+44 7700 900123",
    "07700 900123", "+44 161 555 1234", "0161 555 1234", "+44 121 555 0987", "0121 555 0987", "+44 7401 234567",
    "07401 234567", "01632 960123", "+44 1632 960123",
]
NOT_PHONES = ["12345", "not a phone", "99", "the year 1999", "price was 1234", "ABC 123 XYZ", "section 7.3", "year 2024"]
CARDS = [
    "4111111111111111", "4111-1111-1111-1111", "4012888888881881", "4012 8888 8888 1881", "4242424242424242",
    "5500000000000004", "5500 0000 0000 0004", "5105105105105100", "5555555555554444", "378282246310005",
    "3782 822463 10005", "371449635398431", "340000000000009", "6011111111111117", "6011-1111-1111-1117",
    "6011000990139424", "6011000000000004", "30569309025904", "3530111333300000", "3566002020360505",
]
NOT_CARDS = [
    "1234567890123456", "9999999999999999", "0000000000000000", "1234", "12-34-5678", "99999999999999999",
    "phone: 555-1234", "date: 2024-01-15", "order id 12345",
]


@pytest.mark.parametrize(
    "types,positives,negatives,floor",
    [
        (("EMAIL_ADDRESS",), EMAILS, NOT_EMAILS, 0.9),
        (("PHONE_NUMBER", "UK_PHONE"), PHONES, NOT_PHONES, 0.9),
        (("CREDIT_CARD",), CARDS, NOT_CARDS, 0.9),
    ],
)
def test_accuracy_gates(spark, types, positives, negatives, floor):
    rows = [(i, t, i < len(positives)) for i, t in enumerate(positives + negatives)]
    df = spark.createDataFrame(rows, "id bigint, text string, is_pii boolean")
    hits = detect(df, "id", Detector(0.5, types), ["text"]).select("id", F.lit("any").alias("entity_type"))
    labels = df.select("id", "is_pii", F.lit("any").alias("entity_type"))
    r = compare.accuracy(compare.confusion(labels, hits, ["id"])).first()
    assert r.precision >= 0.85 and r.recall >= 0.85 and r.f1 >= floor


def test_consistency_over_runs(texts):
    df = texts("Contact john.smith@example.com or call +44 7911 123456")
    runs = None
    for i in range(5):
        one = detect(df, "id", Detector(0.5)).withColumn("run", F.lit(i))
        runs = one if runs is None else runs.unionByName(one)
    r = compare.consistency(runs, ["id"]).first()
    assert (r.type_sets, r.runs, r.score_spread) == (1, 5, 0.0)


def test_random_cells_against_python(spark):
    """Spans of random text equal Python's own scan of the same patterns."""
    import random
    import re

    rng = random.Random(7)
    bits = ["a@b.co", "07911 123456", "AB12 CDE", "123456", "12-34-56", "xyz", "London", "\n", " ", "é", "😀", ".", "0161 555 1234"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    recs = [r for r in default_recognizers() if r.entity_type in ("UK_BANK_ACCOUNT", "UK_VRN", "UK_PHONE", "UK_CITY")]
    want = set()
    for i, t in enumerate(texts):
        for r in recs:
            spans = {}
            for p in r.patterns:
                for m in re.finditer(p.regex, t, re.I):
                    spans[m.span()] = max(p.score, spans.get(m.span(), 0))
            for s, score in spans.items():
                inside = any(o != s and o[0] <= s[0] and s[1] <= o[1] and c >= score for o, c in spans.items())
                if not inside:
                    want.add((i, r.entity_type, *s))
    plain = tuple(Recognizer(r.entity_type, r.patterns) for r in recs)
    got = {(r.id, r.entity_type, r.start, r.end) for r in detect(df, "id", Detector(0.0, recognizers=plain)).collect()}
    assert got == want and len(want) > 100


def test_gates_are_necessary_conditions_at_any_length(spark):
    """Whatever a pattern matches opens its gate, also in Unicode text around 256 characters."""
    import random

    from cloakframe.functions.recognizers import default_recognizers

    rng = random.Random(7)
    bits = ["Lisa Smith", "L\u0130sa Smith", "L\u0131sa Smith", "James\u00a0Jones", "United\u00a0Kingdom", "London", "\u212Aeith Brown", "Mr Smith", "a@b.co", "07700 900123", "12-34-56", "AB12 CDE", "10.0.0.1", "\u0663\u0664", "x", "\u00e9", "\u2003", "-", "."]
    rows = []
    for n in range(300):
        text = " ".join(rng.choice(bits) for _ in range(rng.randrange(1, 6)))
        rows.append((n, text + " " * rng.choice([0, 0, 1]) + "z" * rng.choice([0, 0, 230, 256 - len(text) % 256, 300])))
    df = spark.createDataFrame(rows, "id bigint, text string")
    missed = []
    for r in default_recognizers():
        for k, p in enumerate(r.patterns):
            gate = p.gate
            while gate is not None:
                missed.append(F.count_if(F.col("text").rlike(p.java) & ~gate.test(F.col("text"))).alias(f"{r.entity_type}_{k}_{len(missed)}"))
                gate = gate.parent
    assert not any(df.agg(*missed).first())


def test_dense_cells_have_the_same_scores(spark, monkeypatch):
    mails = [f"user{k}@mail{k % 7}.org" for k in range(150)]
    texts = [",".join(mails), "e-mail " + ",".join(mails), ",".join([*mails[:75], "EMAIL", *mails[75:]]), " ".join(mails), "Email: " + " ".join(mails), "07700 900123 " * 90, "mobile " + "07700 900123, " * 90]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")

    def scores(dense):
        monkeypatch.setattr("cloakframe.functions.spans.DENSE", dense)
        # another threshold each time, as built expressions are kept
        return sorted(tuple(r) for r in detect(df, "id", Detector(0.3 + dense / 1e9)).collect())

    assert scores(1) == scores(1 << 20) and len(scores(2)) >= 5 * 150
