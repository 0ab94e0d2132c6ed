"""What to look for: entity types, their patterns, scores and context words.

Patterns run in Java's regex engine, case-insensitive and with Unicode classes
unless a pattern says otherwise.  They use no look-around, so the same text is
valid in other engines too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cloakframe.functions import checks

# --------------------------------------------------------------------------
# Entity types, patterns, scores, context words and word lists.
# --------------------------------------------------------------------------

ENTITY_TYPES = (
    "EMAIL_ADDRESS",
    "PHONE_NUMBER",
    "CREDIT_CARD",
    "PERSON",
    "LOCATION",
    "DATE_TIME",
    "IP_ADDRESS",
    "IBAN_CODE",
    "UK_NHS",
    "UK_NINO",
    "UK_POSTCODE",
    "UK_PHONE",
    "UK_CITY",
    "UK_NAME",
    "UK_DRIVERS_LICENSE",
    "UK_PASSPORT",
    "UK_BANK_ACCOUNT",
    "UK_VRN",
)

FIRST_NAMES = tuple(
    """
    James John Robert Michael William David Richard Thomas Mark Daniel Matthew Andrew
    Paul Stephen Edward Charles Christopher Anthony Adam Kevin Brian George Jonathan Tom
    Ben Sam Alex Chris Steve Mike Dave Pete Joe Phil Oliver Harry Charlie Jack Noah Leo
    Henry Oscar Theo Arthur Mason Alfie Jacob Freddie Hugo Lucas Logan Roman Ethan Liam
    Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Margaret
    Helen Anna Maria Catherine Rachel Laura Sophie Hannah Olivia Amelia Isla Ava Mia
    Isabella Sophia Lily Grace Evie Poppy Florence Willow Ruby Elsie Ella Daisy Phoebe
    Charlotte Emma Emily
    """.split()
)

LAST_NAMES = tuple(
    """
    Smith Jones Williams Brown Taylor Davies Wilson Evans Thomas Roberts Walker Wright
    Robinson Hall Green King Wood Harris Lewis Johnson White Martin Lee Thompson Clarke
    Jackson Hill Cooper Edwards Turner Phillips Watson Carter Mitchell Stewart Morris
    Bailey Bell Cox Murphy Cook Collins Reed Kelly Howard Ward Brooks Foster Patel Khan
    """.split()
)

CITIES = tuple(
    """
    London Manchester Birmingham Leeds Glasgow Liverpool Bristol Sheffield Edinburgh
    Cardiff Belfast Newcastle Nottingham Coventry Leicester Brighton Southampton
    Portsmouth Reading Plymouth York Oxford Cambridge Bath Aberdeen Swansea
    """.split()
)

COUNTRIES = (
    "United Kingdom", "Great Britain", "Northern Ireland", "England", "Scotland", "Wales",
    "Ireland", "France", "Germany", "Spain", "Italy", "Portugal", "Netherlands", "Belgium",
    "United States", "Canada", "Australia",
)

TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof")
MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def word_tree(words: tuple[str, ...]) -> str:
    """An alternation that shares common beginnings: matches exactly ``words``.

    A flat ``A|B|C`` tries every word at every word start; here the first
    letters rule nearly all of them out.
    """
    heads: dict[str, list[str]] = {}
    for word in words:
        heads.setdefault(word[:1], []).append(word[1:])
    ends = "" in heads
    branches = [
        (r"\s+" if head == " " else head) + word_tree(tuple(tails))
        for head, tails in heads.items()
        if head
    ]
    if not branches:
        return ""
    body = branches[0] if len(branches) == 1 and not ends else "(?:" + "|".join(branches) + ")"
    return body + "?" if ends else body


@dataclass(frozen=True)
class Gate:
    """A cheap test a text must pass before any pattern behind it can match.

    It is a necessary condition of all its patterns.  Most cells fail most
    gates, so most patterns never run.  Where a gate has a parent, the parent
    is asked first.
    """

    test: Callable[[Column], Column]
    parent: Gate | None = None


def _rlike(regex: str) -> Gate:
    return Gate(lambda text: text.rlike(regex))


# Rare characters come first in these tests: that is where the scan stops.
HAS_DIGIT = _rlike(r"(?U)\d")
HAS_DIGIT_RUN = _rlike(r"(?U)\d[\d\s-]{4}")
HAS_DIALLED_RUN = _rlike(r"(?U)\d[\d\s.()-]{5}")
HAS_LETTER_DIGIT = _rlike(r"(?U)\d(?<=\p{L}\s?\d)")
HAS_ADDRESS_MARK = _rlike(r"[.:][0-9A-Fa-f:]")
HAS_AT_SIGN = Gate(lambda text: F.contains(text, F.lit("@")))


def _word_gate(words: tuple[str, ...]) -> Gate:
    # The first word of each entry must stand among the text's words; that holds
    # for every match, whatever white space follows it.  Four letters beyond ASCII
    # equal an ASCII one where case is ignored (dotted and dotless i, long s, Kelvin).
    firsts = sorted({w.lower().split()[0] for w in words})

    def test(text: Column) -> Column:
        folded = F.lower(F.translate(text, "İıſK", "iisk"))
        return F.exists(F.split(folded, "[^a-z]+"), lambda word: word.isin(firsts))

    return Gate(test)


HAS_KNOWN_WORD = _word_gate(FIRST_NAMES + CITIES + COUNTRIES + TITLES)


@dataclass(frozen=True)
class Pattern:
    regex: str
    score: float
    gate: Gate | None = None
    any_case: bool = True

    @property
    def java(self) -> str:
        return ("(?iU)" if self.any_case else "(?U)") + self.regex


@dataclass(frozen=True)
class Recognizer:
    """One entity type.

    ``validator`` turns matched text into true (score 1.0) or false (dropped);
    without one the pattern score stands.  A ``context`` word among the five
    words before a match raises its score.
    """

    entity_type: str
    patterns: tuple[Pattern, ...]
    context: tuple[str, ...] = ()
    validator: Callable[[Column], Column] | None = None


def uk_recognizers() -> list[Recognizer]:
    return [
        Recognizer(
            "UK_NHS",
            (
                Pattern(r"\b\d{3}\s\d{3}\s\d{4}\b", 0.85, HAS_DIGIT_RUN),
                Pattern(r"\b\d{10}\b", 0.6, HAS_DIGIT_RUN),
            ),
            ("nhs", "national health", "health service", "patient", "hospital", "medical", "healthcare"),
            checks.nhs_ok,
        ),
        Recognizer(
            "UK_NINO",
            (Pattern(r"\b[A-CEGHJ-NPR-TW-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]\b", 0.85, HAS_LETTER_DIGIT),),
            ("national insurance", "ni number", "nino", "insurance number", "tax", "hmrc", "employer"),
            checks.nino_ok,
        ),
        Recognizer(
            "UK_POSTCODE",
            (Pattern(r"\b[A-Z]{1,2}\d[A-Z\d]?\s?\d[A-Z]{2}\b", 0.95, HAS_LETTER_DIGIT),),
            ("postcode", "post code", "address", "zip", "location", "delivery", "shipping"),
        ),
        Recognizer(
            "UK_PHONE",
            (
                Pattern(r"\+44\s?\d{4}\s?\d{6}", 0.9, HAS_DIGIT_RUN),
                Pattern(r"\+44\s\d{2,3}\s\d{3,4}\s\d{3,4}", 0.9, HAS_DIGIT_RUN),
                Pattern(r"\b07\d{3}\s?\d{6}\b", 0.85, HAS_DIGIT_RUN),
                Pattern(r"\b0[1-9]\d{2,4}\s?\d{5,6}\b", 0.75, HAS_DIGIT_RUN),
                Pattern(r"\b0\d{2,3}\s\d{3,4}\s\d{3,4}\b", 0.85, HAS_DIGIT_RUN),
            ),
            ("phone", "mobile", "telephone", "tel", "call", "contact", "number", "cell"),
        ),
        Recognizer(
            "UK_CITY",
            (Pattern(rf"\b{word_tree(CITIES)}\b", 0.85, HAS_KNOWN_WORD),),
            ("city", "town", "address", "street", "road", "avenue", "lane", "close", "way", "postcode"),
        ),
        Recognizer(
            "UK_NAME",
            (Pattern(rf"\b{word_tree(FIRST_NAMES)}\s+{word_tree(LAST_NAMES)}\b", 0.95, HAS_KNOWN_WORD),),
            ("name", "customer", "client", "person", "contact"),
        ),
        Recognizer(
            "UK_DRIVERS_LICENSE",
            (
                Pattern(r"\b[A-Z]{5}\d{6}[A-Z\d]{5}\b", 0.8, HAS_LETTER_DIGIT),
                Pattern(r"\b[A-Z]{5}\s?\d{6}\s?[A-Z\d]{5}\b", 0.75, HAS_LETTER_DIGIT),
            ),
            ("driving", "license", "licence", "driver", "dvla", "permit"),
        ),
        Recognizer(
            "UK_PASSPORT",
            (Pattern(r"\b\d{9}\b", 0.5, HAS_DIGIT_RUN),),
            ("passport", "travel", "document", "hmpo", "border", "visa", "immigration"),
        ),
        Recognizer(
            "UK_BANK_ACCOUNT",
            (
                Pattern(r"\b\d{2}-\d{2}-\d{2}\b", 0.8, HAS_DIGIT_RUN),
                Pattern(r"\b\d{8}\b", 0.4, HAS_DIGIT_RUN),
                Pattern(r"\b\d{6}\b", 0.3, HAS_DIGIT_RUN),
            ),
            ("account", "bank", "sort code", "account number", "payment", "transfer", "bacs", "direct debit"),
        ),
        Recognizer(
            "UK_VRN",
            (
                Pattern(r"\b[A-Z]{2}\d{2}\s?[A-Z]{3}\b", 0.8, HAS_LETTER_DIGIT),
                Pattern(r"\b[A-Z]\d{1,3}\s?[A-Z]{3}\b", 0.7, HAS_LETTER_DIGIT),
            ),
            ("vehicle", "registration", "car", "plate", "dvla", "number plate", "license plate"),
        ),
    ]


def general_recognizers() -> list[Recognizer]:
    """Country-neutral types; scores follow the public defaults of common tools."""
    return [
        Recognizer(
            "EMAIL_ADDRESS",
            # A local part has at most 64 characters (RFC 5321); the bound also
            # keeps the scan linear on long runs without spaces.
            (Pattern(r"[\w.!#$%&*+/=?^{|}~-]{1,64}@\w[\w-]*(?:\.[\w-]+)*\.[A-Z]{2,24}\b", 1.0, HAS_AT_SIGN),),
            ("email",),
        ),
        Recognizer(
            "PHONE_NUMBER",
            (
                Pattern(r"\+\d{1,3}[\s.-]?\(?\d{1,4}\)?(?:[\s.-]?\d{2,4}){2,4}\b", 0.4, HAS_DIALLED_RUN),
                Pattern(r"(?:\(\d{3}\)\s?|\b\d{3}[\s.-])\d{3}[\s.-]\d{4}\b", 0.4, HAS_DIALLED_RUN),
                Pattern(r"\b0\d{2,4}[\s-]?\d{3,4}[\s-]?\d{3,4}\b", 0.4, HAS_DIALLED_RUN),
            ),
            ("phone", "number", "telephone", "cell", "cellphone", "mobile", "call"),
        ),
        Recognizer(
            "CREDIT_CARD",
            (Pattern(r"\b(?:4\d{3}|5[0-5]\d{2}|[136]\d{3})[- ]?\d{3,4}[- ]?\d{3,4}[- ]?\d{3,5}\b", 0.3, HAS_DIGIT_RUN),),
            ("credit", "card", "visa", "mastercard", "cc", "amex", "discover", "jcb", "diners", "maestro", "instapayment"),
            checks.card_ok,
        ),
        Recognizer(
            "PERSON",
            (
                Pattern(rf"\b{word_tree(TITLES)}\.?\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\b", 0.85, HAS_KNOWN_WORD, False),
                Pattern(rf"\b{word_tree(FIRST_NAMES)}\s+[A-Z][a-z]+(?:-[A-Z][a-z]+)?\b", 0.85, HAS_KNOWN_WORD, False),
            ),
        ),
        Recognizer(
            "LOCATION",
            (
                Pattern(rf"\b{word_tree(COUNTRIES)}\b", 0.85, HAS_KNOWN_WORD, False),
                Pattern(r"\b\d{1,4}\s+[A-Z][a-z]+\s+(?:Street|Road|Avenue|Lane|Close|Way)\b", 0.85, HAS_DIGIT, False),
            ),
        ),
        Recognizer(
            "DATE_TIME",
            (
                Pattern(r"\b\d{4}[/-]\d{1,2}[/-]\d{1,2}(?:[T ]\d{2}:\d{2}(?::\d{2})?)?\b", 0.85, HAS_DIGIT),
                Pattern(r"\b\d{1,2}[/.-]\d{1,2}[/.-]\d{4}\b", 0.85, HAS_DIGIT),
                Pattern(rf"\b\d{{1,2}}(?:st|nd|rd|th)?\s+(?:{MONTHS})\s+\d{{4}}\b", 0.85, HAS_DIGIT),
                Pattern(rf"\b(?:{MONTHS})\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}\b", 0.85, HAS_DIGIT),
            ),
            ("date", "birthday"),
        ),
        Recognizer(
            "IP_ADDRESS",
            (
                Pattern(rf"\b(?:{OCTET}\.){{3}}{OCTET}\b", 0.6, HAS_ADDRESS_MARK),
                Pattern(r"\b(?:[0-9A-F]{1,4}:){7}[0-9A-F]{1,4}\b", 0.6, HAS_ADDRESS_MARK),
                Pattern(r"\b(?:[0-9A-F]{1,4}:){1,6}(?::[0-9A-F]{1,4}){1,6}\b", 0.6, HAS_ADDRESS_MARK),
            ),
            ("ip", "ipv4", "ipv6"),
        ),
        Recognizer(
            "IBAN_CODE",
            (Pattern(r"\b[A-Z]{2}\d{2}(?:[ -]?[A-Z0-9]{4}){2,7}(?:[ -]?[A-Z0-9]{1,3})?\b", 0.5, HAS_LETTER_DIGIT),),
            ("iban", "bank", "transaction"),
            checks.iban_ok,
        ),
    ]


def default_recognizers() -> list[Recognizer]:
    """The ten UK types and the eight general ones; entity types are unique."""
    found = uk_recognizers() + general_recognizers()
    order = {name: i for i, name in enumerate(ENTITY_TYPES)}
    return sorted(found, key=lambda r: order[r.entity_type])
