"""Synthetic personal records as a Spark job.

Every value is arithmetic on a row key, so a record depends on nothing but its
key: the same on every retry, on any partitioning, and at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The lists and templates synthetic records draw from.
NAMES = (
    "James Smith", "Emma Johnson", "Oliver Williams", "Sophia Brown", "Harry Jones",
    "Emily Taylor", "Charlie Wilson", "Olivia Davies", "Jack Thomas", "Amelia Roberts",
    "George Evans", "Mia Walker", "William Wright", "Isabella Robinson", "Henry Hall",
    "Lily Green", "Oscar King", "Ava Wood", "Thomas Harris", "Grace Lewis",
)
POSTCODES = (
    "SW1A 1AA", "EC1A 1BB", "W1A 0AX", "M1 1AE", "B1 1AA", "G1 1AA", "EH1 1AA", "CF10 1AA",
    "BT1 1AA", "LS1 1AA", "NE1 1AA", "S1 1AA", "NG1 1AA", "L1 1AA", "BS1 1AA",
)
DOMAINS = (
    "gmail.com", "outlook.co.uk", "yahoo.co.uk", "company.co.uk", "university.ac.uk",
    "business.com", "organisation.org.uk",
)
TOWNS = (
    "London", "Manchester", "Birmingham", "Leeds", "Glasgow", "Liverpool", "Bristol",
    "Sheffield", "Edinburgh", "Cardiff",
)
STREETS = ("High", "Church", "Victoria", "Station", "Park")
STREET_TYPES = ("Street", "Road", "Avenue", "Lane", "Close", "Way")
NINO_PREFIXES = ("AB", "CB", "CC", "GH", "HJ", "JK", "LM", "NP", "PR", "RS")
CARD_PREFIXES = ("4111", "5500", "6011")

SIZES = {"small": 100, "medium": 1_000, "large": 10_000}

# A Lehmer step spreads neighbouring keys; its modulus is the prime 2^31 - 1.
MULTIPLIER, MODULUS = 48_271, 2_147_483_647


def draw(key: Column, field: int, n: int) -> Column:
    """A number in ``[0, n)`` for one field of one record."""
    first = (F.pmod(key, F.lit(MODULUS)) * MULTIPLIER + F.lit(field * 7919)) % MODULUS
    return (first * MULTIPLIER % MODULUS) % F.lit(n)


def between(key: Column, field: int, low: int, high: int) -> Column:
    return draw(key, field, high - low + 1) + F.lit(low)


def pick(values: Sequence[str], key: Column, field: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (draw(key, field, len(values)) + 1).cast("int"))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def name(key: Column) -> Column:
    return pick(NAMES, key, 1)


def email(key: Column) -> Column:
    """One of four shapes of the record's name at one of the domains."""
    parts = F.split(F.lower(name(key)), " ")
    first, last = parts[0], parts[1]
    shape = draw(key, 2, 4)
    local = (
        F.when(shape == 0, F.concat(first, F.lit("."), last))
        .when(shape == 1, F.concat(F.left(first, F.lit(1)), last))
        .when(shape == 2, F.concat(first, F.left(last, F.lit(1))))
        .otherwise(F.concat(first, F.lit("_"), last))
    )
    return F.concat(local, F.lit("@"), pick(DOMAINS, key, 3))


def phone(key: Column) -> Column:
    shape = draw(key, 4, 5)
    mobile = F.concat(
        between(key, 5, 100, 999).cast("string"), F.lit(" "), between(key, 6, 100_000, 999_999).cast("string")
    )
    london = F.concat(
        between(key, 7, 1000, 9999).cast("string"), F.lit(" "), between(key, 8, 1000, 9999).cast("string")
    )
    area = F.concat(
        between(key, 9, 1000, 9999).cast("string"), F.lit(" "), between(key, 10, 100_000, 999_999).cast("string")
    )
    return (
        F.when(shape == 0, F.concat(F.lit("+44 7"), mobile))
        .when(shape == 1, F.concat(F.lit("07"), mobile))
        .when(shape == 2, F.concat(F.lit("+44 20 "), london))
        .when(shape == 3, F.concat(F.lit("020 "), london))
        .otherwise(F.concat(F.lit("0"), area))
    )


def nino(key: Column) -> Column:
    return F.concat(
        pick(NINO_PREFIXES, key, 11), padded(draw(key, 12, 1_000_000), 6), pick(("A", "B", "C", "D"), key, 13)
    )


def _digits_sum(digits: Column, weights: Sequence[int]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights):
        total = total + F.substring(digits, i + 1, 1).cast("int") * F.lit(w)
    return total


def nhs_check(nine: Column) -> Column:
    """Mod-11 check digit; 10 means the nine digits have none."""
    return F.pmod(F.lit(11) - _digits_sum(nine, range(10, 1, -1)) % 11, F.lit(11))


def nhs_number(key: Column) -> Column:
    """Nine digits and their check digit.

    Raising the ninth digit (weight 2) by one, or lowering it from 9, moves the
    check by two, so digits without a valid check are shifted by one step.
    """
    nine = padded(draw(key, 14, 1_000_000_000), 9)
    last = F.substring(nine, 9, 1).cast("int")
    moved = F.concat(F.left(nine, F.lit(8)), F.when(last == 9, 8).otherwise(last + 1).cast("string"))
    good = F.when(nhs_check(nine) == 10, moved).otherwise(nine)
    return F.concat(good, nhs_check(good).cast("string"))


def luhn_digit(fifteen: Column) -> Column:
    total = F.lit(0)
    for i in range(15):
        d = F.substring(fifteen, i + 1, 1).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        total = total + (twice if i % 2 == 0 else d)
    return F.pmod(F.lit(10) - total % 10, F.lit(10))


def credit_card(key: Column) -> Column:
    body = F.concat(pick(CARD_PREFIXES, key, 15), padded(draw(key, 16, 1_000_000), 6), padded(draw(key, 17, 100_000), 5))
    return F.concat(body, luhn_digit(body).cast("string"))


def address(key: Column) -> Column:
    return F.concat_ws(
        " ",
        between(key, 18, 1, 200).cast("string"),
        pick(STREETS, key, 19),
        pick(STREET_TYPES, key, 20),
        pick(TOWNS, key, 21),
        pick(POSTCODES, key, 22),
    )


def date_of_birth(key: Column) -> Column:
    return F.concat_ws(
        "-",
        between(key, 23, 1950, 2005).cast("string"),
        padded(between(key, 24, 1, 12), 2),
        padded(between(key, 25, 1, 28), 2),
    )


def synthetic_records(keys: DataFrame, key: str, sensitive: bool = True) -> DataFrame:
    """Eight fields per key, and three more sensitive ones."""
    k = F.col(key).cast("bigint")
    fields = {
        "id": between(k, 0, 10_000, 99_999),
        "name": name(k),
        "email": email(k),
        "phone": phone(k),
        "address": address(k),
        "postcode": pick(POSTCODES, k, 26),
        "date_of_birth": date_of_birth(k),
        "notes": F.concat(F.lit("Customer since "), between(k, 27, 2010, 2024).cast("string")),
    }
    if sensitive:
        fields |= {"national_insurance": nino(k), "nhs_number": nhs_number(k), "credit_card": credit_card(k)}
    return keys.select(F.col(key), *[v.alias(n) for n, v in fields.items()])


def generate(spark: SparkSession, rows: int, sensitive: bool = True) -> DataFrame:
    """``rows`` records; write with ``maxRecordsPerFile`` for files of a given size."""
    keys = spark.range(1, rows + 1).withColumnRenamed("id", "record_key")
    return synthetic_records(keys, "record_key", sensitive)


def rows_for_size(kilobytes: int, bytes_per_row: int = 180) -> int:
    """How many records make a file of about this size."""
    return max(10, kilobytes * 1024 // bytes_per_row)


def plant(df: DataFrame, column: str, key: str, every: int = 10) -> DataFrame:
    """A labelled corpus: a sentence with personal data at the end of some texts.

    Adds ``planted_email``, ``planted_phone`` and ``planted_card`` (null where
    nothing was planted) as the truth to measure against.
    """
    k = F.col(key).cast("bigint")
    chosen = draw(k, 30, every) == 0
    truth = {"planted_email": email(k), "planted_phone": phone(k), "planted_card": credit_card(k)}
    labelled = df.withColumns({n: F.when(chosen, v) for n, v in truth.items()})
    tail = F.concat(
        F.lit(" Write to "), F.col("planted_email"), F.lit(" or call "), F.col("planted_phone"),
        F.lit(" about card "), F.col("planted_card"),
    )
    return labelled.withColumn(column, F.concat(F.col(column), F.coalesce(tail, F.lit(""))))
