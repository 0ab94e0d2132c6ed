"""Check-digit and structure tests for matched text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-letter National Insurance prefixes that are never issued.
NINO_BANNED_PREFIXES = ("BG", "GB", "NK", "KN", "TN", "NT", "ZZ")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def nhs_ok(text: Column) -> Column:
    """Ten digits whose last one is the mod-11 check digit of the first nine."""
    d = digits_of(text)
    weighted = F.aggregate(
        F.sequence(F.lit(1), F.lit(9)),
        F.lit(0),
        lambda acc, i: acc + F.substring(d, i, F.lit(1)).cast("int") * (F.lit(11) - i),
    )
    # 11 - r, with 11 folded to 0; a result of 10 can never equal one digit.
    check = F.pmod(F.lit(11) - weighted % F.lit(11), F.lit(11))
    return F.when(F.length(d) == 10, check == F.substring(d, 10, 1).cast("int")).otherwise(False)


def nino_ok(text: Column) -> Column:
    bare = F.upper(F.replace(text, F.lit(" "), F.lit("")))
    return (F.length(bare) == 9) & ~F.substring(bare, 1, 2).isin(*NINO_BANNED_PREFIXES)


def card_ok(text: Column) -> Column:
    """Luhn-valid, and not a 13-digit number starting with 1 (a millisecond clock)."""
    d = digits_of(text)
    clock = (F.length(text) == 13) & F.startswith(text, F.lit("1"))
    return F.call_function("luhn_check", d) & ~clock


def iban_ok(text: Column) -> Column:
    """ISO 7064 mod 97 over country+check moved to the end, letters as 10..35."""
    bare = F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")
    moved = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def fold(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    rest = F.aggregate(F.sequence(F.lit(1), F.length(bare)), F.lit(0), fold)
    return F.when(F.length(bare).between(15, 34), rest == 1).otherwise(False)
