"""The derived ``people`` table: personal data computed from customer keys.

The driver tables hold no UK identifiers, so queries that need them use this
view.  The recipe is plain arithmetic, stated once for Spark and once for SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions.recognizers import CITIES, FIRST_NAMES, LAST_NAMES
from cloakframe.plans.layout import spread
from cloakframe.synth import NINO_PREFIXES, POSTCODES, luhn_digit, nhs_check

TEXT_COLUMNS = (
    "name", "email", "phone", "nino", "nhs", "card", "postcode", "city", "vrn", "sort_code", "ip",
    "notes", "passport_note",
)


def _pick(values, k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def _pad(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row_key")
    first, last = _pick(FIRST_NAMES, k), _pick(LAST_NAMES, F.floor(k / len(FIRST_NAMES)))
    nine = _pad((k * 104729) % 1_000_000_000, 9)
    check = nhs_check(nine)
    body = F.concat(F.lit("4111"), _pad((k * 1299709) % 100_000_000_000, 11))
    digit = luhn_digit(body)
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("row_key"))
    base = spread(keys, 3 * spark.sparkContext.defaultParallelism)
    return base.select(
        "row_key",
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), k.cast("string"), F.lit("@example.co.uk")).alias("email"),
        F.concat(F.lit("07"), _pad(k % 900 + 100, 3), F.lit(" "), _pad((k * 7919) % 1_000_000, 6)).alias("phone"),
        F.concat(
            F.when(k % 17 == 0, "BG").otherwise(_pick(NINO_PREFIXES, k)),
            _pad((k * 7919) % 1_000_000, 6),
            _pick("ABCD", k),
        ).alias("nino"),
        F.concat(nine, F.when(check == 10, 0).otherwise(check).cast("string")).alias("nhs"),
        F.concat(body, F.when(k % 13 == 0, (digit + 1) % 10).otherwise(digit).cast("string")).alias("card"),
        _pick(POSTCODES, k).alias("postcode"),
        _pick(CITIES, k).alias("city"),
        F.concat(_pick(("AB", "CD", "EF", "GH"), k), _pad(k % 100, 2), F.lit(" "), _pick(("KLM", "NPR", "STU"), k)).alias("vrn"),
        F.concat_ws("-", _pad(k % 100, 2), _pad((k * 3) % 100, 2), _pad((k * 7) % 100, 2)).alias("sort_code"),
        F.concat_ws(".", F.lit("10"), (k % 256).cast("string"), ((k * 7) % 256).cast("string"), ((k * 13) % 256).cast("string")).alias("ip"),
    ).select(
        "*",
        F.when(k % 5 == 0, F.when(k % 2 == 0, " \n").otherwise(""))
        .otherwise(F.concat(F.lit("Contact "), "name", F.lit(" at "), "email", F.lit(" or "), "phone"))
        .alias("notes"),
        F.concat(F.when(k % 2 == 0, "passport ").otherwise("ref "), _pad((k * 15485863) % 1_000_000_000, 9)).alias("passport_note"),
    )


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_NINE = "lpad(CAST((k*104729) % 1000000000 AS VARCHAR), 9, '0')"
_BODY = "'4111' || lpad(CAST((k*1299709) % 100000000000 AS VARCHAR), 11, '0')"

PEOPLE_SQL = f"""
people_keys AS (SELECT c_custkey AS k FROM customer),
people_parts AS (
  SELECT k,
    {_list(FIRST_NAMES)}[k % {len(FIRST_NAMES)} + 1] AS first_name,
    {_list(LAST_NAMES)}[CAST(floor(k / {len(FIRST_NAMES)}) AS BIGINT) % {len(LAST_NAMES)} + 1] AS last_name,
    {_NINE} AS nine,
    CAST((11 - list_sum(list_transform(range(1, 10), lambda i: CAST(substr({_NINE}, i, 1) AS INT) * (11 - i))) % 11) % 11 AS INT) AS nhs_digit,
    {_BODY} AS body,
    CAST((10 - list_sum(list_transform(range(1, 16), lambda i: CASE WHEN i % 2 = 1 THEN
        CASE WHEN CAST(substr({_BODY}, i, 1) AS INT) > 4 THEN CAST(substr({_BODY}, i, 1) AS INT) * 2 - 9
             ELSE CAST(substr({_BODY}, i, 1) AS INT) * 2 END
        ELSE CAST(substr({_BODY}, i, 1) AS INT) END)) % 10) % 10 AS INT) AS luhn
  FROM people_keys),
people_base AS (
  SELECT k AS row_key,
    first_name || ' ' || last_name AS name,
    lower(first_name) || '.' || lower(last_name) || CAST(k AS VARCHAR) || '@example.co.uk' AS email,
    '07' || lpad(CAST(k % 900 + 100 AS VARCHAR), 3, '0') || ' ' || lpad(CAST((k*7919) % 1000000 AS VARCHAR), 6, '0') AS phone,
    (CASE WHEN k % 17 = 0 THEN 'BG' ELSE {_list(NINO_PREFIXES)}[k % 10 + 1] END)
      || lpad(CAST((k*7919) % 1000000 AS VARCHAR), 6, '0') || ['A','B','C','D'][k % 4 + 1] AS nino,
    nine || CAST(CASE WHEN nhs_digit = 10 THEN 0 ELSE nhs_digit END AS VARCHAR) AS nhs,
    body || CAST(CASE WHEN k % 13 = 0 THEN (luhn + 1) % 10 ELSE luhn END AS VARCHAR) AS card,
    {_list(POSTCODES)}[k % 15 + 1] AS postcode,
    {_list(CITIES)}[k % {len(CITIES)} + 1] AS city,
    ['AB','CD','EF','GH'][k % 4 + 1] || lpad(CAST(k % 100 AS VARCHAR), 2, '0') || ' ' || ['KLM','NPR','STU'][k % 3 + 1] AS vrn,
    lpad(CAST(k % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST((k*3) % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST((k*7) % 100 AS VARCHAR), 2, '0') AS sort_code,
    '10.' || CAST(k % 256 AS VARCHAR) || '.' || CAST((k*7) % 256 AS VARCHAR) || '.' || CAST((k*13) % 256 AS VARCHAR) AS ip
  FROM people_parts),
people AS (
  SELECT *,
    CASE WHEN row_key % 5 = 0 THEN CASE WHEN row_key % 2 = 0 THEN ' ' || chr(10) ELSE '' END
         ELSE 'Contact ' || name || ' at ' || email || ' or ' || phone END AS notes,
    CASE WHEN row_key % 2 = 0 THEN 'passport ' ELSE 'ref ' END
      || lpad(CAST((row_key*15485863) % 1000000000 AS VARCHAR), 9, '0') AS passport_note
  FROM people_base)
"""
