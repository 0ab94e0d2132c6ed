"""Source, sink, job, audit, alarm, stream and synthetic-data queries.

Round trips write what Spark derives from the driver tables into the shared
scratch folder and read it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.operators import compare
from cloakframe.operators.detect import Detector, detect
from cloakframe.plans import audit as audit_log
from cloakframe.plans.jobs import gate_files, protect_files, read_lake
from cloakframe.plans.scratch import scratch_path
from cloakframe.sources import csv as csv_source
from cloakframe.sources import json as json_source
from cloakframe.sources import lake
from cloakframe.sources import parquet as parquet_source
from cloakframe.streaming import alarms
from cloakframe.streaming.protect_stream import alarm_stream, protect_arrivals, protect_stream
from cloakframe.synth import plant, synthetic_records
from suite.detection import table, texts
from suite.oracle_text import entities_sql
from suite.people import PEOPLE_SQL, people
from suite.protection import ORACLES as PROTECT_SQL
from suite.protection import POLICY, SECRETS, without_ciphertext

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def add(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


# Round trips ---------------------------------------------------------------

_TRICKY = """SELECT row_key, name, notes, CASE WHEN row_key % 3 = 0 THEN 'say "hi", ' || city ELSE '' END AS remark FROM people"""


def _tricky(spark, sf_dir) -> DataFrame:
    remark = F.when(F.col("row_key") % 3 == 0, F.concat(F.lit('say "hi", '), "city")).otherwise("")
    return people(spark, sf_dir).select("row_key", "name", "notes", remark.alias("remark"))


@query("csv_roundtrip_people", f"WITH {PEOPLE_SQL} SELECT CAST(row_key AS VARCHAR) AS row_key, name, notes, remark FROM ({_TRICKY})")
def csv_roundtrip_people(spark, sf_dir):
    path = scratch_path(spark, "csv")
    csv_source.write_csv(_tricky(spark, sf_dir), path)
    return csv_source.read_csv(spark, path)


@query("csv_semicolon_people", f"WITH {PEOPLE_SQL} SELECT CAST(row_key AS VARCHAR) AS row_key, name, email, phone, nino, nhs, card, postcode, city, vrn, sort_code, ip FROM people")
def csv_semicolon_people(spark, sf_dir):
    path = scratch_path(spark, "csv")
    csv_source.write_csv(people(spark, sf_dir).select("row_key", "name", "email", "phone", "nino", "nhs", "card", "postcode", "city", "vrn", "sort_code", "ip"), path, ";")
    groups, _ = gate_files(spark, path)
    rows = None
    for g in groups:
        one = csv_source.read_csv(spark, list(g.paths), g.delimiter, multi_line=g.multi_line)
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _text_files(spark, sf_dir) -> str:
    """Customer lines as CSV files per nation: some ragged, some with other delimiters."""
    path = scratch_path(spark, "nations")
    d = F.element_at(F.array(*map(F.lit, csv_source.DELIMITERS)), (F.col("c_nationkey") % 4 + 1).cast("int"))
    ragged = (F.col("c_nationkey") % 5 == 0) & (F.col("turn") == 3)
    line = F.concat(
        F.col("c_custkey").cast("string"), d, F.col("c_name"), d, F.col("c_mktsegment"),
        F.when(ragged, F.concat(d, F.lit("extra"))).otherwise(""),
    )
    from pyspark.sql import Window

    # The header comes with a nation's first line: Spark takes a union of two tables grouped by nation as grouped,
    # leaves out the repartition, and then merges the partitions of each one on its own.
    turn = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    head = F.concat(F.lit("id"), d, F.lit("name"), d, F.lit("segment"))
    own = F.struct("turn", line.alias("value"))
    rows = F.when(F.col("turn") == 1, F.array(F.struct(F.lit(0).alias("turn"), head.alias("value")), own)).otherwise(F.array(own))
    (
        table(spark, sf_dir, "customer")
        .withColumn("turn", turn)
        .select("c_nationkey", F.inline(rows))
        .repartition("c_nationkey")
        .sortWithinPartitions("c_nationkey", "turn")
        .select("c_nationkey", "value")
        .write.partitionBy("c_nationkey")
        .option("compression", "none")
        .text(path)
    )
    return path


_NATION_LINES = "(SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1)"


@query(
    "csv_gate_nations",
    # A ragged line in a file of fewer than ten leaves no delimiter with enough
    # agreement, so the configured comma is used.
    f"""SELECT nation, CASE WHEN sure THEN d ELSE ',' END AS delimiter, n + 1 AS lines,
    CASE WHEN ragged AND (sure OR d = ',') THEN 'Row 4 has 4 columns, expected 3' ELSE '' END AS error
    FROM (SELECT *, NOT ragged OR n / (n + 1) >= 0.9 AS sure FROM (
      SELECT *, [',', ';', chr(9), '|'][nation % 4 + 1] AS d, nation % 5 = 0 AND n >= 3 AS ragged FROM {_NATION_LINES}))""",
)
def csv_gate_nations(spark, sf_dir):
    files = csv_source.csv_files(spark, _text_files(spark, sf_dir))
    return files.select(
        F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int").alias("nation"),
        "delimiter", "lines", F.coalesce("error", F.lit("")).alias("error"),
    )


# All columns, with a number of any precision, a time and a null in every tenth row.
_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders"""


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")))


def _times_plain(df: DataFrame) -> DataFrame:
    """JSON has no times: they come back as texts, shown here without the T and fractions."""
    return df.withColumn("o_orderdate", F.replace(F.substring("o_orderdate", 1, 19), F.lit("T"), F.lit(" ")))


@query("json_array_roundtrip_orders", _ORDERS)
def json_array_roundtrip_orders(spark, sf_dir):
    path = scratch_path(spark, "json")
    json_source.write_json(_orders(spark, sf_dir), path)
    return _times_plain(json_source.read_json(spark, path))


@query("json_wrapped_roundtrip_orders", _ORDERS)
def json_wrapped_roundtrip_orders(spark, sf_dir):
    path = scratch_path(spark, "json")
    json_source.write_json(_orders(spark, sf_dir), path, "rows")
    return _times_plain(json_source.read_json(spark, path, "rows"))


@query(
    "json_shapes_orders",
    "SELECT shape, coalesce(p, '') AS records_path, count(*) > 0 AS present FROM (VALUES ('array', NULL), ('nested', 'data'), ('ndjson', NULL)) t(shape, p) GROUP BY ALL",
)
def json_shapes_orders(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "json")
    json_source.write_json(df, f"{path}/a")
    json_source.write_json(df, f"{path}/b", "data")
    json_source.write_ndjson(df, f"{path}/c")
    found = json_source.json_files(spark, [f"{path}/a", f"{path}/b", f"{path}/c"])
    return found.groupBy("shape", F.coalesce("records_path", F.lit("")).alias("records_path")).agg(
        (F.count("*") > 0).alias("present")
    )


@query(
    "ndjson_flatten_customers",
    """SELECT c_custkey AS id, c_name AS "who.name", c_nationkey AS "who.place.nation", c_mktsegment AS segment, c_acctbal AS "who.balance" FROM customer""",
)
def ndjson_flatten_customers(spark, sf_dir):
    path = scratch_path(spark, "ndjson")
    nested = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation")).alias("place"), F.col("c_acctbal").alias("balance")).alias("who"),
        F.col("c_mktsegment").alias("segment"),
    )
    json_source.write_ndjson(nested, path)
    return json_source.read_ndjson(spark, path)


@query("parquet_roundtrip_parts", "SELECT * FROM part")
def parquet_roundtrip_parts(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    parquet_source.write_parquet(table(spark, sf_dir, "part"), path)
    return parquet_source.read_parquet(spark, path)


@query("parquet_gate_tables", "SELECT 14 AS files, 0 AS refused")
def parquet_gate_tables(spark, sf_dir):
    files = parquet_source.parquet_files(spark, f"{sf_dir}/*.parquet")
    tables = files.groupBy(lake.named_folder(spark, F.col("path"), sf_dir)).agg(F.count("error").alias("errors"))
    return tables.agg(F.count("*").alias("files"), F.count_if(F.col("errors") > 0).alias("refused"))


@query(
    "stringify_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
    CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(event_id % 100 AS VARCHAR) END AS maybe,
    '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]' AS pair FROM events""",
)
def stringify_events(spark, sf_dir):
    k = F.col("event_id")
    df = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.when(k % 4 != 0, k % 100).alias("maybe"),
        F.array("event_type", F.col("user_id").cast("string")).alias("pair"),
    )
    return lake.stringify(df)


@query(
    "file_profile_tables",
    "SELECT 'customer.parquet' AS file_name, 'PARQUET' AS file_format, count(*) AS row_count, 5 AS column_count, 'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey' AS columns FROM customer",
)
def file_profile_tables(spark, sf_dir):
    profile = lake.file_profile(table(spark, sf_dir, "customer"))
    return profile.select(
        "file_name", "file_format", "row_count", "column_count", F.array_join(F.array_sort("columns"), ",").alias("columns")
    )


_NAMES = """(SELECT c_custkey AS k, 'in/' || c_name || ['.csv', '.JSON', '.ndjson', '.Parquet', '.txt', ''][c_custkey % 6 + 1] AS path,
   CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 10 END AS length FROM customer)"""


@query(
    "receive_gate_names",
    f"""SELECT path, coalesce(['csv', 'json', 'json', 'parquet'][k % 6 + 1], '') AS format,
    coalesce(['CSV', 'JSON', 'NDJSON', 'PARQUET'][k % 6 + 1], 'UNKNOWN') AS display,
    CASE WHEN length = 0 THEN 'Empty content received' WHEN k % 6 >= 4 THEN 'Unsupported file format: ' || substr(path, 4) ELSE '' END AS error
    FROM {_NAMES}""",
)
def receive_gate_names(spark, sf_dir):
    k = F.col("c_custkey")
    suffix = F.element_at(F.array(*map(F.lit, [".csv", ".JSON", ".ndjson", ".Parquet", ".txt", ""])), (k % 6 + 1).cast("int"))
    names = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("in/"), "c_name", suffix).alias("path"), F.when(k % 11 == 0, 0).otherwise(10).alias("length")
    )
    return lake.receive_gate(names).select(
        "path", F.coalesce("format", F.lit("")).alias("format"), "display", F.coalesce("error", F.lit("")).alias("error")
    )


@query("listing_tables", "SELECT unnest(['benchmark','conversations','customer','documents','embeddings','events','labels','lineitem','nation','orders','pages','part','region','supplier']) || '.parquet' AS file_name, 'parquet' AS format, true AS filled")
def listing_tables(spark, sf_dir):
    return lake.classify_files(spark, sf_dir, folders=True).select("file_name", "format", (F.col("length") > 0).alias("filled"))


@query(
    "work_list_orders",
    """SELECT 'raw' AS bucket, 'in/' || o_orderstatus || ' ' || o_orderkey || '.csv' AS key FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT 'raw', 'two/' || o_orderkey || '.json' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT 'bus', 'in/' || o_orderstatus || '+' || o_orderkey || '.csv' FROM orders WHERE o_orderkey % 3 = 1""",
)
def work_list_orders(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    records = F.concat(
        F.lit('{"Records":[{"s3":{"bucket":{"name":"raw"},"object":{"key":"in/'), status, F.lit("+"), k,
        F.lit('.csv"}}},{"s3":{"bucket":{"name":"raw"},"object":{"key":"two%2F'), k, F.lit('.json"}}}]}'),
    )
    bus = F.concat(
        F.lit('{"source":"aws.s3","detail":{"bucket":{"name":"bus"},"object":{"key":"in/'), status, F.lit("+"), k, F.lit('.csv"}}}')
    )
    value = F.when(F.col("o_orderkey") % 3 == 0, records).when(F.col("o_orderkey") % 3 == 1, bus).otherwise('{"other":1}')
    return lake.work_list(table(spark, sf_dir, "orders").select(value.alias("value")))


# File jobs -----------------------------------------------------------------

def _lake_folder(spark, sf_dir) -> str:
    path = scratch_path(spark, "lake")
    df = people(spark, sf_dir).select("row_key", "name", "email", "notes")
    csv_source.write_csv(df, f"{path}/csv")
    json_source.write_ndjson(df, f"{path}/json")
    parquet_source.write_parquet(df, f"{path}/parquet")
    df.select(F.col("email").alias("value")).write.text(f"{path}/text")
    return path


_JOB = entities_sql("people", "row_key", ("name", "email", "notes"), None, 0.7, PEOPLE_SQL)


@query("read_lake_people", f"WITH {PEOPLE_SQL} SELECT f AS format, count(*) AS rows, count(DISTINCT row_key) AS keys FROM people, (SELECT unnest(['csv','json','parquet']) AS f) GROUP BY f")
def read_lake_people(spark, sf_dir):
    out = None
    for fmt, df in read_lake(spark, _lake_folder(spark, sf_dir)).items():
        one = df.agg(F.count("*").alias("rows"), F.count_distinct(F.col("row_key").cast("string")).alias("keys"))
        one = one.select(F.lit(fmt).alias("format"), "rows", "keys")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "protect_files_people",
    PROTECT_SQL["protect_people"].rsplit("SELECT p.row_key", 1)[0]
    + """ SELECT f.format, CAST(p.row_key AS VARCHAR) AS row_key,
      coalesce((SELECT cell FROM rewritten r WHERE r.row_key = p.row_key AND column_name = 'email'), p.email) AS email,
      coalesce((SELECT cell FROM rewritten r WHERE r.row_key = p.row_key AND column_name = 'notes'), p.notes) AS notes
      FROM people p, (SELECT unnest(['csv','json','parquet']) AS format) f""",
)
def protect_files_people(spark, sf_dir):
    target = scratch_path(spark, "out")
    protect_files(spark, _lake_folder(spark, sf_dir), target, POLICY, SECRETS)
    return _protected(spark, target)


@query(
    "protect_files_audit_people",
    _JOB + """ SELECT f AS file_format, (SELECT count(*) FROM people) AS cells, e.entity_type, count(*) AS entities
      FROM entities e, (SELECT unnest(['CSV','JSON','PARQUET']) AS f) GROUP BY ALL""",
)
def protect_files_audit_people(spark, sf_dir):
    target = scratch_path(spark, "out")
    protect_files(
        spark, _lake_folder(spark, sf_dir), f"{target}/data", POLICY, SECRETS, audit_path=f"{target}/audit"
    )
    log = spark.read.parquet(f"{target}/audit")
    scanned = log.groupBy("file_format").agg(F.sum("detection_summary.cells_scanned").alias("all_cells"))
    counts = log.select("file_format", F.explode("detection_summary.entity_counts").alias("entity_type", "n"))
    # CSV also scans the key, which is text there.
    width = F.when(F.col("file_format") == "CSV", 4).otherwise(3)
    return counts.groupBy("file_format", "entity_type").agg(F.sum("n").alias("entities")).join(scanned, "file_format").select(
        "file_format", (F.col("all_cells") / width).cast("bigint").alias("cells"), "entity_type", "entities"
    )


def _finish(df: DataFrame) -> DataFrame:
    """Some rows lost, some e-mails blanked, and the key as text."""
    k = F.col("row_key").cast("bigint")
    return df.where(k % 50 != 7).withColumn("email", F.when(k % 3 != 0, F.col("email"))).withColumn("row_key", F.col("row_key").cast("string"))


@query(
    "protect_files_schema_issues",
    # Files are of any number, so counts are summed; CSV has neither nulls nor numbers.
    f"""WITH {PEOPLE_SQL} SELECT f AS format, 'error' AS severity, '' AS "column", 'Row count mismatch' AS message, count(*) FILTER (row_key % 50 = 7) AS lost, 0 AS nulls
      FROM people, (SELECT unnest(['csv', 'json', 'parquet']) AS f) GROUP BY f
    UNION ALL SELECT f, 'warning', 'email', 'Column ''email'' gained null values after protection', 0, count(*) FILTER (row_key % 50 <> 7 AND row_key % 3 = 0)
      FROM people, (SELECT unnest(['json', 'parquet']) AS f) GROUP BY f
    UNION ALL SELECT f, 'info', 'row_key', 'Type widened for ''row_key'': bigint -> string', 0, 0 FROM (SELECT unnest(['json', 'parquet']) AS f)""",
)
def protect_files_schema_issues(spark, sf_dir):
    target = scratch_path(spark, "out")
    protect_files(spark, _lake_folder(spark, sf_dir), target, POLICY, SECRETS, finish=_finish)
    found = spark.read.parquet(f"{target}/schema_issues")

    def sum_of(high: str, low: str):
        return F.coalesce(F.sum(F.try_element_at("details", F.lit(high)).cast("bigint") - F.try_element_at("details", F.lit(low)).cast("bigint")), F.lit(0))

    return found.groupBy(
        F.split("source_key", "/")[0].alias("format"), "severity", F.coalesce("column", F.lit("")).alias("column"), F.split("message", ": [0-9]")[0].alias("message")
    ).agg(sum_of("original_rows", "protected_rows").alias("lost"), sum_of("protected_nulls", "original_nulls").alias("nulls"))


def _protected(spark, target: str) -> DataFrame:
    """The rewritten columns of what a job wrote, all formats."""
    read = {
        "csv": csv_source.read_csv(spark, f"{target}/protected/csv/*/*.csv"),
        "json": spark.read.json(f"{target}/protected/json"),
        "parquet": spark.read.parquet(f"{target}/protected/parquet"),
    }
    out = None
    for fmt, df in read.items():
        one = df.select(F.lit(fmt).alias("format"), F.col("row_key").cast("string").alias("row_key"), "email", "notes")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "stream_protect_mixed_lake",
    f"""SELECT 'output' AS kind, format, row_key, email, notes, 1 AS n FROM ({ORACLES["protect_files_people"]})
    UNION ALL SELECT 'cells', f.format, '', '', '', count(*) * f.width FROM customer, (VALUES ('CSV', 4), ('JSON', 3), ('PARQUET', 3)) f(format, width) GROUP BY f.format, f.width
    UNION ALL SELECT 'issues', '', '', '', '', 0
    UNION ALL SELECT 'refused', 'txt', '', '', '', 1 WHERE (SELECT count(*) FROM customer) > 0""",
)
def stream_protect_mixed_lake(spark, sf_dir):
    target = scratch_path(spark, "out")
    # Two batches at least, so that outputs of several batches meet in one folder.
    protect_arrivals(
        spark, _lake_folder(spark, sf_dir), target, f"{target}/check", POLICY, SECRETS, files_per_trigger=60, audit_path=f"{target}/audit"
    ).awaitTermination()
    none = F.lit("")

    def counts(df: DataFrame, kind: str, fmt, n) -> DataFrame:
        return df.groupBy(fmt.alias("format")).agg(n.cast("bigint").alias("n")).select(F.lit(kind).alias("kind"), "format", none.alias("row_key"), none.alias("email"), none.alias("notes"), "n")

    log = spark.read.parquet(f"{target}/audit")
    cells = counts(log.where("success"), "cells", F.col("file_format"), F.sum("detection_summary.cells_scanned"))
    issues = spark.read.parquet(f"{target}/schema_issues").agg(F.count("*").alias("n")).select(F.lit("issues").alias("kind"), none.alias("format"), none.alias("row_key"), none.alias("email"), none.alias("notes"), "n")
    aside = spark.read.parquet(f"{target}/quarantine").select(F.element_at(F.split("path", "[.]"), -1).alias("suffix")).distinct()
    refused = counts(aside, "refused", F.col("suffix"), F.count("*"))
    rows = _protected(spark, target).select(F.lit("output").alias("kind"), "format", "row_key", "email", "notes", F.lit(1).cast("bigint").alias("n"))
    return rows.unionByName(cells).unionByName(issues).unionByName(refused)


@query("run_summary_people", "SELECT true AS some_processed, true AS some_failed, 207 AS status")
def run_summary_people(spark, sf_dir):
    results = protect_files(spark, _lake_folder(spark, sf_dir), scratch_path(spark, "out"), POLICY, SECRETS)
    return audit_log.run_summary(results).select(
        (F.col("processed") > 0).alias("some_processed"), (F.col("failed") > 0).alias("some_failed"), "status"
    )


# Audit ---------------------------------------------------------------------

def _runs(spark, sf_dir) -> DataFrame:
    """Events as processing runs: a user's events are runs over one file."""
    k = F.col("event_id")
    file = F.concat(F.lit("in/u"), F.col("user_id").cast("string"), F.lit(".csv"))
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), k.cast("string")).alias("request_id"),
        F.lit("raw").alias("source_bucket"),
        file.alias("source_key"),
        F.when(~failed, F.concat(F.lit("protected/"), file)).alias("secure_key"),
        F.lit("CSV").alias("file_format"),
        (~failed).alias("success"),
        F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
        F.col("ts").alias("processed_at"),
        F.struct(F.create_map(F.lit("EMAIL_ADDRESS"), k % 5, F.lit("UK_NHS"), k % 3).alias("entity_counts")).alias("detection_summary"),
        F.struct(F.create_map(F.lit("sha256_hash"), k % 5, F.lit("tokenization"), k % 3).alias("methods_used")).alias("protection_summary"),
        F.map_from_entries(
            F.filter(
                F.array(
                    F.struct(F.lit("output"), k % 7),
                    F.struct(F.lit("receive"), k % 2),
                    F.struct(F.lit("detect"), k % 50),
                    F.struct(F.lit("other"), k % 3),
                ),
                lambda e: e.getField("col2") > 0,
            )
        ).alias("stage_durations"),
        F.when(failed, "failed").alias("error"),
    )


_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_AUDIT = f"""audit AS (SELECT 'FILE#raw/in/u' || user_id || '.csv' AS pk, 'PROCESS#' || {_ISO} AS sk,
  'DATE#' || strftime(ts, '%Y-%m-%d') AS gsi1pk, 'FILE#u' || user_id || '.csv' AS gsi1sk, 'r' || event_id AS request_id,
  event_type <> 'error' AS success, CAST(round(value * 1000) AS BIGINT) AS duration_ms,
  CAST(floor(epoch(ts)) AS BIGINT) + 7776000 AS ttl, event_id, ts FROM events)"""


def _audit(spark, sf_dir):
    return audit_log.audit_rows(_runs(spark, sf_dir))


@query("audit_rows_events", f"WITH {_AUDIT} SELECT pk, sk, gsi1pk, gsi1sk, request_id, success, duration_ms, ttl FROM audit")
def audit_rows_events(spark, sf_dir):
    return _audit(spark, sf_dir).select("pk", "sk", "gsi1pk", "gsi1sk", "request_id", "success", "duration_ms", "ttl")


@query("audit_latest_events", f"WITH {_AUDIT} SELECT pk, max(sk) AS sk, arg_max(request_id, sk) AS request_id FROM audit GROUP BY pk")
def audit_latest_events(spark, sf_dir):
    return audit_log.latest(_audit(spark, sf_dir)).select("pk", "sk", "request_id")


@query("audit_day_events", f"WITH {_AUDIT} SELECT pk, sk, request_id FROM audit WHERE gsi1pk = 'DATE#2024-01-10'")
def audit_day_events(spark, sf_dir):
    path = scratch_path(spark, "audit")
    audit_log.write_audit(_audit(spark, sf_dir), path)
    return audit_log.read_day(spark, path, "2024-01-10").select("pk", "sk", "request_id")


@query("audit_unexpired_events", f"WITH {_AUDIT} SELECT request_id, ttl FROM audit WHERE ttl > 1712500000")
def audit_unexpired_events(spark, sf_dir):
    return audit_log.unexpired(_audit(spark, sf_dir), F.lit(1712500000)).select("request_id", "ttl")


@query("audit_retention_events", f"WITH {_AUDIT} SELECT request_id, ttl, strftime(ts, '%Y-%m-%d') AS day FROM audit WHERE ttl > 1712500000")
def audit_retention_events(spark, sf_dir):
    path = scratch_path(spark, "audit")
    audit_log.write_audit(_audit(spark, sf_dir), path)
    audit_log.expire(spark, path, 1712500000)
    return spark.read.parquet(path).select("request_id", "ttl", F.col("dt").cast("string").alias("day"))


@query(
    "audit_stage_rows_events",
    """SELECT 'r' || event_id AS request_id, pos, stage, ms AS duration_ms FROM (
      SELECT event_id, 1 AS pos, 'receive' AS stage, event_id % 2 AS ms FROM events
      UNION ALL SELECT event_id, 3, 'detect', event_id % 50 FROM events
      UNION ALL SELECT event_id, 7, 'output', event_id % 7 FROM events) WHERE ms > 0""",
)
def audit_stage_rows_events(spark, sf_dir):
    return audit_log.stage_rows(_audit(spark, sf_dir), ("request_id",))


@query(
    "dashboard_events",
    """SELECT 'entity_type' AS kind, 'EMAIL_ADDRESS' AS name, sum(event_id % 5)::BIGINT AS n FROM events
    UNION ALL SELECT 'entity_type', 'UK_NHS', sum(event_id % 3)::BIGINT FROM events
    UNION ALL SELECT 'method', 'sha256_hash', sum(event_id % 5)::BIGINT FROM events
    UNION ALL SELECT 'method', 'tokenization', sum(event_id % 3)::BIGINT FROM events""",
)
def dashboard_events(spark, sf_dir):
    return audit_log.dashboard(_audit(spark, sf_dir))


@query(
    "audit_exact_numbers_events",
    "SELECT event_id, CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR) AS value FROM events",
)
def audit_exact_numbers_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", audit_log.exact(F.col("value")).cast("string").alias("value"))


@query(
    "bench_stats_events",
    """SELECT event_type, count(*) AS runs, round(avg(value), 6) AS mean_ms, min(value) AS min_ms, max(value) AS max_ms,
    round((sum(user_id * 1000) / 1000000.0) / (sum(value) / 1000.0), 6) AS mb_per_s FROM events GROUP BY event_type""",
)
def bench_stats_events(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select("event_type", F.col("value").alias("ms"), (F.col("user_id") * 1000).alias("bytes"))
    return compare.bench_stats(runs, ["event_type"]).withColumns(
        {"mean_ms": F.round("mean_ms", 6), "mb_per_s": F.round("mb_per_s", 6)}
    )


# Alarms --------------------------------------------------------------------

def _log_columns():
    kind = F.col("event_type")
    return [
        "ts",
        F.when(kind == "error", 1).otherwise(0).alias("errors"),
        (F.col("value") * 1000).alias("duration_ms"),
        F.when(kind == "signup", 1).otherwise(0).alias("throttles"),
        F.lit(1).alias("invocations"),
    ]


def _run_log(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(*_log_columns())


# The events are sparser than a real run log, so thresholds are scaled down.
SCALED = {
    "error_rate": alarms.Alarm("error_rate", "errors", "sum", 5, 0.5, periods=2),
    "latency": alarms.Alarm("latency", "duration_ms", "avg", 5, 60_000, periods=2),
    "throttle": alarms.Alarm("throttle", "throttles", "sum", 5, 1, inclusive=True),
    "volume": alarms.Alarm("volume", "invocations", "sum", 60, 15),
}


def _alarm_sql(a: alarms.Alarm, closed: str = "") -> str:
    value = {
        "errors": "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
        "duration_ms": "value * 1000",
        "throttles": "CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END",
        "invocations": "1",
    }[a.value]
    seconds = a.minutes * 60
    op = ">=" if a.inclusive else ">"
    on = "breach"
    if a.periods == 2:
        on = f"breach AND coalesce(lag(breach) OVER (ORDER BY p) AND lag(p) OVER (ORDER BY p) = p - {seconds}, false)"
    return f"""WITH per AS (
      SELECT CAST(floor(epoch(ts) / {seconds}) AS BIGINT) * {seconds} AS p, {a.statistic}({value}) AS m FROM events GROUP BY 1),
    judged AS (SELECT p, m, m {op} {a.threshold} AS breach FROM per)
    SELECT '{a.name}' AS alarm, p AS period_start, round(CAST(m AS DOUBLE), 3) AS measured, breach, {on} AS alarm_on
    FROM judged {closed}"""


def _alarm_rows(periods: DataFrame) -> DataFrame:
    return periods.select(
        "alarm", F.unix_timestamp("period_start").alias("period_start"), F.round("measured", 3).alias("measured"), "breach", "alarm_on"
    )


for _name, _alarm in SCALED.items():
    def _run(spark: SparkSession, sf_dir: str, a=_alarm) -> DataFrame:
        return _alarm_rows(alarms.alarm_periods(_run_log(spark, sf_dir), a))

    QUERIES[f"alarm_{_name}_events"] = _run
    ORACLES[f"alarm_{_name}_events"] = _alarm_sql(_alarm)


@query(
    "monitor_series_events",
    """SELECT CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS period_start, count(*) AS runs,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors, round(avg(value * 1000), 3) AS mean_ms FROM events GROUP BY 1""",
)
def monitor_series_events(spark, sf_dir):
    return alarms.monitor_series(_run_log(spark, sf_dir)).select(
        F.unix_timestamp("period_start").alias("period_start"), "runs", "errors", F.round("mean_ms", 3).alias("mean_ms")
    )


@query(
    "max_concurrency_events",
    """WITH d AS (
      SELECT epoch_us(ts) AS us, 1 AS d FROM events
      UNION ALL SELECT epoch_us(ts) + CAST(round(value * 1000 * 1000) AS BIGINT), -1 FROM events),
    i AS (SELECT us, sum(d) AS d FROM d GROUP BY us),
    l AS (SELECT us, sum(d) OVER (ORDER BY us) AS after FROM i),
    s AS (SELECT unnest(range((SELECT min(us) // 300000000 FROM l), (SELECT max(us) // 300000000 FROM l) + 1)) AS slot),
    c AS (SELECT slot, coalesce(l.after, 0) AS going FROM s ASOF LEFT JOIN l ON s.slot * 300000000 >= l.us)
    SELECT slot * 300 AS period_start, greatest(any_value(going), max(after))::BIGINT AS max_running
    FROM c LEFT JOIN l ON l.us // 300000000 = slot GROUP BY slot HAVING any_value(going) > 0 OR count(after) > 0""",
)
def max_concurrency_events(spark, sf_dir):
    return alarms.max_concurrency(_run_log(spark, sf_dir)).select(
        F.unix_timestamp("period_start").alias("period_start"), F.col("max_running").cast("bigint").alias("max_running")
    )


# Streams -------------------------------------------------------------------

def _stream(spark, sf_dir, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of them."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).option("recursiveFileLookup", True).parquet(f"{sf_dir}/{name}.parquet")


@query(
    "stream_alarm_error_rate_events",
    _alarm_sql(SCALED["error_rate"], "WHERE p + 300 <= (SELECT epoch(max(ts)) FROM events)"),
)
def stream_alarm_error_rate_events(spark, sf_dir):
    path = scratch_path(spark, "alarms")
    periods = alarms.alarm_periods(_stream(spark, sf_dir, "events").select(*_log_columns()), SCALED["error_rate"], late="0 seconds")
    alarm_stream(periods, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return _alarm_rows(spark.read.parquet(f"{path}/table"))


@query(
    "stream_monitor_events",
    "SELECT * FROM (" + ORACLES["monitor_series_events"] + ") WHERE period_start + 300 <= (SELECT epoch(max(ts)) FROM events)",
)
def stream_monitor_events(spark, sf_dir):
    path = scratch_path(spark, "monitor")
    series = alarms.monitor_series(_stream(spark, sf_dir, "events").select(*_log_columns()), late="0 seconds")
    alarm_stream(series, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/table").select(
        F.unix_timestamp("period_start").alias("period_start"), "runs", "errors", F.round("mean_ms", 3).alias("mean_ms")
    )


@query("stream_protect_documents", PROTECT_SQL["protect_documents"])
def stream_protect_documents(spark, sf_dir):
    path = scratch_path(spark, "stream")
    stream = _stream(spark, sf_dir, "documents").select("doc_id", "text")
    protect_stream(stream, f"{path}/table", f"{path}/checkpoint", POLICY, SECRETS).awaitTermination()
    return without_ciphertext(spark.read.parquet(f"{path}/table").select("doc_id", "text"), ["text"])


# Synthetic data ------------------------------------------------------------

def _draw_sql(field: int, n: int) -> str:
    return f"(((((k % 2147483647) * 48271 + {field * 7919}) % 2147483647) * 48271 % 2147483647) % {n})"


@query(
    "synthetic_records_customers",
    f"""SELECT c_custkey, true AS nhs_ok, true AS card_ok, true AS nino_ok, true AS email_ok, true AS born_ok,
    {_draw_sql(0, 90000)} + 10000 AS id,
    CAST({_draw_sql(23, 56)} + 1950 AS VARCHAR) || '-' || lpad(CAST({_draw_sql(24, 12)} + 1 AS VARCHAR), 2, '0') || '-'
      || lpad(CAST({_draw_sql(25, 28)} + 1 AS VARCHAR), 2, '0') AS date_of_birth
    FROM (SELECT c_custkey, c_custkey AS k FROM customer)""",
)
def synthetic_records_customers(spark, sf_dir):
    from cloakframe.functions.checks import card_ok, nhs_ok, nino_ok

    df = synthetic_records(table(spark, sf_dir, "customer"), "c_custkey")
    return df.select(
        "c_custkey",
        nhs_ok(F.col("nhs_number")).alias("nhs_ok"),
        card_ok(F.col("credit_card")).alias("card_ok"),
        nino_ok(F.col("national_insurance")).alias("nino_ok"),
        F.col("email").rlike(r"^[a-z._]+@[a-z.]+$").alias("email_ok"),
        F.col("date_of_birth").rlike(r"^\d{4}-\d{2}-\d{2}$").alias("born_ok"),
        "id",
        "date_of_birth",
    )


@query(
    "planted_accuracy_documents",
    f"""WITH k AS (SELECT doc_id AS k FROM documents), planted AS (SELECT count(*) AS n FROM k WHERE {_draw_sql(30, 10)} = 0)
    SELECT t AS entity_type, n AS tp, 0 AS "fn" FROM planted, (SELECT unnest(['EMAIL_ADDRESS', 'UK_PHONE', 'CREDIT_CARD']) AS t)""",
)
def planted_accuracy_documents(spark, sf_dir):
    corpus = plant(texts(spark, sf_dir, "documents", "doc_id", "text"), "text", "doc_id")
    truth = F.array(
        F.struct(F.lit("EMAIL_ADDRESS").alias("entity_type"), F.col("planted_email").alias("text")),
        F.struct(F.lit("UK_PHONE").alias("entity_type"), F.col("planted_phone").alias("text")),
        F.struct(F.lit("CREDIT_CARD").alias("entity_type"), F.col("planted_card").alias("text")),
    )
    labels = corpus.select("doc_id", F.inline(truth)).filter("text IS NOT NULL").withColumn("is_pii", F.lit(True))
    found = detect(corpus, "doc_id", Detector(0.7), ["text"])
    return compare.confusion(labels, found, ["doc_id", "text"]).select("entity_type", "tp", "fn")
