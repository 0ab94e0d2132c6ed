"""The audit table: one row per processed file, its lookups and its retention."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.plans.scratch import children, exists, move, remove

# Days a record is kept, and the order of processing stages.
RETENTION_DAYS = 90
STAGES = ("receive", "validate", "detect", "evaluate", "protect", "schema_check", "output")


def audit_rows(runs: DataFrame) -> DataFrame:
    """Audit records from run rows.

    ``runs`` needs ``request_id, source_bucket, source_key, secure_key,
    file_format, success, duration_ms, processed_at (timestamp),
    detection_summary, protection_summary, stage_durations, error``.  None of
    them holds raw text: summaries are counts.
    """
    at = F.col("processed_at")
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    name = F.element_at(F.split("source_key", "/"), -1)
    return runs.select(
        F.concat(F.lit("FILE#"), "source_bucket", F.lit("/"), "source_key").alias("pk"),
        F.concat(F.lit("PROCESS#"), iso).alias("sk"),
        F.concat(F.lit("DATE#"), F.date_format(at, "yyyy-MM-dd")).alias("gsi1pk"),
        F.concat(F.lit("FILE#"), name).alias("gsi1sk"),
        "request_id",
        "source_bucket",
        "source_key",
        "secure_key",
        "file_format",
        "success",
        F.col("duration_ms").cast("bigint").alias("duration_ms"),
        iso.alias("timestamp"),
        "detection_summary",
        "protection_summary",
        "stage_durations",
        "error",
        (F.unix_timestamp(at) + F.lit(RETENTION_DAYS * 86_400)).alias("ttl"),
    )


def exact(number: Column) -> Column:
    """A floating number as the decimal the audit table stores."""
    return number.cast("decimal(18,6)")


def write_audit(audit: DataFrame, path: str, run: str | None = None) -> bool:
    """Rows partitioned by day and run; failure is reported, not raised.

    A run, done again under the same name, replaces its rows of that day and no others.
    """
    try:
        named = audit.withColumns({"dt": F.substring("timestamp", 1, 10), "run": F.lit(run or uuid.uuid4().hex)})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "run").parquet(path)
        return True
    except Exception as e:
        import logging

        logging.getLogger(__name__).warning("audit not written: %s", e)
        return False


def read_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Records of one day; Spark reads that partition only."""
    return spark.read.parquet(path).filter(F.col("dt") == F.lit(day).cast("date"))


def latest(audit: DataFrame) -> DataFrame:
    """The newest record of each file.

    ``max_by`` aggregates on the map side, so a file processed very often does
    not become one big group to sort.
    """
    rest = [c for c in audit.columns if c != "pk"]
    return audit.groupBy("pk").agg(F.max_by(F.struct(*rest), "sk").alias("r")).select("pk", "r.*")


def unexpired(audit: DataFrame, now: Column | None = None) -> DataFrame:
    """Records whose time to live has not passed."""
    return audit.filter(F.col("ttl") > (F.unix_timestamp() if now is None else now))


def expire(spark: SparkSession, path: str, now: int) -> dict[str, list[str]]:
    """Takes records whose time to live has passed by ``now`` (seconds) out of the table at ``path``.

    A day without any other records goes as a whole, a day with some is written anew beside the table and
    swapped in by renaming, and no other day is touched.  Returns the days ``dropped`` and ``rewritten``.  A
    swap that broke off is completed, or taken back, by the next call; one call may run at a time.  Appends to
    a day that is being rewritten are not seen, so that day should be over, as one of past time to live is.
    """
    aside = f"{path}/_retention"
    for day in children(spark, aside):
        if not exists(spark, f"{path}/{day}"):
            whole = exists(spark, f"{aside}/{day}/new/_SUCCESS")
            move(spark, f"{aside}/{day}/{'new' if whole else 'old'}", f"{path}/{day}")
    remove(spark, aside)
    days = spark.read.parquet(path).groupBy("dt").agg(F.min("ttl").alias("first"), F.max("ttl").alias("last")).orderBy("dt").collect()
    out: dict[str, list[str]] = {"dropped": [], "rewritten": []}
    for r in days:
        day = f"dt={r.dt}"
        if r.last <= now:
            remove(spark, f"{path}/{day}")
            out["dropped"].append(str(r.dt))
        elif r.first <= now:
            place = f"{aside}/{day}"
            spark.read.parquet(f"{path}/{day}").where(F.col("ttl") > now).write.partitionBy("run").parquet(f"{place}/new")
            move(spark, f"{path}/{day}", f"{place}/old")
            move(spark, f"{place}/new", f"{path}/{day}")
            out["rewritten"].append(str(r.dt))
    remove(spark, aside)
    return out


def stage_rows(audit: DataFrame, keys: tuple[str, ...] = ("pk", "sk")) -> DataFrame:
    """Stage durations in processing order, absent stages left out."""
    order = F.array(*map(F.lit, STAGES))
    return (
        audit.select(*keys, F.explode("stage_durations").alias("stage", "ms"))
        .withColumn("pos", F.array_position(order, F.col("stage")))
        .filter("pos > 0")
        .select(*keys, F.col("pos").cast("int").alias("pos"), "stage", F.col("ms").alias("duration_ms"))
    )


def dashboard(audit: DataFrame) -> DataFrame:
    """Totals over all records: ``(kind, name, n)`` for types and methods."""

    def totals(kind: str, counts: Column) -> DataFrame:
        return (
            audit.select(F.explode(counts).alias("name", "n"))
            .groupBy("name")
            .agg(F.sum("n").alias("n"))
            .select(F.lit(kind).alias("kind"), "name", "n")
        )

    return totals("entity_type", F.col("detection_summary.entity_counts")).unionByName(
        totals("method", F.col("protection_summary.methods_used"))
    )


def run_summary(results: DataFrame) -> DataFrame:
    """``processed, failed, status``: 200, 207 with some failures, 500 if none worked."""
    failed = F.count_if(F.col("error").isNotNull())
    done = F.count_if(F.col("error").isNull())
    return results.agg(done.alias("processed"), failed.alias("failed")).select(
        "processed",
        "failed",
        F.when(F.col("failed") == 0, 200).when(F.col("processed") == 0, 500).otherwise(207).alias("status"),
    )

