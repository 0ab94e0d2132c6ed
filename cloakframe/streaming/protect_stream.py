"""Continuous protection of arriving rows and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cloakframe.operators.detect import Detector
from cloakframe.operators.protect import FINDINGS, protection_counts, token_pairs_of
from cloakframe.operators.vault import append_pairs
from cloakframe.plans.jobs import protect_files
from cloakframe.plans.policy import Policy
from cloakframe.plans.scratch import exists, remove
from cloakframe.plans.secrets import Secrets


# Fixed value: the columns of Spark's file listing.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """New files of one format as a stream; the suffix filter ignores case."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    suffix = "".join(f"[{c.upper()}{c}]" for c in fmt)
    return reader.option("pathGlobFilter", f"*.{suffix}").format("json" if fmt == "ndjson" else fmt).load(path)


def protect_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    policy: Policy,
    secrets: Secrets = Secrets(),
    detector: Detector | None = None,
    audit_path: str | None = None,
    vault_path: str | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Protect a stream into ``target``; each micro-batch adds its audit counts.

    The transform itself is narrow and stateless.  A batch is written to
    ``target/batch=<id>`` with overwrite, so a batch repeated after a failure
    replaces its own output instead of adding to it; vault and audit then read
    that folder, so detection runs once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        done = token_pairs_of(batch, policy, secrets, detector)
        spark = batch.sparkSession
        path = f"{target}/batch={batch_id}"
        work = f"{checkpoint}/work/batch={batch_id}"
        try:
            (done if vault_path else done.drop("_pairs")).write.mode("overwrite").parquet(work)
            staged = spark.read.parquet(work)
            if vault_path:
                append_pairs(vault_path, staged.select(F.explode("_pairs").alias("p")).select("p.*"))
            staged.drop(FINDINGS, "_pairs").write.mode("overwrite").parquet(path)
            if audit_path:
                counts = protection_counts(staged).withColumn("rows", F.lit(staged.count()))
                counts.withColumn("processed_at", F.current_timestamp()).write.mode("overwrite").parquet(
                    f"{audit_path}/batch={batch_id}"
                )
        finally:
            remove(spark, work)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{checkpoint}/offsets")
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def protect_arrivals(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    policy: Policy,
    secrets: Secrets = Secrets(),
    files_per_trigger: int = 1000,
    available_now: bool = True,
    interval: str = "1 minute",
    **job_options,
) -> StreamingQuery:
    """Protect files as they arrive below ``source``: the file job, a micro-batch of names at a time.

    The stream carries paths only; every batch is gated, protected, checked and audited like a folder, so a
    bad file goes to quarantine and the others go on.  A batch is named by query and number.  It notes when it
    began before it does anything, and that it ended after all is written: a batch repeated after its end
    adds nothing, and one that broke off is done again under its first time and replaces what it had
    written.  Files without a byte are no arrival: Spark's file stream shows none of them.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        run_batch(spark, batch, f"{query}-{batch_id}", source, target, policy, secrets, **job_options)

    names = spark.readStream.format("binaryFile").schema(FILE_COLUMNS).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger).load(source).select("path")
    writer = names.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_batch(spark: SparkSession, batch: DataFrame, name: str, source: str, target: str, policy: Policy, secrets: Secrets, **job_options) -> None:
    """The file job over a batch of ``path`` rows, exactly once per ``name``."""
    begun, ended = f"{target}/batches/{name}", f"{target}/commits/{name}"
    if exists(spark, f"{ended}/_SUCCESS"):
        return
    if not exists(spark, f"{begun}/_SUCCESS"):
        batch.select("path").withColumn("processed_at", F.current_timestamp()).write.mode("overwrite").parquet(begun)
    arrived = spark.read.schema("path string, processed_at timestamp").parquet(begun).collect()  # at most ``files_per_trigger``
    if arrived:
        protect_files(spark, source, target, policy, secrets, files=[r.path for r in arrived], request=name, processed_at=arrived[0].processed_at, **job_options)
    spark.createDataFrame([(name,)], "name string").write.mode("overwrite").parquet(ended)


def alarm_stream(periods: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append closed alarm or monitor periods to a table as they complete."""
    return (
        periods.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
