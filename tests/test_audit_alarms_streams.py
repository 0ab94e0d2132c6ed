import datetime as dt

import pytest
from pyspark.sql import functions as F

from cloakframe import Secrets, default_policy, detect, protect, protect_arrivals, protect_stream, schema_check
from cloakframe.operators import compare
from cloakframe.operators.schema_check import is_valid
from cloakframe.plans import audit
from cloakframe.streaming import alarms
from cloakframe.plans.scratch import move, remove
from cloakframe.streaming.protect_stream import alarm_stream, arriving_files, run_batch
from cloakframe.synth import generate, plant, rows_for_size, synthetic_records

SECRETS = Secrets(bytes(32), "salt", "tok")
T0 = dt.datetime(2024, 1, 1, 12, 0)


def runs(spark, rows):
    """rows: (minute, errors, duration_ms)"""
    data = [(T0 + dt.timedelta(minutes=m), e, float(d), 0, 1) for m, e, d in rows]
    return spark.createDataFrame(data, "ts timestamp, errors int, duration_ms double, throttles int, invocations int")


def on(periods):
    return {int((r.period_start - T0).total_seconds() // 60): r.alarm_on for r in periods.collect()}


def test_two_breaching_periods_in_a_row(spark):
    df = runs(spark, [(0, 6, 1), (6, 6, 1), (12, 1, 1), (16, 9, 1), (30, 9, 1), (36, 3, 1), (37, 3, 1)])
    assert on(alarms.alarm_periods(df, alarms.ERROR_RATE)) == {0: False, 5: True, 10: False, 15: False, 30: False, 35: True}


def test_a_gap_does_not_breach(spark):
    df = runs(spark, [(0, 9, 1), (11, 9, 1)])
    assert not any(on(alarms.alarm_periods(df, alarms.ERROR_RATE)).values())


def test_threshold_is_strict_or_inclusive(spark):
    df = runs(spark, [(0, 5, 120_000), (6, 5, 120_000)])
    assert not any(on(alarms.alarm_periods(df, alarms.ERROR_RATE)).values())
    assert not any(on(alarms.alarm_periods(df, alarms.LATENCY)).values())
    once = runs(spark, [(0, 0, 1)]).withColumn("throttles", F.lit(1))
    assert on(alarms.alarm_periods(once, alarms.THROTTLE)) == {0: True}


def test_concurrency_counts_overlap_and_half_open_ends(spark):
    minute = 60_000.0
    df = runs(spark, [(0, 0, 2 * minute), (1, 0, 2 * minute), (2, 0, minute), (8, 0, 0)])
    got = {int((r.period_start - T0).total_seconds() // 60): r.max_running for r in alarms.max_concurrency(df).collect()}
    # At minute 2 the first run ends as the third starts.
    assert got == {0: 2, 5: 0}
    # Periods in which a run only goes on, over hours as well; one that ends as a period begins is not in it.
    df = runs(spark, [(1, 0, 239 * minute), (60, 0, 5 * minute), (62, 0, 3 * minute), (300, 0, 4 * minute)])
    got = {int((r.period_start - T0).total_seconds() // 60): r.max_running for r in alarms.max_concurrency(df).collect()}
    assert got == {k: 1 for k in range(0, 240, 5)} | {60: 3, 240: 0, 300: 1}


def test_stream_alarms_equal_batch(spark, tmp_path):
    df = runs(spark, [(i * 3, i % 7, 1000 * i) for i in range(60)])
    df.write.parquet(f"{tmp_path}/in")
    for alarm in (alarms.ERROR_RATE, alarms.LATENCY):
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        out = f"{tmp_path}/{alarm.name}"
        alarm_stream(alarms.alarm_periods(stream, alarm, late="0 seconds"), f"{out}/t", f"{out}/c").awaitTermination()
        got = {tuple(r) for r in spark.read.parquet(f"{out}/t").collect()}
        want = {tuple(r) for r in alarms.alarm_periods(df, alarm).collect()}
        assert got <= want and len(got) >= len(want) - alarm.periods


def test_stream_protects_arriving_files_and_repeats_nothing(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "id bigint, email string"

    def go():
        stream = arriving_files(spark, src, "csv", spark.createDataFrame([], schema).schema)
        protect_stream(
            stream, f"{out}/t", f"{out}/c", default_policy(), SECRETS, audit_path=f"{out}/a", vault_path=f"{out}/v"
        ).awaitTermination()
        return sorted((r.id, r.email) for r in spark.read.parquet(f"{out}/t").select("id", "email").collect())

    spark.createDataFrame([(1, "a@b.com")], schema).write.option("header", True).csv(src)
    first = go()
    assert len(first) == 1 and first[0][1].startswith("HASH:")
    assert go() == first
    spark.createDataFrame([(2, "nhs 943 476 5919")], schema).write.mode("append").option("header", True).csv(src)
    assert [i for i, _ in go()] == [1, 2]
    assert spark.read.parquet(f"{out}/v").count() == 1
    assert spark.read.parquet(f"{out}/a").agg(F.sum("applied")).first()[0] == 2


def test_a_stream_can_be_transformed_without_batches(spark, tmp_path):
    df = spark.createDataFrame([(1, "a@b.com")], "id bigint, email string")
    df.write.parquet(f"{tmp_path}/in")
    stream = protect(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), default_policy(), SECRETS)
    q = stream.writeStream.format("memory").queryName("plain_stream").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("plain_stream").first().email.startswith("HASH:")


# Audit -----------------------------------------------------------------------

def audit_frame(spark):
    base = spark.createDataFrame(
        [(1, "in/a.csv", T0), (2, "in/a.csv", T0 + dt.timedelta(hours=1)), (3, "b.csv", T0)], "n int, source_key string, processed_at timestamp"
    )
    return audit.audit_rows(
        base.select(
            F.concat(F.lit("r"), F.col("n").cast("string")).alias("request_id"), F.lit("bkt").alias("source_bucket"), "source_key",
            F.lit(None).cast("string").alias("secure_key"), F.lit("CSV").alias("file_format"), F.lit(True).alias("success"),
            F.lit(12.7).alias("duration_ms"), "processed_at",
            F.struct(F.create_map(F.lit("UK_NHS"), F.lit(2)).alias("entity_counts")).alias("detection_summary"),
            F.struct(F.create_map(F.lit("masking"), F.lit(3)).alias("methods_used")).alias("protection_summary"),
            F.create_map(F.lit("output"), F.lit(5), F.lit("receive"), F.lit(1), F.lit("x"), F.lit(1)).alias("stage_durations"),
            F.lit(None).cast("string").alias("error"),
        )
    )


def test_audit_record(spark):
    r = audit_frame(spark).filter("request_id = 'r1'").first()
    assert r.pk == "FILE#bkt/in/a.csv" and r.sk == "PROCESS#2024-01-01T12:00:00.000000+00:00"
    assert r.gsi1pk == "DATE#2024-01-01" and r.gsi1sk == "FILE#a.csv" and r.duration_ms == 12
    assert r.ttl == int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) + 90 * 86400


def test_audit_lookups(spark, tmp_path):
    rows = audit_frame(spark)
    assert {r.request_id for r in audit.latest(rows).collect()} == {"r2", "r3"}
    assert audit.unexpired(rows).count() == 0 and audit.unexpired(rows, F.lit(0)).count() == 3
    assert [(r.stage, r.duration_ms) for r in audit.stage_rows(rows.filter("request_id = 'r1'")).orderBy("pos").collect()] == [("receive", 1), ("output", 5)]
    assert {(r.kind, r.name, r.n) for r in audit.dashboard(rows).collect()} == {("entity_type", "UK_NHS", 6), ("method", "masking", 9)}
    assert audit.write_audit(rows, f"{tmp_path}/log")
    day = audit.read_day(spark, f"{tmp_path}/log", "2024-01-01")
    assert day.count() == 3 and "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().toString()
    assert audit.read_day(spark, f"{tmp_path}/log", "2024-01-02").count() == 0


def test_audit_failure_is_only_reported(spark):
    assert audit.write_audit(audit_frame(spark), "/proc/nowhere") is False


@pytest.mark.parametrize("errors,status", [([None, None], 200), ([None, "x"], 207), (["x", "y"], 500)])
def test_run_status(spark, errors, status):
    df = spark.createDataFrame([(e,) for e in errors], "error string")
    assert audit.run_summary(df).first().status == status


# Schema ----------------------------------------------------------------------

@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a", True, 1.5), (2, None, False, 2.5)], "id bigint, name string, flag boolean, score double")


def kinds(issues):
    return {(r.severity, r.column) for r in issues.collect()}


def test_same_table_is_valid(frame):
    assert kinds(schema_check(frame, frame)) == set()
    assert is_valid(schema_check(frame, frame)).first().is_valid


def test_columns_order_types_rows_and_nulls(frame):
    assert kinds(schema_check(frame, frame.drop("name"))) == {("error", "name")}
    assert kinds(schema_check(frame, frame.withColumn("x", F.lit(1)))) == {("warning", "x")}
    assert kinds(schema_check(frame, frame.select("name", "id", "flag", "score"))) == {("warning", None)}
    text = frame.withColumns({c: F.col(c).cast("string") for c in ("id", "flag")})
    assert kinds(schema_check(frame, text)) == {("info", "id"), ("warning", "flag")}
    assert kinds(schema_check(frame, frame.withColumn("score", F.col("score").cast("int")))) == {("info", "score")}
    assert kinds(schema_check(frame, text, True, False)) == {("error", "id"), ("error", "flag")}
    assert kinds(schema_check(frame, frame.limit(1))) == {("error", None)}
    assert kinds(schema_check(frame, frame.limit(1), validate_row_count=False)) == set()
    gained = schema_check(frame, frame.withColumn("id", F.when(F.col("id") == 1, F.col("id"))))
    assert gained.first().details == {"original_nulls": "0", "protected_nulls": "1"}


@pytest.mark.parametrize("strict,widening", [(True, True), (False, False)])
def test_exactly_one_type_mode(frame, strict, widening):
    with pytest.raises(ValueError):
        schema_check(frame, frame, strict, widening)


def test_bench_stats_and_scaling(spark):
    df = spark.createDataFrame([("a", 1000.0, 2_000_000), ("a", 3000.0, 2_000_000)], "k string, ms double, bytes bigint")
    r = compare.bench_stats(df, ["k"]).first()
    assert (r.mean_ms, r.min_ms, r.max_ms, r.mb_per_s) == (2000.0, 1000.0, 3000.0, 1.0)
    assert compare.scaling_factor(100, 10.0, 1000, 150.0) == 1.5


def test_accuracy_with_empty_denominators(spark):
    df = spark.createDataFrame([("x", 0, 0, 0)], "entity_type string, tp int, fp int, fn int")
    r = compare.accuracy(df).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


# Synthetic data --------------------------------------------------------------

def test_records_are_reproducible_and_found(spark):
    df = generate(spark, 300)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, generate(spark, 300).repartition(7).collect()))
    assert generate(spark, 5, sensitive=False).columns[-1] == "notes" and rows_for_size(100) > 500
    want = {"email": "EMAIL_ADDRESS", "national_insurance": "UK_NINO", "nhs_number": "UK_NHS", "credit_card": "CREDIT_CARD", "name": "UK_NAME", "phone": "UK_PHONE", "postcode": "UK_POSTCODE", "date_of_birth": "DATE_TIME"}
    got = detect(df, "record_key", columns=list(want)).groupBy("column_name", "entity_type").agg(F.count_distinct("record_key").alias("n"))
    counts = {(r.column_name, r.entity_type): r.n for r in got.collect()}
    assert all(counts[(c, t)] == 300 for c, t in want.items())


def test_planted_corpus(spark):
    df = plant(spark.range(200).select("id", F.lit("Some text.").alias("text")), "text", "id", 4)
    n = df.filter("planted_email IS NOT NULL").count()
    assert 20 < n < 90 and df.filter("text <> 'Some text.'").count() == n
    assert synthetic_records(spark.range(2), "id").count() == 2


def test_arriving_files_are_gated_and_a_repeated_batch_adds_nothing(spark, tmp_path):
    src, out = tmp_path / "in", f"{tmp_path}/out"
    (src / "sub").mkdir(parents=True)
    (src / "a.csv").write_text("id,email\n1,q@example.org\n2,x\n")
    (src / "bad.csv").write_text("a,b\n1\n")
    (src / "sub" / "é b.ndjson").write_text('{"id":1,"email":"w@example.org"}\n')
    (src / "note.txt").write_text("x")

    def state():
        return (
            sorted(r.value for r in spark.read.text(f"{out}/protected/csv").collect()),
            sorted(r.email for r in spark.read.json(f"{out}/protected/json").collect()),
            sorted((r.path.split("/")[-1], r.stage) for r in spark.read.parquet(f"{out}/quarantine").collect()),
            sorted((r.source_key, r.success, str(r.dt)) for r in spark.read.parquet(f"{tmp_path}/audit").collect()),
            spark.read.parquet(f"{out}/runs").count(),
        )

    def arrive():
        protect_arrivals(spark, str(src), out, f"{tmp_path}/check", default_policy(), SECRETS, audit_path=f"{tmp_path}/audit").awaitTermination()

    arrive()
    first = state()
    assert [r[0] for r in first[3]] == ["a.csv", "bad.csv", "note.txt", "sub/é b.ndjson"] and len(first[2]) == 2 and first[4] == 4
    assert "example.org" not in str(first) and len(first[0]) == 3 and len(first[1]) == 1
    (name,) = [d.name for d in (tmp_path / "out" / "commits").iterdir() if not d.name.startswith(".")]
    again = spark.read.parquet(f"{out}/batches/{name}").select("path")
    run_batch(spark, again, name, str(src), out, default_policy(), SECRETS, audit_path=f"{tmp_path}/audit")  # committed
    assert state() == first
    remove(spark, f"{out}/commits/{name}")  # as if it had broken off before its end
    run_batch(spark, again, name, str(src), out, default_policy(), SECRETS, audit_path=f"{tmp_path}/audit")
    assert state() == first
    (src / "c.csv").write_text("id,email\n3,e@example.org\n")
    arrive()
    more = state()
    assert len(more[3]) == 5 and len(more[0]) == 5 and more[2] == first[2]


def test_retention_touches_only_days_with_expired_records(spark, tmp_path):
    path, day = f"{tmp_path}/audit", 86_400
    rows = [(k, f"2024-01-0{d}T00:00:00", ttl * day) for k, (d, ttl) in enumerate([(1, 1), (1, 2), (2, 2), (2, 9), (3, 9), (4, 9)])]
    df = spark.createDataFrame(rows, "request_id int, timestamp string, ttl bigint")
    audit.write_audit(df.where("request_id <> 3"), path, "one")
    audit.write_audit(df.where("request_id = 3"), path, "two")

    def files():
        return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in (tmp_path / "audit").rglob("*.parquet")}

    old = files()
    assert audit.expire(spark, path, 5 * day) == {"dropped": ["2024-01-01"], "rewritten": ["2024-01-02"]}
    assert sorted(r.request_id for r in spark.read.parquet(path).collect()) == [3, 4, 5]
    assert {n: t for n, t in files().items() if "dt=2024-01-02" not in n} == {n: t for n, t in old.items() if "-03" in n or "-04" in n}
    assert audit.expire(spark, path, 5 * day) == {"dropped": [], "rewritten": []}
    # A swap that broke off between its two renames, with and without a whole new day.
    for whole in (True, False):
        move(spark, f"{path}/dt=2024-01-03", f"{path}/_retention/dt=2024-01-03/old")
        if whole:
            spark.read.parquet(f"{path}/_retention/dt=2024-01-03/old").write.partitionBy("run").parquet(f"{path}/_retention/dt=2024-01-03/new")
        assert audit.expire(spark, path, 5 * day) == {"dropped": [], "rewritten": []}
        assert sorted(r.request_id for r in spark.read.parquet(path).collect()) == [3, 4, 5]
