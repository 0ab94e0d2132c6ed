"""What registered queries must hold on tables larger, or laid out otherwise, than those of the smallest scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cloakframe.functions import spans
from cloakframe.functions.recognizers import default_recognizers
from cloakframe.sources import lake
from suite.check import TABLES, normal


@pytest.fixture
def small_partitions(spark):
    """Partitions are merged by size, as on large tables, not into one."""
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    for key, size in zip(keys, ["2k", "1b"]):
        spark.conf.set(key, size)
    yield
    for key in keys:
        spark.conf.unset(key)


def customers(spark, folder, rows):
    k = F.col("id")
    spark.range(rows).select(
        k.alias("c_custkey"), F.concat(F.lit("Customer#"), k.cast("string")).alias("c_name"), (k % 25).cast("int").alias("c_nationkey"),
        (k * 1.5).alias("c_acctbal"), F.lit("MACHINERY").alias("c_mktsegment"),
    ).write.parquet(f"{folder}/customer.parquet")


def test_gate_of_nations_sees_one_file_per_nation(spark, tmp_path, small_partitions):
    customers(spark, tmp_path, 5000)
    rows = entry.queries()["csv_gate_nations"](spark, str(tmp_path)).collect()
    assert sorted((r.nation, r.lines) for r in rows) == [(n, 201) for n in range(25)]
    assert {r.nation for r in rows if r.error} == {0, 5, 10, 15, 20}


def tables_as_folders(spark, folder, names):
    """Some tables as folders of part files, as Spark writes them."""
    for name in TABLES:
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name in names:
            df.repartition(3).write.parquet(f"{folder}/{name}.parquet")
        else:
            df.toPandas().to_parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", ["stream_protect_documents", "stream_monitor_events", "listing_tables", "parquet_gate_tables"])
def test_tables_may_be_folders(spark, tmp_path, name):
    tables_as_folders(spark, tmp_path, ["documents", "events"])
    mine = entry.queries()[name](spark, str(tmp_path)).toPandas()
    theirs = entry.queries()[name](spark, "/root/testdata/sf0.001").toPandas()
    assert len(mine) > 0 and normal(mine) == normal(theirs)


def test_folders_below_a_root_with_an_extension(spark, tmp_path):
    root = tmp_path / "all.parquet"
    spark.range(6).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{root}/a.Parquet")
    spark.range(6).repartition(2).write.csv(f"{root}/plain")
    rows = lake.classify_files(spark, str(root), folders=True).collect()
    assert sorted(r.file_name for r in rows if r.format == "parquet") == ["a.Parquet"]
    assert sum(r.format == "csv" for r in rows) == 2


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["accuracy_people", "leaks_people", "changed_cells_people"])
def test_exploded_cells_are_not_broadcast(spark, tmp_path, name):
    customers(spark, tmp_path, 50)
    assert "Broadcast" not in plan(entry.queries()[name](spark, str(tmp_path)))


def test_new_vault_rows_detect_once(spark, tmp_path):
    customers(spark, tmp_path, 50)
    df = entry.queries()["new_vault_rows_people"](spark, str(tmp_path))
    assert "RoundRobinPartitioning" not in plan(df) and "Broadcast" not in plan(df)


def test_preview_protects_only_the_rows_it_shows(spark, tmp_path):
    customers(spark, tmp_path, 50)
    df = entry.queries()["preview_people"](spark, str(tmp_path))
    text = plan(df)
    assert text.count("BroadcastHashJoin") == 2
    assert [r.row_key for r in df.orderBy("row_key").collect()] == list(range(10))


def test_few_and_many_spans_are_judged_alike(spark, monkeypatch):
    """Nested, equal, touching and overlapping matches of many types, with either way to drop contained ones."""
    numbers = ["4111111111111111", "07123 456789", "943 476 5919", "9434765919", "12-34-56", "GB82 WEST 1234 5698 7654 32", "AB123456C"]
    mails = ["James Smith", "mail james.smith1@example.co.uk", "London", "passport 123456789", "10.1.2.3", "1 May 2020", "Dr Smith", "Wales"]
    words = numbers + mails
    texts = [" ".join(words[i % len(words)] for i in range(k, k + n)) for k in range(len(words)) for n in (1, 2, 3, 9, 40)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", " ", None, "a\u0001b 123456789"]], "text string")

    def found(few):
        monkeypatch.setattr(spans, "FEW", few)
        return df.select("text", spans.find_spans(F.col("text"), default_recognizers(), 0.3).alias("s")).collect()

    assert found(0) == found(8) == found(1000)


def test_patterns_without_a_match_build_nothing(spark):
    """The time of a cell goes into its matches: no result is made for patterns that do not occur."""
    text = str(spans._hits(F.col("t"), default_recognizers()))
    assert "context" not in text and "array_compact" in text
