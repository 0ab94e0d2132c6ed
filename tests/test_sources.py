"""Readers, gates, writers and the file job, on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cloakframe import Policy, Rule, Secrets, default_policy, gate_files, protect_files, read_lake
from cloakframe.plans import audit
from cloakframe.plans.jobs import key_of, root_of
from cloakframe.plans.scratch import shared_folder
from cloakframe.sources import csv as csv_source
from cloakframe.sources import json as json_source
from cloakframe.sources import lake
from cloakframe.sources import parquet as parquet_source

SECRETS = Secrets(bytes(32), "salt", "tok")


def put(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())
    return path


def csv_state(spark, path):
    return csv_source.csv_files(spark, path).first()


@pytest.mark.parametrize(
    "content,delimiter,error",
    [
        ("a,b,c\n1,2,3\n", ",", None),
        ("a;b;c\n1;2;3\n4;5;6\n", ";", None),
        ("a\tb\n1\t2\n", "\t", None),
        ("a|b\n1|2\n", "|", None),
        ("only\nx\n", ",", None),
        ('a,b\n"x,y",2\n', ",", None),
        ("a,b,c\n1,2\n3,4,5\n", ",", "Row 2 has 2 columns, expected 3"),
        ("a,b\n1,2\n3,4,5\n", ",", "Row 3 has 3 columns, expected 2"),
        ("a,b\n1,2\n\n3,4\n", ",", "Row 3 has 0 columns, expected 2"),
        (b"\xff\xfe", ",", "Invalid encoding"),
        ("  \n \n", ",", "File is empty"),
    ],
)
def test_csv_gate(spark, tmp_path, content, delimiter, error):
    state = csv_state(spark, put(tmp_path, "f.csv", content))
    assert state.error == error
    if error is None:
        assert state.delimiter == delimiter


def test_csv_ragged_row_is_numbered_across_blocks(spark, tmp_path):
    lines = ["a,b"] + [f"{i},x" for i in range(5000)] + ["1,2,3"] + ["z,z"] * 10
    path = put(tmp_path, "f.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(path).rdd.getNumPartitions() > 1
        assert csv_state(spark, path).error == "Row 5002 has 3 columns, expected 2"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_read_csv_keeps_empty_cells_and_trims_names(spark, tmp_path):
    path = put(tmp_path, "f.csv", ' id , name\n1,\n2,"say ""hi"", x"\n3,nan\n')
    df = csv_source.read_csv(spark, path)
    assert df.columns == ["id", "name"]
    assert [r.name for r in df.orderBy("id").collect()] == ["", 'say "hi", x', "nan"]


def test_read_csv_marks_bad_rows_and_other_encoding(spark, tmp_path):
    path = put(tmp_path, "f.csv", "a,b\n1,2\n3\n4,5,6\n")
    df = csv_source.read_csv(spark, path, mark_bad_rows=True)
    assert len(df.filter(F.col(csv_source.BAD_ROW).isNotNull()).collect()) == 2
    latin = put(tmp_path, "latin.csv", "a\ncafé\n".encode("latin-1"))
    assert csv_source.read_csv(spark, latin, encoding="ISO-8859-1").first().a == "café"


def json_state(spark, path, **kw):
    return json_source.json_files(spark, path, **kw).first()


@pytest.mark.parametrize(
    "name,content,shape,path,error",
    [
        ("a.json", '[{"a":1},{"a":2}]', "array", None, None),
        ("a.json", '{"x":[1],"records":[{"a":1}]}', "nested", "records", None),
        ("a.json", '{"zz":[{"a":1}],"data":[{"a":1}]}', "nested", "data", None),
        ("a.json", '{"records":[],"zz":[{"a":1}],"b":[{"a":1}]}', "nested", "zz", None),
        ("a.json", '{"a":1}\n\n{"a":2}\n', "ndjson", None, None),
        ("a.ndjson", '{"a":1}\n', "ndjson", None, None),
        ("a.json", "{invalid}", None, None, "Invalid JSON"),
        ("a.json", "[]", "array", None, "Empty JSON array"),
        ("a.json", '[1,{"a":1}]', "array", None, "Array must contain only objects"),
        ("a.json", '{"a":1}', "nested", None, "No records array found. Specify records_path or use array format"),
        ("a.json", "3", None, None, "JSON must be an array or object"),
        ("a.ndjson", '{"a":1}\n[2]\n', "ndjson", None, "1 lines are not JSON objects"),
        ("a.json", b"\xff\xfe{", "ndjson", None, "Invalid encoding"),
    ],
)
def test_json_gate(spark, tmp_path, name, content, shape, path, error):
    state = json_state(spark, put(tmp_path, name, content))
    assert (state.shape, state.records_path, state.error) == (shape, path, error)


def test_json_explicit_path(spark, tmp_path):
    f = put(tmp_path, "a.json", '{"response":{"data":[{"x":1,"n":{"m":{"k":"v"}}}]},"s":1}')
    assert json_state(spark, f, records_path="response.data").error is None
    assert "not found" in json_state(spark, f, records_path="no.way").error
    assert "not an array" in json_state(spark, f, records_path="s").error
    df = json_source.read_json(spark, f, "response.data")
    assert df.columns == ["n.m.k", "x"] and df.first()["n.m.k"] == "v"


def test_stringify_nulls_and_arrays(spark, tmp_path):
    f = put(tmp_path, "a.ndjson", '{"a":1,"b":null,"c":[1,2],"d":"nan"}\n{"a":2,"b":true}\n')
    rows = lake.stringify(json_source.read_ndjson(spark, f)).orderBy("a").collect()
    assert rows[0].asDict() == {"a": "1", "b": "", "c": "[1,2]", "d": "nan"}
    assert rows[1].asDict() == {"a": "2", "b": "true", "c": "", "d": ""}


def test_json_writers(spark, tmp_path):
    df = spark.createDataFrame([("é", None), ("b", "2")], "a string, b string").coalesce(1)

    def text(path):
        part = next(p for p in os.listdir(path) if p.startswith("part"))
        return open(os.path.join(path, part), encoding="utf-8").read()

    json_source.write_json(df, f"{tmp_path}/arr")
    assert json.loads(text(f"{tmp_path}/arr")) == [{"a": "é", "b": None}, {"a": "b", "b": "2"}]
    json_source.write_json(df, f"{tmp_path}/wrap", "items")
    assert json.loads(text(f"{tmp_path}/wrap")) == {"items": [{"a": "é", "b": None}, {"a": "b", "b": "2"}]}
    json_source.write_ndjson(df, f"{tmp_path}/nd")
    assert "é" in text(f"{tmp_path}/nd") and '"b":null' in text(f"{tmp_path}/nd")


def test_parquet_gate(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/src")
    part = next(p for p in os.listdir(f"{tmp_path}/src") if p.endswith(".parquet"))
    put(tmp_path, "in/good.parquet", open(f"{tmp_path}/src/{part}", "rb").read())
    put(tmp_path, "in/tiny.parquet", "PA")
    put(tmp_path, "in/fake.parquet", "XXXX" + "." * 30 + "XXXX")
    put(tmp_path, "in/cut.parquet", "PAR1" + "." * 30)
    got = {r.path.split("/")[-1]: r.error for r in parquet_source.parquet_files(spark, f"{tmp_path}/in").collect()}
    assert got["good.parquet"] is None
    assert "too small" in got["tiny.parquet"] and "header" in got["fake.parquet"] and "footer" in got["cut.parquet"]


def test_formats_and_display_names(spark):
    names = ["x.csv", "X.JSON", "a.b.ndjson", "p.Parquet", "t.txt", "none", "dir.csv/none"]
    df = spark.createDataFrame([(n, 1) for n in names], "path string, length int")
    got = {r.path: (r.format, r.display) for r in lake.receive_gate(df).collect()}
    assert got["X.JSON"] == ("json", "JSON") and got["a.b.ndjson"] == ("json", "NDJSON")
    assert got["t.txt"] == (None, "UNKNOWN") and got["none"] == (None, "UNKNOWN") and got["dir.csv/none"][0] is None


def test_notifications(spark):
    rows = [
        json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "a+b%2Fc.csv", "size": 3}}}]}),
        json.dumps({"source": "aws.s3", "detail": {"bucket": {"name": "b"}, "object": {"key": "a+b.csv"}}}),
        json.dumps({"source": "aws.s3", "detail": {"bucket": {"name": "b"}}}),
        json.dumps({"source": "other"}),
    ]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    assert {(r.bucket, r.key) for r in lake.work_list(df).collect()} == {("b", "a b/c.csv"), ("b", "a+b.csv")}


@pytest.fixture
def folder(spark, tmp_path):
    src = f"{tmp_path}/in"
    put(src, "a.csv", 'id,name,email\n1,"Smith, John",john@example.com\n2,Ava Wood,\n')
    put(src, "sub/b.CSV", "id;email\n1;q@example.org\n")
    put(src, "multi.csv", 'id,notes\n1,"two\nlines a@b.co.uk"\n')
    put(src, "space é+.csv", "id,email\n1,x@y.com\n")
    put(src, "arr.json", '[{"a":1,"n":{"pc":"SW1A 1AA"}}]')
    put(src, "lines.ndjson", '{"id":1,"email":"e@f.com"}\n{"id":2,"email":"none"}\n')
    put(src, "bad.csv", "a,b,c\n1,2\n")
    put(src, "empty.csv", "")
    put(src, "note.txt", "x")
    return src


def test_gate_files(spark, folder):
    groups, refused = gate_files(spark, folder)
    assert sum(len(g.paths) for g in groups) == 6
    assert {r.path.split("/")[-1]: r.stage for r in refused.collect()} == {
        "bad.csv": "validate", "empty.csv": "receive", "note.txt": "receive",
    }


def test_read_lake(spark, folder):
    got = read_lake(spark, folder)
    assert got["csv"].count() == 5 and got["json"].count() == 3


def test_file_job(spark, folder, tmp_path):
    out = f"{tmp_path}/out"
    results = protect_files(
        spark, folder, out, default_policy(), SECRETS, audit_path=f"{tmp_path}/audit", vault_path=f"{tmp_path}/vault"
    )
    assert audit.run_summary(results).first().asDict() == {"processed": 6, "failed": 3, "status": 207}
    rows = {r.source_key: r.rows for r in results.collect() if r.error is None}
    assert rows == {"a.csv": 2, "sub/b.CSV": 1, "multi.csv": 1, "space é+.csv": 1, "arr.json": 1, "lines.ndjson": 2}
    csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/protected/csv")
    assert not [r for r in csv.collect() if "@" in str(r)]
    keys = {r.source_key for r in csv.select("source_key").distinct().collect()}
    assert keys == {"a.csv", "sub/b.CSV", "multi.csv", "space é+.csv"}
    assert spark.read.json(f"{out}/protected/json").filter("`n.pc` = 'SW1*****'").count() == 1
    assert spark.read.parquet(f"{out}/quarantine").count() == 3
    log = spark.read.parquet(f"{tmp_path}/audit")
    first = log.filter("source_key = 'a.csv'").first()
    assert first.pk == "FILE#lake/a.csv" and first.secure_key == "protected/a.csv" and first.dt is not None
    assert first.detection_summary.cells_scanned == 6 and first.detection_summary.entity_counts["UK_NAME"] == 1
    text = str(log.collect())
    assert "john@" not in text and "Ava Wood" not in text


def test_file_job_on_a_mixed_lake(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(src, "x/a.csv", "id,email\n1,q@example.org\n")
    put(src, "y/a.csv", "id,note\n1,w@example.org\n2,z\n")
    put(src, "ragged.csv", 'id,a,b\n1,"two\nlines",x\n2,z\n3,p,q\n')
    put(src, "x/bad.csv", "a,b\n1\n")
    put(src, "y/bad.csv", "a,b\n1\n")
    put(src, "header.csv", "id,email\n")
    put(src, "bare; head.csv", "id;say ""hi"";note\n")
    spark.createDataFrame([], "id int, email string").coalesce(1).write.parquet(f"{src}/none")
    put(src, "one.ndjson", '{"a":1}\n{"a":2}\n')
    put(src, "two.ndjson", '{"b":"v@example.org"}\n')
    put(src, "lines.json", '{"a":1}\n{"a":2}\n{"a":\n{"a":4}\n')
    spark.createDataFrame([(1, "u@example.org")], "id int, email string").coalesce(1).write.parquet(f"{src}/p")
    spark.createDataFrame([("s",)], "id string").coalesce(1).write.parquet(f"{src}/q")
    with open(f"{src}/junk.parquet", "wb") as f:
        f.write(b"PAR1" + b"junk" * 10 + b"PAR1")
    before = set(os.listdir(shared_folder(spark)))
    results = protect_files(spark, src, out, default_policy(), SECRETS, audit_path=f"{tmp_path}/audit")
    got = {("parquet " + str(r.rows) if r.source_key.startswith(("p/", "q/", "none/")) else r.source_key): (r.rows, bool(r.error)) for r in results.collect()}
    assert got == {
        "x/a.csv": (1, False), "y/a.csv": (2, False), "ragged.csv": (0, True), "x/bad.csv": (0, True), "y/bad.csv": (0, True),
        "header.csv": (0, False), "bare; head.csv": (0, False), "one.ndjson": (2, False), "two.ndjson": (1, False), "lines.json": (0, True),
        "parquet 0": (0, False), "parquet 1": (1, False), "junk.parquet": (0, True),
    }
    heads = {k: [r.value for r in spark.read.text(f"{out}/protected/csv/source_key={k}").collect()] for k in ("header.csv", "bare; head.csv")}
    assert heads == {"header.csv": ["id,email"], "bare; head.csv": ["id,say hi,note"]}
    (bare,) = [d for d in os.listdir(f"{out}/protected/parquet") if d.startswith("source_key=none")]
    assert spark.read.parquet(f"{out}/protected/parquet/{bare}").schema.simpleString() == "struct<id:int,email:string>"
    assert results.count() == 14 and set(os.listdir(shared_folder(spark))) == before
    log = spark.read.parquet(f"{tmp_path}/audit")
    assert log.count() == 14 and log.where("not success").count() == 5 and set(log.where("success").first().stage_durations) == {"receive", "validate", "protect", "schema_check", "output"}
    one = {r.value for r in spark.read.text(f"{out}/protected/json/source_key=one.ndjson").collect()}
    assert one == {'{"a":1}', '{"a":2}'}
    assert "example.org" not in str([r for f in ("csv", "json") for r in spark.read.text(f"{out}/protected/{f}").collect()])


def test_keys_below_any_root(spark):
    cases = [
        ("s3a://raw/in", "s3a://raw/in/a/b.csv", "a/b.csv"), ("s3a://raw/in/", "s3a://raw/in/in/in.csv", "in/in.csv"),
        ("file:///x/in", "file:/x/in/f.csv", "f.csv"), ("/x/in", "file:///x/in/data/in/f.csv", "data/in/f.csv"),
        ("data/in", f"file:{os.getcwd()}/data/in/f.csv", "f.csv"), ("/x/in/f.csv", "file:/x/in/f.csv", "f.csv"),
    ]
    for root, path, key in cases:
        assert spark.range(1).select(key_of(F.lit(path), root_of(spark, root)).alias("k")).first().k == key


def test_a_large_json_array_passes_the_gate(spark, tmp_path):
    put(tmp_path, "large.json", "[" + ",".join('{"a":"' + "x" * 1000 + '"}' for _ in range(140_000)) + "]")
    assert [(r.shape, r.error) for r in json_source.json_files(spark, f"{tmp_path}/large.json").collect()] == [("array", None)]


def test_file_job_keeps_delimiter_on_request(spark, tmp_path):
    put(f"{tmp_path}/in", "b.csv", "id;email\n1;q@example.org\n2;x\n")
    policy = Policy((Rule("EMAIL_ADDRESS", "redact"),))
    for keep, sep in ((False, ","), (True, ";")):
        out = f"{tmp_path}/out{keep}"
        protect_files(spark, f"{tmp_path}/in", out, policy, SECRETS, keep_delimiter=keep)
        lines = {r.value for r in spark.read.text(f"{out}/protected/csv").collect()}
        assert f"1{sep}[REDACTED]" in lines


def test_file_profile(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/p")
    r = lake.file_profile(spark.read.parquet(f"{tmp_path}/p")).first()
    assert (r.row_count, r.column_count, r.columns, r.schema) == (5, 1, ["id"], {"id": "bigint"}) and r.size_bytes > 0


def test_layouts_do_not_depend_on_size(spark, tmp_path):
    long, src = "x" * 10_000_000, f"{tmp_path}/in"
    for name in ("a", "b"):  # documents beyond what one variant may hold, of records that each are none too large
        put(src, f"{name}.json", "[" + ",".join('{"%s":"%s"}' % (name, long) for _ in range(14)) + "]")
    put(src, "line.ndjson", '{"k":1}\n{"k":2,"t":"' + long * 14 + '"}\n')
    put(src, "twice.ndjson", '{"k":1,"k":2}\n')
    put(src, "quotes.ndjson", "{'k':1}\n{\"k\":2}\n")
    got = {r.path.split("/")[-1]: r for r in json_source.json_files(spark, src).collect()}
    assert got["a.json"].layout == "OBJECT<a: STRING>" and got["b.json"].layout == "OBJECT<b: STRING>"
    assert got["line.ndjson"].error is None and got["line.ndjson"].layout.split("\n") == ["OBJECT<k: BIGINT>", ".k:int", ".t:str"]
    assert got["twice.ndjson"].error is None and got["quotes.ndjson"].error == "1 lines are not JSON objects"
    groups, refused = gate_files(spark, src)
    assert sorted(len(g.paths) for g in groups) == [1, 1, 1, 1] and refused.count() == 1


def test_a_record_beyond_a_variant_in_a_document(spark, tmp_path):
    long = "x" * 140_000_000
    put(tmp_path, "a.json", '{"data":[{"a":{"b":[1,{}]}},{"a":"' + long + '","c":null}]}')
    (r,) = json_source.json_files(spark, f"{tmp_path}/a.json").collect()
    assert (r.shape, r.records_path, r.error) == ("nested", "data", None)
    assert r.layout.split("\n")[1:] == [".a:str", ".c:NoneType"]


def test_a_file_that_fails_the_schema_check_has_no_output(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(src, "good.ndjson", '{"id":1,"email":"q@example.org","n":null}\n{"id":2,"email":"x","n":1}\n')
    put(src, "x/lost é.ndjson", '{"id":7,"email":"w@example.org","n":2}\n{"id":8,"email":"y","n":3}\n')
    put(src, "id.csv", "id;email\n1;q@example.org\n2;x\n")

    def finish(df):
        kept = df.where("cast(id as int) <> 7").withColumn("more", F.lit("m"))
        return kept.withColumn("n", F.when(F.col("id") != 8, F.col("n"))).withColumn("id", F.col("id").cast("string")) if "n" in df.columns else kept.drop("email")

    results = protect_files(spark, src, out, default_policy(), SECRETS, finish=finish, audit_path=f"{tmp_path}/audit", vault_path=f"{tmp_path}/vault")
    errors = {r.source_key: r.error for r in results.collect()}
    assert errors == {"good.ndjson": None, "x/lost é.ndjson": "Row count mismatch: 2 -> 1", "id.csv": "Column 'email' missing in protected data"}
    found = {(r.source_key, r.severity, r.column, r.message) for r in spark.read.parquet(f"{out}/schema_issues").collect()}
    both = {(k, *x) for k in ("good.ndjson", "x/lost é.ndjson") for x in (("warning", "more", "Extra column 'more' in protected data"), ("info", "id", "Type widened for 'id': bigint -> string"))}
    assert found == both | {
        ("x/lost é.ndjson", "error", None, "Row count mismatch: 2 -> 1"), ("x/lost é.ndjson", "warning", "n", "Column 'n' gained null values after protection"),
        ("id.csv", "error", "email", "Column 'email' missing in protected data"), ("id.csv", "warning", "more", "Extra column 'more' in protected data"),
    }
    assert os.listdir(f"{out}/protected/json") and not [d for d in os.listdir(f"{out}/protected/json") if "lost" in d]
    assert {r.stage for r in spark.read.parquet(f"{out}/quarantine").collect()} == {"schema_check"}
    log = spark.read.parquet(f"{tmp_path}/audit")
    assert log.count() == 3 and set(log.where("success").first().stage_durations) == {"receive", "validate", "protect", "schema_check", "output"}
    assert "w@example.org" not in str(spark.read.parquet(f"{tmp_path}/vault").collect()) if os.path.exists(f"{tmp_path}/vault") else True
    protect_files(spark, src, out, default_policy(), SECRETS, finish=finish)
    assert spark.read.json(f"{out}/protected/json").count() == 2  # a key that is processed again replaces its output


def test_footers_of_many_files_in_one_job(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{tmp_path}/in")
    for k in range(600):
        table = pa.table({"a": [k]}) if k % 3 else pa.table({"a": [k], "b": ["x"]})
        pq.write_table(table, f"{tmp_path}/in/{k}.parquet")
    put(tmp_path, "in/junk.parquet", b"PAR1" + b"junk" * 10 + b"PAR1")
    context = spark.sparkContext
    context.setJobGroup("footers", "one job for all footers")
    found = parquet_source.parquet_files(spark, f"{tmp_path}/in").collect()
    context.setJobGroup("rest", "")
    assert len(context.statusTracker().getJobIdsForGroup("footers")) <= 2  # the listing may be a job as well
    assert len(found) == 601 and len({r.layout for r in found if r.layout}) == 2 and sum(r.error is not None for r in found) == 1
    groups, refused = gate_files(spark, f"{tmp_path}/in")
    assert sorted(len(g.paths) for g in groups) == [200, 400] and refused.count() == 1
    assert [k for k, v in parquet_source.schemas_of(spark, [r.path for r in found if r.error or r.path.endswith("/1.parquet")]) if not v] == [r.path for r in found if r.error]


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "windows-1252", "UTF-16LE"])
def test_files_of_another_charset(spark, tmp_path, encoding):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(src, "a.csv", "näme;émail\r\nJürgen;q@example.org\r\nçx;y\r\n".encode(encoding))
    put(src, "b.ndjson", '{"näme":"Zoë","mail":"w@example.org"}\n{"näme":"ñ","mail":"-"}\n'.encode(encoding))
    put(src, "c.json", '[{"k":"ü","mail":"e@example.org"}]'.encode(encoding))
    bad = {"ISO-8859-1": [], "windows-1252": [b"a,b\n1,\x81\n"], "UTF-16LE": ["a,b\n1,2\n".encode(encoding) + b"\x00\xd8"]}[encoding]
    for content in bad:
        put(src, "bad.csv", content)
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # Spark's readers take other charsets than its own list only so
    try:
        results = protect_files(spark, src, out, Policy((Rule("EMAIL_ADDRESS", "redact"),)), SECRETS, encoding=encoding)
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")
    assert {r.source_key: (r.rows, r.error) for r in results.collect()} == {"a.csv": (2, None), "b.ndjson": (2, None), "c.json": (1, None)} | {"bad.csv": (0, "Invalid encoding") for _ in bad}

    def text(fmt, key):
        folder = f"{out}/protected/{fmt}/source_key={key}"
        return "".join(open(f"{folder}/{f}", "rb").read().decode(encoding) for f in sorted(os.listdir(folder)) if f.startswith("part"))

    assert text("csv", "a.csv").splitlines() == ["näme,émail", "Jürgen,[REDACTED]", "çx,y"]
    assert [json.loads(x) for x in text("json", "b.ndjson").splitlines()] == [{"mail": "[REDACTED]", "näme": "Zoë"}, {"mail": "-", "näme": "ñ"}]
    assert json.loads(text("json", "c.json")) == {"k": "ü", "mail": "[REDACTED]"}
    assert not os.path.exists(f"{out}/schema_issues") or spark.read.parquet(f"{out}/schema_issues").count() == 0
