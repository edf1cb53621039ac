from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from feedquality import (ConfigError, RECORD_SEPARATOR, SinkSpec, SourceSpec, split_corrupt, as_lines, bigquery_sink, flatten, mongo_sink, read_table,
                         sink_for, write_connector, write_table)
from feedquality.sinks.writers import save_mode


@pytest.fixture(scope="module")
def nested(spark):
    return spark.sql("select named_struct('city', 'Pune', 'state', 'MH') as user_address, 10L as Quantity,"
                     " array(1, 2) as tags union all select null, 3L, null")


def lines(path):
    return sorted(line for f in path.glob("part-*") for line in f.read_text().splitlines())


def test_json_leaves_out_nulls(nested, tmp_path):
    write_table(nested, SinkSpec("json", str(tmp_path / "j")))
    assert [json.loads(x) for x in lines(tmp_path / "j")] == [
        {"Quantity": 3}, {"user_address": {"city": "Pune", "state": "MH"}, "Quantity": 10, "tags": [1, 2]}]


def test_csv_is_flat_and_without_header_by_default(nested, tmp_path):
    write_table(nested, SinkSpec("csv", str(tmp_path / "c")))
    assert lines(tmp_path / "c") == [",,3,", "Pune,MH,10,\"[1,2]\""]
    write_table(nested.limit(1), SinkSpec("csv", str(tmp_path / "h"), {"header": "true"}))
    assert "user_address_city,user_address_state,Quantity,tags" in lines(tmp_path / "h")


def test_flattening_may_not_merge_columns(spark):
    with pytest.raises(ConfigError):
        flatten(spark.sql("select named_struct('b', 1) as a, 2 as a_b"))


def test_text_takes_one_string_column_or_json(spark, nested, tmp_path):
    write_table(spark.sql("select 'hello' as s"), SinkSpec("txt", str(tmp_path / "t")))
    assert lines(tmp_path / "t") == ["hello"]
    assert as_lines(nested).columns == ["value"]
    write_table(nested, SinkSpec("text", str(tmp_path / "u")))
    assert json.loads(lines(tmp_path / "u")[0]) == {"Quantity": 3}
    assert as_lines(spark.range(1)).first()[0] == '{"id":0}'


def test_parquet_round_trip(nested, spark, tmp_path):
    write_table(nested, SinkSpec("parquet", str(tmp_path / "p")))
    back = read_table(spark, SourceSpec(str(tmp_path / "p"), "parquet"))
    assert back.schema.simpleString() == nested.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, nested.collect()))


def test_dispositions(spark, tmp_path):
    path = str(tmp_path / "d")

    def count():
        return spark.read.parquet(path).count()
    write_table(spark.range(3), SinkSpec("parquet", path))
    with pytest.raises(AnalysisException):
        write_table(spark.range(3), SinkSpec("parquet", path))
    for mode, expected in (("append", 6), ("ignore", 6), ("overwrite", 3)):
        write_table(spark.range(3), SinkSpec("parquet", path, mode=mode))
        assert count() == expected


@pytest.mark.parametrize("mode", ["WRITE_APPEND", "replace", ""])
def test_other_dispositions_are_refused(mode):
    with pytest.raises(ConfigError):
        save_mode(mode)


def test_default_modes():
    assert SinkSpec("json", "/x").mode == "errorifexists"
    assert SinkSpec("mongodb").mode == "append"
    for arguments in (("",), ("json",)):
        with pytest.raises(ConfigError):
            SinkSpec(*arguments)


def test_connector_options():
    bq = bigquery_sink("set.table", "create_if_needed", "append", "my-project")
    assert (bq.format, bq.mode) == ("bigquery", "append")
    assert bq.options == {"table": "set.table", "createDisposition": "CREATE_IF_NEEDED", "project": "my-project"}
    assert bigquery_sink("set.table").options == {"table": "set.table"}
    with pytest.raises(ConfigError):
        bigquery_sink("set.table", "sometimes")
    mongo = mongo_sink("db.totals", "mongodb://host:1/", "overwrite")
    assert (mongo.format, mongo.mode) == ("mongodb", "overwrite")
    assert mongo.options == {"spark.mongodb.write.connection.uri": "mongodb://host:1/db.totals"}


def test_sinks_by_word():
    assert sink_for("file", "/out/x.json").format == "json"
    assert sink_for("file", "/out/x", "txt").format == "text"
    assert sink_for("mongo", "db.c", None, "mongodb://h/", "append", "create_if_needed") == mongo_sink(
        "db.c", "mongodb://h/", "append")
    assert sink_for("bq", "a.b", None, "p", None, "create_never") == bigquery_sink("a.b", "create_never", None, "p")
    for arguments in (("disk", "/x"), ("file", "/out/x"), ("file", "/out/x.xml")):
        with pytest.raises(ConfigError):
            sink_for(*arguments)


def test_connectors_go_through_the_generic_writer(spark, nested, tmp_path):
    write_connector(nested, "noop", {}, "overwrite")
    write_connector(nested, "parquet", {"path": str(tmp_path / "c")}, "append")
    write_table(nested, SinkSpec("orc", str(tmp_path / "o")))
    assert spark.read.parquet(str(tmp_path / "c")).count() == spark.read.orc(str(tmp_path / "o")).count() == 2


def test_a_missing_connector_is_an_error(nested):
    with pytest.raises(Exception, match="(?i)mongodb"):
        write_table(nested, mongo_sink("db.c", "mongodb://h/"))


AWKWARD = ["  pad ", "", None, 'q"uo"te', "back\\slash", "a,b", '"', '\\"', "\\N", "line\nbreak\r\nx", "'", " ", '""', "é\t", "#c"]


@pytest.mark.parametrize("format", ["csv", "json"])
def test_values_come_back_as_they_were(spark, tmp_path, format):
    rows = spark.createDataFrame(list(enumerate(AWKWARD)), "id int, t string").selectExpr(
        "id", "t", "timestamp'2024-01-02 03:04:05.123456' as at", "if(id % 3 = 0, null, id / 7) as d")
    options = {"lineSep": RECORD_SEPARATOR} if format == "csv" else {}
    write_table(rows, SinkSpec(format, str(tmp_path / "x"), {"header": "true", **options} if options else {}))
    good, bad = split_corrupt(read_table(spark, SourceSpec(str(tmp_path / "x"), format, rows.schema, options=options)))
    assert bad.isEmpty() and sorted(map(tuple, good.collect())) == sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("format", ["csv", "text"])
def test_a_value_that_would_become_two_rows_fails_the_write(spark, tmp_path, format):
    separated = {"lineSep": RECORD_SEPARATOR}
    for i, (text, options) in enumerate([("a\nb", {}), ("a\rb", {}), (f"a{RECORD_SEPARATOR}b", separated)]):
        df = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(Exception, match="holds the line separator"):
            write_table(df, SinkSpec(format, str(tmp_path / f"never{i}"), options))
    df = spark.createDataFrame([("a\nb",), ("c",)], "t string")
    write_table(df, SinkSpec("text", str(tmp_path / "t"), {"lineSep": RECORD_SEPARATOR}))
    back = read_table(spark, SourceSpec(str(tmp_path / "t"), "text", options={"lineSep": RECORD_SEPARATOR}))
    assert sorted(r[0] for r in back.collect()) == ["a\nb", "c"]


# --- runs and catalog tables ----------------------------------------------------------------------


@pytest.mark.parametrize("format", ["json", "csv", "text", "parquet"])
def test_a_run_done_again_replaces_its_own_rows(spark, tmp_path, format):
    path = str(tmp_path / "out")

    def run(name, rows):
        write_table(spark.createDataFrame(rows, "a string"), SinkSpec(format, path, {"header": "true"} if format == "csv" else {},
                                                                      mode="append", run_id=name))

    def stored():
        column = "value" if format == "text" else "a"
        read = spark.read.option("header", "true").format(format).load(path)
        return sorted((r["run_id"], r[column]) for r in read.collect())

    run("monday", [("x",), ("y",)])
    run("monday", [("x",), ("y",)])
    run("tue's/day", [("z",)])
    assert stored() == [("monday", "x"), ("monday", "y"), ("tue's/day", "z")]
    run("monday", [("w",)])
    assert stored() == [("monday", "w"), ("tue's/day", "z")]
    run("tue's/day", [])
    assert stored() == [("monday", "w")]


def test_a_run_id_needs_appending(spark, tmp_path):
    for bad in ({"mode": "overwrite"}, {"mode": None}, {"mode": "append", "run_id": ""}):
        with pytest.raises(ConfigError):
            SinkSpec("json", str(tmp_path / "x"), **{"run_id": "r", **bad})
    with pytest.raises(ConfigError):
        SinkSpec("mongodb", mode="append", run_id="r")
    with pytest.raises(ConfigError, match="run_id"):
        write_table(spark.range(1).toDF("run_id"), SinkSpec("json", str(tmp_path / "x"), mode="append", run_id="r"))


@pytest.fixture()
def table_name(spark):
    name = "sink_test"
    spark.sql(f"drop table if exists {name}")
    yield name
    spark.sql(f"drop table if exists {name}")


def test_create_dispositions_of_tables(spark, table_name):
    rows = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    with pytest.raises(ConfigError, match="not there"):
        write_table(rows, SinkSpec("table", table_name, create_disposition="create_never"))
    write_table(rows, SinkSpec("table", table_name, create_disposition="create_if_needed"))
    for _ in range(2):  # by name, whatever the order, and the table keeps its definition
        write_table(rows.select("b", "a"), SinkSpec("table", table_name, create_disposition="create_never"))
    assert sorted((r.a, r.b) for r in spark.table(table_name).collect()) == [(1, "x")] * 3 + [(2, None)] * 3
    write_table(rows, SinkSpec("table", table_name, mode="overwrite"))
    write_table(rows, SinkSpec("table", table_name, mode="ignore"))
    assert spark.table(table_name).count() == 2 and spark.table(table_name).columns == ["a", "b"]
    with pytest.raises(ConfigError, match="already"):
        write_table(rows, SinkSpec("table", table_name, mode="errorifexists"))
    for other in (rows.select("a"), rows.selectExpr("cast(a as bigint) as a", "b"), rows.withColumn("c", rows.a)):
        with pytest.raises(ConfigError, match="rows are"):
            write_table(other, SinkSpec("table", table_name))
    assert spark.table(table_name).count() == 2


def test_runs_in_a_table(spark, table_name):
    for name, values in (("m", [1, 2]), ("t's", [3]), ("m", [5]), ("t's", []), ("{u}", [])):
        write_table(spark.createDataFrame([(v,) for v in values], "a int"), SinkSpec("table", table_name, mode="append", run_id=name))
    assert [tuple(r) for r in spark.table(table_name).collect()] == [(5, "m")]


def test_sinks_by_word():
    assert sink_for("table", "db.t", create_disposition="create_never", run_id="r").create_disposition == "CREATE_NEVER"
    for bad in (lambda: sink_for("bq", "d.t", run_id="r"), lambda: SinkSpec("table"), lambda: SinkSpec("json", "x", create_disposition="create_never"),
                lambda: SinkSpec("table", "t", create_disposition="maybe")):
        with pytest.raises(ConfigError):
            bad()
