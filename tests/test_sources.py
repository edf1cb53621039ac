from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from feedquality import (ConfigError, EmptyFeedError, MissingFeedError, SchemaMismatchError, SourceSpec,
                         TableModel, check_schema, check_tables, clean, feed_listing, feed_ready, read_table,
                         require_feed, sources_from, split_corrupt)
from tests.fixtures import PURCHASES, USERS, models, suites, write_lines


def problems(df, model):
    return {(p.column, p.problem) for p in check_schema(df, model).problems}


def read(spark, path, model=None, mode="infer", **options):
    return read_table(spark, SourceSpec(str(path), schema=model.schema if model else None, mode=mode, options=options))


# --- dispatch -----------------------------------------------------------------------------


def test_format_comes_from_the_extension(spark):
    assert SourceSpec("/a/b.c/feed.JSON", mode="infer").format == "json"
    assert SourceSpec("feed.txt").format == "text"
    assert SourceSpec("/dir/part-*", "csv", mode="infer").format == "csv"
    for path in ("feed.xml", "feed"):
        with pytest.raises(ConfigError):
            SourceSpec(path)
    with pytest.raises(ConfigError):
        SourceSpec("a.json")                       # declared, but no schema
    with pytest.raises(ConfigError):
        SourceSpec("a.json", mode="guess")


def test_sources_by_position(spark):
    found = sources_from("/x/users.json, /x/sales.csv", ["users", "purchase"], mode="infer")
    assert {n: (s.path, s.format) for n, s in found.items()} == {
        "users": ("/x/users.json", "json"), "purchase": ("/x/sales.csv", "csv")}
    with pytest.raises(ConfigError):
        sources_from("/x/users.json", ["users", "purchase"])


# --- readiness ---------------------------------------------------------------------------------


def test_readiness(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    full = write_lines(tmp_path / "full.json", USERS)
    require_feed(spark, full)
    assert feed_ready(spark, full) and feed_ready(spark, str(tmp_path)) and feed_ready(spark, f"{tmp_path}/f*.json")
    with pytest.raises(EmptyFeedError):
        require_feed(spark, str(tmp_path / "empty.json"))
    with pytest.raises(MissingFeedError):
        require_feed(spark, str(tmp_path / "missing.json"))
    assert not feed_ready(spark, str(tmp_path / "empty.json"))
    assert not feed_ready(spark, str(tmp_path / "missing.json"))
    listed = feed_listing(spark, str(tmp_path)).collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in listed] == ["full.json"]
    assert listed[0]["length"] == len((tmp_path / "full.json").read_bytes())


def test_listing_reads_no_content(spark, tmp_path):
    write_lines(tmp_path / "full.json", USERS)
    plan = feed_listing(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert "GreaterThan(length,0)" in plan


# --- what each feed looks like when inferred ------------------------------------------------------


def test_well_formed_lines_fit_their_models(spark, tmp_path):
    for rows, model in zip((USERS, PURCHASES), models()):
        df = read(spark, write_lines(tmp_path / f"{model.name}.json", rows))
        assert check_schema(df, model).ok


def test_corrupt_line(spark, tmp_path):
    model = models()[1]
    path = tmp_path / "corrupt.json"
    path.write_text(json.dumps(PURCHASES[0]) + "\n{bad\n")
    assert problems(read(spark, path), model) == {("_corrupt_record", "unexpected column")}
    good, bad = split_corrupt(read(spark, path, model, "declared"))
    assert check_schema(good, model).ok
    assert [r["Quantity"] for r in good.collect()] == [2]
    assert [(r["raw_record"], r["failed_rules"]) for r in bad.collect()] == [("{bad", ["corrupt_record"])]


def test_all_null_quantity(spark, tmp_path):
    model = models()[1]
    path = write_lines(tmp_path / "nulls.json", [{**r, "Quantity": None} for r in PURCHASES])
    assert problems(read(spark, path), model) == {("Quantity", "type mismatch")}
    good, _ = split_corrupt(read(spark, path, model, "declared"))
    assert check_schema(good, model).ok
    assert clean(good, suites()[1]).kept.isEmpty()


def test_extra_and_missing_keys(spark, tmp_path):
    model = models()[1]
    extra = write_lines(tmp_path / "extra.json", [{**r, "Note": "x"} for r in PURCHASES])
    assert problems(read(spark, extra), model) == {("Note", "unexpected column")}
    assert check_schema(split_corrupt(read(spark, extra, model, "declared"))[0], model).ok
    some = write_lines(tmp_path / "some.json", [PURCHASES[0], {k: v for k, v in PURCHASES[1].items() if k != "Date"}])
    assert check_schema(read(spark, some), model).ok
    none = write_lines(tmp_path / "none.json", [{k: v for k, v in r.items() if k != "Date"} for r in PURCHASES])
    assert problems(read(spark, none), model) == {("Date", "missing column")}


def test_json_arrays(spark, tmp_path):
    model = models()[1]
    pretty, line = tmp_path / "array_pretty.json", tmp_path / "array_one_line.json"
    pretty.write_text(json.dumps(PURCHASES, indent=2))
    line.write_text(json.dumps(PURCHASES))
    assert ("_corrupt_record", "unexpected column") in problems(read(spark, pretty), model)
    assert check_schema(read(spark, pretty, multiLine="true"), model).ok
    assert check_schema(read(spark, line), model).ok and read(spark, line).count() == len(PURCHASES)


def test_fractional_quantity(spark, tmp_path):
    model = models()[1]
    path = write_lines(tmp_path / "fraction.json", [PURCHASES[0], {**PURCHASES[1], "Quantity": 2.5}])
    assert problems(read(spark, path), model) == {("Quantity", "type mismatch")}
    good, bad = split_corrupt(read(spark, path, model, "declared"))
    assert [r["Quantity"] for r in good.collect()] == [2] and bad.collect()[0]["user_id"] == "U01"


CSV = "Date,user_id,Product_Name,Quantity,Unit_Price,Total_Sale_Amount\n2024-01-01,001,pen,3,1.5,4.5\n"


def test_csv_inferred_and_declared(spark, tmp_path):
    model = models()[1]
    path = tmp_path / "purchase.csv"
    path.write_text(CSV)
    assert ("Quantity", "type mismatch") in problems(read(spark, path), model)
    assert ("user_id", "type mismatch") in problems(read(spark, path), model)
    good, _ = split_corrupt(read(spark, path, model, "declared"))
    assert check_schema(good, model).ok
    assert tuple(good.collect()[0]) == ("2024-01-01", "001", "pen", 3, "1.5", "4.5")


def test_declared_csv_notices_a_different_header(spark, tmp_path):
    """Columns in another order must not slip in under the declared names."""
    model = models()[1]
    path = tmp_path / "swapped.csv"
    path.write_text("user_id,Date,Product_Name,Quantity,Unit_Price,Total_Sale_Amount\n001,2024-01-01,pen,3,1.5,4.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        split_corrupt(read(spark, path, model, "declared"))[0].collect()


def test_declared_csv_keeps_a_bad_line_aside(spark, tmp_path):
    model = models()[1]
    path = tmp_path / "bad.csv"
    path.write_text(CSV + "2024-01-02,002,pen,many,1.5,4.5\n")
    good, bad = split_corrupt(read(spark, path, model, "declared"))
    assert [r["user_id"] for r in good.collect()] == ["001"]
    assert [r["raw_record"] for r in bad.collect()] == ["2024-01-02,002,pen,many,1.5,4.5"]


@pytest.mark.parametrize("name, text", [
    ("a.json", '{"id":1,"n":1,"s":"a"}\n{"id":2,"n":"x","s":"b"}\n{"id":3,"n":2\n{"id":4,"n":5,"s":"q"}\n'),
    ("a.csv", "id,n,s\n1,1,a\n2,x,b\n3,2\n4,5,q\n"),
])
def test_what_counts_as_corrupt_does_not_depend_on_the_columns_used(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    schema = T.StructType.fromDDL("id bigint, n bigint, s string")
    good, bad = split_corrupt(read_table(spark, SourceSpec(str(tmp_path / name), schema=schema)))
    assert sorted(r[0] for r in good.select("id").collect()) == sorted(r["id"] for r in good.collect()) == [1, 4]
    assert good.count() == 2 and bad.count() == 2


def test_text(spark, tmp_path):
    path = tmp_path / "notes.txt"
    path.write_text("one\ntwo\n")
    df = read(spark, path, mode="declared")
    assert df.schema == T.StructType([T.StructField("value", T.StringType())]) and df.count() == 2
    assert ("value", "unexpected column") in problems(df, models()[0])
    assert split_corrupt(df) == (df, None)


def test_parquet(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t.parquet"))
    assert read(spark, tmp_path / "t.parquet", mode="declared").count() == 5
    declared = SourceSpec(str(tmp_path / "t.parquet"), schema=T.StructType.fromDDL("id bigint, extra string"))
    assert read_table(spark, declared).columns == ["id", "extra"]


# --- schema gate ---------------------------------------------------------------------------------------


def test_gate_reports_everything_and_ignores_order(spark):
    model = TableModel.from_json({"schema": {"a": {"type": "bigint"}, "b": {"type": "string"},
                                             "s": {"type": "struct<x:int,y:string>"}}}, "t")
    ok = spark.sql("select 'b' as b, named_struct('x', 1, 'y', 'z') as s, 1L as a")
    assert check_schema(ok, model).ok
    check_schema(ok, model).require()
    bad = spark.sql("select 1 as a, 'b' as B, named_struct('y', 'z', 'x', 1) as s")
    assert problems(bad, model) == {("a", "type mismatch"), ("b", "missing column"), ("B", "unexpected column"),
                                    ("s", "type mismatch")}
    with pytest.raises(SchemaMismatchError, match="t.a: type mismatch"):
        check_schema(bad, model).require()
    report = check_schema(bad, model).to_df(spark)
    assert report.columns == ["table", "column", "expected", "actual", "problem"] and report.count() == 4
    assert check_schema(ok, model).to_df(spark).isEmpty()


def test_gate_over_tables(spark):
    model = TableModel.from_json({"schema": {"id": {"type": "bigint"}}}, "t")
    assert check_tables([(spark.range(1), model), (spark.range(2), model)]).ok
    assert not check_tables([(spark.range(1), model), (spark.sql("select 1 as id"), model)]).ok
    twice = spark.sql("select 1L as id, 2L as id")
    assert problems(twice, model) == {("id", "repeated column")}
