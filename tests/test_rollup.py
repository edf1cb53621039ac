from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from feedquality import ConfigError, group_agg


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [("a", "x", 1, 1.5, "2"), ("a", "x", 3, None, "n/a"), ("a", "y", None, 2.0, "1.5"), ("b", "x", 4, 4.0, None),
         (None, "x", 5, 1.0, "1"), (None, "y", 6, 1.0, "1")],
        "k string, j string, q bigint, p double, t string").withColumn(
        "place", F.when(F.col("k").isNotNull(), F.struct(F.col("j").alias("city"), F.col("k").alias("state"))))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_output_order_is_key_then_function_blocks(sales):
    df = group_agg(sales, "k", count="p", max="t", min="j", avg="p", sum="q", naming="suffix")
    assert df.columns == ["k", "q_sum", "p_avg", "j_min", "t_max", "p_count"]
    assert rows(df) == sorted([("a", 4, 1.75, "x", "n/a", 2), ("b", 4, 4.0, "x", None, 1),
                               (None, 11, 1.0, "x", "1", 2)], key=repr)


def test_aggregates_keep_the_source_name(sales):
    df = group_agg(sales, "k", sum="q", avg="p")
    assert df.columns == ["k", "q", "p"]
    assert dict(df.dtypes)["q"] == "bigint"


def test_lists_and_comma_text_agree(sales):
    assert rows(group_agg(sales, ["k", "j"], sum=["q", "p"])) == rows(group_agg(sales, "k, j", sum="q, p"))


@pytest.mark.parametrize("arguments", [{"sum": "q", "max": "q"}, {"sum": "q,q"}, {"count": "k"}])
def test_one_name_for_two_columns_is_refused(sales, arguments):
    with pytest.raises(ConfigError):
        group_agg(sales, "k", **arguments)


def test_key_without_function_is_distinct(sales):
    assert rows(group_agg(sales, "k")) == [("a",), ("b",), (None,)]


@pytest.mark.parametrize("key", [None, []])
def test_missing_key_is_refused(sales, key):
    with pytest.raises(ConfigError):
        group_agg(sales, key, sum="q")


def test_naming_is_checked(sales):
    with pytest.raises(ConfigError):
        group_agg(sales, "k", sum="q", naming="other")


def test_struct_key_groups_its_null(sales):
    found = {(tuple(r["place"]) if r["place"] else None): r["q"] for r in group_agg(sales, "place", sum="q").collect()}
    assert found == {("x", "a"): 4, ("y", "a"): None, ("x", "b"): 4, None: 11}


def test_struct_field_and_expression_keys(sales):
    assert group_agg(sales, "place.city", sum="q").columns == ["city", "q"]
    assert group_agg(sales, "upper(k)", sum="q").columns == ["upper(k)", "q"]
    assert rows(group_agg(sales, F.concat("k", "j").alias("kj"), count="q")) == [
        ("ax", 2), ("ay", 0), ("bx", 1), (None, 2)]
    assert rows(group_agg(sales, [F.upper("k").alias("u"), "j"])) == [
        ("A", "x"), ("A", "y"), ("B", "x"), (None, "x"), (None, "y")]


def test_text_numbers_are_added_and_other_text_is_skipped(sales):
    df = group_agg(sales, "k", sum="t")
    assert rows(df) == [("a", 3.5), ("b", None), (None, 2.0)]


def test_min_and_max_of_structs(sales):
    r = group_agg(sales.where("k = 'a'"), "k", min="place").first()
    assert tuple(r["place"]) == ("x", "a")


def test_overflow_is_loud(spark):
    df = spark.sql("select 1 as k, 9223372036854775807 as q union all select 1, 1")
    with pytest.raises(PySparkException):
        group_agg(df, "k", sum="q").collect()


def test_unknown_columns_are_loud(sales):
    with pytest.raises(AnalysisException):
        group_agg(sales, "k", sum="zz").collect()


def test_column_names_that_need_quotes(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], ["a.b", "c d"])
    assert rows(group_agg(df, "a.b", sum="c d")) == [(1, 5)]


def test_aggregation_is_partial_then_final(sales):
    plan = group_agg(sales, "k", sum="q", count="p")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_count" in plan


def test_an_expression_among_several_keys(spark):
    df = spark.createDataFrame([("a", 1, 2), ("A", 1, 3), ("b,c", 2, 4)], "t string, k int, n int")
    got = {tuple(r) for r in group_agg(df, "upper(t),k", sum="n").collect()}
    assert got == {("A", 1, 5), ("B,C", 2, 4)}
    got = {tuple(r) for r in group_agg(df, "concat(t, ',', coalesce(k, 0)), k", sum="n").collect()}
    assert got == {("a,1", 1, 2), ("A,1", 1, 3), ("b,c,2", 2, 4)}
