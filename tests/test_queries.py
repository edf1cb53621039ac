"""Every registered query against its SQL, and the shape of the plans that matter."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from feedquality.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, db, name):
    df = contract.queries()[name](spark, SF)
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = Counter(map(repr, result.fetchall()))
    assert Counter(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
    text = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_row_rules_share_one_scan_and_one_exchange(spark):
    from feedquality import quality_report
    from feedquality.plans.queries import graded_orders, rule, suite
    rules = suite(rule("ColumnValuesToNotBeNull", "pri"), rule("ColumnValueLengthsToEqual", "pri", value=6),
                  rule("ColumnValuesToBeInSet", "o_custkey", value_set=[1, 2]), rule("ColumnToExist", "pri"))
    text = plan(quality_report(graded_orders(spark, SF), rules))
    assert text.count("FileScan") == 1 and text.count("Exchange SinglePartition") == 1
    assert "o_orderdate" not in text


def test_enforcement_is_a_filter_without_exchange(spark):
    text = plan(contract.queries()["rule_between_keep"](spark, SF))
    assert "Exchange" not in text and "PushedFilters: [Or(IsNull(p_size)" in text
    text = plan(contract.queries()["filter_not_equal"](spark, SF))
    assert "Not(EqualTo(o_orderstatus,F))" in text


def test_failing_values_are_limited_before_the_exchange(spark):
    from feedquality.operators.quality import _failing, _ranked
    from feedquality.plans.queries import rule, suite, table
    rules = suite(rule("ColumnValueLengthsToEqual", "text", value=6))
    text = plan(_ranked(_failing(table(spark, SF, "documents"), rules), 20))
    assert text.count("WindowGroupLimit") == 2
    # what is shuffled to count and rank holds no text
    assert not any("value#" in line for line in text.split("\n") if "Exchange" in line)


def test_totals_shuffle_sums_not_purchases(spark, monkeypatch):
    from feedquality.plans import job
    staged = []
    real = job.stage
    monkeypatch.setattr(job, "stage", lambda df, name: staged.append(df) or real(df, name))
    contract.queries()["flagship"](spark, SF).collect()
    assert [df.columns for df in staged] == [["user_id", "Quantity"]]  # the sums, a row for each user
    text = plan(staged[0])
    assert "partial_sum(Quantity" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text
