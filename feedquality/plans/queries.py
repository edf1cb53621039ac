"""One query per operator, over the TPC-H-like tables, each with the SQL it must agree with.

The tables hold no nulls, so the queries that are about nulls turn one of a column's
values into null, in the same words on both sides (``nullif``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedquality.__main__ import job_spec
from feedquality.model import TableModel
from feedquality.operators.joins import join_range, join_tables
from feedquality.operators.quality import (clean, failing_values, failures, observe_rules, quality_report,
                                           verdict)
from feedquality.operators.rollup import group_agg
from feedquality.operators.schema_gate import check_schema, check_tables
from feedquality.plans.job import FeedSpec, JobSpec, run_job, totals
from feedquality.rules import RuleSet, required_rules
from feedquality.session import scratch_path
from feedquality.sinks.writers import RECORD_SEPARATOR, SinkSpec, write_connector, write_table
from feedquality.sources.feeds import SourceSpec, feed_listing, read_table, require_feed, split_corrupt
from feedquality.sources.staged import stage_feed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, next to its SQL."""
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, SourceSpec(f"{sf}/{name}.parquet"))


def rule(expectation: str, column: str, rule_id: str = "", action: str = "row", **args: Any) -> dict[str, Any]:
    meta: dict[str, Any] = {"discard_row_on_failure": action == "row",
                            "discard_column_on_failure": action == "column"}
    if rule_id:
        meta["rule_id"] = rule_id
    return {"expectation_name": f"Expect{expectation}", "args": {"column": column, **args}, "meta": meta}


def suite(*rules: Mapping[str, Any]) -> RuleSet:
    return RuleSet.from_json({"expectation_suite_name": "suite", "expectations": list(rules)})


def nullif(column: str, value: Any):
    return F.nullif(F.col(column), F.lit(value))


def graded_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose priority is null where it was urgent."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", nullif("o_orderpriority", "1-URGENT").alias("pri"))


P = "(select o_orderkey, o_custkey, nullif(o_orderpriority, '1-URGENT') as pri from orders) t"


# --- row rules -------------------------------------------------------------------


@query(f"select count(*) as n, count(*) - count(pri) as bad from {P}")
def rule_not_null_metric(spark, sf):
    report = quality_report(graded_orders(spark, sf), suite(rule("ColumnValuesToNotBeNull", "pri")))
    return report.select(F.col("element_count").alias("n"), F.col("unexpected_count").alias("bad"))


@query(f"select o_orderkey, pri from {P} where pri is not null")
def rule_not_null_keep(spark, sf):
    return clean(graded_orders(spark, sf), suite(rule("ColumnValuesToNotBeNull", "pri"))).kept.select(
        "o_orderkey", "pri")


@query(f"select o_orderkey, pri from {P} where pri is null or length(pri) = 6")
def rule_length_equal_keep(spark, sf):
    rules = suite(rule("ColumnValueLengthsToEqual", "pri", value=6))
    return clean(graded_orders(spark, sf), rules).kept.select("o_orderkey", "pri")


@query(f"select o_orderkey, pri from {P} where length(pri) = 6")
def rule_length_equal_by_value(spark, sf):
    rules = suite(rule("ColumnValueLengthsToEqual", "pri", value=6))
    return clean(graded_orders(spark, sf), rules, mode="by_value").kept.select("o_orderkey", "pri")


@query("select c_custkey, c_mktsegment from customer where length(c_mktsegment) between 9 and 10")
def rule_length_between_keep(spark, sf):
    rules = suite(rule("ColumnValueLengthsToBeBetween", "c_mktsegment", min_value=9, max_value=10))
    return clean(table(spark, sf, "customer"), rules).kept.select("c_custkey", "c_mktsegment")


@query("select doc_id, length(text) as chars from documents where length(text) <= 2000")
def rule_length_open_ended_keep(spark, sf):
    rules = suite(rule("ColumnValueLengthsToBeBetween", "text", min_value=None, max_value=2000))
    kept = clean(table(spark, sf, "documents").select("doc_id", "text"), rules).kept
    return kept.select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("select page_id, length(html) as chars from pages where regexp_matches(html, 'lang=\"(en|fr)\"')")
def rule_regex_keep(spark, sf):
    rules = suite(rule("ColumnValuesToMatchRegex", "html", regex='lang="(en|fr)"'))
    kept = clean(table(spark, sf, "pages").select("page_id", "html"), rules).kept
    return kept.select("page_id", F.length("html").cast("bigint").alias("chars"))


@query("select c_custkey from customer where regexp_matches(c_name, '7$')"
       " or regexp_matches(c_name, '^Customer#0000000')")
def rule_regex_any_keep(spark, sf):
    rules = suite(rule("ColumnValuesToMatchRegexList", "c_name", match_on="any",
                       regex_list=["7$", "^Customer#0000000"]))
    return clean(table(spark, sf, "customer"), rules).kept.select("c_custkey")


@query("select c_custkey from customer where regexp_matches(c_name, '7$')"
       " and regexp_matches(c_name, '^Customer#0000000')")
def rule_regex_all_keep(spark, sf):
    rules = suite(rule("ColumnValuesToMatchRegexList", "c_name", match_on="all",
                       regex_list=["7$", "^Customer#0000000"]))
    return clean(table(spark, sf, "customer"), rules).kept.select("c_custkey")


@query(f"select count(*) as n, count(pri) as bad, count(pri) = 0 as success from {P}")
def rule_be_null_metric(spark, sf):
    report = quality_report(graded_orders(spark, sf), suite(rule("ColumnValuesToBeNull", "pri")))
    return report.select(F.col("element_count").alias("n"), F.col("unexpected_count").alias("bad"), "success")


@query(f"select o_orderkey, pri from {P} where pri is null")
def rule_be_null_keep(spark, sf):
    return clean(graded_orders(spark, sf), suite(rule("ColumnValuesToBeNull", "pri"))).kept.select(
        "o_orderkey", "pri")


EVENT_TYPES = ["click", "view", "purchase", "signup"]
IN_EVENT_TYPES = "event_type in ('click', 'view', 'purchase', 'signup')"


@query("select mostly, n, bad, (n - bad) / cast(n as double) >= mostly as success from (select count(*) as n,"
       f" count(*) filter (where not {IN_EVENT_TYPES}) as bad from events) e"
       " cross join (select cast(0.75 as double) as mostly union all select cast(0.9 as double)) m")
def rule_in_set_metric(spark, sf):
    rules = suite(*[rule("ColumnValuesToBeInSet", "event_type", value_set=EVENT_TYPES, mostly=m)
                    for m in (0.75, 0.9)])
    return quality_report(table(spark, sf, "events"), rules).select(
        "mostly", F.col("element_count").alias("n"), F.col("unexpected_count").alias("bad"), "success")


@query(f"select event_id, event_type from events where {IN_EVENT_TYPES}")
def rule_in_set_keep(spark, sf):
    rules = suite(rule("ColumnValuesToBeInSet", "event_type", value_set=EVENT_TYPES, mostly=None))
    return clean(table(spark, sf, "events"), rules).kept.select("event_id", "event_type")


@query("select event_id, event_type from events where (select count(*) filter"
       f" (where {IN_EVENT_TYPES}) >= 0.75 * count(*) from events) or {IN_EVENT_TYPES}")
def rule_in_set_mostly_passes(spark, sf):
    rules = suite(rule("ColumnValuesToBeInSet", "event_type", value_set=EVENT_TYPES, mostly=0.75))
    return clean(table(spark, sf, "events"), rules).kept.select("event_id", "event_type")


@query("select event_id, event_type from events where (select count(*) filter"
       f" (where {IN_EVENT_TYPES}) >= 0.9 * count(*) from events) or {IN_EVENT_TYPES}")
def rule_in_set_mostly_fails(spark, sf):
    rules = suite(rule("ColumnValuesToBeInSet", "event_type", value_set=EVENT_TYPES, mostly=0.9))
    return clean(table(spark, sf, "events"), rules).kept.select("event_id", "event_type")


@query("select p_partkey, p_size from part where p_size between 10 and 20")
def rule_between_keep(spark, sf):
    rules = suite(rule("ColumnValuesToBeBetween", "p_size", min=10, max=20))
    return clean(table(spark, sf, "part"), rules).kept.select("p_partkey", "p_size")


@query("select p_partkey, p_size, p_brand from part where p_brand <> 'Brand#2'")
def rule_exists_and_type_keep(spark, sf):
    rules = suite(rule("ColumnToExist", "p_brand"),
                  rule("ColumnValuesToBeOfType", "p_size", type="IntegerType"),
                  rule("ColumnValuesToBeOfType", "p_retailprice", type="double"),
                  rule("ColumnValuesToMatchRegex", "p_brand", regex="^Brand#(?!2$)"))
    return clean(table(spark, sf, "part"), rules).kept.select("p_partkey", "p_size", "p_brand")


@query("select o_orderkey, o_orderstatus from (select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus"
       " from orders) o where o_orderkey is not null and o_orderstatus is not null")
def required_clean(spark, sf):
    model = TableModel.from_json({"schema": {
        "o_orderkey": {"type": "bigint", "required": "true"},
        "o_orderstatus": {"type": "string", "required": "true"},
        "o_orderpriority": {"type": "string", "required": "false"}}}, "orders")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", nullif("o_orderstatus", "P").alias("o_orderstatus"),
        nullif("o_orderpriority", "1-URGENT").alias("o_orderpriority"))
    return clean(orders, required_rules(model)).kept.select("o_orderkey", "o_orderstatus")


@query("select c_custkey, city from (select c_custkey, nullif(n_name, 'NATION_3') as city from customer"
       " join nation on c_nationkey = n_nationkey) c where city is not null")
def required_clean_nested(spark, sf):
    model = TableModel.from_json({"schema": {
        "c_custkey": {"type": "bigint", "required": "true"},
        "address": {"type": "struct<city:string,state:string>", "required": "true",
                    "city": {"type": "string", "required": "true"},
                    "state": {"type": "string", "required": "true"}}}}, "customer")
    users = user_feed(spark, sf).select(
        F.col("user_key").alias("c_custkey"),
        F.col("user_address").withField("city", nullif("user_address.city", "NATION_3")).alias("address"))
    return clean(users, required_rules(model)).kept.select("c_custkey", F.col("address.city").alias("city"))


# --- uniqueness --------------------------------------------------------------------


@query("select cast(sum(c) as bigint) as n, cast(sum(case when c > 1 then c else 0 end) as bigint) as bad"
       " from (select p_name, count(*) as c from part group by p_name) x")
def rule_unique_metric(spark, sf):
    report = quality_report(table(spark, sf, "part"), suite(rule("ColumnValuesToBeUnique", "p_name")))
    return report.select(F.col("element_count").alias("n"), F.col("unexpected_count").alias("bad"))


@query("select doc_id from (select doc_id, count(*) over (partition by text) as k from documents) t where k = 1")
def rule_unique_keep(spark, sf):
    return clean(table(spark, sf, "documents"), suite(rule("ColumnValuesToBeUnique", "text"))).kept.select("doc_id")


@query("select doc_id, 'copies' as failed_rules from documents where text in"
       " (select text from documents group by text having count(*) > 1)")
def rule_unique_rejected(spark, sf):
    rules = suite(rule("ColumnValuesToBeUnique", "text", "copies"))
    rejected = clean(table(spark, sf, "documents"), rules).rejected
    return rejected.select("doc_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("select o_orderkey, status from (select o_orderkey, nullif(o_orderstatus, 'P') as status,"
       " count(*) over (partition by o_orderstatus) as k from orders) o where status is null or k = 1")
def rule_unique_keeps_nulls(spark, sf):
    """Two values and null, a third of the rows each: the copies go and the nulls stay."""
    orders = table(spark, sf, "orders").select("o_orderkey", nullif("o_orderstatus", "P").alias("status"))
    return clean(orders, suite(rule("ColumnValuesToBeUnique", "status"))).kept


# --- rule engine -----------------------------------------------------------------------


REPORT_SQL = """
with a as (select count(*) as n, count(*) - count(pri) as nulls,
                  count(*) filter (where length(pri) <> 6) as len,
                  count(*) filter (where pri not in ('2-HIGH', '3-MEDIUM')) as other from {P}),
     u as (select cast(sum(case when pri is not null and c > 1 then c else 0 end) as bigint) as copies
           from (select pri, count(*) as c from {P} group by pri) g)
select rule_id, element_count, missing_count, unexpected_count,
       round(unexpected_percent, 4) as unexpected_percent, success, on_failure from (
  select 'filled' as rule_id, n as element_count, 0 as missing_count, nulls as unexpected_count,
         cast(100 as double) * nulls / n as unexpected_percent, nulls = 0 as success, 'discard_row' as on_failure from a
  union all select 'len', n, nulls, len, cast(100 as double) * len / (n - nulls), len = 0, 'discard_row' from a
  union all select 'set', n, nulls, other, cast(100 as double) * other / (n - nulls),
                   (n - nulls - other) >= cast(0.4 as double) * (n - nulls), 'none' from a
  union all select 'copies', n, nulls, copies, cast(100 as double) * copies / (n - nulls), copies = 0, 'none' from a, u
  union all select 'there', null, null, null, null, true, 'none'
  union all select 'absent', null, null, null, null, false, 'none'
  union all select 'long', null, null, null, null, true, 'discard_row') r
""".replace("{P}", P)


def priority_suite() -> RuleSet:
    return suite(
        rule("ColumnValuesToNotBeNull", "pri", "filled"),
        rule("ColumnValueLengthsToEqual", "pri", "len", value=6),
        rule("ColumnValuesToBeInSet", "pri", "set", "none", value_set=["2-HIGH", "3-MEDIUM"], mostly=0.4),
        rule("ColumnValuesToBeUnique", "pri", "copies", "none"),
        rule("ColumnToExist", "pri", "there", "none"),
        rule("ColumnToExist", "note", "absent", "none"),
        rule("ColumnValuesToBeOfType", "o_orderkey", "long", type="LongType"))


def _report_columns(report: DataFrame) -> DataFrame:
    return report.select("rule_id", "element_count", "missing_count", "unexpected_count",
                         F.round("unexpected_percent", 4).alias("unexpected_percent"), "success", "on_failure")


@query(REPORT_SQL)
def quality_report_all_scopes(spark, sf):
    return _report_columns(quality_report(graded_orders(spark, sf), priority_suite()))


@query(f"select rule_id, unexpected_count from ({REPORT_SQL}) f where not success")
def failed_rules_log(spark, sf):
    return failures(quality_report(graded_orders(spark, sf), priority_suite())).select(
        "rule_id", "unexpected_count")


@query("select * from (select 'customer' as feed, count(*) filter (where length(c_mktsegment) not between 8 and 10)"
       " = 0 as success from customer union all select 'orders', count(*) = count(pri) from " + P + ") v")
def suite_verdict(spark, sf):
    segments = suite(rule("ColumnValueLengthsToBeBetween", "c_mktsegment", min_value=8, max_value=10),
                     rule("ColumnValuesToBeOfType", "c_custkey", type="bigint"))
    customers = verdict(quality_report(table(spark, sf, "customer"), segments))
    orders = verdict(quality_report(graded_orders(spark, sf), suite(rule("ColumnValuesToNotBeNull", "pri"))))
    return (customers.select(F.lit("customer").alias("feed"), "success")
            .unionByName(orders.select(F.lit("orders").alias("feed"), "success")))


@query(f"select * from ({REPORT_SQL}) r where rule_id in ('filled', 'len', 'set', 'there')")
def quality_report_in_flight(spark, sf):
    """The counts are taken while the rows are being written."""
    rules = suite(rule("ColumnValuesToNotBeNull", "pri", "filled"),
                  rule("ColumnValueLengthsToEqual", "pri", "len", value=6),
                  rule("ColumnValuesToBeInSet", "pri", "set", "none", value_set=["2-HIGH", "3-MEDIUM"], mostly=0.4),
                  rule("ColumnToExist", "pri", "there", "none"))
    observed = observe_rules(graded_orders(spark, sf), rules)
    write_connector(clean(observed.df, rules).kept, "noop", {}, "overwrite")
    return _report_columns(observed.report())


@query(f"select o_orderkey, pri from {P} where pri not in ('5-LOW', '2-HIGH')")
def discard_by_value(spark, sf):
    rules = suite(rule("ColumnValuesToMatchRegex", "pri", regex="^[34]"))
    return clean(graded_orders(spark, sf), rules, mode="by_value").kept.select("o_orderkey", "pri")


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_extendedprice > 20000")
def discard_by_value_many(spark, sf):
    """Tens of thousands of failing values, and none survives."""
    rules = suite(rule("ColumnValuesToBeBetween", "l_extendedprice", min=20000.01, max=None))
    return clean(table(spark, sf, "lineitem"), rules, mode="by_value").kept.select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


@query("select event_id from (select event_id, count(*) over (partition by date_trunc('second', ts), round(value)) as k"
       " from events) e where k = 1")
def rule_unique_struct(spark, sf):
    """Unique on a struct of a time and a number."""
    second = F.date_trunc("second", "ts").alias("ts")
    events = table(spark, sf, "events").select("event_id", F.struct(second, F.round("value").alias("value")).alias("seen"))
    return clean(events, suite(rule("ColumnValuesToBeUnique", "seen"))).kept.select("event_id")


@query("select event_id, seen_at from (select event_id, ts as seen_at, count(*) over (partition by ts, value) as k from events) e"
       " where k = 1")
def rule_unique_struct_micros(spark, sf):
    """Times that differ in microseconds are different values."""
    events = table(spark, sf, "events").select("event_id", F.struct("ts", "value").alias("seen"))
    return clean(events, suite(rule("ColumnValuesToBeUnique", "seen"))).kept.select(
        "event_id", F.col("seen.ts").alias("seen_at"))


@query("select p_partkey, price from (select p_partkey, case when p_size = 1 then 'none' else"
       " cast(p_retailprice as varchar) end as price, p_size, p_retailprice from part) t"
       " where p_size <> 1 and p_retailprice between 920 and 980")
def rule_between_text(spark, sf):
    """Prices kept as text; what is no number is out of bounds."""
    price = F.when(F.col("p_size") == 1, "none").otherwise(F.col("p_retailprice").cast("string")).alias("price")
    parts = table(spark, sf, "part").select("p_partkey", price)
    return clean(parts, suite(rule("ColumnValuesToBeBetween", "price", min=920, max=980))).kept


@query("select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey % 3 <> 0 and l_partkey <= 30000")
def rule_in_set_large(spark, sf):
    """Twenty thousand members."""
    members = [k for k in range(1, 30_001) if k % 3]
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return clean(lines, suite(rule("ColumnValuesToBeInSet", "l_partkey", value_set=members))).kept


@query("select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey in"
       " (select p_partkey from part where p_size <= 25)")
def rule_in_set_table(spark, sf):
    """The members are a table's column, of which a third or so of the lines is no member."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    members = table(spark, sf, "part").where(F.col("p_size") <= 25).select("p_partkey")
    return clean(lines, suite(rule("ColumnValuesToBeInSet", "l_partkey", value_set=members))).kept


@query("select o_orderkey, case when o_custkey % 2 = 0 then null else o_custkey end as customer from orders"
       " where o_custkey % 2 = 0 or o_custkey in (select s_suppkey from supplier)")
def rule_in_set_stored(spark, sf):
    """The members are a column of a stored table, named by its path; half of the rows have no value and stay."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 2 != 0, F.col("o_custkey")).alias("customer"))
    members = {"path": f"{sf}/supplier.parquet", "column": "s_suppkey"}
    return clean(orders, suite(rule("ColumnValuesToBeInSet", "customer", value_set=members))).kept


@query("select o_orderkey, concat_ws(',', case when pri is null then 'filled' end,"
       f" case when length(pri) <> 6 then 'len' end) as failed_rules from {P} where pri is null or length(pri) <> 6")
def quarantine_split(spark, sf):
    rules = suite(rule("ColumnValuesToNotBeNull", "pri", "filled"),
                  rule("ColumnValueLengthsToEqual", "pri", "len", value=6))
    rejected = clean(graded_orders(spark, sf), rules).rejected
    return rejected.select("o_orderkey", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("select doc_id, concat_ws(',', case when length(text) > 2000 then 'long' end,"
       " case when k > 1 then 'copies' end) as failed_rules"
       " from (select doc_id, text, count(*) over (partition by text) as k from documents) d")
def quarantine_flagged(spark, sf):
    """Accepted and rejected rows in one pass; a copy whose twin another rule removes is still a copy."""
    rules = suite(rule("ColumnValueLengthsToBeBetween", "text", "long", min_value=None, max_value=2000),
                  rule("ColumnValuesToBeUnique", "text", "copies"))
    flagged = clean(table(spark, sf, "documents"), rules).flagged
    return flagged.select("doc_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query(f"select o_orderkey, o_custkey from {P}")
def discard_column(spark, sf):
    rules = suite(rule("ColumnValuesToNotBeNull", "pri", action="column"),
                  rule("ColumnValuesToNotBeNull", "o_custkey", action="column"))
    return clean(graded_orders(spark, sf), rules).kept


@query("select rule_id, value, count from (select rule_id, value, count(*) as count, row_number() over"
       " (partition by rule_id order by count(*) desc, value nulls first) as rn from ("
       f" select 'len' as rule_id, pri as value from {P} where length(pri) <> 6"
       f" union all select 'filled', pri from {P} where pri is null) v group by rule_id, value) x where rn <= 2")
def failing_value_sample(spark, sf):
    rules = suite(rule("ColumnValueLengthsToEqual", "pri", "len", value=6),
                  rule("ColumnValuesToNotBeNull", "pri", "filled"))
    return failing_values(graded_orders(spark, sf), rules, n=2)


@query("select 'copies' as rule_id, p_name as value, count(*) as count from part group by p_name"
       " having count(*) > 1 order by count desc, value limit 20")
def failing_value_sample_unique(spark, sf):
    return failing_values(table(spark, sf, "part"), suite(rule("ColumnValuesToBeUnique", "p_name", "copies")), n=20)


@query("select 'long' as rule_id, text as value, count(*) as count from documents where length(text) > 2000 group by text"
       " union all select 'copies', text, count(*) from documents group by text having count(*) > 1")
def failing_values_complete(spark, sf):
    """Every failing value with its count; whole texts come back."""
    rules = suite(rule("ColumnValueLengthsToBeBetween", "text", "long", min_value=None, max_value=2000),
                  rule("ColumnValuesToBeUnique", "text", "copies"))
    return failing_values(table(spark, sf, "documents"), rules)


# --- projections, filters, aggregates ------------------------------------------------------


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F'")
def filter_not_equal(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus")


@query(f"select o_orderkey from {P} where pri is null")
def filter_is_null(spark, sf):
    return graded_orders(spark, sf).where(F.col("pri").isNull()).select("o_orderkey")


@query(f"select o_orderkey from {P} where pri is not null")
def filter_is_not_null(spark, sf):
    return graded_orders(spark, sf).where(F.col("pri").isNotNull()).select("o_orderkey")


@query("select l_returnflag, sum(l_quantity) as l_quantity_sum, avg(l_quantity) as l_quantity_avg,"
       " min(l_extendedprice) as l_extendedprice_min, max(l_extendedprice) as l_extendedprice_max,"
       " count(l_quantity) as l_quantity_count from lineitem group by l_returnflag")
def agg_all_functions(spark, sf):
    return group_agg(table(spark, sf, "lineitem"), "l_returnflag", sum="l_quantity", avg="l_quantity",
                     min="l_extendedprice", max="l_extendedprice", count="l_quantity", naming="suffix")


@query("select l_returnflag, l_linestatus, sum(l_quantity) as l_quantity from lineitem"
       " group by l_returnflag, l_linestatus")
def agg_multi_key(spark, sf):
    return group_agg(table(spark, sf, "lineitem"), "l_returnflag,l_linestatus", sum="l_quantity")


@query("select lower(l_returnflag) as flag, l_linestatus, sum(l_quantity) as l_quantity from lineitem"
       " group by lower(l_returnflag), l_linestatus")
def agg_expression_and_column_key(spark, sf):
    totals_ = group_agg(table(spark, sf, "lineitem"), "lower(l_returnflag), l_linestatus", sum="l_quantity")
    return totals_.toDF("flag", "l_linestatus", "l_quantity")


@query("select l_suppkey, cast(sum(l_linenumber) as bigint) as l_linenumber, sum(l_quantity) as l_quantity,"
       " max(l_tax) as l_tax, max(l_discount) as l_discount from lineitem group by l_suppkey")
def agg_several_columns(spark, sf):
    return group_agg(table(spark, sf, "lineitem"), "l_suppkey", sum="l_linenumber,l_quantity",
                     max=["l_tax", "l_discount"])


@query(f"select o_custkey, count(pri) as pri from {P} group by o_custkey")
def agg_count_skips_nulls(spark, sf):
    return group_agg(graded_orders(spark, sf), "o_custkey", count="pri")


@query(f"select pri, count(o_orderkey) as o_orderkey from {P} group by pri")
def agg_null_key(spark, sf):
    return group_agg(graded_orders(spark, sf), "pri", count="o_orderkey")


@query("select p_brand, p_type from part group by p_brand, p_type")
def agg_keys_only(spark, sf):
    return group_agg(table(spark, sf, "part"), "p_brand,p_type")


@query("select upper(source) as source, max(n_chars) as n_chars from documents group by upper(source)")
def agg_expression_key(spark, sf):
    grouped = group_agg(table(spark, sf, "documents"), "upper(source)", max="n_chars")
    return grouped.withColumnRenamed("upper(source)", "source")


USERS_SQL = """(select c_custkey as user_key, c_name as user_id, n_name as city, r_name as state
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def user_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as users: id, name, and an address struct made of nation and region."""
    places = join_tables(table(spark, sf, "nation"), table(spark, sf, "region"), [("n_regionkey", "r_regionkey")])
    users = join_tables(table(spark, sf, "customer"), places, [("c_nationkey", "n_nationkey")])
    return users.select(
        F.col("c_custkey").alias("user_key"), F.col("c_name").alias("user_id"), F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("user_phno"),
        F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("state")).alias("user_address"))


@query(f"select city, state, count(user_id) as user_id from {USERS_SQL} u group by city, state")
def agg_struct_key(spark, sf):
    grouped = group_agg(user_feed(spark, sf), "user_address", count="user_id")
    return grouped.select("user_address.city", "user_address.state", "user_id")


@query(f"select state, count(user_id) as user_id from {USERS_SQL} u group by state")
def agg_struct_field_key(spark, sf):
    return group_agg(user_feed(spark, sf), "user_address.state", count="user_id")


@query("select text_number as k, sum(try_cast(text_number as double)) as total from (select c_nationkey as nation,"
       " case when c_mktsegment = 'BUILDING' then 'n/a' else cast(c_nationkey as varchar) end as text_number"
       " from customer) c group by text_number")
def agg_sum_of_text_numbers(spark, sf):
    """Numbers kept as text: what is not a number adds nothing."""
    numbers = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("k"))
    return group_agg(numbers.withColumn("total", F.col("k")), "k", sum="total")


# --- joins -----------------------------------------------------------------------------------


LINES_SQL = ("(select nullif(l_linenumber, 7) as line, case when l_linenumber = 7 then null else l_orderkey end"
             " as l_orderkey, l_quantity from lineitem) l")


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of which one in seven has lost its order key, as one large group of nulls."""
    return table(spark, sf, "lineitem").select(
        nullif("l_linenumber", 7).alias("line"),
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("l_orderkey"), "l_quantity")


def _lines_and_orders(spark: SparkSession, sf: str, how: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return join_tables(order_lines(spark, sf), orders, [("l_orderkey", "o_orderkey")], how)


def _join_sql(how: str) -> str:
    return ("select line, l_orderkey, l_quantity, o_orderkey, o_custkey from " + LINES_SQL +
            f" {how} join orders on l_orderkey = o_orderkey")


@query(_join_sql("inner"))
def join_inner(spark, sf):
    return _lines_and_orders(spark, sf, "inner")


@query(_join_sql("left"))
def join_left(spark, sf):
    return _lines_and_orders(spark, sf, "left outer")


@query(_join_sql("right"))
def join_right(spark, sf):
    return _lines_and_orders(spark, sf, "right")


@query(_join_sql("full"))
def join_full(spark, sf):
    return _lines_and_orders(spark, sf, "full outer")


@query(_join_sql("full"))
def join_full_split(spark, sf):
    """The same result put together from joins whose hot groups can be split."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return join_tables(order_lines(spark, sf), orders, [("l_orderkey", "o_orderkey")], "full", hot_key_rows=0)


@query(_join_sql("inner"))
def join_default_type(spark, sf):
    return _lines_and_orders(spark, sf, "")


@query("select n_name, r_name from nation cross join region where n_regionkey = r_regionkey")
def join_cross_with_condition(spark, sf):
    joined = join_tables(table(spark, sf, "nation"), table(spark, sf, "region"),
                         "leftView.n_regionkey = rightView.r_regionkey", "cross")
    return joined.select("n_name", "r_name")


@query("select l_orderkey, l_linenumber, l_partkey, o_custkey from lineitem join orders"
       " on l_orderkey = o_orderkey and l_shipdate < o_orderdate")
def join_theta(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    joined = join_tables(lines, table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
                         "leftView.l_orderkey = rightView.o_orderkey and leftView.l_shipdate < rightView.o_orderdate")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query("select l_orderkey, l_linenumber, o_custkey from lineitem left join orders"
       " on l_orderkey = o_orderkey and l_shipdate < o_orderdate")
def join_theta_left(spark, sf):
    return _theta(spark, sf, "left")


@query("select l_orderkey, l_linenumber, o_custkey from lineitem full join orders"
       " on l_orderkey = o_orderkey and l_shipdate < o_orderdate")
def join_theta_full(spark, sf):
    """Put together from joins that can be split, as with a key that is too big for one task."""
    return _theta(spark, sf, "full", hot_key_rows=0)


def _theta(spark: SparkSession, sf: str, how: str, **options: Any) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = join_tables(lines, orders, [("l_orderkey", "o_orderkey")], how,
                         where="leftView.l_shipdate < rightView.o_orderdate", **options)
    return joined.select("l_orderkey", "l_linenumber", "o_custkey")


def since_new_year() -> Column:
    """Seconds from the start of 2024, whatever the time zone of the session."""
    return F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) / 1000000D")


@query("select event_id, c_custkey from events join"
       " (select c_custkey, 0.0::double + c_custkey * 61 as start from customer) w"
       " on (epoch_us(ts) - 1704067200000000) / 1000000.0::double >= start"
       " and (epoch_us(ts) - 1704067200000000) / 1000000.0::double < start + (c_custkey % 5) * (c_custkey % 900)")
def join_range_events(spark, sf):
    """Events in windows of mixed length, one for each customer, some of no length."""
    moments = table(spark, sf, "events").select("event_id", since_new_year().alias("at"))
    key = F.col("c_custkey")
    windows = table(spark, sf, "customer").select("c_custkey", (key * 61.0).alias("start"))
    windows = windows.withColumn("stop", F.col("start") + (key % 5) * (key % 900))
    return join_range(moments, windows, "at", "start", "stop", closed="left").select("event_id", "c_custkey")


@query("select event_id, c_custkey from events join customer"
       " on (epoch_us(ts) - 1704067200000000) / 1000000.0::double >= 0.0::double + c_custkey * 100000")
def join_range_open(spark, sf):
    """Windows without an end."""
    moments = table(spark, sf, "events").select("event_id", since_new_year().alias("at"))
    windows = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") * 100000.0).alias("start"),
                                                  F.lit(float("inf")).alias("stop"))
    return join_range(moments, windows, "at", "start", "stop", closed="left").select("event_id", "c_custkey")


@query("select p_partkey, p_size, r_regionkey from part join region"
       " on p_size > r_regionkey * 10 and p_size <= r_regionkey * 10 + 10")
def join_range_bands(spark, sf):
    bands = table(spark, sf, "region").select(
        "r_regionkey", (F.col("r_regionkey") * 10).alias("low"), (F.col("r_regionkey") * 10 + 10).alias("high"))
    joined = join_range(table(spark, sf, "part").select("p_partkey", "p_size"), bands, "p_size", "low", "high")
    return joined.select("p_partkey", "p_size", "r_regionkey")


MINUTES_SQL = "(epoch_us(ts) - 1704067200000000) / 60000000.0::double"
SHIFTS_SQL = ("(select c_custkey, c_nationkey, 0.0::double + c_custkey * 90 as start, 0.0::double + c_custkey * 90 + (c_custkey % 7) * 12"
              " as stop from customer)")


def _moments_and_shifts(spark: SparkSession, sf: str, how: str) -> DataFrame:
    """Events and the shifts of customers that they fall into, if the last digits of event and nation differ."""
    moments = table(spark, sf, "events").select("event_id", (since_new_year() / 60.0).alias("at"))
    key = F.col("c_custkey")
    shifts = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", (key * 90.0).alias("start"), (key * 90.0 + (key % 7) * 12).alias("stop"))
    return join_range(moments, shifts, "at", "start", "stop", closed="left", how=how,
                      where="leftView.event_id % 10 <> rightView.c_nationkey % 10")


def _shifts_sql(columns: str, how: str) -> str:
    return (f"select {columns} from (select event_id, {MINUTES_SQL} as minute from events) e {how} join {SHIFTS_SQL} s"
            " on minute >= start and minute < stop and event_id % 10 <> c_nationkey % 10")


@query(_shifts_sql("event_id, c_custkey", "left"))
def join_range_left(spark, sf):
    return _moments_and_shifts(spark, sf, "left").select("event_id", "c_custkey")


@query(_shifts_sql("event_id, c_custkey", "full"))
def join_range_full(spark, sf):
    return _moments_and_shifts(spark, sf, "full").select("event_id", "c_custkey")


@query("select event_id from (" + _shifts_sql("event_id, c_custkey", "left") + ") x where c_custkey is null")
def join_range_anti(spark, sf):
    return _moments_and_shifts(spark, sf, "left anti").select("event_id")


@query(f"select event_id from events where {MINUTES_SQL} < (select max(0.0::double + o_custkey * 20) from orders where o_orderstatus = 'P')")
def join_range_one_bound_semi(spark, sf):
    """Events before the end of some window that has no beginning; no pair is formed."""
    moments = table(spark, sf, "events").select("event_id", (since_new_year() / 60.0).alias("at"))
    ends = table(spark, sf, "orders").where("o_orderstatus = 'P'").select((F.col("o_custkey") * 20.0).alias("stop"))
    return join_range(moments, ends, "at", None, "stop", closed="left", how="semi").select("event_id")


@query("with l as (select nullif(l_returnflag, 'A') as flag, sum(l_quantity) as qty from lineitem group by 1),"
       " o as (select nullif(o_orderstatus, 'F') as status, count(*) as orders from orders group by 1)"
       " select flag, status, qty, orders from l join o on"
       " case flag when 'N' then 'O' when 'R' then 'P' end is not distinct from status")
def join_null_safe(spark, sf):
    """Two rollups, each with a group for null, joined so that the null groups meet."""
    lines = table(spark, sf, "lineitem").select(nullif("l_returnflag", "A").alias("flag"), "l_quantity")
    left = group_agg(lines, "flag", sum="l_quantity").select(
        "flag", F.col("l_quantity").alias("qty"),
        F.when(F.col("flag") == "N", "O").when(F.col("flag") == "R", "P").alias("as_status"))
    orders = table(spark, sf, "orders").select(nullif("o_orderstatus", "F").alias("status"), "o_orderkey")
    right = group_agg(orders, "status", count="o_orderkey").withColumnRenamed("o_orderkey", "orders")
    return join_tables(left, right, [("as_status", "status")], null_safe=True).select(
        "flag", "status", "qty", "orders")


@query("select o_orderkey, o_custkey from orders where o_orderkey in (select l_orderkey from lineitem)")
def join_left_semi(spark, sf):
    return join_tables(table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                       table(spark, sf, "lineitem").select("l_orderkey"), [("o_orderkey", "l_orderkey")], "left semi")


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem"
       " where l_orderkey = o_orderkey)")
def join_left_anti(spark, sf):
    return join_tables(table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                       table(spark, sf, "lineitem").select("l_orderkey"), [("o_orderkey", "l_orderkey")], "left anti")


@query("select d.doc_id as doc_id, d.lang as lang, q.quality as quality, e.text as text_r, length(d.text) as chars"
       " from documents d join labels q on d.doc_id = q.doc_id join benchmark e on e.item_id = q.doc_id")
def join_star_both_sides(spark, sf):
    """Every column of both sides: the key once, a second ``text`` under a suffix."""
    labelled = join_tables(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
    items = table(spark, sf, "benchmark").withColumnRenamed("item_id", "doc_id")
    return join_tables(labelled, items, "doc_id").select(
        "doc_id", "lang", "quality", "text_r", F.length("text").cast("bigint").alias("chars"))


# --- sources and sinks ---------------------------------------------------------------------------


def _written(df: DataFrame, format: str, **options: str) -> str:
    path = scratch_path(df.sparkSession, f"{format}-feed")
    write_table(df, SinkSpec(format, path, options))
    return path


@query("select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem where l_quantity >= 25")
def parquet_scan(spark, sf):
    return (table(spark, sf, "lineitem").where(F.col("l_quantity") >= 25)
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') as c_mktsegment"
       " from customer")
def json_round_trip(spark, sf):
    customers = table(spark, sf, "customer").withColumn("c_mktsegment", nullif("c_mktsegment", "BUILDING"))
    source = SourceSpec(_written(customers, "json"), "json", customers.schema)
    return split_corrupt(read_table(spark, source))[0]


@query("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def csv_round_trip_parts(spark, sf):
    parts = table(spark, sf, "part")
    source = SourceSpec(_written(parts, "csv", header="true"), "csv", parts.schema)
    return split_corrupt(read_table(spark, source))[0]


@query("select doc_id, text from documents")
def csv_round_trip(spark, sf):
    """Texts with line breaks, quotes and blanks, under a record separator that no text holds."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    source = SourceSpec(_written(documents, "csv", header="true", lineSep=RECORD_SEPARATOR), "csv", documents.schema,
                        options={"lineSep": RECORD_SEPARATOR})
    return split_corrupt(read_table(spark, source))[0]


@query("select doc_id, text from documents")
def text_round_trip(spark, sf):
    """Rows as JSON lines, so a text that spans lines comes back whole."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    lines = read_table(spark, SourceSpec(_written(documents, "text"), "txt"))
    return lines.select(F.from_json("value", documents.schema.simpleString()).alias("d")).select("d.*")


@query("select s_name as value from supplier")
def text_round_trip_plain(spark, sf):
    return read_table(spark, SourceSpec(_written(table(spark, sf, "supplier").select("s_name"), "txt"), "txt"))


@query("select text as value from documents")
def text_round_trip_texts(spark, sf):
    """One row for each text, though most hold line breaks."""
    texts = table(spark, sf, "documents").select("text")
    path = _written(texts, "txt", lineSep=RECORD_SEPARATOR)
    return read_table(spark, SourceSpec(path, "txt", options={"lineSep": RECORD_SEPARATOR}))


@query("select o_custkey, count(o_orderkey) as o_orderkey from orders group by o_custkey")
def json_inferred_schema_gate(spark, sf):
    """Infer the schema, compare it with the model, then use the feed."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    path = _written(orders, "json")
    require_feed(spark, path)
    feed = read_table(spark, SourceSpec(path, "json", mode="infer"))
    model = TableModel.from_json({"schema": {"o_orderkey": {"type": "bigint"}, "o_custkey": {"type": "bigint"},
                                             "o_orderpriority": {"type": "string"}}}, "orders")
    check_schema(feed, model).require()
    return group_agg(feed, "o_custkey", count="o_orderkey")


@query("select 'lineitem' as feed, count(*) > 0 as ready from lineitem union all"
       " select 'orders', count(*) > 0 from orders union all select 'customer', count(*) > 0 from customer")
def feed_gate(spark, sf):
    """Which feeds have content, from the file listing alone."""
    names = ["lineitem", "orders", "customer"]
    listing = feed_listing(spark, [f"{sf}/{n}.parquet" for n in names])
    feed = F.regexp_extract("path", r"([^/]+)\.parquet", 1)
    return listing.groupBy(feed.alias("feed")).agg((F.sum("length") > 0).alias("ready"))


@query("select c_custkey, cast(2 as bigint) as copies from customer")
def sink_dispositions(spark, sf):
    """Overwriting replaces, ignoring leaves alone, appending adds."""
    customers = table(spark, sf, "customer").select("c_custkey")
    path = scratch_path(spark, "dispositions")
    for mode in ("errorifexists", "overwrite", "ignore", "append"):
        write_table(customers, SinkSpec("parquet", path, mode=mode))
    stored = read_table(spark, SourceSpec(path, "parquet"))
    return stored.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("copies"))


@query("select o_custkey, count(*) as orders from orders where o_orderstatus <> 'P' group by o_custkey union all"
       " select o_custkey, count(*) from orders where o_orderstatus = 'P' group by o_custkey")
def sink_runs(spark, sf):
    """Two runs append, and the first one is done again: its rows are replaced, not doubled."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "runs")
    for name, part in (("open", "o_orderstatus <> 'P'"), ("pending", "o_orderstatus = 'P'"), ("open", "o_orderstatus <> 'P'")):
        rows = group_agg(orders.where(part), "o_custkey", count="o_orderkey").withColumnRenamed("o_orderkey", "orders")
        write_table(rows, SinkSpec("parquet", path, mode="append", run_id=name))
    return read_table(spark, SourceSpec(path, "parquet")).select("o_custkey", "orders")


@query("select c_nationkey, n from (select c_nationkey, count(*) as n from customer group by c_nationkey) c"
       " union all select s_nationkey, count(*) from supplier group by s_nationkey")
def sink_catalog_table(spark, sf):
    """A table of the session's catalog: created, added to by name, its rows replaced, and added to again."""
    name = f"feedquality_{uuid.uuid4().hex}"
    customers = group_agg(table(spark, sf, "customer"), "c_nationkey", count="c_custkey").withColumnRenamed("c_custkey", "n")
    suppliers = group_agg(table(spark, sf, "supplier"), "s_nationkey", count="s_suppkey").toDF("c_nationkey", "n")
    for rows, mode, create in ((customers, "append", "create_if_needed"), (suppliers.select("n", "c_nationkey"), "append", "create_never"),
                               (customers, "overwrite", "create_never"), (suppliers, "append", "create_if_needed")):
        write_table(rows, SinkSpec("table", name, mode=mode, create_disposition=create))
    return spark.table(name)


# --- the job -----------------------------------------------------------------------------------------


PURCHASES_SQL = """(select case when o_orderstatus = 'P' then null else o_custkey end as user_id,
         case when l_linenumber = 7 then null else cast(l_quantity as bigint) end as Quantity
  from lineitem join orders on l_orderkey = o_orderkey)"""

FLAGSHIP_SQL = f"""
with g as (
  select user_id, sum(Quantity) as Quantity from {PURCHASES_SQL} p
  where user_id is not null and Quantity is not null group by user_id)
select city, state, cast(sum(Quantity) as bigint) as Quantity
from {USERS_SQL} u join g on u.user_key = g.user_id
group by city, state"""


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as purchases; pending orders have no user and seventh lines no quantity."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return join_tables(lines, orders, [("l_orderkey", "o_orderkey")]).select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("user_id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint")).alias("Quantity"),
        "o_orderdate", "l_extendedprice")


@query(FLAGSHIP_SQL)
def flagship(spark, sf):
    users = user_feed(spark, sf).select(F.col("user_key").alias("user_id"), "user_address")
    not_null = [rule("ColumnValuesToNotBeNull", c, mostly=1) for c in ("user_id", "Quantity")]
    exist = [rule("ColumnToExist", c) for c in ("user_id", "Quantity")]
    good_users = clean(users, suite(rule("ColumnToExist", "user_address"),
                                    rule("ColumnValuesToNotBeNull", "user_address"), exist[0], not_null[0])).kept
    good_purchases = clean(purchases(spark, sf).select("user_id", "Quantity"), suite(
        *exist, rule("ColumnValuesToBeOfType", "Quantity", type="LongType"), *not_null)).kept
    result = totals(good_users, good_purchases, "user_id", "Quantity", "user_address")
    return result.select("user_address.city", "user_address.state", "Quantity")


@query(f"select user_id, cast(sum(Quantity) as bigint) as Quantity from {PURCHASES_SQL} p group by user_id")
def rollup_per_user(spark, sf):
    """The first level of the rollup; the null group is a third of all rows."""
    return group_agg(purchases(spark, sf), "user_id", sum="Quantity")


# The two models and suites of the job.
USER_MODEL = {"schema": {
    "user_id": {"type": "string", "required": "true"},
    "user_name": {"type": "string", "required": "true"},
    "user_phno": {"type": "string", "required": "false"},
    "user_address": {"type": "struct<city:string,state:string>", "required": "true",
                     "city": {"type": "string", "required": "true"},
                     "state": {"type": "string", "required": "true"}}}}
PURCHASE_MODEL = {"schema": {
    "Date": {"type": "string", "required": "true"},
    "user_id": {"type": "string", "required": "true"},
    "Product_Name": {"type": "string", "required": "true"},
    "Quantity": {"type": "bigint", "required": "true"},
    "Unit_Price": {"type": "string", "required": "true"},
    "Total_Sale_Amount": {"type": "string", "required": "true"}}}


def _entries(*rules: Mapping[str, Any]) -> dict[str, Any]:
    return {"expectation_suite_name": "suite", "expectations": list(rules)}


def user_suite(id_length: int) -> RuleSet:
    return suite(rule("ColumnToExist", "user_address"), rule("ColumnToExist", "user_id"),
                 rule("ColumnValuesToNotBeNull", "user_address", mostly=1),
                 rule("ColumnValuesToNotBeNull", "user_id", mostly=1),
                 rule("ColumnValueLengthsToEqual", "user_id", value=id_length))


def purchase_suite(id_length: int) -> RuleSet:
    return suite(rule("ColumnToExist", "user_id"), rule("ColumnToExist", "Quantity"),
                 rule("ColumnValuesToBeOfType", "Quantity", type="LongType"),
                 rule("ColumnValuesToNotBeNull", "user_id", mostly=1),
                 rule("ColumnValuesToNotBeNull", "Quantity", mostly=1),
                 rule("ColumnValueLengthsToEqual", "user_id", value=id_length))


def _feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    users = user_feed(spark, sf).drop("user_key")
    bought = purchases(spark, sf).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("user_id"),
        F.lit("part").alias("Product_Name"), "Quantity",
        F.col("l_extendedprice").cast("string").alias("Unit_Price"),
        F.col("l_extendedprice").cast("string").alias("Total_Sale_Amount"))
    return users, bought


def _specs(paths: tuple[str, str], mode: str) -> list[FeedSpec]:
    models = TableModel.from_json(USER_MODEL, "users"), TableModel.from_json(PURCHASE_MODEL, "purchase")
    return [FeedSpec(SourceSpec(path, "json", model.schema, mode), model, rules)
            for path, model, rules in zip(paths, models, (user_suite(18), purchase_suite(18)))]


def _job(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    users, bought = _feeds(spark, sf)
    out = scratch_path(spark, "totals")
    run_job(spark, JobSpec(*_specs((_written(users, "json"), _written(bought, "json")), mode), sink=SinkSpec("json", out)))
    return _totals_read(spark, out)


def _totals_read(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromDDL("user_address struct<city:string,state:string>, Quantity bigint")
    written = read_table(spark, SourceSpec(path, "json", schema))
    return split_corrupt(written)[0].select("user_address.city", "user_address.state", "Quantity")


USER_RULES = _entries(rule("ColumnValuesToNotBeNull", "user_address", mostly=1),
                      rule("ColumnValueLengthsToEqual", "user_id", value=18))
PURCHASE_RULES = _entries(rule("ColumnValuesToNotBeNull", "user_id", mostly=1),
                          rule("ColumnValuesToNotBeNull", "Quantity", mostly=1))


@query(FLAGSHIP_SQL)
def job_from_json_feeds(spark, sf):
    """The whole job: two JSON feeds in, gates, both suites, the rollup, a JSON sink."""
    return _job(spark, sf, "declared")


@query(FLAGSHIP_SQL)
def job_from_inferred_feeds(spark, sf):
    return _job(spark, sf, "infer")


@query("select 'purchase' as feed, count(*) + (select count(*) from customer) as lines,"
       " (select count(*) from customer) as bad from lineitem")
def job_with_corrupt_lines(spark, sf):
    """A feed with a broken line for each customer: counted in the report, set aside, tolerated."""
    users, bought = _feeds(spark, sf)
    path = _written(bought, "json")
    broken = table(spark, sf, "customer").select(F.concat(F.lit("{"), "c_name").alias("value"))
    write_table(broken, SinkSpec("text", path, mode="append"))
    result = run_job(spark, JobSpec(*_specs((_written(users, "json"), path), "declared"), max_corrupt=0.9))
    return result.report.where("rule_id = 'corrupt_record'").where("feed = 'purchase'").select(
        "feed", F.col("element_count").alias("lines"), F.col("unexpected_count").alias("bad"))


@query(FLAGSHIP_SQL)
def job_from_command_line(spark, sf):
    """Feeds by position, the sink by its word, its disposition, all from a command line."""
    users, bought = _feeds(spark, sf)
    files = {}
    for name, content in (("um", USER_MODEL), ("pm", PURCHASE_MODEL), ("us", USER_RULES), ("ps", PURCHASE_RULES)):
        files[name] = scratch_path(spark, name)  # where the feeds are, for whoever runs the driver
        spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(files[name])
    out = scratch_path(spark, "totals")
    paths = [_written(df, "json") for df in (users, bought)]
    globbed = ",".join(f"{p}/*.json" for p in paths)
    _, spec = job_spec(["--input_path", globbed, "--sink", "file", "--output_path", out, "--file_format", "json",
                        "--write_disposition", "overwrite", "--models", f"{files['um']},{files['pm']}",
                        "--suites", f"{files['us']},{files['ps']}"])
    run_job(spark, spec)
    return _totals_read(spark, out)


@query(FLAGSHIP_SQL)
def job_run_twice(spark, sf):
    """The job done twice under one name, and once under another: each name has its totals once."""
    users, bought = _feeds(spark, sf)
    paths, out = (_written(users, "json"), _written(bought, "json")), scratch_path(spark, "totals")
    for name in ("monday", "monday", "tuesday"):
        run_job(spark, JobSpec(*_specs(paths, "declared"), sink=SinkSpec("json", out, mode="append", run_id=name)))
    return _totals_read(spark, f"{out}/run_id=monday")


@query("select * from (select 'good' as feed, count(*) as lines, cast(0 as bigint) as bad, '' as problems from customer"
       " union all select 'another name', count(*), 0, 'user_address.city: missing column, user_address.town: unexpected column' from customer"
       " union all select 'numbers', count(*), 0, 'user_id: type mismatch' from customer"
       " union all select 'cut', count(*), count(*) filter (where c_custkey % 10 = 0), '' from customer) f")
def gate_declared_types(spark, sf):
    """Feeds of customers at the gate of a declared model, each profiled while it is staged."""
    users, _ = _feeds(spark, sf)
    address = F.struct(F.col("user_address.city").alias("town"), F.col("user_address.state").alias("state"))
    lines = users.select(F.to_json(F.struct("*")).alias("value"), F.substring("user_id", -1, 1).alias("digit"))
    cut = lines.select(F.when(F.col("digit") == "0", F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value"))
    feeds = {"good": _written(users, "json"),
             "another name": _written(users.withColumn("user_address", address), "json"),
             "numbers": _written(users.withColumn("user_id", F.length("user_id")), "json"), "cut": _written(cut, "text")}
    model, rows = TableModel.from_json(USER_MODEL, "users"), []
    for name, path in feeds.items():
        feed = stage_feed(spark, SourceSpec(path, "json", model.schema), model, user_suite(18))
        found = ", ".join(sorted(f"{p.column}: {p.problem}" for p in feed.gate.problems))
        rows.append((name, feed.lines, feed.bad, found))
    return spark.createDataFrame(rows, "feed string, lines bigint, bad bigint, problems string")


@query("select 'orders' as feed, count(*) as rows_ok from orders union all select 'lineitem', count(*) from lineitem")
def schema_gate_tables(spark, sf):
    """Both tables must fit their models before either is used."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    check_tables([
        (orders, TableModel.from_json({"schema": {"o_orderkey": {"type": "bigint"},
                                                  "o_custkey": {"type": "LongType"}}}, "orders")),
        (lines, TableModel.from_json({"schema": {"l_quantity": {"type": "double"},
                                                 "l_orderkey": {"type": "bigint"}}}, "lineitem"))]).require()
    return (orders.agg(F.count(F.lit(1)).alias("rows_ok")).select(F.lit("orders").alias("feed"), "rows_ok")
            .unionByName(lines.agg(F.count(F.lit(1)).alias("rows_ok")).select(F.lit("lineitem").alias("feed"),
                                                                           "rows_ok")))
