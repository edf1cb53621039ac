from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from feedquality import ConfigError, join_range, join_tables, totals
from feedquality.operators.joins import NARROWER, NO_LENGTH, _matched_words, cell_widths, has_hot_key, join_type

LEFT = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")]
RIGHT = [(1, 10), (1, 11), (3, 30), (None, 40), (4, 50)]


@pytest.fixture(scope="module")
def pair(spark):
    return (spark.createDataFrame(LEFT, "k int, v string"), spark.createDataFrame(RIGHT, "k int, w int"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute(how, null_safe=False):
    def eq(a, b):
        return a == b if null_safe else a is not None and a == b
    out = [(a[0], a[1], b[1]) for a in LEFT for b in RIGHT if eq(a[0], b[0])]
    if how in ("left", "full"):
        out += [(a[0], a[1], None) for a in LEFT if not any(eq(a[0], b[0]) for b in RIGHT)]
    if how in ("right", "full"):
        out += [(b[0], None, b[1]) for b in RIGHT if not any(eq(a[0], b[0]) for a in LEFT)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [None, 0, 5_000_000])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_shared_key(pair, how, null_safe, hot):
    df = join_tables(*pair, "k", how, null_safe=null_safe, hot_key_rows=hot)
    assert df.columns == ["k", "v", "w"]
    assert rows(df) == brute(how, null_safe)


@pytest.mark.parametrize("hot", [None, 0])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_keys_of_different_names(pair, how, hot):
    left, right = pair
    df = join_tables(left, right.withColumnRenamed("k", "key"), [("k", "key")], how, hot_key_rows=hot)
    assert df.columns == ["k", "v", "key", "w"]
    assert rows(df.select(F.coalesce("k", "key"), "v", "w")) == brute(how)


def test_condition_text_names_the_sides(pair):
    df = join_tables(*pair, "leftView.k = rightView.k", "inner")
    assert df.columns == ["k", "v", "k_r", "w"]
    assert rows(df.drop("k_r")) == brute("inner")


def test_cross_with_condition_is_inner(pair):
    assert rows(join_tables(*pair, "leftView.k = rightView.k", "cross").drop("k_r")) == brute("inner")


def test_theta_condition_as_column(pair):
    left, right = pair
    df = join_tables(left, right.withColumnRenamed("k", "key"),
                     (F.col("k") == F.col("key")) & (F.col("w") > 10), "left")
    assert rows(df.select("k", "v", "w")) == sorted(
        [(1, "a", 11), (1, "b", 11), (4, "e", 50), (2, "c", None), (None, "d", None)], key=repr)


@pytest.mark.parametrize("hot", [None, 0, 5_000_000])
@pytest.mark.parametrize("null_safe", [False, True])
def test_semi_and_anti(pair, null_safe, hot):
    d = [(None, "d")]
    semi, anti = [(1, "a"), (1, "b"), (4, "e")], [(2, "c")]
    options = {"null_safe": null_safe, "hot_key_rows": hot}
    assert rows(join_tables(*pair, "k", "left semi", **options)) == semi + (d if null_safe else [])
    assert rows(join_tables(*pair, "k", "left_anti", **options)) == anti + ([] if null_safe else d)


def test_clashing_columns_get_suffixes(spark):
    left = spark.createDataFrame([(1, "l", 5)], "k int, v string, n int")
    right = spark.createDataFrame([(1, "r")], "k int, v string")
    assert join_tables(left, right, "k").columns == ["k", "v", "n", "v_r"]
    assert join_tables(left, right, "k", suffixes=("_a", "_b")).columns == ["k", "v_a", "n", "v_b"]
    with pytest.raises(ConfigError):
        join_tables(left, right, "k", suffixes=("", ""))


def test_joining_twice_in_one_session_and_a_table_with_itself(pair):
    left, _ = pair
    again = join_tables(join_tables(*pair, "k"), pair[1], "k")
    assert again.columns == ["k", "v", "w", "w_r"] and again.count() == 9
    assert join_tables(left, left, "k").count() == 6


def test_join_words():
    assert [join_type(h) for h in ("", None, "INNER", "left outer", "LEFT_OUTER", "leftouter", "right",
                                   "full outer", "outer", "left semi", "leftanti", "cross")] == [
        "inner", "inner", "inner", "left", "left", "left", "right", "full", "full", "left_semi", "left_anti", "inner"]
    with pytest.raises(ConfigError):
        join_type("sideways")


def test_a_key_is_needed(pair):
    with pytest.raises(ConfigError):
        join_tables(*pair, [])


def test_names_that_need_quotes(spark):
    left = spark.createDataFrame([(1, 2)], ["a.b", "x y"])
    right = spark.createDataFrame([(1, 3)], ["a.b", "x y"])
    df = join_tables(left, right, "a.b")
    assert df.columns == ["a.b", "x y", "x y_r"] and rows(df) == [(1, 2, 3)]


@pytest.fixture()
def small_splits(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_group_is_measured_on_the_side_that_cannot_be_split(spark, small_splits):
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(None, i) for i in range(200)], "k int, w int")
    few = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")

    def split(df):
        return "Union" in df._jdf.queryExecution().optimizedPlan().toString()

    assert split(join_tables(few, many, "k", "left", hot_key_rows=49))
    assert not split(join_tables(few, many, "k", "left", hot_key_rows=50))     # nulls never match
    assert not split(join_tables(many, few, "k", "left", hot_key_rows=49))
    assert split(join_tables(many, few, "k", "full", hot_key_rows=199))        # but they are kept here
    assert not split(join_tables(few, many, "k", "inner", hot_key_rows=0))


def hot_table(spark, n, pad, hot="7"):
    key = F.when(F.col("id") % 3 == 0, F.expr(hot)).otherwise(F.col("id") % 1000)
    return spark.range(0, n, numPartitions=8).select(key.alias("k"), F.uuid().alias(pad))


def split_joins(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("skew=true")


def test_adaptive_execution_splits_a_hot_inner_join(spark, small_splits):
    df = join_tables(hot_table(spark, 60_000, "a"), spark.range(1000).withColumnRenamed("id", "k"), "k")
    assert df.count() == 60_000 and split_joins(df) == 1


@pytest.mark.parametrize("how, left, right, joins", [
    ("left", 200, 60_000, 1),       # inner; the left rows without a match are few
    ("right", 60_000, 200, 1),
    ("full", 60_000, 200, 1),       # left outer
    ("full", 200, 60_000, 1),       # right outer
])
def test_outer_joins_with_a_hot_key_are_split(spark, small_splits, how, left, right, joins):
    def side(n, pad):
        return hot_table(spark, n, pad) if n > 1000 else spark.range(900, 900 + n).select(
            F.when(F.col("id") == 900, 7).otherwise(F.col("id")).alias("k"), F.lit("x").alias(pad))
    tables = side(left, "a"), side(right, "b")
    plain = join_tables(*tables, "k", how, hot_key_rows=None)
    df = join_tables(*tables, "k", how, hot_key_rows=10_000)
    assert split_joins(df) >= joins
    assert df.groupBy("k").count().exceptAll(plain.groupBy("k").count()).isEmpty()
    assert df.count() == plain.count()


def test_totals_split_a_dimension_with_a_hot_key(spark, small_splits):
    users = hot_table(spark, 60_000, "pad").withColumn("place", F.col("k") % 5)
    facts = spark.range(2000).selectExpr("id % 1000 as k", "id as q")
    df = totals(users, facts, "k", "q", "place")
    assert split_joins(df) == 1
    few = totals(users, facts, "k", "q", "place", dimension_rows=100)
    assert split_joins(few) == 0
    assert sorted(df.collect()) == sorted(few.collect())


def test_null_rows_that_meet_a_hot_key_are_split_too(spark, small_splits):
    """Both sides are hot: one with nulls, which the result keeps, one with a key."""
    left, right = hot_table(spark, 60_000, "a", "null"), hot_table(spark, 60_000, "b")
    right = right.where("k = 7 or k > 990")
    for how, joins in (("left", 2), ("full", 2), ("left anti", 1)):
        df = join_tables(left, right, "k", how, hot_key_rows=10_000)
        assert split_joins(df) >= joins
        plain = join_tables(left, right, "k", how, hot_key_rows=None)
        assert df.groupBy("k").count().exceptAll(plain.groupBy("k").count()).isEmpty()
        assert df.count() == plain.count()


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
def test_range_join_against_brute_force(spark, closed):
    r = random.Random(closed)
    points = [(i, r.choice([r.randint(-50, 50), r.uniform(-5, 5), None])) for i in range(120)]
    points = [(i, None if p is None else float(p)) for i, p in points]
    bounds = []
    for i in range(60):
        a = float(r.randint(-60, 60))
        bounds.append((i, a, a + r.choice([0.0, 0.001, 0.5, 1.0, 3.0, 64.0, 1000.0, -2.0])))
    bounds.append((99, None, 3.0))
    left = spark.createDataFrame(points, "id int, p double")
    right = spark.createDataFrame(bounds, "id int, lo double, hi double")
    found = join_range(left, right, "p", "lo", "hi", closed=closed)
    assert found.columns == ["id", "p", "id_r", "lo", "hi"]

    def inside(p, a, b):
        if p is None or a is None:
            return False
        return (p >= a if closed in ("left", "both") else p > a) and (p <= b if closed in ("right", "both") else p < b)
    expected = sorted((i, j) for i, p in points for j, a, b in bounds if inside(p, a, b))
    assert sorted((r["id"], r["id_r"]) for r in found.collect()) == expected
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_range_join_on_large_integers_and_timestamps(spark):
    left = spark.sql("select 9007199254740993 as p union all select 9007199254740992")
    right = spark.sql("select 9007199254740992 as lo, 9007199254740993 as hi")
    assert [r["p"] for r in join_range(left, right, "p", "lo", "hi").collect()] == [9007199254740993]
    left = spark.sql("select timestamp'2024-01-01 10:00:00' as t union all select timestamp'2024-01-02 00:00:00'")
    right = spark.sql("select timestamp'2024-01-01 00:00:00' as lo, timestamp'2024-01-02 00:00:00' as hi")
    assert join_range(left, right, "t", "lo", "hi", closed="left").count() == 1
    assert join_range(left, right.where("lo > hi"), "t", "lo", "hi").isEmpty()
    with pytest.raises(ConfigError):
        join_range(left, right, "t", "lo", "hi", closed="maybe")


@pytest.mark.parametrize("hot", [None, 0, 5_000_000])
@pytest.mark.parametrize("how", ["left", "right", "full", "inner", "semi"])
def test_names_that_differ_in_case_only(spark, small_splits, how, hot):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k int, Date string")
    right = spark.createDataFrame([(1, "z"), (3, "w")], "k int, date string")
    df = join_tables(left, right, "k", how, hot_key_rows=hot)
    assert df.columns == (["k", "Date"] if how == "semi" else ["k", "Date", "date_r"])
    assert len(df.collect()) == {"left": 2, "right": 2, "full": 3, "inner": 1, "semi": 1}[how]


@pytest.mark.parametrize("hot", [None, 0, 5_000_000])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left semi", "left anti"])
def test_a_further_condition_on_pairs(spark, small_splits, how, hot):
    left, right = spark.createDataFrame(LEFT, "k int, v string"), spark.createDataFrame(RIGHT, "k int, w int")
    df = join_tables(left, right, "k", how, hot_key_rows=hot, where="rightView.w > 10 and leftView.v <> 'e'")
    pairs = [(a, b) for a in LEFT for b in RIGHT if a[0] is not None and a[0] == b[0] and b[1] > 10 and a[1] != "e"]
    lone_l = [a for a in LEFT if a not in [p[0] for p in pairs]]
    lone_r = [b for b in RIGHT if b not in [p[1] for p in pairs]]
    expected = [(a[0], a[1], b[1]) for a, b in pairs]
    expected += [(*a, None) for a in lone_l] * (how in ("left", "full")) + [(b[0], None, b[1]) for b in lone_r] * (how in ("right", "full"))
    if how == "left semi":
        expected = [a for a in LEFT if a not in lone_l]
    if how == "left anti":
        expected = lone_l
    assert rows(df) == sorted(expected, key=repr)


def test_a_comparison_of_all_pairs_is_refused(pair):
    with pytest.raises(ConfigError, match="join_range"):
        join_tables(*pair, "leftView.k < rightView.k")
    with pytest.raises(ConfigError):
        join_tables(*pair, "leftView.k < rightView.k", "cross")


def test_a_hot_key_among_very_many_is_found(spark):
    df = spark.range(400_000).selectExpr("if(id < 21, -1, id) as k")
    assert has_hot_key(df, ["k"], 20) and not has_hot_key(df, ["k"], 21)
    nulls = spark.range(1000).selectExpr("if(id < 500, null, id) as k")
    assert not has_hot_key(nulls, ["k"], 20) and has_hot_key(nulls, ["k"], 20, count_nulls=True)


def test_a_small_side_is_not_measured(spark):
    many, few = spark.range(1000).selectExpr("1 as k"), spark.range(3).selectExpr("id as k")
    text = join_tables(few, many, "k", "left", hot_key_rows=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in text


def test_range_join_with_infinite_ends_and_points(spark):
    inf = float("inf")
    points = [(i, p) for i, p in enumerate([-inf, -1e308, -5.0, 0.0, 49.0, 50.0, 1e17, inf, float("nan"), None])]
    bounds = [(0, 50.0, inf), (1, -inf, 0.0), (2, -inf, inf), (3, 0.0, 0.0), (4, inf, inf), (5, 3.0, float("nan")), (6, 1e300, inf)]
    left = spark.createDataFrame(points, "id int, p double")
    right = spark.createDataFrame(bounds, "id int, lo double, hi double")
    found = join_range(left, right, "p", "lo", "hi", closed="both")
    expected = sorted((i, j) for i, p in points for j, a, b in bounds if p is not None and p == p and b == b and a <= p <= b)
    assert sorted((r["id"], r["id_r"]) for r in found.collect()) == expected


def test_range_join_of_moments_has_a_cell_for_each(spark):
    start = 1_700_000_000_000_000
    left = spark.range(20_000).selectExpr(f"id as l", f"{start} + id * 1000003 as p")
    right = spark.range(20_000).selectExpr("id as r", f"{start} + id * 1000003 as lo", f"{start} + id * 1000003 as hi")
    found = join_range(left, right, "p", "lo", "hi", closed="both")
    assert found.count() == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert join_range(left.limit(0), right, "p", "lo", "hi").isEmpty()


HOWS = ["inner", "left", "right", "full", "left semi", "left anti"]


def range_rows(seed):
    r = random.Random(seed)
    points = [(i, r.choice([None, float("nan"), float(r.randint(-30, 30)), r.uniform(-4, 4)])) for i in range(60)]
    bounds = [(i, a, a + r.choice([0.0, 0.5, 3.0, 40.0, -1.0])) for i, a in enumerate(r.uniform(-40, 40) for _ in range(25))]
    return points, [*bounds, (98, None, 2.0), (99, 1.0, None)]


def brute_range(points, bounds, how, inside):
    pairs = [(a, b) for a in points for b in bounds if inside(a, b)]
    alone = [a for a in points if all(a is not p[0] for p in pairs)]
    apart = [b for b in bounds if all(b is not p[1] for p in pairs)]
    if how in ("left semi", "left anti"):
        return [a for a in points if (a in alone) == (how == "left anti")]
    return ([a + b for a, b in pairs] + [(*a, None, None, None) for a in alone] * (how in ("left", "full"))
            + [(None, None, *b) for b in apart] * (how in ("right", "full")))


@pytest.mark.parametrize("how", HOWS)
def test_range_joins_of_every_kind(spark, how):
    points, bounds = range_rows(how)
    left = spark.createDataFrame(points, "row int, p double")
    right = spark.createDataFrame(bounds, "row int, lo double, hi double")
    df = join_range(left, right, "p", "lo", "hi", closed="both", how=how, where="leftView.row % 3 <> rightView.row % 3")

    def inside(a, b):
        return None not in (a[1], b[1], b[2]) and b[1] <= a[1] <= b[2] and a[0] % 3 != b[0] % 3
    assert df.columns == (["row", "p"] if "semi" in how or "anti" in how else ["row", "p", "row_r", "lo", "hi"])
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, map(tuple, brute_range(points, bounds, how, inside))))
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("closed", ["left", "right"])
@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("only", ["lo", "hi"])
def test_range_joins_with_one_bound(spark, how, closed, only):
    points, bounds = range_rows(how + only)
    points += [(100 + i, b[1 if only == "lo" else 2]) for i, b in enumerate(bounds)]
    left = spark.createDataFrame(points, "id int, p double")
    right = spark.createDataFrame(bounds, "id int, lo double, hi double")
    df = join_range(left, right, "p", "lo" if only == "lo" else None, "hi" if only == "hi" else None, closed=closed, how=how)

    def inside(a, b):
        p, end = a[1], b[1] if only == "lo" else b[2]
        if p is None or p != p or end is None:
            return False
        return p == end and closed == ("left" if only == "lo" else "right") or (p > end if only == "lo" else p < end)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, map(tuple, brute_range(points, bounds, how, inside))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    if how in ("left semi", "left anti"):
        assert "Join" not in plan


def test_one_bound_of_other_types(spark):
    left = spark.sql("select timestamp'2024-10-27 00:30:00.123456' as t union all select null")
    right = spark.sql("select timestamp'2024-10-27 00:30:00.123456' as lo")
    assert join_range(left, right, "t", "lo", None, closed="left", how="semi").count() == 1
    assert join_range(left, right, "t", "lo", None, closed="neither", how="semi").isEmpty()
    assert join_range(left, right.limit(0), "t", "lo", None, how="anti").count() == 2
    big = spark.sql("select 9007199254740993 as p")
    assert join_range(big, spark.sql("select 9007199254740992 as lo"), "p", "lo", None, closed="neither", how="semi").count() == 1
    with pytest.raises(ConfigError, match="bound"):
        join_range(left, right, "t", None, None)


def test_matches_are_looked_for_once(spark):
    left = spark.range(50).selectExpr("id as k", "id as row", "id as __row")
    right = spark.range(50).selectExpr("id as k", "id % 7 as w")
    df = join_tables(left, right, "k", "full", hot_key_rows=0, where="leftView.k % 2 = rightView.w % 2")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 0 and plan.count("Join LeftAnti") == 2
    assert df.columns == ["k", "row", "__row", "w"]
    matched = [i for i in range(50) if i % 2 == i % 7 % 2]
    assert df.count() == 100 - len(matched)


def test_cells_of_few_widths_list_fewer_rows():
    few = {k: 100 for k in range(13)} | {NO_LENGTH: 100}
    many_points = cell_widths(few, 1_000_000)
    assert set(many_points) == set(few) and all(w <= k for k, w in many_points.items())
    assert len(set(many_points.values())) == 3  # with that of no length
    assert all(k - w <= NARROWER for k, w in many_points.items())
    # where points are few, each interval has cells of its own width
    assert cell_widths(few, 1) == {k: k for k in few}
    assert cell_widths({}, 5) == {}


def test_range_join_lists_points_under_few_widths(spark):
    points = spark.range(20_000).select((F.col("id") * 3.7).alias("p"))
    spans = spark.range(60).select(F.col("id").alias("n"), F.pow(F.lit(2.0), F.col("id") % 16).alias("lo"))
    spans = spans.withColumn("hi", F.col("lo") + F.col("n") % 5 * F.pow(F.lit(2.0), F.col("n") % 13))
    joined = join_range(points, spans, "p", "lo", "hi", closed="both")
    plan = joined._jdf.queryExecution().analyzed().toString()
    widths = re.search(r"explode\(array\(([-\d, ]+)\)\)", plan).group(1).split(",")
    assert len(widths) <= 4
    brute = points.crossJoin(spans).where("p between lo and hi")
    assert joined.count() == brute.count() > 0
    assert joined.exceptAll(brute.select(*joined.columns)).isEmpty()


def test_matched_numbers_move_as_bits(spark):
    numbers = [0, 1, 63, 63, 64, 127, 5 << 33, (5 << 33) + 63, (5 << 33) + 64]
    words = _matched_words(spark.createDataFrame([(n,) for n in numbers], "number long"))
    found = {r["word"] * 64 + k for r in words.collect() for k in range(64) if r["bits"] >> k & 1}
    assert found == set(numbers)
    assert words.count() == 4
    assert _matched_words(spark.range(0, 100_000, 1, 4).withColumnRenamed("id", "number")).count() == 1563


@pytest.mark.parametrize("how", ["left", "right", "full", "semi", "anti"])
def test_rows_without_a_match_over_many_words(spark, how):
    left = spark.range(0, 3000, 1, 3).selectExpr("id % 500 as k", "id as word", "id % 11 as bits")
    right = spark.range(0, 2000, 1, 2).selectExpr("id % 700 as k", "id as w")
    where = "leftView.bits < rightView.w % 13"
    split = join_tables(left, right, "k", how, hot_key_rows=0, where=where)
    whole = join_tables(left, right, "k", how, hot_key_rows=None, where=where)
    assert split.columns == whole.columns
    assert rows(split) == rows(whole) != []
