"""Joins of two tables.

The physical strategy is Spark's: a side below the broadcast threshold is sent round,
anything else is shuffled on the keys, and adaptive execution splits hot partitions.
It can split both sides of an inner join and the kept side of an outer, semi or anti
join. The other side it cannot split, nor either side of a full join. So
:func:`join_tables` looks for a key too big for one task there, and if it finds one puts
the same result together from joins that can be split.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.errors import ConfigError
from feedquality.functions.columns import quoted
from feedquality.session import stage

# The join types a caller may write, and what they mean here. A cross
# join always comes with a condition, which makes it an inner join.
JOIN_TYPES = {
    "": "inner",
    "inner": "inner",
    "cross": "inner",
    "left": "left",
    "left outer": "left",
    "right": "right",
    "right outer": "right",
    "full": "full",
    "full outer": "full",
    "outer": "full",
    "left semi": "left_semi",
    "semi": "left_semi",
    "left anti": "left_anti",
    "anti": "left_anti",
}

# The names a condition written as text uses for the two sides.
LEFT, RIGHT = "leftView", "rightView"

# A key group up to this many rows is ordinary work for one task.
HOT_KEY_ROWS = 5_000_000

# Buckets that keys are counted in before any key is counted by itself.
KEY_BUCKETS = 1 << 16

On = str | Column | Sequence[str] | Sequence[tuple[str, str]]


def join_type(how: str | None) -> str:
    name = " ".join((how or "").lower().replace("_", " ").split())
    name = {"leftouter": "left", "rightouter": "right", "fullouter": "full",
            "leftsemi": "left semi", "leftanti": "left anti"}.get(name, name)
    if name not in JOIN_TYPES:
        raise ConfigError(f"unknown join type {how!r}")
    return JOIN_TYPES[name]


def side(alias: str, name: str) -> Column:
    return F.col(f"{alias}.{quoted(name)}")


def _pairs(on: On, left: DataFrame, right: DataFrame) -> list[tuple[str, str]] | None:
    """Equal-key pairs, or ``None`` when ``on`` is a condition."""
    if isinstance(on, Column):
        return None
    if isinstance(on, str):
        return [(on, on)] if on in left.columns and on in right.columns else None
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def has_hot_key(df: DataFrame, keys: Sequence[str], limit: int = HOT_KEY_ROWS, count_nulls: bool = False) -> bool:
    """Whether some key has more than ``limit`` rows; a null counts as a key only if asked for.

    Keys are hashed into buckets, counted in each task before the shuffle. Only the keys
    of buckets with more than ``limit`` rows are counted by themselves, so the answer is
    exact at any size, and mostly costs one small exchange.
    """
    columns = [F.col(quoted(k)) for k in dict.fromkeys(keys)]
    rows = df.select(*columns)
    if not count_nulls:
        rows = rows.where(reduce(and_, [c.isNotNull() for c in columns]))
    bucket = F.pmod(F.xxhash64(*columns), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")
    counted = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    heavy = [r["bucket"] for r in counted.select("bucket").collect()]  # KEY_BUCKETS rows at most
    if not heavy:
        return False
    buckets = F.broadcast(df.sparkSession.createDataFrame([(b,) for b in heavy], "heavy int"))
    suspects = rows.join(buckets, bucket == F.col("heavy"), "left_semi")
    return not suspects.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).isEmpty()


def is_small(df: DataFrame) -> bool:
    """Whether Spark, by its estimate, would send ``df`` to every task."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _hot_sides(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], kind: str,
               null_safe: bool, limit: int | None) -> tuple[bool, bool]:
    """Whether the left and the right side hold a key too big for one task, for a join that
    adaptive execution could not split on its own; else ``(False, False)``."""
    if limit is None or kind == "inner" or (kind != "full" and is_small(left if kind == "right" else right)):
        return False, False

    def hot(i: int, kept: bool) -> bool:
        # a null key matches nothing, but the side that is kept moves its null rows too
        return has_hot_key((left, right)[i], [p[i] for p in pairs], limit, null_safe or kept)

    if kind == "full":
        return hot(0, True), hot(1, True)
    if kind == "right":
        return (True, hot(1, True)) if hot(0, False) else (False, False)
    return (hot(0, kind != "left_semi"), True) if hot(1, False) else (False, False)


def _product(joined: DataFrame, left: DataFrame, right: DataFrame) -> bool:
    """Whether a join compares every row of one side with every row of the other."""
    def loops(df: DataFrame) -> int:
        text = df._jdf.queryExecution().sparkPlan().toString()
        return text.count("NestedLoopJoin") + text.count("CartesianProduct")
    return loops(joined) > loops(left) + loops(right)


def join_tables(left: DataFrame, right: DataFrame, on: On, how: str | None = "inner",
                suffixes: tuple[str, str] = ("", "_r"), null_safe: bool = False,
                hot_key_rows: int | None = HOT_KEY_ROWS, where: str | Column | None = None) -> DataFrame:
    """Join two tables and keep the columns of both sides.

    ``on`` is a column name both sides have, a list of such names or of
    ``(left name, right name)`` pairs, a ``Column``, or a SQL condition that calls the
    sides ``leftView`` and ``rightView``. A key given by one name comes out once; any
    other name both sides have gets ``suffixes``. Null keys match nothing unless
    ``null_safe``. Semi and anti joins return the left columns only.

    ``where`` is a further condition on pairs of rows whose keys are equal, again as a
    ``Column`` or as text with ``leftView`` and ``rightView``.

    An outer, semi or anti join on keys first looks for a key with more than
    ``hot_key_rows`` rows on a side that could not be split, and is then put together from
    other joins. ``None`` skips the look, and so does a side small enough to be sent to
    every task. A join on a condition alone is left to Spark as it is, and refused where it
    would compare all pairs: give the keys and ``where``, or use :func:`join_range`.
    """
    kind = join_type(how)
    pairs = _pairs(on, left, right)
    if pairs is not None and not pairs:
        raise ConfigError("a join needs at least one key or a condition")
    l, r = left.alias(LEFT), right.alias(RIGHT)
    if pairs is None:
        condition = on if isinstance(on, Column) else F.expr(on)
        if where is not None:
            raise ConfigError("where goes with keys; a join on a condition takes all of it in on")
        joined = l.join(r, condition, kind)
        if _product(joined, left, right):
            raise ConfigError("the condition has no equal keys, so all pairs would be compared; use join_range")
        return _outputs(joined, left, right, [], kind, suffixes)

    def equal(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_safe else a == b

    condition = reduce(and_, [equal(side(LEFT, a), side(RIGHT, b)) for a, b in pairs])
    if where is not None:
        condition = condition & (where if isinstance(where, Column) else F.expr(where))
    hot_left, hot_right = _hot_sides(left, right, pairs, kind, null_safe, hot_key_rows)
    if not (hot_left or hot_right):
        return _outputs(l.join(r, condition, kind), left, right, pairs, kind, suffixes)

    if where is not None:
        def matches(lefts: DataFrame, rights: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
            return lefts.alias(LEFT).join(rights.alias(RIGHT), condition).select(*[side(*c) for c in columns])
        return _from_matches(matches, left, right, pairs, kind, suffixes)

    if kind in ("left_semi", "left_anti"):
        return l.join(_distinct_keys(right, [b for _, b in pairs], hot_left).alias(RIGHT), condition, kind)

    # a join that can be split, then the rows it leaves out, found by anti joins that can
    first = "inner" if kind != "full" or (hot_left and hot_right) else "left" if hot_left else "right"
    parts = [_outputs(l.join(r, condition, first), left, right, pairs, first, suffixes)]
    if kind in ("left", "full") and first != "left":
        keys = _distinct_keys(right, [b for _, b in pairs], hot_left)
        parts.append(_padded(l.join(keys.alias(RIGHT), condition, "left_anti"), left, right, pairs, suffixes, LEFT))
    if kind in ("right", "full") and first != "right":
        keys = _distinct_keys(left, [a for a, _ in pairs], hot_right)
        parts.append(_padded(r.join(keys.alias(LEFT), condition, "left_anti"), left, right, pairs, suffixes, RIGHT))
    return reduce(DataFrame.union, parts)


def _numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """A staged copy whose rows have a number, and the name of its column, which no other has."""
    name = "row"
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _word(number: Column) -> Column:
    return F.shiftright(number, 6)


def _place(number: Column) -> Column:
    return F.pmod(number, F.lit(64)).cast("int")


def _matched_words(numbers: DataFrame) -> DataFrame:
    """The numbers in ``number`` as bits, 64 to a row: ``word`` and its ``bits``.

    Rows are numbered without gaps in each task, so this is far shorter than the distinct numbers.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _place(F.col("number")))
    return numbers.groupBy(_word(F.col("number")).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _from_matches(matches: Callable[[DataFrame, DataFrame, Sequence[tuple[str, str]]], DataFrame], left: DataFrame,
                  right: DataFrame, pairs: list[tuple[str, str]], kind: str, suffixes: tuple[str, str]) -> DataFrame:
    """A join of any kind, put together from its matches, which are looked for once.

    ``matches(left, right, columns)`` gives the pairs of rows that meet the condition; of their
    columns those that are named, as ``(side, column)``. The kept side's rows get a number for that,
    and those whose number is among no match come from an anti join with the staged matches, whose
    numbers are put together as bits before they move.
    """
    kept = {"left": [LEFT], "right": [RIGHT], "full": [LEFT, RIGHT], "left_semi": [LEFT], "left_anti": [LEFT]}[kind]
    tables, numbers = {LEFT: left, RIGHT: right}, {}
    for name in kept:
        tables[name], numbers[name] = _numbered(tables[name])

    def rows(name: str, found: DataFrame, how: str) -> DataFrame:
        matched = _matched_words(found.select(F.col(f"number_{name}").alias("number")))
        number = tables[name][quoted(numbers[name])]
        held = (_word(number) == matched["word"]) & (F.getbit(matched["bits"], _place(number)) == 1)
        return tables[name].join(matched, held, how).drop(numbers[name])

    wanted = [(name, numbers[name]) for name in kept]
    if kind in ("left_semi", "left_anti"):
        return rows(LEFT, matches(tables[LEFT], tables[RIGHT], wanted).toDF(f"number_{LEFT}"), kind)
    lefts, rights = _labels(left, right, pairs, suffixes)
    shared = {a for a, b in pairs if a == b}
    columns = [*[(LEFT, c) for c in lefts], *[(RIGHT, c) for c in right.columns if c not in shared]]
    found = matches(tables[LEFT], tables[RIGHT], [*columns, *wanted])
    labels = [*lefts.values(), *rights.values()]
    # labels may equal the numbers' names, so all of them get plain ones until the end
    found = stage(found.toDF(*[f"c{i}" for i in range(len(labels))], *[f"number_{name}" for name in kept]), "matches")
    parts = [found.select(*[F.col(f"c{i}").alias(label) for i, label in enumerate(labels)])]
    for name in kept:
        parts.append(_padded(rows(name, found, "left_anti").alias(name), left, right, pairs, suffixes, name))
    return reduce(DataFrame.union, parts)


def _distinct_keys(df: DataFrame, names: list[str], staged: bool) -> DataFrame:
    """The keys ``df`` holds. Adaptive execution splits a join only between plain
    shuffles, not on top of an aggregate, so keys that meet a hot side are staged first."""
    keys = df.select(*[F.col(quoted(n)) for n in dict.fromkeys(names)]).distinct()
    return stage(keys, "keys") if staged else keys


def _labels(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
            suffixes: tuple[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """Output name of each left and each right column; a shared key is listed on the left."""
    exact = left.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def same(name: str) -> str:
        return name if exact else name.lower()

    shared = {a for a, b in pairs if a == b}
    clash = ({same(c) for c in left.columns} & {same(c) for c in right.columns if c not in shared})
    lefts = {c: c + suffixes[0] if same(c) in clash and c not in shared else c for c in left.columns}
    rights = {c: c + suffixes[1] if same(c) in clash else c for c in right.columns if c not in shared}
    labels = [same(c) for c in (*lefts.values(), *rights.values())]
    if len(set(labels)) < len(labels):
        raise ConfigError(f"suffixes {suffixes!r} leave two result columns with one name")
    return lefts, rights


def _outputs(joined: DataFrame, left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
             kind: str, suffixes: tuple[str, str]) -> DataFrame:
    if kind in ("left_semi", "left_anti"):
        return joined
    lefts, rights = _labels(left, right, pairs, suffixes)
    if [*lefts.values(), *rights.values()] == joined.columns:
        return joined
    shared = {a for a, b in pairs if a == b}
    source = {"right": f"{RIGHT}.{{0}}", "full": f"coalesce({LEFT}.{{0}}, {RIGHT}.{{0}})"}.get(kind, f"{LEFT}.{{0}}")
    return joined.selectExpr(
        *[(source if c in shared else f"{LEFT}.{{0}}").format(quoted(c)) + f" as {quoted(label)}"
          for c, label in lefts.items()],
        *[f"{RIGHT}.{quoted(c)} as {quoted(label)}" for c, label in rights.items()])


def _padded(alone: DataFrame, left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
            suffixes: tuple[str, str], kept: str) -> DataFrame:
    """Unmatched rows of one side with nulls for the other side's columns."""
    lefts, rights = _labels(left, right, pairs, suffixes)
    shared = {a for a, b in pairs if a == b}

    def value(alias: str, schema: T.StructType, name: str) -> Column:
        if alias == kept or name in shared:
            return side(kept, name)
        return F.lit(None).cast(schema[name].dataType)

    return alone.select(
        *[value(LEFT, left.schema, c).alias(label) for c, label in lefts.items()],
        *[value(RIGHT, right.schema, c).alias(label) for c, label in rights.items()])


# Beyond this an end or a point counts as infinitely far.
FAR = 1e300

# The level of intervals of no length, below those of any cells.
NO_LENGTH = -10_000

# An interval is listed under cells of 2**-NARROWER times its own width at the narrowest.
NARROWER = 10


def join_range(left: DataFrame, right: DataFrame, point: str, low: str | None, high: str | None,
               closed: str = "right", suffixes: tuple[str, str] = ("", "_r"), how: str | None = "inner",
               where: str | Column | None = None) -> DataFrame:
    """Join of points with intervals by hashing instead of a nested loop.

    ``closed`` names the ends that belong to the interval: ``left``, ``right``, ``both``
    or ``neither``. Points and ends are numbers or timestamps; an end may be infinite, and
    without ``low`` or ``high`` all intervals are open on that side. ``how`` is any type of
    :func:`join_tables`, and ``where`` a further condition on a point and an interval that holds it,
    as a ``Column`` or as text with ``leftView`` and ``rightView``. A point or an end that is null is in no
    interval; an outer join keeps its row.

    Intervals are first cut to the range of the points. One no longer than ``2**k`` touches
    two or three cells of width ``2**k``, and some more narrower ones. So each interval is listed
    under its cells, and each point under its one cell of every width in use that is not too small
    for it. Of the widths that occur among the intervals (a few dozen, whatever the size of the tables)
    those are used with which the fewest rows are listed in all (``cell_widths``). Sharing a cell
    makes a candidate pair; the exact comparison decides. Cells are never so small that
    numbers of the interval's magnitude can't be told apart. Intervals of no length are listed under
    their number itself, and so are points if there are any. The listed intervals are staged, so
    that Spark knows their true size before it moves the points.

    For a semi or an anti join on one bound alone, points are compared with the outermost of the
    bounds, and no pair is formed. Other outer, semi and anti joins look for the matches once, stage
    them, and take the rows without any from an anti join on row numbers.
    """
    if closed not in ("left", "right", "both", "neither"):
        raise ConfigError(f"closed must be left, right, both or neither, got {closed!r}")
    if low is None and high is None:
        raise ConfigError("a range needs at least one bound")
    kind = join_type(how)
    if kind in ("left_semi", "left_anti") and where is None and (low is None or high is None):
        return _beyond_one_bound(left, right, point, low, high, closed, kind)

    def matches(lefts: DataFrame, rights: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
        return _in_cells(lefts, rights, point, low, high, closed, where).select(
            *[F.col(name).getField(c) for name, c in columns])

    if kind != "inner":
        return _from_matches(matches, left, right, [], kind, suffixes)
    lefts, rights = _labels(left, right, [], suffixes)
    found = matches(left, right, [*[(LEFT, c) for c in lefts], *[(RIGHT, c) for c in rights]])
    return found.toDF(*lefts.values(), *rights.values())


def _beyond_one_bound(left: DataFrame, right: DataFrame, point: str, low: str | None, high: str | None, closed: str,
                      kind: str) -> DataFrame:
    """Points above the smallest of the lower ends, or below the largest of the upper ones; or the others."""
    at, end = F.col(quoted(point)), F.col(quoted(low or high))
    data_type = right.schema[low or high].dataType
    outermost = F.min(end) if low else F.max(end)
    moment = isinstance(data_type, T.TimestampType)
    # one number, whatever the number of intervals, fetched in a form that loses nothing
    value = right.where(~F.isnan(end.cast("double"))).agg(
        (F.unix_micros(outermost) if moment else outermost.cast("string")).alias("value")).first()["value"]
    bound = F.timestamp_micros(F.lit(value)) if moment else F.lit(value).cast(data_type)
    with_end = closed in ("both", "left" if low else "right")
    if low:
        inside = at >= bound if with_end else at > bound
    else:
        inside = at <= bound if with_end else at < bound
    inside = F.coalesce(inside & ~F.isnan(at.cast("double")), F.lit(False))
    return left.where(inside if kind == "left_semi" else ~inside)


def cell_widths(intervals: Mapping[int, int], points: int) -> dict[int, int]:
    """The level of the cells that intervals of each level are listed under.

    ``intervals`` has the number of intervals by level. A level in use costs a row for each of the
    ``points``, and cells narrower by ``d`` levels than an interval cost up to ``2**d + 1`` rows for it.
    Neighbouring levels share the lowest of them where that makes fewer rows in all.
    """
    levels = sorted(k for k in intervals if k != NO_LENGTH)
    # the least number of rows for the first levels, and where the last of their groups begins
    rows, begins = [0], []
    for i, k in enumerate(levels):
        costs = [(rows[j] + points + sum(intervals[x] * (2 ** (x - levels[j]) + 1) for x in levels[j:i + 1]), -j)
                 for j in range(i + 1) if k - levels[j] <= NARROWER]
        cost, j = min(costs)
        rows.append(cost)
        begins.append(-j)
    used, end = {k: k for k in intervals if k == NO_LENGTH}, len(levels)
    while end:
        begin = begins[end - 1]
        used |= {k: levels[begin] for k in levels[begin:end]}
        end = begin
    return used


def _in_cells(left: DataFrame, right: DataFrame, point: str, low: str | None, high: str | None, closed: str,
              where: str | Column | None) -> DataFrame:
    """Points and the intervals that hold them, as the structs ``leftView`` and ``rightView``."""
    def number(c: Column) -> Column:
        return F.greatest(F.least(c.cast("double"), F.lit(FAR)), F.lit(-FAR))

    def cell(c: Column, level: Column) -> Column:
        return F.floor(c / F.pow(F.lit(2.0), level))

    at = F.col(quoted(point))
    lo, hi = (F.col(quoted(c)) if c is not None else None for c in (low, high))
    present = left.where(at.isNotNull() & ~F.isnan(at.cast("double")))
    reach = present.agg(F.min(number(at)).alias("lo"), F.max(number(at)).alias("hi"), F.count(at).alias("n")).first()
    first, last = (0.0, 0.0) if reach["lo"] is None else (reach["lo"], reach["hi"])
    begin = F.greatest(number(lo), F.lit(first)) if lo is not None else F.lit(first)
    end = F.least(number(hi), F.lit(last)) if hi is not None else F.lit(last)
    magnitude = F.greatest(F.abs(F.col("begin")), F.abs(F.col("end")), F.lit(1e-200))
    level = F.when(F.col("end") > F.col("begin"), F.greatest(
        F.ceil(F.log2(F.col("end") - F.col("begin"))), F.ceil(F.log2(magnitude)) - 50)).otherwise(NO_LENGTH)
    given = [c for c in (lo, hi) if c is not None]
    valid = reduce(and_, [c.isNotNull() & ~F.isnan(c.cast("double")) for c in given])
    if len(given) == 2:
        valid = valid & (lo <= hi)
    ends = [c.alias(name) for c, name in ((lo, "lo"), (hi, "hi")) if c is not None]
    intervals = (right.where(valid)
                 .select(F.struct("*").alias(RIGHT), *ends, begin.alias("begin"), end.alias("end"))
                 .where("begin <= end").withColumn("level", level.cast("int")))
    # a row for each level
    used = cell_widths(dict(intervals.groupBy("level").count().collect()), reach["n"])
    if not used:
        used = {NO_LENGTH: NO_LENGTH}
    taken = F.create_map(*[F.lit(k) for pair in used.items() for k in pair])

    no_length = F.col("level") == NO_LENGTH
    cells = F.sequence(F.when(no_length, 0).otherwise(cell(F.col("begin"), F.col("level"))),
                       F.when(no_length, 0).otherwise(cell(F.col("end"), F.col("level"))))
    listed = stage(intervals.withColumn("level", F.element_at(taken, F.col("level"))).withColumn("cell", F.explode(cells))
                   .withColumn("exact", F.when(no_length, F.col("begin")).otherwise(0.0)).drop("begin", "end"), "intervals")
    near = F.abs(F.col("place")) <= F.pow(F.lit(2.0), F.col("level") + 51 + NARROWER)
    points = (present.select(F.struct("*").alias(LEFT), at.alias("at"), number(at).alias("place"),
                             F.explode(F.lit(sorted(set(used.values())))).alias("level"))
              .where(no_length | near)
              .withColumn("cell", F.when(no_length, 0).when(near, cell(F.col("place"), F.col("level"))))
              .withColumn("exact", F.when(no_length, F.col("place")).otherwise(0.0)).drop("place"))
    inside = []
    if lo is not None:
        inside.append(F.col("at") >= F.col("lo") if closed in ("left", "both") else F.col("at") > F.col("lo"))
    if hi is not None:
        inside.append(F.col("at") <= F.col("hi") if closed in ("right", "both") else F.col("at") < F.col("hi"))
    found = points.join(listed, ["level", "cell", "exact"]).where(reduce(and_, inside))
    if where is None:
        return found
    return found.where(where if isinstance(where, Column) else F.expr(where))
