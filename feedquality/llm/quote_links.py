r"""Quotation linking: replies that quote, linked to what they quote.

A line of a message is quoted at the level that its leading ``>`` marks give, as many as
there are. Lines of one level that follow each other are a passage. A passage counts
under a hash of its words: A-Z small, runs of anything but letters and digits one blank.
The own text of a message, which is its lines without marks, counts as a passage as a
whole and line by line, so a quote of all of a message, of some lines or of one is found.

Quoted passages, and their lines, are joined to own text of the same hash in the same
conversation. The original is the earliest turn that holds it, if that is before the
quoting one; so the originals have one row for each key and a common line makes no pairs.
A message replies to that of the turns found which it quotes at the lowest level, of
these to the one with most words quoted, then to the latest. Without a link it opens a thread.

Threads come from the links by doubling: after ``k`` rounds each message knows its ancestor
``2 ** k`` links up. The order of a conversation is ``root`` (the turn that opens the
thread), ``depth`` (links up to it), then ``turn``: three numbers a row, so a conversation
that holds a third of all messages is sorted like any other rows and never gathered.

All of it is DataFrame expressions. A null or empty text has no lines and quotes nothing.
Repeated rows (of one conversation and turn) quote and are quoted together; each is
returned. Rows with a null conv_id or turn link with nothing; their root is their turn and their depth 0.
Extra columns are not looked at; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedquality.llm.text import read
from feedquality.session import stage

MARKS = r"^(?:\x20*>)+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["conv_id", "turn"]


def level(line: Column) -> Column:
    """How many marks a line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def unquoted(line: Column) -> Column:
    return F.regexp_replace(line, MARKS + r"\x20?", "")


def normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.translate(text, CAPITALS, SMALL), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), text).alias(f"h{i}") for i in (1, 2)]


def own_text(text: Column) -> Column:
    """A text without quoted lines, and without blank lines around what is left."""
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: level(x) == 0), "\n")
    return F.btrim(kept, F.lit("\n"))


def passages(messages: DataFrame) -> DataFrame:
    """The passages of each message and their lines: level, normalised text, number of words.

    A message's lines are grouped within its row: a passage is the line it starts with and
    those that follow at its level.
    """
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(level(x).alias("level"), unquoted(x).alias("line")))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0) | (F.get(F.col("lines"), i)["level"] != F.get(F.col("lines"), i - 1)["level"]))
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("lines")))
    runs = F.transform("starts", lambda s, k: F.struct(
        F.get(F.col("lines"), s)["level"].alias("level"),
        F.array_join(F.transform(F.slice("lines", s + 1, F.get(F.col("ends"), k) - s), lambda x: x["line"]), "\n")
        .alias("line")))
    whole_own = F.array(F.struct(F.lit(0).alias("level"), own_text(F.col("text")).alias("line")))
    found = (messages.filter("text is not null and conv_id is not null and turn is not null").select(*KEY, "text", lines.alias("lines"))
             .withColumn("starts", starts).withColumn("ends", ends)
             .select(*KEY, F.explode(F.concat("lines", runs, whole_own)).alias("p"))
             .select(*KEY, F.col("p.level").alias("level"), normal(F.col("p.line")).alias("words"))
             .filter("words <> ''"))
    return found.select(*KEY, "level", *_hashes(F.col("words")),
                        F.size(F.split("words", " ")).cast("long").alias("n_words")).distinct()


def links(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``parent`` (a turn), ``quote_level`` and ``quoted_words`` of each message that quotes another."""
    parts = stage(passages(messages), "passages")
    quoted = parts.filter("level > 0")
    key = ["conv_id", "h1", "h2"]
    originals = parts.filter("level = 0").groupBy(*key).agg(F.min("turn").alias("source"))
    found = quoted.join(originals, key).filter("source < turn")
    votes = found.groupBy("conv_id", "turn", "level", "source").agg(F.sum("n_words").alias("quoted_words"))
    best = votes.groupBy(*KEY).agg(F.max(F.struct(-F.col("level"), "quoted_words", "source")).alias("b"))
    return best.select(*KEY, F.col("b.source").alias("parent"), (-F.col("b.col1")).cast("int").alias("quote_level"),
                       F.col("b.quoted_words").alias("quoted_words"))


def threads(linked: DataFrame) -> DataFrame:
    """``root`` and ``depth`` of each message that has a parent."""
    at = stage(linked.select(*KEY, F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = at.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("up"), F.col("depth").alias("more"))
        joined = at.join(up, ["conv_id", "root"], "left")
        if joined.filter("up is not null").isEmpty():
            return at
        at = stage(joined.select(*KEY, F.coalesce("up", "root").alias("root"),
                                 (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")


def conversations(messages: DataFrame) -> DataFrame:
    """Every message: its parent, thread and place in it, and its text without quotes."""
    linked = stage(links(messages), "links")
    placed = linked.join(threads(linked), KEY)
    return (messages.select(*KEY, "role", "text").join(placed, KEY, "left")
            .select(*KEY, "role", "parent", "quote_level", "quoted_words",
                    F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
                    own_text(F.col("text")).alias("text")))


def op2_quote_links(spark, sf):
    return conversations(read(spark, sf, "conversations"))


_BODY = r"regexp_replace(line, '^(?:\x20*>)+\x20?', '')"


def _normal(text: str) -> str:
    return (rf"trim(regexp_replace(translate({text}, '{CAPITALS}', '{SMALL}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ')")


OP2_SQL = rf"""
with recursive messages as (
  select row_number() over () as rid, * from conversations),
lines as (
  select rid, conv_id, turn, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as pos
  from messages),
levelled as (
  select *, {_BODY} as body,
         length(regexp_replace(regexp_extract(line, '^(?: *>)+'), '[^>]', '', 'g')) as level
  from lines),
runs as (
  select *, pos - row_number() over (partition by rid, level order by pos) as run from levelled),
own as (
  select rid, conv_id, turn, trim(string_agg(line, chr(10) order by pos), chr(10)) as text
  from levelled where level = 0 group by rid, conv_id, turn),
parts as (
  select conv_id, turn, level, {_normal('body')} as words from levelled
  union
  select conv_id, turn, level, {_normal("string_agg(body, chr(10) order by pos)")}
  from runs group by rid, conv_id, turn, level, run
  union
  select conv_id, turn, 0, {_normal('text')} from own),
originals as (
  select conv_id, words, min(turn) as source from parts where level = 0 and words <> '' group by conv_id, words),
votes as (
  select q.conv_id, q.turn, q.level, o.source, sum(len(string_split(q.words, ' '))) as quoted_words
  from parts q join originals o using (conv_id, words)
  where q.level > 0 and o.source < q.turn group by all),
best as (
  select conv_id, turn, source as parent, level as quote_level, cast(quoted_words as bigint) as quoted_words
  from votes
  qualify row_number() over (partition by conv_id, turn order by level, quoted_words desc, source desc) = 1),
up as (
  select conv_id, turn, parent as root, 1 as depth from best
  union all
  select u.conv_id, u.turn, b.parent, u.depth + 1 from up u join best b on b.conv_id = u.conv_id and b.turn = u.root),
placed as (select conv_id, turn, arg_max(root, depth) as root, max(depth) as depth from up group by conv_id, turn)
select m.conv_id, m.turn, m.role, b.parent, cast(b.quote_level as int) as quote_level, b.quoted_words,
       coalesce(p.root, m.turn) as root, cast(coalesce(p.depth, 0) as bigint) as depth,
       case when m.text is not null then coalesce(o.text, '') end as text
from messages m left join own o using (rid)
left join best b on b.conv_id = m.conv_id and b.turn = m.turn
left join placed p on p.conv_id = m.conv_id and p.turn = m.turn
"""
