"""Removal of boilerplate lines: lines that many sites share.

A line counts under a hash of its text without outer blanks; blank lines never count. One
aggregation keeps, for each hash, how often it occurs, a HyperLogLog sketch of the sites
it occurs on, and the smallest document that holds it. Tasks merge their sketches before
anything is shuffled, so a line that a third of all documents hold is a few bytes from
each task. A line that occurs fewer than ``min_sites`` times cannot be on that many sites.
Of the others, the estimate decides far from the threshold, and an exact count of distinct
sites decides near it, so the lines found are those that exact counting would find.

A boilerplate line stays in the document with the smallest doc_id that holds it, so that
no content leaves the corpus, and goes from all others.

A null site counts as no site. A null text stays null and an empty one empty. Rows with a
null doc_id are cleaned but never keep a line for the others; repeated rows are cleaned
alike. Extra columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedquality.llm.text import read
from feedquality.session import stage

#: The blanks that don't count at a line's ends.
BLANKS = " \t\r\x0b\x0c"
#: On so many sites a line is boilerplate.
MIN_SITES = 10
#: Sketches of 2 ** 10 registers: a standard error of 3 per cent.
SKETCH_LG = 10
#: An estimate within this share of the threshold (eight standard errors) is counted exactly.
NEAR = 0.25

LINE = ["h1", "h2"]
ROW = ["doc_id", "t1", "t2"]


def _hash128(value: Column, names: list[str]) -> list[Column]:
    return [F.xxhash64(F.lit(i), value).alias(name) for i, name in enumerate(names)]


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """Every line that isn't blank: its hash, site and position, and the row it is in.

    A row is known by its doc_id and the hash of its text: rows that agree in both are
    cleaned alike.
    """
    trimmed = F.btrim("line", F.lit(BLANKS))
    return (docs.select("doc_id", F.col(site).alias("site"), *_hash128(F.col("text"), ROW[1:]),
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .filter(trimmed != "").select(*ROW, "site", "pos", *_hash128(trimmed, LINE)))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The hash of each line on ``min_sites`` sites or more, and the ``keeper`` of it."""
    lines = _lines(docs, site).filter(F.col("site").isNotNull())
    spread = stage(
        lines.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keeper"),
                                 F.hll_sketch_agg(F.col("site").cast("string"), F.lit(SKETCH_LG)).alias("sketch"))
        .filter(F.col("n") >= min_sites)
        .select(*LINE, "keeper", F.hll_sketch_estimate("sketch").alias("sites"))
        .filter(F.col("sites") >= min_sites * (1 - NEAR)), "spread")
    sure = spread.filter(F.col("sites") > min_sites * (1 + NEAR)).select(*LINE, "keeper")
    near = spread.filter(F.col("sites") <= min_sites * (1 + NEAR)).select(*LINE, "keeper")
    counted = (lines.join(near, LINE).groupBy(*LINE, "site").agg(F.first("keeper").alias("keeper"))
               .groupBy(*LINE).agg(F.first("keeper").alias("keeper"), F.count(F.lit(1)).alias("exact"))
               .filter(F.col("exact") >= min_sites).select(*LINE, "keeper"))
    return sure.unionByName(counted)


def drop_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """A column ``doc`` with each document, its text cleaned, and ``n_lines``, ``n_removed``."""
    found = stage(boilerplate(docs, site, min_sites), "boilerplate")
    goes = F.col("doc_id").isNull() | F.col("keeper").isNull() | (F.col("doc_id") != F.col("keeper"))
    drops = (_lines(docs, site).join(found, LINE).filter(goes)
             .groupBy(*ROW).agg(F.collect_set("pos").alias("drops")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), "doc_id",
                       *_hash128(F.col("text"), ROW[1:]))
    same = (rows["doc_id"].eqNullSafe(drops["doc_id"]) & (rows["t1"] == drops["t1"]) & (rows["t2"] == drops["t2"]))
    lines = F.split("doc.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "drops")
    cleaned = F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n")
    return (rows.join(drops.select(*ROW, "drops"), same, "left")
            .select(F.when(F.col("drops").isNull(), F.col("doc"))
                    .otherwise(F.col("doc").withField("text", cleaned)).alias("doc"),
                    F.when(F.col("doc.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_removed")))


def op6_line_dedup(spark, sf):
    return drop_boilerplate(read(spark, sf, "documents").select("doc_id", "text", "source")).select(
        "doc.doc_id", "n_lines", F.greatest("n_removed", F.lit(0)).alias("n_removed"),
        F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("clean_sha256"))


OP6_SQL = f"""
with lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as pos
  from documents),
keyed as (select *, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) as key from lines),
spread as (
  select key, min(doc_id) as keeper from keyed
  where key <> '' and source is not null group by key having count(distinct source) >= {MIN_SITES}),
judged as (
  select k.doc_id, k.pos, k.line, s.key is not null and (k.doc_id <> s.keeper) as gone
  from keyed k left join spread s using (key))
select d.doc_id, coalesce(j.n_lines, 0) as n_lines, coalesce(j.n_removed, 0) as n_removed,
       sha256(coalesce(j.clean, '')) as clean_sha256
from documents d left join (
  select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
         string_agg(line, chr(10) order by pos) filter (where not gone) as clean
  from judged group by doc_id) j using (doc_id)
"""
