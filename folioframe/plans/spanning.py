"""Queries of intervals over documents' texts: words in windows of lines, words in marked stretches, spans that others cover; names that are free."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.udfs import line_places, word_places
from ..operators import intervals
from ..sources import sinks
from ..sources.tables import table
from .registry import query

#: Lines with where they begin in the text, words with where they begin, and windows of five lines, each three lines later.
PLACED = """with l as (select doc_id as doc, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
  ln as (select *, cast(coalesce(sum(length(line) + 1) over (partition by doc order by pos rows between unbounded preceding and 1 preceding), 0) as bigint) as "at" from l),
  wr as (select doc, pos, "at", unnest(string_split(line, ' ')) as word, generate_subscripts(string_split(line, ' '), 1) as k from ln),
  wd as (select doc, pos, word, cast("at" + coalesce(sum(length(word) + 1) over (partition by doc, pos order by k rows between unbounded preceding and 1 preceding), 0) as bigint) as "at" from wr),
  marks as (select doc, "at", word from wd where length(word) >= 9),
  win as (select a.doc, a.pos as win, a."at" as "start", max(b."at" + length(b.line)) as "end" from ln a join ln b on a.doc = b.doc and b.pos between a.pos and a.pos + 4 where a.pos % 3 = 0 group by a.doc, a.pos, a."at")"""


LEAF = 8  # windows, and lines up to a comma, are of some hundred characters


def _placed(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc"), line_places(F.col("text")).alias("lines"))


def lines(spark, d):
    """doc, pos, at, length, comma: where each line begins in its text; the texts themselves go no further."""
    return _placed(spark, d).select("doc", F.inline("lines"))


def marks(spark, d):
    """doc, at, word: words of nine characters or more."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.inline(word_places(F.col("text"), 9)))


def windows(spark, d):
    """doc, win, start, end: five lines from every third line on; they overlap."""
    last = lambda k: F.get("lines", F.least(k + 4, F.size("lines") - 1))
    own = F.transform(F.sequence(F.lit(0), F.size("lines") - 1, F.lit(3)), lambda k: F.struct(k.alias("win"), F.get("lines", k)["at"].alias("start"), (last(k)["at"] + last(k)["length"]).alias("end")))
    return _placed(spark, d).filter("lines is not null").select("doc", F.inline(own))


@query("marks_in_windows", PLACED + """ select w.doc, w.win, count(m.word) as marks, min(m."at") as first from win w left join marks m on m.doc = w.doc and m."at" >= w."start" and m."at" < w."end" group by w.doc, w.win""")
def q_marks_in_windows(spark, d):
    own = windows(spark, d)
    held = intervals.holding(marks(spark, d), own, leaf=LEAF).groupBy("doc", "win").agg(F.count("*").alias("marks"), F.min("at").alias("first"))
    return own.select("doc", "win").join(held, ["doc", "win"], "left").withColumn("marks", F.coalesce("marks", F.lit(0)))


@query("windows_of_marks", PLACED + """ select doc, "at", (select count(*) from win w where m.doc = w.doc and m."at" >= w."start" and m."at" < w."end") as windows from marks m""")
def q_windows_of_marks(spark, d):
    own = marks(spark, d)
    held = intervals.holding(own, windows(spark, d), leaf=LEAF).groupBy("doc", "at").agg(F.count("*").alias("windows"))
    return own.select("doc", "at").join(held, ["doc", "at"], "left").withColumn("windows", F.coalesce("windows", F.lit(0)))


#: Lines that begin with a capital and hold a comma: what is marked.
@query("words_in_marked_lines", PLACED + """, iv as (select doc, "at" as "start", "at" + strpos(line, ',') as "end" from ln where contains(line, ',')) select doc, "at", word, exists (select 1 from iv where iv.doc = m.doc and m."at" >= iv."start" and m."at" < iv."end") as covered from marks m""")
def q_words_in_marked(spark, d):
    """Whether a word stands before the first comma of its line."""
    marked = lines(spark, d).filter("comma >= 0").select("doc", F.col("at").alias("start"), (F.col("at") + F.col("comma") + 1).alias("end"))
    return intervals.covered(marks(spark, d), marked, leaf=LEAF)


@query(
    "widest_spans",
    PLACED + """, sp as (select doc, "start", "end", 'window' as kind from win union all select doc, "at", "at" + length(line), 'line' from ln union all select doc, "at", "at" + length(word), 'word' from marks),
      u as (select *, max("end") over (partition by doc order by "start", "end" desc, kind rows between unbounded preceding and 1 preceding) as last from sp)
      select doc, "start", "end", count(*) as n from u where last is null or "end" > last group by all""",
)
def q_widest(spark, d):
    own = lines(spark, d).select("doc", F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("end"))
    words = marks(spark, d).select("doc", F.col("at").alias("start"), (F.col("at") + F.length("word")).alias("end"))
    every = windows(spark, d).select("doc", "start", "end").unionByName(own).unionByName(words)
    return intervals.widest(every).groupBy("doc", "start", "end").agg(F.count("*").alias("n"))


@query(
    "free_output_names",
    """with w as (select 'p' || page_id % 97 || '.md' as name from pages union all select 'p' || doc_id % 97 || '-' || (2 + doc_id % 4) || '.md' from documents),
       t as (select distinct 'p' || conv_id % 80 || case when conv_id % 3 = 0 then '' else '-' || conv_id % 7 end || '.md' as name from conversations),
       o as (select name, row_number() over (partition by name) as nth, name in (select name from t) as held from w),
       r as (select name, regexp_replace(name, '\\.md$', '') as stem, row_number() over (partition by name) as r from o where held or nth > 1),
       f as (select stem, k, row_number() over (partition by stem order by k) as r from (select distinct stem from r) s, generate_series(2, 5000) g(k) where not exists (select 1 from w where w.name = stem || '-' || k || '.md') and not exists (select 1 from t where t.name = stem || '-' || k || '.md'))
       select name, name as free from o where not held and nth = 1 union all select r.name, r.stem || '-' || f.k || '.md' from r join f using (stem, r)""".replace("\\\\", "\\"),
)
def q_free_names(spark, d):
    text = lambda c: F.col(c).cast("string")
    pages = table(spark, d, "pages").select(F.concat(F.lit("p"), (F.col("page_id") % 97).cast("string"), F.lit(".md")).alias("name"))
    docs = table(spark, d, "documents").select(F.concat(F.lit("p"), (F.col("doc_id") % 97).cast("string"), F.lit("-"), (F.col("doc_id") % 4 + 2).cast("string"), F.lit(".md")).alias("name"))
    part = F.when(F.col("conv_id") % 3 == 0, "").otherwise(F.concat(F.lit("-"), (F.col("conv_id") % 7).cast("string")))
    taken = table(spark, d, "conversations").select(F.concat(F.lit("p"), (F.col("conv_id") % 80).cast("string"), part, F.lit(".md")).alias("name")).distinct()
    return sinks.free_names(pages.unionByName(docs), taken).select(text("name").alias("name"), text("free").alias("free"))
