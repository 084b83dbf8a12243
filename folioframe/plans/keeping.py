"""Queries of reports that are kept up as documents arrive, and of raw pages that were kept in part, and in part broken."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, gates, producer
from ..sources.shared import fresh_path
from ..sources.tables import blocks, table
from ..streaming import reports
from .producing import PAGES, results
from .registry import ORACLE, query, sql


def kept(spark, d):
    """The state after three increments, each taken by a run of its own."""
    arriving, folder, log = (fresh_path(spark, x) for x in ("arriving", "state", "log"))
    documents = table(spark, d, "documents")
    for k in range(3):
        documents.filter(F.pmod("doc_id", F.lit(3)) == k).write.parquet(f"{arriving}/day={k}")
        stream = spark.readStream.schema(documents.schema).option("recursiveFileLookup", True).parquet(arriving)
        reports.keep(blocks(stream), folder, log).awaitTermination()
    return reports.state(spark, folder)


@query("kept_corpus_report", ORACLE["corpus_block_percentiles"])
def q_corpus(spark, d):
    return reports.corpus(kept(spark, d))


@query("kept_label_histogram", sql("blocks", then="select label, count(*) as n from blocks group by label"))
def q_labels(spark, d):
    return reports.labels(kept(spark, d))


@query("kept_nearest_ranks", ORACLE["nearest_rank_percentiles"])
def q_ranks(spark, d):
    return reports.nearest_ranks(kept(spark, d), {"p50": 0.5, "p90": 0.9, "p95": 0.95})


#: What became of a page's raw file: of every third document files are numbered from 1, of some pages there is none, some are cut short, some hold an empty list.
RAW = """, raw as (select doc, page_seq, count(*) as n, case when (doc + page_seq) % 10 = 3 then 'none' when (doc + page_seq) % 10 = 5 then 'cut' when (doc + page_seq) % 10 = 7 then 'empty' else 'whole' end as state from blocks group by doc, page_seq),
  files as (select doc, page_seq + case when doc % 3 = 0 then 1 else 0 end as number, n, state from raw where state <> 'none'),
  counted as (select r.doc, r.page_seq, case when a.state = 'cut' then null when a.state = 'whole' then a.n when a.state = 'empty' then 0 when b.state = 'whole' then b.n when b.state = 'empty' then 0 end as raw_count
              from raw r left join files a on a.doc = r.doc and a.number = r.page_seq left join files b on b.doc = r.doc and b.number = r.page_seq + 1)"""


def raw(spark, d):
    own = results(spark, d).select("doc", "page_seq", "pruned")
    state = F.pmod(F.col("doc") + F.col("page_seq"), F.lit(10))
    text = F.when(state == 5, F.left("pruned", F.length("pruned") - 9)).when(state == 7, F.lit('{"parsing_res_list": []}')).otherwise(F.col("pruned"))
    number = F.col("page_seq") + F.when(F.col("doc") % 3 == 0, 1).otherwise(0)
    return own, own.filter(state != 3).select("doc", number.alias("number"), text.alias("text"))


@query("raw_block_counts", sql("blocks", then=RAW + " select doc, page_seq, raw_count from counted"))
def q_raw_counts(spark, d):
    return gates.raw_counts(*raw(spark, d))


@query("raw_extraction_loss", sql("blocks", then=RAW + ", l as (select c.doc, c.raw_count - r.n as loss from counted c join raw r using (doc, page_seq) where c.raw_count is not null) select doc, cast(sum(loss) as bigint) as loss, cast(count_if(loss <> 0) as bigint) as pages_differing from l group by doc"))
def q_raw_loss(spark, d):
    """Raw counts as they were kept against the blocks of the documents."""
    return gates.extraction_loss(blocks(table(spark, d, "documents")), gates.raw_counts(*raw(spark, d)))


# ---- images in Markdown

TAGGED = PAGES + """, im as (select doc, page_seq, case (doc + page_seq) % 4 when 0 then 'media/imgs/p' || page_seq || '.png' when 3 then 'media/imgs/p' || page_seq || '.jpg' else '/imgs/../p' || page_seq || '.png' end as file from pg),
  tx as (select pg.doc, string_agg(md || chr(10) || '<div><img width="9" src="' || file || '" alt="a"></div> <a src="/imgs/../p' || pg.page_seq || '.png">' || case when pg.page_seq % 2 = 1 then '<img src="/other.png">' else '' end, chr(10) order by pg.page_seq) as md from pg join im on im.doc = pg.doc and im.page_seq = pg.page_seq group by pg.doc)"""


def tagged(spark, d):
    """Results whose pages show their image, in Markdown, once as an image and once not."""
    own, src = results(spark, d), F.map_keys("images")[0]
    tags = F.concat(F.lit('\n<div><img width="9" src="'), src, F.lit('" alt="a"></div> <a src="'), src, F.lit('">'), F.when(F.col("page_seq") % 2 == 1, '<img src="/other.png">').otherwise(""))
    return own.withColumn("markdown_text", F.concat("markdown_text", tags))


def _saved(rows):
    each = rows.select("doc", F.explode("images").alias("src", "value"))
    return producer.image_records(each).filter("state = 'saved'").select("doc", "src", "file")


@query("rewritten_markdown", sql("blocks", then=TAGGED + r" select doc, sha256(regexp_replace(md, '[ \t\r\f\v]+(\n|$)', '\1', 'g')) as markdown from tx"))
def q_rewritten(spark, d):
    rows = tagged(spark, d)
    texts = producer.markdown(producer.page_table(rows)).select("doc", F.col("markdown").alias("content"))
    return evidence.rewritten(texts, _saved(rows)).select("doc", F.sha2("content", 256).alias("markdown"))


@query("converted_markdown", sql("blocks", then=TAGGED + r" select doc, 'ok' as status, sha256(regexp_replace(md, '[ \t\r\f\v]+(\n|$)', '\1', 'g')) as markdown from tx"))
def q_converted(spark, d):
    """What is converted holds its images under the names under which they were saved."""
    rows = tagged(spark, d)
    return producer.convert(rows, rows.select("doc").distinct()).select("doc", "status", F.sha2("markdown", 256).alias("markdown"))
