"""Queries of what is asked for and where it lies: inputs, problems, targets, artifacts; a document's summary with geometry, assets and loss."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates, stats
from ..sources import inputs
from ..sources.tables import blocks, table
from .keeping import RAW, raw
from .registry import query, sql

#: A catalogue of files, one a page, in folders by host, and what is asked for: files, folders, names in another case, a folder of folders.
PATHS = """paths as (select page_id as place, 'in/' || coalesce(regexp_extract(url, '://([^/:?#]*)', 1), '') || case when page_id % 4 = 0 then '/old' else '' end as folder,
      case when page_id % 5 = 0 then '/P' else '/p' end || cast(page_id // 4 as varchar) || case page_id % 3 when 0 then '.pdf' when 1 then '.MD' else case when page_id % 2 = 0 then '.revised.md' else '.html' end end as file from pages),
  asked as (select place, case place % 6 when 0 then folder || file when 1 then folder || '/' when 2 then upper(folder || file) when 3 then 'in' when 4 then folder || '/old' end as name from paths),
  files as (select distinct folder || file as path, folder, lower(regexp_extract(file, '(\\.[^.]+)$', 1)) in ('.pdf', '.md') as fits, contains(file, '.revised.') as made from paths),
  keys as (select place, name, rtrim(name, '/') as key from asked where name is not null)"""


def catalogue(spark, d):
    """place, folder, path of a file a page."""
    number = F.col("page_id")
    folder = F.concat(F.lit("in/"), F.coalesce(F.regexp_extract("url", "://([^/:?#]*)", 1), F.lit("")), F.when(number % 4 == 0, "/old").otherwise(""))
    last = F.when(number % 3 == 0, ".pdf").when(number % 3 == 1, ".MD").when(number % 2 == 0, ".revised.md").otherwise(".html")
    file = F.concat(F.when(number % 5 == 0, "/P").otherwise("/p"), F.floor(number / 4).cast("string"), last)
    return table(spark, d, "pages").select(number.alias("place"), folder.alias("folder"), F.concat(folder, file).alias("path"))


def asked(files):
    turn = F.col("place") % 6
    name = F.when(turn == 0, F.col("path")).when(turn == 1, F.concat("folder", F.lit("/"))).when(turn == 2, F.upper("path")).when(turn == 3, "in").when(turn == 4, F.concat("folder", F.lit("/old")))
    return files.select("place", name.alias("name"))


COLLECTED = """, met as (select k.place, f.path from keys k join files f on f.path = k.key and f.fits union all select k.place, f.path from keys k join files f on f.folder = k.key and f.fits and not f.made)
  select place, path from met qualify row_number() over (partition by lower(path) order by place, path) = 1"""


@query("collected_inputs", "with " + PATHS + COLLECTED)
def q_collected(spark, d):
    files = catalogue(spark, d)
    return inputs.collected(asked(files), files, inputs.BOTH, r"\.revised$")


@query(
    "input_problems",
    "with " + PATHS + """, good as (select path as key from files where fits union select folder from files where fits and not made),
  folders as (select folder as key from files union select regexp_replace(folder, '/old$', '') from files union select 'in' from files)
  select place, name, case when key in (select path from files) then 'other_suffix' when key in (select key from folders) then 'no_files' else 'absent' end as problem from keys where key not in (select key from good)""",
)
def q_problems(spark, d):
    files = catalogue(spark, d)
    return inputs.problems(asked(files), files, inputs.BOTH, r"\.revised$")


@query("first_targets", "with " + PATHS + " select path from files where folder = (select min(folder) from files where not contains(folder, '/old')) and regexp_matches(path, '/p[^/]*[0-4]\\.(pdf|MD)$') order by path limit 20")
def q_targets(spark, d):
    """The first twenty files of the first host's folder that a pattern takes: a trial run's limit is the feature."""
    files = catalogue(spark, d)
    folder = files.filter("not contains(folder, '/old')").agg(F.min("folder")).first()[0]
    return inputs.targets(files, folder or "", "p*[0-4].[pM][dD]*", 20)


@query(
    "artifact_places",
    """with e as (select page_id, case page_id % 3 when 0 then 'in/d' || page_id || '_prework/evidence.json' when 1 then 'in/d' || page_id || '.evidence.json' else 'in/d' || page_id || '/evidence.json' end as path from pages),
  p as (select *, regexp_replace(path, '/[^/]*$', '') as folder, page_id % 3 = 0 as new from e)
  select page_id, path, case when new then folder || '/normalized-view.json' else replace(path, '.evidence.json', '.normalized.json') end as view,
    case when new then folder || '/raw' else replace(path, '.evidence.json', '') || '_raw' end as raw, case when new then folder || '/semantic' else folder end as semantic,
    case when new then folder || '/diagnostics' else folder end as diagnostics, case when new then folder end as prework from p""",
)
def q_places(spark, d):
    number = F.col("page_id").cast("string")
    stem = F.concat(F.lit("in/d"), number)
    path = F.when(F.col("page_id") % 3 == 0, F.concat(stem, F.lit("_prework/evidence.json"))).when(F.col("page_id") % 3 == 1, F.concat(stem, F.lit(".evidence.json"))).otherwise(F.concat(stem, F.lit("/evidence.json")))
    own = table(spark, d, "pages").select("page_id", path.alias("path"))
    return own.select("*", *[inputs.beside(F.col("path"), k).alias(k) for k in ("view", "raw", "semantic", "diagnostics")], inputs.prework(F.col("path")).alias("prework"))


#: Blocks have a box but for headers (an empty one) and footers (none), every third an outline; each image is an asset.
SHAPED = """, shaped as (select *, label not in ('header', 'footer') as boxed, (doc + pos) % 3 = 0 as outlined from blocks),
  back as (select doc, page_seq, provider_block_order < lag(provider_block_order) over (partition by doc, page_seq order by sequence_index) as b from blocks where provider_block_order is not null),
  c as (select doc, page_seq, count_if(b) as conflicts from back group by all),
  per as (select s.doc, s.page_seq, count(*) as blocks, count(provider_block_order) as ordered, count_if(boxed) as boxed, count_if(outlined) as outlined, count_if(label in ('image', 'chart')) as images,
      count_if(label in ('display_formula', 'inline_formula', 'formula_number')) as formulas, any_value(coalesce(c.conflicts, 0)) as conflicts from shaped s left join c on s.doc = c.doc and s.page_seq = c.page_seq group by s.doc, s.page_seq),
  full_pages as (select per.*, k.raw_count, k.raw_count - per.blocks as loss from per left join counted k using (doc, page_seq))"""


def pages(spark, d):
    own = blocks(table(spark, d, "documents"))
    box = F.when(F.col("label") == "header", F.array().cast("array<double>")).when(F.col("label") != "footer", F.array(F.lit(0.0), F.col("pos").cast("double"), F.lit(1.0), F.col("pos") + 1.0))
    outline = F.when((F.col("doc") + F.col("pos")) % 3 == 0, F.array(F.array(F.lit(0.0), F.col("pos").cast("double"))))
    return stats.per_page(own.withColumn("bbox", box).withColumn("polygon", outline), gates.raw_counts(*raw(spark, d)))


@query(
    "document_summary",
    sql("blocks", then=RAW + SHAPED + """, a as (select doc, count(*) as assets, count_if((doc + pos) % 4 < 2) as saved, count_if((doc + pos) % 4 = 2) as missing from blocks where label = 'image' group by doc)
  select p.doc, count(*) as pages, cast(sum(blocks) as bigint) as blocks, min(blocks) as blocks_per_page_min, max(blocks) as blocks_per_page_max, cast(sum(ordered) as bigint) as ordered, cast(sum(conflicts) as bigint) as conflicts,
    cast(count_if(conflicts > 0) as bigint) as pages_out_of_order, cast(sum(images) as bigint) as images, cast(sum(formulas) as bigint) as formulas, count(raw_count) as raw_pages_read, cast(coalesce(sum(loss), 0) as bigint) as loss_blocks,
    count(*) filter (loss <> 0) as pages_with_loss, coalesce(any_value(a.assets), 0) as assets, cast(coalesce(any_value(a.saved), 0) as bigint) as assets_saved, cast(coalesce(any_value(a.missing), 0) as bigint) as assets_missing,
    round((sum(blocks) - sum(ordered)) / sum(blocks), 4) as order_null_ratio, round(sum(boxed) / sum(blocks), 4) as bbox_present_ratio, round(sum(outlined) / sum(blocks), 4) as polygon_present_ratio
  from full_pages p left join a on p.doc = a.doc group by p.doc"""),
)
def q_summary(spark, d):
    images = blocks(table(spark, d, "documents")).filter("label = 'image'")
    kind = F.pmod(F.col("doc") + F.col("pos"), F.lit(4))
    state = F.when(kind < 2, "saved").when(kind == 2, "missing").otherwise("remote")
    return stats.document_summary(pages(spark, d), images.select("doc", state.alias("state")))


@query("pages_with_loss", sql("blocks", then=RAW + SHAPED + " select doc, page_seq, blocks, raw_count, loss from full_pages where loss <> 0"))
def q_pages_with_loss(spark, d):
    return pages(spark, d).filter("loss <> 0").select("doc", "page_seq", "blocks", "raw_count", "loss")
