"""Evidence, text, view, statistics, audit, alignment, pressure and structure over the plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.udfs import text_math
from ..operators import align, audit, evidence, gates, marks, pressure, stats, structure, view
from ..sources.tables import blocks, table
from .registry import query, sql


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.with_hash(blocks(table(spark, sf_dir, "documents")))


# ---- evidence


@query("block_stream", sql("blocks", then="select doc, pos, page_seq, sequence_index, block_ref, label, provider_block_order, sha256(content) as content_sha256 from blocks"))
def q_stream(spark, d):
    return _blocks(spark, d).select("doc", "pos", "page_seq", "sequence_index", "block_ref", "label", "provider_block_order", "content_sha256")


@query("label_histogram", sql("blocks", then="select label, count(*) as n from blocks group by label"))
def q_labels(spark, d):
    return stats.label_histogram(_blocks(spark, d))


@query(
    "order_consistency",
    sql(
        "blocks",
        then="""
        , k as (select *, lag(provider_block_order) over (partition by doc, page_seq order by sequence_index) as before from blocks where provider_block_order is not null),
        f as (select doc, page_seq, count(*) as ordered_blocks, cast(count_if(provider_block_order < before) as bigint) as conflicts from k group by all)
        select b.doc, b.page_seq, count(*) as blocks, coalesce(any_value(f.ordered_blocks), 0) as ordered_blocks, coalesce(any_value(f.conflicts), 0) as conflicts, coalesce(any_value(f.conflicts), 0) = 0 as monotonic
        from blocks b left join f on b.doc = f.doc and b.page_seq = f.page_seq group by b.doc, b.page_seq""",
    ),
)
def q_order(spark, d):
    return evidence.order_consistency(_blocks(spark, d))


STATS = """
  , pages as (select doc, page_seq, count(*) as n from blocks group by all)
  select doc, (select count(*) from pages p where p.doc = b.doc) as pages, count(*) as blocks, count(distinct label) as labels, count(provider_block_order) as ordered,
         cast(count_if(label in ('image', 'chart')) as bigint) as images, cast(count_if(label in ('display_formula', 'inline_formula', 'formula_number')) as bigint) as formulas,
         (select min(n) from pages p where p.doc = b.doc) as blocks_per_page_min, (select max(n) from pages p where p.doc = b.doc) as blocks_per_page_max,
         round((count(*) - count(provider_block_order)) / count(*), 4) as order_null_ratio
  from blocks b group by doc"""


@query("document_stats", sql("blocks", then=STATS))
def q_stats(spark, d):
    return stats.per_document(_blocks(spark, d))


@query("order_null_ratio", sql("blocks", then="select doc, round((count(*) - count(provider_block_order)) / count(*), 4) as order_null_ratio from blocks group by doc"))
def q_ratio(spark, d):
    return stats.per_document(_blocks(spark, d)).select("doc", "order_null_ratio")


@query("corpus_block_percentiles", sql("blocks", then="select count(*) as documents, cast(sum(n) as bigint) as blocks, min(n) as blocks_min, cast(trunc(quantile_cont(n, 0.5)) as bigint) as blocks_median, max(n) as blocks_max from (select doc, count(*) as n from blocks group by doc)"))
def q_corpus(spark, d):
    return stats.corpus_blocks(_blocks(spark, d))


@query(
    "nearest_rank_percentiles",
    sql("blocks", then="""select l[cast(round_even(0.5 * (len(l) - 1), 0) as int) + 1] as p50, l[cast(round_even(0.9 * (len(l) - 1), 0) as int) + 1] as p90, l[cast(round_even(0.95 * (len(l) - 1), 0) as int) + 1] as p95
        from (select list_sort(list(n)) as l from (select doc, count(*) as n from blocks group by doc))"""),
)
def q_nearest(spark, d):
    per = _blocks(spark, d).groupBy("doc").agg(F.count("*").alias("n"))
    return stats.nearest_rank_of(per, "n", {"p50": 0.5, "p90": 0.9, "p95": 0.95})


@query(
    "evidence_content_hash",
    sql("blocks", then="""select doc, sha256(string_agg(case when sequence_index = 0 then 'P' || page_seq || '|None' || chr(10) else '' end
        || 'B' || sequence_index || '|' || coalesce(cast(provider_block_order as varchar), 'None') || '|' || label || '|' || sha256(content) || chr(10), '' order by pos)) as content_hash from blocks group by doc"""),
)
def q_hash(spark, d):
    return evidence.content_hash(_blocks(spark, d))


@query(
    "extraction_loss",
    sql("blocks", then="""select doc, cast(sum(case when (doc + page_seq) % 50 = 0 then 1 else 0 end) as bigint) as loss, cast(count_if((doc + page_seq) % 50 = 0) as bigint) as pages_differing
        from (select distinct doc, page_seq from blocks) group by doc"""),
)
def q_extraction(spark, d):
    own = _blocks(spark, d)
    raw = own.groupBy("doc", "page_seq").agg((F.count("*") + F.max(F.when((F.col("doc") + F.col("page_seq")) % 50 == 0, 1).otherwise(0))).alias("raw_count"))
    return gates.extraction_loss(own, raw)


@query("unfinished_documents", "select doc_id, lang from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def q_unfinished(spark, d):
    return evidence.unfinished(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])


@query("resume_status", "select d.doc_id, case when l.doc_id is null then 'todo' else 'skipped' end as status, case when l.doc_id is not null then 'evidence_exists' end as reason from documents d left join (select distinct doc_id from labels) l on d.doc_id = l.doc_id")
def q_resume(spark, d):
    return evidence.with_skipped(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query("output_conflicts", "select regexp_extract(url, '://([^/]*)', 1) as target, count(distinct url) as sources from pages group by 1 having count(distinct url) > 1")
def q_conflicts(spark, d):
    return evidence.output_conflicts(table(spark, d, "pages"), "url", F.regexp_extract("url", "://([^/]*)", 1))


@query(
    "missing_link_targets",
    """with l as (select distinct page_id as doc, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as src from pages)
       select doc, src from l where not starts_with(lower(src), 'data:') and not exists (select 1 from pages p where p.page_id = l.doc and p.url = l.src)""",
)
def q_missing(spark, d):
    pages = table(spark, d, "pages")
    return evidence.missing_images(pages.select(F.col("page_id").alias("doc"), F.col("html").alias("content")), pages.select(F.col("page_id").alias("doc"), F.col("url").alias("src")), 'href="([^"]*)"')


# ---- text


MAGIC_ROWS = [("FFD8FFE000104A46",), ("89504E470D0A1A0A0000",), ("474946383961",), ("424D7A00",), ("49492A00",), ("524946460000000057454250",), ("25504446",), (None,)]


@query(
    "image_magic_format",
    """select hexed, case when hexed is null then null when left(hexed, 8) = '52494646' and substr(hexed, 17, 8) = '57454250' then 'webp' when starts_with(hexed, 'FFD8FF') then 'jpeg' when starts_with(hexed, '89504E470D0A1A0A') then 'png'
       when starts_with(hexed, '474946383761') or starts_with(hexed, '474946383961') then 'gif' when starts_with(hexed, '424D') then 'bmp' when starts_with(hexed, '49492A00') or starts_with(hexed, '4D4D002A') then 'tiff' end as format
       from (values ('FFD8FFE000104A46'), ('89504E470D0A1A0A0000'), ('474946383961'), ('424D7A00'), ('49492A00'), ('524946460000000057454250'), ('25504446'), (null)) v(hexed)""",
)
def q_magic(spark, d):
    return spark.createDataFrame(MAGIC_ROWS, "hexed string").select("hexed", T.image_format(F.col("hexed")).alias("format"))


@query("redact_urls", "select page_id, case when regexp_matches(lower(trim(url)), '^(https?://|data:)') then '<<remote:' || left(sha256(trim(url)), 16) || '>>' else url end as url from pages")
def q_redact(spark, d):
    return table(spark, d, "pages").select("page_id", T.redact_remote(F.col("url")).alias("url"))


@query(
    "secret_candidates",
    r"""select doc_id, word from (select doc_id, case when length(w) >= 9 then 'K9' || w || sha256(w) when length(w) = 8 then w || sha256(w) else w end as word from (select doc_id, unnest(string_split_regex(text, '\s+')) as w from documents))
        where length(word) >= 32 and regexp_matches(word, '[A-Za-z0-9_-]{32,}') and regexp_matches(word, '[A-Z]') and regexp_matches(word, '[a-z]') and regexp_matches(word, '[0-9]')""",
)
def q_secret(spark, d):
    """Words, the long ones made to look like keys: with an upper-case letter and a digit, or, at eight characters, only what they have."""
    w, size = F.col("w"), F.length("w")
    word = F.when(size >= 9, F.concat(F.lit("K9"), w, F.sha2("w", 256))).when(size == 8, F.concat(w, F.sha2("w", 256))).otherwise(w)
    words = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", r"\s+")).alias("w")).select("doc_id", word.alias("word"))
    return words.filter(T.looks_secret(F.col("word")))


@query("safe_paths", r"""select page_id, array_to_string(list_filter(string_split(replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '\', '/'), '/'), lambda p: p not in ('', '.', '..')), '/') as path from pages""")
def q_safe(spark, d):
    return table(spark, d, "pages").select("page_id", T.safe_path(F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)).alias("path"))


@query("trailing_space_clean", r"""select doc_id, sha256(regexp_replace(text, '[ \t\r\f\v]+(\n|$)', '\1', 'g')) as clean from documents""")
def q_trailing(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.rstrip_lines(F.col("text")), 256).alias("clean"))


@query("newline_styles", "select doc_id, case when (length(text) - length(replace(text, chr(13) || chr(10), ''))) / 2 > 0 and (length(text) - length(replace(text, chr(13) || chr(10), ''))) >= (length(text) - length(replace(text, chr(10), ''))) then 'CRLF' else 'LF' end as style from documents")
def q_newlines(spark, d):
    return table(spark, d, "documents").select("doc_id", T.newline_style(F.col("text")).alias("style"))


SWAPPED = "translate(text, ',.:;!?()', '，。：；！？（）')"


@query("char_map", f"select doc_id, sha256(translate({SWAPPED}, '，。：；！？（）ªº', ',.:;!?()ao')) as folded from documents")
def q_map(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.fold_characters(F.expr(SWAPPED)), 256).alias("folded"))


@query("punctuation_spacing_lines")
def q_spacing_lines(spark, d):
    """All lines, those with periods too: SQL without look-around can't express N-06."""
    own = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "content"))
    return own.select("doc_id", F.col("pos").cast("long").alias("pos"), T.space_punctuation(F.col("content")).alias("spaced"))


@query("numeric_literals", "select doc_id, count(*) as n from (select doc_id, unnest(string_split(text, ' ')) as w from documents) where regexp_matches(trim(w, ' ' || chr(9) || chr(10) || chr(13)), '^[+-]?[0-9,]+([.][0-9]+)?%?$') group by doc_id")
def q_numeric(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return words.filter(T.is_numeric_literal(F.col("w"))).groupBy("doc_id").agg(F.count("*").alias("n"))


BALANCED = r"""case pos % 4 when 0 then '$\left( ' || bare || ' \right)$' when 1 then '$\left( ' || bare || '$ and $\right)$' when 2 then '$a \rightarrow ' || bare || '$' else bare end"""


@query(
    "left_right_balance",
    sql("blocks", then=rf""", t as (select doc, pos, {BALANCED} as t from (select doc, pos, replace(content, '$', '') as bare from blocks)),
        m as (select doc, pos, unnest(regexp_extract_all(t, '\$([^$\n]*)\$', 1)) as e from t)
        select t.doc, t.pos, exists (select 1 from m where m.doc = t.doc and m.pos = t.pos and len(regexp_extract_all(e, '\\left([^a-z]|$)')) <> len(regexp_extract_all(e, '\\right([^a-z]|$)'))) as unbalanced from t"""),
)
def q_balance(spark, d):
    """Every line, in one of four dresses."""
    bare = blocks(table(spark, d, "documents")).select("doc", "pos", F.replace("content", F.lit("$"), F.lit("")).alias("bare"))
    return bare.select("doc", "pos", T.unbalanced_left_right(F.expr(BALANCED.replace("\\", "\\\\"))).alias("unbalanced"))


for _name, _pattern in (("html_tag_counts", "</?[A-Za-z][^<>]*>"), ("url_counts", "(https?|ftp)://[^ \\t\\r\\n<>()\"'\\[\\]]+"), ("comment_counts", "<!--[^>]*-->")):
    query(_name, f"""select page_id, cast(len(regexp_extract_all(html, '{_pattern.replace("'", "''")}')) as int) as n from pages""")(
        lambda spark, d, p=_pattern: table(spark, d, "pages").select("page_id", F.regexp_count("html", F.lit(p)).alias("n"))
    )


MARKED = """case pos % 7 when 0 then '##' when 1 then '### 解题' when 2 then '# 题 目' when 3 then '<img src="a/header_1.png">' when 4 then '# Title ' || doc else content end"""


@query(
    "ocr_marks",
    sql("blocks", then=r"""select doc, cast(pos + 1 as int) as line, case pos % 7 when 0 then 'R5' when 1 then 'R3' when 2 then 'R2' when 3 then 'R4' end as rule,
        case pos % 7 when 0 then '##' when 1 then '解题' when 2 then '题 目' when 3 then '<img src="a/header_1.png">' end as content from blocks where pos % 7 < 4
        union all select doc, cast(pos + 1 as int), 'R5', content from blocks where pos % 7 > 4 and regexp_matches(content, '^#{1,6}\s*$')"""),
)
def q_marks(spark, d):
    """Lines of documents, four of seven made into what the rules look for."""
    own = blocks(table(spark, d, "documents")).select("doc", "pos", F.expr(MARKED).alias("line"))
    texts = own.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return marks.marks(texts)


# ---- view


@query("profile_dispatch", sql("blocks", then="select label, case when label = 'text' then 'text_math' when label in ('display_formula', 'inline_formula') then 'formula_canonical' else 'preserve' end as profile, count(*) as n from blocks group by all"))
def q_profile(spark, d):
    return _blocks(spark, d).groupBy("label", view.profile(F.col("label")).alias("profile")).agg(F.count("*").alias("n"))


def _plain(c):
    """A normalizer in plain expressions: one blank after marks."""
    return F.struct(F.regexp_replace(c, r"([,!?:;])(?=[^\s])", "$1 ").alias("text"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("stable"))


VIEW = r"""
  , v as (select doc, label, content, case when label = 'text' then regexp_replace(regexp_replace(content, '([,!?:;])([^\s])', '\1 \2', 'g'), '([,!?:;])([^\s])', '\1 \2', 'g')
                                     when label in ('display_formula', 'inline_formula') then trim(content, ' ' || chr(9) || chr(13)) end as new from blocks),
  s as (select *, case when new is not null and new <> content then 'changed' else 'unchanged' end as status from v)"""


@query(
    "view_status_summary",
    sql("blocks", then=VIEW + """ select label, count(*) as blocks, cast(count_if(status = 'changed') as bigint) as changed, cast(count_if(status = 'unchanged') as bigint) as unchanged, cast(0 as bigint) as fatal, cast(0 as bigint) as preserved,
        cast(count_if(status = 'changed' and label <> 'text') as bigint) as cosmetic, cast(count_if(status = 'changed' and label = 'text') as bigint) as substantive, cast(0 as bigint) as idempotence_failures from s group by label"""),
)
def q_summary(spark, d):
    return view.summarize(view.normalized(_blocks(spark, d), _plain), ["label"])


@query("view_rollup", sql("blocks", then=VIEW + " select doc, count(*) as blocks, cast(count_if(status = 'changed') as bigint) as changed, cast(0 as bigint) as fatal from s group by rollup(doc)"))
def q_rollup(spark, d):
    return view.rollup(view.normalized(_blocks(spark, d), _plain))


@query("window_payload", sql("blocks", then=VIEW.replace("select doc, label", "select doc, block_ref, sequence_index, label") + r""" select doc, block_ref, status as normalization_status, concat_ws('|', 'label:' || label, 'normalization:' || status, case when sequence_index = 0 then 'page_start' end,
   case when label in ('display_formula', 'inline_formula') then 'formula_block' end, case when regexp_matches(content, '\$[^$]+\$') then 'has_math_env' end) as signals from s"""))  # fmt: skip
def q_payload(spark, d):
    out = view.payload(view.normalized(_blocks(spark, d), _plain))
    return out.select("doc", "block_ref", "normalization_status", F.array_join("signals", "|").alias("signals"))


@query("text_math_status")
def q_text_math(spark, d):
    """Lines of documents by what the normalizer of mathematics makes of them; each different text once."""
    own = _blocks(spark, d).filter("label = 'text' and content <> ''")
    texts = own.groupBy("content_sha256").agg(F.any_value("content").alias("content"), F.count("*").alias("n"))
    got = texts.select("n", "content", text_math(F.col("content")).alias("t"))
    status = F.when(F.col("t.error").isNotNull(), "fatal").when(F.col("t.text") == F.col("content"), "unchanged").otherwise("changed")
    return got.groupBy(status.alias("status")).agg(F.sum("n").alias("blocks"), F.count("*").alias("texts"))


# ---- audit


@query("diff_buckets_normalized")
def q_buckets_normalized(spark, d):
    """Every line against what the normalizer of mathematics makes of it (itself, where that fails), by the operator's five buckets; each different line once."""
    texts = _blocks(spark, d).groupBy("content_sha256").agg(F.any_value("content").alias("raw"), F.count("*").alias("n"))
    got = texts.select("n", "raw", F.coalesce(text_math(F.col("raw"))["text"], F.col("raw")).alias("new"))
    return got.groupBy(audit.classify(F.col("raw"), F.col("new")).alias("bucket")).agg(F.sum("n").alias("n"))


CASES = [(1, "x=1", "$x=1$"), (2, "the year 1999", "$the$ year $1999$"), (3, "n 10", "n $10$"), (4, "a，b", "$a$, $b$"), (5, "a b", "a b"), (6, "x，y", "$x$,$z$")]


@query("diff_classes", "select * from (values (1, 'WRAP_MATH_ONLY', 0), (2, 'HIGH_RISK', 1), (3, 'HIGH_RISK', 1), (4, 'PUNCTUATION_ONLY', 0), (5, 'OTHER', 0), (6, 'MIXED', 0)) v(id, bucket, gain)")
def q_classes(spark, d):
    return spark.createDataFrame(CASES, "id int, raw string, new string").select("id", audit.classify(F.col("raw"), F.col("new")).alias("bucket"), audit.numeric_wrap_gain(F.col("raw"), F.col("new")).alias("gain"))


NUMERIC = r"^[+-]?[0-9,]+(\.[0-9]+)?%?$"


@query(
    "numeric_wrap_bag_diff",
    sql("blocks", then=rf""", w as (select doc, pos, list_filter(regexp_extract_all(content, '\$([^$\n]*)\$', 1), lambda x: regexp_matches(trim(x, ' '), '{NUMERIC}')) as old,
             list_filter(regexp_extract_all(regexp_replace(content, '([0-9]+)', '$\1$', 'g'), '\$([^$\n]*)\$', 1), lambda x: regexp_matches(trim(x, ' '), '{NUMERIC}')) as new from blocks)
        select doc, pos, cast(coalesce(list_sum(list_transform(list_distinct(new), lambda v: greatest(len(list_filter(new, lambda x: x = v)) - len(list_filter(old, lambda x: x = v)), 0))), 0) as int) as gain from w"""),
)
def q_bag(spark, d):
    """Every line against itself with its numbers wrapped."""
    new = F.regexp_replace("content", "([0-9]+)", r"\$$1\$")
    return blocks(table(spark, d, "documents")).select("doc", "pos", audit.numeric_wrap_gain(F.col("content"), new).alias("gain"))


LCP = "coalesce((select min(i) from generate_series(1, cast(least(length(a), length(b)) as int)) g(i) where a[i] <> b[i]) - 1, least(length(a), length(b)))"


@query("edit_distance_lcp", f"select page_id, length(a) + length(b) - 2 * {LCP} as distance from (select p.page_id, p.url as a, o.url as b from pages p join pages o on o.page_id = p.page_id - 1)")
def q_lcp(spark, d):
    pages = table(spark, d, "pages")
    before = pages.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("b"))
    return pages.select("page_id", F.col("url").alias("a")).join(before, "page_id").select("page_id", audit.distance(F.col("a"), F.col("b")).alias("distance"))


BUCKETED = "case doc_id % 5 when 0 then 'HIGH_RISK' when 1 then 'WRAP_MATH_ONLY' when 2 then 'PUNCTUATION_ONLY' when 3 then 'MIXED' else 'OTHER' end"


@query(
    "stratified_sample",
    f"""with b as (select doc_id as doc, 'p0000:b0000' as block_ref, n_chars as distance, {BUCKETED} as bucket from documents),
        q(bucket, quota) as (values ('HIGH_RISK', 30), ('WRAP_MATH_ONLY', 10), ('PUNCTUATION_ONLY', 10), ('MIXED', 10), ('OTHER', 0)),
        s as (select sum(greatest(quota - coalesce(n, 0), 0)) as spill from q left join (select bucket, count(*) as n from b group by bucket) c using (bucket) where bucket <> 'HIGH_RISK'),
        r as (select *, cast(row_number() over (partition by bucket order by distance desc, doc, block_ref) as int) as rank from b)
        select doc, block_ref, distance, bucket, rank from r join q using (bucket), s where rank <= quota + case when bucket = 'HIGH_RISK' then spill else 0 end""",
)
def q_sample(spark, d):
    own = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.lit("p0000:b0000").alias("block_ref"), F.col("n_chars").alias("distance"), F.expr(BUCKETED).alias("bucket"))
    return audit.sample(own)


# ---- alignment


SQUEEZE = r"regexp_replace(translate({}, '，。：；（）', ',.:;()'), '\s+', '', 'g')"
ALIGN = f"""
  , q as (select item_id as question, {SQUEEZE.format("text")} as t from benchmark),
  p as (select question, k as rank, left(t, n) as probe from q, (values (0, 40), (1, 28), (2, 20), (3, 14)) v(k, n) where length(left(t, n)) >= 6),
  b as (select doc, pos, {SQUEEZE.format("content")} as s from blocks),
  hit as (select p.question, p.rank, b.doc, b.pos from p join b on contains(b.s, p.probe)),
  st as (select question, doc, cast(min(rank * 1000000 + pos) % 1000000 as int) as start, case when min(rank) = 0 then 'exact' else 'approximate' end as confidence from hit group by question, doc)"""


def _questions(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("question"), F.col("text").alias("statement"))


@query("align_benchmark", sql("blocks", then=ALIGN + " select * from st"))
def q_align(spark, d):
    return align.starts(_questions(spark, d), _blocks(spark, d))


SPANS = ", sz as (select doc, cast(count(*) as int) as n from blocks group by doc), sp as (select st.*, coalesce(lead(start) over (partition by st.doc order by question), n) as next_start from st join sz on st.doc = sz.doc)"


@query("alignment_spans", sql("blocks", then=ALIGN + SPANS + " select question, doc, start, confidence, next_start, greatest(1, next_start - start) as span from sp"))
def q_spans(spark, d):
    own = _blocks(spark, d)
    return align.spans(align.starts(_questions(spark, d), own), own.groupBy("doc").agg(F.count("*").cast("int").alias("n"))).select("question", "doc", "start", "confidence", "next_start", "span")


@query(
    "alignment_anomalies",
    sql("blocks", then=ALIGN + SPANS + """
        , held as (select sp.question, sp.doc, b.label, b.page_seq from sp join blocks b on b.doc = sp.doc and b.pos >= sp.start and b.pos < sp.next_start where next_start - start > 5)
        select question, doc, case when bool_or(label = 'number') then 'ALIGNMENT_DRIFT' when min(page_seq) <> max(page_seq) then 'CROSS_PAGE' else 'REAL_LONG_PROBLEM' end as reason from held group by question, doc"""),
)
def q_anomalies(spark, d):
    own = _blocks(spark, d)
    spans = align.spans(align.starts(_questions(spark, d), own), own.groupBy("doc").agg(F.count("*").cast("int").alias("n")))
    return align.long_spans(spans, own, 5)


LATER = """
  , w as (select question, t, unnest([60, 40, 24]) as n from q where not exists (select 1 from st where st.question = q.question)),
  cut as (select distinct question, substr(t, cast(o as int) + 1, n) as probe from (select question, t, n, unnest(generate_series(0, greatest(length(t) - n - 1, 0), n // 2)) as o from w)),
  later as (select distinct question from cut join b on contains(b.s, cut.probe) where length(probe) >= 12)"""


@query("alignment_failures", sql("blocks", then=ALIGN + LATER + " select question, case when t = '' then 'SOLUTION_BLEED' when exists (select 1 from later where later.question = q.question) then 'OCR_CONTENT_VARIATION' else 'ALIGNMENT_ALGORITHM_LIMIT' end as reason from q where not exists (select 1 from st where st.question = q.question)"))
def q_failures(spark, d):
    own = _blocks(spark, d)
    questions = _questions(spark, d)
    return align.failures(questions, align.starts(questions, own), own)


# ---- pressure

TEXTS = ["", "HTTP 429 returned", "status: 503", "queue is full, code 10010", "daily submit limit reached", "quota exceeded for key", "No module named x", "rate limit hit", "all good", "code 12002"]
STATUS = "case event_type when 'error' then [" + ", ".join(f"'{t}'" for t in TEXTS) + "][cast(event_id % 10 as int) + 1] else 'ok' end"
VERDICT = f"""with t as (select event_id, lower({STATUS}) as t from events),
  v as (select event_id, case when trim(t) = '' then 'NONE|other|' when contains(t, 'quota exceeded') then 'QUOTA_EXHAUSTED|quota_exhausted|quota exceeded'
     when contains(t, 'daily submit limit') then 'QUOTA_EXHAUSTED|quota_exhausted|daily submit limit' when contains(t, 'http 429') then 'REMOTE_BACKPRESSURE|http_429|HTTP 429'
     when contains(t, 'status: 503') then 'REMOTE_BACKPRESSURE|http_503|HTTP 503/504' when contains(t, '10010') then 'REMOTE_BACKPRESSURE|queue_full|code 10010' when contains(t, '12002') then 'REMOTE_BACKPRESSURE|rate_limit|code 12002'
     when contains(t, 'rate limit') then 'REMOTE_BACKPRESSURE|rate_limit|rate limit' when contains(t, 'no module named') then 'LOCAL_ENVIRONMENT|other|no module named' else 'NONE|other|' end as v from t)"""


def _verdicts(spark, d):
    texts = F.array(*[F.lit(t) for t in TEXTS])
    text = F.when(F.col("event_type") == "error", F.element_at(texts, (F.col("event_id") % 10 + 1).cast("int"))).otherwise("ok")
    return table(spark, d, "events").select("event_id", pressure.classify(text).alias("v")).select("event_id", "v.kind", "v.reason", "v.evidence")


@query("pressure_verdicts", VERDICT + " select event_id, split_part(v, '|', 1) as kind, split_part(v, '|', 2) as reason, split_part(v, '|', 3) as evidence from v")
def q_verdicts(spark, d):
    return _verdicts(spark, d)


@query("pressure_stats", VERDICT + " select split_part(v, '|', 1) as kind, split_part(v, '|', 2) as reason, count(*) as n from v group by all")
def q_pressure(spark, d):
    return pressure.statistics(_verdicts(spark, d))


def _events(spark, d):
    order = F.struct("ts", "event_id")
    delta = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    return table(spark, d, "events").select(F.col("user_id").alias("key"), F.struct(F.col("ts"), F.col("event_id")).alias("seq"), delta.alias("delta"))


@query(
    "backoff_levels",
    """with recursive e as (select user_id as key, event_id, case event_type when 'error' then 1 when 'purchase' then -1 else 0 end as d, row_number() over (partition by user_id order by ts, event_id) as k from events),
       f as (select key, event_id, k, least(greatest(d, 0), 5) as level from e where k = 1
             union all select e.key, e.event_id, e.k, least(greatest(f.level + e.d, 0), 5) from f join e on e.key = f.key and e.k = f.k + 1)
       select key, event_id, cast(level as int) as level, cast([0, 5, 10, 20, 40, 60][level + 1] as int) as cooldown from f""",
)
def q_backoff(spark, d):
    events = _events(spark, d).select("key", F.struct(F.unix_micros(F.col("seq.ts").cast("timestamp")).alias("at"), F.col("seq.event_id").alias("id")).alias("seq"), "delta")
    flat = events.select("key", F.format_string("%020d:%012d", "seq.at", "seq.id").alias("seq"), "delta")
    out = pressure.levels(flat)
    return out.select("key", F.split("seq", ":")[1].cast("long").alias("event_id"), "level", "cooldown")


@query("schedule_simulation")
def q_schedule(spark, d):
    jobs = table(spark, d, "events").select(F.col("user_id").alias("schedule"), F.col("event_id").alias("job"), (F.col("event_id") % 7 + 1).cast("double").alias("duration"), (F.col("event_type") == "error").alias("pressure"))
    return pressure.simulate(jobs, workers=2, spacing=0.5)


# ---- structure


@query("json_key_paths", "select path, count(*) as n from (select unnest(json_keys(props)) as path from events) group by path")
def q_paths(spark, d):
    return structure.flat_keys(table(spark, d, "events"), "props")


@query("json_type_profile", "select path, case json_type(props, '$.' || path) when 'UBIGINT' then 'int' when 'BIGINT' then 'int' when 'DOUBLE' then 'float' when 'VARCHAR' then 'str' when 'BOOLEAN' then 'bool' when 'NULL' then 'null' when 'OBJECT' then 'object' else 'array' end as type, count(*) as n from (select props, unnest(json_keys(props)) as path from events) group by all")
def q_types(spark, d):
    return structure.flat_types(table(spark, d, "events"), "props")


@query("json_scrubbed", "select event_id, '{\"token\": \"<<redacted>>\", \"k\": ' || json_extract_string(props, '$.k') || '}' as clean from events")
def q_scrubbed(spark, d):
    raw = F.concat(F.lit('{"token": "abc", "k": '), F.get_json_object("props", "$.k"), F.lit("}"))
    return table(spark, d, "events").select("event_id", structure.scrubbed(raw).alias("clean"))
