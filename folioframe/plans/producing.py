"""Provider results made of documents' lines, and what producers, capability reports, prompts and alignment reports make of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align, audit, capability, labels, producer, prompt, windows
from ..sources import sinks
from ..sources.evidence import provider_blocks
from ..sources.tables import blocks, table, turns
from .registry import query, sql
from .structural import ALIGN, SPANS, _plain, _questions

#: How PNG and JPEG files begin.
PNG, JPEG = "89504E470D0A1A0A", "FFD8FFE0"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page of a document's lines as a provider would return it: JSON with blocks, boxes and settings, text and one image."""
    own = blocks(table(spark, sf_dir, "documents"))
    item = F.struct(F.col("pos").alias("block_id"), F.col("provider_block_order").alias("block_order"), F.col("label").alias("block_label"), F.col("content").alias("block_content"), F.lit(0).alias("group_id"))
    pages = own.groupBy("doc", "page_seq").agg(F.array_sort(F.collect_list(F.struct("sequence_index", item.alias("b"), "content"))).alias("own"))
    page = F.col("page_seq")
    boxes = F.transform(F.slice("own", F.lit(1), F.lit(3)), lambda x: F.struct(x["sequence_index"].alias("box")))
    settings = F.when(page == 1, F.struct(F.lit(True).alias("use_doc_preprocessor")))
    pruned = F.struct((page + 600).alias("width"), F.lit(800).alias("height"), F.transform("own", lambda x: x["b"]).alias("parsing_res_list"), F.struct(boxes.alias("boxes")).alias("layout_det_res"), settings.alias("model_settings"))
    kind = (F.col("doc") + page) % 4
    text = F.encode(F.concat(F.lit("page "), page.cast("string")), "UTF-8")
    coded = lambda head: F.base64(F.concat(F.unhex(F.lit(head)), text))
    value = F.when(kind == 0, F.concat(F.lit("data:image/png;base64,"), coded(PNG))).when(kind == 1, F.concat(F.lit("https://images.example.org/"), page.cast("string"))).when(kind == 2, F.base64(text)).otherwise(F.rtrim(coded(JPEG), F.lit("=")))
    return pages.select(
        "doc", "page_seq", F.to_json(pruned, {"ignoreNullFields": "false"}).alias("pruned"), F.array_join(F.transform("own", lambda x: x["content"]), "\n").alias("markdown_text"),
        F.create_map(F.concat(F.lit("/imgs/../p"), page.cast("string"), F.lit(".png")), value).alias("images"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.format_string("in/doc-%d.pdf", "doc_id").alias("filename"), F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("size_bytes"))


PAGES = """, pg as (select doc, page_seq, count(*) as n, string_agg(content, chr(10) order by pos) as md,
     string_agg('B' || sequence_index || '|' || pos || '|' || label || '|' || sha256(content) || chr(10), '' order by pos) as lines from blocks group by doc, page_seq)"""


@query("provider_pages", sql("blocks", then=PAGES + "select doc, page_seq, cast(page_seq + 600 as int) as width, 800 as height, cast(least(n, 3) as int) as boxes, page_seq = 1 as preprocessed, case when page_seq = 1 then '{\"use_doc_preprocessor\":true}' end as settings, sha256(md) as text_sha256 from pg"))
def q_pages(spark, d):
    return producer.page_table(results(spark, d)).select("doc", "page_seq", "width", "height", "boxes", "preprocessed", "settings", F.sha2("markdown_text", 256).alias("text_sha256"))


@query("provider_block_stream", sql("blocks", then="select doc, page_seq, sequence_index, block_ref, pos as provider_block_id, provider_block_order, label, sha256(content) as content_sha256 from blocks"))
def q_provider_blocks(spark, d):
    return provider_blocks(results(spark, d)).select("doc", "page_seq", "sequence_index", "block_ref", "provider_block_id", "provider_block_order", "label", F.sha2("content", 256).alias("content_sha256"))


@query(
    "evidence_documents",
    sql("blocks", then=PAGES + """select doc, 'doc-' || doc || '-' || left(sha256(coalesce(d.text, '')), 8) as document_id, count(*) as page_count, cast(sum(n) as bigint) as block_count,
        sha256(string_agg('P' || page_seq || '|' || (page_seq + 600) || 'x800' || chr(10) || lines || md || chr(10), '' order by page_seq)) as content_hash, case when count(*) > 1 then '{"use_doc_preprocessor":true}' end as settings,
        cast(count_if(page_seq = 1) as bigint) as preprocessed, cast(count_if((doc + page_seq) % 4 < 2) as bigint) as redacted
        from pg join documents d on d.doc_id = pg.doc group by doc, d.text"""),
)
def q_evidence(spark, d):
    out = producer.evidence(results(spark, d), sources(spark, d), {"model": "m1", "provider": "p1", "page_ranges": ""})
    count = lambda f: F.size(F.filter("pages", f)).cast("long")
    preprocessed = count(lambda p: p["coordinate_space"]["kind"] == "preprocessed_page")
    redacted = count(lambda p: F.exists(F.map_values(p["images"]), lambda v: F.startswith(v, F.lit("<<remote:"))))
    return out.select("doc", "document_id", "page_count", F.col("block_count").cast("long").alias("block_count"), "content_hash", "producer.settings", preprocessed.alias("preprocessed"), redacted.alias("redacted"))


IMAGES = f"""select doc, '/imgs/../p' || page_seq || '.png' as src, (doc + page_seq) % 4 as k, encode('page ' || page_seq) as raw, unhex('{PNG}') || encode('page ' || page_seq) as png, unhex('{JPEG}') || encode('page ' || page_seq) as jpg, page_seq from pg"""


@query(
    "image_records",
    sql("blocks", then=PAGES + f""", im as ({IMAGES}) select doc, src, case when k = 1 then 'url' else 'inline' end as kind, case when k in (0, 3) then 'saved' else 'missing' end as state,
        case k when 0 then 'media/imgs/p' || page_seq || '.png' when 3 then 'media/imgs/p' || page_seq || '.jpg' end as file, case k when 0 then 'png' when 3 then 'jpeg' end as format,
        case k when 0 then octet_length(png) when 3 then octet_length(jpg) end as bytes, case k when 0 then sha256(png) when 3 then sha256(jpg) end as sha256, case k when 1 then 'not fetched' when 2 then 'not an image' end as detail from im"""),
)
def q_images(spark, d):
    each = results(spark, d).select("doc", F.explode("images").alias("src", "value"))
    return producer.image_records(each).drop("content")


@query(
    "conversion_outcomes",
    sql("blocks", then=PAGES + r""", t as (select doc, count(*) as pages, cast(sum(n) as bigint) as blocks, regexp_replace(string_agg(md, chr(10) order by page_seq), '[ \t\r\f\v]+(\n|$)', '\1', 'g') as md, cast(count_if((doc + page_seq) % 4 in (0, 3)) as bigint) as saved from pg group by doc),
        o as (select d.doc_id as doc, exists (select 1 from labels l where l.doc_id = d.doc_id) as done, trim(coalesce(t.md, ''), ' ' || chr(9) || chr(10) || chr(13)) = '' as blank, t.* exclude (doc) from documents d left join t on t.doc = d.doc_id),
        s as (select *, case when done then 'skipped' when blank then 'failed' else 'ok' end as status from o)
        select doc, status, case status when 'skipped' then 'evidence_exists' when 'failed' then 'empty_markdown' else '' end as reason, case when status = 'ok' then pages else 0 end as pages, case when status = 'ok' then length(md) else 0 end as chars,
          case when status = 'ok' then blocks else 0 end as blocks, case when status = 'ok' then pages else 0 end as images_total, case when status = 'ok' then saved else 0 end as images_saved from s"""),
)
def q_convert(spark, d):
    return producer.convert(results(spark, d), sources(spark, d), table(spark, d, "labels").select(F.col("doc_id").alias("doc"))).drop("markdown")


@query(
    "capability_stats",
    sql("blocks", then="""select doc, count(distinct page_seq) as pages, count(*) as blocks, 'block_content,block_id,block_label,block_order,group_id' as block_keys, count(*) as orders, count(provider_block_order) as orders_known,
        round(1 - count(provider_block_order) / count(*), 4) as order_null_ratio, true as has_group, false as has_polygon, cast(count_if(sequence_index < 3) as bigint) as boxes,
        (select string_agg(label || ':' || n, '|' order by n desc, label) from (select label, count(*) as n from blocks c where c.doc = b.doc group by label)) as labels,
        (select string_agg(k, '|' order by k) from (select distinct case (c.doc + c.page_seq) % 4 when 0 then 'data_url' when 1 then 'url' else 'opaque' end as k from blocks c where c.doc = b.doc)) as image_kinds, 'B' as gap, false as has_block_bbox
        from blocks b group by doc"""),
)
def q_capability(spark, d):
    out = capability.report(results(spark, d), ["markdown", "images"])
    listed = F.array_join(F.transform("labels", lambda x: F.concat(x["label"], F.lit(":"), x["n"].cast("string"))), "|")
    return out.select(
        "doc", "pages", "blocks", F.array_join("block_keys", ",").alias("block_keys"), "orders", "orders_known", "order_null_ratio", "has_group", "has_polygon", F.col("boxes").cast("long").alias("boxes"), listed.alias("labels"), F.array_join("image_kinds", "|").alias("image_kinds"), "gap", "has_block_bbox",
    )


@query("image_pages", sql("blocks", then=PAGES + "select doc, page_seq, 1 as images, case (doc + page_seq) % 4 when 0 then 'data_url' when 1 then 'url' else 'opaque' end as kinds from pg"))
def q_image_pages(spark, d):
    return capability.image_pages(results(spark, d)).select("doc", "page_seq", "images", F.array_join("kinds", "|").alias("kinds"))


@query(
    "envelope_stats",
    "select count(*) as lines, 'code,result' as line_keys, 'dataInfo,layoutParsingResults' as result_keys, 'numPages' as data_info_keys, cast(sum(conv_id % 3) as bigint) as items, cast(min(conv_id % 3) as int) as items_min, cast(max(conv_id % 3) as int) as items_max from conversations",
)
def q_envelope(spark, d):
    n = (F.col("conv_id") % 3).cast("int")
    items = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(i.alias("i")))).otherwise(F.array().cast("array<struct<i:int>>"))
    line = F.to_json(F.struct(F.lit(0).alias("code"), F.struct(items.alias("layoutParsingResults"), F.struct(n.alias("numPages")).alias("dataInfo")).alias("result")))
    out = capability.envelope_stats(table(spark, d, "conversations").select(line.alias("value")))
    return out.select("lines", *[F.array_join(c, ",").alias(c) for c in ("line_keys", "result_keys", "data_info_keys")], F.col("items").cast("long").alias("items"), "items_min", "items_max")


# ---- prompts


def _members(spark, d):
    return windows.membership(turns(table(spark, d, "conversations")))


@query("window_prompts", sql("members", then="select doc, window_index, window_id, count(*) as blocks, cast(sum(length(coalesce(content, ''))) as bigint) as chars, string_agg(block_ref, '|' order by pos) as refs from members group by doc, window_index, window_id"))
def q_prompts(spark, d):
    window = F.from_json(F.regexp_replace("user", r"^[^\n]*\n", ""), "window_id string, window_size long, blocks array<struct<block_ref:string,label:string,raw_text:string>>")
    out = prompt.prompts(_members(spark, d)).withColumn("w", window)
    chars = F.aggregate("w.blocks", F.lit(0).cast("long"), lambda n, b: n + F.length(b["raw_text"]))
    return out.select("doc", "window_index", "w.window_id", F.col("w.window_size").alias("blocks"), chars.alias("chars"), F.array_join(F.transform("w.blocks", lambda b: b["block_ref"]), "|").alias("refs"))


@query("window_requests", sql("windows", then=", s as (select doc, count(*) as n from turns group by doc) select s.doc, s.n as block_count, count(window_id) as windows, string_agg(window_id || ':' || start_index || '-' || end_index, ' ' order by window_index) as listed from s left join windows w on w.doc = s.doc group by s.doc, s.n"))
def q_requests(spark, d):
    stream = turns(table(spark, d, "conversations"))
    out = prompt.request(stream, windows.windows(stream))
    listed = F.array_join(F.transform("windows", lambda w: F.concat(w["window_id"], F.lit(":"), w["start_index"].cast("string"), F.lit("-"), w["end_index"].cast("string"))), " ")
    return out.select("doc", "block_count", F.size("windows").cast("long").alias("windows"), listed.alias("listed"))


def _stub(system: str, user: str, attempt: int) -> str:
    """Answers every window with one problem; of every third window only at the second attempt, of every seventh never."""
    import json

    window = json.loads(user.split("\n", 1)[1])
    k = int(window["window_id"][1:])
    if k % 7 == 6 or k % 3 == 2 and attempt == 1:
        return "no json" if attempt == 1 else '{"schema": "other"}'
    refs = [b["block_ref"] for b in window["blocks"]]
    roles = [{"block_ref": r, "role": "PROBLEM_CONTINUATION" if i else "PROBLEM_START"} for i, r in enumerate(refs)]
    pairs = [{"left_ref": a, "right_ref": b, "relation": "SAME_PROBLEM"} for a, b in zip(refs, refs[1:], strict=False)]
    return "```json\n" + json.dumps({"schema": labels.PREDICTION_SCHEMA, "window_id": window["window_id"], "roles": roles, "boundaries": pairs, "splits": [], "uncertain": []}) + "\n```"


@query("predicted_windows", sql("windows", then="select doc, window_index, case when window_index % 7 = 6 or window_index % 3 = 2 then 2 else 1 end as tries, window_index % 7 <> 6 as ok, case when window_index % 7 = 6 then 'not_an_object|schema' when window_index % 3 = 2 then 'not_an_object' else '' end as errors, case when window_index % 7 = 6 then 'schema' end as error, case when window_index % 7 <> 6 then end_index - start_index end as roles from windows"))
def q_predicted(spark, d):
    out = prompt.predict(prompt.prompts(_members(spark, d)), prompt.provider(_stub))
    return out.select("doc", "window_index", F.size("tries").alias("tries"), F.col("prediction").isNotNull().alias("ok"), F.array_join(F.transform("tries", lambda t: t["error"]), "|").alias("errors"), "error", F.when(F.col("prediction").isNotNull(), F.size("prediction.roles")).alias("roles"))


@query("provider_calls", sql("windows", then="select count(*) as windows, cast(sum(case when window_index % 7 = 6 or window_index % 3 = 2 then 2 else 1 end) as bigint) as calls, cast(sum(case when window_index % 7 = 6 then 2 when window_index % 3 = 2 then 1 else 0 end) as bigint) as invalid, cast(count_if(window_index % 7 = 6 or window_index % 3 = 2) as bigint) as retries, cast(count_if(window_index % 7 = 6) as bigint) as lost from windows"))
def q_calls(spark, d):
    return prompt.call_counts(prompt.predict(prompt.prompts(_members(spark, d)), prompt.provider(_stub)))


@query("answer_texts", "select conv_id, string_agg(text, chr(10) order by turn) filter (where role = 'assistant' and trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) <> '') as answer from conversations group by conv_id")
def q_answers(spark, d):
    part = F.array(F.struct(F.lit("output_text").alias("type"), F.col("text").alias("text")))
    kind = F.when(F.col("role") == "assistant", "message").otherwise("reasoning")
    items = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.struct(kind.alias("type"), part.alias("content")).alias("item")))), lambda x: x["item"]).alias("output"))
    return items.select("conv_id", prompt.answer_text(F.to_json(F.struct("output"))).alias("answer"))


# ---- alignment and audit


@query(
    "statement_texts",
    """with p as (select conv_id, turn, row_number() over (partition by conv_id order by turn) as k, substr(text, 3, 10 + conv_id % 5) as cut, case turn % 4 when 0 then chr(10) when 1 then chr(10) || chr(10) when 2 then ' ' else '' end as sep from conversations where coalesce(text, '') <> ''),
       f as (select *, min(k) over (partition by conv_id) as first from p)
       select c.conv_id as question, coalesce(string_agg(case when k = first then '' else sep end || cut, '' order by k), '') as statement from (select distinct conv_id from conversations) c left join f on f.conv_id = c.conv_id group by c.conv_id""",
)
def q_statements(spark, d):
    own = table(spark, d, "conversations").withColumn("unit_id", F.concat_ws(":", "conv_id", "turn"))
    join = F.when(F.col("turn") % 4 == 0, "linebreak").when(F.col("turn") % 4 == 1, "paragraph").when(F.col("turn") % 4 == 2, "space").otherwise("none")
    part = F.struct("unit_id", F.lit(2).alias("start"), (F.col("conv_id") % 5 + 12).cast("int").alias("end"), join.alias("join_before"))
    questions = own.groupBy(F.col("conv_id").alias("question")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", part.alias("p")))), lambda x: x["p"]).alias("parts"))
    units = align.units_of(own.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("unit_id", F.col("text").alias("raw_text")))).alias("units")))
    return align.statements(questions, units)


def _spans(spark, d):
    own = blocks(table(spark, d, "documents"))
    return own, align.spans(align.starts(_questions(spark, d), own), own.groupBy("doc").agg(F.count("*").cast("int").alias("n")))


REPORTED = """, g as (select sp.*, greatest(1, next_start - start) as span, (select page_seq from blocks b where b.doc = sp.doc and b.pos = sp.start) as fp, (select page_seq from blocks b where b.doc = sp.doc and b.pos = greatest(sp.next_start - 1, sp.start)) as lp from sp),
  r as (select doc, count(*) as aligned, cast(count_if(confidence = 'exact') as bigint) as exact, cast(count_if(confidence <> 'exact') as bigint) as approximate, list_sort(list(span)) as l, max(span) as span_max, cast(count_if(span = 1) as bigint) as single,
        cast(count_if(span <= 3) as bigint) as within_3, cast(count_if(span <= 5) as bigint) as within_5, cast(count_if(span <= 7) as bigint) as within_7, cast(count_if(lp > fp) as bigint) as cross_page, cast(count_if(next_start = start) as bigint) as same_block from g group by doc)"""


@query("alignment_document_report", sql("blocks", then=ALIGN + SPANS + REPORTED + "select doc, aligned, exact, approximate, l[cast(round_even(0.5 * (len(l) - 1), 0) as int) + 1] as span_p50, l[cast(round_even(0.9 * (len(l) - 1), 0) as int) + 1] as span_p90, span_max, single, within_3, within_5, within_7, cross_page, same_block from r"))
def q_document_report(spark, d):
    own, spans = _spans(spark, d)
    return align.document_report(spans, own)


@query(
    "alignment_corpus_report",
    sql("blocks", then=ALIGN + SPANS + REPORTED + """select count(*) as documents, cast(sum(aligned) as bigint) as spans, cast(sum(cross_page) as bigint) as cross_page, cast(sum(same_block) as bigint) as same_block, round(sum(within_3) / sum(aligned), 4) as within_3_ratio,
        round(sum(within_5) / sum(aligned), 4) as within_5_ratio, round(sum(within_7) / sum(aligned), 4) as within_7_ratio, (select count(distinct question) from g) as aligned, (select round(avg(span), 2) from g) as span_mean, (select max(span) from g) as span_max,
        (select count(distinct question) from q) as questions, (select count(distinct question) from q) - (select count(distinct question) from g) as lost from r"""),
)
def q_corpus_report(spark, d):
    own, spans = _spans(spark, d)
    return align.corpus_report(_questions(spark, d), spans, align.document_report(spans, own))


@query("alignment_in_order")
def q_in_order(spark, d):
    """Starts that never go back, before the answers; without SQL, held against brute force."""
    return align.starts_in_order(_questions(spark, d), blocks(table(spark, d, "documents")), cutoff=True)


@query("anomaly_counts")
def q_anomaly_counts(spark, d):
    """Failures and long spans by reason; the tables that it counts have SQL of their own."""
    own, spans = _spans(spark, d)
    questions = _questions(spark, d)
    return align.anomaly_report(align.failures(questions, spans.select("question"), own), align.long_spans(spans, own))


@query("audit_changes", sql("blocks", then=r""", v as (select doc, block_ref, content, regexp_replace(regexp_replace(content, '([,!?:;])([^\s])', '\1 \2', 'g'), '([,!?:;])([^\s])', '\1 \2', 'g') as new from blocks where label = 'text')
   select doc, block_ref, 'OTHER' as bucket, 0 as gain, left(content, 300) as raw, left(new, 300) as new from v where new <> content"""))
def q_audit(spark, d):
    from ..operators import view

    changes, _ = audit.collect(view.normalized(blocks(table(spark, d, "documents")), _plain))
    return changes.drop("distance")


@query("report_rows", sql("blocks", then="select '| ' || label || ' | ' || count(*) || ' |' as line from blocks group by label"))
def q_report_rows(spark, d):
    return sinks.markdown_rows(blocks(table(spark, d, "documents")).groupBy("label").agg(F.count("*").alias("n")), ["label", "n"])


@query("revised_names", r"select page_id, regexp_replace(url, '(\.[^./\\]*)?$', '.revised\1') as name from pages")
def q_revised(spark, d):
    return table(spark, d, "pages").select("page_id", sinks.revised(F.col("url")).alias("name"))
