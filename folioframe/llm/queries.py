"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, fim, langid, lexicon, line_dedup, minhash, packing, resampling, sstable, toxicity, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query(
    "op3_exact_dedup",
    """
    with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents)
    select doc_id, max(doc_id) over (partition by text_sha256) as keep_id,
           cast(count(*) over (partition by text_sha256) as bigint) as group_size,
           doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
    from d
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query(
    "op4_warc",
    """
    with p as (
      select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
    ), g as (select *, max(page_id) over (partition by payload_digest) as first_id from p)
    select page_id, payload_bytes, payload_digest,
           case when payload_bytes >= 1000 and page_id <> first_id then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= 1000 and page_id <> first_id then first_id end as refers_to
    from g
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


@query(
    "op9_url_filter",
    """
    with r(rhost, rpath, v) as (values ('com','/en/','block'), ('example.com','/en/7','allow'), ('net','/de/','block'),
                                       ('example.net','/de/8','block'), ('org','/es/','block')),
    u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
    m as (select p.page_id, p.host, p.path, r.rhost || r.rpath as rule, r.v,
                 row_number() over (partition by p.page_id order by length(r.rhost || r.rpath) desc nulls last) as k
          from p left join r on (p.host = r.rhost or ends_with(p.host, '.' || r.rhost)) and starts_with(p.path, r.rpath))
    select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m where k = 1
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules)


@query("op10_sstable")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.round_trip(table(spark, sf_dir, "documents"))


@query(
    "op8_minhash_near_dedup",
    r"""
    with recursive t as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
    ), s as (
      select distinct doc_id, x from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as x from t)
    ), n as (select doc_id, count(*) as n from s group by doc_id),
    p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
    l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
    e as (select a, b from l union all select b, a from l),
    r as (select a as node, a as seen from e union select r.node, e.b from r join e on e.a = r.seen),
    c as (select node, min(seen) as component from r group by node)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.component, d.doc_id) as component_id, coalesce(c.component, d.doc_id) = d.doc_id as kept
    from documents d left join n on n.doc_id = d.doc_id left join c on c.node = d.doc_id
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(table(spark, sf_dir, "documents"), width=3, percent=85)


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaks: doc_id, n_items, item_ids (ascending), best similarity; documents without any have none."""
    found = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct("found.item_id"))
    return found.select("doc_id", F.size(items).alias("n_items"), items.alias("item_ids"), F.coalesce(F.array_max("found.similarity"), F.lit(0.0)).alias("similarity"), (F.size("found") > 0).alias("leaked"))


@query(
    "op2_line_dedup",
    r"""
    with l as (
      select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents
    ), t as (select doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13)) as line from l),
    e as (select *, length(line) >= 12 and row_number() over (partition by line order by doc_id, pos) > 1 as equal from t),
    u as (select doc_id, pos, line, length(line) as size, length(replace(line, 'e', '')) as e, length(replace(line, 't', '')) as t, length(replace(line, 'a', '')) as a,
                 length(replace(line, 'n', '')) as n, length(replace(line, 'o', '')) as o from e where not equal and length(line) >= 24),
    n as (select distinct b.doc_id, b.pos from u a join u b
          on b.size between a.size - 2 and a.size + 2 and abs(a.e - b.e) <= 2 and abs(a.t - b.t) <= 2 and abs(a.a - b.a) <= 2 and abs(a.n - b.n) <= 2 and abs(a.o - b.o) <= 2
             and (a.doc_id, a.pos) < (b.doc_id, b.pos)
          where levenshtein(a.line, b.line) <= case when least(a.size, b.size) >= 48 then 2 else 1 end),
    f as (select e.*, n.pos is not null as near from e left join n on e.doc_id = n.doc_id and e.pos = n.pos),
    g as (select doc_id, count(*) as n_lines, count_if(equal) as n_equal, count_if(near) as n_near,
                 coalesce(string_agg(raw, chr(10) order by pos) filter (not equal and not near), '') as text from f group by doc_id)
    select d.doc_id, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_equal, 0) as bigint) as n_equal,
           cast(coalesce(n_near, 0) as bigint) as n_near, case when d.text is not null then g.text end as text
    from documents d left join g on d.doc_id = g.doc_id
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_equal", "n_near", "text")


@query("op2_line_dedup_words")
def op2_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the pipeline does it: lines go too that an earlier one equals but for one word."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), words=True).select("doc_id", "n_lines", "n_equal", "n_near", "text")


@query(
    "op11_fill_in_middle",
    r"""
    with t as (
      select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as d,
             regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w from documents
    ), h as (
      select doc_id, text, w, cast(len(w) as bigint) as n, cast('0x' || substr(d, 1, 8) as bigint) as h1, cast('0x' || substr(d, 9, 8) as bigint) as h2,
             cast('0x' || substr(d, 17, 8) as bigint) as h3, cast('0x' || substr(d, 25, 8) as bigint) as h4 from t
    ), f as (
      select doc_id, text, n, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form,
             array_to_string(w[1 : least(h1 % (n + 1), h2 % (n + 1))], '') as p, array_to_string(w[1 + least(h1 % (n + 1), h2 % (n + 1)) : greatest(h1 % (n + 1), h2 % (n + 1))], '') as m,
             array_to_string(w[1 + greatest(h1 % (n + 1), h2 % (n + 1)) : n], '') as s from h
    )
    select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars, case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
           sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(text) as restored_sha256
    from f
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(table(spark, sf_dir, "documents"))
    digest = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(fim.restore(F.col("output"), F.col("form")), 256)}
    return out.withColumns(digest).drop("output")


@query(
    "op12_importance_resampling",
    r"""
    with k as (select 'd' as of, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
    w as (select of, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from k),
    g as (
      select of, id, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]),
                                        list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as x from w
    ), c as (select of, id, x, count(*) as n from g group by of, id, x),
    t as (select list_transform(generate_series(0, 255), lambda v: list_reduce(list_prepend(v, generate_series(1, 8)), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t),
    u as (select x, hex(encode(x)) as z from (select distinct x from c)),
    y as (
      select x, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(generate_series(1, length(z) - 1, 2), lambda i: 16 * (strpos('0123456789ABCDEF', z[i]) - 1) + strpos('0123456789ABCDEF', z[i + 1]) - 1)),
                                            lambda a, b: xor(a >> 8, t.t[1 + (xor(a, b) & 255)]))) % 10000 as bucket from u, t
    ), b as (select bucket, sum(n) filter (of = 'd') as s, sum(n) filter (of = 'b') as t from c join y using (x) group by bucket),
    a as (select coalesce(sum(s), 0) as s, coalesce(sum(t), 0) as t from b),
    v as (select bucket, cast(floor(1000 * ln(cast(coalesce(b.t, 0) + 1 as double) * cast(a.s + 10000 as double) / (cast(coalesce(b.s, 0) + 1 as double) * cast(a.t + 10000 as double)))) as bigint) as gain from b, a),
    m as (select id, sum(n) as n, sum(n * gain) as weight from c join y using (x) join v using (bucket) where of = 'd' group by id),
    d as (
      select id as doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
             cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('42:' || id), 1, 8) as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
      from w left join m using (id) where of = 'd'
    ), r as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as k, count(*) filter (n_words >= 20) over () as total from d)
    select doc_id, n_features, weight, score, case when n_words >= 20 and k <= 5 * total // 100 then k end as rank, n_words from r
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_bpe_transducer")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.digests(table(spark, sf_dir, "documents"))
