"""Queries over nested payloads, made of events: their values, key paths, block lists and secrets, by recursion in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators import nested
from ..sources.tables import table
from .producing import results
from .registry import query, sql

#: A payload's text, in SQL that Spark and DuckDB read alike: keys out of order, lists in lists, empty block lists before full ones, some cut short.
PAYLOAD = """case when event_id % 11 = 0 then '{"cut": [1, {"short": ' when event_id % 13 = 0 then '[]' else
  concat('{"z": {"user": ', cast(user_id as varchar(20)), ', "tags": ["t', cast(event_id % 3 as varchar(20)), '", {"deep": [[], [', cast(event_id as varchar(20)), ', null, true, 0.5]]}]}, "a": {"pages": [{"blocks": []}, {"inner": {',
    case when event_id % 2 = 0 then concat('"blocks": [{"id": ', cast(event_id as varchar(20)), '}], ') else '' end,
    case when event_id % 3 = 0 then concat('"parsing_res_list": [{"id": -', cast(event_id as varchar(20)), ', "label": "', event_type, '"}, {}], ') else '' end, '"n": 1}}]}, "props": ', props,
    ', "access_token": "', case when event_id % 5 = 0 then '<<redacted>>' when event_id % 5 = 1 then '' else 'abc' end, '", "tool": {"password": "exempt"}, "links": ["https://example.org/', cast(event_id as varchar(20)), '", "plain", "Key0',
    case when event_id % 4 = 0 then '0123456789abcdefABCDEF0123456789' else 'short' end, '"]}') end"""
PAYLOADS = f"with p as (select event_id, {PAYLOAD} as payload from events), t as (select p.event_id, j.* from p, json_tree(p.payload) j where json_valid(p.payload))"


def found(spark, d):
    payload = PAYLOAD.replace("varchar(20)", "string")
    return nested.nodes(table(spark, d, "events").select(F.col("event_id").alias("id"), F.expr(payload).alias("payload")))


KINDS = "case type when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'str' when 'BOOLEAN' then 'bool' when 'NULL' then 'null' when 'DOUBLE' then 'float' else 'int' end"


@query("nested_values", PAYLOADS + f" select event_id, cast(row_number() over (partition by event_id order by id) as int) as place, fullkey as path, {KINDS} as kind, case when type not in ('OBJECT', 'ARRAY', 'NULL') then json_extract_string(value, '$') end as said from t")
def q_values(spark, d):
    place = F.row_number().over(W.partitionBy("id").orderBy("ord"))
    said = F.when(~F.col("kind").isin("object", "array", "null"), F.col("text"))
    return found(spark, d).filter("kind is not null").select(F.col("id").alias("event_id"), place.alias("place"), nested.full_path(F.col("steps")).alias("path"), "kind", said.alias("said"))


@query("nested_key_paths", PAYLOADS + r", k as (select event_id, regexp_replace(replace(fullkey, '$.', ''), '\[0\]', '[]', 'g') as path from t where key is not null and fullkey not similar to '.*\[[1-9][0-9]*\].*' and not ends_with(fullkey, ']')) select path, count(*) as n from k group by path")
def q_paths(spark, d):
    return nested.key_paths(found(spark, d)).groupBy("path").agg(F.count("*").alias("n"))


@query("nested_type_profile", PAYLOADS + rf", k as (select regexp_replace(replace(fullkey, '$.', ''), '\[0\]', '[]', 'g') as path, {KINDS} as kind from t where key is not null and fullkey not similar to '.*\[[1-9][0-9]*\].*' and not ends_with(fullkey, ']')) select path, kind, count(*) as n from k group by path, kind")
def q_profile(spark, d):
    return nested.type_profile(found(spark, d))


@query(
    "nested_block_lists",
    PAYLOADS + """, b as (select *, row_number() over (partition by event_id order by parent, list_position(['parsing_res_list', 'parsingResList', 'blocks'], key)) as k from t where type = 'ARRAY' and key in ('parsing_res_list', 'parsingResList', 'blocks') and json_array_length(value) > 0)
      select event_id, cast(json_array_length(value) as int) as blocks, cast(json_extract_string(value, '$[0].id') as bigint) as first from b where k = 1""",
)
def q_block_lists(spark, d):
    return nested.block_lists(found(spark, d)).select(F.col("id").alias("event_id"), F.json_array_length("blocks").alias("blocks"), F.get_json_object("blocks", "$[0].id").cast("long").alias("first"))


@query(
    "nested_secrets",
    PAYLOADS + r""", s as (select event_id, fullkey as path, case when key similar to '.*(token|password).*' and json_extract_string(value, '$') <> '' and not starts_with(json_extract_string(value, '$'), '<<') then 'sensitive_key'
        when json_extract_string(value, '$') similar to 'Key0[0-9a-fA-F]{32}' then 'secret_value' when starts_with(json_extract_string(value, '$'), 'https://') then 'resource' end as reason from t where type = 'VARCHAR' and not starts_with(fullkey, '$.tool'))
      select * from s where reason is not null""",
)
def q_secrets(spark, d):
    return nested.secrets(found(spark, d)).withColumnRenamed("id", "event_id")


@query("nested_keys_present", PAYLOADS + " select distinct event_id from t where key in ('parsing_res_list', 'label')")
def q_with_key(spark, d):
    return nested.with_key(found(spark, d), ("parsing_res_list", "label")).withColumnRenamed("id", "event_id")


@query("nested_provider_blocks", sql("blocks", then="select doc, page_seq, sequence_index, block_ref, pos as provider_block_id, provider_block_order, label, sha256(content) as content_sha256 from blocks"))
def q_deep_blocks(spark, d):
    """Pages whose block list stands below others that are empty."""
    wrapped = F.concat(F.lit('{"pages": [{"blocks": []}, {"inner": ['), "pruned", F.lit("]}]}"))
    out = nested.deep_blocks(results(spark, d).withColumn("pruned", wrapped))
    return out.select("doc", "page_seq", "sequence_index", "block_ref", "provider_block_id", "provider_block_order", "label", F.sha2("content", 256).alias("content_sha256"))
