"""Nested JSON payloads as rows, by recursion in SQL: every value of every depth with its path and its place in the text.

nodes() gives one row for each value; key paths, block lists, key searches and secret scans are filters over those rows. A
level of all payloads is one step, however many payloads there are, and no payload is held whole by Python. The order of keys
is that of the text: a level's keys and texts are read as a map of texts, its types as a map of variants, in one order.

Payloads that are no JSON, hold an object with one key twice, or are nested deeper than the parser goes (about
1,000 levels) have one row, without kind. Values below `deepest` levels have no rows; what stands at that depth and holds
something has `more` set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import looks_secret
from .structure import BLOCK_LISTS, EXEMPT, RESOURCE, SENSITIVE

DEEPEST = 64


def _kind(v: str, text: str, missing: str) -> str:
    """SQL of the kind of a variant, whose text is also at hand; missing: what a null variant is."""
    kind = f"schema_of_variant({v})"
    return (
        f"case when {v} is null then {missing} when {kind} = 'VOID' then 'null' when startswith({kind}, 'OBJECT') then 'object' when startswith({kind}, 'ARRAY') then 'array' when {kind} = 'STRING' then 'str' when {kind} = 'BOOLEAN' then 'bool'"
        f" when {text} rlike '^\\\\s*-?[0-9]+\\\\s*$' then 'int' else 'float' end"
    )


def nodes(payloads: DataFrame, deepest: int = DEEPEST, id_col: str = "id", column: str = "payload") -> DataFrame:
    """(id, payload as JSON text) -> id, ord, steps, depth, kind, text, more.

    ord: the places from the top, so that rows in order of ord are parents first, in order of the text. steps: of each step
    down the key, and, in arrays, the place. kind: object, array, str, int, float, bool, null. text: of texts what they say,
    of all others their JSON. Ids may repeat or be null, rows of one id then mix; a null payload has one row without kind.
    """
    spark = payloads.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # rows grow with the payloads; levels are bounded
    own = payloads.select(F.col(id_col).alias("id"), F.col(column).cast("string").alias("payload"))
    named = "named_struct('key', {key}, 'text', {text}, 'kind', {kind})".format
    member = named(key="a.key", text="a.value", kind=_kind("b.value", "a.value", "'null'"))
    item = named(key="cast(null as string)", text="a", kind=_kind("b", "a", "'null'"))
    members = f"zip_with(map_entries(from_json(n.text, 'map<string,string>')), map_entries(from_json(n.text, 'map<string,variant>')), (a, b) -> {member})"
    items = f"zip_with(from_json(n.text, 'array<string>'), from_json(n.text, 'array<variant>'), (a, b) -> {item})"
    return spark.sql(
        f"""with recursive n(id, ord, steps, depth, kind, text) max recursion level {deepest + 2} as (
              select id, cast(array() as array<int>), cast(array() as array<struct<key: string, at: int>>), 0, {_kind('try_parse_json(payload)', 'payload', 'null')}, payload from {{own}}
              union all
              select n.id, concat(n.ord, array(c.at)), concat(n.steps, array(named_struct('key', c.item.key, 'at', case when c.item.key is null then c.at end))), n.depth + 1, c.item.kind, c.item.text
              from n, lateral posexplode(case n.kind when 'object' then {members} when 'array' then {items} end) as c(at, item)
              where n.depth < {deepest} and n.kind in ('object', 'array'))
            select id, ord, steps, depth, kind, text, depth = {deepest} and kind in ('object', 'array') and text not rlike '^[\\\\[{{{{]\\\\s*[\\\\]}}}}]$' as more from n""",
        own=own,
    )


def key(steps: Column) -> Column:
    """The key under which a value stands; null of items and at the top."""
    return F.try_element_at(steps, F.lit(-1))["key"]


def full_path(steps: Column) -> Column:
    """$.a[0].b"""
    return F.concat(F.lit("$"), F.array_join(F.transform(steps, lambda s: F.when(s["key"].isNull(), F.concat(F.lit("["), s["at"].cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), s["key"]))), ""))


def key_paths(found: DataFrame, depth: int = 6) -> DataFrame:
    """id, ord, path of every key, a.b[].c: of arrays the first item alone; rows in order of ord are parents first, and repeat where the payload does."""
    own = found.filter(key(F.col("steps")).isNotNull() & (F.col("depth") <= depth + 1) & ~F.exists("steps", lambda s: F.coalesce(s["at"] > 0, F.lit(False))))
    path = F.array_join(F.transform("steps", lambda s: F.when(s["key"].isNull(), "[]").otherwise(F.concat(F.lit("."), s["key"]))), "")
    return own.select("id", "ord", F.regexp_replace(path, r"^\.", "").alias("path"))


def type_profile(found: DataFrame, depth: int = 6) -> DataFrame:
    """path, kind, n: of all keys, as key_paths names them."""
    own = key_paths(found.filter("kind is not null"), depth).join(found.select("id", "ord", "kind"), ["id", "ord"])
    return own.groupBy("path", "kind").agg(F.count("*").alias("n"))


def block_lists(found: DataFrame, names: tuple[str, ...] = BLOCK_LISTS) -> DataFrame:
    """id, blocks (JSON): of each payload the first list under one of the names that isn't empty, objects before what they hold, names of one object in the order given. Payloads without any have no row."""
    own = key(F.col("steps"))
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), own)
    lists = found.filter((F.col("kind") == "array") & own.isin(*names) & (F.json_array_length("text") > 0))
    return lists.groupBy("id").agg(F.min_by("text", F.struct(F.slice("ord", F.lit(1), F.size("ord") - 1), rank)).alias("blocks"))


def with_key(found: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """id of payloads that have one of the keys at any depth."""
    return found.filter(key(F.col("steps")).isin(*names)).select("id").distinct()


def secrets(found: DataFrame) -> DataFrame:
    """id, path, reason of texts that look secret still: under a secret key (sensitive_key), like a key themselves (secret_value), addresses and data (resource). What stands under an exempt key is left out, whole."""
    own, text = key(F.col("steps")), F.col("text")
    texts = found.filter((F.col("kind") == "str") & (F.col("depth") > 0) & ~F.exists("steps", lambda s: F.coalesce(s["key"].isin(*sorted(EXEMPT)), F.lit(False))))
    told = own.isNotNull() & own.rlike(f"(?i){SENSITIVE.pattern}") & (text != "") & ~F.startswith(text, F.lit("<<"))
    reason = F.when(told, "sensitive_key").when(looks_secret(text), "secret_value").when(text.rlike(f"(?i){RESOURCE.pattern}"), "resource")
    return texts.select("id", full_path(F.col("steps")).alias("path"), reason.alias("reason")).filter("reason is not null")


def first_block_list(column: str, deepest: int = DEEPEST, names: tuple[str, ...] = BLOCK_LISTS) -> Column:
    """What block_lists finds in one payload (JSON), within its row: no value but the lists and objects of one level is kept, and none past the best list so far. Null if there is none."""
    let = "transform(array({value}), {name} -> {body})[0]".format
    kind = lambda v, text: f"case when not {text} rlike '^\\\\s*[\\\\[{{]' then null when startswith(schema_of_variant({v}), 'OBJECT') then 'object' when startswith(schema_of_variant({v}), 'ARRAY') then 'array' end"
    member = f"named_struct('key', a.key, 'text', a.value, 'kind', {kind('b.value', 'a.value')})"
    item = f"named_struct('key', cast(null as string), 'text', a, 'kind', {kind('b', 'a')})"
    members = f"zip_with(map_entries(from_json(f.text, 'map<string,string>')), map_entries(from_json(f.text, 'map<string,variant>')), (a, b) -> {member})"
    items = f"zip_with(from_json(f.text, 'array<string>'), from_json(f.text, 'array<variant>'), (a, b) -> {item})"
    listed = ", ".join(f"'{n}'" for n in names)
    child = f"named_struct('parent', f.ord, 'ord', concat(f.ord, array(i)), 'rank', cast(coalesce(array_position(array({listed}), c.key), 0) as int), 'text', c.text, 'kind', c.kind)"
    below = f"filter(flatten(transform(s.open, f -> transform(case f.kind when 'object' then {members} else {items} end, (c, i) -> {child}))), c -> c.kind is not null)"
    hit = "(c.kind = 'array' and c.rank > 0 and json_array_length(c.text) > 0)"
    best = f"array_min(concat(array(s.best), transform(filter(k, c -> {hit}), c -> named_struct('parent', c.parent, 'rank', c.rank, 'text', c.text))))"
    still = f"transform(filter(k, c -> not {hit} and (b is null or c.ord < b.parent)), c -> named_struct('ord', c.ord, 'text', c.text, 'kind', c.kind))"
    step = let(name="k", value=below, body=let(name="b", value=best, body=f"named_struct('best', b, 'open', {still})"))
    top = f"named_struct('ord', cast(array() as array<int>), 'text', {column}, 'kind', {kind(f'try_parse_json({column})', column)})"
    start = f"named_struct('best', cast(null as struct<parent: array<int>, rank: int, text: string>), 'open', filter(array({top}), c -> c.kind is not null))"
    return F.expr(f"aggregate(sequence(1, {deepest}), {start}, (s, n) -> case when size(s.open) = 0 then s else {step} end, s -> s.best.text)")


def deep_blocks(results: DataFrame, column: str = "pruned") -> DataFrame:
    """results (doc, page_seq, pruned JSON) -> blocks as provider_blocks gives them, of the block list wherever in the page it stands."""
    from ..sources.evidence import provider_blocks

    own = results.select("doc", "page_seq", F.col(column).cast("string").alias("payload"))
    found = own.select("doc", "page_seq", F.explode_outer(F.array(first_block_list("payload"))).alias("blocks")).filter("blocks is not null")  # an array, so that it is computed once
    return provider_blocks(found.select("doc", "page_seq", F.concat(F.lit(f'{{"{BLOCK_LISTS[0]}": '), "blocks", F.lit("}")).alias("pruned")))
