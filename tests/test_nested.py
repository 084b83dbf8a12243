"""Nested payloads as rows against walks of the parsed payload; odd and deep ones."""

import json
import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import nested, structure
from folioframe.session import ship

KEY = "K9" + "abcdEF01" * 5


def payload(rng, depth):
    kind = rng.choice(["object", "object", "array", "text", "number", "other"]) if depth else rng.choice(["object", "array"])
    if depth > 5 and kind in ("object", "array"):
        kind = "text"
    if kind == "object":
        names = rng.sample(["zeta", "alpha", "blocks", "parsing_res_list", "parsingResList", "token", "note", "é", "x_y", "model"], rng.randint(0, 4))
        return {k: payload(rng, depth + 1) for k in names}
    if kind == "array":
        return [payload(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    if kind == "text":
        return rng.choice(["", "plain", "<<redacted>>", KEY, "https://x.example/a", "123", "true", "null", '{"a": 1}', 'a"b\\c\n'])
    return rng.choice([0, -7, 12345678901234567890, 2.0, 0.125, -1e30]) if kind == "number" else rng.choice([True, False, None])


@pytest.fixture(scope="module")
def payloads():
    rng = random.Random(11)
    return {k: payload(rng, 0) for k in range(250)}


@pytest.fixture(scope="module")
def found(spark, payloads):
    ship(spark)
    rows = [(k, json.dumps(v, ensure_ascii=k % 2 == 0)) for k, v in payloads.items()]
    return nested.nodes(spark.createDataFrame(rows, "id long, payload string").repartition(3)).cache()


def walked(value, ord_=(), path="$"):
    yield ord_, path, value
    below = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for n, (k, v) in enumerate(below):
        yield from walked(v, (*ord_, n), f"{path}[{k}]" if isinstance(value, list) else f"{path}.{k}")


def test_every_value(found, payloads):
    got = sorted((r.id, tuple(r.ord), r.path, r.kind) for r in found.select("id", "ord", nested.full_path(F.col("steps")).alias("path"), "kind").collect())
    assert got == sorted((k, o, p, structure.type_name(v)) for k, whole in payloads.items() for o, p, v in walked(whole))
    texts = {(r.id, tuple(r.ord)): r.text for r in found.filter("kind = 'str' and depth > 0").collect()}
    assert texts == {(k, o): v for k, whole in payloads.items() for o, _, v in walked(whole) if isinstance(v, str) and o}


def test_filters_equal_walks_of_the_payload(found, payloads):
    paths = {}
    for r in sorted(nested.key_paths(found).collect(), key=lambda r: (r.id, r.ord)):
        paths.setdefault(r.id, []).append(r.path)
    assert paths == {k: p for k, v in payloads.items() if (p := structure.key_paths(v))}
    lists = {r.id: json.loads(r.blocks) for r in nested.block_lists(found).collect()}
    assert {k: json.dumps(v) for k, v in lists.items()} == {k: json.dumps(b) for k, v in payloads.items() if (b := structure.block_list(v))}
    secrets = {}
    for r in nested.secrets(found).collect():
        secrets.setdefault(r.id, []).append((r.path, r.reason))
    assert {k: sorted(v) for k, v in secrets.items()} == {k: sorted(s) for k, v in payloads.items() if (s := structure.secrets(v))}
    assert {r.id for r in nested.with_key(found, ("é", "model")).collect()} == {k for k, v in payloads.items() if structure.has_key(v, ("é", "model"))}
    assert len(secrets) > 20 and len(lists) > 20 and len(paths) > 100


def test_first_block_list_within_the_row(spark, payloads, found):
    """The same lists as by rows of all values, without any: no recursion, no shuffle, so no disk for the payloads' values."""
    rng = random.Random(12)
    wide = {1000 + k: [payload(rng, 0) for _ in range(12)] for k in range(150)}
    texts = {k: json.dumps(v, ensure_ascii=k % 2 == 0) for k, v in (payloads | wide).items()}
    odd = {-1: None, -2: "", -3: "{bad", -4: '{"blocks": [1], "blocks": [2]}', -5: "[" * 5000, -6: '"text"', -7: ' [ {"blocks": "[1]"}, {"blocks": [ ]}, {"blocks": [null]} ]', -8: '{"blocks": null, "a": {"parsingResList": [[]]}}', -9: '{"a":' * 64 + '{"blocks": [1]}' + "}" * 64, -10: '{"a":' * 63 + '{"blocks": [1]}' + "}" * 63}
    rows = spark.createDataFrame(list((texts | odd).items()), "id long, payload string")
    own = rows.select("id", nested.first_block_list("payload").alias("blocks"))
    got = {r.id: r.blocks for r in own.filter("blocks is not null").collect()}
    assert got == {r.id: r.blocks for r in nested.block_lists(nested.nodes(rows)).collect()}
    assert {k: json.dumps(json.loads(got[k])) for k in got if k >= 0} == {k: json.dumps(b) for k, v in (payloads | wide).items() if (b := structure.block_list(v))}
    assert sorted(k for k in got if k < 0) == [-10, -8, -7]
    plan = nested.deep_blocks(rows.selectExpr("id as doc", "0 as page_seq", "payload as pruned"))._jdf.queryExecution().executedPlan().toString()
    assert "UnionLoop" not in plan and "Exchange" not in plan


def test_odd_payloads(spark):
    deep = "[" * 5000 + "]" * 5000
    rows = [(1, None), (2, ""), (3, "{bad"), (4, '{"a": 1, "a": 2}'), (5, deep), (6, '"text"'), (7, "[]"), (8, "null"), (None, '{"k": 1}'), (9, "7"), (9, "[8]")]
    got = nested.nodes(spark.createDataFrame(rows, "id long, payload string").withColumn("text", F.lit("clash")).withColumn("steps", F.lit(1))).collect()
    kinds = {}
    for r in sorted(got, key=lambda r: (r.id or 0, r.ord)):
        kinds.setdefault(r.id, []).append(r.kind)
    assert {k: kinds[k] for k in (1, 2, 3, 4, 5)} == {k: [None] for k in (1, 2, 3, 4, 5)}
    assert kinds[6] == ["str"] and kinds[7] == ["array"] and kinds[8] == ["null"] and kinds[None] == ["object", "int"] and sorted(kinds[9]) == ["array", "int", "int"]
    assert nested.nodes(spark.createDataFrame([], "id long, payload string")).collect() == []


def test_depth_is_bounded(spark):
    rows = [(1, "[" * 30 + "1" + "]" * 30), (2, '{"a": {"a": {"a": {}}}}')]
    got = nested.nodes(spark.createDataFrame(rows, "id long, payload string"), deepest=3).collect()
    assert sorted((r.id, r.depth, r.more) for r in got) == [(1, 0, False), (1, 1, False), (1, 2, False), (1, 3, True), (2, 0, False), (2, 1, False), (2, 2, False), (2, 3, False)]


def test_deep_payloads_end_no_job(spark):
    """900 levels are walked; 200,000 can't be parsed and are null."""
    ship(spark)
    deep = '{"a":' * 900 + '"https://x.example"' + "}" * 900
    rows = spark.createDataFrame([(1, deep), (2, "[" * 200_000), (3, '{"a": ["https://x.example"]}')], "id long, payload string")
    got = {r.id: r for r in rows.select("id", structure.scrubbed(F.col("payload")).alias("scrubbed"), structure.desensitized(F.col("payload")).alias("plain"), structure.secrets_of(F.col("payload")).alias("secrets"), structure.structure_of(F.col("payload")).alias("shape"), structure.paths_of(F.col("payload")).alias("paths")).collect()}
    assert (got[2].scrubbed, got[2].plain, got[2].secrets, got[2].shape, got[2].paths) == (None,) * 5
    assert "<<truncated>>" in got[1].scrubbed and "<<redacted-resource:" in got[1].plain and [s.reason for s in got[1].secrets] == ["resource"] and len(got[1].paths) == 7
    assert [tuple(s) for s in got[3].secrets] == [("$.a[0]", "resource")] and got[3].scrubbed == '{"a": ["https://x.example"]}'


def test_rebuilt_payloads_keep_their_shape(payloads):
    for v in payloads.values():
        assert [p for _, p, _ in walked(v) if "token" not in p] == [p for _, p, _ in walked(structure.desensitize(v)) if "token" not in p]
        assert json.dumps(structure.scrub(v, 99)).count(KEY) == 0
