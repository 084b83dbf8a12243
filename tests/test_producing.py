"""Sinks, providers' answers, images, reports and alignment in order, against brute force and round trips."""

import json
import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import align, audit, capability, labels, producer, prompt, structure
from folioframe.session import ship
from folioframe.sources import evidence as readers
from folioframe.sources import sinks


def test_json_sink_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    sinks.write_json(df, f"{tmp_path}/out")
    assert '"b":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_json(df, f"{tmp_path}/out")
    sinks.write_json(df.limit(1), f"{tmp_path}/out", overwrite=True)
    assert spark.read.json(f"{tmp_path}/out").count() == 1


def test_raw_pages(spark, tmp_path):
    pages = producer.page_table(spark.createDataFrame([(1, 0, '{"width": 5, "blocks": []}', "t", {}), (1, 1, "{}", "u", {}), (2, 0, "no json", None, None)], "doc int, page_seq int, pruned string, markdown_text string, images map<string,string>"))
    got = {(r.doc, r.page_seq): r for r in pages.collect()}
    assert got[1, 0].width == 5 and got[1, 1].raw is None and got[2, 0].raw is None and got[2, 0].markdown_text == ""
    sinks.write_raw_pages(pages, f"{tmp_path}/none", "none")
    assert not (tmp_path / "none").exists()
    envelope = spark.createDataFrame([('{"token": "abc", "k": 1}',)], "value string")
    sinks.write_raw_pages(pages, f"{tmp_path}/full", "full", envelope)
    assert spark.read.json(f"{tmp_path}/full/pages").count() == 1
    assert json.loads(spark.read.text(f"{tmp_path}/full/envelope").first().value) == {"token": "<<redacted>>", "k": 1}
    with pytest.raises(ValueError):
        sinks.write_raw_pages(pages, f"{tmp_path}/x", "all")


def test_markdown_files_round_trip(spark, tmp_path):
    ship(spark)
    rows = [("a.md", "one\ntwo é", True, "CRLF"), ("b.md", "one\r\ntwo", False, "LF"), ("sub/c.md", "", False, "LF")]
    out = sinks.write_markdown(spark.createDataFrame(rows, "name string, text string, has_bom boolean, style string").repartition(2), f"file://{tmp_path}")
    assert {r.name: r.bytes for r in out.collect()} == {"a.md": 3 + len("one\r\ntwo é".encode()), "b.md": 7, "sub/c.md": 0}
    assert (tmp_path / "a.md").read_bytes() == b"\xef\xbb\xbf" + "one\r\ntwo é".encode() and (tmp_path / "b.md").read_bytes() == b"one\ntwo"
    got = {r.path.rsplit("/", 1)[1]: r for r in readers.read_markdown(spark, str(tmp_path)).collect()}
    assert got["a.md"].has_bom and got["a.md"].text == "one\r\ntwo é" and not got["b.md"].has_bom
    assert not list(tmp_path.rglob("*.part"))


def test_names_and_reports(spark):
    df = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.free for r in sinks.free_names(df("a.md", "b.md", "c"), df("a.md", "a-4.md", "x.md")).collect()}
    assert got == {"a.md": "a-2.md", "b.md": "b.md", "c": "c"}
    assert sinks.chosen_files(spark, ["b.md", "a.md", "a.revised.md"], "all") == ["a.md", "b.md"]
    assert sinks.chosen_files(spark, [], "x.md； y.md,z.md") == ["x.md", "y.md", "z.md"]
    report = sinks.markdown_report(spark.createDataFrame([(1, "p|q"), (2, None)], "k int, v string").orderBy("k"), ["k", "v"], "T")
    assert report.split("\n") == ["# T", "", "| k | v |", "| --- | --- |", "| 1 | p\\|q |", "| 2 |  |", ""]


def test_images(spark):
    rows = [(1, "a.jpg", "iVBORw0KGgoAAA"), (1, "/../b", "data:image/jpeg;base64,/9j/4AAA"), (1, "", "iVBORw0KGgo="), (1, "c.png", "%%%"), (1, "d", "https://x"), (1, ".hid", "R0lGODlhAAA="), (2, "e.png", None)]
    images = spark.createDataFrame(rows, "doc int, src string, value string")
    got = {r.src: r for r in producer.image_records(images).collect()}
    assert got["a.jpg"].file == "media/a.png" and got["a.jpg"].state == "saved" and got["/../b"].file == "media/b.jpg" and got[".hid"].file == "media/.hid.gif"
    assert got[""].detail == "invalid name" and got["c.png"].state == "missing" and got["d"].detail == "not fetched" and got["e.png"].state == "missing"
    assert {r.state for r in producer.image_records(images, keep=False).filter("src <> ''").collect()} == {"remote"}
    text = spark.createDataFrame([(1, '<img src="http://a"> <img src="http://a"><img src="l.png"><img x src="https://b">')], "doc int, content string")
    assert sorted(r.src for r in producer.broken_images(text, spark.createDataFrame([(1, "https://b")], "doc int, src string")).collect()) == ["http://a", "http://a"]


def test_settings_and_conversion(spark):
    schema = "doc int, page_seq int, pruned string, markdown_text string, images map<string,string>"
    rows = [(1, 0, '{"model_settings": {}}', "a  \nb", {"i": "iVBORw0KGgo="}), (1, 1, '{"model_settings": {"z": 1}, "parsingResList": [{"content": "c"}, 7]}', '<img src="i">', {"i": "iVBORw0KGgo="}), (2, 0, "{}", " \n ", {}), (3, 0, "{}", "x", {})]
    results = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in producer.model_settings(producer.page_table(results)).collect()] == [(1, '{"z":1}')]
    sources = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "doc int")
    got = {r.doc: r for r in producer.convert(results, sources, spark.createDataFrame([(3,)], "doc int")).collect()}
    assert (got[1].status, got[1].markdown, got[1].pages, got[1].blocks, got[1].images_saved) == ("ok", 'a\nb\n<img src="media/i.png">', 2, 1, 1)
    assert (got[2].reason, got[3].reason, got[4].reason) == ("empty_markdown", "evidence_exists", "empty_markdown")


def test_fixture(spark):
    ship(spark)
    page = {"layout_det_res": {"boxes": list(range(20))}, "token": "t", "url": "https://x", "text": "y" * 300}
    pages = spark.createDataFrame([(1, k, json.dumps(page)) for k in range(4)], "doc int, page_seq int, pruned string")
    got = [json.loads(r.page) for r in capability.fixture(pages).collect()]
    assert len(got) == 2 and got[0]["layout_det_res"] == {"boxes": list(range(8)), "__boxes_total__": 20}
    assert got[0]["token"] == "<<redacted>>" and got[0]["url"].startswith("<<redacted-resource:") and got[0]["text"].startswith("y" * 200 + "<<truncated:300:")


def test_answers(spark):
    payloads = ['{"output_text": "yes"}', '{"output_text": " ", "output": [{"type": "reasoning", "content": [{"type": "text", "text": "no"}]}, {"type": "message", "content": [{"type": "output_text", "text": "a"}, {"type": "x", "text": "b"}, {"type": "text", "text": "c"}]}]}', '{"output": []}', "{}", "nothing", None]
    got = [r.a for r in spark.createDataFrame([(k, p) for k, p in enumerate(payloads)], "k int, p string").orderBy("k").select(prompt.answer_text(F.col("p")).alias("a")).collect()]
    assert got == ["yes", "a\nc", None, None, None, None]


def test_every_rule_of_predictions(spark):
    good = {"schema": labels.PREDICTION_SCHEMA, "window_id": "w0", "roles": [{"block_ref": "a", "role": "PROBLEM_START"}, {"block_ref": "b", "role": "UNCERTAIN"}], "boundaries": [{"left_ref": "a", "right_ref": "b", "relation": "SAME_PROBLEM"}], "splits": [], "uncertain": []}
    role = lambda *pairs: [{"block_ref": r, "role": x} for r, x in pairs]
    bad = {
        "schema": {"schema": "x"}, "window_id": {"window_id": "w1"}, "roles_empty": {"roles": []}, "unknown_role": {"roles": role(("a", "X"), ("b", "UNCERTAIN"))}, "role_outside_window": {"roles": role(("a", "UNCERTAIN"), ("z", "UNCERTAIN"))},
        "role_repeated": {"roles": role(("a", "UNCERTAIN"), ("a", "UNCERTAIN"))}, "roles_not_in_order": {"roles": role(("b", "UNCERTAIN"), ("a", "UNCERTAIN"))}, "boundaries_missing": {"boundaries": None}, "boundaries_not_in_order": {"boundaries": []},
        "unknown_relation": {"boundaries": [{"left_ref": "a", "right_ref": "b", "relation": "X"}]}, "split_outside_window": {"splits": [{"block_ref": "z", "anchor": "q"}]}, "split_without_anchor": {"splits": [{"block_ref": "a", "anchor": " "}]},
        "unknown_uncertain_kind": {"uncertain": [{"kind": "X", "refs": [], "reason": ""}]}, "uncertain_outside_window": {"uncertain": [{"kind": "ROLE", "refs": ["z"], "reason": ""}]}, "confidence_forbidden": {"uncertain": [{"kind": "ROLE", "refs": [], "reason": "confidence 0.9"}]},
    }
    rows = [("", json.dumps(good))] + [(k, json.dumps(good | v)) for k, v in bad.items()]
    df = spark.createDataFrame(rows, "want string, answer string").withColumn("p", labels.parse_response(F.col("answer"), prompt.PREDICTION))
    got = {r.want: r.e for r in df.select("want", labels.validation_error(F.col("p"), F.lit("w0"), F.array(F.lit("a"), F.lit("b"))).alias("e")).collect()}
    assert got.pop("") is None and got == {k: k for k in bad}


def test_units_keep_the_last(spark):
    df = spark.createDataFrame([([("u", "one"), ("v", None), ("u", "two")],)], "units array<struct<unit_id:string,raw_text:string>>")
    assert {r.unit_id: r.text for r in align.units_of(df).collect()} == {"u": "two", "v": ""}


@pytest.mark.parametrize("cutoff", [False, True])
def test_starts_in_order(spark, cutoff):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc") for _ in range(rng.choice([8, 20, 45, 60]))) for _ in range(8)]
    docs = {d: [rng.choice([rng.choice(texts)[: rng.choice([7, 15, 30, 60])] + "zz", "参考答案", "other text"]) for _ in range(14)] for d in range(12)}
    questions = spark.createDataFrame(list(enumerate(texts)), "question int, statement string")
    blocks = spark.createDataFrame([(d, k, t) for d, own in docs.items() for k, t in enumerate(own)], "doc int, pos int, content string")
    got = {(r.doc, r.question): (r.start, r.confidence) for r in align.starts_in_order(questions, blocks, cutoff).collect()}
    want = {}
    for d, own in docs.items():
        cursor = 0
        zone = next((k for k, t in enumerate(own) if 0 < len(t) <= 30 and any(m in t for m in align.MARKERS)), len(own))
        for q, statement in enumerate(texts):
            upper = zone if cutoff and zone > cursor else len(own)
            for rank, n in enumerate(align.PROBES):
                at = next((k for k in range(cursor, upper) if statement[:n] in own[k]), None) if len(statement[:n]) >= 6 else None
                if at is not None:
                    want[d, q] = (at, "exact" if rank == 0 else "approximate")
                    cursor = at
                    break
    assert got == want


def test_audit_collects_fatals(spark):
    rows = [(1, "r1", "x" * 400, "text_math", "fatal", None, "NORMALIZE_FATAL"), (1, "r2", "x=1", "text_math", "changed", "$x=1$", None), (1, "r3", "a", "preserve", "changed", "b", None)]
    changes, fatals = audit.collect(spark.createDataFrame(rows, "doc int, block_ref string, content string, profile string, status string, normalized_content string, diagnostic string"))
    assert [(r.block_ref, len(r.raw)) for r in fatals.collect()] == [("r1", 300)]
    assert [(r.block_ref, r.bucket, r.raw, r.new) for r in changes.collect()] == [("r2", "WRAP_MATH_ONLY", "x=1", "$x=1$")]


def test_types_of_values(spark):
    rows = [('{"s": "123", "t": "true", "n": 1, "f": 1.5, "b": false, "z": null, "a.b": "x", "o": {"k": "7"}, "l": [1]}',)]
    got = {(r.path, r.type) for r in structure.flat_types(spark.createDataFrame(rows, "j string"), "j").collect()}
    assert got == {("s", "str"), ("t", "str"), ("n", "int"), ("f", "float"), ("b", "bool"), ("z", "null"), ("a.b", "str"), ("o", "object"), ("l", "array")}
