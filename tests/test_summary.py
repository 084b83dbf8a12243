"""A document's summary against counts by hand; verdicts of gaps; what a wrapper hands on; images without links."""

import json

from pyspark.sql import functions as F

from folioframe.operators import capability, pressure, stats, structure
from folioframe.sources import evidence


def test_summary_by_hand(spark):
    box, no_box, line = [0.0, 0.0, 1.0, 1.0], [], [[0.0, 0.0]]
    rows = [
        ("a", 0, 0, "text", 5, box, None), ("a", 0, 1, "image", None, None, line), ("a", 0, 2, "chart", 3, no_box, line), ("a", 0, 3, "text", 4, box, []),
        ("a", 2, 0, "inline_formula", 1, box, line), ("b", 0, 0, None, None, None, None),
    ]
    blocks = spark.createDataFrame(rows, "doc string, page_seq int, sequence_index int, label string, provider_block_order int, bbox array<double>, polygon array<array<double>>")
    raw = spark.createDataFrame([("a", 0, 6), ("a", 1, 2), ("a", 2, None), ("c", 0, 0)], "doc string, page_seq int, raw_count long")
    assets = spark.createDataFrame([("a", "saved"), ("a", "missing"), ("a", "remote"), ("a", None), ("z", "saved")], "doc string, state string")
    pages = stats.per_page(blocks, raw)
    assert {(r.doc, r.page_seq): (r.blocks, r.conflicts, r.loss) for r in pages.collect()} == {("a", 0): (4, 1, 2), ("a", 1): (0, 0, 2), ("a", 2): (1, 0, None), ("b", 0): (1, 0, None), ("c", 0): (0, 0, 0)}
    got = {r.doc: r.asDict() for r in stats.document_summary(pages, assets).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"] == {
        "doc": "a", "pages": 3, "blocks": 5, "blocks_per_page_min": 0, "blocks_per_page_max": 4, "ordered": 4, "conflicts": 1, "pages_out_of_order": 1, "images": 2, "formulas": 1, "raw_pages_read": 2,
        "loss_blocks": 4, "pages_with_loss": 2, "assets": 4, "assets_saved": 1, "assets_missing": 1, "order_null_ratio": 0.2, "bbox_present_ratio": 0.6, "polygon_present_ratio": 0.6,
    }
    assert got["c"]["bbox_present_ratio"] is None and got["c"]["order_null_ratio"] is None and got["c"]["raw_pages_read"] == 1
    assert got["b"]["loss_blocks"] == 0 and got["b"]["assets"] == 0 and got["b"]["order_null_ratio"] == 1.0
    assert stats.document_summary(stats.per_page(blocks.limit(0), raw.limit(0)), assets).count() == 0


def test_gaps(spark):
    own = spark.createDataFrame([("some", True), ("none", False), ("unknown", None)], "k string, has boolean")
    verdict = lambda fields: {r.k: r.g for r in own.select("k", capability.gap(fields, F.col("has")).alias("g")).collect()}
    assert verdict(["markdown"]) == {"some": "B", "none": "A", "unknown": "A"}
    assert set(verdict(["pages_structured", "markdown"]).values()) == {"C"} and set(verdict(["blocks"]).values()) == {"C"}
    assert capability.wrapper_fields(own) == ["k", "has"]


def test_fields_of_blocks():
    got = structure.block_fields([{"block_bbox": None}, "no block", {"label": "x"}])
    assert {k for k, v in got.items() if v} >= {k for k, names in structure.BLOCK_FIELDS.items() if "block_bbox" in names or "label" in names}
    assert not any(structure.block_fields([]).values()) and not any(structure.block_fields([None, 3]).values())


def test_keys_of_envelopes(spark):
    lines = [json.dumps({"b": 1, "result": {"x": 1, "a": {}}}), json.dumps({"a": 2, "result": []}), "no json", "[1]", None, ""]
    got = evidence.envelope_keys(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r[0] for r in got] == [["a", "b", "result", "result.a", "result.x"]]
    assert evidence.envelope_keys(spark.createDataFrame([], "value string")).collect()[0][0] == []


def test_images_without_links(spark):
    own = spark.createDataFrame([({"a.png": "https://x/y?sign=1", "b.png": "plain/b.png"},), ({},), (None,)], "images map<string,string>")
    got = [r[0] for r in own.select(evidence.redacted_images(F.col("images"))).collect()]
    assert "https" not in json.dumps(got) and got[0]["b.png"] == "plain/b.png" and got[1] == {} and got[2] is None


def test_what_cools_down(spark):
    texts = ["code 12002", "read of a file: no space left on device", "all well", "", None]
    own = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("v", pressure.classify(F.col("t")))
    got = {r.k: (r.kind, r.cools) for r in own.select("k", "v.kind", pressure.cools_down(F.col("v")).alias("cools")).collect()}
    assert got[0] == ("REMOTE_BACKPRESSURE", True) and not any(cools for k, (_, cools) in got.items() if k)
