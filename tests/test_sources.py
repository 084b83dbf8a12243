"""Readers and streams on small files."""

import json

from pyspark.sql import functions as F

from folioframe.sources import evidence, inputs
from folioframe.streaming import backoff


def test_evidence_and_view(spark, tmp_path):
    block = lambda p, k, label: {"block_ref": f"p{p:04d}:b{k:04d}", "sequence_index": k, "label": label, "content": f"c{k}"}
    doc = {"document_id": "d", "pages": [{"page_seq": p, "images": {"a": f"http://x/{p}"}, "blocks": [block(p, k, "text") for k in (1, 0)]} for p in (1, 0)]}
    (tmp_path / "a.evidence.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "b_prework").mkdir()
    (tmp_path / "b_prework" / "evidence.json").write_text(json.dumps(doc | {"document_id": "e"}))
    (tmp_path / "a.normalized.json").write_text(json.dumps({"document_id": "d", "blocks": [{"block_ref": "p0000:b0000", "status": "changed", "normalized_content": "x"}]}))
    read = evidence.read_evidence(spark, str(tmp_path))
    assert read.count() == 2
    blocks = evidence.flatten(read)
    assert [r.block_ref for r in blocks.filter("doc = 'd'").orderBy("pos").collect()] == ["p0000:b0000", "p0000:b0001", "p0001:b0000", "p0001:b0001"]
    joined = evidence.with_view(blocks, evidence.read_views(spark, str(tmp_path)))
    assert joined.count() == 8 and joined.filter("status = 'changed'").count() == 1
    names = {r[0].rsplit("/", 1)[1] for r in read.select(inputs.beside(F.col("path"), "view")).collect()}
    assert names == {"a.normalized.json", "normalized-view.json"}
    images = read.select(F.col("document_id").alias("doc"), F.explode("pages").alias("p")).select("doc", "p.page_seq", "p.images")
    assert {r.doc: r.images for r in evidence.merged_images(images).collect()}["d"] == {"a": "http://x/1"}


def test_provider_blocks(spark):
    pruned = json.dumps({"parsingResList": [{"blockLabel": "text", "block_content": "a", "order": 3, "bbox": [1, 2, 3, 4]}, "no block", {"label": "", "block_label": "image", "block_id": "x"}]})
    got = evidence.provider_blocks(spark.createDataFrame([("d", 0, pruned), ("e", 0, "not json")], "doc string, page_seq int, pruned string")).orderBy("sequence_index").collect()
    assert [(r.block_ref, r.label, r.content, r.provider_block_order, r.provider_block_id) for r in got] == [("p0000:b0000", "text", "a", 3, None), ("p0000:b0002", "image", "", None, None)]


def test_streams(spark, tmp_path):
    schema = "key string, seq long, delta int"
    spark.createDataFrame([("a", k, 1) for k in range(8)] + [("b", 0, -1)], schema).write.parquet(str(tmp_path / "in"))
    query = backoff.levels(backoff.arriving(spark, str(tmp_path / "in"), schema)).writeStream.format("memory").queryName("levels").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.key, r.seq): (r.level, r.cooldown) for r in spark.table("levels").collect()}
    assert got["a", 0] == (1, 5) and got["a", 7] == (5, 60) and got["b", 0] == (0, 0)
    for _ in range(2):
        backoff.ingest(backoff.arriving(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
