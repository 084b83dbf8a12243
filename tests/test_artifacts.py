"""Files of documents: committed as a whole, written again only where they changed; the other sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from folioframe.session import ship
from folioframe.sources import artifacts, sinks


def table(spark, rows):
    return spark.createDataFrame(rows, "doc string, kind string, content string").repartition(3)


def there(spark, folder):
    return sorted((r.doc, r.kind, r.content) for r in artifacts.read_documents(spark, folder).collect())


ODD = [("a", "run", '{"k": 1}'), ("a", "view", "two"), ("../é/x", "run", "three"), ("__é_x", "run", "four"), ("é" * 300, "run", ""), (None, "run", None)]
SHOWN = sorted((d or "None", k, c or "") for d, k, c in ODD)


def test_written_once_and_read_back(spark, tmp_path):
    ship(spark)
    folder = f"file://{tmp_path}/out"
    assert artifacts.manifest(spark, f"file://{tmp_path}/none").collect() == []
    artifacts.write_documents(table(spark, ODD), folder)
    assert there(spark, folder) == SHOWN
    files = {f: os.stat(tmp_path / "out" / "files" / f).st_mtime_ns for f in os.listdir(tmp_path / "out" / "files")}
    assert len(files) == len(ODD) and all("/" not in f and len(f) < 200 for f in files)
    artifacts.write_documents(table(spark, [*ODD[1:], ("a", "run", '{"k": 2}')]), folder)
    assert {f: os.stat(tmp_path / "out" / "files" / f).st_mtime_ns for f in files} == files and len(os.listdir(tmp_path / "out" / "files")) == len(ODD) + 1
    assert there(spark, folder) == sorted([*(x for x in SHOWN if x[:2] != ("a", "run")), ("a", "run", '{"k": 2}')])
    artifacts.write_documents(table(spark, ODD[:1]), folder)  # back to what it was: the file is there already
    assert there(spark, folder) == SHOWN and len(os.listdir(tmp_path / "out" / "files")) == len(ODD) + 1
    assert [r["files"] for r in artifacts._runs(folder)] == [6, 1, 1]
    artifacts.write_documents(table(spark, []), folder)
    artifacts.write_documents(table(spark, ODD), folder, force=True)
    assert there(spark, folder) == SHOWN


def test_a_run_that_fails_leaves_nothing(spark, tmp_path):
    """Some tasks write their files, one fails: no document counts, none is half there, and what counted before still does."""
    ship(spark)
    folder = f"file://{tmp_path}/out"
    artifacts.write_documents(table(spark, ODD[:2]), folder)
    rows = spark.range(40).repartition(4).select(F.concat(F.lit("d"), "id").alias("doc"), F.lit("run").alias("kind"), F.when(F.col("id") == 39, F.raise_error(F.lit("broken"))).otherwise(F.repeat(F.lit("x"), 1000)).alias("content"))
    with pytest.raises(Exception, match="broken"):
        artifacts.write_documents(rows.unionByName(table(spark, [("a", "run", "new")])), folder, force=True)
    assert there(spark, folder) == sorted((d, k, c) for d, k, c in ODD[:2])
    assert len(artifacts._runs(folder)) == 1 and not [f for f in os.listdir(tmp_path / "out" / "files") if f.endswith(".part")]
    artifacts.write_documents(rows.filter("id <> 39"), folder)
    assert len(there(spark, folder)) == 41


def test_abort_keeps_what_other_runs_name(spark, tmp_path):
    ship(spark)
    folder = f"file://{tmp_path}/out"
    artifacts.write_documents(table(spark, ODD[:1]), folder)
    import pyarrow as pa

    writer = artifacts._Writer(folder, ["doc", "kind", "content"])
    batch = pa.RecordBatch.from_pydict({"doc": ["a", "z"], "kind": ["run", "run"], "content": [ODD[0][2], "new"]})
    message = writer.write(iter([batch]))
    assert len(os.listdir(tmp_path / "out" / "files")) == 2
    writer.abort([message, None])
    assert len(os.listdir(tmp_path / "out" / "files")) == 1 and there(spark, folder) == [ODD[0]]


def test_runs(spark):
    a = spark.createDataFrame([("x", 2, None), ("x", 1, "t")], "doc string, k int, v string")
    b = spark.createDataFrame([("y", 5)], "doc string, w int")
    got = {r.doc: json.loads(r.content) for r in artifacts.runs_of(a=a, b=b).collect()}
    assert got == {"x": {"a": [{"k": 1, "v": "t"}, {"k": 2, "v": None}], "b": []}, "y": {"a": [], "b": [{"w": 5}]}}


def test_tables_are_not_overwritten_unasked(spark, tmp_path):
    views = spark.createDataFrame([("d1", "b0", "ok"), ("d2", "b0", "fatal")], "doc string, block_ref string, status string")
    for write in (sinks.write_views, sinks.write_calls):
        path = f"file://{tmp_path}/{write.__name__}"
        write(views, path)
        assert sorted((r.doc, r.status) for r in spark.read.json(path).collect()) == [("d1", "ok"), ("d2", "fatal")]
        with pytest.raises(Exception, match="(?i)exists"):
            write(views, path)
    outcomes = spark.createDataFrame([("d1", "ok", "", 2, 10, 3, 1, 1), ("d2", "failed", "empty_markdown", 0, 0, 0, 0, 0), ("d3", "skipped", "evidence_exists", 0, 0, 0, 0, 0)], "doc string, status string, reason string, pages long, chars long, blocks long, images_total long, images_saved long")
    sinks.write_outcomes(outcomes, f"file://{tmp_path}/log")
    assert spark.read.json(f"file://{tmp_path}/log/status").count() == 3 and spark.read.json(f"file://{tmp_path}/log/summary").count() == 1
