"""Reports by increments, and raw pages that were kept in part."""

import pytest
from pyspark.sql import functions as F

from folioframe.operators import gates, stats
from folioframe.sources import evidence as readers
from folioframe.streaming import reports


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(d, f"l{(d * p) % 4}") for d in range(60) for p in range(1 + (d * 7) % 13)] + [(99, None)], "doc long, label string")


def test_increments_equal_the_whole(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/state"
    for k in range(3):
        rows.filter(F.col("doc") % 3 == k).write.parquet(f"file://{tmp_path}/in/{k}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
        reports.keep(stream, folder, f"file://{tmp_path}/log").awaitTermination()
    total = reports.state(spark, folder)
    assert reports.corpus(total).collect() == stats.corpus_blocks(rows).collect()
    assert sorted(map(tuple, reports.labels(total).collect()), key=repr) == sorted(map(tuple, stats.label_histogram(rows).collect()), key=repr)
    per = rows.groupBy("doc").agg(F.count("*").alias("n"))
    ratios = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    assert tuple(reports.nearest_ranks(total, ratios).first()) == tuple(stats.nearest_rank_of(per, "n", ratios).first())
    # a batch that runs again replaces its own state
    again = rows.filter(F.col("doc") % 3 == 1)
    reports.partial(again).write.mode("overwrite").parquet(f"{folder}/batch=1")
    assert reports.corpus(reports.state(spark, folder)).collect() == stats.corpus_blocks(rows).collect()


def test_an_empty_report(spark, rows):
    assert tuple(reports.corpus(reports.partial(rows.limit(0))).first()) == (0, None, None, None, None)


def test_raw_counts(spark, tmp_path):
    raw = {
        "a/raw/page-0000.json": '{"parsing_res_list": [1, 2]}', "a/raw/page-0001.json": '{"pruned_result": {"parsing_res_list": [1]}}', "a/raw/page-0002.json": '{"parsing_res_list": [1', "a/raw/page-0003.json": '{"parsing_res_list": []}',
        "b/page-0001.json": '{"parsing_res_list": [1, 2, 3]}', "b/page-0002.json": '{"other": 1}', "b/page-0003.json": '{"parsing_res_list": [4]}', "b/page-x.json": "{}", "c/page-0005.json": "",
    }
    for name, text in raw.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    pages = spark.createDataFrame([("a", k) for k in range(5)] + [("b", k) for k in range(4)] + [("c", 9), ("a", 0)], "doc string, page_seq int")
    got = {(r.doc, r.page_seq): r.raw_count for r in gates.raw_counts(pages, readers.read_raw_pages(spark, f"file://{tmp_path}")).collect()}
    assert got == {("a", 0): 2, ("a", 1): 1, ("a", 2): None, ("a", 3): 0, ("a", 4): None, ("b", 0): 3, ("b", 1): 3, ("b", 2): 1, ("b", 3): 1, ("c", 9): None}
