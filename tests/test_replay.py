"""Recordings read back: ranges, faults, growing files, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from folioframe.session import ship
from folioframe.sources import replay


def line(doc, pages, first=None, **more):
    own = [{"prunedResult": {"width": 10 + k}, "markdown": {"text": t, "images": {f"i{k}": "x"}}, "outputImages": {"o": k}, "inputImage": "in"} for k, t in enumerate(pages)]
    return json.dumps({k: v for k, v in {"doc": doc, "first_page": first, "result": {"layoutParsingResults": own, "dataInfo": {"numPages": len(pages)}}, **more}.items() if v is not None}, ensure_ascii=False)


@pytest.fixture()
def folder(tmp_path):
    path = tmp_path / "rec"
    (path / "day=1").mkdir(parents=True)
    (path / "a.jsonl").write_text("\n".join([line("d1", ["é one", "two\nlines"], 0), "", line("d2", ["x" * 200_000], 5), "no json", '{"result": 3}', "[" * 100_000, line("d1", ["three"], 2)]) + "\n", encoding="utf-8")
    (path / "day=1" / "d9.jsonl").write_text(line(None, ["p"]) + "\n" + line(None, ["q", "r"]), encoding="utf-8")  # the last line has no end
    (path / "_skipped").write_text("no json\n")
    return path


PAGES = [("d1", 0, "é one"), ("d1", 1, "two\nlines"), ("d1", 2, "three"), ("d2", 5, "x" * 200_000), ("d9", 0, "p"), ("d9", 1, "q"), ("d9", 2, "r")]


@pytest.mark.parametrize("split", [1, 7, 1000, replay.SPLIT])
def test_every_line_once_whatever_the_ranges(folder, split):
    """Each line is read by the range in which it begins."""
    files = {f: (0, n) for f, n in replay.listed(str(folder)).items()}
    assert set(files) == {"a.jsonl", "day=1/d9.jsonl"}
    ranges = replay._ranges(files, split) if split > 1 else [replay.Range("day=1/d9.jsonl", k, k + 1) for k in range(files["day=1/d9.jsonl"][1])]
    got = [(r.file, at, data) for r in ranges for at, data in replay._lines(str(folder), r)]
    want = []
    for name in ["day=1/d9.jsonl"] if split == 1 else sorted(files):
        at = 0
        for part in (folder / name).read_bytes().split(b"\n"):
            if at < files[name][1]:
                want.append((name, at, part))
            at += len(part) + 1
    assert got == want


def test_batch(spark, folder):
    ship(spark)
    rows = replay.read_recording(spark, str(folder), split_bytes=1000)
    assert sorted(r.fault for r in rows.filter("fault is not null").collect()) == ["no_pages", "not_json", "not_json"]
    got = replay.results(rows)
    assert sorted((r.doc, r.page_seq, r.markdown_text) for r in got.collect()) == PAGES
    seen = {r.doc: r for r in replay.observed(rows).collect()}
    assert seen["d1"].page_count == 3 and [p.markdown_text for p in seen["d1"].pages] == ["é one", "two\nlines", "three"] and [p.position for p in seen["d1"].pages] == [0, 1, 2]
    assert seen["d1"].data_info == '{"numPages": 2}' and seen["d1"].pages[0].output_images == {"o": "0"} and seen["d1"].pages[0].pruned_result == '{"width": 10}'


def test_recorded_and_read_back(spark, tmp_path):
    ship(spark)
    data = [('a"1', k, json.dumps({"k": k}), f"text {k}\n", {"s": "v"}) for k in range(9)] + [("b", 0, None, None, None), ("ü", 3, "{}", "", {})]
    made = spark.createDataFrame(data, "doc string, page_seq int, pruned string, markdown_text string, images map<string,string>")
    replay.record(made, f"file://{tmp_path}/out")
    got = replay.results(replay.read_recording(spark, f"file://{tmp_path}/out")).select("doc", "page_seq", "pruned", "markdown_text", "images")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((d, k, p, t or "", i or {}) for d, k, p, t, i in data), key=repr)


def run(spark, folder, out, log, **options):
    started = replay.stream_recording(spark, str(folder), **options).writeStream.format("parquet").option("path", out).option("checkpointLocation", log).start()
    try:
        started.processAllAvailable()
        return [p["numInputRows"] for p in started.recentProgress if p["numInputRows"]]
    finally:
        started.stop()


def test_stream_goes_on_from_its_offsets(spark, folder, tmp_path):
    """A file that grows and one that comes later are taken by the next run, once; a line without an end waits."""
    ship(spark)
    out, log = f"file://{tmp_path}/out", f"file://{tmp_path}/log"
    assert run(spark, folder, out, log, max_bytes=100)
    read = lambda: spark.read.schema(replay.SCHEMA).parquet(out)
    shown = lambda: sorted((r.doc, r.markdown_text) for r in read().filter("fault is null").collect())
    first = [(d, t) for d, _, t in PAGES if t not in ("q", "r")]
    assert shown() == sorted(first)
    assert run(spark, folder, out, log, max_bytes=100) == []
    with (folder / "day=1" / "d9.jsonl").open("a", encoding="utf-8") as f:
        f.write("\n" + line("d9", ["s"]) + "\n" + line("d9", ["half"])[:30])
    (folder / "A.jsonl").write_text(line("d0", ["new"], 0) + "\n", encoding="utf-8")  # its name sorts before what was taken
    run(spark, folder, out, log, max_bytes=10)
    assert shown() == sorted([(d, t) for d, _, t in PAGES] + [("d9", "s"), ("d0", "new")])
    assert read().filter(F.col("fault").isNotNull()).count() == 3
    run(spark, folder, out, log)
    assert len(shown()) == len(PAGES) + 2


def test_batches_are_bounded(folder):
    """By max_bytes, at the end of a line; a longer line is a batch of its own."""
    stream, at = replay._Stream({"path": str(folder), "max_bytes": "300"}), {}
    stream.taken, seen = {}, []
    while (new := stream.latestOffset()) != at:
        parts = stream.partitions(at, new)
        seen.append([line for p in parts for _, line in replay._lines(str(folder), p)])
        at = new
    sizes = [sum(map(len, lines)) for lines in seen]
    assert len(seen) > 2 and all(n <= 300 or len(lines) == 1 for n, lines in zip(sizes, seen, strict=True))
    text = (folder / "a.jsonl").read_bytes() + (folder / "day=1" / "d9.jsonl").read_bytes().rsplit(b"\n", 1)[0]  # without the line that has no end
    assert sorted(line for lines in seen for line in lines) == sorted(text.rstrip(b"\n").split(b"\n"))
