"""Recorded provider envelopes as a Spark data source, batch and stream: a provider's answers again, without the provider.

A recording is a folder of files of JSON lines. A line is an envelope: `result.layoutParsingResults` is a list of pages, `doc`
names the document (else the file's name does), `first_page` is the place of its first page (else pages are counted through
the lines of the document in the recording, in order of files and lines).

    spark.dataSource.register(Recording)
    spark.read.format("recording").load(folder)
    spark.readStream.format("recording").load(folder)

Files are cut into ranges of `split_bytes`; a line belongs to the range in which it begins, so that one large file is read by
many tasks. The stream's offset is how many bytes of each file were taken, up to the last complete line; files may grow and
new ones may come, and `max_bytes` bounds each batch of a run but the first. A line that is no envelope gives one row that holds its fault.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.window import Window as W

from .shared import store

SCHEMA = "file string, at long, page int, doc string, first_page int, pruned string, markdown_text string, images map<string,string>, output_images map<string,string>, input_image string, data_info string, fault string"
SPLIT = 16 << 20
_STEP = 1 << 16


@dataclass
class Range(InputPartition):
    file: str
    begin: int
    end: int


def listed(folder: str) -> dict[str, int]:
    """Bytes of each file of a recording; names that begin with . or _ are not of it."""
    from pyarrow import fs

    files, at = store(folder)
    found = files.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
    return {f.path[len(at) :].lstrip("/"): f.size for f in found if f.is_file and not any(p.startswith((".", "_")) for p in f.path[len(at) :].split("/"))}


def _path(folder: str, file: str) -> str:
    return f"{folder.rstrip('/')}/{file}"


def _lines(folder: str, part: Range) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in the range."""
    files, path = store(_path(folder, part.file))
    with files.open_input_file(path) as f:
        size, at, rest = f.size(), part.begin, b""
        if at:  # the line that goes on at the beginning is not of this range
            at -= 1
            f.seek(at)
            while at < size:
                chunk = f.read(_STEP)
                if (k := chunk.find(b"\n")) >= 0:
                    at, rest = at + k + 1, chunk[k + 1 :]
                    break
                at += len(chunk)
        while at < part.end and (at < size):
            chunks, k = [rest], rest.find(b"\n")
            while k < 0 and (chunk := f.read(_STEP)):
                chunks.append(chunk)
                k = chunk.find(b"\n")
            data = b"".join(chunks)
            k = data.find(b"\n") if k >= 0 else len(data)
            yield at, data[:k]
            at, rest = at + k + 1, data[k + 1 :]


def _text(value) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _texts(value) -> dict:
    return {str(k): _text(v) for k, v in value.items()} if isinstance(value, dict) else {}


def rows_of_line(file: str, at: int, line: bytes) -> Iterator[tuple]:
    """The pages of an envelope. Parts of another type than they should be count as absent; numbers and objects in place of texts are written as JSON."""

    def fault(what: str) -> tuple:
        return (file, at, None, None, None, None, None, None, None, None, None, what)

    try:
        envelope = json.loads(line.decode("utf-8", "replace"))
    except (ValueError, RecursionError):
        yield fault("not_json")
        return
    result = envelope.get("result") if isinstance(envelope, dict) else None
    pages = result.get("layoutParsingResults") if isinstance(result, dict) else None
    if not isinstance(pages, list):
        yield fault("no_pages")
        return
    doc = _text(envelope.get("doc"))
    doc = file.rsplit("/", 1)[-1].split(".")[0] if doc is None else doc
    first = envelope.get("first_page")
    first = first if isinstance(first, int) and not isinstance(first, bool) else None
    info = envelope.get("dataInfo") or result.get("dataInfo")
    for k, page in enumerate(pages):
        page = page if isinstance(page, dict) else {}
        shown = page.get("markdown") if isinstance(page.get("markdown"), dict) else {}
        pruned = page.get("prunedResult")
        yield (
            file, at, k, doc, first, None if pruned is None else json.dumps(pruned, ensure_ascii=False), _text(shown.get("text")) or "", _texts(shown.get("images")), _texts(page.get("outputImages")),
            _text(page.get("inputImage")), _text(info) if isinstance(info, dict) else None, None,
        )


def _ranges(files: dict[str, tuple[int, int]], split: int) -> list[Range]:
    return [Range(f, at, min(at + split, end)) for f, (begin, end) in sorted(files.items()) for at in range(begin, end, split)]


class _Read:
    def __init__(self, options):
        self.folder, self.split = options["path"], int(options.get("split_bytes", SPLIT))
        self.most = int(options.get("max_bytes", 1 << 40))

    def read(self, partition: Range) -> Iterator[tuple]:
        for at, line in _lines(self.folder, partition):
            if line.strip():
                yield from rows_of_line(partition.file, at, line)


class _Batch(_Read, DataSourceReader):
    def partitions(self) -> list[Range]:
        return _ranges({f: (0, n) for f, n in listed(self.folder).items()}, self.split)


class _Stream(_Read, DataSourceStreamReader):
    """Offset: {file: bytes taken}. A batch goes on from the last one, file by file in order of names, until max_bytes are reached or nothing is left.

    The first batch of a run takes all there is: Spark doesn't tell a reader where the run before ended when it asks for the
    latest offset, and one that lay before it would make lines be read twice.
    """

    taken: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out, room = dict(self.taken or {}), 1 << 62 if self.taken is None else self.most
        for file, size in sorted(listed(self.folder).items()):
            begin = out.get(file, 0)
            if size <= begin or room <= 0:
                continue
            end = self._complete(file, begin, min(size, begin + room), size)
            if end > begin:
                out[file] = end
                room -= end - begin
        return out

    def _complete(self, file: str, begin: int, end: int, size: int) -> int:
        """Just behind the last line's end before `end`; behind the first one after it where a line is longer than that; `begin` where there is none."""
        files, path = store(_path(self.folder, file))
        with files.open_input_file(path) as f:
            at = end
            while at > begin:
                step = min(_STEP, at - begin)
                f.seek(at - step)
                if (k := f.read(step).rfind(b"\n")) >= 0:
                    return at - step + k + 1
                at -= step
            at = end
            f.seek(at)
            while at < size:
                chunk = f.read(min(_STEP, size - at))
                if (k := chunk.find(b"\n")) >= 0:
                    return at + k + 1
                at += len(chunk)
        return begin

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.taken = dict(end)
        return _ranges({f: (start.get(f, 0), n) for f, n in end.items() if n > start.get(f, 0)}, self.split)

    def commit(self, end: dict) -> None:
        self.taken = dict(end)


class Recording(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recording"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def read_recording(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Rows of SCHEMA, one a page, and one for each line that is no envelope."""
    spark.dataSource.register(Recording)
    return spark.read.format("recording").options(**options).load(folder)


def stream_recording(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(Recording)
    return spark.readStream.format("recording").options(**options).load(folder)


def results(pages: DataFrame) -> DataFrame:
    """Read pages -> doc, page_seq, pruned, markdown_text, images: what producers take. Pages of lines without first_page are counted through their document."""
    known = pages.filter("fault is null")
    kept = ["doc", "pruned", "markdown_text", "images"]
    said = known.filter("first_page is not null").select(*kept, (F.col("first_page") + F.col("page")).alias("page_seq"))
    rest = known.filter("first_page is null")
    lines = rest.groupBy("doc", "file", "at").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("doc").orderBy("file", "at")) - F.col("n")  # a row a line, without its pages
    counted = rest.join(lines.select("file", "at", before.alias("before")), ["file", "at"])
    return said.unionByName(counted.select(*kept, (F.col("before") + F.col("page")).cast("int").alias("page_seq")))


def observed(pages: DataFrame) -> DataFrame:
    """One nested row a document, as plain data: doc, page_count, data_info (of its first line that has any), pages in order (position, markdown_text, markdown_images, output_images, pruned_result, input_image)."""
    known = pages.filter("fault is null")
    page = F.struct("markdown_text", F.col("images").alias("markdown_images"), "output_images", F.col("pruned").alias("pruned_result"), "input_image")
    place = F.struct(F.coalesce("first_page", F.lit(0)).alias("first"), "file", "at", "page")
    by = lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0)  # noqa: E731  maps have no order
    nested = known.groupBy("doc").agg(F.count("*").alias("page_count"), F.min_by("data_info", F.when(F.col("data_info").isNotNull(), place)).alias("data_info"), F.array_sort(F.collect_list(F.struct(place.alias("place"), page.alias("own"))), by).alias("listed"))
    own = lambda p, k: F.struct(k.cast("int").alias("position"), *[p["own"][c].alias(c) for c in ("markdown_text", "markdown_images", "output_images", "pruned_result", "input_image")])
    return nested.select("doc", "page_count", "data_info", F.transform("listed", own).alias("pages"))


def record(results_table: DataFrame, folder: str, pages_a_line: int = 4) -> None:
    """results (doc, page_seq, pruned, markdown_text, images) -> a recording: envelopes of up to so many pages of a document."""
    page = F.concat(
        F.lit('{"prunedResult": '), F.coalesce("pruned", F.lit("null")), F.lit(', "markdown": '), F.to_json(F.struct(F.coalesce("markdown_text", F.lit("")).alias("text"), F.coalesce("images", F.create_map().cast("map<string,string>")).alias("images"))), F.lit("}")
    )
    line = F.floor(F.col("page_seq") / pages_a_line).alias("line")
    own = results_table.select("doc", "page_seq", line, page.alias("json")).groupBy("doc", "line").agg(F.array_sort(F.collect_list(F.struct("page_seq", "json"))).alias("own"))
    listed_pages = F.array_join(F.transform("own", lambda p: p["json"]), ", ")
    name = F.regexp_extract(F.to_json(F.struct(F.col("doc").cast("string").alias("d"))), r'^\{"d":(.*)\}$', 1)
    head = F.concat(F.lit('{"doc": '), name, F.lit(', "first_page": '), F.col("own")[0]["page_seq"].cast("string"))
    own.select(F.concat(head, F.lit(', "result": {"dataInfo": {"numPages": '), F.size("own").cast("string"), F.lit('}, "layoutParsingResults": ['), listed_pages, F.lit("]}}")).alias("value")).write.text(folder)
