"""One file a document, with a commit: what a run wrote counts as a whole or not at all, and a second run writes only what changed.

    folder/files/<document>-<digest>.<kind>.json   written beside its place and moved, never changed afterwards
    folder/parts/<run>/...                         what each task wrote, as JSON lines
    folder/runs/<time>-<run>.json                  the commit: which parts belong to the run

A file's name holds the digest of its content, so two contents never meet and no run disturbs what another wrote. Only files
that a committed run names are there for readers; of a document and kind the last run counts. If a job fails, its files are
taken away again, but for those that a committed run names too; if its driver dies, they are only never named.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .shared import put, store

MANIFEST = "doc string, kind string, file string, bytes long, sha256 string, made boolean"


@dataclass
class Written(WriterCommitMessage):
    part: str | None
    files: int


def file_name(doc: str, kind: str, digest: str) -> str:
    """A name that is safe and of bounded length; what is not plain in the document's name is told apart by the digest of the name."""
    plain = re.sub(r"[^A-Za-z0-9._-]", "_", doc)[:80].lstrip("._") or "d"  # names that begin with these are hidden
    mark = "" if plain == doc else "-" + hashlib.sha256(doc.encode()).hexdigest()[:12]
    return f"{plain}{mark}-{digest[:16]}.{kind}.json"


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, names: list[str]):
        self.folder, self.run, self.names = folder.rstrip("/"), uuid.uuid4().hex, names
        if sorted(names) != ["content", "doc", "kind"]:
            raise ValueError("columns must be doc, kind and content")

    def write(self, iterator) -> Written:
        files, base = store(self.folder)
        lines = []
        for batch in iterator:
            for doc, kind, content in zip(*(batch.column(self.names.index(c)).to_pylist() for c in ("doc", "kind", "content")), strict=True):
                data = (content or "").encode()
                digest = hashlib.sha256(data).hexdigest()
                name = file_name(str(doc), str(kind), digest)
                made = files.get_file_info(f"{base}/files/{name}").type.name == "NotFound"
                if made:
                    put(f"{self.folder}/files/{name}", data)
                lines.append(json.dumps({"doc": doc, "kind": kind, "file": name, "bytes": len(data), "sha256": digest, "made": made}, ensure_ascii=False))
        if not lines:
            return Written(None, 0)
        part = f"parts/{self.run}/{uuid.uuid4().hex}.json"
        put(f"{self.folder}/{part}", ("\n".join(lines) + "\n").encode())
        return Written(part, len(lines))

    def commit(self, messages) -> None:
        done = [m for m in messages if m is not None and m.part]
        name = f"{time.time_ns():020d}-{self.run}.json"
        put(f"{self.folder}/runs/{name}", json.dumps({"parts": sorted(m.part for m in done), "files": sum(m.files for m in done)}).encode())

    def abort(self, messages) -> None:
        """What tasks that ended had made is taken away; tasks that failed leave whole files that no run names."""
        files, base = store(self.folder)
        named = {line["file"] for run in _runs(self.folder) for part in run["parts"] for line in _lines(files, f"{base}/{part}")}
        for m in messages:
            for line in _lines(files, f"{base}/{m.part}") if m is not None and m.part else ():
                if line["made"] and line["file"] not in named:
                    files.delete_file(f"{base}/files/{line['file']}")


def _lines(files, path: str) -> list[dict]:
    with files.open_input_stream(path) as f:
        return [json.loads(x) for x in f.read().splitlines()]


def _runs(folder: str) -> list[dict]:
    """The committed runs, first ones first."""
    from pyarrow import fs

    files, base = store(folder)
    found = files.get_file_info(fs.FileSelector(f"{base}/runs", allow_not_found=True))
    out = []
    for info in sorted(found, key=lambda f: f.path):
        if info.path.endswith(".json") and not info.base_name.startswith("."):
            with files.open_input_stream(info.path) as f:
                out.append(json.loads(f.read()))
    return out


class Artifacts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artifacts"

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options["path"], [f.name for f in schema.fields])


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """doc, kind, file, bytes, sha256 of what is there: of each document and kind what the last committed run that has it says."""
    parts = [(k, f"{folder.rstrip('/')}/{p}") for k, run in enumerate(_runs(folder)) for p in run["parts"]]
    if not parts:
        return spark.createDataFrame([], MANIFEST).drop("made")
    rows = spark.read.schema(MANIFEST).json([p for _, p in parts]).withColumn("part", F.element_at(F.split("_metadata.file_path", "/"), -1))
    order = spark.createDataFrame([(k, p.rsplit("/", 1)[1]) for k, p in parts], "run int, part string")  # a row a task
    last = rows.join(F.broadcast(order), "part").groupBy("doc", "kind").agg(F.max_by(F.struct("file", "bytes", "sha256"), "run").alias("last"))
    return last.select("doc", "kind", "last.*")


def write_documents(documents: DataFrame, folder: str, force: bool = False) -> None:
    """documents (doc, kind, content) -> one file each below folder, in one run.

    Documents whose content is there already are not written again, unless force is said. A document and kind must come once;
    if it comes more often, any of them counts. Null contents are empty, null names are "None".
    """
    spark = documents.sparkSession
    spark.dataSource.register(Artifacts)
    own = documents.select(F.coalesce(F.col("doc").cast("string"), F.lit("None")).alias("doc"), F.coalesce(F.col("kind").cast("string"), F.lit("None")).alias("kind"), F.coalesce("content", F.lit("")).alias("content"))
    if not force:
        have = manifest(spark, folder).select("doc", "kind", "sha256")
        own = own.withColumn("sha256", F.sha2("content", 256)).join(have, ["doc", "kind", "sha256"], "left_anti").drop("sha256")
    own.write.format("artifacts").mode("append").save(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc, kind, content of what is there; the content of a file that somebody took away is null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{folder.rstrip('/')}/files")
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.decode("content", "UTF-8").alias("content"))
    held = F.when(F.col("bytes") == 0, F.lit("")).otherwise(F.col("content"))  # empty files have no row
    return manifest(spark, folder).join(named, "file", "left").select("doc", "kind", held.alias("content"))


def runs_of(**tables: DataFrame) -> DataFrame:
    """Tables with a column doc -> doc, content: one JSON object a document that holds each table's rows of it as a list, in order of their columns. Documents that a table lacks have an empty list there."""
    out, names = None, sorted(tables)
    for name in names:
        df = tables[name]
        row = F.struct(*[c for c in df.columns if c != "doc"])
        own = df.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct(row.alias("r")))), lambda x: x["r"]).alias(name))
        out = own if out is None else out.join(own, "doc", "full")
    whole = F.struct(*[F.coalesce(name, F.array().cast(out.schema[name].dataType)).alias(name) for name in names])
    return out.select("doc", F.to_json(whole, {"ignoreNullFields": "false"}).alias("content"))
