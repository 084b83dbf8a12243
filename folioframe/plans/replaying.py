"""Queries over recordings: provider results of documents' lines, recorded in the shared folder and read back by the data source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls, labels, pressure, producer, prompt
from ..sources import replay
from ..sources.evidence import provider_blocks
from ..sources.shared import fresh_path
from ..sources.tables import table
from ..streaming import backoff
from .producing import PAGES, _members
from .producing import results as provided
from .registry import query, sql


def recorded(spark, d) -> str:
    folder = fresh_path(spark, "recording")
    replay.record(provided(spark, d), folder)
    return folder


REPLAYED = PAGES + "select doc, page_seq, cast(page_seq + 600 as int) as width, 800 as height, cast(least(n, 3) as int) as boxes, page_seq = 1 as preprocessed, case when page_seq = 1 then '{\"use_doc_preprocessor\":true}' end as settings, sha256(md) as text_sha256 from pg"


def _shown(results):
    rows = results.withColumn("doc", F.col("doc").cast("long"))
    return producer.page_table(rows).select("doc", "page_seq", "width", "height", "boxes", "preprocessed", "settings", F.sha2("markdown_text", 256).alias("text_sha256"))


@query("replayed_pages", sql("blocks", then=REPLAYED))
def q_replayed(spark, d):
    return _shown(replay.results(replay.read_recording(spark, recorded(spark, d))))


@query("replayed_pages_streamed", sql("blocks", then=REPLAYED))
def q_streamed(spark, d):
    """What is recorded later is taken by a second run, which goes on from the offsets of the first; batches are bounded."""
    folder, out, log = fresh_path(spark, "recording"), fresh_path(spark, "replayed"), fresh_path(spark, "log")
    for k in range(2):
        replay.record(provided(spark, d).filter(F.pmod("doc", F.lit(2)) == k), f"{folder}/day={k}")
        stream = replay.stream_recording(spark, folder, max_bytes=64 << 20)
        started = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).start()
        try:
            started.processAllAvailable()
        finally:
            started.stop()
    return _shown(replay.results(spark.read.schema(replay.SCHEMA).parquet(out)))


@query("replayed_blocks", sql("blocks", then="select doc, page_seq, sequence_index, block_ref, pos as provider_block_id, provider_block_order, label, sha256(content) as content_sha256 from blocks"))
def q_replayed_blocks(spark, d):
    rows = provider_blocks(replay.results(replay.read_recording(spark, recorded(spark, d), split_bytes=1 << 20)))
    return rows.select(F.col("doc").cast("long").alias("doc"), "page_seq", "sequence_index", "block_ref", "provider_block_id", "provider_block_order", "label", F.sha2("content", 256).alias("content_sha256"))


@query(
    "observed_documents",
    sql("blocks", then=PAGES + """select doc, count(*) as page_count, 'numPages' as info_keys, sha256(string_agg(md, chr(10) order by page_seq)) as text_sha256, cast(sum(n) as bigint) as blocks,
        string_agg('/imgs/../p' || page_seq || '.png', '|' order by page_seq) as images from pg group by doc"""),
)
def q_observed(spark, d):
    out = replay.observed(replay.read_recording(spark, recorded(spark, d)))
    blocks = F.aggregate("pages", F.lit(0).cast("long"), lambda n, p: n + F.json_array_length(F.get_json_object(p["pruned_result"], "$.parsing_res_list")))
    return out.select(
        F.col("doc").cast("long").alias("doc"), "page_count", F.array_join(F.json_object_keys("data_info"), ",").alias("info_keys"), F.sha2(F.array_join(F.transform("pages", lambda p: p["markdown_text"]), "\n"), 256).alias("text_sha256"), blocks.alias("blocks"),
        F.array_join(F.flatten(F.transform("pages", lambda p: F.map_keys(p["markdown_images"]))), "|").alias("images"),
    )


# ---- calls that are recorded

EXPECTED = """, x as (select doc, window_index, count(*) as n, sum(length(coalesce(content, ''))) % 7 = 6 as never, sum(length(coalesce(content, ''))) % 3 = 2 as late from members group by doc, window_index)"""


def _by_size(system: str, user: str, attempt: int) -> str:
    """Answers with one problem; windows of certain numbers of characters only at the second attempt, or never."""
    import json

    window = json.loads(user.split("\n", 1)[1])
    n = sum(len(b["raw_text"]) for b in window["blocks"])
    if n % 7 == 6 or n % 3 == 2 and attempt == 1:
        return "no json" if attempt == 1 else '{"schema": "other"}'
    refs = [b["block_ref"] for b in window["blocks"]]
    roles = [{"block_ref": r, "role": "PROBLEM_CONTINUATION" if i else "PROBLEM_START"} for i, r in enumerate(refs)]
    pairs = [{"left_ref": a, "right_ref": b, "relation": "SAME_PROBLEM"} for a, b in zip(refs, refs[1:], strict=False)]
    return json.dumps({"schema": labels.PREDICTION_SCHEMA, "window_id": window["window_id"], "roles": roles, "boundaries": pairs, "splits": [], "uncertain": []})


def asked(spark, d):
    """Windows, and a folder in which a first run recorded one attempt and a second one went on."""
    own, folder = prompt.prompts(_members(spark, d)), fresh_path(spark, "calls")
    for attempts in (1, 2):
        calls.ask(own, _by_size, folder, attempts=attempts)
    return own, folder


@query("recorded_predictions", sql("members", then=EXPECTED + "select doc, window_index, case when never or late then 2 else 1 end as tries, not never as ok, case when never then 'not_an_object|schema' when late then 'not_an_object' else '' end as errors, case when never then 'schema' end as error, case when not never then cast(n as int) end as roles from x"))
def q_recorded_predictions(spark, d):
    own, folder = asked(spark, d)
    out = calls.predictions(own, calls.recorded(spark, folder))
    return out.select("doc", "window_index", F.size("tries").alias("tries"), F.col("prediction").isNotNull().alias("ok"), F.array_join(F.transform("tries", lambda t: t["error"]), "|").alias("errors"), "error", F.when(F.col("prediction").isNotNull(), F.size("prediction.roles")).alias("roles"))


@query("recorded_calls", sql("members", then=EXPECTED + "select attempt, count(*) as calls, count(*) as requests from x, (values (1), (2)) a(attempt) where attempt = 1 or never or late group by attempt"))
def q_recorded_calls(spark, d):
    """All rows that two runs wrote, not only the different ones."""
    _, folder = asked(spark, d)
    rows = spark.read.schema(calls.CALLS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/calls")
    return rows.groupBy("attempt").agg(F.count("*").alias("calls"), F.countDistinct("request").alias("requests"))


@query("call_records", sql("members", then=EXPECTED + "select doc, printf('w%04d', window_index) as window_id, cast(n as int) as window_size, cast(case when never or late then 2 else 1 end as int) as attempts, case when not never then printf('w%04d', window_index) end as predicted from x"))
def q_call_records(spark, d):
    own = prompt.prompts(_members(spark, d))
    out = calls.records(calls.predictions(own, calls.ask(own, _by_size, fresh_path(spark, "calls"))))
    return out.select("doc", "window_id", "window_size", F.size("attempts").alias("attempts"), F.get_json_object("prediction", "$.window_id").alias("predicted"))


# ---- back-off by event time

#: Each step of a cooldown is this many seconds: events of a key are hours apart.
STEP_SECONDS = 3600
DEADLINES = f"""with recursive e as (select user_id as key, event_id, ts, case event_type when 'error' then 1 when 'purchase' then -1 else 0 end as d, row_number() over (partition by user_id order by ts, event_id) as k from events),
   f as (select key, event_id, ts, d, k, least(greatest(d, 0), 5) as level from e where k = 1
         union all select e.key, e.event_id, e.ts, e.d, e.k, least(greatest(f.level + e.d, 0), 5) from f join e on e.key = f.key and e.k = f.k + 1),
   p as (select *, case when d > 0 then ts + to_seconds([0, 5, 10, 20, 40, 60][level + 1] * {STEP_SECONDS}) end as own from f),
   l as (select *, max(case when d > 0 then k end) over (partition by key order by k) as cause, min(case when d > 0 then ts end) over (partition by key order by k rows between 1 following and unbounded following) as next from p),
   o as (select key, event_id as seq, ts as "at", 'event' as kind, level, (select q.own from p q where q.key = l.key and q.k = l.cause) as until from l
         union all select key, null, own, 'expired', null, null from l where own is not null and (next is null or next >= own))
   select cast(key as varchar) as key, seq, "at", kind, cast(coalesce(level, (select x.level from l x where x.key = o.key and x.ts < o."at" order by x.k desc limit 1)) as int) as level, case when until > "at" then until end as until from o"""


def timed_events(spark, d):
    delta = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", -1).otherwise(0)
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("at"), delta.alias("delta"))


@query("backoff_deadlines", DEADLINES)
def q_deadlines(spark, d):
    return pressure.deadlines(timed_events(spark, d), STEP_SECONDS)


@query("backoff_deadlines_streamed", DEADLINES)
def q_deadlines_streamed(spark, d):
    """Eight batches, whose events overlap and in part repeat, and a last event of no key's that lets the watermark pass all cooldowns."""
    folder, out, log = (fresh_path(spark, x) for x in ("arriving", "levels", "log"))
    own = timed_events(spark, d)
    last = own.agg(F.max("at").alias("at")).select(F.lit("~").alias("key"), F.lit(0).cast("long").alias("seq"), (F.col("at") + F.expr("interval 90 days")).alias("at"), F.lit(0).alias("delta"))
    day = F.floor(F.dayofyear("at") / 7).cast("int")
    shuffled = own.withColumn("file", day + F.pmod(F.xxhash64("seq"), F.lit(2)).cast("int"))  # half of the events come with those of the week after
    again = own.filter("seq % 10 = 0").withColumn("file", day + 1)
    for k, rows in enumerate([*(shuffled.unionByName(again).filter(f"file = {i}").drop("file") for i in range(7)), last]):
        rows.write.mode("append").parquet(f"{folder}/{k}")
    backoff.state_store(spark)
    files = len(spark.read.option("recursiveFileLookup", True).parquet(folder).inputFiles())
    arriving = spark.readStream.schema(own.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", -(-files // 8)).parquet(folder)
    started = backoff.timed(arriving, STEP_SECONDS, "21 days").writeStream.format("parquet").option("path", out).option("checkpointLocation", log).start()
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    return spark.read.parquet(out).filter("key <> '~'")
