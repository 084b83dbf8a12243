"""Queries of predictions that hold splits and doubts, from a provider's answers to candidates and to the files of each document."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import assemble, calls, labels, predictions, prompt, reconcile
from ..operators import windows as W
from ..sources import artifacts
from ..sources.shared import fresh_path
from ..sources.tables import table, turns
from .registry import ORACLE, PARTS, query, sql
from .semantic import REASONS


def _judge(system: str, user: str, attempt: int) -> str:
    """Roles by label, place and number of characters; splits of some numbers; doubts about some windows."""
    window = json.loads(user.split("\n", 1)[1])
    own, roles, splits = window["blocks"], [], []
    for k, b in enumerate(own):
        n, number = len(b["raw_text"]), b["label"] == "number"
        role = "PROBLEM_CONTINUATION"
        if b["label"] == "header" or number and n % 7 == 0:
            role = "NON_PROBLEM"
        elif number and not (k == 0 and n % 5 == 0):
            role = "PROBLEM_START"
        roles.append({"block_ref": b["block_ref"], "role": role})
        anchor = b["raw_text"].split(" ")[-1][:3]
        if number and n % 3 == 0 and anchor.strip(" "):
            splits.append({"block_ref": b["block_ref"], "anchor": anchor})
    pairs = [{"left_ref": a["block_ref"], "right_ref": b["block_ref"], "relation": "NEW_PROBLEM" if b["role"] == "PROBLEM_START" else "SAME_PROBLEM"} for a, b in zip(roles, roles[1:], strict=False)]
    doubts = [{"kind": "ROLE", "refs": [own[0]["block_ref"]], "reason": "short"}] if sum(len(b["raw_text"]) for b in own) % 5 == 1 else []
    return json.dumps({"schema": labels.PREDICTION_SCHEMA, "window_id": window["window_id"], "roles": roles, "boundaries": pairs, "splits": splits, "uncertain": doubts}, ensure_ascii=False)


#: The same roles and splits in SQL, in place of the parts of these names.
LABELLED = """
      labelled as (select m.*, case when label = 'header' or label = 'number' and length(coalesce(content, '')) % 7 = 0 then 'NON_PROBLEM'
                                    when label = 'number' and not (pos_in_window = 0 and length(coalesce(content, '')) % 5 = 0) then 'PROBLEM_START' else 'PROBLEM_CONTINUATION' end as role from members m)"""
SPLITS = PARTS["splits"].replace("where label = 'number'", "where label = 'number' and length(content) % 3 = 0 and trim(left(list_last(string_split(content, ' ')), 3), ' ') <> ''")


def _sql(text: str) -> str:
    return text.replace(PARTS["labelled"], LABELLED).replace(PARTS["splits"], SPLITS)


def judged(spark, d):
    """Members of windows, and the windows with their predictions, which a folder of calls holds."""
    members = W.membership(turns(table(spark, d, "conversations")))
    own = prompt.prompts(members)
    return members, calls.predictions(own, calls.ask(own, _judge, fresh_path(spark, "calls")))


def reasons(spark, d):
    members, predicted = judged(spark, d)
    own = predictions.roles(predicted, members)
    return reconcile.expansion_reasons(own, reconcile.roles(own), reconcile.boundaries(predictions.boundaries(predicted)), predictions.splits(predicted, members), predictions.uncertain(predicted))


ALL_REASONS = _sql(REASONS) + """, ends as (select doc, window_index, min(pos) as low, max(pos) as high, sum(length(coalesce(content, ''))) % 5 = 1 as unsure from labelled group by doc, window_index),
  edge as (select distinct e.doc, e.window_index from ends e join labelled l on l.doc = e.doc and l.window_index = e.window_index and l.pos in (e.low, e.high)
           where l.label = 'number' and length(l.content) % 3 = 0 and trim(left(list_last(string_split(l.content, ' ')), 3), ' ') <> ''),
  six as (select n.doc, n.window_index, n.window_id, concat_ws('|', case when e.unsure then 'MODEL_UNCERTAIN' end, case when starts_with(n.reasons, 'OVERLAP_CONFLICT') then 'OVERLAP_CONFLICT' end, case when g.doc is not null then 'EDGE_SPLIT' end,
                 nullif(regexp_replace(n.reasons, '^OVERLAP_CONFLICT\\|?', ''), '')) as reasons
          from named n join ends e using (doc, window_index) left join edge g on g.doc = n.doc and g.window_index = n.window_index)"""


@query("predicted_expansion_reasons", ALL_REASONS + " select * from six")
def q_reasons(spark, d):
    return reasons(spark, d).withColumn("reasons", F.array_join("reasons", "|"))


@query("predicted_expansion_histogram", ALL_REASONS + " select reason, count(*) as n from (select unnest(string_split(reasons, '|')) as reason from six where reasons <> '') group by reason")
def q_histogram(spark, d):
    return reconcile.reason_histogram(reasons(spark, d))


def _cut(spark, d):
    """Blocks with their fates, and the splits of the predictions."""
    members, predicted = judged(spark, d)
    stream = turns(table(spark, d, "conversations"))
    own = assemble.assigned(assemble.decided(stream, reconcile.roles(predictions.roles(predicted, members))))
    return own, predictions.resolved(predictions.splits(predicted, members))


@query("predicted_splits", _sql(ORACLE["split_resolution"]))
def q_splits(spark, d):
    return _cut(spark, d)[1].select("doc", "block_ref", "anchor", "split.status", "split.start", "split.end")


@query("predicted_candidates", _sql(ORACLE["candidates_with_splits"]))
def q_candidates(spark, d):
    return assemble.candidate_refs(*_cut(spark, d)).select("doc", "candidate_number", "block_ref", "start", "end")


@query(
    "semantic_run_files",
    _sql(sql("roles", "edges", "splits", then="""select t.doc, (select count(*) from windows w where w.doc = t.doc) as windows, (select count(*) from roles r where r.doc = t.doc) as roles, (select count(*) from roles r where r.doc = t.doc and conflict) as conflicts,
        (select count(*) from edges e where e.doc = t.doc) as edges, (select count(*) from splits s where s.doc = t.doc) as splits from (select distinct doc from turns) t""")),
)
def q_files(spark, d):
    """A file a document, written twice: the second run has nothing to write."""
    members, predicted = judged(spark, d)
    own = predictions.roles(predicted, members)
    folder = fresh_path(spark, "runs")
    windows = W.windows(turns(table(spark, d, "conversations")))
    split_table = predictions.resolved(predictions.splits(predicted, members)).select("doc", "block_ref", "anchor", "split")
    runs = artifacts.runs_of(windows=windows, roles=reconcile.roles(own), edges=reconcile.boundaries(predictions.boundaries(predicted)), splits=split_table)
    for _ in range(2):
        artifacts.write_documents(runs.withColumn("kind", F.lit("semantic-run")), folder)
    size = lambda name: F.json_array_length(F.get_json_object("content", f"$.{name}")).cast("long").alias(name)
    conflicts = F.size(F.filter(F.from_json(F.get_json_object("content", "$.roles"), "array<struct<conflict:boolean>>"), lambda r: r["conflict"])).cast("long")
    return artifacts.read_documents(spark, folder).select(F.col("doc").cast("long").alias("doc"), size("windows"), size("roles"), conflicts.alias("conflicts"), size("edges"), size("splits"))
