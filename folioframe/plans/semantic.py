"""Windows, labels, reconciliation, assembly and gates over conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble, gates, labels, reconcile, windows
from ..sources.tables import blocks, table, turns
from .registry import query, sql


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(table(spark, sf_dir, "conversations"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_roles(windows.membership(_turns(spark, sf_dir)))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.assigned(assemble.decided(_turns(spark, sf_dir), reconcile.roles(_labelled(spark, sf_dir))))


def _splits(labelled: DataFrame) -> DataFrame:
    """Of each number block the first anchor: the first three characters of its last word."""
    anchor = F.left(F.element_at(F.split("content", " "), -1), F.lit(3))
    found = labelled.filter("label = 'number'").select("doc", "window_index", F.col("pos").alias("split_pos"), "block_ref", "content", anchor.alias("anchor"))
    found = assemble.first_splits(found)
    return found.withColumn("split", assemble.resolve_split(F.col("content"), F.col("anchor")))


@query("windows", sql("windows", then="select doc, window_index, window_id, start_index, end_index, end_index - start_index as window_size from windows"))
def q_windows(spark, d):
    return windows.windows(_turns(spark, d))


@query("window_membership", sql("members", then="select doc, window_index, window_id, pos, block_ref, cast(pos_in_window as int) as pos_in_window from members"))
def q_membership(spark, d):
    return windows.membership(_turns(spark, d)).select("doc", "window_index", "window_id", "pos", "block_ref", "pos_in_window")


def _expanded(size: int) -> str:
    return sql(
        "windows",
        then=f"""select doc, window_index, window_id, cast(s2 as int) as start_index, cast(e2 as int) as end_index, cast(e2 - s2 as int) as window_size from (
          select *, s1 - least(s1, lack) as s2, least(n, e1 + lack - least(s1, lack)) as e2 from (
            select *, greatest(0, least({size}, n) - (e1 - s1)) as lack from (
              select *, greatest(0, start_index - extra // 2) as s1, least(n, end_index + extra - extra // 2) as e1 from (
                select *, greatest({size} - (end_index - start_index), 0) as extra from windows))))""",
    )


def _expand(size: int):
    def run(spark, d):
        stream = _turns(spark, d)
        return windows.expand(windows.windows(stream), stream.groupBy("doc").agg(F.count("*").cast("int").alias("n")), size)

    return run


for _size in (9, 13):
    query(f"window_expand_{_size}", _expanded(_size))(_expand(_size))


@query("label_roles", sql("labelled", then="select doc, window_index, pos, block_ref, role from labelled"))
def q_label_roles(spark, d):
    return _labelled(spark, d).select("doc", "window_index", "pos", "block_ref", "role")


@query("sequential_roles", sql("members", then="select doc, window_index, pos, case when pos_in_window % 3 = 0 then 'PROBLEM_START' else 'PROBLEM_CONTINUATION' end as role from members"))
def q_sequential(spark, d):
    return labels.sequential_roles(windows.membership(_turns(spark, d))).select("doc", "window_index", "pos", "role")


@query("label_boundaries", sql("bounds", then="select * from bounds"))
def q_boundaries(spark, d):
    return labels.boundaries(_labelled(spark, d)).select("doc", "window_index", "left_ref", "right_ref", "relation")


#: Each seventh kind of window gets its own fault.
FAULTS = ["schema", "window_id", "roles_empty", "unknown_role", "boundaries_not_in_order", "split_without_anchor", None]


@query(
    "validate_predictions",
    sql(
        "windows",
        then="""select doc, window_index, case (doc + window_index) % 7 when 0 then 'schema' when 1 then 'window_id' when 2 then 'roles_empty' when 3 then 'unknown_role'
             when 4 then case when end_index - start_index > 1 then 'boundaries_not_in_order' end when 5 then 'split_without_anchor' end as error from windows""",
    ),
)
def q_validate(spark, d):
    p = labels.predictions(_labelled(spark, d))
    kind, own = F.pmod(F.col("doc") + F.col("window_index"), F.lit(7)), F.col("prediction")
    empty = F.slice(own["roles"], 1, 0)
    broken = (
        own.withField("schema", F.when(kind == 0, "other/v0").otherwise(own["schema"]))
        .withField("window_id", F.when(kind == 1, "w9999").otherwise(own["window_id"]))
        .withField("roles", F.when(kind == 2, empty).when(kind == 3, F.transform(own["roles"], lambda r: r.withField("role", F.lit("TITLE")))).otherwise(own["roles"]))
        .withField("boundaries", F.when(kind == 4, F.slice(own["boundaries"], 1, 0)).otherwise(own["boundaries"]))
        .withField("splits", F.when(kind == 5, F.array(F.struct(F.col("refs")[0].alias("block_ref"), F.lit(" ").alias("anchor")))).otherwise(own["splits"]))
    )
    return p.select("doc", "window_index", labels.validation_error(broken, F.col("window_id"), F.col("refs")).alias("error"))


@query("reconciled_roles", sql("roles", then="select * from roles"))
def q_roles(spark, d):
    return reconcile.roles(_labelled(spark, d))


@query("role_conflicts", sql("roles", then="select doc, block_ref, found from roles where conflict"))
def q_conflicts(spark, d):
    return reconcile.roles(_labelled(spark, d)).filter("conflict").select("doc", "block_ref", "found")


@query("reconciled_boundaries", sql("edges", then="select * from edges"))
def q_edges(spark, d):
    return reconcile.boundaries(labels.boundaries(_labelled(spark, d)))


REASONS = sql(
    "roles", "edges",
    then="""
    , per as (
      select l.doc, l.window_index, l.window_id, bool_or(r.conflict) as role_hit,
             bool_or((l.label = 'number' and l.role in ('NON_PROBLEM', 'SHARED_CONTEXT')) or (l.label in ('display_formula', 'inline_formula') and l.role = 'PROBLEM_START')) as signal,
             arg_min(l.role, l.pos) as head, arg_max(l.role, l.pos) as tail
      from labelled l join roles r on l.doc = r.doc and l.block_ref = r.block_ref group by all),
    hits as (select distinct b.doc, b.window_index from bounds b join edges e on b.doc = e.doc and b.left_ref = e.left_ref and b.right_ref = e.right_ref where e.conflict),
    named as (
      select per.*, concat_ws('|', case when role_hit or h.doc is not null then 'OVERLAP_CONFLICT' end,
                 case when head in ('PROBLEM_CONTINUATION', 'SOLUTION_CONTINUATION') then 'HEAD_CONTINUATION' end,
                 case when tail in ('PROBLEM_CONTINUATION', 'SOLUTION_CONTINUATION') then 'TAIL_CONTINUATION' end,
                 case when signal then 'SIGNAL_CONFLICT' end) as reasons
      from per left join hits h on per.doc = h.doc and per.window_index = h.window_index)
    """,
)


def _reasons(spark, d):
    labelled = _labelled(spark, d)
    return reconcile.expansion_reasons(labelled, reconcile.roles(labelled), reconcile.boundaries(labels.boundaries(labelled)))


@query("expansion_reasons", REASONS + "select doc, window_index, window_id, reasons from named")
def q_reasons(spark, d):
    return _reasons(spark, d).withColumn("reasons", F.array_join("reasons", "|"))


@query("expansion_histogram", REASONS + "select reason, count(*) as n from (select unnest(string_split(reasons, '|')) as reason from named where reasons <> '') group by reason")
def q_histogram(spark, d):
    return reconcile.reason_histogram(_reasons(spark, d))


@query("split_resolution", sql("splits", then="select doc, block_ref, anchor, status, cast(case when status = 'resolved' then spot end as int) as start, cast(case when status = 'resolved' then spot + n end as int) as \"end\" from splits"))
def q_splits(spark, d):
    return _splits(_labelled(spark, d)).select("doc", "block_ref", "anchor", "split.status", "split.start", "split.end")


@query(
    "question_numbers",
    sql(
        "blocks",
        then=r"""select doc, pos, regexp_extract(left(trim(content, ' '), 40), '^([0-9]{1,3})[ ]*[.、]', 1) as number from (select doc, pos, case pos % 3 when 0 then (pos % 1200) || '. ' || content when 1 then (pos % 9) || ' 、' || content else content end as content from blocks)
             where regexp_matches(left(trim(content, ' '), 40), '^([0-9]{1,3})[ ]*[.、]')""",
    ),
)
def q_numbers(spark, d):
    """Lines of documents, two of three with a number in front."""
    content = F.expr("case pos % 3 when 0 then (pos % 1200) || '. ' || content when 1 then (pos % 9) || ' 、' || content else content end")
    own = blocks(table(spark, d, "documents")).withColumn("number", assemble.question_number(content))
    return own.filter("number is not null").select("doc", "pos", "number.number")


@query(
    "candidates",
    sql("assigned", then="""select doc, printf('pc%04d', candidate) as candidate_id, cast(count_if(fate = 'statement') as bigint) as statement_blocks, cast(count_if(fate = 'solution') as bigint) as solution_blocks,
        string_agg(block_ref, ',' order by pos) as refs from assigned where fate in ('statement', 'solution') group by doc, candidate"""),
)
def q_candidates(spark, d):
    own = _assigned(spark, d)
    out = assemble.candidates(assemble.candidate_refs(own), own)
    refs = F.array_join(F.array_sort(F.concat(F.transform("statement_refs", lambda x: x["block_ref"]), F.transform("solution_refs", lambda x: x["block_ref"]))), ",")
    return out.select("doc", "candidate_id", F.size("statement_refs").cast("long").alias("statement_blocks"), F.size("solution_refs").cast("long").alias("solution_blocks"), refs.alias("refs"))


@query("candidate_refs", sql("assigned", then="select doc, candidate as candidate_number, fate as kind, block_ref, 0 as start, cast(length(content) as int) as \"end\" from assigned where fate in ('statement', 'solution')"))
def q_candidate_refs(spark, d):
    return assemble.candidate_refs(_assigned(spark, d)).select("doc", "candidate_number", "kind", "block_ref", "start", "end")


@query(
    "candidates_with_splits",
    sql(
        "assigned", "splits",
        then="""
        , cuts as (select a.doc, a.candidate, a.pos, a.block_ref, s.spot as cut,
                          row_number() over (partition by a.doc order by s.window_index, s.pos) as nth
                   from assigned a join splits s on a.doc = s.doc and a.block_ref = s.block_ref
                   where s.status = 'resolved' and s.spot > 0 and a.fate = 'statement'),
        tops as (select doc, max(candidate) as starts from assigned group by doc),
        made as (select c.*, t.starts + c.nth as new_number from cuts c join tops t on c.doc = t.doc),
        pieces as (
          select a.doc, a.candidate, a.pos, a.block_ref, 0 as start, coalesce(m.cut, length(a.content)) as stop, 0 as tail
          from assigned a left join made m on a.doc = m.doc and a.pos = m.pos where a.fate = 'statement'
          union all select a.doc, a.candidate, a.pos, a.block_ref, m.cut, length(a.content), 1 from assigned a join made m on a.doc = m.doc and a.pos = m.pos)
        select p.doc, cast(coalesce((select arg_max(m.new_number, m.pos) from made m where m.doc = p.doc and m.candidate = p.candidate and (m.pos < p.pos or (m.pos = p.pos and p.tail = 1))), p.candidate) as int) as candidate_number,
               p.block_ref, cast(p.start as int) as start, cast(p.stop as int) as "end" from pieces p
        """,
    ),
)
def q_with_splits(spark, d):
    return assemble.candidate_refs(_assigned(spark, d), _splits(_labelled(spark, d))).select("doc", "candidate_number", "block_ref", "start", "end")


@query("excluded_blocks", sql("assigned", then="select doc, pos, block_ref, substr(fate, 10) as reason from assigned where fate like 'excluded:%'"))
def q_excluded(spark, d):
    return assemble.excluded(_assigned(spark, d))


@query(
    "assembly_diagnostics",
    sql("assigned", "splits", then="""select doc, block_ref, case when fate like 'diagnostic:%' then substr(fate, 12) else 'uncertain_role' end as diagnostic from assigned
        where fate like 'diagnostic:%' or fate = 'excluded:uncertain_role'
        union all select doc, block_ref, case when status <> 'resolved' then 'unresolved_split:' || status else 'split_at_block_start' end from splits where status <> 'resolved' or spot = 0"""),
)
def q_diagnostics(spark, d):
    return assemble.diagnostics(_assigned(spark, d), _splits(_labelled(spark, d)))


@query("coverage_gate", sql("members", then="select t.doc, cast(count_if(m.doc is null) as bigint) as missing, count_if(m.doc is null) = 0 as coverage_complete from turns t left join (select distinct doc, block_ref from members) m on t.doc = m.doc and t.block_ref = m.block_ref group by t.doc"))
def q_coverage(spark, d):
    stream = _turns(spark, d)
    return gates.coverage(stream, windows.membership(stream))


@query("blocks_decided", sql("roles", then="select t.doc, count(*) as blocks_decided from turns t semi join roles r on t.doc = r.doc and t.block_ref = r.block_ref group by t.doc"))
def q_decided(spark, d):
    return gates.decided(_turns(spark, d), reconcile.roles(_labelled(spark, d)))


@query("silent_loss", sql("assigned", then="select doc, block_ref from assigned where pos % 11 = 5"))
def q_loss(spark, d):
    """What an assembly that forgets every eleventh block leaves out: the gate must name those and no others."""
    own = _assigned(spark, d).filter("pos % 11 <> 5")
    return gates.silent_loss(_turns(spark, d), assemble.candidate_refs(own), assemble.excluded(own), assemble.diagnostics(own))


def _report(spark, d) -> DataFrame:
    stream, labelled, own = _turns(spark, d), _labelled(spark, d), _assigned(spark, d)
    role_table, edge_table = reconcile.roles(labelled), reconcile.boundaries(labels.boundaries(labelled))
    told = own.filter("pos % 97 <> 5")  # a forgetful assembly, so that the gate has something to find
    lost = gates.silent_loss(stream, assemble.candidate_refs(told), assemble.excluded(told), assemble.diagnostics(told))
    count = lambda df, name: df.groupBy("doc").agg(F.count("*").alias(name))
    out = stream.groupBy("doc").agg(F.count("*").alias("blocks"))
    parts = [
        count(windows.windows(stream), "windows"), count(role_table.filter("conflict"), "role_conflicts"), count(edge_table.filter("conflict"), "boundary_conflicts"),
        own.groupBy("doc").agg(F.max("candidate").cast("long").alias("candidates")), count(lost, "silent_loss"), gates.coverage(stream, windows.membership(stream)).select("doc", "coverage_complete"),
    ]
    for p in parts:
        out = out.join(p, "doc", "left")
    return out.na.fill(0).withColumn("hard_gates_passed", F.col("coverage_complete") & (F.col("silent_loss") == 0))


PER_DOC = sql(
    "windows", "assigned", "edges",
    then="""
    , per as (select doc, count(*) as blocks, (select count(*) from windows w where w.doc = t.doc) as windows,
             (select count(*) from roles r where r.doc = t.doc and conflict) as role_conflicts, (select count(*) from edges e where e.doc = t.doc and conflict) as boundary_conflicts,
             (select cast(max(candidate) as bigint) from assigned a where a.doc = t.doc) as candidates, cast(count_if(pos % 97 = 5) as bigint) as silent_loss, count(*) = (select count(distinct pos) from members m where m.doc = t.doc) as coverage_complete,
             count(*) = (select count(distinct pos) from members m where m.doc = t.doc) and count_if(pos % 97 = 5) = 0 as hard_gates_passed from turns t group by doc)
    """,
)


@query("hard_gates", PER_DOC + "select * from per")
def q_gates(spark, d):
    return _report(spark, d)


@query(
    "baseline_report",
    PER_DOC + """select count(*) as documents, cast(sum(blocks) as bigint) as blocks, cast(sum(windows) as bigint) as windows, cast(sum(role_conflicts) as bigint) as role_conflicts,
    cast(sum(boundary_conflicts) as bigint) as boundary_conflicts, cast(sum(candidates) as bigint) as candidates, cast(sum(silent_loss) as bigint) as silent_loss, bool_and(hard_gates_passed) as hard_gates_passed from per""",
)
def q_report(spark, d):
    names = ["blocks", "windows", "role_conflicts", "boundary_conflicts", "candidates", "silent_loss"]
    return _report(spark, d).agg(F.count("*").alias("documents"), *[F.sum(n).alias(n) for n in names], F.bool_and("hard_gates_passed").alias("hard_gates_passed"))
