"""Where queries register, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


#: Common table expressions of the SQL side, in the order in which they build on each other.
PARTS = {
    "blocks": """
      _lines as (select doc_id as doc, unnest(string_split(text, chr(10))) as content,
                        cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as int) as pos from documents),
      _placed as (select doc, pos, cast(pos // 20 as int) as page_seq, cast(pos % 20 as int) as sequence_index,
                         printf('p%04d:b%04d', pos // 20, pos % 20) as block_ref, content,
                         case when pos = 0 then 'doc_title' when trim(content, ' ') = '' then 'footer' when contains(content, '$') then 'inline_formula'
                              when regexp_matches(content, '^[A-Z]') and length(content) < 40 then 'number'
                              else case (doc * 31 + pos) % 10 when 0 then 'header' when 1 then 'paragraph_title' when 2 then 'image'
                                   when 3 then 'display_formula' else 'text' end end as label from _lines),
      blocks as (select *, cast(case when label in ('header', 'doc_title', 'footer') then null
                                     else pos - case when (doc + pos) % 17 = 0 then 2 else 0 end end as int) as provider_block_order from _placed)""",
    "turns": """
      _turns as (select conv_id as doc, cast(row_number() over (partition by conv_id order by turn) - 1 as int) as pos, text as content,
                        case role when 'system' then 'header' when 'user' then 'number' else 'text' end as label from conversations),
      turns as (select *, cast(pos // 20 as int) as page_seq, cast(pos % 20 as int) as sequence_index, printf('p%04d:b%04d', pos // 20, pos % 20) as block_ref from _turns)""",
    "sizes": "sizes as (select doc, cast(count(*) as int) as n from turns group by doc)",
    "windows": """
      windows as (select doc, n, cast(i as int) as window_index, printf('w%04d', i) as window_id, cast(i * 3 as int) as start_index,
                         cast(least(i * 3 + 5, n) as int) as end_index
                  from sizes, generate_series(0, 10000) g(i) where i < 1 + least(ceil(greatest(n - 5, 0) / 3), (n - 1) // 3))""",
    "members": """
      members as (select t.*, w.window_index, w.window_id, t.pos - w.start_index as pos_in_window
                  from turns t join windows w on t.doc = w.doc and t.pos >= w.start_index and t.pos < w.end_index)""",
    "labelled": """
      labelled as (select *, case when label = 'number' or (pos_in_window = 0 and label <> 'doc_title') then 'PROBLEM_START'
                                  when label = 'paragraph_title' and contains(content, '参考答案') then 'SOLUTION_START'
                                  when label in ('header', 'doc_title', 'footer') then 'NON_PROBLEM' else 'PROBLEM_CONTINUATION' end as role from members)""",
    "bounds": """
      _next as (select doc, window_index, block_ref as left_ref, lead(block_ref) over w as right_ref, lead(role) over w as next_role
                from labelled window w as (partition by doc, window_index order by pos)),
      bounds as (select doc, window_index, left_ref, right_ref, case when next_role = 'PROBLEM_START' then 'NEW_PROBLEM' else 'SAME_PROBLEM' end as relation
                 from _next where right_ref is not null)""",
    "roles": """
      roles as (select doc, block_ref, case when count(distinct role) = 1 then min(role) else 'UNCERTAIN' end as role,
                       count(distinct role) > 1 as conflict, string_agg(distinct role, '|' order by role) as found from labelled group by doc, block_ref)""",
    "edges": """
      edges as (select doc, left_ref, right_ref, case when count(distinct relation) = 1 then min(relation) else 'UNCERTAIN' end as relation,
                       count(distinct relation) > 1 as conflict, string_agg(distinct relation, '|' order by relation) as found
                from bounds group by doc, left_ref, right_ref)""",
    "assigned": """
      _decided as (select t.*, coalesce(r.role, 'UNCERTAIN') as role from turns t left join roles r on t.doc = r.doc and t.block_ref = r.block_ref),
      _counted as (select *, sum(case when role = 'PROBLEM_START' then 1 else 0 end) over (partition by doc order by pos) as k from _decided),
      assigned as (select *, cast(k as int) as candidate,
                     case when role = 'PROBLEM_START' then 'statement'
                          when role = 'PROBLEM_CONTINUATION' then case when k = 0 then 'diagnostic:orphan_continuation' else 'statement' end
                          when role in ('SOLUTION_START', 'SOLUTION_CONTINUATION') then case when k = 0 then 'diagnostic:orphan_solution' else 'solution' end
                          when role = 'UNCERTAIN' then 'excluded:uncertain_role' else 'excluded:excluded_role:' || role end as fate from _counted)""",
    "splits": """
      _anchors as (select doc, window_index, pos, block_ref, content, left(list_last(string_split(content, ' ')), 3) as anchor from labelled where label = 'number'),
      splits as (select doc, window_index, pos, block_ref, anchor,
                   case when anchor = '' then 'missing_anchor' when strpos(content, anchor) = 0 then 'not_found'
                        when strpos(substr(content, strpos(content, anchor) + 1), anchor) > 0 then 'ambiguous' else 'resolved' end as status,
                   strpos(content, anchor) - 1 as spot, length(anchor) as n
                 from (select *, row_number() over (partition by doc, block_ref order by window_index, pos) as k from _anchors) where k = 1)""",
}


def sql(*names: str, then: str) -> str:
    """A query over some of the parts; each part brings those it builds on."""
    needs = {"sizes": ["turns"], "windows": ["sizes"], "members": ["windows"], "labelled": ["members"], "bounds": ["labelled"], "roles": ["labelled"], "edges": ["bounds"], "assigned": ["roles"], "splits": ["labelled"]}
    wanted: list[str] = []

    def add(name: str) -> None:
        for x in needs.get(name, []):
            add(x)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return "with " + ",".join(PARTS[n] for n in wanted) + "\n" + then
