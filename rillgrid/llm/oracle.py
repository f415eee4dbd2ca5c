"""What queries of this subpackage must return, in DuckDB SQL, where SQL can express it."""

from __future__ import annotations

from rillgrid.llm.decontamination import UNITS

_BARE = r"lower(regexp_replace(w, '[^\p{L}\p{N}]+', '', 'g'))"
_NUMBER = r"'^[^\p{L}\p{N}]*[0-9]'"
_SLOT = "substr(t, 1, 1) in ('#', '&', '@')"

OP1 = rf"""
with texts as (
  select 'doc' as side, doc_id as id, text from documents union all select 'item', item_id, text from benchmark
), words as (
  select side, id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]')) as ws from texts
), pairs as (
  select side, id, i, ws[i] as w, case when i > 1 then ws[i - 1] end as before from (select side, id, ws, unnest(generate_series(1, len(ws))) as i from words)
), tokens as (
  select side, id, i, case
    when regexp_matches(w, {_NUMBER}) then '#' || {_BARE}
    when {_BARE} in ({", ".join(f"'{u}'" for u in UNITS)}) and coalesce(regexp_matches(before, {_NUMBER}), false) then '&' || {_BARE}
    when regexp_matches(w, '^[^\p{{L}}\p{{N}}]*\p{{Lu}}\p{{Ll}}') and coalesce(not regexp_matches(before, '[.!?:][^\p{{L}}\p{{N}}]*$'), false) then '@' || {_BARE}
    else {_BARE} end as t from pairs
), lined as (
  select side, id, i, [t, lead(t, 1) over o, lead(t, 2) over o, lead(t, 3) over o, lead(t, 4) over o] as five from tokens window o as (partition by side, id order by i)
), windows as (
  select side, id, i, array_to_string(list_transform(five, lambda t: case when {_SLOT} then substr(t, 1, 1) else t end), ' ') as k, list_filter(five, lambda t: {_SLOT}) as slots
  from lined where five[5] is not null
), items as (
  select id as item, k, min(slots) as slots from windows where side = 'item' and 5 - len(slots) >= 3 group by 1, 2
), sizes as (
  select item, count(*) as n_item_windows from items group by 1
), hits as (
  select d.id as doc, b.item, b.k, d.slots as here, b.slots, count(*) as times from windows d join items b using (k) where d.side = 'doc' group by 1, 2, 3, 4, 5
), counted as (
  select doc, item, count(distinct k) as n_windows, n_item_windows from hits join sizes using (item) group by doc, item, n_item_windows having count(distinct k) >= 0.8 * n_item_windows
), met as (
  select doc, item, unnest(slots) as was, unnest(here) as now, times from hits where len(slots) > 0
), shares as (
  select doc, item, sum(most) / sum(every) as agreement from (
    select doc, item, was, max(n) as most, sum(n) as every from (select doc, item, was, now, sum(times) as n from met group by 1, 2, 3, 4) group by 1, 2, 3
  ) group by 1, 2
)
select doc as doc_id, item as item_id, n_windows, n_item_windows, cast(coalesce(agreement, 1.0) as double) as slot_agreement
from counted left join shares using (doc, item) where coalesce(agreement, 1.0) >= 0.8
"""

OP2 = r"""
with lines as (
  select doc_id, i - 1 as place, ls[i] as line from (
    select doc_id, ls, unnest(generate_series(1, len(ls))) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
  )
), worded as (
  select doc_id, place, line, list_filter(regexp_split_to_array(lower(line), '\s+'), lambda w: w <> '') as ws from lines
), keyed as (
  select doc_id, place, array_to_string(ws, ' ') as s, len(ws) as n, ws from worded where len(ws) > 0
), classes as (
  select s, n, any_value(ws) as ws, min({'d': doc_id, 'p': place}) as earliest from keyed group by 1, 2
), gaps as (
  select s, earliest, i, array_to_string(list_concat(ws[1:i - 1], ws[i + 1:]), ' ') as rest from (select s, earliest, ws, unnest(generate_series(1, n)) as i from classes where n >= 5)
), partners as (
  select gaps.s, g.m from gaps join (select rest, i, min(earliest) as m from gaps group by 1, 2) g on gaps.rest = g.rest and gaps.i = g.i
  union all select gaps.s, classes.earliest from gaps join classes on gaps.rest = classes.s
  union all select classes.s, gaps.earliest from gaps join classes on gaps.rest = classes.s
), kept as (
  select classes.s, least(min(earliest), coalesce(min(m), min(earliest))) as stays from classes left join partners on classes.s = partners.s group by 1
), marked as (
  select worded.doc_id, worded.place, worded.line, coalesce({'d': worded.doc_id, 'p': worded.place} > kept.stays, false) as goes
  from worded left join keyed on worded.doc_id = keyed.doc_id and worded.place = keyed.place left join kept on keyed.s = kept.s
)
select doc_id, count(*) as n_lines, count(*) filter (where goes) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not goes), '')) as text_sha256
from marked group by 1
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"

#: Scores by a plain join of the items' terms and the documents' terms.
OP12 = f"""
with docs as (select row_number() over () as r, doc_id, {_TERMS} as ws from documents),
sized as (select r, doc_id, ws, cast(len(ws) as bigint) as n from docs where len(ws) > 0),
total as (select count(*) as nn, cast(sum(n) as bigint) as ll from sized),
tf as (select r, t, count(*) as tf from (select r, unnest(ws) as t from sized) group by 1, 2),
items as (select distinct item_id, t from (select item_id, unnest({_TERMS}) as t from benchmark)),
weight as (
    select t, cast(floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)::double)) as bigint) as w
    from (select t, count(*) as df from tf where t in (select t from items) group by 1), total
),
scored as (
    select item_id, doc_id, r, cast(sum(w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * n * nn) // ll)))) as bigint) as score
    from items join weight using (t) join tf using (t) join sized using (r), total group by 1, 2, 3
)
select item_id, cast(rank as int) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id, r) as rank from scored where score > 0)
where rank <= 10
"""
