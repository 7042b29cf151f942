"""SQL of the corpus operators, where SQL can state them: the one form as a joined table of code points, similarities of all pairs, runs of letters.

The statements follow the definitions, not the operators: no keys, indexes or filters.
"""

from __future__ import annotations

from ..functions.text import WHITE
from . import pieces
from .leakage import LEAST_RUN, LEAST_RUN_BY_LANG
from .textform import fold_table

_W = f"[{WHITE}]"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_FOLD = f"(select unnest([{', '.join(map(_quoted, fold_table()))}]) as ch, unnest([{', '.join(map(_quoted, fold_table().values()))}]) as seq)"


def _forms(rows: str) -> str:
    """with-clause: forms(tbl, k, text, form) of rows (tbl, k, text), without null and blank texts."""
    return f"""fold as materialized {_FOLD},
        kept as materialized (select *, row_number() over () as rid from ({rows}) where text is not null and not regexp_full_match(text, '{_W}*')),
        points as (select rid, i, substring(text, i, 1) as ch from (select rid, text, unnest(generate_series(1, length(text))) as i from kept)),
        built as (select rid, nfc_normalize(string_agg(coalesce(seq, points.ch), '' order by i)) as form from points left join fold on fold.ch = points.ch group by rid),
        forms as materialized (select tbl, k, text, form from kept join built using (rid))"""


_CHUNKS = "select 'cpt_chunk' as tbl, lpad(cast(row_id as varchar), 10, '0') as k, text from cpt_chunk"
_BOTH = f"{_CHUNKS} union all select 'dummy', id, context from dummy"

_SIMILAR = f"""
    texts as materialized (select tbl, form, regexp_replace(form, '{_W}+', '', 'g') as flat, row_number() over () as fid from (select distinct tbl, form from forms)),
    grams as materialized (select distinct fid, tbl, substring(flat, i, 5) as gram from (select *, unnest(generate_series(1, length(flat) - 4)) as i from texts)),
    sizes as (select fid, count(*) as n from grams group by fid),
    shared as (select a.fid as fa, b.fid as fb, count(*) as s from grams a join grams b on a.tbl = b.tbl and a.gram = b.gram and a.fid < b.fid group by all),
    near as materialized (select fa, fb, s / (x.n + y.n - s) as j from shared join sizes x on x.fid = fa join sizes y on y.fid = fb where 5 * s >= 3 * (x.n + y.n - s)),
    members as materialized (select forms.*, fid from forms join texts using (tbl, form))"""

P1_FORMS = f"with {_forms(_BOTH)} select tbl, k as key, form from forms"
P1_FOUND = f"""with {_forms(_BOTH)} select distinct a.tbl, a.k as key_a, b.k as key_b from forms a join forms b on a.tbl = b.tbl and a.form = b.form and a.text <> b.text and a.k < b.k"""
P2_FOUND = f"""with {_forms(_BOTH)}, {_SIMILAR}
    select distinct a.tbl, least(a.k, b.k) as key_a, greatest(a.k, b.k) as key_b from near join members a on a.fid = fa join members b on b.fid = fb"""

_OVERLAPS = f"""{_forms(_CHUNKS)}, {_SIMILAR},
    sides as materialized (select fid, row_id, coalesce(split = 'train', false) as train, split, source_file from members join cpt_chunk on lpad(cast(row_id as varchar), 10, '0') = k),
    links as (select fa, fb, j from near union all select fb, fa, j from near union all select fid, fid, 1 from texts)"""
P3_FOUND = f"""with {_OVERLAPS} select distinct least(a.row_id, b.row_id) as row_a, greatest(a.row_id, b.row_id) as row_b from links join sides a on a.fid = fa and a.train join sides b on b.fid = fb and not b.train"""
P3_REPORT = f"""with {_OVERLAPS}, trained as (select distinct fid from sides where train),
    best as (select fb as fid, max(j) as best, count(*) as n from links join trained on trained.fid = fa group by fb)
    select c.split, c.source_file, count(*) as n_rows, count(*) filter (best = 1) as n_equal, count(*) filter (best < 1) as n_near, cast(coalesce(sum(n), 0) as bigint) as n_training_texts
    from cpt_chunk c left join sides s on s.row_id = c.row_id left join best b on b.fid = s.fid where c.split is distinct from 'train' group by all"""

_LEAST = f"case lang {' '.join(f'when {_quoted(k)} then {v}' for k, v in LEAST_RUN_BY_LANG.items())} else {LEAST_RUN} end"
_LETTERS = "regexp_replace(form, '[^\\p{L}\\p{N}]', '', 'g')"
_WINDOWS = "(select *, unnest(generate_series(1, length(t) - least_run + 1)) as p from {0})"
# a match of the least length at each of a row of places is a longer one: places of one diagonal that follow each other
_LEAKS = f"""{_forms("select 'd' as tbl, cast(doc_id as varchar) as k, text from documents union all select 'i', cast(item_id as varchar), text from eval_item")},
    items as (select item_id, {_LETTERS} as t, {_LEAST} as least_run from forms join eval_item on tbl = 'i' and cast(item_id as varchar) = k),
    docs as (select cast(k as bigint) as doc_id, {_LETTERS} as t, least_run from forms, (select distinct least_run from items) where tbl = 'd'),
    hits as (select doc_id, item_id, d.p as dp, d.p - i.p as diagonal, least_run from (select doc_id, least_run, p, substring(t, p, least_run) as w from {_WINDOWS.format("docs")}) d
        join (select item_id, least_run, p, substring(t, p, least_run) as w from {_WINDOWS.format("items")}) i using (least_run, w)),
    runs as (select doc_id, item_id, least_run, count(*) as n from (select *, dp - row_number() over (partition by doc_id, item_id, diagonal order by dp) as island from (select distinct * from hits)) group by doc_id, item_id, diagonal, least_run, island),
    leaks as materialized (select doc_id, item_id, max(n + least_run - 1) as n_chars from runs group by doc_id, item_id)"""
P7_FOUND = f"with {_LEAKS} select doc_id, item_id from leaks"
P7_LEAKED_ITEMS = f"with {_LEAKS} select item_id, count(*) as n_docs, max(n_chars) as longest from leaks group by item_id"
P7_CLEAN_DOCUMENTS = f"with {_LEAKS} select * replace (cast(fetched_at as timestamp) as fetched_at) from documents where doc_id not in (select doc_id from leaks)"

ORACLE: dict[str, str] = {
    "p1_found": P1_FOUND,
    "p1_forms": P1_FORMS,
    "p2_found": P2_FOUND,
    "p3_found": P3_FOUND,
    "p3_report": P3_REPORT,
    "p4_found": pieces.P4_FOUND_SQL,
    "p7_found": P7_FOUND,
    "p7_leaked_items": P7_LEAKED_ITEMS,
    "p7_clean_documents": P7_CLEAN_DOCUMENTS,
}
