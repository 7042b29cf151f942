"""Named queries over the driver's tables and the SQL that must give the same rows.

Each query runs an operator over its whole tables. Markup that SQL cannot parse is put around every text in a known form, so that
the result follows from the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import wikitext as wt
from ..functions.text import WHITE
from ..operators import chat, dedup, entries, ordinals, similarity, upload
from ..operators.tables import new_path
from ..settings import CptSettings, QaSettings
from ..sources import wiki
from . import cpt, dialect, qa

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: Sizes of the chunk queries.
MIN, MAX, OVERLAP = 128, 512, 64
_MARKUP_HEAD = "<!-- note -->'''"
_MARKUP_TAIL = "'''<ref name=\"a\"/><br/><span class=\"x\">s</span><ref>r</ref>__TOC__[[x]]{{y}}"
_KEYWORD = "織機"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"), "title", F.col("text").alias("content"), F.col("source").alias("source_file"), "doc_id")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries.candidates(entries.with_entry_id(_entries(spark, sf_dir)), "content", "title", True, MIN, MAX, OVERLAP)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "cpt_chunk").select("row_id", F.col("id").alias("entry_id"), "chunk_index", "text", "source_file", "split")


# --- SQL fragments -------------------------------------------------------------------------------------------

_W = f"[{WHITE}]"


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_W}+|{_W}+$', '', 'g')"


def _sql_normalized(x: str) -> str:
    lines = rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"
    return _sql_strip(rf"regexp_replace(regexp_replace({lines}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


_SQL_BODY = f"""(select cast(doc_id as varchar) as id, doc_id, title, source, {_sql_normalized("text")} as body from documents where text is not null)"""
_SQL_TITLED = f"""(select id, doc_id, source, case when {_sql_strip("coalesce(title, '')")} <> '' then {_sql_strip("title")} || chr(10) || chr(10) || body else body end as n from {_SQL_BODY} where length(body) >= {MIN})"""


def _sql_end(s: str) -> str:
    w = f"substring(n, {s} + {MAX // 2} + 1, {MAX - MAX // 2})"
    whens = " ".join(f"when contains({w}, {sep}) then {s} + {MAX} - strpos(reverse({w}), {sep}) + 1" for sep in ("chr(10) || chr(10)", "chr(10)", "'。'", "'、'"))
    return f"(case when len <= {s} + {MAX} then len {whens} else {s} + {MAX} end)"


_SQL_NEXT = f"greatest(en - {OVERLAP}, st + 1)"
_SQL_CHUNKS = f"""
    f as (select id, doc_id, source, n, length(n) as len from {_SQL_TITLED}),
    r as (select id, doc_id, source, n, len, 0 as st, {_sql_end("0")} as en from f
          union all select id, doc_id, source, n, len, {_SQL_NEXT} as st, {_sql_end(_SQL_NEXT)} as en from r where en < len),
    c as (select *, case when len <= {MAX} then n else {_sql_strip("substring(n, st + 1, en - st)")} end as chunk from r),
    chunks as (select id, doc_id, source, cast(row_number() over (partition by doc_id order by st) - 1 as int) as chunk_index, chunk from c where chunk <> '')
"""
_SQL_KEY = "md5(coalesce(cast({0} as varchar), '') || ':' || coalesce(cast({1} as varchar), '') || ':42')"

# --- text functions --------------------------------------------------------------------------------------------


@query(f"select row_id, {_sql_normalized('text')} as body from cpt_chunk")
def normalize_text(spark, sf_dir):
    return _t(spark, sf_dir, "cpt_chunk").select("row_id", tx.normalized("text").alias("body"))


@query(f"select doc_id, cast(length(body) as bigint) as n_chars from {_SQL_BODY} where length(body) >= {MIN}")
def min_chars_filter(spark, sf_dir):
    body = _entries(spark, sf_dir).select("doc_id", tx.normalized("content").alias("body"))
    return body.where(F.length("body") >= MIN).select("doc_id", F.length("body").cast("long").alias("n_chars"))


@query(f"select doc_id, n as text from {_SQL_TITLED}")
def title_prefix(spark, sf_dir):
    body = _entries(spark, sf_dir).withColumn("body", tx.normalized("content")).where(F.length("body") >= MIN)
    return body.select("doc_id", tx.with_title("title", "body").alias("text"))


@query(f"with recursive {_SQL_CHUNKS} select id as entry_id, chunk_index, chunk from chunks")
def chunk_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir).select("entry_id", F.col("chunk_index").cast("int").alias("chunk_index"), "chunk")


@query(f"with recursive {_SQL_CHUNKS} select id as entry_id, count(*) as n_candidates from chunks group by id")
def candidates_per_entry(spark, sf_dir):
    return entries.candidates_per_entry(_candidates(spark, sf_dir))


@query(
    f"""select item_id, {_sql_strip("string_split(list_last(string_split(answer, '<answer>')), '</answer>')[1]")} as body,
        {_sql_strip("case when contains(answer, '<answer>') then string_split(answer, '<answer>')[1] || case when contains(substring(answer, strpos(answer, '<answer>')), '</answer>') then substring(substring(answer, strpos(answer, '<answer>') + 8), strpos(substring(answer, strpos(answer, '<answer>') + 8), '</answer>') + 9) else '' end else answer end")} as rest
        from qa_row where answer is not null"""
)
def extract_tag(spark, sf_dir):
    q = _t(spark, sf_dir, "qa_row").where("answer is not null")
    return q.select("item_id", tx.tag_content("answer", "answer").alias("body"), tx.without_tag_block("answer", "answer").alias("rest"))


@query("""select item_id, 'user' as role_1, coalesce(question, '') as content_1, 'assistant' as role_2,
          '<think>' || coalesce(thinking, '') || '</think>' || chr(10) || chr(10) || coalesce(answer, '') as content_2 from qa_row""")
def build_messages(spark, sf_dir):
    m = _t(spark, sf_dir, "qa_row").select("item_id", tx.chat_messages("question", "thinking", "answer").alias("m"))
    return m.select("item_id", *[F.col("m")[i][f].alias(f"{f}_{i + 1}") for i in (0, 1) for f in ("role", "content")])


@query("""select item_id, 'Q: ' || coalesce(question, '') || ' {x} A: ' || coalesce(answer, '') as prompt from qa_row""")
def render_prompt(spark, sf_dir):
    q = _t(spark, sf_dir, "qa_row")
    return q.select("item_id", tx.rendered("Q: {question} {{x}} A: {answer}", {"question": "question", "answer": "answer", "unused": "eval"}).alias("prompt"))


@query("""with recursive r as (
            select id, context, length(context) as n, 0 as k, []::bigint[] as chosen from dummy where length(context) > 0
            union all
            select id, context, n, k + 1, case when n > len(chosen) then list_append(chosen, list_reduce(
                list_prepend(('0x' || substring(md5(id || ':' || (k + 1) || ':0'), 1, 12))::bigint % greatest(n - len(chosen), 1), list_sort(chosen)), lambda p, taken: case when taken <= p then p + 1 else p end)) else chosen end
            from r where k < 10)
          select id, array_to_string(list_transform(chosen, lambda p: substring(context, p + 1, 1)), '') as token from r where k = 10""")
def random_tokens(spark, sf_dir):
    d = _t(spark, sf_dir, "dummy").where("length(context) > 0")
    return d.select("id", tx.random_token("context", "id").alias("token"))


@query("""select item_id, case when lower(trim(eval)) in ('true', '1', 'yes', 'on') then true when lower(trim(eval)) in ('false', '0', 'no', 'off') then false
          when eval is not null then length(eval) > 0 end as flag from qa_row""")
def optional_bool_column(spark, sf_dir):
    return _t(spark, sf_dir, "qa_row").select("item_id", tx.optional_bool("eval").alias("flag"))


@query("select row_id, case when id is null then null when chunk_index is null then id else id || chr(9) || chunk_index end as cache_key from cpt_chunk")
def cache_keys(spark, sf_dir):
    return _t(spark, sf_dir, "cpt_chunk").select("row_id", tx.cache_key("id", "chunk_index").alias("cache_key"))


# --- wiki ------------------------------------------------------------------------------------------------------


def _pages(spark, sf_dir) -> DataFrame:
    """Documents as pages, with markup around every text."""
    d = _t(spark, sf_dir, "documents").where("text is not null")
    ns = F.when(F.col("doc_id") % 7 == 0, "1").otherwise("0")
    text = F.concat(F.when(F.col("doc_id") % 11 == 0, "  #REDIRECT ").otherwise(""), F.lit(_MARKUP_HEAD), "text", F.lit(_MARKUP_TAIL))
    return d.select("doc_id", F.col("doc_id").cast("string").alias("id"), F.coalesce("title", F.lit("")).alias("title"), ns.alias("ns"), text.alias("text"))


_SQL_PAGES = f"""(select doc_id, coalesce(title, '') as title, case when doc_id % 7 = 0 then '1' else '0' end as ns,
    case when doc_id % 11 = 0 then '  #REDIRECT ' else '' end || '{_MARKUP_HEAD.replace("'", "''")}' || text || '{_MARKUP_TAIL.replace("'", "''")}' as text from documents where text is not null)"""
_SQL_CONTENT = f"""(select * from {_SQL_PAGES} where ns = '0' and not regexp_matches(title, '^[-:]') and not regexp_matches(lower(text), '^{_W}*#(redirect|転送)'))"""
_SQL_REASON = f"""(select doc_id, case when contains(title, '{_KEYWORD}') then 'title' when len(string_split(text, '{_KEYWORD}')) - 1 >= 3 then 'content' end as match_reason from {_SQL_CONTENT})"""


@query(f"select doc_id, ns from {_SQL_CONTENT}")
def namespace_redirect_filter(spark, sf_dir):
    return wiki.content_pages(_pages(spark, sf_dir)).select("doc_id", "ns")


@query(f"select doc_id, match_reason from {_SQL_REASON} where match_reason is not null")
def keyword_match(spark, sf_dir):
    return wiki.keyword_pages(wiki.content_pages(_pages(spark, sf_dir)), _KEYWORD).select("doc_id", "match_reason")


@query(f"select count(*) filter (match_reason = 'title') as title_matches, count(*) filter (match_reason = 'content') as content_matches, count(match_reason) as total from {_SQL_REASON}")
def match_counts(spark, sf_dir):
    return wiki.match_counts(wiki.articles(_pages(spark, sf_dir), _KEYWORD))


@query(f"""select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '(?i)<ref\\b[^/>]*/\\s*>', '', 'g'), '(?is)<ref\\b[^>]*>.*?</ref\\s*>', '', 'g') as text from {_SQL_PAGES}""")
def strip_refs(spark, sf_dir):
    return _pages(spark, sf_dir).select("doc_id", wt.strip_refs("text").alias("text"))


def _sql_markup(x: str) -> str:
    for pattern, new in wt.MARKUP:
        flags = "g"
        new_sql = "chr(10)" if new == "\n" else "''"
        x = f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', {new_sql}, '{flags}')"
    return x


@query(f"select doc_id, replace(replace(replace(replace({_sql_markup('text')}, '[[', ''), ']]', ''), '{{{{', ''), '}}}}', '') as text from {_SQL_PAGES}")
def strip_markup_and_residue(spark, sf_dir):
    return _pages(spark, sf_dir).select("doc_id", wt.strip_residue(wt.strip_markup("text")).alias("text"))


def _sql_lines(x: str) -> str:
    """Lines without their marks, by the definition: one list of lines, each by cases."""
    line, bare = _sql_strip("l"), _sql_strip("regexp_replace(l, '^[*:;#]+', '')")
    shown = f"""case when regexp_full_match(l, '={{2,6}}\\s*(.*?)\\s*={{2,6}}') then regexp_extract(l, '^={{2,6}}\\s*(.*?)\\s*={{2,6}}$', 1)
        when {bare}[1] = '|' then '' when {bare}[1] = '!' then substring({bare}, 2) else {bare} end"""
    collapsed = _sql_strip(f"regexp_replace({shown}, '{_W}+', ' ', 'g')")
    kept = f"case when l = '' then '' when regexp_matches(l, '(?i)\\.(jpg|jpeg|png|svg|gif|webp)\\s*(\\||$)') then null else nullif({collapsed}, '') end"
    lines = f"list_filter(list_transform(list_transform(string_split({x}, chr(10)), lambda l: {line}), lambda l: {kept}), lambda l: l is not null)"
    return _sql_strip(f"regexp_replace(array_to_string({lines}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"""select cast(doc_id as varchar) as id, title, content from (select doc_id, p.title, {_sql_lines("d.text || chr(10) || 'sx'")} as content
    from {_SQL_REASON} r join {_SQL_PAGES} p using (doc_id) join documents d using (doc_id) where match_reason is not null) where content <> ''""")
def clean_wiki_text(spark, sf_dir):
    return wiki.articles(_pages(spark, sf_dir), _KEYWORD).select("id", "title", "content")


def _around(name: str, kernel, before: str, after: str, sql: str) -> None:
    """Registers a kernel over all texts with markup before and after them; sql gives the result from the bare text."""

    def run(spark, sf_dir):
        d = _t(spark, sf_dir, "documents").where("text is not null")
        return d.select("doc_id", tx.text_udf(kernel)(F.concat(F.lit(before), "text", F.lit(after))).alias("text"))

    run.__name__ = name
    query(f"select doc_id, {sql} as text from documents where text is not null")(run)


_BOLD = 3 * chr(39)
_TAIL_BEFORE, _TAIL_AFTER = "導入\n== 歴史 ==\n", "\n=== 脚注 ===\n捨\n==== 細目 ====\n捨\n== 地理 ==\n末尾\n== 参考文献 ==\n捨"
_FILES_BEFORE, _FILES_AFTER = "[[ファイル:a.jpg|thumb|[[x]]の図]]", "[[File:b.png]][[:画像:c.svg|d]] [[記事|名]] [[閉じない"
_LINKS_BEFORE, _LINKS_AFTER = "[[記事]]と[[記事|名]]と[[記事#節]]と[[:記事2]]と[[外|[[内|中]]の]]。[[Category:x]]", "[https://a.example/x 外部][https://b.example]https://c.example/y 終"
_BLOCKS_BEFORE, _BLOCKS_AFTER = '{| class="x"\n|-\n| {{t|{{u}}}}\n|}{{v|[[w]]}}', "}}x{{開いたまま y"
_LINES_BEFORE, _LINES_AFTER = "  * 項目  1\n== 見出し ==\n|- 行\n! 表頭\na.jpg\n\n\n\n", "\n#; 番号\n"
_around("drop_tail_sections", wt.without_tail_sections, _TAIL_BEFORE, _TAIL_AFTER, "'導入' || chr(10) || '== 歴史 ==' || chr(10) || text || chr(10) || '== 地理 ==' || chr(10) || '末尾'")
_around("strip_file_links", wt.without_file_links, _FILES_BEFORE, _FILES_AFTER, "text || ' [[記事|名]] [[閉じない'")
_around("simplify_links", lambda t: wt.plain_links(wt.plain_external_links(t)), _LINKS_BEFORE, _LINKS_AFTER, "'記事と名と節と記事2と中の。' || text || '外部 終'")
_around("remove_templates", lambda t: wt.without_blocks(wt.without_blocks(t, "{|", "|}"), "{{", "}}"), _BLOCKS_BEFORE, _BLOCKS_AFTER, "text || '}}x'")
_around("normalize_lines", wt.plain_lines, _LINES_BEFORE, _LINES_AFTER, _sql_lines("'項目 1' || chr(10) || '見出し' || chr(10) || '表頭' || chr(10) || chr(10) || text || chr(10) || '番号'"))
_around("unescape_entities", wt.unescaped, "&amp;&lt;b&gt;&quot;&#39;&#x3042;", "\r\nx\ry&amp;lt;", """'&<b>"''あ' || text || chr(10) || 'x' || chr(10) || 'y&lt;'""")
_around(
    "clean_rich_article", wt.clean, f"{_FILES_BEFORE}{_BOLD}題{_BOLD}<ref>r</ref>&amp;\n{_BLOCKS_BEFORE}\n== 見出し ==\n* [[記事|名]] [https://a.example/x 外部]\n", f"\n[[Category:x]]\n{_TAIL_AFTER.removeprefix(chr(10))}",
    _sql_lines("'題&' || chr(10) || chr(10) || '見出し' || chr(10) || '名 外部' || chr(10) || text || chr(10) || chr(10) || '地理' || chr(10) || '末尾'"),
)


# --- duplicates, resume, completion ------------------------------------------------------------------------------


@query("select row_id, source_file from (select *, row_number() over (partition by text order by row_id) as r from cpt_chunk) where r = 1")
def dedup_global(spark, sf_dir):
    return dedup.first_of_each(_chunks(spark, sf_dir), "text", ["row_id"]).select("row_id", "source_file")


@query("""select row_id from (select *, row_number() over (partition by w, text order by row_id) as r from (
            select row_id, text, (row_number() over (order by row_id) - 1) // 64 as w from cpt_chunk)) where r = 1""")
def dedup_batch_window(spark, sf_dir):
    return dedup.first_in_windows(_chunks(spark, sf_dir), "text", ["row_id"], 64).select("row_id")


@query("""select row_id from cpt_chunk c where split <> 'train' and not exists (select 1 from cpt_chunk s where s.split = 'train' and s.text is not distinct from c.text)""")
def dedup_against_saved(spark, sf_dir):
    c = _chunks(spark, sf_dir)
    return dedup.not_saved(c.where("split <> 'train'"), c.where("split = 'train'"), "text").select("row_id")


_SQL_KEYS = f"(select distinct {_sql_strip('cache_key')} as k from processed_key where {_sql_strip('cache_key')} <> '')"


def _processed(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "processed_key").select(tx.strip("cache_key").alias("cache_key")).where("cache_key <> ''").distinct()


@query(f"select row_id from cpt_chunk where id is null or id not in (select k from {_SQL_KEYS})")
def pending_entries(spark, sf_dir):
    return entries.pending_entries(_chunks(spark, sf_dir), _processed(spark, sf_dir)).select("row_id")


@query(f"""select row_id from cpt_chunk c where not exists (select 1 from {_SQL_KEYS} p where p.k = c.id) and not exists (select 1 from {_SQL_KEYS} p where p.k = c.id || chr(9) || c.chunk_index)""")
def pending_chunks_compound_key(spark, sf_dir):
    return entries.pending_chunks(_chunks(spark, sf_dir), _processed(spark, sf_dir), "entry_id").select("row_id")


_SQL_OUTCOME = """(select id as entry_id, chunk_index, text is not null as saved, false as failed from cpt_chunk where id is not null
    union all select entry_id, chunk_index, false, true from cpt_failure where entry_id is not null)"""


# a chunk that was saved or failed several times is one candidate; an entry has as many as its highest chunk number says
_SQL_DONE = f"""(select entry_id from (select entry_id, chunk_index, bool_or(saved) as saved, bool_or(failed) as failed from {_SQL_OUTCOME} group by all)
    group by entry_id having count(*) >= max(chunk_index) + 1 and bool_or(saved) and not bool_or(failed))"""


def _outcome(spark, sf_dir) -> DataFrame:
    ok = _chunks(spark, sf_dir).where("entry_id is not null").select("entry_id", "chunk_index", F.col("text").isNotNull().alias("saved"), F.lit(False).alias("failed"))
    bad = _t(spark, sf_dir, "cpt_failure").where("entry_id is not null").select("entry_id", "chunk_index", F.lit(False).alias("saved"), F.lit(True).alias("failed"))
    return ok.union(bad)


def _done(outcome: DataFrame) -> DataFrame:
    chunks = outcome.groupBy("entry_id", "chunk_index").agg(F.bool_or("saved").alias("saved"), F.bool_or("failed").alias("failed"))
    candidates = outcome.groupBy("entry_id").agg((F.max("chunk_index") + 1).alias("n_candidates"))
    return entries.completed_entries(chunks.join(candidates, "entry_id"))


@query(f"select entry_id from {_SQL_DONE}")
def entry_completion_gate(spark, sf_dir):
    return _done(_outcome(spark, sf_dir))


@query(f"""with o as (select entry_id, chunk_index, failed from {_SQL_OUTCOME}), d as (select entry_id from {_SQL_DONE})
    select chunk_index as batch, count(*) as input_records, count(*) filter (not failed) as output_chunks, count(*) filter (failed) as failed_chunks,
    coalesce(string_agg(distinct d.entry_id, ',' order by d.entry_id), '') as cached_ids from o left join d using (entry_id) group by chunk_index""")
def batch_status(spark, sf_dir):
    o = _outcome(spark, sf_dir)
    rows = o.withColumn("error", F.when(F.col("failed"), "x")).withColumn("batch", F.col("chunk_index"))
    return cpt.batch_status(rows, _done(o)).withColumn("cached_ids", F.array_join("cached_ids", ","))


@query("select failed_step, count(*) as n from cpt_failure group by failed_step union all select cast(failed_step as varchar), count(*) from qa_failure group by failed_step")
def failures_by_step(spark, sf_dir):
    a = _t(spark, sf_dir, "cpt_failure").groupBy("failed_step").agg(F.count("*").alias("n"))
    b = _t(spark, sf_dir, "qa_failure").groupBy(F.col("failed_step").cast("string").alias("failed_step")).agg(F.count("*").alias("n"))
    return a.union(b)


# --- order, splits, batches ------------------------------------------------------------------------------------------

_SQL_ORDER = f"(select row_id, row_number() over (order by {_SQL_KEY.format('id', 'row_id')}, id, row_id) as ordinal from cpt_chunk)"


@query(f"select row_id, ordinal from {_SQL_ORDER}")
def seeded_shuffle(spark, sf_dir):
    return ordinals.shuffled(_t(spark, sf_dir, "cpt_chunk").select("id", "row_id"), ["id", "row_id"]).select("row_id", F.col("ordinal").cast("long").alias("ordinal"))


_SQL_SPLIT = f"""(select row_id, case when ordinal <= (select case when count(*) > 1 and floor(count(*) * 0.98::double) = count(*) then count(*) - 1 else floor(count(*) * 0.98::double) end from cpt_chunk) then 'train' else 'validation' end as split from {_SQL_ORDER})"""


@query(f"select row_id, split from {_SQL_SPLIT}")
def train_validation_split(spark, sf_dir):
    return ordinals.train_validation(_t(spark, sf_dir, "cpt_chunk").select("id", "row_id"), ["id", "row_id"]).select("row_id", "split")


@query(f"""select (select count(*) from documents) as entries, count(*) as chunks, count(*) filter (split = 'train') as train_chunks, count(*) filter (split = 'validation') as validation_chunks,
    (select count(*) from cpt_failure) as failed_chunks from {_SQL_SPLIT}""")
def dataset_stats(spark, sf_dir):
    return cpt.statistics(_t(spark, sf_dir, "documents"), train_validation_split(spark, sf_dir), _t(spark, sf_dir, "cpt_failure"))


@query("""select row_id, (n - 5) // 32 as batch, (n - 5) // 32 * 32 + 5 as batch_start, least((n - 5) // 32 * 32 + 36, m) as batch_end
    from (select row_id, row_number() over (order by row_id) as n, count(*) over () as m from cpt_chunk) where n >= 5 and (n - 5) // 32 * 32 + 36 <= m""")
def batch_windows(spark, sf_dir):
    rows = ordinals.with_ordinal(_t(spark, sf_dir, "cpt_chunk").select("row_id"), ["row_id"])
    return ordinals.batches(rows, 32, start=5, drop_last=True).select("row_id", *[F.col(c).cast("long").alias(c) for c in ("batch", "batch_start", "batch_end")])


@query("select item_id, n - 1 as ordinal from (select item_id, row_number() over (order by item_id) as n from qa_row) where n >= 10")
def start_index_offset(spark, sf_dir):
    rows = ordinals.with_ordinal(_t(spark, sf_dir, "qa_row").select("item_id"), ["item_id"]).where("ordinal >= 10")
    return rows.select("item_id", (F.col("ordinal") - 1).cast("long").alias("ordinal"))


@query("""select source_file, row_id, coalesce(text, '') || chr(10) || chr(10) || coalesce(lead(text) over (partition by source_file order by row_id), '') as pair from cpt_chunk""")
def lead_pair(spark, sf_dir):
    return ordinals.lead_pairs(_t(spark, sf_dir, "cpt_chunk"), "text", "row_id", ["source_file"]).select("source_file", "row_id", "pair")


@query("""select id, text, split from cpt_chunk where split = 'train' union all select cast(doc_id as varchar), text, null from documents""")
def union_resume(spark, sf_dir):
    saved = _t(spark, sf_dir, "cpt_chunk").where("split = 'train'").select("id", "text", "split")
    new = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return saved.unionByName(new, allowMissingColumns=True)


# --- publication, terms ------------------------------------------------------------------------------------------


@query("select row_id, id, chunk_index, title, text, cpt_generator from cpt_chunk where copyright_mitigation")
def upload_projection(spark, sf_dir):
    rows = _t(spark, sf_dir, "cpt_chunk").select("row_id", "id", "chunk_index", "title", "text", "cpt_generator", "source_file", "copyright_mitigation")
    return upload.upload_columns(rows)


@query("select source_file, count(*) as n_records from cpt_chunk where copyright_mitigation group by source_file")
def upload_counts(spark, sf_dir):
    return upload.counts(_t(spark, sf_dir, "cpt_chunk").where(upload.is_mitigated()))


_SQL_GRAMS = """(select {0} as k, substring({1}, i, z) as term from (select {0}, {1}, z, unnest(generate_series(1, length({1}) - z + 1)) as i from {2}, (select unnest([1, 2]) as z) where length({1}) >= z))"""


@query(f"select k as item_id, term, count(*) as n from {_SQL_GRAMS.format('item_id', 'question', 'qa_row')} group by k, term")
def ngram_tf(spark, sf_dir):
    return similarity.term_counts(_t(spark, sf_dir, "qa_row").where("question is not null"), "item_id", "question")


@query(f"select term, count(distinct k) as df from {_SQL_GRAMS.format('item_id', 'question', 'qa_row')} group by term")
def document_frequency(spark, sf_dir):
    return similarity.document_frequencies(similarity.term_counts(_t(spark, sf_dir, "qa_row").where("question is not null"), "item_id", "question"))


@query(f"""with g as (select k, 0 as side, term from {_SQL_GRAMS.format('item_id', 'question', 'qa_row')} union all select k, 1, term from {_SQL_GRAMS.format('item_id', 'answer', 'qa_row')}),
    c as (select k, term, count(*) filter (side = 0) as p, count(*) filter (side = 1) as q from g group by k, term),
    w as (select k, p * (ln(3.0 / (1 + (p > 0)::int + (q > 0)::int)) + 1) as p, q * (ln(3.0 / (1 + (p > 0)::int + (q > 0)::int)) + 1) as q from c),
    s as (select k, case when sum(p * p) > 0 and sum(q * q) > 0 then sum(p * q) / (sqrt(sum(p * p)) * sqrt(sum(q * q))) else 0 end as v from w group by k)
    select item_id, cast(round(coalesce(v, 0), 6) as double) as similarity from qa_row left join s on item_id = k""")
def tfidf_cosine(spark, sf_dir):
    found = similarity.tfidf_cosine(_t(spark, sf_dir, "qa_row"), "item_id", "question", "answer")
    return found.select("item_id", F.round("similarity", 6).alias("similarity"))


# --- model chains with a client that answers by a closed form ------------------------------------------------------


def _fake_rewrite(prompt: str, step) -> str:
    if "登記" in prompt and step == "to_bullet_points":
        return ""
    return f"- {prompt[2:]}" if step == "to_bullet_points" else f"<{prompt[2:]}>"


def _rewrite(spark, sf_dir, policy: str, min_chars: int = 1) -> tuple[DataFrame, CptSettings, chat.FakeChat]:
    settings = CptSettings(min_chars=min_chars, copyright_mitigation=True, copyright_failure_policy=policy, keep_intermediate=True, prompts={"to_bullet_points_prompt": "B:{text}", "bullet_points_to_text_prompt": "T:{text}"})
    rows = _t(spark, sf_dir, "cpt_chunk").where(F.length(tx.strip("text")) > 0)
    rows = rows.select(F.col("row_id").cast("string").alias("entry_id"), "id", "title", "source_file", "chunk_index", tx.strip("text").alias("chunk"))
    client = chat.FakeChat(_fake_rewrite)
    return cpt.outcomes(rows, settings, client), settings, client


_SQL_STRIPPED = f"(select *, {_sql_strip('text')} as s from cpt_chunk where {_sql_strip('text')} <> '')"


@query(f"""select cast(row_id as varchar) as entry_id, '<- ' || s || '>' as text, 'fake-model' as cpt_generator, true as copyright_mitigation, '- ' || s as bullet_points from {_SQL_STRIPPED} where not contains(s, '登記')""")
def cpt_rewrite_fail_policy(spark, sf_dir):
    outcome, settings, client = _rewrite(spark, sf_dir, "fail")
    return cpt.saved_chunks(outcome, settings, client.model).select("entry_id", "text", "cpt_generator", "copyright_mitigation", "bullet_points")


@query(f"""select cast(row_id as varchar) as entry_id, 'to_bullet_points' as failed_step, 'Bullet point generation returned blank text.' as error, s as original_text from {_SQL_STRIPPED} where contains(s, '登記')""")
def cpt_rewrite_failures(spark, sf_dir):
    outcome, _, client = _rewrite(spark, sf_dir, "fail")
    return cpt.failures(outcome, client.model).select("entry_id", "failed_step", "error", "original_text")


@query(f"""select cast(row_id as varchar) as entry_id, case when contains(s, '登記') then s else '<- ' || s || '>' end as text, case when contains(s, '登記') then null else 'fake-model' end as cpt_generator, not contains(s, '登記') as copyright_mitigation from {_SQL_STRIPPED}""")
def cpt_rewrite_original_policy(spark, sf_dir):
    outcome, settings, client = _rewrite(spark, sf_dir, "original")
    return cpt.saved_chunks(outcome, settings, client.model).select("entry_id", "text", "cpt_generator", "copyright_mitigation")


def _fake_qa(prompt: str, step) -> str:
    text = prompt[3:]
    if step == 2 and "登記" in text:
        return ""
    return {1: f"<question>q {text}</question>", 2: f"<answer>a {text}</answer>", 3: f"<think>t {text}</think>", 4: f"r {text}", 5: "<eval>5</eval>"}[step]


def _qa(spark, sf_dir) -> tuple[DataFrame, chat.FakeChat]:
    names = ("question_prompt", "answer_prompt", "thinking_prompt", "refine_answer_prompt")
    prompts = {n: f"{i}: {{text}}" for i, n in enumerate(names, 1)} | {"eval_prompt": "5: {answer}"}
    rows = _t(spark, sf_dir, "dummy").select("id", tx.strip("context").alias("text")).where("text <> ''")
    client = chat.FakeChat(_fake_qa)
    return qa.outcomes(qa.items(rows, ["id"]), QaSettings(prompts=prompts), client), client


_SQL_DUMMY = f"(select id, s, row_number() over (order by id) - 1 as item_id from (select id, {_sql_strip('context')} as s from dummy) where s <> '')"


@query(f"""select cast(item_id as int) as item_id, id, 'q ' || s as question, 't ' || s as thinking, 'r ' || s as answer, '5' as eval, 'fake-model' as qa_generator,
    '<think>t ' || s || '</think>' || chr(10) || chr(10) || 'r ' || s as reply from {_SQL_DUMMY} where not contains(s, '登記')""")
def qa_pipeline(spark, sf_dir):
    outcome, client = _qa(spark, sf_dir)
    return qa.results(outcome, client.model).select("item_id", "id", "question", "thinking", "answer", "eval", "qa_generator", F.col("messages")[1]["content"].alias("reply"))


@query(f"""select cast(item_id as int) as item_id, id, cast(2 as int) as failed_step, 'Step 2 returned empty answer.' as error, 'q ' || s as question from {_SQL_DUMMY} where contains(s, '登記')""")
def qa_failures(spark, sf_dir):
    outcome, client = _qa(spark, sf_dir)
    return qa.failures(outcome, client.model).select("item_id", "id", "failed_step", "error", F.col("previous_outputs")["question"].alias("question"))


@query("""select item_id from qa_row where length(question) > 0 and length(answer) > 0 and length(qa_generator) > 0 and len(messages) > 0""")
def qa_save_guard(spark, sf_dir):
    return _t(spark, sf_dir, "qa_row").where(qa.save_guard()).select("item_id")


@query("select try_cast(trim(eval) as int) as score, count(*) as n from qa_row group by 1")
def eval_score_hist(spark, sf_dir):
    score = F.expr("try_cast(trim(eval) as int)")
    return _t(spark, sf_dir, "qa_row").groupBy(score.alias("score")).agg(F.count("*").alias("n"))


@query("select item_id, 'd:' || question as question, case when thinking is not null then 'd:' || thinking end as thinking, 'fake-model' as generator from qa_row where question is not null")
def dialect_rewrite(spark, sf_dir):
    rows = _t(spark, sf_dir, "qa_row").where("question is not null").select("item_id", "question", "thinking")
    return dialect.rewritten(rows, "question, thinking", "d:{text}", chat.FakeChat(lambda prompt, step: prompt))


# --- sources and streams over files written from the tables -----------------------------------------------------------


@query("select cast(doc_id as varchar) as id, title, text as content from documents where text is not null")
def json_lines_round_trip(spark, sf_dir):
    from ..sources import files

    path = new_path(spark, "lines")
    _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "title", F.col("text").alias("content")).write.json(path)
    rows = files.read_json_lines(spark, path)
    return rows.select(files.field("id").alias("id"), files.field("title").alias("title"), files.field("content").alias("content")).where("content is not null")


@query(f"with recursive {_SQL_CHUNKS} select distinct chunk as text from chunks where length(chunk) >= {MIN}")
def streaming_chunks(spark, sf_dir):
    from ..streaming.chunks import stream_chunks

    base = new_path(spark, "stream")
    _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "title", F.col("text").alias("content")).write.json(f"{base}/in")
    settings = CptSettings(min_chars=MIN, max_chars=MAX, overlap_chars=OVERLAP, output_path=f"{base}/out")
    stream_chunks(spark, f"{base}/in", f"{base}/checkpoint", settings).awaitTermination()
    return spark.read.json(f"{base}/out/all.jsonl", schema="text string")
