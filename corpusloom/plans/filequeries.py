"""Queries that go through files: sources, sinks and whole pipelines over folders written from the tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chat
from ..operators.tables import new_path
from ..settings import CptSettings, QaSettings
from ..sources import files, sinks, wiki
from . import catalog, cpt, dialect, qa
from .catalog import MAX, MIN, OVERLAP, query


def _t(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("select cast(item_id as varchar) as book, text from eval_item where trim(text) <> ''")
def text_folder(spark, sf_dir):
    """A text file per item in a folder of its own."""
    path = new_path(spark, "texts")
    _t(spark, sf_dir, "eval_item").select("text", F.col("item_id").alias("item")).write.partitionBy("item").text(path)
    rows = files.read_texts(spark, files.discover(path, spark), "text")
    return rows.select(F.regexp_replace("book", "^item=", "").alias("book"), F.regexp_replace("text", "\n$", "").alias("text"))


@query("select cast(doc_id as varchar) as id, title, text as content from documents where text is not null")
def json_documents(spark, sf_dir):
    """JSON documents with a list of about a thousand records each."""
    path = new_path(spark, "documents")
    d = _t(spark, sf_dir, "documents")
    parts = d.count() // 1000 + 1
    rows = d.select(F.struct(F.col("doc_id").cast("string").alias("id"), "title", F.col("text").alias("content")).alias("r"), F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"))
    rows.groupBy("part").agg(F.to_json(F.collect_list("r")).alias("value")).write.partitionBy("part").text(path)
    found = files.read_json_documents(spark, path)
    return found.select(files.field("id").alias("id"), files.field("title").alias("title"), files.field("content").alias("content")).where("content is not null")


@query("select cast(doc_id as varchar) as id, text as content from documents where text is not null")
def json_lines_strict(spark, sf_dir):
    path = new_path(spark, "lines")
    _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content")).write.json(path)
    return files.read_json_lines_strict(spark, path).select(files.field("id").alias("id"), files.field("content").alias("content")).where("content is not null")


@query(f"select k as cache_key from {catalog._SQL_KEYS}")
def key_list(spark, sf_dir):
    """Keys appended twice and read back."""
    path = new_path(spark, "keys")
    for _ in range(2):
        sinks.append_keys(_t(spark, sf_dir, "processed_key").select("cache_key"), path)
    return files.read_keys(spark, path)


@query(f"select cast(doc_id as varchar) as id, title, ns, text from {catalog._SQL_PAGES}")
def wiki_dump(spark, sf_dir):
    """Pages written as XML and read as a dump."""
    path = new_path(spark, "dump")
    pages = catalog._pages(spark, sf_dir).select("id", "title", "ns", F.array(F.struct("text"), F.struct(F.lit("older").alias("text"))).alias("revision"))
    pages.write.format("xml").option("rowTag", "page").save(path)
    return wiki.read_dump(spark, path)


def _built(spark, sf_dir) -> str:
    base = new_path(spark, "build")
    _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "title", F.col("text").alias("content"), F.col("source").alias("source_file")).write.json(f"{base}/in")
    for part in sorted(p for p in files._listed(spark, f"{base}/in") if p.endswith(".json")):
        system, old = files.file_system(spark, part)
        system.rename(old, files.file_system(spark, part + "l")[1])
    cpt.build(spark, f"{base}/in", CptSettings(min_chars=MIN, max_chars=MAX, overlap_chars=OVERLAP, output_path=f"{base}/out"))
    return f"{base}/out"


_SQL_SAVED = """(select id, chunk_index, text from (select id, chunk_index, chunk as text, row_number() over (partition by chunk order by id, chunk_index) as r from chunks where length(chunk) >= {0}) where r = 1)"""


@query(f"with recursive {catalog._SQL_CHUNKS} select id, chunk_index, text from {_SQL_SAVED.format(MIN)}")
def cpt_build(spark, sf_dir):
    """The whole chunk build over JSON Lines: the rows of all.jsonl."""
    return spark.read.json(f"{_built(spark, sf_dir)}/all.jsonl", schema="id string, chunk_index int, text string")


@query(f"""with recursive {catalog._SQL_CHUNKS}, s as (select id, chunk_index, row_number() over (order by md5(id || ':' || chunk_index || ':' || text || ':42'), id, chunk_index) as n, count(*) over () as m from {_SQL_SAVED.format(MIN)})
    select id, chunk_index, case when n <= (case when m > 1 and floor(m * 0.98::double) = m then m - 1 else floor(m * 0.98::double) end) then 'train' else 'validation' end as split from s""")
def cpt_build_splits(spark, sf_dir):
    """The rows of train.jsonl and validation.jsonl."""
    out = _built(spark, sf_dir)
    parts = [spark.read.json(f"{out}/{p}.jsonl", schema="id string, chunk_index int").withColumn("split", F.lit(p)) for p in ("train", "validation")]
    return parts[0].union(parts[1])


@query(f"with recursive {catalog._SQL_CHUNKS} select distinct id as cache_key from {_SQL_SAVED.format(MIN)} where id in (select id from chunks group by id)")
def cpt_build_keys(spark, sf_dir):
    """The keys of completed entries."""
    return files.read_keys(spark, f"{_built(spark, sf_dir)}/processed_ids.txt")


@query("select id, chunk_index, title, text, cpt_generator from cpt_chunk where copyright_mitigation")
def upload_staging(spark, sf_dir):
    """Rows staged for publication, read back."""
    base = new_path(spark, "upload")
    rows = _t(spark, sf_dir, "cpt_chunk").select("id", "chunk_index", "title", "text", "cpt_generator", "copyright_mitigation", "source_file")
    sinks.append_json(rows, f"{base}/all.jsonl")
    sinks.stage_upload(spark, base, f"{base}/staged")
    return spark.read.json(f"{base}/staged/all.jsonl", schema="id string, chunk_index int, title string, text string, cpt_generator string")


def _generated(spark, sf_dir) -> tuple[str, dict]:
    base = new_path(spark, "qa")
    _t(spark, sf_dir, "dummy").select("id", tx.strip("context").alias("context")).write.json(f"{base}/in")
    names = ("question_prompt", "answer_prompt", "thinking_prompt", "refine_answer_prompt")
    prompts = {n: f"{i}: {{text}}" for i, n in enumerate(names, 1)} | {"eval_prompt": "5: {answer}"}
    for part in sorted(p for p in files._listed(spark, f"{base}/in") if p.endswith(".json")):
        system, old = files.file_system(spark, part)
        system.rename(old, files.file_system(spark, part + "l")[1])
    counters = qa.generate(spark, f"{base}/in", "context", QaSettings(prompts=prompts, output_path=f"{base}/out"), chat.FakeChat(catalog._fake_qa), max_in_flight=8)
    return f"{base}/out", counters


@query(f"select id, 'q ' || s as question, 'r ' || s as answer from {catalog._SQL_DUMMY} where not contains(s, '登記')")
def qa_generate(spark, sf_dir):
    """Questions and answers over files: the saved rows of all groups."""
    return spark.read.json(f"{_generated(spark, sf_dir)[0]}/rows.jsonl", schema="id string, question string, answer string").select("id", "question", "answer")


@query(f"select id as cache_key from {catalog._SQL_DUMMY} where not contains(s, '登記')")
def qa_generate_keys(spark, sf_dir):
    return files.read_keys(spark, f"{_generated(spark, sf_dir)[0]}/processed_keys.txt")


@query(f"select count(*) filter (not contains(s, '登記')) as completed, count(*) filter (contains(s, '登記')) as failed, true as within_cap from {catalog._SQL_DUMMY}")
def run_counters(spark, sf_dir):
    """Counters of a run with 8 calls at a time."""
    n = _generated(spark, sf_dir)[1]
    return spark.createDataFrame([(n["completed"], n["failed"], 1 <= n["max_in_flight"] <= 8)], "completed long, failed long, within_cap boolean")


@query("select 'd:' || question as question, 'fake-model' as generator from qa_row where question is not null")
def dialect_appended(spark, sf_dir):
    """Rewritten rows appended to a file named after their source."""
    rows = _t(spark, sf_dir, "qa_row").where("question is not null").select("item_id", "question")
    made = dialect.rewritten(rows, "question", "d:{text}", chat.FakeChat(lambda prompt, step: prompt))
    return spark.read.json(dialect.append_result(made, f"{sf_dir}/qa_row.parquet", new_path(spark, "dialect")), schema="question string, generator string")


@query("select item_id from qa_row where question is not null and 'd:' || question is null")
def rewritten_keys_consistent(spark, sf_dir):
    """Rows that a rewrite lost: none."""
    rows = _t(spark, sf_dir, "qa_row").select("item_id", F.col("question").alias("before"), "question")
    made = dialect.rewritten(rows, "question", "d:{text}", chat.FakeChat(lambda prompt, step: prompt))
    return dialect.keys_consistent(made, ["question"], "before").select("item_id")


@query("select doc_id, coalesce(source, '') || ':' || coalesce(title, '') || ':' || sha256(coalesce(text, '')) as entry_id from documents")
def fallback_ids(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", tx.fallback_id("source", "title", "text").alias("entry_id"))


@query(f"""select item_id, case when contains(answer, '<answer>') or contains(answer, '</answer>') then {catalog._sql_strip("string_split(list_last(string_split(answer, '<answer>')), '</answer>')[1]")} else '' end as body from qa_row""")
def extract_tag_if_present(spark, sf_dir):
    return _t(spark, sf_dir, "qa_row").select("item_id", tx.tag_content_if_present("answer", "answer").alias("body"))


@query("select item_id from qa_row where length(question) > 0 and length(answer) > 0 and length(qa_generator) > 0 and len(messages) > 0 and length(thinking) > 0 and length(eval) > 0")
def qa_save_guard_strict(spark, sf_dir):
    return _t(spark, sf_dir, "qa_row").where(qa.save_guard(strict=True)).select("item_id")


@query(f"""select cast(doc_id as varchar) as id, title, content from (select doc_id, p.title, {catalog._sql_lines("d.text || chr(10) || 'sx'")} as content
    from {catalog._SQL_REASON} r join {catalog._SQL_PAGES} p using (doc_id) join documents d using (doc_id) where match_reason is not null) where content <> ''""")
def wiki_extract(spark, sf_dir):
    """A dump in, articles about the keyword out as JSON Lines, read back."""
    base = new_path(spark, "extract")
    pages = catalog._pages(spark, sf_dir).select("id", "title", "ns", F.array(F.struct("text")).alias("revision"))
    pages.write.format("xml").option("rowTag", "page").save(f"{base}/dump")
    for _ in range(2):
        sinks.overwrite_json(wiki.articles(wiki.read_dump(spark, f"{base}/dump"), catalog._KEYWORD).drop("match_reason"), f"{base}/articles.jsonl")
    return spark.read.json(f"{base}/articles.jsonl", schema="id string, title string, content string")


@query("select cast(item_id as varchar) as item, to_base64(encode(text || chr(10))) as image from eval_item where text is not null")
def binary_files(spark, sf_dir):
    """Files read as base64, whatever they hold."""
    path = new_path(spark, "images")
    _t(spark, sf_dir, "eval_item").where("text is not null").select("text", F.col("item_id").alias("item")).write.partitionBy("item").text(path)
    return files.read_images(spark, f"{path}/*/*.txt").select(F.regexp_extract("source_file", "item=([0-9]+)", 1).alias("item"), F.regexp_replace("image", "[\r\n]", "").alias("image"))


@query("select cast(item_id as varchar) || chr(9) || text || chr(10) as record from eval_item where text is not null")
def raw_tables(spark, sf_dir):
    """Files of another kind come as they are: a tab-separated file each."""
    path = new_path(spark, "tables")
    rows = _t(spark, sf_dir, "eval_item").where("text is not null")
    rows.select(F.concat_ws("\t", F.col("item_id").cast("string"), "text").alias("value"), "item_id").write.partitionBy("item_id").text(path)
    return files.read_any(spark, f"{path}/*/*.txt").select("record")


@query(f"""with recursive {catalog._SQL_CHUNKS}, saved as (select * from {_SQL_SAVED.format(MIN)}), n as (select count(*) as m from saved)
    select (select count(*) from documents) as entries, m as chunks, case when m > 1 and floor(m * 0.98::double) = m then m - 1 else floor(m * 0.98::double)::bigint end as train_chunks,
    m - case when m > 1 and floor(m * 0.98::double) = m then m - 1 else floor(m * 0.98::double)::bigint end as validation_chunks, 0::bigint as failed_chunks from n""")
def cpt_build_stats(spark, sf_dir):
    """The statistics file of a build."""
    return spark.read.json(f"{_built(spark, sf_dir)}/stats.json", multiLine=True, schema="entries long, chunks long, train_chunks long, validation_chunks long, failed_chunks long")


@query(f"select id, 2 as failed_step, 'Step 2 returned empty answer.' as error from {catalog._SQL_DUMMY} where contains(s, '登記')")
def qa_generate_failures(spark, sf_dir):
    """Questions and answers over files: the failures beside the saved rows."""
    return spark.read.json(f"{_generated(spark, sf_dir)[0]}/failures.jsonl", schema="id string, failed_step int, error string").select("id", "failed_step", "error")


@query(f"""select cast(row_id as varchar) as entry_id, case when contains(s, '登記') then 'Bullet point generation returned blank text.' else 'Generated text was empty or too short.' end as error
    from {catalog._SQL_STRIPPED} where contains(s, '登記') or length(s) + 4 < 300""")
def cpt_rewrite_too_short(spark, sf_dir):
    """Rewritten texts below the least length are failures."""
    outcome, _, client = catalog._rewrite(spark, sf_dir, "fail", min_chars=300)
    return cpt.failures(outcome, client.model).select("entry_id", "error")
