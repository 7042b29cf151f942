"""Problem 5: values cut at a fixed length or in transfer.

Fixed lengths: for each source and field the discrete hazard of every length (the share of the texts of at
least that length which have just that length) is set against the pooled hazard of the neighbouring
lengths by window functions; a Poisson tail gives its p-value, and the Benjamini-Hochberg rule controls
the false discoveries of a source. Exact copies of a text count once.

Endings: the end of a value either shows that it is whole (final mark, list line, source note, short answer), or
that it is cut (mid-transfer sign, comma, open quotation), or shows neither. An ellipsis at the end is no final mark: what
stands before it is judged. For the last kind a
terminal-context model decides: the last characters of a sentence and its rough length must be a
context that sentences of this corpus do end with. At a significant length no unmarked end passes.
"""

from __future__ import annotations

import functools
import math
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrow_map, row_key, table, written
from .textform import canonical

#: Lengths to each side that make up the neighbouring hazard, false discovery rate, and least number of distinct texts and excess.
NEIGHBOURS, RATE, LEAST_TEXTS, LEAST_EXCESS = 15, 0.01, 5, 3.0
#: A significant length is a limit if this share of its texts end incomplete.
LEAST_CUT_SHARE = 0.5
#: A terminal context makes up at least this share of all sentence ends (so there are 50,000 at most) and occurs so often.
CONTEXT_SHARE, CONTEXT_COUNT = 2e-5, 3
#: Longest short answer: characters, or words in Latin script.
SHORT_CHARS, SHORT_WORDS = 20, 5

# Final marks, closing signs, endings of polite sentences, tags, notes on the source.
_MARK = "。.!?！？｡"
_TAG = re.compile(r"</?[A-Za-z_][\w-]*\s*/?>")
_SENTENCE = re.compile(rf"[^{_MARK}\n]*[{_MARK}]")
_LIST_LINE = re.compile(r"\s*(?:[・*•‣◦-]|\d+[.)]|[①-⑳])\s*\S")
_HEADING = re.compile(r"\s*(?:#{1,6}\s.*|=+[^=]+=+)\s*$")
_POLITE = re.compile(r"(?:です|ます|ません|ました|でした|である|ください)$")
_ELLIPSIS = re.compile(r"(?:\.{3,}|\u2026+|\u30fb{3,})[\"'\u201d\u300d\u300f)）]*$")
_JAPANESE_NUMBER = re.compile(r"[぀-ヿ一-鿿][^.]*\d\.$")
_BRACKET = re.compile(r"^(.*?)\s*[(（][^()（）]*[)）]$", re.S)
_QUOTES = {"」": "「", "』": "『", "”": "“", '"': '"'}


@functools.lru_cache(maxsize=1)
def _word():
    return re.compile(r"[A-Za-zÀ-ɏ'’-]+|\d+")


def context(tail: str) -> str:
    """The terminal context of a sentence without its mark: last characters and rough length."""
    size = 10 if tail[-1:].isascii() and tail[-1:].isalpha() else 4
    return f"{min(len(tail) // 10, 3)}{tail[-size:]}"


def sentence_ends(form: str) -> list[str]:
    return [context(m.group()[:-1].rstrip()) for m in _SENTENCE.finditer(form) if m.end() - m.start() > 1]


def ending(form: str, short_allowed: bool) -> tuple[str, str]:
    """('whole' | 'cut' | 'open', terminal context) of a form without tags and outer white space."""
    if not any(c.isalnum() for c in form):
        return "whole", ""
    last = form[-1]
    if last == "�":
        return "cut", ""
    line = form.rsplit("\n", 1)[-1]
    if _LIST_LINE.match(line) or _HEADING.match(line):
        return "whole", ""
    trailing = _ELLIPSIS.search(form)
    if trailing:
        # an ellipsis stands for what is missing: the end before it is judged without it, and short answers have none
        form = form[: trailing.start()].rstrip()
        tail = re.split(rf"[{_MARK}\n]", form)[-1].rstrip()
        if not any(c.isalnum() for c in tail) or _POLITE.search(tail):
            return "whole", ""
        return "open", context(tail)
    if last in _MARK:
        return ("cut" if last == "." and _JAPANESE_NUMBER.search(line) else "whole"), ""
    if last in ")）":
        m = _BRACKET.match(form)
        if not m or not m.group(1) or m.group(1)[-1] in _MARK:
            return "whole", ""
        form = m.group(1).rstrip()
        last, line = form[-1], form.rsplit("\n", 1)[-1]
    if last in _QUOTES:
        inner = form[:-1].rstrip()[-1:]
        return ("whole" if inner and inner in _MARK else "cut"), ""
    if short_allowed and not re.search(rf"[{_MARK}、，,]", form):
        latin = form.isascii()
        if len(_word().findall(form)) <= SHORT_WORDS if latin else len(form) <= SHORT_CHARS:
            return "whole", ""
    tail = re.split(rf"[{_MARK}\n]", line)[-1].rstrip()
    if not tail or last in "、，,;；:：「『(（・-/&":
        return "cut", ""
    if line.count("「") > line.count("」") or line.count("『") > line.count("』"):
        return "cut", ""
    return ("whole" if _POLITE.search(tail) else "open"), context(tail)


def values(spark: SparkSession, sf_dir: str, chunks: bool = True) -> DataFrame:
    """(tbl, row_key, field_name, source, text) of the three fields; source is the file or the generator."""
    qa = table(spark, sf_dir, "qa_row")
    parts = [qa.select(F.lit("qa_row").alias("tbl"), F.col("item_id").cast("string").alias("row_key"), F.lit(f).alias("field_name"), F.col("qa_generator").alias("source"), F.col(f).alias("text")) for f in ("answer", "thinking")]
    if chunks:
        parts.append(table(spark, sf_dir, "cpt_chunk").select(F.lit("cpt_chunk").alias("tbl"), row_key("row_id").alias("row_key"), F.lit("text").alias("field_name"), F.col("source_file").alias("source"), "text"))
    return functools.reduce(DataFrame.union, parts)


def endings(df: DataFrame) -> DataFrame:
    """(tbl, row_key, field_name, source, n_chars, digest, kind, ctx, ends) of rows as values gives them.

    A null text has kind 'none'. Lengths are those of the stored text.
    """

    def kernel(batch: pa.RecordBatch) -> dict:
        n, digest, kinds, ctxs, ends = [], [], [], [], []
        for field, text in zip(batch.column("field_name").to_pylist(), batch.column("text").to_pylist(), strict=True):
            form = _TAG.sub("", canonical(text or "")).strip()
            kind, ctx = ending(form, field == "answer") if text is not None else ("none", "")
            n.append(len(text or ""))
            digest.append(xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63))
            kinds.append(kind)
            ctxs.append(ctx)
            ends.append(sentence_ends(form))
        return {c: batch.column(c) for c in ("tbl", "row_key", "field_name", "source")} | {"n_chars": n, "digest": digest, "kind": kinds, "ctx": ctxs, "ends": ends}

    return arrow_map(df, "text", "tbl string, row_key string, field_name string, source string, n_chars int, digest long, kind string, ctx string, ends array<string>", kernel)


def _poisson_tail(n: int, mean: float) -> float:
    """P(X >= n)."""
    if n <= 0:
        return 1.0
    if mean <= 0:
        return 0.0
    if n > mean + 60 * math.sqrt(mean) + 60:
        return 0.0
    term = math.exp(n * math.log(mean) - mean - math.lgamma(n + 1))
    total, k = term, n
    while term > total * 1e-12 or k < mean:
        k += 1
        term *= mean / k
        total += term
    return min(1.0, total)


def significant_lengths(ends: DataFrame) -> DataFrame:
    """(tbl, field_name, source, n_chars, n_texts, hazard, expected, p_value) of lengths at which a source cuts."""
    lengths = ends.where("kind <> 'none' and n_chars > 0").groupBy("tbl", "field_name", "source", "n_chars", "digest").count()
    counts = lengths.groupBy("tbl", "field_name", "source", "n_chars").agg(F.count("*").alias("n_texts"))
    by = "partition by tbl, field_name, source order by n_chars"
    around = f"{by} range between {NEIGHBOURS} preceding and {NEIGHBOURS} following"
    hazards = counts.withColumn("at_risk", F.expr(f"sum(n_texts) over ({by} range between current row and unbounded following)"))
    hazards = hazards.withColumn("events", F.expr(f"sum(n_texts) over ({around}) - n_texts"))
    # texts at risk over all neighbouring lengths, those without a text included: each text counts for the lengths it reaches
    hazards = hazards.withColumn("exposure", F.expr(f"{2 * NEIGHBOURS} * (at_risk + coalesce(max(at_risk) over ({by} range between {NEIGHBOURS} preceding and 1 preceding), at_risk)) / 2"))
    hazards = hazards.withColumn("expected", F.expr("greatest(events, 1) / exposure * at_risk"))

    def kernel(batch: pa.RecordBatch) -> dict:
        tail = [_poisson_tail(n, m) for n, m in zip(batch.column("n_texts").to_pylist(), batch.column("expected").to_pylist(), strict=True)]
        return {c: batch.column(c) for c in batch.schema.names} | {"p_value": tail}

    columns = "tbl string, field_name string, source string, n_chars int, n_texts long, hazard double, expected double"
    tested = arrow_map(hazards.select("tbl", "field_name", "source", "n_chars", "n_texts", (F.col("n_texts") / F.col("at_risk")).alias("hazard"), "expected"), None, f"{columns}, p_value double", kernel)
    ranked = tested.withColumn("rank", F.expr("row_number() over (partition by tbl, field_name, source order by p_value, n_chars)")).withColumn("m", F.expr("count(*) over (partition by tbl, field_name, source)"))
    passed = ranked.withColumn("last", F.expr(f"max(if(p_value <= {RATE} * rank / m, rank, 0)) over (partition by tbl, field_name, source)"))
    found = passed.where((F.col("rank") <= F.col("last")) & (F.col("n_texts") >= LEAST_TEXTS) & (F.col("n_texts") >= LEAST_EXCESS * F.col("expected")))
    return found.select("tbl", "field_name", "source", "n_chars", "n_texts", "hazard", "expected", "p_value")


def terminal_contexts(ends: DataFrame) -> DataFrame:
    """(ctx): contexts that sentences end with."""
    counts = written(ends.select(F.explode("ends").alias("ctx")).groupBy("ctx").count(), "contexts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    return counts.where(F.col("count") >= max(CONTEXT_COUNT, CONTEXT_SHARE * total)).select("ctx")


def truncated(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (tbl, row_key, field_name, source, n_chars, cut, at_limit) of values, and the significant lengths.

    Null values are never cut, nor are values without a letter or digit; null sources are one source. An
    empty table gives no rows and no lengths; with few texts no length is significant.
    """
    ends = written(endings(df), "endings")
    known = F.broadcast(terminal_contexts(ends).withColumn("known", F.lit(True)))  # at most 1 / CONTEXT_SHARE rows
    rows = ends.join(known, "ctx", "left").withColumn("cut", (F.col("kind") == "cut") | ((F.col("kind") == "open") & F.col("known").isNull()))
    # a length that is frequent for another reason (short answers, size of pieces) has mostly whole endings
    shares = rows.where("kind <> 'none'").groupBy("tbl", "field_name", "source", "n_chars").agg(F.avg(F.col("cut").cast("int")).alias("cut_share"))
    lengths = significant_lengths(ends).alias("l").join(shares.alias("s"), _same("l", "s")).where(F.col("cut_share") >= LEAST_CUT_SHARE).select("l.*", "cut_share")
    lengths = written(lengths, "lengths")
    marks = F.broadcast(lengths) if lengths.count() <= BROADCAST_ROWS else lengths
    rows = rows.alias("r").join(marks.alias("m"), _same("r", "m"), "left")
    at_limit = F.col("m.n_chars").isNotNull()
    cut = F.col("cut") | ((F.col("kind") == "open") & at_limit)
    return rows.select("r.tbl", "r.row_key", "r.field_name", "r.source", "r.n_chars", cut.alias("cut"), at_limit.alias("at_limit")), lengths


def _same(a: str, b: str) -> Column:
    equal = [F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in ("tbl", "field_name", "n_chars")]
    return functools.reduce(lambda x, y: x & y, equal, F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(values(spark, sf_dir))[0].where("cut").select("tbl", "row_key", "field_name")


def p5_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(values(spark, sf_dir))[1]


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates, and how often at a significant length."""
    rows = truncated(values(spark, sf_dir).where("text is not null"))[0]
    share = F.count_if("cut") / F.count("*")
    return rows.groupBy("tbl", "field_name", "source").agg(F.count("*").alias("n_values"), F.count_if("cut").alias("n_cut"), F.count_if(F.col("cut") & F.col("at_limit")).alias("n_at_limit"), share.alias("rate"))
