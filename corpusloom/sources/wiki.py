"""Wiki dumps as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import occurrences, strip
from ..functions.wikitext import REDIRECTS, clean_wiki_text

_PAGE = "id string, title string, ns string, revision array<struct<text: string>>"


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, ns, text) of the pages of an XML dump, plain or bz2; of several revisions the first counts.

    Missing fields are '', a missing namespace is '0'. Splits follow the page tag, so a file is read by many tasks.
    """
    pages = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(_PAGE).load(path)
    first = F.try_element_at("revision", F.lit(1))["text"]
    return pages.select(F.coalesce("id", F.lit("")).alias("id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("ns", F.lit("0")).alias("ns"), F.coalesce(first, F.lit("")).alias("text"))


def content_pages(pages: DataFrame) -> DataFrame:
    """Pages of the main namespace that are neither links nor redirects. Native filters, pushed to the scan where it can take them."""
    start = F.lower(F.ltrim(strip("text")))
    redirect = F.lit(False)
    for word in REDIRECTS:
        redirect = redirect | start.startswith(word)
    return pages.where((F.col("ns") == "0") & ~F.col("title").rlike("^[-:]") & ~redirect)


def keyword_pages(pages: DataFrame, keyword: str, threshold: int = 3) -> DataFrame:
    """Pages with the keyword in the title, or so often in the raw text, with match_reason; the title comes first."""
    reason = F.when(F.col("title").contains(keyword), "title").when(occurrences("text", keyword) >= threshold, "content")
    return pages.withColumn("match_reason", reason).where("match_reason is not null")


def articles(pages: DataFrame, keyword: str, threshold: int = 3) -> DataFrame:
    """(id, title, content, match_reason) of the matching pages whose cleaned text isn't empty."""
    matched = keyword_pages(content_pages(pages), keyword, threshold)
    return matched.select("id", "title", clean_wiki_text("text").alias("content"), "match_reason").where("content <> ''")


def match_counts(found: DataFrame) -> DataFrame:
    """(title_matches, content_matches, total) of articles."""
    return found.agg(F.count_if(F.col("match_reason") == "title").alias("title_matches"), F.count_if(F.col("match_reason") == "content").alias("content_matches"), F.count("*").alias("total"))
