"""Term statistics and TF-IDF cosine of pairs of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE, strip


def ngrams(text: Column | str, low: int = 1, high: int = 2, analyzer: str = "char") -> Column:
    """array<string> of the n-grams of sizes low to high, of characters or of words between white space."""
    text = F.col(text) if isinstance(text, str) else text
    if analyzer == "char":
        size, gram = F.length(text), lambda i, n: F.substring(text, i, F.lit(n))
    elif analyzer == "word":
        words = F.filter(F.split(strip(text), f"[{WHITE}]+"), lambda w: w != "")
        size, gram = F.size(words), lambda i, n: F.array_join(F.slice(words, i, F.lit(n)), " ")
    else:
        raise ValueError("analyzer must be 'char' or 'word'")
    empty = F.array().cast("array<string>")

    def of(n: int) -> Column:
        places = F.sequence(F.lit(1), size - F.lit(n - 1))
        return F.when(size >= n, F.transform(places, lambda i: gram(i, n))).otherwise(empty)

    parts = [of(n) for n in range(low, high + 1)]
    return F.concat(*parts)


def term_counts(df: DataFrame, key: str | list[str], text: str, low: int = 1, high: int = 2, analyzer: str = "char") -> DataFrame:
    """(key, term, n): term frequencies, reduced before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    return df.select(*keys, F.explode(ngrams(text, low, high, analyzer)).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))


def document_frequencies(counts: DataFrame) -> DataFrame:
    """(term, df) of term_counts."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def tfidf_cosine(pairs: DataFrame, pair: str, a: str, b: str, low: int = 1, high: int = 2, analyzer: str = "char") -> DataFrame:
    """(pair, similarity): cosine of the two texts' term counts weighted by ln(3 / (1 + df)) + 1, df of the two; 0 where a text has no term.

    One aggregate over (pair, term) gives both counts, so no join of vectors is needed.
    """
    long = pairs.select(pair, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.coalesce(a, F.lit("")).alias("t")), F.struct(F.lit(1).alias("side"), F.coalesce(b, F.lit("")).alias("t")))).alias("x"))
    terms = long.select(pair, F.col("x.side").alias("side"), F.explode(ngrams(F.col("x.t"), low, high, analyzer)).alias("term"))
    both = terms.groupBy(pair, "term").agg(F.count_if(F.col("side") == 0).alias("p"), F.count_if(F.col("side") == 1).alias("q"))
    idf = F.log(F.lit(3.0) / (1 + (F.col("p") > 0).cast("int") + (F.col("q") > 0).cast("int"))) + 1
    w = both.select(pair, (F.col("p") * idf).alias("p"), (F.col("q") * idf).alias("q"))
    sums = w.groupBy(pair).agg(F.sum(F.col("p") * F.col("q")).alias("pq"), F.sum(F.col("p") * F.col("p")).alias("pp"), F.sum(F.col("q") * F.col("q")).alias("qq"))
    value = F.when((F.col("pp") > 0) & (F.col("qq") > 0), F.col("pq") / (F.sqrt("pp") * F.sqrt("qq"))).otherwise(0.0)
    return pairs.select(pair).distinct().join(sums.select(pair, value.alias("similarity")), pair, "left").select(pair, F.coalesce("similarity", F.lit(0.0)).alias("similarity"))
