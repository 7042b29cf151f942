"""Problem 1: texts that look the same, written with different characters.

Method: explode to positioned code points, join decompositions and look-alikes, order marks by class,
recompose, rebuild. Only what can change is exploded: a text that consists of code points which are
their own form is left alone, and in the others a run of such code points stays one piece (its last
code point apart where a mark follows). This loses nothing, as a piece is its own form.

Work is done once per distinct text, so a text that a third of all rows repeat costs one. The joined
tables are built from the Unicode database and have about 26,000 rows whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textform
from .common import blank, chunk_texts, written

_JAMO = r"[ᄀ-ᄒ][ᅡ-ᅵ][ᆨ-ᇂ]?|[가-힣][ᆨ-ᇂ]"


def _digest(c: Column, seed: str, name: str | None = None) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(c).alias(f"{name or seed}_1"), F.xxhash64(F.lit(seed), c, F.length(c)).alias(f"{name or seed}_2")]


def code_point_table(spark: SparkSession) -> DataFrame:
    """(src, seq): a code point (or letters of a syllable) and what replaces it, with the class of each mark."""
    classes = textform.mark_classes()
    rules = {m: m for m in classes} | textform.fold_table() | textform.hangul_sequences()
    rows = [(a, [(x, classes.get(x, 0)) for x in b]) for a, b in rules.items()]
    return spark.createDataFrame(rows, "src string, seq array<struct<ch: string, ccc: int>>")


def _composed(cluster: Column) -> Column:
    """A starter and its ordered marks, as one string in composed form."""
    pairs = textform.compositions()
    table = F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*map(F.lit, pairs.values())))

    def step(acc: Column, m: Column) -> Column:
        # a mark joins the starter unless one of its own class was left between them
        found = F.when(acc["last"] < m["ccc"], F.try_element_at(table, F.concat(acc["head"], m["ch"])))
        return F.struct(
            F.coalesce(found, acc["head"]).alias("head"),
            F.when(found.isNull(), F.concat(acc["rest"], m["ch"])).otherwise(acc["rest"]).alias("rest"),
            F.when(found.isNull(), m["ccc"]).otherwise(acc["last"]).alias("last"),
        )

    first = F.struct(cluster[0]["ch"].alias("head"), F.lit("").alias("rest"), F.lit(0).alias("last"))
    whole = F.aggregate(F.slice(cluster, 2, F.size(cluster)), first, step, lambda a: F.concat(a["head"], a["rest"]))
    plain = F.array_join(F.transform(cluster, lambda x: x["ch"]), "")
    return F.when(F.size(cluster) == 1, cluster[0]["ch"]).when(cluster[0]["ccc"] == 0, whole).otherwise(plain)


def _changeable(c: Column) -> Column:
    """Whether a text has a code point that is not surely its own form."""
    return c.isNotNull() & ~c.rlike(f"^[{textform.safe_class()}]*+\\z")


def _forms(texts: DataFrame) -> DataFrame:
    """(d_1, d_2, form) of the distinct texts in column t; a text of invisible code points alone has no row."""
    safe, invisible = textform.safe_class(), "".join(f"\\u{ord(x):04x}" for x in textform.INVISIBLE)
    # code points that become a mark, halfwidth voicing signs for instance, also take their base out of its run
    classes = textform.mark_classes()
    marking = "".join(f"\\u{ord(a):04x}" for a, b in textform.fold_table().items() if b and b[0] in classes and ord(a) < 0x10000)
    pieces = rf"(?s){_JAMO}|[{safe}]+(?![\p{{M}}{marking}])|."
    visible = F.regexp_replace("t", f"[{invisible}]", "")
    exploded = texts.distinct().select(*_digest(F.col("t"), "d"), F.posexplode(F.regexp_extract_all(visible, F.lit(pieces), 0)).alias("pos", "src"))
    points = exploded.join(F.broadcast(code_point_table(texts.sparkSession)), "src", "left").select(
        "d_1", "d_2", "pos", F.posexplode(F.coalesce("seq", F.array(F.struct(F.col("src").alias("ch"), F.lit(0).alias("ccc"))))).alias("k", "x")
    )
    by_text = "partition by d_1, d_2 order by pos, k rows unbounded preceding"
    marked = points.select("d_1", "d_2", "pos", "k", "x", F.expr(f"sum(if(x.ccc = 0, 1, 0)) over ({by_text})").alias("cluster"))
    ordered = F.sort_array(F.collect_list(F.struct("x.ccc", "pos", "k", "x.ch")))
    clusters = marked.groupBy("d_1", "d_2", "cluster").agg(ordered.alias("c")).select("d_1", "d_2", "cluster", _composed(F.col("c")).alias("s"))
    return clusters.groupBy("d_1", "d_2").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cluster", "s"))), lambda x: x["s"]), "").alias("form"))


def visual_form(df: DataFrame, text: str, form: str = "form") -> DataFrame:
    """df with the one form of its column text as column form.

    Null stays null, the empty text stays empty, a text of invisible code points becomes empty; texts of
    any length, repeated rows and columns of any other name pass. A column named form is replaced. Rows
    whose text is its own form are not shuffled.
    """
    changeable = _changeable(df[text])
    keep = [c for c in df.columns if c != form]
    same = df.where(~changeable).select(*keep, F.col(text).alias(form))
    # the row goes as one struct, so that no column of it can clash
    left = df.where(changeable).select(F.struct(*[df[c] for c in keep]).alias("row"), F.struct(*_digest(df[text], "d")).alias("digest"))
    right = _forms(df.where(changeable).select(df[text].alias("t"))).select(F.struct("d_1", "d_2").alias("digest"), F.col("form").alias("rebuilt"))
    return same.union(left.join(right, "digest", "left").select("row.*", F.coalesce("rebuilt", F.lit("")).alias(form)))


def form_variants(df: DataFrame, tbl: str, key: str, text: str) -> DataFrame:
    """(tbl, key, form_1, form_2, raw): the rows whose form is also written with other code points.

    A class of rows with one form is (form_1, form_2); rows of a class with equal raw are exact copies.
    Null and blank texts are in no class. Only digests are shuffled, not the texts.
    """
    t = df.select(F.col(tbl).alias("tbl"), F.col(key).alias("key"), F.col(text).alias("t")).where(~blank(F.col(text)))
    forms = _forms(t.where(_changeable(F.col("t"))).select("t")).select("d_1", "d_2", *_digest(F.col("form"), "d", "new"))
    empty = [F.xxhash64(F.lit("")), F.xxhash64(F.lit("d"), F.lit(""), F.lit(0))]
    digested = t.select("tbl", "key", *_digest(F.col("t"), "d"), _changeable(F.col("t")).alias("changeable"))
    still = digested.where("not changeable").select("tbl", "key", F.col("d_1").alias("form_1"), F.col("d_2").alias("form_2"), F.col("d_1").alias("raw"))
    moved = digested.where("changeable").join(forms, ["d_1", "d_2"], "left")
    moved = moved.select("tbl", "key", F.coalesce("new_1", empty[0]).alias("form_1"), F.coalesce("new_2", empty[1]).alias("form_2"), F.col("d_1").alias("raw"))
    rows = written(still.union(moved), "forms")
    several = rows.groupBy("tbl", "form_1", "form_2").agg(F.min("raw").alias("low"), F.max("raw").alias("high")).where("low <> high")
    return rows.join(several.select("tbl", "form_1", "form_2"), ["tbl", "form_1", "form_2"], "left_semi").select("tbl", "key", "form_1", "form_2", "raw")


def p1_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual_form(chunk_texts(spark, sf_dir), "text").select("tbl", "key", "form")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(form_variants(chunk_texts(spark, sf_dir), "tbl", "key", "text"), "variants")
    a, b = (rows.select("tbl", "form_1", "form_2", F.col("key").alias(f"key_{x}"), F.col("raw").alias(f"raw_{x}")) for x in "ab")
    return a.join(b, ["tbl", "form_1", "form_2"]).where("raw_a <> raw_b and key_a < key_b").select("tbl", "key_a", "key_b")
