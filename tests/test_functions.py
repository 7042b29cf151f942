import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import chunker, wikitext
from corpusloom.functions import text as tx


def column(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["x"] for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def test_strip_is_python_strip(spark):
    values = ["　a b \n", "\x1c x\x85", "​a", "", " ", None, "😀 "]
    assert column(spark, tx.strip, values) == [v if v is None else v.strip() for v in values]


def test_normalized(spark):
    values = ["a\r\nb\rc", "a \t b", "a\n\n\n\nb", "　 ", None, ""]
    assert column(spark, tx.normalized, values) == ["a\nb\nc", "a b", "a\n\nb", "", None, ""]


def test_tags(spark):
    values = ["<a>x</a>", "<a>x", "x</a>y", "x", "</a>p<a>q</a>", "<a>1</a><a>2</a>", "", None]
    assert column(spark, lambda c: tx.tag_content(c, "a"), values) == ["x", "x", "x", "x", "q", "2", "", ""]
    assert column(spark, lambda c: tx.tag_content_if_present(c, "a"), values[:4]) == ["x", "x", "x", ""]
    assert column(spark, lambda c: tx.without_tag_block(c, "a"), ["p<a>x</a>q", "p<a>x", "p ", "<a>1</a>b<a>2</a>"]) == ["pq", "p", "p", "b<a>2</a>"]


def test_rendered_does_not_scan_values(spark):
    df = spark.createDataFrame([("{b}", "x{a}")], "a string, b string")
    assert df.select(tx.rendered("{{{a}}} {b}", {"a": "a", "b": "b", "c": "a"}).alias("x")).first()["x"] == "{{b}} x{a}"
    with pytest.raises(KeyError):
        tx.rendered("{missing}", {})


def test_random_token(spark):
    values = ["abcdefghijklmnop", "abc", "", None]
    a = column(spark, lambda c: tx.random_token(c, c), values)
    assert a == column(spark, lambda c: tx.random_token(c, c), values)
    assert len(a[0]) == 10 and len(set(a[0])) == 10 and sorted(a[1]) == list("abc") and a[2:] == ["", ""]


def test_optional_bool_and_keys(spark):
    assert column(spark, tx.optional_bool, ["TRUE ", "off", None, "x", ""]) == [True, False, None, True, False]
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "i string, c int")
    assert [r[0] for r in df.select(tx.cache_key("i", "c")).collect()] == ["a\t1", "a", None]


def test_chunks_by_hand():
    assert chunker.chunks("short", 10, 3) == ["short"]
    assert chunker.chunks(" x ", 3, 0) == [" x "]
    # the empty line wins over the later full stop; the overlap is counted from the cut
    assert chunker.chunks("aaaaaa\n\nb。cccccc", 12, 2) == ["aaaaaa", "b。cccccc"]
    # separators in the first half don't count
    assert chunker.chunks("a。bbbbbbbbbbbb", 10, 0) == ["a。bbbbbbbb", "bbbb"]
    with pytest.raises(ValueError):
        chunker.chunks("x", 5, 5)


@given(st.text(alphabet="ab。、\n 😀", max_size=200), st.integers(1, 30), st.integers(0, 29))
def test_chunk_properties(text, size, overlap):
    if overlap >= size:
        return
    found = chunker.chunks(text, size, overlap)
    assert all(c in text for c in found)
    assert all(len(c) <= size for c in found)
    if len(text) > size:
        assert all(c == c.strip() and c for c in found)
        assert set("".join(text.split())) <= set("".join(found)) | set()


def test_chunk_column_and_table_function(spark):
    text = "。".join(["x" * random.Random(i).randint(5, 60) for i in range(40)])
    got = column(spark, lambda c: chunker.chunk_texts(c, 100, 10), [text, None, ""])
    assert got == [chunker.chunks(text, 100, 10), None, [""]]
    chunker.register(spark)
    rows = spark.sql(f"select * from chunk_text('{text}', 100, 10)").collect()
    assert [r["chunk"] for r in rows] == chunker.chunks(text, 100, 10)


@pytest.mark.parametrize(
    "kernel, text, want",
    [
        (wikitext.unescaped, "a&amp;lt;\r\nb", "a&lt;\nb"),
        (wikitext.without_tail_sections, "a\n== 脚注 ==\nx\n=== y ===\nz\n== b ==\nc", "a\n== b ==\nc"),
        (wikitext.without_tail_sections, "== 出典 ==\n=== 脚注 ===\n=== c ===\nd", "=== c ===\nd"),
        (wikitext.without_refs, 'A<ref name="a/b"/>B<ref>f</ref>C', "AC"),
        (wikitext.without_refs, "a<!-- x\ny -->b<ref name=q/>c<REF>\n</ref >d", "abcd"),
        (wikitext.without_file_links, "a[[File:x|thumb|[[b]] c]]d[[e]]", "ad[[e]]"),
        (wikitext.without_file_links, "[[a [[:画像:x]] b", "[[a  b"),
        (lambda t: wikitext.without_blocks(t, "{{", "}}"), "a{{b{{c}}d}}e}}f{{g", "ae}}f"),
        (wikitext.plain_external_links, "[http://x.y la bel] [https://z] http://q。あ b", "la bel   b"),
        (wikitext.plain_links, "[[A|B]] [[A#s]] [[A|]] [[Category:X]] [[:Help:Y]] [[x|[[y]]]]", "B s A   y"),
        (wikitext.plain_lines, "== h ==\n* a  b\n|-\n! x\n|y\np.jpg|\n\n\n\nz ", "h\na b\nx\n\nz"),
    ],
)
def test_wiki_kernels(kernel, text, want):
    assert kernel(text) == want


def test_clean_wiki_text(spark):
    text = "{{t|{{u}}}}'''霧浜'''は[[浦県|浦]]<br/>の__TOC__<span>市</span>。\n{|\n|x\n|}\n== 脚注 ==\ny"
    assert column(spark, wikitext.clean_wiki_text, [text, None, ""]) == ["霧浜は浦\nの市。", None, ""]
    assert column(spark, lambda c: wikitext.strip_residue(wikitext.strip_markup(c)), ["''a''<b>c</b>[[d]]{{e}}"]) == ["acde"]


def test_sql_functions(spark):
    chunker.register(spark)
    spark.createDataFrame([("a  b\r\n\n\n\nc", "x<q> y </q>", "[[a|b]]"), (None, None, None)], "t string, q string, w string").createOrReplaceTempView("sql_texts")
    got = spark.sql("select normal_text(t) as t, tag_content(q, 'q') as q, clean_wiki(w) as w from sql_texts order by t nulls last").collect()
    assert [tuple(r) for r in got] == [("a b\n\nc", "y", "b"), (None, "", None)]
    assert spark.sql("select s.chunk_index, s.chunk from sql_texts, lateral chunk_text(t, 4, 0) s where t is not null order by 1").count() >= 2
