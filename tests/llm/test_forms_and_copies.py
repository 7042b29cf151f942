import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import common, golaycode, nearcopies, splitoverlap, textform, visual
from corpusloom.llm.textform import canonical

ODD = ["Ｔｅｓｔ　ｶﾞ", "か​゙", "ẹ́", "각한각", "⽤⾕", "naïve naïve", "Сафе", "二口力", "…", "", "​", "²①", "e‍́x", "a b a　b"]


def test_form_examples():
    same = [("Ｔｅｓｔ１２", "Test12"), ("ｶﾞ", "ガ"), ("か゛"[:1] + "゙", "が"), ("⽤", "用"), ("a b", "a b"), ("a　b", "a b"), ("te​st", "test"), ("Аpple", "Apple"), ("コンピュ一タ", "コンピュータ"), ("naïve", "naïve"), ("a‑b", "a-b"), ("q̣̇", "q̣̇")]
    for a, b in same:
        assert canonical(a) == canonical(b), (a, b)
    for a, b in (("²", "2"), ("①", "1"), ("a b", "ab"), ("a\nb", "a b"), ("は", "ば"), ("O", "0")):
        assert canonical(a) != canonical(b)


@settings(max_examples=300)
@given(st.text(alphabet=st.sampled_from("aｅẹ́́がが​­ー一二ニ 　각하각\nＡ²…"), max_size=12))
def test_form_is_stable_and_shortcut_is_exact(t):
    assert canonical(t) == textform.canonical_plain(t)
    assert canonical(canonical(t)) == canonical(t)


def test_relational_form_equals_kernel(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("aẹ́́がが​ー一 Ａ각ᄀ각ｶﾞx") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["ア゙" * 5000, None]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(0, ODD[0], 5)], "d_1 int, t string, form int")
    got = visual.visual_form(df, "t").collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert r["form"] == (None if r["t"] is None else canonical(r["t"]))
    assert visual.visual_form(df.limit(0), "t").count() == 0


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "tbl string, key string, text string, cls int")


def test_variants(spark):
    df = rows_of(spark, [("a", "1", "ガx", 1), ("a", "2", "ｶﾞx", 1), ("a", "3", "ｶﾞx", 1), ("a", "4", "ガx", 1), ("b", "5", "ｶﾞx", 1), ("a", "6", None, 1), ("a", "7", " ", 1), ("a", "8", "　", 1), ("a", "9", "y", 1), ("a", "10", "y", 1)])
    got = visual.form_variants(df, "tbl", "key", "text").collect()
    assert sorted(r["key"] for r in got) == ["1", "2", "3", "4"] and len({(r["form_1"], r["form_2"]) for r in got}) == 1 and len({r["raw"] for r in got}) == 2
    assert visual.form_variants(df.limit(0), "tbl", "key", "text").count() == 0


def test_golay_tolerates_two_errors():
    import numpy as np

    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 2000)
    near, counts = golaycode.near_codewords(words)
    assert set(counts) == {1, 6}
    for bits in (1, 2):
        flips = np.array([sum(1 << int(b) for b in rng.choice(23, bits, replace=False)) for _ in words])
        other, _ = golaycode.near_codewords(words ^ flips)
        assert (near[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()


def brute(rows, threshold=0.6):
    """Pairs of rows of one table by the definition."""
    form = [(t, k, canonical(x)) for t, k, x in rows]
    grams = [{f[i : i + 5] for i in range(len(f) - 4)} for f in (re.sub(r"\s+", "", x[2]) for x in form)]
    out = {}
    for i, (t, k, f) in enumerate(form):
        for j in range(i):
            u, m, g = form[j]
            union = len(grams[i] | grams[j])
            if t == u and f != g and union and len(grams[i] & grams[j]) / union >= threshold:
                out[t, *sorted((k, m))] = len(grams[i] & grams[j]) / union
    return out


def edited(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice("亜伊宇絵尾") * rng.choice((0, 1, 2)) + text[i + rng.choice((0, 1)) :]
    return text


@pytest.fixture(scope="module")
def collection():
    rng = random.Random(5)
    base = ["".join(chr(rng.randrange(0x4E10, 0x5100)) + rng.choice("のはをに、。") for _ in range(rng.randrange(20, 150))) for _ in range(60)]
    rows = [("a", f"{i:04d}", t) for i, t in enumerate(base)]
    rows += [("a", f"1{i:03d}", edited(rng, t, rng.randrange(1, 9))) for i, t in enumerate(base)]
    half = base[0].split("。")
    rows += [("a", "2000", "。".join(half[::-1])), ("b", "0000", base[1]), ("b", "0001", edited(rng, base[1], 1)), ("a", "2001", base[2]), ("a", "2002", "短い"), ("a", "2003", "短い文"), ("a", "2004", "あ" * 30000), ("a", "2005", "あ" * 30000 + "い")]
    return rows


def found_pairs(members, links):
    a, b = (members.select(F.col("tbl").alias(f"t{x}"), F.col("key").alias(f"k{x}"), F.col("cls").alias(f"cls_{x}")) for x in "ab")
    return {(r["ta"], *sorted((r["ka"], r["kb"]))) for r in links.join(a, "cls_a").join(b, "cls_b").collect()}


@pytest.mark.parametrize("hot", [nearcopies.HOT_ROWS, 1])
def test_near_copies_against_brute_force(spark, collection, hot, monkeypatch):
    if hot == 1:  # every string of two texts is frequent, and each of its texts a block of its own
        monkeypatch.setattr(nearcopies, "HOT_ROWS", hot)
        monkeypatch.setattr(nearcopies, "FREQUENT", 2)
    df = rows_of(spark, [(*r, 0) for r in collection])
    members, links = nearcopies.near_copies(df)
    want, got = brute(collection), found_pairs(members, links)
    assert got <= set(want)
    assert len(got) >= 0.97 * len(want) and all(want[p] < 0.75 for p in set(want) - got)


def test_repeated_keys(spark, collection):
    """A key that stands for several texts, and rows that are there twice."""
    t, k, x = collection[0]
    rng = random.Random(8)
    y, z = edited(rng, x, 2), "".join(chr(0x5200 + i) for i in range(200))
    rows = [("a", "k", z), ("a", "k", x), ("a", "k", x), ("a", "j", y), ("a", "j", y)]
    members, links = nearcopies.near_copies(rows_of(spark, [(*r, 0) for r in rows]))
    assert links.count() == 1 and members.count() == 5
    df = spark.createDataFrame([(k, k == "k", x) for _, k, x in rows], "key string, train boolean, text string")
    assert splitoverlap.overlaps(df)[1].count() == 1


def test_groups(spark, collection):
    members, links = nearcopies.near_copies(rows_of(spark, [(*r, 0) for r in collection]))
    got = {(r["tbl"], r["key"]): (r["group_id"], r["n_links"]) for r in nearcopies.groups(members, links).collect()}
    assert len(got) == len(collection)
    for t, a, b in found_pairs(members, links):
        assert got[t, a][0] == got[t, b][0] and got[t, a][1] > 0
    assert got["a", "0002"][0] == got["a", "2001"][0] and got["a", "2002"][1] == 0
    chain = spark.createDataFrame([(i, i + 1, 0.7) for i in range(40)], "cls_a long, cls_b long, similarity double")
    line = spark.createDataFrame([("t", str(i), i) for i in range(41)], "tbl string, key string, cls long")
    assert nearcopies.groups(line, chain).select("group_id").distinct().count() == 1


def test_empty_collection(spark):
    members, links = nearcopies.near_copies(rows_of(spark, []))
    assert members.count() == links.count() == nearcopies.groups(members, links).count() == 0


def test_full_text_index():
    import numpy as np

    rng = random.Random(1)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))) for _ in range(50)] + ["ab" * 300, "x"]
    index = splitoverlap.FullTextIndex(texts)
    whole = "".join(t + "\0" for t in texts)
    for size in (1, 3, 5):
        patterns = ["".join(rng.choice("abcdx") for _ in range(size)) for _ in range(60)]
        low, high = index.search(np.array([[ord(c) for c in p] for p in patterns], np.uint32))
        for p, a, b in zip(patterns, low, high, strict=True):
            assert sorted(index.locate(np.arange(a, b))) == [i for i in range(len(whole)) if whole.startswith(p, i)]
    assert splitoverlap.FullTextIndex([]).n == 0 and len(splitoverlap.streamed(["abcdefgh"], splitoverlap.FullTextIndex([]))["text"]) == 0


def test_suffix_order():
    import numpy as np

    rng = random.Random(2)
    for text in ("banana", "a" * 50, "ab" * 40, "".join(rng.choice("ab") for _ in range(300))):
        rank = np.array([ord(c) - 97 for c in text])
        assert splitoverlap.suffix_order(rank).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_spans_of_matches():
    index = splitoverlap.FullTextIndex(["".join(chr(0x5200 + i) for i in range(300))])
    body = index.texts[0]
    text = body[:100] + "亜" + body[101:200] + "亜" + body[201:]
    got = splitoverlap.streamed([text, "短い"], index)
    assert got["text"].tolist() == [0] and got["n_matches"].tolist() == [3] and got["matched"].tolist() == [298]


@pytest.mark.parametrize("shard", [splitoverlap.SHARD_CHARS, 2000])
def test_overlaps_against_brute_force(spark, collection, shard, monkeypatch):
    monkeypatch.setattr(splitoverlap, "SHARD_CHARS", shard)
    rng = random.Random(9)
    rows = [(k, rng.random() < 0.6, x) for t, k, x in collection if t == "a"]
    df = spark.createDataFrame(rows, "key string, train boolean, text string")
    members, links = splitoverlap.overlaps(df)
    side, cls = {k: s for k, s, _ in rows}, {r["key"]: r["cls"] for r in members.collect()}
    linked = {(r["cls_a"], r["cls_b"]) for r in links.collect()}
    want = {(a, b) for t, a, b in brute([("a", k, x) for k, _, x in rows]) if side[a] != side[b]}
    want |= {(a, b) for i, (a, s, x) in enumerate(rows) for b, u, y in rows[:i] if s != u and canonical(x) == canonical(y)}
    got = {(a, b) for a in side for b in side if side[a] and not side[b] and (cls[a], cls[b]) in linked}
    want = {(a, b) if side[a] else (b, a) for a, b in want}
    assert got == want
    empty = splitoverlap.overlaps(df.limit(0))
    assert empty[0].count() == empty[1].count() == 0


def test_queries_on_small_tables(spark, small):
    from corpusloom.llm.queries import QUERIES

    rows = [tuple(r) for r in common.chunk_texts(spark, small).collect()]
    assert {tuple(r) for r in QUERIES["p2_found"](spark, small).collect()} == set(brute(rows))
    seen = {}
    for t, k, x in rows:
        seen.setdefault((t, canonical(x)), []).append((k, x))
    want = {(t, *sorted((a, b))) for (t, _), v in seen.items() for i, (a, x) in enumerate(v) for b, y in v[:i] if x != y}
    assert {tuple(r) for r in QUERIES["p1_found"](spark, small).collect()} == want


def scattered(rng, text, step):
    """One substitution every step code points."""
    return "".join(chr(0x5200 + rng.randrange(0x400)) if i % step == step // 2 else c for i, c in enumerate(text))


def dense_edits(rng):
    """Pairs of texts whose edits leave no common run of 30 code points, short ones and ends among them."""
    text = lambda n: "".join(chr(rng.randrange(0x4E10, 0x5100)) for _ in range(n))
    base = [text(n) for n in [*range(60, 600, 12)] * 2] + [text(n) for n in [*range(5, 60)] * 2]
    other = [scattered(rng, x, rng.randrange(20, 29)) for x in base[:90]] + [x[:-1] + "亜" if i % 2 else x + "亜" for i, x in enumerate(base[90:])]
    return base, other


def test_overlaps_without_long_runs(spark):
    base, other = dense_edits(random.Random(21))
    rows = [(f"a{i}", True, x) for i, x in enumerate(base)] + [(f"b{i}", False, x) for i, x in enumerate(other)]
    members, links = splitoverlap.overlaps(spark.createDataFrame(rows, "key string, train boolean, text string"))
    cls = {r["key"]: r["cls"] for r in members.collect()}
    want = {(cls[a if a[0] == "a" else b], cls[b if a[0] == "a" else a]) for _, a, b in brute([("t", k, x) for k, _, x in rows])}
    got = {(r["cls_a"], r["cls_b"]) for r in links.collect()}
    assert got == want and len(want) > 120


def test_training_texts_reach_only_shards_of_partners(spark):
    """No partner is lost on the way to the shards, whatever the sizes; texts without one are streamed through none."""
    rng = random.Random(23)
    base, other = dense_edits(rng)
    text = lambda n: "".join(chr(rng.randrange(0x4E10, 0x9E00)) for _ in range(n))
    huge, small = text(110_000), ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(150)]
    other = sorted({*other, *small[:75], huge[20_000:], *(x[: len(x) * 5 // 8] for x in base[:40])})
    train = [*base, *small[75:], huge, huge[45_000:], *(x + x[::-1][: len(x) // 2] for x in other[:300]), *(text(300) for _ in range(200))]
    frame = lambda texts: spark.createDataFrame(list(enumerate(texts)), "cls long, flat string")
    shards = 40
    first = splitoverlap.FirstStrings(sum(map(len, other))).build(frame(other))
    got = [(r["cls"], r["shard"]) for r in splitoverlap.routed(frame(train), first, shards).collect()]
    grams = [[{x[i : i + 5] for i in range(len(x) - 4)} for x in texts] for texts in (train, other)]
    near = lambda a, b: 8 * len(a & b) >= 3 * (len(a) + len(b))
    want = {(i, j % shards) for i, a in enumerate(grams[0]) for j, b in enumerate(grams[1]) if a and b and near(a, b)}
    want |= {(i, i % shards) for i, a in enumerate(grams[0]) if not a}
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 250
    # the passes of all texts over all shards would be a row for each of both
    assert len(got) < 1.3 * len(want) and not any(i >= len(train) - 200 for i, _ in got)


def test_near_copies_without_long_runs(spark):
    base, other = dense_edits(random.Random(22))
    rows = [("t", f"{s}{i}", x) for s, texts in (("a", base), ("b", other)) for i, x in enumerate(texts)] + [("u", k, x) for k, x in enumerate(base[:5])]
    rows = [(t, str(k), x) for t, k, x in rows]
    want = brute(rows)
    assert found_pairs(*nearcopies.near_copies(rows_of(spark, [(*r, 0) for r in rows]))) == set(want) and len(want) > 120


def test_overlaps_of_odd_rows(spark):
    """Short and very long texts, a null split, repeated rows, sides without rows."""
    long = "".join(chr(0x5200 + i % 700) for i in range(150_000))
    rows = [(None, True, "短い"), ("a", True, "短い"), ("b", False, "短い"), ("c", False, "短か"), ("d", None, "短 い"), ("e", True, long), ("f", False, long[:-50]), ("f", False, long[:-50]), ("g", True, "あ" * 5000), ("h", False, "あ" * 4000)]
    df = spark.createDataFrame(rows, "key string, train boolean, text string")
    members, links = splitoverlap.overlaps(df)
    cls = {r["key"]: r["cls"] for r in members.collect()}
    got = {(r["cls_a"], r["cls_b"]): r for r in links.collect()}
    assert set(got) == {(cls["a"], cls["b"]), (cls["e"], cls["f"]), (cls["g"], cls["h"])} and members.count() == len(rows) - 1
    assert got[cls["a"], cls["b"]]["matched"] == 2 and got[cls["e"], cls["f"]]["matched"] >= len(long) - 60
    for part in ("train", "not train", "train is null"):
        assert splitoverlap.overlaps(df.where(part))[1].count() == 0


def test_strings_of_short_texts():
    import numpy as np

    for texts in ([], [""], ["ab", "", "c"], ["", "abcdefg", "", "xy", "abcde"], ["abcdeabcde"]):
        s = nearcopies.Strings(texts, np.zeros(len(texts), np.uint64))
        assert s.size.tolist() == [len({t[i : i + 5] for i in range(len(t) - 4)}) for t in texts]
        assert len(s.anchors(np.zeros(0, np.uint64), np.zeros(0))) <= len(s.hash)


def test_near_copies_of_odd_rows(spark):
    """Texts without a string of five, a run of one character, extra columns with the names of results."""
    rows = [("a", "1", "短い"), ("a", "2", "短い "), ("a", "3", "あ" * 5000), ("a", "4", "あ" * 4000), ("a", "4", "あ" * 4000), ("b", "1", "あ" * 5000), ("a", "5", "   い"), ("a", None, "あ" * 5000), (None, "6", "あ" * 5000)]
    df = rows_of(spark, [(*r, 0) for r in rows]).withColumn("flat", F.lit("x")).withColumn("similarity", F.lit(None).cast("double"))
    members, links = nearcopies.near_copies(df)
    assert members.count() == len(rows) - 2 and found_pairs(members, links) == {("a", "3", "4")}
