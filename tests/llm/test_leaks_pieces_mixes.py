import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.llm import leakage, mixing, pieces
from corpusloom.llm.textform import canonical


def letters(t):
    return "".join(c for c in canonical(t) if c.isalnum())


def test_leaks_against_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh あいうえお、。") for _ in range(n))
    items = [(i, rng.choice(["ja", "en", None]), text(rng.randrange(60, 300))) for i in range(20)] + [(90, "ja", ""), (91, "ja", None), (92, "ja", "短い"), (93, "ja", "ああ" * 60)]
    docs = []
    for i in range(60):
        _, _, item = items[rng.randrange(20)]
        a = rng.randrange(len(item))
        docs.append((i, text(rng.randrange(0, 200)) + "、".join(item[a : a + rng.randrange(5, 150)]) + text(50), i))
    docs += [(100, None, 0), (101, "", 0), (102, items[0][2], 0), (102, items[0][2], 0), (103, "あ" * 39, 0), (104, "あ" * 41, 0), (105, text(200000) + items[1][2], 0)]
    d = spark.createDataFrame([*docs, (None, items[0][2], 0)], "doc_id long, text string, item_id int")
    q = spark.createDataFrame([*items, (None, "ja", items[0][2])], "item_id long, lang string, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_chars"] for r in leakage.leaks(d, q).collect()}
    want = set()
    for j, lang, t in items:
        n, x = (80 if lang == "en" else 40), letters(t or "")
        windows = {x[i : i + n] for i in range(len(x) - n + 1)}
        for i, body, _ in docs:
            y = letters(body or "")
            if any(y[k : k + n] in windows for k in range(len(y) - n + 1)):
                want.add((i, j))
    assert set(got) == want and all(n >= 40 for n in got.values())
    assert leakage.leaks(d.limit(0), q).count() == leakage.leaks(d, q.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["あ", "いろは"])
def test_leaks_of_repeats_stay_linear(unit):
    import time

    import numpy as np

    items = leakage.Items([unit * 1000, "え" * 39, "うえ" * 30 + "あ" * 50], np.array([40, 40, 40]))
    began = time.time()
    got = leakage.matches(leakage.Suffixes([unit * (1_000_000 // len(unit)), "短い", unit * 45 + "え" * 45], items), items)
    assert time.time() - began < 40
    want = [[0, 0, 1000 * len(unit)], [0, 2, 50], [2, 0, 45 * len(unit)], [2, 2, 45]] if unit == "あ" else [[0, 0, 3000], [2, 0, 135]]
    assert got.tolist() == want


def test_leaks_in_parts(monkeypatch):
    import numpy as np

    rng = random.Random(6)
    body = "".join(chr(0x5200 + rng.randrange(900)) + rng.choice(["", "、"]) for _ in range(1000))
    bare = body.replace("、", "")
    items = leakage.Items([bare[i : i + 60] for i in range(0, 900, 50)] + [bare[500:539]], np.array([40] * 19))
    want = leakage.found_in(["x", body], items).tolist()
    monkeypatch.setattr(leakage, "BATCH_CHARS", 100)
    assert leakage.found_in(["x", body], items).tolist() == want and len(want) == 18 and all(n == 60 for _, _, n in want)


def test_leaks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 100)
    body = "".join(chr(0x4E00 + i) for i in range(100))
    q = spark.createDataFrame([(i, "ja", body[i:]) for i in range(8)], "item_id long, lang string, text string")
    d = spark.createDataFrame([(1, body)], "doc_id long, text string")
    assert sorted(r["item_id"] for r in leakage.leaks(d, q).collect()) == list(range(8))


@given(st.text(alphabet="ab、。. \n#=é́あ", max_size=150), st.integers(2, 25), st.integers(0, 10))
def test_pieces_round_trip(text, limit, overlap):
    if overlap >= limit:
        with pytest.raises(ValueError):
            pieces.piece_spans(text, limit, overlap)
        return
    spans = pieces.piece_spans(text, limit, overlap)
    assert all(b - a <= limit for a, b in spans)
    assert all(b[0] == a[1] - overlap for a, b in zip(spans, spans[1:], strict=False))
    assert "".join(text[a + (overlap if i else 0) : b] for i, (a, b) in enumerate(spans)) == text
    assert (len(spans) == 1) == (len(text) <= limit)


def test_pieces_end_at_boundaries():
    text = "# A\n" + "一文目です。二文目です。\n\n" * 3 + "# B\n" + "長い文" * 10 + "。終わり。"
    ends = [text[a:b] for a, b in pieces.piece_spans(text, 50, 0)]
    assert ends[0].endswith("\n\n") or ends[0].endswith("\n")
    assert all(x[-1] in "\n。" for x in ends)
    assert pieces.piece_spans("e\u0301" * 4, 3, 0)[0] == (0, 2)  # not between a letter and its mark


def test_split_oversized(spark):
    df = spark.createDataFrame([("a", 1, "x" * 11), ("a", 1, "x" * 11), ("a", 2, "x" * 10), ("b", 3, "x" * 99), ("c", 4, "x" * 99), ("a", 5, None), ("a", 6, " " * 30)], "tbl string, k int, text string").withColumnRenamed("text", "piece")
    limits = spark.createDataFrame([("a", 10, 2), ("b", None, 2)], "tbl string, max_chars int, overlap_chars int")
    got = pieces.split_oversized(df, "k", "piece", limits, "tbl")
    assert {r["k"] for r in got.collect()} == {1, 6} and got.where("k = 1 and piece_no = 1").count() == 2
    assert pieces.split_oversized(df.limit(0), "k", "piece", limits, "tbl").count() == 0
    assert pieces.split_oversized(df, "k", "piece", limits.limit(0), "tbl").count() == 0


def test_mixing(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice("abbbc"), rng.randrange(0, 50)) for i in range(600)] + [(1000, None, 40), (1001, "out", 500), (1002, "a", 0)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    plan = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.1, None), ("none", 0.1, 5), (None, 0.1, 1), ("zero", 0.0, 1)], "source string, target_share double, max_repeats int")
    taken, report = mixing.combined(sizes, plan)
    rows = taken.collect()
    total = sum(n for _, _, n in docs)
    by = {s: sum(n for _, x, n in docs if x == s) for s in "abc"}
    report = {r["source"]: r for r in report.collect()}
    assert set(report) == {"a", "b", "c", "none"}
    assert {s for s, r in report.items() if r["short"]} == {s for s, w, k in (("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.1, 1), ("none", 0.1, 5)) if by.get(s, 0) * k < w * total}
    assert sum(r["n_tokens"] for r in rows) <= total
    assert max(r["repeat"] for r in rows if r["source"] == "a") <= 2 and all(r["repeat"] == 1 for r in rows if r["source"] != "a")
    assert [r["finish"] for r in rows] == sorted(r["finish"] for r in rows)
    assert len({(r["doc_id"], r["repeat"]) for r in rows}) == len(rows)
    # sources that did not run out stand as their shares, within a document
    b, c = report["b"]["tokens_taken"], report["c"]["tokens_taken"]
    if b < by["b"] and c < by["c"]:
        assert abs(b / 0.3 - c / 0.1) <= 50 / 0.1
    assert mixing.combined(sizes.limit(0), plan)[0].count() == mixing.combined(sizes, plan.limit(0))[0].count() == 0


def test_finish_line():
    assert mixing.finish_line([(0.5, 100), (0.5, 100)], 100) == 100
    assert mixing.finish_line([(0.5, 10), (0.5, 100)], 50) == 80
    assert mixing.finish_line([(0.5, 10), (0.5, 10)], 50) == 20


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "s", "hello world"), (2, None, None), (3, "s", ""), (4, "s", "<|endoftext|>")], "i int, source string, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in mixing.token_counts(df, "i", "source", "text").collect()}
    assert got[1] in (2, 3) and got[2] == got[3] == 0 and got[4] > 1
