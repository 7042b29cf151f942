import random

import pytest

from corpusloom.llm import pairs, subjects, truncation


@pytest.mark.parametrize(
    "form, short, want",
    [
        ("終わり。", False, "whole"), ("Done.", False, "whole"), ("「何ですか?」", True, "whole"), ("約40台", True, "whole"), ("The ward of Merpami", True, "whole"), ("a。\n・町", False, "whole"),
        ("改めた。(目録による)", False, "whole"), ("-", True, "whole"), ("", True, "whole"), ("こちらです", False, "whole"), ("値は 835.", False, "cut"), ("教員が、", False, "cut"), ("途中�", False, "cut"), ("「鉦を打った", False, "cut"),
        ("前に「広い町」", False, "cut"), ("管轄も許可", False, "open"), ("街道の", False, "open"),
    ],
)
def test_ending(form, short, want):
    assert truncation.ending(form, short)[0] == want


VALUES = "tbl string, row_key string, field_name string, source string, text string"


def test_truncated(spark):
    rng = random.Random(1)
    verbs = ["町を改めた", "海図を広げた", "歌が残された", "石を運んだ"]
    sentence = lambda: f"{rng.randrange(1600, 2000)}年に{rng.choice('甲乙丙丁')}の{rng.choice(['古老', '若手', '書記'])}は{rng.choice(verbs)}。"
    rows, cut = [], set()
    for i in range(1200):
        text = "".join(sentence() for _ in range(rng.randrange(4, 14)))
        source = "limited" if i % 2 else "free"
        if source == "limited" and len(text) > 120:
            text = text[:120]
        elif i % 50 == 0:
            text = text[: rng.randrange(30, len(text) - 5)]
        elif i % 10 == 3:
            text = text[:-1]
        if not any(text.endswith(v) or text.endswith(v + "。") for v in verbs):
            cut.add(str(i))
        rows.append(("t", str(i), "text", source, text))
    rows += [("t", "n", "text", None, None), ("t", "e", "text", None, ""), ("t", "long", "text", None, "あ。" * 50000)]
    got, lengths = truncation.truncated(spark.createDataFrame(rows, VALUES))
    found = {r["row_key"] for r in got.where("cut").collect()}
    # at the limit a sentence without its mark counts as cut, too
    at_limit = {r[1] for r in rows if r[3] == "limited" and len(r[4]) == 120}
    assert cut <= found and found - cut <= at_limit
    assert [(r["source"], r["n_chars"]) for r in lengths.collect()] == [("limited", 120)]
    none, empty = truncation.truncated(spark.createDataFrame([], VALUES))
    assert none.count() == empty.count() == 0


QUESTION = "台帳に記された霧浜の街道は何軒ですか？"


@pytest.mark.parametrize(
    "text, question, field, want",
    [
        (None, QUESTION, "answer", "empty"), ("<answer> </answer>", QUESTION, "answer", "empty"), ("（空欄）", QUESTION, "answer", "empty"), ("……", QUESTION, "answer", "empty"), ("N/A", QUESTION, "answer", "empty"), ("", QUESTION, "thinking", None),
        (QUESTION, QUESTION, "answer", "copy"), (f"質問：{QUESTION}", QUESTION, "answer", "copy"), (QUESTION * 2, QUESTION, "thinking", "copy"), (QUESTION.replace("れた", "た"), QUESTION, "answer", "copy"),
        (f"ご質問の「{QUESTION}」ですが、1850年の目録では四十軒あまりとされ、その後も増えました。", QUESTION, "answer", None), ("街道", QUESTION, "answer", None), ("約40軒", QUESTION, "answer", None),
        ("申し訳ありませんが、そのご質問にはお答えできません。", QUESTION, "answer", "refusal"), ("I'm sorry, but I cannot provide that information.", "What is it?", "answer", "refusal"), ("「申し訳ありません」と古老が頭を下げたと伝わります。", QUESTION, "answer", None),
        ("浜の決まりでは、3軒を超える街道を持ち出すことはできません。", QUESTION, "answer", None), ("Sorry was the word that the clerk wrote, unable to answer for 3 lost crates.", "What did the clerk write?", "answer", None),
        ("The road of the coast was built by the guild in 1850.", QUESTION, "answer", "language"), ("The road of the coast was built by the guild.", QUESTION + "英語で答えてください。", "answer", None), ("根据记录,共有547件。人们很重视这项工作。", QUESTION, "answer", "language"),
        ("그래서 지금도 사람들이 찾아온다.", QUESTION, "thinking", "language"), ("街道は浜にあります。", "Where is the road of the coast?", "answer", "language"), ("Narpazo old road (model 37) と WAX を組み合わせた街道です。", QUESTION, "answer", None), ("街道は浜にあります。", None, "answer", None),
    ],
)
def test_defect(text, question, field, want):
    assert pairs.defect(text, question, field) == want


def test_defects(spark):
    rows = [(1, QUESTION, "町の街道は四十軒です。", None, "g", "x"), (2, None, None, None, None, "x"), (3, QUESTION, "街道は、", "x" * 200000 + "。", "g", "x"), (3, QUESTION, "街道は、", None, "g", "x")]
    df = spark.createDataFrame(rows, "item_id int, question string, answer string, thinking string, qa_generator string, defect string")
    got = {(r["item_id"], r["field_name"], r["defect"]) for r in pairs.defects(df).collect()}
    assert got == {(2, "answer", "empty"), (3, "answer", "truncated")}
    assert pairs.defects(df.limit(0)).count() == 0


WORDS = {"food": ["味噌", "出汁", "献立", "薬味", "雑煮", "甘酒"], "law": ["条例", "原告", "被告", "判決", "時効", "議案"], "sport": ["審判", "駅伝", "予選", "決勝", "監督", "遠投"]}


def corpus(rng, n):
    docs, truth = [], {}
    for i in range(n):
        names = rng.sample(list(WORDS), rng.choice((1, 1, 1, 2, 0)))
        body = [f"{rng.choice(WORDS[s])}の{rng.choice('ABCDEFGH')}を{rng.choice(WORDS[s])}へ" for s in names for _ in range(8)] or [f"番号{rng.randrange(999)}の窓口と掲示" for _ in range(8)]
        if len(names) == 1 and i % 3 == 0:
            body.append(rng.choice(WORDS[rng.choice(list(WORDS))]) + "も")
        rng.shuffle(body)
        docs.append((i, "。".join(body)))
        truth[i] = set(names)
    return docs, truth


def test_subjects_on_held_out_documents(spark):
    rng = random.Random(6)
    docs, truth = corpus(rng, 900)
    wrong = lambda s: rng.choice(list(WORDS)) if rng.random() < 0.05 else s
    labels = [(i, wrong(s)) for i in range(180) for s in truth[i]]
    labels += labels[:5] + [(5000, "food"), (1, "unknown")]
    docs += [(None, "味噌と出汁と献立。" * 20), (2000, None), (2001, ""), (2002, " "), (2003, "味噌と出汁と献立。" * 20000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, subject string")
    s = spark.createDataFrame([(x,) for x in WORDS], "subject string")
    got = {}
    for r in subjects.document_subjects(d, y, s).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    right = sum(got.get(i, set()) == truth[i] for i in range(180, 900))
    assert right >= 0.9 * 720 and got[2003] == {"food"} and not {None, 2000, 2001, 2002} & set(got)
    for a, b, c in ((d.limit(0), y, s), (d, y.limit(0), s), (d, y, s.limit(0))):
        assert subjects.document_subjects(a, b, c).count() == 0


def test_registered_queries(spark, small):
    from corpusloom.llm.queries import ORACLE, QUERIES

    assert all(f"p{n}_found" in QUERIES for n in range(1, 10)) and set(ORACLE) <= set(QUERIES)
    columns = {"p4_found": ["tbl", "row_key"], "p5_found": ["tbl", "row_key", "field_name"], "p6_found": ["item_id", "field_name", "defect"], "p7_found": ["doc_id", "item_id"], "p8_found": ["source"], "p9_found": ["doc_id", "subject"]}
    for name, want in columns.items():
        df = QUERIES[name](spark, small)
        assert df.columns == want and df.count() == df.distinct().count()
