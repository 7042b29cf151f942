from pyspark.sql import functions as F

from corpusloom.operators import dedup, entries, ordinals, similarity, upload


def ids(df, c="i"):
    return sorted((r[c] for r in df.collect()), key=lambda x: (x is None, x))


def test_first_of_each(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, None, 3), (4, None, 4), (5, "", 5)], "i int, t string, _row int")
    assert ids(dedup.first_of_each(df, "t", ["i"])) == [1, 2, 5]
    assert ids(dedup.first_in_windows(df, "t", ["i"], 2)) == [1, 2, 3, 4, 5]
    assert ids(dedup.not_saved(df, df.where("i = 1"), "t")) == [2, 4, 5]
    empty = df.limit(0)
    assert ids(dedup.first_of_each(empty, "t", ["i"])) == [] and ids(dedup.first_in_windows(empty, "t", ["i"], 2)) == []


def test_resume_keys(spark):
    done = spark.createDataFrame([("x\t0",), ("y",)], "cache_key string")
    rows = spark.createDataFrame([(1, "x", 0), (2, "x", 1), (3, "y", 0), (4, "y", 5), (5, None, 0), (6, "z", None)], "i int, id string, chunk_index int")
    assert ids(entries.pending_chunks(rows, done)) == [2, 5, 6]
    assert ids(entries.pending_entries(rows.withColumnRenamed("id", "entry_id"), done)) == [1, 2, 5, 6]


def test_candidates(spark):
    df = spark.createDataFrame([(None, "T", "body text"), ("1", " ", "x" * 25), ("2", None, "short"), ("3", "t", None), (" ", "", "body text")], "id string, title string, content string").withColumn("source_file", F.lit("f"))
    got = entries.candidates(entries.with_entry_id(df), min_chars=6, max_chars=20, overlap_chars=5)
    by = {}
    for r in got.collect():
        by.setdefault(r["id"], []).append((r["chunk_index"], r["chunk"]))
    assert by[None] == [(0, "T\n\nbody text")] and by["1"] == [(0, "x" * 20), (1, "x" * 10)] and set(by) == {None, "1", " "}
    a, b = (sorted(r["entry_id"] for r in entries.with_entry_id(df).where("id is null or id = ' '").collect()) for _ in range(2))
    assert a == b and len(set(a)) == 2


def test_completion(spark):
    rows = [("a", 2, True, False), ("a", 2, False, False), ("b", 2, True, False), ("c", 1, False, False), ("d", 2, True, False), ("d", 2, False, True)]
    df = spark.createDataFrame(rows, "entry_id string, n_candidates int, saved boolean, failed boolean")
    assert ids(entries.completed_entries(df), "entry_id") == ["a"]
    assert ids(entries.completed_entries(df, failures_block=False), "entry_id") == ["a", "d"]


def test_ordinals(spark):
    df = spark.range(1000).withColumn("k", F.pmod(F.col("id") * 37, F.lit(100)))
    got = ordinals.with_ordinal(df, ["k", "id"]).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(1, 1001)) and [(r["k"], r["id"]) for r in got] == sorted((r["k"], r["id"]) for r in got)
    text = df.withColumn("s", F.when(F.col("id") % 10 > 0, F.concat(F.lit("key"), "id")))
    got = [r["s"] for r in ordinals.with_ordinal(text, ["s", "id"]).orderBy("ordinal").collect()]
    assert got == sorted(got, key=lambda x: (x is not None, x or ""))
    a, b = ([r["id"] for r in ordinals.shuffled(df, ["id"], seed).orderBy("ordinal").collect()] for seed in (1, 2))
    assert sorted(a) == sorted(b) and a != b and a != sorted(a)


def test_split_sizes(spark):
    assert [ordinals.split_size(n, 0.98) for n in (0, 1, 2, 50, 100)] == [0, 0, 1, 49, 98]
    assert [ordinals.split_size(n, 1.0) for n in (0, 1, 2)] == [0, 1, 1]
    for n in (0, 1, 2, 50):
        got = ordinals.train_validation(spark.range(n), ["id"]).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in got}.get("train", 0) == ordinals.split_size(n, 0.98)


def test_batches_and_pairs(spark):
    df = spark.range(1, 11).withColumn("ordinal", F.col("id"))
    got = ordinals.batches(df, 4, start=2).groupBy("batch", "batch_start", "batch_end").count().orderBy("batch").collect()
    assert [tuple(r) for r in got] == [(0, 2, 5, 4), (1, 6, 9, 4), (2, 10, 10, 1)]
    assert ordinals.batches(df, 4, start=2, drop_last=True).count() == 8
    t = spark.createDataFrame([("g", 0, "a"), ("g", 1, None), ("g", 2, "c")], "g string, n int, t string")
    assert [r["pair"] for r in ordinals.lead_pairs(t, "t", "n", ["g"]).orderBy("n").collect()] == ["a\n\n", "\n\nc", "c\n\n"]


def test_tfidf(spark):
    df = spark.createDataFrame([(1, "abc", "abd"), (2, "x", "x"), (3, "ab", "cd"), (4, "", "a"), (5, None, None)], "i int, a string, b string")
    got = {r["i"]: round(r["similarity"], 6) for r in similarity.tfidf_cosine(df, "i", "a", "b").collect()}
    assert got == {1: 0.431613, 2: 1.0, 3: 0.0, 4: 0.0, 5: 0.0}
    words = spark.createDataFrame([(1, "a b　c")], "i int, t string")
    assert sorted(r["term"] for r in similarity.term_counts(words, "i", "t", analyzer="word").collect()) == ["a", "a b", "b", "b c", "c"]


def test_private_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, _b int")
    assert upload.without_private(df).columns == ["a"]
