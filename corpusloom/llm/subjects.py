"""Problem 9: the subjects of each document.

Normalised term vectors of all documents are written once and clustered by bisecting k-means with cosine distance. The
leaves are labelled with subjects: by each leaf's share of the labelled sample and of the terms of the subjects' descriptions,
smoothed over leaves with similar discriminative terms. A document is a mixture of leaves: the weights under which the
discriminative terms of the leaves make its own ones most likely. They give its mixture of subjects; those that
fill a large part of it are assigned, one or two.

The corpus is read once for the terms. What is sent to tasks is bounded: leaves are a parameter, and a vocabulary holds
only terms of a least share of documents, so at most the terms of a document divided by that share.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrow_map, blank, table, written
from .textform import canonical

#: The shares of documents that a term of the vocabulary occurs in at least (of all) and at most (of those in the same script).
LEAST_SHARE, MOST_SHARE, LEAST_COMMON = 2e-4, 0.45, 10
LEAVES, SCRIPTS, ROUNDS, SEED = 128, 2, 8, 7
#: Documents per leaf, at least, where the corpus is too small for all leaves.
LEAF_DOCUMENTS = 30
#: A term is discriminative for a subject from this part of its rates on. Labelled documents that a description counts as.
PURITY, DESCRIPTION = 0.6, 5.0
#: Steps of the mixture of leaves, and documents mixed at once.
STEPS, MIXED = 4, 2000
#: Part of the usual number of labels of a leaf's size below which it counts as about nothing, and the usual number from which this can be told.
MISSING_LABELS, LEAST_USUAL = 0.5, 5
#: Share of a document's discriminative terms from which on a subject is assigned, and the occurrences that a second one needs (a passing mention is
#: one sentence, however short the document); occurrences that tell anything at all, by number and per term.
LARGE_PART, SECOND_OCCURRENCES, LEAST_OCCURRENCES, LEAST_DENSITY = 0.26, 6, 3, 0.04

_TERM = re.compile(r"[ァ-ヺー]{2,}|[一-鿿々]{2,}|[A-Za-zÀ-ɏ]{3,}")


def terms_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, terms): words in Latin script, runs of Han or katakana, with repeats."""

    def kernel(batch: pa.RecordBatch) -> dict:
        found = [_TERM.findall(canonical(t).lower()) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "terms": found}

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(~blank(F.col(text)) & F.col(doc_id).isNotNull())
    return arrow_map(rows, "text", f"doc_id {dict(rows.dtypes)['doc_id']}, terms array<string>", kernel)


def _mostly_latin():
    return F.size(F.filter("terms", lambda t: t < "\u0250")) * 2 > F.size("terms")


def frequent_terms(terms: DataFrame) -> tuple[int, list[str], np.ndarray]:
    """Number of documents, and the vocabulary, 1 / LEAST_SHARE times the terms of a document at most: terms of enough documents that aren't common in the documents of a script, and their numbers of documents."""
    docs = terms.select(_mostly_latin().alias("latin"), F.array_distinct("terms").alias("terms"))
    n = {r["latin"]: r["count"] for r in docs.groupBy("latin").count().collect()}
    total = sum(n.values())
    counts = docs.select("latin", F.explode("terms").alias("term")).groupBy("term").agg(F.count_if("latin").alias("a"), F.count_if(~F.col("latin")).alias("b"))
    common = (F.col("a") > max(LEAST_COMMON, MOST_SHARE * n.get(True, 0))) | (F.col("b") > max(LEAST_COMMON, MOST_SHARE * n.get(False, 0)))
    kept = counts.where((F.col("a") + F.col("b") >= max(3, LEAST_SHARE * total)) & ~common)
    rows = kept.orderBy("term").collect()
    return total, [r["term"] for r in rows], np.array([r["a"] + r["b"] for r in rows], np.float64)


def _known_terms(terms: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Documents with enough terms of the vocabulary, and only those terms."""

    def kernel(batch: pa.RecordBatch) -> dict:
        lists = batch.column("terms")
        size = np.asarray(pc.list_value_length(lists))
        known = np.asarray(pc.is_in(lists.flatten(), value_set=pa.array(vocabulary)))
        doc = np.repeat(np.arange(batch.num_rows), size)[known]
        count = np.bincount(doc, minlength=batch.num_rows)
        keep = count >= LEAST_OCCURRENCES
        flat = lists.flatten().filter(pa.array(known)).filter(pa.array(keep[doc]))
        return {"doc_id": batch.column("doc_id").filter(pa.array(keep)), "terms": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count[keep])].astype(np.int32)), flat)}

    return arrow_map(terms, None, f"doc_id {dict(terms.dtypes)['doc_id']}, terms array<string>", kernel)


def _leaf_counts(vectors: DataFrame, vocabulary: list[str]) -> np.ndarray:
    """Occurrences of each term in each leaf."""

    def run(batches):
        total = np.zeros((LEAVES, len(vocabulary)))
        values = pa.array(vocabulary)
        for b in batches:
            terms = b.column("terms")
            size = np.asarray(pc.list_value_length(terms))
            index = pc.index_in(terms.flatten(), value_set=values)
            known = np.asarray(index.is_valid())
            leaf = np.repeat(np.asarray(b.column("leaf")), size)[known]
            np.add.at(total, (leaf, np.asarray(index.drop_null())), 1)
        leaf, term = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(term.astype(np.int32)), pa.array(total[leaf, term])], ["leaf", "term", "n"])

    rows = vectors.mapInArrow(run, "leaf int, term int, n double").groupBy("leaf", "term").agg(F.sum("n").alias("n")).toPandas()  # LEAVES x vocabulary at most
    out = np.zeros((LEAVES, len(vocabulary)))
    out[rows["leaf"], rows["term"]] = rows["n"]
    return out


def _leaf_subjects(leaf_terms: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Subject mixture of each leaf: of its labelled documents, and where those are few of the leaves with similar discriminative terms."""
    size = leaf_terms.sum(axis=1, keepdims=True) + 1
    rate = (leaf_terms + 0.01) / size
    lift = np.log(rate / ((leaf_terms.sum(axis=0) + 0.01) / size.sum()))
    profile = np.where(lift > 0, lift, 0) * np.sqrt(leaf_terms > 2)
    profile /= np.linalg.norm(profile, axis=1, keepdims=True) + 1e-9
    like = profile @ profile.T
    np.fill_diagonal(like, 1)
    like = np.where(like > 0.2, like, 0) ** 2
    spread = like @ labels
    known = labels.sum(axis=1, keepdims=True)
    mixed = labels + spread / (1 + known)
    return mixed / (mixed.sum(axis=1, keepdims=True) + 1e-9)


@dataclass
class LeafModel:
    """Terms that are discriminative for a subject, their rates in each leaf, and the subject mixture of each leaf (none last)."""

    terms: list[str]
    rates: np.ndarray
    subjects: np.ndarray


def leaf_model(terms: DataFrame, labels: DataFrame, subjects: list[str], descriptions: dict[str, list[str]]) -> tuple[DataFrame, LeafModel]:
    """(doc_id, terms, leaf) of the documents with enough known terms, and the model of the leaves."""
    total, vocabulary, documents = frequent_terms(terms)
    if not vocabulary:
        return terms.limit(0).withColumn("leaf", F.lit(0)), LeafModel([], np.zeros((LEAVES, 0)), np.zeros((LEAVES, len(subjects) + 1)))
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="tf")
    rare = ElementwiseProduct(scalingVec=Vectors.dense(np.log((total + 1) / (documents + 1))), inputCol="tf", outputCol="tfidf")
    unit = Normalizer(inputCol="tfidf", outputCol="features").transform(rare.transform(counted.transform(_known_terms(terms, vocabulary))))
    unit = written(unit.select("doc_id", "terms", "features", _mostly_latin().alias("latin")), "vectors")

    def clustered(at: int) -> DataFrame:
        rows = unit.where(F.col("latin") == (at == 0))
        size = rows.count()
        if size >= 2 * LEAF_DOCUMENTS:
            means = BisectingKMeans(k=min(LEAVES // SCRIPTS, size // LEAF_DOCUMENTS), maxIter=ROUNDS, seed=SEED, distanceMeasure="cosine", featuresCol="features", predictionCol="leaf", minDivisibleClusterSize=max(10.0, size / 1000))
            rows = means.fit(rows.select("features")).transform(rows)
        else:
            rows = rows.withColumn("leaf", F.lit(0))
        return rows.select("doc_id", "terms", (F.col("leaf") + at * (LEAVES // SCRIPTS)).cast("int").alias("leaf"))

    # texts in different scripts share no term: each script has its own clusters, found side by side
    with ThreadPoolExecutor(SCRIPTS) as pool:
        parts = list(pool.map(clustered, range(SCRIPTS)))
    leaves = written(parts[0].union(parts[1]), "leaves")
    leaf_terms = _leaf_counts(leaves.select("terms", "leaf"), vocabulary)
    known = labels.where(F.col("subject").isin(subjects)).select("doc_id", "subject").distinct()
    known = known.withColumn("weight", 1 / F.count("*").over(_by_doc()))
    labelled = leaves.join(F.broadcast(known) if known.count() <= BROADCAST_ROWS else known, "doc_id")
    by_leaf = np.zeros((LEAVES, len(subjects) + 1))
    for r in labelled.groupBy("leaf", "subject").agg(F.sum("weight").alias("w")).collect():  # LEAVES x subjects at most
        by_leaf[r["leaf"], subjects.index(r["subject"])] = r["w"]
    in_leaf = np.zeros(LEAVES)
    for r in leaves.groupBy("leaf").count().collect():  # LEAVES at most
        in_leaf[r["leaf"]] = r["count"]
    # labels go to documents about something: a leaf with far fewer of them than others is about nothing, as far as they are missing
    observed = by_leaf.sum(axis=1)
    usual = observed.sum() / max(in_leaf.sum(), 1) * in_leaf
    by_leaf[:, -1] = np.where(usual >= LEAST_USUAL, np.maximum(0, MISSING_LABELS * usual - observed), 0)
    # a description counts as some labelled documents, in the leaves in which its terms occur
    place = {t: i for i, t in enumerate(vocabulary)}
    for i, subject in enumerate(subjects):
        own = leaf_terms[:, [place[t] for t in set(descriptions.get(subject, [])) if t in place]]
        if own.sum():
            by_leaf[:, i] += DESCRIPTION * (own / np.maximum(own.sum(axis=0), 1e-9)).mean(axis=1)
    mixture = _leaf_subjects(leaf_terms, by_leaf) ** 2  # a leaf speaks for its main subject
    mixture /= mixture.sum(axis=1, keepdims=True) + 1e-9
    use = np.flatnonzero(discriminative(mixture.T @ leaf_terms).any(axis=1))
    rates = leaf_terms[:, use] + 0.01
    return leaves, LeafModel([vocabulary[i] for i in use], rates / rates.sum(axis=1, keepdims=True) if len(use) else rates, mixture)


def _by_doc():
    from pyspark.sql import Window

    return Window.partitionBy("doc_id")


def discriminative(own: np.ndarray) -> np.ndarray:
    """Terms x subjects: 1 where the term is discriminative for the subject, of occurrences subjects x terms."""
    rate = (own + own.sum(axis=0) / max(own.sum(), 1e-9)) / (own.sum(axis=1, keepdims=True) + 1)
    part = (rate / (rate.sum(axis=0) + 1e-12)).T
    return np.where((part == part.max(axis=1, keepdims=True)) & (part >= PURITY), 1.0, 0.0)


def leaf_mixture(doc: np.ndarray, term: np.ndarray, count: np.ndarray, rates: np.ndarray, n: int) -> np.ndarray:
    """Weights of the leaves in each of n documents, of term counts in the order of documents: expectation and maximisation from equal weights on."""
    weight = np.full((n, len(rates)), 1 / len(rates), np.float32)
    if not len(doc):
        return weight
    start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    likely, total = rates[:, term].T.astype(np.float32), np.add.reduceat(count, start)[:, None]
    for _ in range(STEPS):
        part = likely * weight[doc]
        part *= (count / (part.sum(axis=1) + 1e-30))[:, None]
        weight[doc[start]] = np.add.reduceat(part, start, axis=0) / total
    return weight


def mixtures(leaves: DataFrame, model: LeafModel, subjects: list[str]) -> DataFrame:
    """(doc_id, subject, share, n_occurrences) of the subjects in each document (doc_id, terms, leaf) that has enough discriminative terms; the leaves of its script are mixed."""
    doc_type, per_script = dict(leaves.dtypes)["doc_id"], LEAVES // SCRIPTS

    def kernel(batch: pa.RecordBatch) -> dict | None:
        lists = batch.column("terms")
        size, script = np.asarray(pc.list_value_length(lists)), np.asarray(batch.column("leaf")) // per_script
        index = pc.index_in(lists.flatten(), value_set=pa.array(model.terms, pa.string()))
        key = np.repeat(np.arange(len(size)), size)[np.asarray(index.is_valid())] * max(1, len(model.terms)) + np.asarray(index.drop_null())
        key, count = np.unique(key, return_counts=True)
        doc, term = key // max(1, len(model.terms)), key % max(1, len(model.terms))
        total = np.bincount(doc, weights=count, minlength=len(size))
        share = np.zeros((len(size), len(subjects) + 1), np.float32)
        for at in range(SCRIPTS):
            own = slice(at * per_script, (at + 1) * per_script)
            for first in range(0, len(size), MIXED):
                use = np.flatnonzero((doc >= first) & (doc < first + MIXED) & (script[doc] == at))
                weight = leaf_mixture(doc[use] - first, term[use], count[use].astype(np.float32), model.rates[own], min(MIXED, len(size) - first))
                rows = np.unique(doc[use])
                share[rows] = weight[rows - first] @ model.subjects[own]
        share[(total < LEAST_OCCURRENCES) | (total < LEAST_DENSITY * size)] = 0
        row, subject = np.nonzero(share[:, :-1] >= LARGE_PART)
        if not len(row):
            return None
        found = share[row, subject]
        return {"doc_id": batch.column("doc_id").take(pa.array(row)), "subject": [subjects[i] for i in subject], "share": found.astype(np.float64), "n_occurrences": np.rint(found * total[row]).astype(np.int64)}

    return arrow_map(leaves, None, f"doc_id {doc_type}, subject string, share double, n_occurrences long", kernel)


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, subject, share) of one or two subjects of each document that is about any.

    Null and blank texts, documents without an id, and texts with hardly any discriminative term have no subject. Labels of unknown
    documents or subjects are ignored, repeated labels count once; without subjects nothing is assigned. subjects has
    (subject, description); a null description says nothing.
    """
    areas = subjects.select("subject", "description" if "description" in subjects.columns else F.lit(None).cast("string").alias("description")).where("subject is not null")
    said: dict[str, list[str]] = {}
    for r in areas.distinct().collect():  # a row per subject
        said.setdefault(r["subject"], []).extend(_TERM.findall(canonical(r["description"] or "").lower()))
    names = sorted(said)
    leaves, model = leaf_model(written(terms_of(docs, doc_id, text), "terms"), labels, names, said)
    ranked = mixtures(leaves, model, names).withColumn("rank", F.row_number().over(_by_doc().orderBy(F.desc("share"), "subject")))
    return ranked.where(f"rank = 1 or rank = 2 and n_occurrences >= {SECOND_OCCURRENCES}").select("doc_id", "subject", "share")


def p9_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_label"), table(spark, sf_dir, "subject_area"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_subjects(spark, sf_dir).select("doc_id", "subject").distinct()


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each subject per source, a document of two subjects counting half for each."""
    found = p9_subjects(spark, sf_dir)
    part = found.withColumn("part", F.col("share") / F.sum("share").over(_by_doc()))
    rows = part.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return rows.groupBy("source", "subject").agg(F.countDistinct("doc_id").alias("n_docs"), F.sum("part").alias("size"))
