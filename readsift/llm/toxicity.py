"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

Trained on a sample of at most SAMPLE labelled documents. The distinct texts of each label are dealt out in turn, so that
copies stay together and each part has both labels: the lexicon (words and word beginnings that mark toxic texts), the trees, or the calibration.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window as W, functions as F

from readsift.llm.storage import stored
from readsift.llm.vectors import releasing

SAMPLE = 20_000  # labelled documents that training reads at most; one is in by the order of a hash of its id
TURNS = ["trees", "calibration", "lexicon", "trees", "lexicon", "trees", "lexicon", "calibration", "trees", "lexicon"]  # parts that the distinct texts of a label serve in turn
LEXICON = 5_000  # entries that the lexicon holds at most, most frequent first
NEAR = 6  # words between a lexicon word and a word that addresses the reader
STEMS = (4, 5, 6)
FEATURES = 12
KNOWN = 60_000  # words whose codes a task remembers

#: Words that address the reader, in four languages (fixed values).
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te ti tus tuyo usted ustedes vos vosotros toi ton ta tes vous votre vos".split())
#: Letters that stand for others in disguised words (fixed values).
DISGUISE = str.maketrans("013457@$!", "oieastasi")
EDGES = ".,;:!?\"'()[]{}<>«»„“”-_*"


def entries(text: str) -> set:
    """Words of a text and their beginnings (marked by a star), as the lexicon lists them."""
    out = set()
    for word in {w.strip(EDGES) for w in text.lower().split()}:
        if len(word) > 2:
            out.add(word)
            out.update(word[:n] + "*" for n in STEMS if len(word) >= n)
    return out


class Words(dict):
    """Code of a raw word: 1, 2 lexicon tier; 4 addresses the reader; 8 capitals; 16 disguised; 32 lexicon word in disguise."""

    def __init__(self, lexicon: dict):
        self.lexicon = lexicon

    def tier(self, word: str) -> int:
        found = self.lexicon.get(word, 0)
        for n in STEMS:
            if len(word) >= n:
                found = max(found, self.lexicon.get(word[:n] + "*", 0))
        return found

    def __missing__(self, raw: str) -> int:
        word = raw.strip(EDGES)
        low = word.lower()
        code = self.tier(low) | 4 * (low in SECOND_PERSON) | 8 * (len(word) > 2 and word.isupper())
        letters = sum(c.isalpha() for c in low)
        if 0 < letters < len(low):
            plain = "".join(c for c in low.translate(DISGUISE) if c.isalpha())
            code |= 16 | (32 | self.tier(plain) if self.tier(plain) and not code & 3 else 0)
        if len(self) < KNOWN:
            self[raw] = code
        return code


def features(text: str, words: Words) -> list:
    """Dense features of a text; an empty one has zeros."""
    raw = text.split()
    if not raw:
        return [0.0] * FEATURES
    codes = np.fromiter(map(words.__getitem__, raw), np.int64, len(raw))
    n = len(raw)
    strong, weak = (codes & 3) == 2, (codes & 3) == 1
    hits = np.flatnonzero(strong | weak)
    you = np.flatnonzero(codes & 4)
    near = 0
    if len(hits) and len(you):
        right = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(you[np.minimum(right, len(you) - 1)] - hits), np.abs(hits - you[np.maximum(right - 1, 0)]))
        near = int((gap <= NEAR).sum())
    marks = text.count("!") + text.count("?")
    stops = text.count(".") + text.count(",") + text.count(";")
    return [
        strong.sum() / n, math.log1p(strong.sum()), weak.sum() / n, math.log1p(weak.sum()), near / n, math.log1p(near),
        len(you) / n, (codes & 8 > 0).sum() / n, marks / n, stops / n, (codes & 16 > 0).sum() / n, (codes & 32 > 0).sum() / n,
    ]


def with_features(texts: DataFrame, lexicon: dict) -> DataFrame:
    """Adds `features` (array<double>)."""
    keep = texts.columns
    schema = texts.select(*keep, F.array(F.lit(0.0)).alias("features")).schema

    def run(batches):
        words = Words(lexicon)
        for batch in batches:
            rows = [features(t or "", words) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "features"])

    return texts.mapInArrow(releasing(run), schema)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic, part) of at most `most` labelled training documents.

    A document with labels of both kinds is toxic; of several texts with one doc_id the least counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # bounded by `most` rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(stored(picked, "labelled")), "doc_id")
    rows = stored(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("doc_id"), "sample-texts")
    # windows over at most `most` digests
    digests = rows.groupBy(F.sha2("text", 256).alias("digest")).agg(F.max("toxic").alias("label"))
    turn = (F.row_number().over(W.partitionBy("label").orderBy("digest")) - 1) % len(TURNS)
    dealt = digests.select("digest", F.element_at(F.array(*map(F.lit, TURNS)), turn + 1).alias("part"))
    return stored(rows.withColumn("digest", F.sha2("text", 256)).join(F.broadcast(dealt), "digest").drop("digest"), "sample")


def learn_lexicon(rows: DataFrame) -> dict:
    """entry -> tier (2: nine of ten distinct texts that have it are toxic, after weighing the classes; 1: two of three)."""

    def split(batches):
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                own = sorted(entries(text))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([toxic] * len(own), pa.int32())], names=["entry", "toxic"])

    distinct = rows.dropDuplicates(["text"])
    sizes = dict(distinct.groupBy("toxic").count().collect())
    good, bad = max(sizes.get(0, 0), 1), max(sizes.get(1, 0), 1)
    least = max(min(5, (bad + 1) // 2), bad // 400)  # of few toxic texts, half
    counted = distinct.select("text", "toxic").mapInArrow(split, "entry string, toxic int").groupBy("entry").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    lift = F.col("bad") / bad / (F.col("bad") / bad + (F.col("good") + 0.5) / good)
    ranked = counted.where(F.col("bad") >= least).withColumn("lift", lift).where("lift >= 0.667").orderBy(F.desc("bad"), "entry").limit(LEXICON)
    return {r.entry: 2 if r.lift >= 0.9 else 1 for r in ranked.collect()}


class Model:
    """A lexicon, trees, and their calibration; without both labels a constant."""

    def __init__(self, rows: DataFrame):
        sizes = {(r.part, r.toxic): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
        by_label = [sum(n for (_, t), n in sizes.items() if t == label) for label in (0, 1)]
        self.constant = None if all(by_label) else float(bool(by_label[1]))
        if self.constant is not None:
            return
        # a label with a single text can't serve several parts: all rows do
        apart = all(sizes.get((part, toxic)) for part in ("trees", "calibration") for toxic in (0, 1))
        of = lambda df, part: df.where(F.col("part") == part) if apart else df
        self.lexicon = learn_lexicon(of(rows, "lexicon"))
        rest = rows.where("part <> 'lexicon'") if apart else rows
        dense = stored(with_features(rest, self.lexicon).drop("text"), "features").withColumn("vector", array_to_vector("features"))
        trees = GBTClassifier(featuresCol="vector", labelCol="toxic", predictionCol="side", maxIter=12, maxDepth=3, stepSize=0.3, seed=7)
        self.trees = trees.fit(of(dense, "trees"))
        ranked = self.raw(of(dense, "calibration")).select("raw", F.col("toxic").cast("double").alias("label"))
        self.calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(ranked)

    def raw(self, dense: DataFrame) -> DataFrame:
        return self.trees.transform(dense).withColumn("raw", vector_to_array("probability")[1])

    def score(self, texts: DataFrame) -> DataFrame:
        """Adds `score`."""
        if self.constant is not None:
            return texts.withColumn("score", F.lit(float(self.constant)))
        dense = with_features(texts, self.lexicon).withColumn("vector", array_to_vector("features"))
        scored = self.calibration.transform(self.raw(dense))
        return scored.select(*texts.columns, F.col("prediction").cast("double").alias("score"))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    return Model(sample(docs, labels, most))


def toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row; held_out rows (crc32 of the id as text mod 5 = 0) are never learned from.

    Null text is empty and scored like any other; a null doc_id is not held out and not labelled. Repeated
    rows get equal scores. Training takes the least text of a repeated doc_id, and a doc_id with both labels as toxic. If the
    sample lacks a label of one kind, every score is 1 (toxic ones only) or 0. Other columns, also of the labels, are ignored.
    """
    model = train(docs, labels, most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scored = model.score(texts)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
