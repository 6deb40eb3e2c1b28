"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

From a bounded sample of labelled rows (``SAMPLE`` of each class, picked by a hash of the id) a lexicon is counted
in Spark: words that stand in many toxic and few clean rows, ``LEXICON`` of them at most. Each text then has the
features of ``FEATURES``: how dense lexicon words are and how many differ, as written and after undoing common
disguises, how near they are to words of address, capitals, marks, repeats and disguise rates. Spark's GBTClassifier
learns on part of the sample, its IsotonicRegression maps margins to probabilities on the rest.

A null or empty text has zero features and is scored like any other. Labels of one id are joined by their maximum;
labels of ids without a document, or null labels, teach nothing. With no toxic or no clean labelled row, every score
is the share of toxic ones (0 without labels). Texts are read whole. Repeated rows each give their row, an
empty table an empty result. Only ids and texts (and ``toxic`` of the labels) are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, table
from tempolith.llm.registry import query

#: Labelled rows of each class that are learned from, at most; words of the lexicon, at most.
SAMPLE, LEXICON = 8000, 256
#: A lexicon word stands in at least this share of toxic rows, and this many times as often as in clean ones.
LEAST, ODDS = 0.01, 20.0
TREES, DEPTH, STEP = 15, 4, 0.2
CALIBRATION = 4  # every fourth sampled row calibrates

# Words of address (second person) of the languages at hand.
ADDRESS = {"you", "your", "yours", "yourself", "ur", "u", "ya", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te", "ton", "ta", "tes", "vous",
           "votre", "vos", "usted", "ustedes", "ti", "tus", "vosotros"}
# Marks that stand in for letters.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "_": None, "-": None, ".": None})
FEATURES = ["hits", "hit_share", "distinct_hits", "hidden_hits", "hidden_share", "near_address", "address_share", "capital_share", "capital_words", "mark_share",
            "shout_share", "digit_share", "mixed_words", "repeats", "log_words"]

_EDGE = "!.,?;:'\"*#$%&()[]{}<>~_-+=|/\\"
_MIXED = re.compile(r"[^\W\d_]+[\d@$!*]+[^\W\d_]+")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
#: Words of this distance or less from a lexicon word count as near.
NEAR = 5


def tokens(text: str) -> list[str]:
    return [t for t in (w.strip(_EDGE) for w in text.lower().split()) if t]


def features(text: str | None, lexicon: frozenset[str]) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    words = tokens(text)
    n = max(1, len(words))
    places = [k for k, w in enumerate(words) if w in lexicon]
    address = [k for k, w in enumerate(words) if w in ADDRESS]
    odd = {w for w in set(words) if not w.isalpha()}
    undone = {w: w.translate(DISGUISE) for w in odd}
    hidden = sum(w in odd and undone[w] in lexicon and w not in lexicon for w in words) if odd else 0
    near = 0
    if places and address:
        at = np.array(address)
        spot = np.searchsorted(at, places)
        gap = np.minimum(np.abs(at[np.minimum(spot, len(at) - 1)] - places), np.abs(at[np.maximum(spot - 1, 0)] - places))
        near = int((gap <= NEAR).sum())
    codes = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(1, len(text))
    capitals = int(codes[65:91].sum())
    marks = int(codes[33:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum())
    upper = sum(len(w) > 1 and w.isupper() for w in text.split())
    return [float(len(places)), 100 * len(places) / n, float(len({words[k] for k in places})), float(hidden), 100 * hidden / n, float(near), 100 * len(address) / n,
            capitals / size, upper / n, marks / size, int(codes[33] + codes[63]) / size, int(codes[48:58].sum()) / size,
            sum(1 for w in odd if _MIXED.search(w)) / n, len(_REPEAT.findall(text)) / n if _REPEAT.search(text) else 0.0, float(np.log1p(len(words)))]


def _sample(labels: DataFrame) -> DataFrame:
    """SAMPLE ids of each class in hash order, with their label."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    parts = [rows.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def learn_lexicon(sample: DataFrame) -> frozenset[str]:
    """Words of toxic rows, by their odds, from rows (doc_id, text, toxic); counted in Spark, LEXICON words come back."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = [sorted({w for w in tokens(t or "") if w.isalpha() and len(w) > 1}) for t in f["text"]]
            if any(sets):
                yield pd.DataFrame({"word": [w for s in sets for w in s], "toxic": np.repeat(f["toxic"].to_numpy(), [len(s) for s in sets])})

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return frozenset()
    words = sample.select("text", "toxic").mapInPandas(work, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    ratio = ((F.col("t") + 0.5) / (n[1] + 1)) / ((F.col("c") + 0.5) / (n[0] + 1))
    best = words.filter(F.col("t") >= max(3, LEAST * n[1])).withColumn("ratio", ratio).filter(F.col("ratio") >= ODDS)
    return frozenset(r["word"] for r in best.orderBy(F.col("t").desc(), "word").limit(LEXICON).collect())


def featured(rows: DataFrame, lexicon: frozenset[str], *keep: str) -> DataFrame:
    """The kept columns and ``features``, a vector, for rows with a ``text``."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            values = np.array([features(t, lexicon) for t in f["text"]], float).reshape(len(f), len(FEATURES))
            yield pd.concat([f[list(keep)].reset_index(drop=True), pd.DataFrame(values, columns=FEATURES)], axis=1)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    made = rows.select(*keep, "text").mapInPandas(work, kinds + ", " + ", ".join(f"{c} double" for c in FEATURES))
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(made).select(*keep, "features")


class Scorer:
    """Lexicon, trees and calibration; ``score`` gives rows their score."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        """docs: (doc_id, text); labels: (doc_id, toxic), the rows that may be learned from."""
        stage = Scratch(docs.sparkSession, "toxicity")
        # the sampled ids are bounded by SAMPLE, so the documents need not move
        sample = docs.select("doc_id", "text").join(F.broadcast(_sample(labels.select("doc_id", "toxic"))), "doc_id").select("doc_id", "text", "toxic")
        sample = stage.keep(sample, "sample")
        n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.constant = None
        self.lexicon = frozenset()
        if not n.get(0) or not n.get(1):
            self.constant = float(bool(n.get(1)))
            return
        self.lexicon = learn_lexicon(sample)
        rows = stage.keep(featured(sample, self.lexicon, "doc_id", "toxic").coalesce(4), "features")
        turn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibrate")), F.lit(CALIBRATION)) == 0
        fit, rest = rows.filter(~turn), rows.filter(turn)
        if fit.select("toxic").distinct().count() < 2 or rest.select("toxic").distinct().count() < 2:
            fit = rest = rows  # too few rows to hold some back
        fit = fit.coalesce(2).persist()
        trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, minInstancesPerNode=3, cacheNodeIds=False)
        self.trees = trees.fit(fit)
        fit.unpersist()
        self.curve = IsotonicRegression(labelCol="toxic", featuresCol="margin").fit(self._margins(rest).coalesce(1))
        stage.drop()

    def _margins(self, rows: DataFrame) -> DataFrame:
        made = self.trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])
        return made.drop("rawPrediction", "probability", "prediction")

    def score(self, rows: DataFrame, *keep: str) -> DataFrame:
        if self.constant is not None:
            return rows.select(*keep, F.lit(self.constant).alias("score"))
        made = self.curve.transform(self._margins(featured(rows, self.lexicon, *keep)))
        # isotonic steps are flat; the margin orders rows within a step without leaving it
        return made.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction") * 0.98 + 0.02 / (1 + F.exp(-F.col("margin"))))).alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    scored = Scorer(docs, labels).score(docs, "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
