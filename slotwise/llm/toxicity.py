"""Operator 3: toxicity by a linear classifier on character n-grams with naive Bayes scaling.

Features are the character n-grams (3 to 5, lower case, blanks included) that occur in a text,
hashed to 2^20 buckets. Spark counts in how many labelled texts of either class each bucket
occurs; the log-count ratio of the classes scales the feature, and a logistic regression on the
scaled features is trained with Spark ML. Buckets enter if their class difference is significant
(G2 statistic), at most ``features`` of them.

Bound: the classifier is fitted on about ``sample`` labelled rows, drawn by a hash of doc_id; all
labelled rows if there are fewer. Scores cover whole texts of all documents in a map without shuffle.

Defined results: a null text is an empty one and gets the score of a text without any selected
feature; a document with contrary labels counts as toxic; null labels are no labels; without labels
of both classes (an empty table) every score is the smoothed share of toxic labels; rows with a null
id are scored and never learnt from; repeated rows get equal scores; only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, map_batches, pieces

BITS = 20
SIZES = (3, 4, 5)
#: Odd constants of the polynomial hash and its final mix.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    bias: float
    buckets: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))


def grams(texts: list[str]):
    """Pairs (index of the text, bucket) of all n-grams, an array pair per n-gram size."""
    framed = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    points[(points >= 9) & (points <= 13)] = 32
    of = np.repeat(np.arange(len(framed), dtype=np.int32), [len(t) for t in framed])
    h = points
    for k in range(1, max(SIZES)):
        h = h[:-1] * BASE + points[k:]
        if k + 1 in SIZES:
            same = of[:len(h)] == of[k:]
            yield of[:len(h)][same], ((h[same] * MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def present(texts: list[str], chosen: np.ndarray | None = None):
    """Distinct (text, bucket) pairs, of the chosen buckets if given; sorted."""
    found = []
    for of, bucket in grams(texts):
        if chosen is not None:
            keep = chosen[bucket]
            of, bucket = of[keep], bucket[keep]
        found.append((of.astype(np.int64) << BITS) | bucket)
    keys = np.concatenate(found) if found else np.empty(0, np.int64)
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return keys >> BITS, keys & ((1 << BITS) - 1)


def mask_of(buckets: np.ndarray) -> np.ndarray:
    chosen = np.zeros(1 << BITS, bool)
    chosen[buckets] = True
    return chosen


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return batch.column("_text").fill_null("").to_pylist()


def labelled(docs: DataFrame, labels: DataFrame, sample: int, doc_id: str = "doc_id", text: str = "text",
             label: str = "toxic", learn: Column | None = None) -> DataFrame:
    """Texts of about ``sample`` labelled documents that may be learnt from, with their label y."""
    own = labels.select(F.col(doc_id).alias("_doc"), F.col(label).alias("_y")).dropna()
    own = own.where(~held_out("_doc") if learn is None else learn).groupBy("_doc").agg(F.max("_y").cast("int").alias("y"))
    share = min(1.0, sample / max(1, own.count()))
    own = own.where(F.pmod(F.xxhash64("_doc", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # About ``sample`` rows of 12 bytes whatever the input: bounded, so it may be broadcast.
    return docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(own), "_doc").select("_text", "y")


def train(rows: DataFrame, features: int = 4096, least_g2: float = 12.0) -> Model:
    """Fit the classifier on rows (_text, y)."""

    def count(batches):
        n, docs = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for part in pieces(batch, "_text", 1_500_000):
                y = np.asarray(part.column("y"))
                of, bucket = present(texts_of(part))
                docs += np.bincount(y, minlength=2)[:2]
                for k in (0, 1):
                    n[k] += np.bincount(bucket[y[of] == k], minlength=1 << BITS)
        seen = np.flatnonzero(n.any(0))
        cells = np.concatenate([[-1], seen]), np.concatenate([docs[:1], n[0][seen]]), np.concatenate([docs[1:], n[1][seen]])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["bucket", "n0", "n1"])

    counts = durable(rows.mapInArrow(count, "bucket bigint, n0 bigint, n1 bigint").groupBy("bucket").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    t = counts.where("bucket = -1").first()
    docs0, docs1 = (t.n0, t.n1) if t else (0, 0)
    prior = math.log((docs1 + 1) / (docs0 + 1))
    if not docs0 or not docs1:
        return Model(prior)
    real = counts.where("bucket >= 0")
    s0, s1 = real.agg(F.sum(F.col("n0") + 1), F.sum(F.col("n1") + 1)).first()
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    both = F.col("n0") + F.col("n1")
    cells = [(F.col("n0"), both, docs0), (F.col("n1"), both, docs1), (docs0 - F.col("n0"), docs0 + docs1 - both, docs0), (docs1 - F.col("n1"), docs0 + docs1 - both, docs1)]
    g2 = 2 * sum((term(o, row * n / (docs0 + docs1)) for o, row, n in cells), F.lit(0.0))
    best = (real.withColumn("g2", g2).where(F.col("g2") >= least_g2)
            .withColumn("r", F.log(((F.col("n1") + 1) / s1) / ((F.col("n0") + 1) / s0)))
            .orderBy(F.desc("g2"), "bucket").limit(features).select("bucket", "r").collect())
    if not best:
        return Model(prior)
    best.sort(key=lambda row: row.bucket)
    buckets = np.array([row.bucket for row in best])
    chosen = mask_of(buckets)

    def features_of(batch):
        out = []
        for part in pieces(batch, "_text", 1_500_000):
            of, bucket = present(texts_of(part), chosen)
            out += np.split(bucket, np.searchsorted(of, np.arange(1, part.num_rows)))
        return pa.RecordBatch.from_arrays(
            [batch.column("y").cast(pa.float64()), pa.array([[str(b) for b in x] for x in out], pa.list_(pa.string()))], names=["label", "found"])

    learnt = durable(map_batches(rows, features_of, "label double, found array<string>"))
    vectors = CountVectorizerModel.from_vocabulary([str(b) for b in buckets], inputCol="found", outputCol="present", minTF=1.0).transform(learnt)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense([row.r for row in best]), inputCol="present", outputCol="features").transform(vectors)
    fit = LogisticRegression(maxIter=100, regParam=0.0005, standardization=False).fit(scaled)
    weights = fit.coefficients.toArray() * np.array([row.r for row in best])
    return Model(float(fit.intercept), buckets, weights)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the ``keep`` columns, ``score`` and ``predicted`` of every document."""
    chosen, bias = mask_of(model.buckets), model.bias
    weight = np.zeros(len(chosen))
    weight[model.buckets] = model.weights

    def run(batch):
        margins = []
        for part in pieces(batch, "_text", 1_500_000):
            of, bucket = present(texts_of(part), chosen)
            margins.append(bias + np.bincount(of, weights=weight[bucket], minlength=part.num_rows))
        s = np.round(1 / (1 + np.exp(-np.concatenate(margins))), 6)
        columns = [batch.column("_text" if n == text else f"c{i}") for i, n in enumerate(names)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*(f"c{i}" for i in range(len(columns))), "score", "predicted"])

    names = [doc_id, *keep]
    kinds = ", ".join(f"c{i} {docs.schema[n].dataType.simpleString()}" for i, n in enumerate(names))
    # A text that is kept goes to the task once, as the scored one.
    sent = docs.select(F.col(text).alias("_text"), *[F.col(n).alias(f"c{i}") for i, n in enumerate(names) if n != text])
    out = map_batches(sent, run, f"{kinds}, score double, predicted int", "_text")
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], "score", "predicted")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 40_000) -> Model:
    return train(labelled(docs, labels, sample))
