"""Quality classifier: a naive Bayes support vector machine.

Indicators of n-grams are scaled by the log ratio of their counts in the two classes; a linear
hinge-loss model on them is fitted by dual coordinate descent. Margins become scores by a
logistic curve, fitted on rows that the models it judges have not seen.

n-grams: words in lower case, and runs of one to three word shapes (letters as a or A, digits as
0, runs as one sign, other signs kept); a word or a line that repeats the one before it or an
earlier line has a shape of its own. Shape n-grams also count by how much of the text they fill.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import CACHE, forget_others, remembered, written

DIMENSIONS = 1 << 18
TRAIN_ROWS = 12_000  # labelled rows that the fit takes, chosen by a hash of doc_id
PARTS = 4  # of the training rows; each gives a model of its own, which are averaged
EPOCHS = 12
COST = 1.0
THRESHOLD = 0.7
LONGEST_REMEMBERED = 64  # characters of a word; longer ones are hashed anew each time


def _shape(word: str) -> str:
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", kinds)


class _Words(dict):
    """Word -> hash of the word in lower case, and above it the hash of its shape."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        crc = lambda s: zlib.crc32(s.encode("utf-8", "surrogatepass"))
        value = (crc(_shape(word)) & 0x3FFFFFFF) << 32 | crc(word.lower())
        if len(word) <= LONGEST_REMEMBERED:
            self[word] = value
        return value


_WORDS = remembered(_Words())
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray) -> np.ndarray:
    """Hash keys to places below DIMENSIONS."""
    return ((keys * _MIX) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Sorted places of the indicators that are on; none for a null or wordless text."""
    words = (text or "").split()
    if not words:
        return np.empty(0, dtype=np.int64)
    packed = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    low = packed & np.uint64(0xFFFFFFFF)
    shape = packed >> np.uint64(32)
    shape[1:][low[1:] == low[:-1]] = 1  # the word before again
    lines = [x for x in text.split("\n") if x.strip()]
    again = len(lines) - len(set(lines))
    grams, shares = [], []
    key = shape
    for n in (1, 2, 3):
        found, times = np.unique(key, return_counts=True)
        grams.append(found * np.uint64(8) + np.uint64(n))
        shares.append(times / len(key))
        if len(shape) <= n:
            break
        key = (key[:-1] * np.uint64(1_000_003)) ^ shape[n:]
    grams.append(np.array([7], dtype=np.uint64))
    shares.append(np.array([again / max(len(lines), 1)]))
    gram, share = np.concatenate(grams), np.concatenate(shares)
    band = np.clip(-np.log2(np.maximum(share, 1e-9)), 0, 6).astype(np.uint64)
    return np.unique(np.concatenate([
        _places(np.unique(low) << np.uint64(1)), _places(gram * np.uint64(2) + np.uint64(1)),
        _places((gram * np.uint64(16) + band) * np.uint64(4) + np.uint64(3))]))


@dataclass
class Model:
    weights: np.ndarray  # of the scaled indicators, times their ratios; the last one is the bias
    ratios: np.ndarray
    slope: float
    shift: float

    def margin(self, on: np.ndarray) -> float:
        return margin(self.weights, self.ratios, on)

    def score(self, text: str | None) -> float:
        at = np.clip(self.slope * self.margin(features(text)) + self.shift, -500, 500)
        return float(1 / (1 + np.exp(-at)))


def scaled(ratios: np.ndarray, on: np.ndarray) -> np.ndarray:
    x = ratios[on]
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def margin(weights: np.ndarray, ratios: np.ndarray, on: np.ndarray) -> float:
    return float(weights[on] @ scaled(ratios, on) + weights[-1])


def descend(rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, cost: float = COST,
            epochs: int = EPOCHS) -> np.ndarray:
    """Dual coordinate descent for the hinge loss with a bias; the same rows give the same weights."""
    weights = np.zeros(len(ratios) + 1)
    alpha = np.zeros(len(rows))
    values = [scaled(ratios, on) for on in rows]
    square = np.array([v @ v + 1 for v in values])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            on, x, y = rows[i], values[i], signs[i]
            gradient = y * (weights[on] @ x + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if step := (new - alpha[i]) * y:
                weights[on] += step * x
                weights[-1] += step
                alpha[i] = new
    return weights


def curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton's method."""
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.array([1.0, 0.0])
    good, bad = labels.sum(), len(labels) - labels.sum()
    aim = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (aim - p))
        theta = theta + np.clip(step, -5, 5)
    return max(float(theta[0]), 1e-6), float(theta[1])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """A model of the labelled rows that are not held out, `rows` of them at most.

    Null labels, ids and labels without a document are left out; of several texts with one id the
    least is taken. Without rows of both classes
    every score is the share of good rows (one half without any).
    """
    spark = docs.sparkSession
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .dropDuplicates(["doc_id"])
        .orderBy(F.md5(F.col("doc_id").cast("string"))).limit(rows)
    )

    def on(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                # not by the bits that hold rows out
                [pa.array([(zlib.crc32(str(d).encode()) >> 2) % PARTS for d in batch.column(0).to_pylist()], pa.int32()),
                 batch.column(2),
                 pa.array([features(t).astype("<i4").tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
                names=["part", "label", "places"])

    train = written(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `rows` ids
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
        .mapInArrow(on, "part int, label int, places binary"), "classifier-rows")

    def counted(batches):
        counts = np.zeros((2, DIMENSIONS), dtype=np.int64)
        for frame in batches:
            for kind, places in zip(frame["label"], frame["places"], strict=True):
                counts[kind, np.frombuffer(places, "<i4")] += 1
        used = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"place": used, "bad": counts[0, used], "good": counts[1, used]})

    counts = (train.mapInPandas(counted, "place bigint, bad bigint, good bigint")
              .groupBy("place").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))).toPandas()
    kinds = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        share = sum(k * n for k, n in kinds.items()) / max(sum(kinds.values()), 1) if kinds else 0.5
        return Model(np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS), 1e-6,
                     float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    good, bad = np.ones(DIMENSIONS), np.ones(DIMENSIONS)
    good[counts["place"]] += counts["good"]
    bad[counts["place"]] += counts["bad"]
    ratios = np.log((good / (kinds[1] + 2)) / (bad / (kinds[0] + 2)))
    ratios[(good + bad) <= 4] = 0  # seen in two documents or fewer
    shared = spark.sparkContext.broadcast(ratios)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["places", "label"])
        where = [np.frombuffer(p, "<i4") for p in frame["places"]]
        weights = descend(where, np.where(frame["label"] == 1, 1.0, -1.0), shared.value)
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "weights": [weights.astype("<f4").tobytes()]})

    models = {r["part"]: np.frombuffer(r["weights"], "<f4").astype(float) for r in
              train.groupBy("part").applyInPandas(one, "part int, weights binary").collect()}
    weights = sum(models.values()) / len(models)
    others = {p: (weights * len(models) - m) / max(len(models) - 1, 1) for p, m in models.items()}
    unseen = spark.sparkContext.broadcast({p: m.astype("<f4") for p, m in others.items()})

    def judged(batches):
        for frame in batches:
            yield pd.DataFrame({"label": frame["label"], "margin": [
                margin(unseen.value[part], shared.value, np.frombuffer(places, "<i4"))
                for part, places in zip(frame["part"], frame["places"], strict=True)]})

    seen = train.mapInPandas(judged, "label int, margin double").toPandas()  # at most `rows` rows
    return Model(weights, ratios, *curve(seen["margin"].to_numpy(), seen["label"].to_numpy()))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with held_out, score (0 to 1) and predicted (1 from `threshold` on) of every whole text.

    A null, empty or wordless text gets the score of the bias alone; a null id is not held out;
    repeated rows score alike; columns that are named like the results give way to them.
    """
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    at = kept.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        forget_others(_WORDS)
        for batch in batches:
            values = [shared.value.score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())],
                                             names=[*batch.schema.names, "score"])

    schema = docs.select(*kept).schema.add("score", "double")
    return (docs.select(*kept).mapInArrow(score, schema)
            .withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return scored(docs, fit(docs, labels, **options))
