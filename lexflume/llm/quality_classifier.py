"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Three streams of features come from a text's words: word unigrams and bigrams, shapes of words with their bigrams
(letters by case, digits, marks; whether the word repeats the one before), each hashed into the same table. A text's
value at a feature is the feature's share of its stream, so a score is a bias and a sparse dot product, the mean weight
of the stream's n-grams. Weights are learned by FTRL-proximal (McMahan et al., 2013).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.llm.common import held_out, mix64, table

BITS = 18
#: The labelled rows that a model is fitted on: those with the smallest hashes of their ids, at most this many.
SAMPLE = 8192
EPOCHS, ALPHA, BETA, L1, L2, SCALE = 3, 0.3, 1.0, 0.002, 0.5, 8.0
THRESHOLD = 0.3
FOLDS, HELD = 5, 0

_RUNS = re.compile(r"(.)\1+")


def _hash(b: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b)


class Words(dict):
    """Hashes of words and of their shapes, made once per word. Emptied when it has grown beyond its bound."""

    MOST = 1_000_000

    def __missing__(self, w: bytes) -> tuple[int, int]:
        s = w.decode("utf-8", "replace")
        shape = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in s)
        v = self[w] = (_hash(w.lower()), _hash(_RUNS.sub(r"\1", shape).encode()))
        return v


def streams(text: str | None, cache: Words) -> list[np.ndarray]:
    """Indexes of the features of each stream; no stream for a text without words."""
    words = (text or "").encode("utf-8", "replace").split()
    if not words:
        return []
    if len(cache) > cache.MOST:
        cache.clear()
    both = np.array([cache[w] for w in words], dtype=np.uint64)
    word, shape = both[:, 0], both[:, 1]
    with np.errstate(over="ignore"):
        same = np.concatenate([[False], word[1:] == word[:-1]])
        shape = shape + same.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out = [word, word[:-1] * np.uint64(31) + word[1:] + np.uint64(1), shape + np.uint64(2), shape[:-1] * np.uint64(31) + shape[1:] + np.uint64(3)]
    return [(mix64(x) >> np.uint64(64 - BITS)).astype(np.int64) for x in out if len(x)]


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int = BITS) -> np.ndarray:
    """Weights, the last of them the bias, from (indexes, values, label) in the given order."""
    n, z, g2 = 1 << bits, np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    weight = lambda i: np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(g2[i])) / ALPHA + L2))
    for _ in range(EPOCHS):
        for idx, val, y in rows:
            i, x = np.append(idx, n), np.append(val, 1.0)
            w = weight(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(g2[i] + g * g) - np.sqrt(g2[i])) / ALPHA
            z[i] += g - sigma * w
            g2[i] += g * g
    return weight(np.arange(n + 1)).astype(np.float32)


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = Words()
    for b in batches:
        out = []
        for doc_id, text, y in zip(b["doc_id"], b["text"], b["quality"], strict=True):
            s = streams(text, cache)
            idx, at = np.unique(np.concatenate(s), return_inverse=True) if s else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            val = np.bincount(at, np.concatenate([np.full(len(x), SCALE / len(x)) for x in s])) if s else np.zeros(0)
            out.append((doc_id, float(y), idx.astype("<i4").tobytes(), val.astype("<f4").tobytes()))
        yield pd.DataFrame(out, columns=["doc_id", "y", "idx", "val"])


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = {r.doc_id: (np.frombuffer(r.idx, "<i4").astype(np.int64), np.frombuffer(r.val, "<f4").astype(float), r.y) for b in batches for r in b.itertuples()}
    order = sorted(rows, key=lambda k: int(mix64(np.array([k], dtype=np.int64).view(np.uint64))[0]))
    yield pd.DataFrame({"w": [train([rows[k] for k in order]).tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """Weights from the labelled rows outside the held-out fold, at most `most` of them.

    Ids are never inputs; they choose the fold, the sample and the order. Null labels, and ids with labels that
    contradict each other, are left out. Without labels all weights are 0.
    """
    some = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"), FOLDS, HELD))
    some = some.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_q")).where("quality = _q").drop("_q")
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # at most `most` ids and labels are sent to every task
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(some), "doc_id").select("doc_id", "text", "quality")
    coded = rows.mapInPandas(_encode, "doc_id long, y double, idx binary, val binary")
    got = coded.repartition(1).mapInPandas(_fit, "w binary").collect()
    return np.frombuffer(got[0][0], np.float32) if got else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs (doc_id, text); a text without words scores by the bias."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, cache = sent.value, Words()
        for b in batches:
            z = np.array([float(w[-1]) + SCALE * sum(float(w[x].mean()) for x in streams(t if isinstance(t, str) else None, cache)) for t in b["text"]])
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))})

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
