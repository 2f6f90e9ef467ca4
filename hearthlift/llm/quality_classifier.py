"""Quality score by supervised subword embeddings.

Words, pairs of neighbouring words and character n-grams are hashed to buckets, each with a learned vector. A
document's vector is the average over all of them; a softmax layer on it gives the class. Vectors and layer
are trained together by stochastic gradient descent in numpy. As averaging and the layer are linear, scoring
needs one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, held_out, map_arrow, mixed, powers, read, text_slices
from hearthlift.llm.language_id import sample_of

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
DIMENSIONS = 16
# Labelled texts that the model is trained on at most, the same number from each label.
SAMPLE_ROWS = 4_000
THRESHOLD = 0.7
_BASE = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, bool)
_WHITE[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = True


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every feature of all texts, in no special order."""
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    # A text's closing line feed belongs to no feature.
    real = np.ones(len(data), bool)
    real[np.cumsum(sizes) - 1] = False
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    signs = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    sign_owner, sign_real = owner[heads], real[heads]
    owners, found = [], []

    def put(own: np.ndarray, hashes: np.ndarray, kind: int) -> None:
        owners.append(own)
        found.append((mixed(hashes + np.uint64(kind)) & np.uint64(BUCKETS - 1)).astype(np.int64))

    gram = np.zeros(len(signs), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        gram = gram[: len(signs) - n + 1] * np.uint64(_BASE) + signs[n - 1 :] if len(signs) >= n else gram[:0]
        if n in GRAMS:
            last = slice(n - 1, n - 1 + len(gram))
            inside = sign_real[last] & (sign_owner[: len(gram)] == sign_owner[last])
            put(sign_owner[: len(gram)][inside], gram[inside], n)
    wide = data.astype(np.uint64) + np.uint64(1)
    power, inverse = (powers(b, len(data) + 1) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(wide * power[: len(data)])])
    inside = np.concatenate([[False], ~_WHITE[data], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    a, b = change[::2], change[1::2]
    words, own = mixed((sums[b] - sums[a]) * inverse[a]), owner[a]
    put(own, words, 100)
    same = own[1:] == own[:-1]
    # A word that follows itself is a feature whatever the word.
    pair = np.where(words[1:] == words[:-1], np.uint64(1), words[:-1] * np.uint64(3) + words[1:])
    put(own[1:][same], pair[same], 200)
    return np.concatenate(owners), np.concatenate(found)


def bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of every text and their shares of its features."""
    own, bucket = buckets(texts)
    keys, counts = np.unique(own * BUCKETS + bucket, return_counts=True)
    cut = np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS)
    out = []
    for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
        share = counts[a:b] / max(counts[a:b].sum(), 1)
        out.append(((keys[a:b] - k * BUCKETS).astype(np.int32), share.astype(np.float32)))
    return out


@dataclass(frozen=True)
class QualityModel:
    logit: np.ndarray
    bias: float

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], prior: float, least_steps=3000, rate=20.0, seed=5):
        """Softmax over two classes on averaged vectors. Examples are weighted so that the classes count as
        much as their shares `prior` and 1 - prior among all labelled rows."""
        rng = np.random.default_rng(seed)
        vectors = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
        layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
        target = np.array(labels, np.int64)
        share = np.bincount(target, minlength=2) / max(len(target), 1)
        weight = (np.array([1 - prior, prior]) / np.maximum(share, 1e-9)).astype(np.float32)
        steps = max(1, len(rows) // 32)
        epochs = -(-least_steps // steps)
        table = np.zeros((-(-len(rows) // steps), BUCKETS), np.float32)  # the examples of a step, used again for the next
        for epoch in range(epochs if len(rows) else 0):
            for k, part in enumerate(np.array_split(rng.permutation(len(rows)), steps)):
                now = rate * (1 - (epoch * steps + k) / (epochs * steps))
                x = table[: len(part)]
                x.fill(0)
                for i, r in enumerate(part):
                    x[i, rows[r][0]] = rows[r][1]
                hidden = x @ vectors
                out = hidden @ layer + bias
                out = np.exp(out - out.max(axis=1, keepdims=True))
                pull = out / out.sum(axis=1, keepdims=True)
                pull[np.arange(len(part)), target[part]] -= 1
                pull *= weight[target[part]][:, None] / len(part)
                back = pull @ layer.T
                layer -= now / 20 * (hidden.T @ pull)
                bias -= now / 20 * pull.sum(axis=0)
                vectors -= now * (x.T @ back)
        difference = layer[:, 1] - layer[:, 0]
        return cls((vectors @ difference).astype(np.float64), float(bias[1] - bias[0]))

    def score(self, texts: list[bytes]) -> np.ndarray:
        own, bucket = buckets(texts)
        total = np.bincount(own, self.logit[bucket], minlength=len(texts))
        mean = total / np.maximum(np.bincount(own, minlength=len(texts)), 1)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Train on labelled rows that are not held out. Texts are read whole, features are made in the tasks, and
    those of `sample_rows` texts at most go to the driver. A row labelled more than once counts with its
    largest label; rows without label or id are left out. Without any row every score is one half."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    total = known.agg(F.count("*"), F.sum("label")).first()
    prior = (total[1] or 0) / total[0] if total[0] else 0.5
    # The sample's ids are bounded by its parameter, so they may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample_of(known, "label", sample_rows)), "doc_id")
    # One row an id, however many rows have it: that of the text with the smallest hash.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "label", "text")).alias("row")
    rows = rows.groupBy("doc_id").agg(one).select("row.label", "row.text")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = byte_strings(batch.column(1))
            for a, b in text_slices(texts):
                found = bags(texts[a:b])
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([k.tobytes() for k, _ in found], pa.binary()),
                    pa.array([s.tobytes() for _, s in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["label", "bucket", "share"])

    made = map_arrow(rows.select("label", "text"), run, "label int, bucket binary, share binary").collect()
    made.sort()
    bag = [(np.frombuffer(r.bucket, np.int32), np.frombuffer(r.share, np.float32)) for r in made]
    return QualityModel.fit(bag, [r.label for r in made], prior)


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score in 0..1, predicted.

    Only the text decides; a missing or empty one gets the score of no features. Equal texts have equal
    results. Other columns are left out whatever their names; a missing id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = byte_strings(batch.column(2))
            for a, b in text_slices(texts):
                found = shared.value.score(texts[a:b])
                columns = [batch.column(k).slice(a, b - a) for k in (0, 1)]
                columns += [pa.array(found), pa.array((found >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    return map_arrow(docs.select("doc_id", held_out().alias("held_out"), "text"), run, schema)


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder)
    return score(docs, fit(docs, read(spark, folder, "labels")))
