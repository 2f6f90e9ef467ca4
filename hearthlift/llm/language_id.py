"""Language identification by error-correcting output codes over hashed byte n-grams.

Every language has a codeword of +1 and -1. One linear classifier per bit predicts it from the frequencies of
the text's byte n-grams. Decoding takes the language whose codeword has the smallest logistic loss, bits
weighted by how well they were learned; a small lead over the next codeword flags the answer as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthlift.llm.common import held_out, map_arrow, mixed, read, text_slices

UNKNOWN = "und"
BUCKETS = 1 << 12
GRAMS = (1, 2, 3)
CODE_BITS = 15
# Texts that the classifiers are fitted on at most, the same number from each language.
SAMPLE_ROWS = 4_000
AMBIGUOUS = 0.2
_BASE = np.uint64(0x9E3779B97F4A7C15)


def features(texts: list[bytes]) -> np.ndarray:
    """A row per text: square roots of the frequencies of its hashed byte n-grams, A-Z lowered."""
    data = np.frombuffer(b"".join(t.lower() for t in texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    out, gram = np.zeros(len(texts) * BUCKETS), np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        gram = gram[: len(data) - n + 1] * _BASE + data[n - 1 :] + np.uint64(1) if len(data) >= n else gram[:0]
        own = owner[: len(gram)]
        inside = own == owner[n - 1 : n - 1 + len(gram)]
        bucket = (mixed(gram + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        if n in GRAMS:
            out += np.bincount((own * BUCKETS + bucket)[inside], minlength=len(out))
    rows = out.reshape(len(texts), BUCKETS)
    return np.sqrt(rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def code_matrix(n: int, bits: int = CODE_BITS, seed: int = 7) -> np.ndarray:
    """Codewords of n languages: of many random codes the one with the largest least distance of two rows."""
    rng = np.random.default_rng(seed)
    best, score = None, (-1, -1.0)
    for _ in range(200):
        code = rng.choice([-1, 1], (n, bits))
        agree = code @ code.T
        apart = (bits - agree[np.triu_indices(n, 1)]) / 2
        useful = (np.abs(code.sum(axis=0)) < n).mean()
        now = (apart.min() if len(apart) else 0, useful)
        if now > score:
            best, score = code, now
    return best.astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    @classmethod
    def fit(cls, rows: np.ndarray, names: list[str], epochs: int = 12, rate: float = 0.05, seed: int = 3):
        """Logistic classifiers for all bits together, by stochastic gradient steps with running scales."""
        languages = tuple(sorted(set(names)))
        code = code_matrix(max(len(languages), 1))
        index = {name: k for k, name in enumerate(languages)}
        target = code[[index[n] for n in names]] if names else np.zeros((0, code.shape[1]), np.float32)
        rng = np.random.default_rng(seed)
        weights, bias = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for part in np.array_split(order, max(1, len(order) // 64)) if len(order) else ():
                step += 1
                x, y = rows[part], target[part]
                pull = -y / (1 + np.exp(np.clip(y * (x @ weights + bias), -30, 30))) / len(part)
                slope = x.T @ pull + 1e-5 * weights
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                scale = np.sqrt(square / (1 - 0.99**step)) + 1e-6
                weights -= rate * (mean / (1 - 0.9**step)) / scale
                bias -= rate * pull.sum(axis=0)
        right = ((rows @ weights + bias) * target > 0).mean(axis=0) if len(rows) else np.ones(code.shape[1])
        trust = np.clip(2 * right - 1, 0.01, 1)
        return cls(languages, code, weights, bias, (trust / trust.sum() * len(trust)).astype(np.float32))

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, its share in 0..1, and the lead in loss over the next one."""
        out = rows @ self.weights + self.bias
        margins = out[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -margins) * self.trust).sum(axis=2)
        best = loss.argmin(axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        score = 1 / share.sum(axis=1)
        ordered = np.sort(loss, axis=1)
        lead = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        return best, score, lead


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def sample_of(labelled: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` rows, the same number from each label, by a hash of the id: rows is the whole bound.

    Of more labels than that the largest are taken. A label's rows are thinned by the hash to a small multiple
    of its share before they are ranked, so a ranking task sees few rows however many the label has.
    """
    spark, known = labelled.sparkSession, labelled.where(F.col(label).isNotNull())
    sizes = known.groupBy(label).agg(F.count("*").alias("_of")).orderBy(F.desc("_of"), label).limit(max(1, rows))
    schema, sizes = sizes.schema, sizes.collect()
    each = max(1, rows // max(1, len(sizes)))
    draw = F.xxhash64("doc_id") / F.lit(2.0**64) + F.lit(0.5)
    likely = known.join(F.broadcast(spark.createDataFrame(sizes, schema)), label)
    likely = likely.where(draw <= F.lit(4.0 * each + 100) / F.col("_of")).drop("_of")
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    return likely.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= each).drop("_rank")


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from rows that have text and lang and are not held out. Texts are read whole, features are made
    in the tasks, and those of `sample_rows` texts at most go to the driver."""
    able = docs.select("doc_id", "lang").where(~held_out() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    chosen = sample_of(able, "lang", sample_rows).select("doc_id").distinct()
    # The sample's ids are bounded by its parameter, so they may be broadcast.
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).join(F.broadcast(chosen), "doc_id")
    # One row an id, however many rows have it: that of the text with the smallest hash.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "lang", "text")).alias("row")
    rows = rows.groupBy("doc_id").agg(one).select("row.lang", "row.text")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for a, b in text_slices(texts):
                found = [r.tobytes() for r in features(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found, pa.binary())], ["lang", "row"]
                )

    made = map_arrow(rows.select("lang", "text"), run, "lang string, row binary").collect()
    made.sort()
    matrix = np.frombuffer(b"".join(r.row for r in made), np.float32).reshape(-1, BUCKETS)
    return LanguageModel.fit(matrix, [r.lang for r in made])


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score and ambiguous.

    Only the text decides. A missing text, one without a letter, and any text if no language was learned, are
    `und` with score 0 and ambiguous. Equal texts have equal results. Other columns are left out whatever
    their names; a missing id stays missing and is not held out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: buckets times bits

    def run(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in text_slices(["" if t is None else t for t in texts]):
                part = texts[a:b]
                known = np.array([has_letter(t) for t in part]) & bool(model.languages)
                best, score, lead = model.predict(features([(t or "").encode() for t in part]))
                best = np.where(known, best, len(names) - 1)
                columns = [
                    batch.column(0).slice(a, b - a),
                    batch.column(1).slice(a, b - a),
                    pa.array(names[best], pa.string()),
                    pa.array(np.where(known, score, 0.0).astype(float)),
                    pa.array(~known | (lead < AMBIGUOUS)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return map_arrow(docs.select("doc_id", held_out().alias("held_out"), "text"), run, schema)


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder)
    return predict(docs, fit(docs))
