"""Byte-level BPE by a rank file: encoding with byte offsets, and decoding.

Missing text counts as empty and gives no ids. Pre-tokens come from `pretokens` (class arrays and
transition-function scans); every distinct pre-token is merged once per worker and kept in a bounded table.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import map_arrow, read, strings, text_slices
from hearthlift.llm.token_ids import KeptIds

# Bytes from which a pre-token is merged with a heap instead of repeated scans.
LONG_WORD = 48


class RankEncoder(KeptIds):
    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.lengths = np.zeros(max(self.tokens, default=-1) + 1, np.int64)
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        super().__init__(np.dtype("<u4"))

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token: always the leftmost pair of lowest rank is joined next."""
        if word in self.ranks:
            return [self.ranks[word]]
        return self._by_scan(word) if len(word) < LONG_WORD else self._by_heap(word)

    def _by_scan(self, word: bytes) -> list[int]:
        rank, never = self.ranks.get, len(self.ranks)
        ends = list(range(len(word) + 1))
        scores = [rank(word[i : i + 2], never) for i in range(len(word) - 1)]
        while scores and (best := min(scores)) < never:
            i = scores.index(best)
            del ends[i + 1], scores[i]
            if i:
                scores[i - 1] = rank(word[ends[i - 1] : ends[i + 1]], never)
            if i < len(scores):
                scores[i] = rank(word[ends[i] : ends[i + 2]], never)
        ranks = self.ranks
        return [ranks[word[a:b]] for a, b in zip(ends, ends[1:], strict=False)]

    def _by_heap(self, word: bytes) -> list[int]:
        """The same in n log n: a heap of pairs over a linked list of parts, given by their ends."""
        n, ranks = len(word), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n))
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (r := ranks.get(word[i : after[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, after[after[i]]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            gone = after[i]
            alive[gone] = False
            after[i] = end
            if end < n:
                before[end] = i
            offer(before[i])
            offer(i)
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : after[i]]])
            i = after[i]
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [self.merged(w.encode()) for w in words]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte of the text at which each token ends."""
        return np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(2)
def rank_encoder(path: str) -> RankEncoder:
    return RankEncoder(path)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id as `doc_id`, `ids` and `ends`, both binary.

    `ids` holds little-endian unsigned 32-bit ids, `ends` as many little-endian unsigned 64-bit byte
    offsets at which the tokens end in the UTF-8 text, so that any range of tokens can be cut from the
    text or decoded alone. A missing or empty text has empty binaries, a missing id stays missing, equal
    rows stay separate rows, other columns are left out whatever their names. Nothing is shuffled.
    """

    def run(batches):
        coder = rank_encoder(path)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in text_slices(texts):
                done = coder.encode(texts[a:b])
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([ids.tobytes() for ids in done], pa.binary()),
                    pa.array([coder.ends(ids).astype("<u8").tobytes() for ids in done], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "ends"])

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_arrow(source, run, f"doc_id {source.schema[0].dataType.simpleString()}, ids binary, ends binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `decoded`, the bytes that `ids` stand for. Only `doc_id`, `ids` and `ends` are kept."""

    def run(batches):
        coder = rank_encoder(path)
        for batch in batches:
            texts = [coder.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "ends", "decoded"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, ends binary, decoded binary"
    return map_arrow(encoded.select("doc_id", "ids", "ends"), run, schema)


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = decode(encode(read(spark, folder), path), path)
    return done.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
