"""Pack token sequences under simultaneous limits on tokens, segments and loss-bearing tokens.

Every input partition packs its own documents while it streams, so nothing is shuffled and no more than
`POOL` open items are held. An item is a whole document or what cutting left of one. A bin is filled by
the dot-product heuristic: of the items that still fit under all three limits, the one whose demand has
the largest dot product with what the bin has left goes in. When none fits, the item of the largest
product is cut to fill the bin. A bin that stays short (its segments or loss-bearing tokens are used up,
or the partition ends) is cut into sequences whose lengths are powers of two, which are not padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift.llm.common import map_arrow, read, strings, text_slices
from hearthlift.llm.token_ids import text_encoder

POOL = 512
END_ID = 1


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold at most."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("limits must be positive")


class Packer:
    """Fills bins from a pool of items; yields each finished sequence as [(document, start, length), ...]."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.most = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.int64)
        self.documents: list[object] = [None] * POOL
        self.loss: list[np.ndarray | None] = [None] * POOL
        self.start = np.zeros(POOL, np.int64)
        self.needs = np.zeros((POOL, 3), np.int64)
        self.used = 0

    def add(self, document: object, length: int, loss: np.ndarray | None = None) -> Iterator[list]:
        """`loss` holds running counts of loss-bearing tokens, one more than tokens; None: all bear loss."""
        if self.used == POOL:
            yield from self._fill()
        k = self.used
        self.documents[k], self.loss[k], self.start[k] = document, loss, 0
        self.needs[k] = length, 1, length if loss is None else int(loss[-1])
        self.used += 1
        while self.used and self._oversized(self.used - 1):
            yield from self._settled([self._take(self.used - 1, self.most)])

    def finish(self) -> Iterator[list]:
        while self.used:
            yield from self._fill()

    def _oversized(self, k: int) -> bool:
        return bool((self.needs[k] > self.most).any())

    def _take(self, k: int, room: np.ndarray) -> tuple:
        """Cut as much from the front of item k as there is room for; the rest stays in the pool."""
        start, loss = int(self.start[k]), self.loss[k]
        length = int(min(self.needs[k, 0], room[0]))
        if loss is None:
            length = int(min(length, room[2]))
            bearing = length
        else:
            length = int(min(length, np.searchsorted(loss, loss[start] + room[2], "right") - 1 - start))
            bearing = int(loss[start + length] - loss[start])
        piece = (self.documents[k], start, length)
        self.start[k] += length
        self.needs[k, 0] -= length
        self.needs[k, 2] -= bearing
        self.taken = np.array([length, 1, bearing])
        if not self.needs[k, 0]:
            last = self.used = self.used - 1
            for column in (self.documents, self.loss, self.start):
                column[k] = column[last]
            self.needs[k] = self.needs[last]
            self.documents[last] = self.loss[last] = None
        return piece

    def _fill(self) -> Iterator[list]:
        """One bin; more sequences than one if it stays short."""
        room, bin_ = self.most.copy(), []
        while self.used and room.min() > 0:
            needs = self.needs[: self.used]
            product = (needs / self.most) @ (room / self.most)
            fits = (needs <= room).all(axis=1)
            k = int(np.argmax(np.where(fits, product, -1.0) if fits.any() else product))
            piece = self._take(k, room)
            if not piece[2]:  # it begins with a loss-bearing token and there is room for none
                break
            room -= self.taken
            bin_.append(piece)
        yield from self._settled(bin_)

    def _settled(self, bin_: list[tuple]) -> Iterator[list]:
        if sum(length for _, _, length in bin_) == self.limits.tokens:
            yield bin_
        else:
            yield from powers_of_two(bin_)


def powers_of_two(pieces: list[tuple]) -> Iterator[list]:
    """The same tokens in sequences whose lengths are the binary digits of their number, largest first."""
    left = sum(length for _, _, length in pieces)
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            document, start, length = pieces.pop()
            now = min(length, room)
            out.append((document, start, now))
            room -= now
            if now < length:
                pieces.append((document, start + now, length - now))
        yield out


class _Rows:
    """Collects pieces of finished sequences, and numbers those within the partition."""

    def __init__(self, with_ids: bool):
        self.with_ids = with_ids
        self.sequence = TaskContext.get().partitionId() << 40 if TaskContext.get() else 0
        self.rows: list[tuple] = []

    def put(self, sequence: list[tuple]) -> None:
        offset = 0
        for (doc_id, ids), start, length in sequence:
            own = ids[start : start + length].astype("<u4").tobytes()
            row = (doc_id, start, length, zlib.crc32(own), len(ids), self.sequence, offset)
            self.rows.append((*row, own) if self.with_ids else row)
            offset += length
        self.sequence += 1

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    limits: Limits = Limits(),  # noqa: B008
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    loss_from: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences: one row per piece.

    doc_id; start and length within the document's ids; ids_crc32 of the ids as little-endian unsigned
    32-bit numbers; doc_tokens with the closing `end_id`; sequence_id; offset in the sequence; with
    `with_ids` also those ids. `loss_from` names a column with the number of leading tokens that bear no
    loss (the prompt of an instruction; missing: none); without it all tokens bear loss.

    A missing or empty text is a document of the closing id alone. Missing ids stay missing; equal rows
    are packed each for itself; other columns are left out whatever their names; an empty table gives no
    rows. A text of any length is cut over as many sequences as it needs. Documents of one input partition
    are packed with each other only, so sequence_id names the partition and stays the same on a retry.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    columns = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    columns += ", ids binary" if with_ids else ""

    def run(batches):
        coder, packer, rows = text_encoder(tokenizer_path), Packer(limits), _Rows(with_ids)
        schema = None
        for batch in batches:
            if schema is None:
                long = [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
                ids = [("ids", pa.binary())] if with_ids else []
                schema = pa.schema([("doc_id", batch.schema.field(0).type), *long, *ids])
            keys, texts, free = batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist()
            for a, b in text_slices(texts):
                for key, prompt, found in zip(keys[a:b], free[a:b], coder.encode(texts[a:b]), strict=True):
                    ids, loss = np.append(found, found.dtype.type(end_id)), None
                    if prompt:
                        loss = np.maximum(np.arange(len(ids) + 1) - min(prompt, len(ids)), 0)
                    for sequence in packer.add((key, ids), len(ids), loss):
                        rows.put(sequence)
                yield rows.batch(schema)
        for sequence in packer.finish():
            rows.put(sequence)
        if rows.rows:
            yield rows.batch(schema)

    free = F.col(loss_from).cast("long") if loss_from else F.lit(None).cast("long")
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), free.alias("free"))
    return map_arrow(source, run, columns)


def op2_vector_packing(spark, folder: str) -> DataFrame:
    return pack(read(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))
