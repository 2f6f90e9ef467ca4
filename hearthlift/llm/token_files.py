"""Files of token ids with Elias-Fano document boundaries, written and read in Spark tasks.

A shard holds the documents of one range of ids, ascending. Its layout, all little-endian:

    8 bytes   magic
    4 x 8     documents, documents without id, width of a token id in bytes, ids in the shard
    boundaries of documents in the id array      (Elias-Fano)
    document ids, less the smallest of the shard (Elias-Fano; 8 bytes for the smallest go before)
    the ids of all documents, one after the other

An Elias-Fano list keeps the low bits of every value packed, and the high bits as a bit vector in which
value i sets bit (high part + i): under 2 + log2(largest / count) bits a value. `select` finds the i-th
set bit from counts per 512 bits, so an offset is read without a table of 64-bit numbers.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import map_arrow, read, scratch, strings, text_slices
from hearthlift.llm.token_ids import text_encoder

MAGIC = b"HLTOKEN1"
END_ID = 0
BITS = 512
# Characters of a shard, whose ids a task holds until it writes; documents whose ids are read at a time.
SHARD_CHARACTERS, READ_DOCUMENTS = 16_000_000, 2_048


class EliasFano:
    """A non-decreasing list of unsigned numbers."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.count, self.low_bits, self.low, self.high = count, low_bits, low, high
        padded = np.zeros(-(-len(high) * 8 // BITS) * BITS // 8, np.uint8)
        padded[: len(high)] = high
        self.blocks = padded.reshape(-1, BITS // 8)
        ones = np.bitwise_count(self.blocks).sum(axis=1, dtype=np.uint32)
        self.before = np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones.astype(np.int64)] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"))

    def select(self, index: np.ndarray) -> np.ndarray:
        """Positions of the set bits with these numbers."""
        block = np.searchsorted(self.before, index, "right") - 1
        bits = np.unpackbits(self.blocks[block], axis=1, bitorder="little")
        rank = (index - self.before[block] + 1).astype(np.int64)
        inside = np.argmax(np.cumsum(bits, axis=1, dtype=np.int64) == rank[:, None], axis=1)
        return block * BITS + inside

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values with these numbers."""
        index = np.asarray(index, np.int64)
        out = np.zeros(len(index), np.int64)
        for a in range(0, len(index), 4096):
            part = index[a : a + 4096]
            at = part[:, None] * self.low_bits + np.arange(self.low_bits)
            bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1 if self.low_bits else np.zeros(at.shape, np.uint8)
            low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
            out[a : a + 4096] = ((self.select(part) - part) << self.low_bits) + low
        return out

    def to_bytes(self) -> bytes:
        head = np.array([self.count, self.low_bits, len(self.low), len(self.high)], "<u8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def read(cls, file) -> EliasFano:
        """The list that begins where the open file stands."""
        count, low_bits, low, high = np.frombuffer(file.read(32), "<u8").tolist()
        return cls(count, low_bits, np.frombuffer(file.read(low), np.uint8), np.frombuffer(file.read(high), np.uint8))


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: list[bytes], width: int) -> list[bytes]:
    """One file, in parts. Documents without an id come first."""
    missing = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[missing:], np.int64)
    ends = np.cumsum(lengths, dtype=np.int64)
    head = np.array([len(doc_ids), missing, width, int(ends[-1]) if len(ends) else 0], "<u8")
    least = known[:1] if len(known) else np.zeros(1, np.int64)
    bounds, names = EliasFano.of(np.concatenate([[0], ends])), EliasFano.of((known - least).astype(np.uint64))
    return [MAGIC, head.tobytes(), bounds.to_bytes(), least.astype("<i8").tobytes(), names.to_bytes(), *ids]


class Shard:
    """An open file as read back: both lists stay packed, `offsets` and `doc_ids` of a range of documents come by
    select, and their ids from their place in the file."""

    def __init__(self, file):
        self.file = file
        if bytes(file.read(8)) != MAGIC:
            raise ValueError("not a file of token ids")
        self.n_docs, self.missing, self.width, self.n_ids = np.frombuffer(file.read(32), "<u8").tolist()
        self.bounds = EliasFano.read(file)
        self.least = int(np.frombuffer(file.read(8), "<i8")[0])
        self.names = EliasFano.read(file)
        self.at = file.tell()

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Where the documents first..last begin, and where the last one ends."""
        return self.bounds.get(np.arange(first, last + 1))

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        known = self.names.get(np.arange(max(first - self.missing, 0), max(last - self.missing, 0))) + self.least
        return [None] * (last - first - len(known)) + known.tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from one offset to another."""
        self.file.seek(self.at + start * self.width)
        return np.frombuffer(self.file.read((end - start) * self.width), f"<u{self.width}")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    shards: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode every document, close it with `end_id`, and write shards to `folder`, a path or URI that the
    driver and all tasks reach. Returns the list of files: shard, file, n_docs, n_ids, base.

    Documents are dealt over `shards` (as many as the counted characters need at SHARD_CHARACTERS each, unless
    given) by ranges of their id and a hash of the text, so that one id with very many rows does not end in one shard, and are ascending in id
    over all files. Missing ids come first; equal ids are ordered by that hash and their text. A missing or
    empty text is the closing id alone. Other columns are left out. A task writes under a name of its own and
    renames the whole file at the end, so a task that is run again leaves one file. `base`, the ids in earlier
    shards, comes from one row per shard. Runs a Spark job at once.
    """
    spark = docs.sparkSession
    if not shards:
        size = docs.agg(F.sum(F.length(text_column).cast("long") + 1)).first()[0] or 0
        shards = max(1, -(-size // SHARD_CHARACTERS))

    def run(batches):
        coder = text_encoder(tokenizer_path)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        ids: list[bytes] = []
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            texts = strings(batch.column(1))
            for a, b in text_slices(texts):
                for found in coder.encode(texts[a:b]):
                    lengths.append(len(found) + 1)
                    ids.append(found.tobytes() + found.dtype.type(end_id).tobytes())
        context = TaskContext.get()
        shard = context.partitionId()
        if doc_ids:
            store, root = fs.FileSystem.from_uri(folder)
            store.create_dir(root, recursive=True)
            name = f"shard-{shard:06d}.tokens"
            own = f"{root}/.{name}.{context.taskAttemptId()}"
            with store.open_output_stream(own) as out:
                for part in shard_bytes(doc_ids, lengths, ids, coder.dtype.itemsize):
                    out.write(part)
            store.move(own, f"{root}/{name}")
            row = [[shard], [name], [len(doc_ids)], [sum(lengths)]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["shard", "file", "n_docs", "n_ids"])

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = source.repartitionByRange(shards, *by).sortWithinPartitions(*by, "text")
    # One row per shard, whatever the number of documents.
    files = map_arrow(dealt, run, "shard long, file string, n_docs long, n_ids long").collect()
    rows, base = [], 0
    for row in sorted(files):
        rows.append((*row, base))
        base += row.n_ids
    return spark.createDataFrame(rows, "shard long, file string, n_docs long, n_ids long, base long")


def read_token_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the listed files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 of the ids as little-endian unsigned 32-bit numbers, and with `with_ids` the ids as such."""

    def parts(shard: Shard, base: int):
        for a in range(0, shard.n_docs, READ_DOCUMENTS):
            b = min(a + READ_DOCUMENTS, shard.n_docs)
            offsets = shard.offsets(a, b)
            ids = shard.ids(int(offsets[0]), int(offsets[-1]))
            inside = (offsets - offsets[0]).tolist()
            own = [ids[x:y].astype("<u4").tobytes() for x, y in zip(inside[:-1], inside[1:], strict=True)]
            columns = [
                pa.array(shard.doc_ids(a, b), pa.int64()),
                pa.array(offsets[:-1] + base),
                pa.array(np.diff(offsets)),
                pa.array([zlib.crc32(x) for x in own], pa.int64()),
                *([pa.array(own, pa.binary())] if with_ids else []),
            ]
            names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as file:
                    yield from parts(Shard(file), row["base"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(files.repartition(tasks, "shard"), run, schema)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch(spark, "tokens")
    files = write_token_files(read(spark, folder), target, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(files, target)
