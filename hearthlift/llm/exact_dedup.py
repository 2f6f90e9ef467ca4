"""Exact dedup by counting quotient filters, with comparison of bytes.

Every partition counts the 64-bit fingerprints of its texts in counting quotient filters, one per range of
fingerprints. The filters of a range merge without loss, by their sorted remainders. Fingerprints counted
more than once lead back to the texts, which are grouped by their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, free_name, map_arrow, read, stage, text_slices

# Ranges of fingerprints: a power of two, so that a range is the leading bits of the quotient. At least so many
# bits, and more where a range would have more than RANGE_ROWS rows.
RANGE_BITS, RANGE_ROWS = 7, 4_000_000
# Fingerprints held before a task passes on its filters and begins new ones, 32 MB.
HELD = 4_000_000
# Repeated fingerprints (8 bytes each) up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


class CountingQuotientFilter:
    """A multiset of fingerprints of `bits` bits: quotients in bit vectors, remainders sorted within a run.

    `occupied` has a bit per quotient, `run_ends` a bit per slot, `remainders` a number per slot; `counted`
    marks the slots with a count above one, whose counts follow in `counts`.
    """

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, bits: int):
        """Distinct fingerprints in ascending order, and how often each was seen."""
        self.n, self.bits = len(fingerprints), bits
        self.quotient_bits = min(max(self.n - 1, 0).bit_length(), bits)
        shift = np.uint64(bits - self.quotient_bits)
        quotients = (fingerprints >> shift).astype(np.int64) if bits > self.quotient_bits else fingerprints.astype(np.int64)
        self.remainders = fingerprints & np.uint64((1 << int(shift)) - 1)
        occupied = np.zeros(1 << self.quotient_bits, bool)
        occupied[quotients] = True
        last = np.ones(self.n, bool)
        last[:-1] = quotients[1:] != quotients[:-1]
        self.occupied, self.run_ends, self.counted = np.packbits(occupied), np.packbits(last), np.packbits(counts > 1)
        self.counts = counts[counts > 1].astype("<u8")

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in ascending order, and their counts."""
        quotients = np.flatnonzero(np.unpackbits(self.occupied, count=1 << self.quotient_bits))
        ends = np.unpackbits(self.run_ends, count=self.n)
        run = np.cumsum(ends) - ends
        high = quotients[run].astype(np.uint64) << np.uint64(self.bits - self.quotient_bits)
        counts = np.ones(self.n, np.uint64)
        counts[np.unpackbits(self.counted, count=self.n).astype(bool)] = self.counts
        return high | self.remainders, counts

    def to_bytes(self) -> bytes:
        width = max(1, -(-(self.bits - self.quotient_bits) // 8))
        low = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = np.array([self.n, self.bits, self.quotient_bits, width], "<u8")
        parts = (head, self.occupied, self.run_ends, self.counted, low, self.counts)
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        self = cls.__new__(cls)
        self.n, self.bits, self.quotient_bits, width = np.frombuffer(data, "<u8", 4).tolist()
        at, slots = 32, -(-self.n // 8)
        parts = []
        for size in (-(-(1 << self.quotient_bits) // 8), slots, slots, self.n * width):
            parts.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        self.occupied, self.run_ends, self.counted, low = parts
        wide = np.zeros((self.n, 8), np.uint8)
        wide[:, :width] = low.reshape(-1, width)
        self.remainders, self.counts = wide.view("<u8").ravel(), np.frombuffer(data, "<u8", -1, at)
        return self


def merged(filters: list[CountingQuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """All fingerprints of the filters in ascending order with their summed counts."""
    both = [f.items() for f in filters]
    values, counts = (np.concatenate(x) for x in zip(*both, strict=True))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.add.reduceat(counts, first)


def normalised(text: bytes) -> bytes:
    """Lower-case A-Z only."""
    return text.lower()


def fingerprints(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, fp (64 bits of the normalised text) and its text_sha256; no text."""

    def run(batches):
        for batch in batches:
            texts = [normalised(t) for t in byte_strings(batch.column(1))]
            columns = [
                batch.column(0),
                pa.array(np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64).view(np.int64)),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "text_sha256"])

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema[0].dataType.simpleString()
    return map_arrow(source, run, f"doc_id {kind}, fp long, text_sha256 string")


def range_bits(rows: int) -> int:
    return max(RANGE_BITS, min(32, (rows // RANGE_ROWS).bit_length()))


def counting_filters(slim: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Filters of every partition, for ranges by the first `bits` bits: range, filter."""
    rest = 64 - bits

    def run(batches):
        held: list[np.ndarray] = []

        def filters():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            ranges = (values >> np.uint64(rest)).astype(np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ranges)) + 1, [len(values)]])
            low = values & np.uint64((1 << rest) - 1)
            own = [CountingQuotientFilter(low[a:b], counts[a:b], rest) for a, b in zip(cuts, cuts[1:], strict=False)]
            columns = [pa.array(ranges[cuts[:-1]]), pa.array([f.to_bytes() for f in own], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["range", "filter"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= HELD:
                yield filters()
        if held:
            yield filters()

    return map_arrow(slim.select("fp"), run, "range long, filter binary")


def repeated_fingerprints(filters: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """fp and seen, for fingerprints counted more than once over all filters."""

    def run(table: pa.Table) -> pa.Table:
        high = np.uint64(table.column(0)[0].as_py() << (64 - bits))
        values, counts = merged([CountingQuotientFilter.from_bytes(x) for x in table.column(1).to_pylist()])
        more = counts > 1
        found = [pa.array((values[more] | high).view(np.int64)), pa.array(counts[more].astype(np.int64))]
        return pa.Table.from_arrays(found, ["fp", "seen"])

    return filters.groupBy("range").applyInArrow(run, "fp long, seen long")


def verified_groups(docs: DataFrame, repeated: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Texts whose fingerprint repeats, grouped by their bytes: fp, text_sha256, keep_id, group_size.

    Copies collapse within each task before anything is shuffled."""

    def run(batches):
        for batch in batches:
            texts = byte_strings(batch.column(1))
            for a, b in text_slices(texts, 1 << 20):
                low = [normalised(t) for t in texts[a:b]]
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(np.array([xxhash.xxh64_intdigest(t) for t in low], np.uint64).view(np.int64)),
                    pa.array(low, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "bytes"])

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema[0].dataType.simpleString()
    texts = map_arrow(source, run, f"doc_id {kind}, fp long, bytes binary")
    keys = repeated.select("fp")
    if repeated.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return (
        texts.join(keys, "fp", "left_semi")
        .groupBy("fp", "bytes")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("fp", F.sha2("bytes", 256).alias("text_sha256"), "keep_id", "group_size")
    )


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; a missing text counts as empty, and all empty
    texts are one group. Of equal texts the row with the largest id stays; a missing id is smaller than any,
    and if all are missing keep_id is too. Of rows equal in id and text one stays. Other columns are left out
    whatever their names. Reads `docs` twice, the first time at once; the table without texts is written to
    the shared folder.
    """
    slim = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    bits = range_bits(slim.count())
    repeated = stage(repeated_fingerprints(counting_filters(slim, bits), bits), "repeated")
    groups = verified_groups(docs, repeated, id_column, text_column)
    rows = slim.groupBy("doc_id", "fp", "text_sha256").agg(F.count("*").alias("copies"))
    joined = rows.join(groups, ["fp", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        F.col("doc_id").eqNullSafe(keep_id).alias("first"),
        "text_sha256",
    ).select(
        "doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256"
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns, which may have any names: those needed here take
    names that are free."""
    decided = stage(exact_groups(docs, id_column, text_column), "exact-groups")
    key, sha, own = (free_name(docs, n) for n in ("id", "sha256", "own_sha256"))
    same_id = F.col(f"`{id_column}`").eqNullSafe(F.col(key))
    names = [f"`{c}`" for c in docs.columns]
    twice = decided.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    if not twice:  # an id stands for one row, so ids alone decide
        lost = decided.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
        return docs.join(lost, same_id, "left_anti").select(*names)
    lower = F.translate(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    kept = decided.where("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha))
    marked = docs.withColumn(own, F.sha2(lower.cast("binary"), 256))
    same = same_id & (F.col(own) == F.col(sha))
    return marked.join(kept, same, "left_semi").dropDuplicates([id_column, own]).select(*names)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(read(spark, folder))


OP9_SQL = """
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(low) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY low)
"""
