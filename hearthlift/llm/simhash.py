"""SimHash near-duplicates: meet-in-the-middle ball hashing.

A link means at most three differing bits. Two such fingerprints meet in a word that is within two bits of
the one and within one bit of the other. The number of differing bits is odd exactly if one fingerprint has
an even and the other an odd number of set bits, so it is enough that even fingerprints emit all variants
within two bits and odd ones all within one: half the radius, rounded up or down. (At two differing bits one
bit from each side is enough.)

Variants are shuffled by their leading bits only, the remaining flips being made where they arrive: a row
stands for all its variants with those leading bits. Within a variant, a row that is at most one bit away is
linked to all others, which are then within three bits; without such a row nothing follows from the variant.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, free_name, map_arrow, read, stage
from hearthlift.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
# Variants that are made at once in a task; beyond, the next bits are taken one value after the other.
MAX_VARIANTS = 4_000_000
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority of every bit over the hashes of all word shingles; zero for a text without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=False)]
    columns = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_column: str, text_column: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, words) for t in byte_strings(batch.column(1))]
            columns = [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp"])

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_arrow(source, run, f"doc_id {source.schema[0].dataType.simpleString()}, fp long")


def flips(bits: int, most: int) -> np.ndarray:
    """Words with at most `most` of the lowest `bits` bits set."""
    some = [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(bits), n)]
    return np.array(some, np.uint64)


def _radius(fps: np.ndarray) -> np.ndarray:
    return np.where(np.bitwise_count(fps) & 1, 1, 2)


def emitted(distinct: DataFrame, lead: int) -> DataFrame:
    """variant (its leading bits) and fp: one row for each value of the leading bits that variants have."""
    near = [flips(lead, r) for r in range(3)]

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for r in (1, 2):
                own = fps[_radius(fps) == r]
                for a in range(0, len(own), 4096):
                    part = own[a : a + 4096]
                    variants = ((part >> np.uint64(64 - lead))[:, None] ^ near[r]).ravel()
                    copies = np.repeat(part, len(near[r]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(variants.view(np.int64)), pa.array(copies.view(np.int64))], ["variant", "fp"]
                    )

    return map_arrow(distinct, run, "variant long, fp long")


def meetings(fps: np.ndarray, high: int, bits: int) -> np.ndarray:
    """Pairs that meet in a word whose leading 64 - bits bits are `high`: an array of two columns."""
    away = np.bitwise_count((fps >> np.uint64(bits)) ^ np.uint64(high)) if bits < 64 else np.zeros(len(fps), int)
    left = _radius(fps) - away.astype(np.int64)
    fps, left = fps[left >= 0], left[left >= 0]
    if len(fps) < 2:
        return np.zeros((0, 2), np.uint64)
    sizes = [math.comb(bits, k) for k in range(3)]
    expected = sum(int((left >= k).sum()) * sizes[k] for k in range(3))
    if expected > MAX_VARIANTS and bits > 8:
        step = 4
        found = [meetings(fps, (high << step) | v, bits - step) for v in range(1 << step)]
        return np.unique(np.concatenate(found), axis=0)
    low = fps & np.uint64((1 << bits) - 1)
    words, rows, exact = [], [], []
    for k in range(3):
        own = np.flatnonzero(left == k)
        masks = flips(bits, k)
        used = np.bitwise_count(masks).astype(np.int64)
        words.append((low[own][:, None] ^ masks).ravel())
        rows.append(np.repeat(own, len(masks)))
        distance = (_radius(fps[own]) - k)[:, None] + used
        exact.append((distance <= 1).ravel())
    words, rows, exact = (np.concatenate(x) for x in (words, rows, exact))
    order = np.argsort(words, kind="stable")
    words, rows, exact = words[order], rows[order], exact[order]
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    sizes = np.diff(np.append(first, len(words)))
    # The smallest row at most one bit away from each word, if there is one.
    centre = np.minimum.reduceat(np.where(exact, rows, len(fps)), first)
    centre = np.repeat(np.where(sizes > 1, centre, len(fps)), sizes)
    linked = (centre < len(fps)) & (centre != rows)
    pairs = np.unique(np.minimum(centre, rows)[linked] * len(fps) + np.maximum(centre, rows)[linked])
    return np.stack([fps[pairs // len(fps)], fps[pairs % len(fps)]], axis=1)


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """The smallest member reached and the member, for every member of the pairs but the smallest ones."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in pairs.tolist():
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [(root(x), x) for x in list(parent) if root(x) != x]


def links(distinct: DataFrame, lead: int, differing: int = 3) -> DataFrame:
    """a, b: links that span, for every value of the leading bits, what its variants connect."""

    def run(table: pa.Table) -> pa.Table:
        variant = table.column("variant")[0].as_py()
        fps = np.unique(table.column("fp").to_numpy().view(np.uint64))
        pairs = meetings(fps, variant, 64 - lead)
        pairs = pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= differing].view(np.int64)
        found = forest(pairs)
        columns = [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())]
        return pa.Table.from_arrays(columns, ["a", "b"])

    return emitted(distinct, lead).groupBy("variant").applyInArrow(run, "a long, b long")


def leading_bits(n: int) -> int:
    """Leading bits to shuffle by, so that some hundred fingerprints share them whatever their number."""
    return min(32, max(4, (max(n, 1) // 128).bit_length()))


def near_duplicate_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 lowercase hex digits), component_id.

    Fingerprints link at three or fewer differing bits, directly or through others; component_id is the
    smallest id in the component, missing only if all its ids are. A missing text is an empty one; a text
    without words has fingerprint zero, linked like any other; one with fewer words than a shingle has one
    shingle. Equal rows share a component. Other columns are left out whatever their names. Only distinct
    fingerprints are compared, so copies cost nothing. Runs Spark jobs at once.
    """
    slim = stage(fingerprints(docs, id_column, text_column, words), "simhash")
    by_fp = stage(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = components(links(by_fp.select("fp"), leading_bits(by_fp.count())))
    named = by_fp.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(smallest, "root").select("fp", "component_id")
    return slim.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, with all columns, which may have any names.

    Rows that share an id, or have none, go only if none of them is to stay."""
    groups = near_duplicate_groups(docs, id_column, text_column)
    key = free_name(docs, "id")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    lost = groups.groupBy(F.col("doc_id").alias(key)).agg(F.max(stays).alias("stays")).where("not stays").select(key)
    return docs.join(lost, F.col(f"`{id_column}`").eqNullSafe(F.col(key)), "left_anti")


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(read(spark, folder))
