"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

SimHash fingerprints of such texts differ in ten of 64 bits at 0.8 and in five at 0.95, beyond what ball hashing
reaches. So candidates come from both: texts whose fingerprints are linked at three bits share a bucket, and so
do texts that agree in one of `BANDS` bands of `ROWS` MinHash values. With eight values a band, texts of a similarity
of 0.33 meet in one of 180 cases, while at 0.8 all but one in 1,700 pairs meet, most of them in several buckets.
The values are one-permutation MinHash: each is the least of a part of the shingles' range, an empty part
borrowing from another in an order that is the same for all texts.

Every link is a pair whose shingle sets have been compared in full. Pairs are taken from the buckets in rounds.
In each round every bucket with texts of different components has a centre, the first text in an order that
changes from round to round, and every text is compared with one centre, the one it shares most buckets with,
small ones counting for more. So a round compares no more pairs than there are texts, however large a bucket is, and a group of near copies is mostly
linked by the first. After ROUNDS rounds all pairs of different components are compared: those of buckets of up to
SMALL_BUCKET texts pair by pair, and larger buckets in blocks of about BLOCK texts, every block with every other, a
task needing the texts of two blocks only. So no link between texts of one bucket is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, discard, free_name, map_arrow, mixed, powers, stage, text_slices, workers_can_import
from hearthlift.llm.components import components
from hearthlift.llm.simhash import leading_bits, links

SHINGLE_WORDS = 5
# Similarity of near copies: SHARED / OF at least.
SHARED, OF = 4, 5
BANDS, ROWS = 40, 8
ROUNDS, SMALL_BUCKET, BLOCK = 3, 16, 128
# Keys of rows up to which a join copies them to all tasks.
BROADCAST_KEYS = 1_000_000
SEED = 42
_RANDOM = np.random.default_rng(SEED)
_LETTERS = _RANDOM.integers(0, 1 << 63, 256, np.uint64)
_PLACES = _RANDOM.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
# From which other parts an empty part borrows, in order.
_LENDERS = np.argsort(_RANDOM.random((BANDS * ROWS, BANDS * ROWS)), axis=1)
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        _powers[:] = powers(_BASE, n), powers(pow(_BASE, -1, 1 << 64), n)
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, A-Z lowered, and the number of words up to the end of each text."""
    data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    power, inverse = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * power[: len(data)], out=sums[1:])
    edges = np.diff(_WHITE[data].astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))


def shingle_sets(texts: list[bytes], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of every text; one with fewer words has one."""
    hashes, stops = word_hashes(texts)
    count = max(len(hashes) - words + 1, 0)
    joined = np.full(count, words, np.uint64)
    for k in range(words):
        joined += hashes[k : k + count] * _PLACES[k]
    joined = mixed(joined)
    out = []
    for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        else:
            out.append(mixed(np.array([(hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
    return out


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles have the similarity of near copies."""
    if OF * min(len(a), len(b)) < SHARED * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= SHARED * (len(a) + len(b) - both)


def least_values(shingles: np.ndarray) -> np.ndarray:
    """One-permutation MinHash: the least value of every part of the range."""
    values = np.sort(mixed(shingles + np.uint64(SEED)))
    part = ((values >> np.uint64(32)) * np.uint64(BANDS * ROWS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    out, known = np.zeros(BANDS * ROWS, np.uint64), np.zeros(BANDS * ROWS, bool)
    out[part[first]], known[part[first]] = values[first], True
    empty = np.flatnonzero(~known)
    for width in (16, BANDS * ROWS):  # most find a lender soon
        if len(empty):
            lenders = known[_LENDERS[empty, :width]]
            has = lenders.any(axis=1)
            out[empty[has]] = out[_LENDERS[empty[has], lenders[has].argmax(axis=1)]]
            empty = empty[~has]
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One word per band, of its values; rows of texts."""
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(least), BANDS))
    for k in range(ROWS):
        keys = mixed(keys * np.uint64(_BASE) + least.reshape(-1, BANDS, ROWS)[:, :, k])
    return keys.view(np.int64)


def fingerprint(shingles: np.ndarray) -> int:
    """Majority of every bit over the set of shingles."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles), bitorder="little").tobytes(), "little")


def sketches(texts: DataFrame) -> DataFrame:
    """key, fp (the fingerprint as a signed number) and the band keys."""

    def run(batches):
        for batch in batches:
            own = byte_strings(batch.column(1))
            for x, y in text_slices(own):
                sets = shingle_sets(own[x:y])
                fps = np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64)
                bands = band_keys(np.stack([least_values(s) for s in sets])).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(bands) + 1, BANDS, dtype=np.int32)), pa.array(bands))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), pa.array(fps), lists], ["key", "fp", "bands"])

    return map_arrow(texts, run, "key long, fp long, bands array<long>")


def buckets(texts: DataFrame) -> DataFrame:
    """Written table of bucket, key and size, the bucket's rows; buckets of one row are left out."""
    sketched = stage(sketches(texts), "near-sketches")
    by_fp = stage(sketched.select("fp").distinct(), "near-fingerprints")
    linked = components(links(by_fp, leading_bits(by_fp.count()))).withColumnRenamed("node", "fp")
    by_balls = sketched.select("key", "fp").join(linked, "fp", "left")
    rows = sketched.select(F.explode("bands").alias("bucket"), "key").union(
        by_balls.select(F.xxhash64(F.lit("fingerprint"), F.coalesce("root", "fp")), "key")
    )
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    found = stage(rows.join(shared, "bucket"), "near-buckets")
    discard(sketched)
    return found


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose texts are near copies. A row of `texts` is in few pairs as `b`, maybe in many as `a`."""

    def run(batches):
        for batch in batches:
            one, other = byte_strings(batch.column(2)), byte_strings(batch.column(3))
            keep = []
            for x, y in text_slices([s + t for s, t in zip(one, other, strict=True)]):
                distinct = list(dict.fromkeys([*one[x:y], *other[x:y]]))
                sets = dict(zip(distinct, shingle_sets(distinct), strict=True))
                keep += [similar(sets[s], sets[t]) for s, t in zip(one[x:y], other[x:y], strict=True)]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    one = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return map_arrow(both, run, "a long, b long")


def _open(shared: DataFrame, found: DataFrame | None) -> DataFrame:
    """Rows of buckets with texts of different components, with their roots."""
    if found is None:
        return shared.withColumn("root", F.col("key"))
    roots = components(found).withColumnRenamed("node", "key")
    named = shared.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = stage(named.select("bucket", "key", "size", "root"), "near-open")
    several = named.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    return named.join(several.select("bucket"), "bucket", "left_semi")


def _votes(rows: DataFrame, number: int) -> DataFrame:
    """a, b: for every text the centre of another component that it shares most buckets with; a small bucket says
    more than a large one."""
    place = F.col("key") if number == 0 else F.xxhash64("key", F.lit(number))
    centres = rows.groupBy("bucket").agg(F.min(F.struct(place.alias("place"), "key", "root")).alias("centre"))
    met = rows.join(centres, "bucket").where("root <> centre.root")
    votes = met.groupBy("key", F.col("centre.key").alias("centre")).agg(F.sum(F.expr("1000000 div size + 1")).alias("n"))
    best = votes.groupBy("key").agg(F.max(F.struct("n", (-F.col("centre")).alias("minus"))).alias("best"))
    return best.select((-F.col("best.minus")).alias("a"), F.col("key").alias("b"))


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    """The pairs that have not been compared, in either order."""
    if tested is None:
        return pairs
    low, high = F.least("a", "b"), F.greatest("a", "b")
    known = tested.select(low.alias("low"), high.alias("high")).distinct()
    return pairs.withColumns({"low": low, "high": high}).join(known, ["low", "high"], "left_anti").select("a", "b")


def _with(frame: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if frame is None else frame.union(more)


def _links_of_tile(keys: list, roots: list, blocks: list, sets: list[np.ndarray]) -> list[tuple]:
    """Links that connect the components of a tile's texts as all links between different blocks would, or all links
    if there is one block."""
    known, sizes = {r: r for r in roots}, np.array([len(s) for s in sets])
    starts = np.append(0, np.cumsum(sizes)[:-1])
    shingles, block = np.unique(np.concatenate(sets), return_inverse=True)[1], np.array(blocks)
    one_block = bool((block == block[0]).all())
    present, found = np.zeros(shingles.max() + 1, bool), []

    def find(x):
        while known[x] != x:
            known[x] = x = known[known[x]]
        return x

    for i in range(len(keys) - 1):
        own = shingles[starts[i] : starts[i] + sizes[i]]
        present[own] = True
        both = np.add.reduceat(present[shingles[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1], dtype=np.int64)
        present[own] = False
        linked = OF * both >= SHARED * (sizes[i] + sizes[i + 1 :] - both)
        if not one_block:
            linked &= block[i + 1 :] != block[i]
        for j in (np.flatnonzero(linked) + i + 1).tolist():
            x, y = find(roots[i]), find(roots[j])
            if x != y:
                known[x] = y
                found.append((keys[i], keys[j]))
    return found


def _linked_in_blocks(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: links that connect all near copies within each of the buckets, of rows bucket, key, size and root.

    A bucket is dealt to blocks by hash, and a tile holds two blocks, or one with itself."""
    workers_can_import(rows.sparkSession)
    blocks = F.ceil(F.col("size") / BLOCK)
    own = rows.withColumn("block", F.pmod(F.xxhash64("key"), blocks))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    tiles = own.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "root")
    tiles = tiles.join(texts.select("key", "text"), "key")

    def run(table: pa.Table) -> pa.Table:
        column = {name: table.column(name).to_pylist() for name in ("key", "root", "block")}
        own_texts, found = byte_strings(table.column("text")), []
        if len(set(column["root"])) > 1:
            sets = [s for x, y in text_slices(own_texts) for s in shingle_sets(own_texts[x:y])]
            found = _links_of_tile(column["key"], column["root"], column["block"], sets)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return tiles.groupBy("bucket", "low", "high").applyInArrow(run, "a long, b long")


def near_links(shared: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: links that connect what the buckets (bucket, key, size) let find."""
    found, tested = None, None
    for number in range(ROUNDS):
        rows = _open(shared, found)
        pairs = stage(_untested(_votes(rows, number), tested), "near-pairs")
        tested = _with(tested, pairs)
        if pairs.isEmpty():
            break
        found = _with(found, stage(verified(pairs, texts), "near-links"))
    rows = _open(shared, found)
    small, large = rows.where(F.col("size") <= SMALL_BUCKET), rows.where(F.col("size") > SMALL_BUCKET)
    other = small.select("bucket", F.col("key").alias("b"), F.col("root").alias("root_b"))
    crossing = small.join(other, "bucket").where("root <> root_b and key < b")
    crossing = stage(_untested(crossing.select(F.col("key").alias("a"), "b").distinct(), tested), "near-pairs")
    found = _with(found, stage(verified(crossing, texts), "near-links"))
    return found.union(stage(_linked_in_blocks(large, texts), "near-links"))


def _copied(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` but those that near copies, direct or through others, link to a row of a smaller id.

    Of rows with the same id the one with the smaller md5 of its text stays, and missing ids come last. A missing
    text is an empty one; texts without words are copies of each other. All columns come back, which may have any
    names: the one needed here takes a name that is free. Runs Spark jobs at once."""
    own = free_name(docs, "near_key")
    names = [f"`{c}`" for c in docs.columns]
    docs = stage(docs.withColumn(own, F.monotonically_increasing_id()), "near-rows")
    texts = docs.select(F.col(own).alias("key"), F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    shared = buckets(texts.select("key", "text"))
    texts = stage(texts.join(_copied(stage(shared.select("key").distinct(), "near-keys")), "key"), "near-texts")
    linked = components(near_links(shared, texts))
    groups = linked.select(F.col("node").alias("key"), "root").union(linked.select("root", "root").distinct())
    order = F.struct(F.isnull("id").alias("missing"), "id", F.md5(F.coalesce("text", F.lit(""))).alias("text"), "key")
    groups = stage(groups.join(texts.select("key", order.alias("place")), "key"), "near-groups")
    first = groups.groupBy("root").agg(F.min("place").getField("key").alias("first"))
    lost = stage(groups.join(first, "root").where("key <> first").select(F.col("key").alias(own)), "near-lost")
    for table in (shared, texts, groups):
        discard(table)
    return docs.join(_copied(lost), own, "left_anti").select(*names)
