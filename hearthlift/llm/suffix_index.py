"""Repeated passages by a logarithmic family of suffix indexes.

Sparse suffix arrays. Only some suffixes are indexed, chosen by content: in every window of MATCH bytes the
first GRAM-byte string of the smallest hash is the window's anchor. Two equal windows have their anchors at
the same place, so no match is missed, and there is about one anchor in 185 bytes. An entry is an anchor with
the range of window starts that lead to it (`lo` to `hi`), the first eight bytes of its suffix, the hash of the
suffix's first GRAM bytes, and the hash of all bytes in its windows.

The family. Texts are dealt over batches, whose number follows the counted anchors. A batch gets its own array,
ordered by the suffixes' first eight bytes, then by the hash of the first GRAM. It is merge-scanned (a sort-merge
join in that order) against all levels for suffixes that they have too, and then becomes a level. Two levels of
equal size are merged before the next batch, so that sizes grow geometrically, a batch meets a logarithmic number
of levels, and a suffix is written a logarithmic number of times; levels that have been merged are deleted.

Matches. Only entries whose suffix was hit go on. Those with equal bytes in all their windows are a class, and one
of two members or more repeats in whole. For the other entries of a suffix with several classes, the bytes around
the anchors are fetched, every window start is looked up by the hash of its MATCH bytes, and what is found is
compared byte by byte, so spans are exact. Members of one class, and windows of suffixes with very many
classes, are compared by two 64-bit hashes and the eight bytes.

Words. The same works on texts whose every word is replaced by the eight bytes of its hash. Then a match is a run of
words, whatever white space stands between them, and only windows that begin with a word count.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, discard, free_name, map_arrow, mixed, powers, read, stage, text_slices

MATCH, GRAM = 400, 32
# A repeated run of words has so many at least: over 50.
MATCH_WORDS, WORD_BYTES = 51, 8
# Batches of word anchors, always so many: every batch is joined with all levels, so a number that follows the corpus
# would shuffle more than in proportion to it.
WORD_BATCHES = 4
# Anchors of a batch, and most batches: they follow one another, so a larger corpus has larger ones.
BATCH_ENTRIES, MOST_BATCHES, PART_ENTRIES = 1 << 19, 32, 1 << 18
# Bytes of a text looked at in one piece; longer texts are cut into pieces that overlap.
PIECE = 1 << 18
POSITION_BITS = 22
# Numbers in a table (8 bytes each) up to which it is broadcast, after counting them; beyond, both sides are
# shuffled.
BROADCAST_NUMBERS = 4_000_000
# Classes of one anchor up to which their bytes are compared in one task; beyond, the hashes of their window
# starts are counted by a shuffle that collapses equal ones first. Both ways find the same.
TASK_CLASSES = 8_000
# Entries gathered in a task before they are compared, and entries hashed at once.
GATHERED, CHUNK = 1_024, 256

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ENTRY = "a int, lo int, hi int, lead long, kh long, ck long"
KEY = ["doc_id", "text_hash"]
# What a suffix is ordered and matched by.
SUFFIX = ["lead", "kh"]
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, one table a base."""
    if base not in _powers or len(_powers[base][0]) < n:
        _powers[base] = powers(base, n), powers(pow(base, -1, 1 << 64), n)
    return _powers[base]


@lru_cache(1)
def _letters() -> np.ndarray:
    """A 64-bit number for every byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64))


class _Hashes:
    """Hashes of any substring of a byte array, from running sums."""

    def __init__(self, data: np.ndarray, base: int):
        power, self.inverse = _tables(base, 1 << max(len(data), 1).bit_length())
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_letters()[data] * power[: len(data)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.inverse[a]

    def all_grams(self, n: int) -> np.ndarray:
        count = len(self.sums) - n
        return (self.sums[n:] - self.sums[:count]) * self.inverse[:count]


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte behind it."""
    edges = np.diff(_WHITE[data].astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def word_codes(texts: list[bytes]) -> list[bytes]:
    """Every text as the hashes of its words, WORD_BYTES each."""
    out: list[bytes] = []
    for x, y in text_slices(texts):
        data = np.frombuffer(b" ".join([*texts[x:y], b""]), np.uint8)
        starts, ends = word_edges(data)
        hashes = mixed(_Hashes(data, _BASES[0]).of(starts, ends) + (ends - starts).astype(np.uint64))
        codes = hashes.astype("<u8").tobytes()
        stops = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts[x:y]])) * WORD_BYTES
        out += [codes[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]
    return out


def word_runs(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Runs of words, by their numbers, that ranges of a text's code hold, windows within a word left out."""
    first = -(-np.array(starts) // WORD_BYTES)
    last = (np.array(ends) - MATCH_WORDS * WORD_BYTES) // WORD_BYTES
    real = first <= last
    return covered(first[real], last[real] + MATCH_WORDS)


def word_places(text: bytes, starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Byte ranges of the runs of words that ranges of a text's code hold."""
    runs = word_runs(starts, ends)
    begin, behind = word_edges(np.frombuffer(text, np.uint8))
    return [int(begin[a]) for a, _ in runs], [int(behind[b - 1]) for _, b in runs]


class Unit(NamedTuple):
    """What passages are counted in: the code of texts that is indexed, the bytes of it that a repeated string has at
    least, the bytes from one window start to the next, and the place in a text of ranges of its code."""

    match: int
    step: int
    code: Callable[[list[bytes]], list[bytes]]
    places: Callable[[bytes, list[int], list[int]], tuple[list[int], list[int]]]


def _own_bytes(texts: list[bytes]) -> list[bytes]:
    return texts


def _own_places(text: bytes, starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    return starts, ends


BYTES = Unit(MATCH, 1, _own_bytes, _own_places)
WORDS = Unit(MATCH_WORDS * WORD_BYTES, WORD_BYTES, word_codes, word_places)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every `width` neighbours, from running minima within blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[bytes], match: int = MATCH, gram: int = GRAM, step: int = 1) -> tuple[np.ndarray, ...]:
    """Text number, a, lo, hi, lead, kh and ck of every anchor of every text."""
    owner, begin, parts = [], [], []
    for k, text in enumerate(texts):
        for at in range(0, max(len(text) - match + 1, 0), PIECE):
            owner.append(k)
            begin.append(at)
            parts.append(text[at : at + PIECE + match - 1])
    found: list[tuple[np.ndarray, ...]] = []
    for x, y in text_slices(parts, PIECE):
        found.append(_piece_anchors(parts[x:y], owner[x:y], begin[x:y], match, gram, step))
    if not found:
        return tuple(np.zeros(0, t) for t in (*[np.int64] * 4, *[np.uint64] * 3))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _piece_anchors(parts, owner, begin, match, gram, step):
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    first, second = (_Hashes(data, base) for base in _BASES)
    grams = mixed(first.all_grams(gram))
    mask = np.uint64((1 << POSITION_BITS) - 1)
    keyed = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_minimum(keyed, match - gram + 1)
    piece = np.repeat(np.arange(len(parts)), sizes)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + match <= ends[piece])
    if step > 1:
        starts = starts[(starts - (ends - sizes)[piece[starts]]) % step == 0]
    at = (least[starts] & mask).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    a, lo, hi = at[new], starts[new], starts[np.append(new[1:], len(at)) - 1]
    kh = mixed(second.of(a, a + gram)) ^ grams[a]
    around = first.of(lo, hi + match) ^ mixed(second.of(lo, hi + match))
    ck = mixed(around + mixed((a - lo).astype(np.uint64) << np.uint64(20)) + (hi - lo).astype(np.uint64))
    # Big-endian, and with the first bit turned, so that signed numbers are in the order of the bytes.
    lead = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))[a].astype(np.uint64) ^ np.uint64(1 << 63)
    own = piece[lo]
    shift = np.array(begin)[own] - (ends - sizes)[own]
    return np.array(owner)[own], a + shift, lo + shift, hi + shift, lead, kh, ck


def keyed_documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text_hash and text; the first two stand for a row, and equal rows share their result."""
    text = F.coalesce(text_column, F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def indexed_anchors(keyed: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """Anchors of every text."""

    def run(batches):
        for batch in batches:
            texts = byte_strings(batch.column(2))
            for x, y in text_slices(texts):
                own, *columns = anchors(unit.code(texts[x:y]), unit.match, step=unit.step)
                take = pa.array(own + x)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).take(take) for k in range(2)],
                        *[pa.array(c.astype(np.int32)) for c in columns[:3]],
                        *[pa.array(c.view(np.int64)) for c in columns[3:]],
                    ],
                    ["doc_id", "text_hash", "a", "lo", "hi", "lead", "kh", "ck"],
                )

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return map_arrow(keyed, run, f"doc_id {kind}, text_hash long, {ENTRY}")


class SuffixIndexFamily:
    """Levels of suffixes in the shared folder, each with its size in batches; `add` indexes a batch and keeps
    the suffixes that it has twice or that a level has too.

    A level has lead, kh and n, the number of places, in the order of the suffixes."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.hits: list[DataFrame] = []

    @staticmethod
    def _written(suffixes: DataFrame) -> DataFrame:
        return stage(suffixes.groupBy(*SUFFIX).agg(F.sum("n").alias("n")).sortWithinPartitions(*SUFFIX), "suffix-level")

    def add(self, batch: DataFrame) -> None:
        """`batch`: lead, kh and n, also several rows a suffix."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, last), (_, before) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self._written(before.union(last))))
            discard(last)
            discard(before)
        own = self._written(batch)
        found = own.where("n > 1").select(*SUFFIX)
        for _, level in self.levels:
            found = found.union(own.select(*SUFFIX).join(level.select(*SUFFIX).hint("merge"), SUFFIX, "left_semi"))
        self.hits.append(stage(found, "suffix-hits"))
        self.levels.append((1, own))

    def hit_suffixes(self) -> DataFrame:
        """Suffixes with more than one place, in one batch or in different ones."""
        frame = self.hits[0]
        for hit in self.hits[1:]:
            frame = frame.union(hit)
        return stage(frame.distinct(), "suffix-hits")

    def discard(self) -> None:
        for frame in (*self.hits, *[level for _, level in self.levels]):
            discard(frame)


def repeated_suffixes(entries: DataFrame, batches: int, parts: int) -> DataFrame:
    """Suffixes of the entries that have several places, by adding the batches, written in so many parts each,
    one after the other."""
    number = F.pmod("text_hash", F.lit(batches)).cast("int").alias("batch")
    counted = entries.groupBy(number, *SUFFIX).agg(F.count("*").alias("n"))
    counted = stage(counted.repartition("batch", F.pmod("kh", F.lit(parts))), "suffix-batches", ["batch"])
    family = SuffixIndexFamily()
    for k in range(batches):
        family.add(counted.where(F.col("batch") == k).drop("batch"))
    hits = family.hit_suffixes()
    family.discard()
    discard(counted)
    return hits


def _sized(table: DataFrame, numbers: int) -> DataFrame:
    """The written table, to be broadcast if counting shows that it is small. `numbers`: in a row."""
    return F.broadcast(table) if numbers * table.count() <= BROADCAST_NUMBERS else table


def contexts(keyed: DataFrame, edges: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """Edges with `bytes`, the code of the text from lo to the end of the window at hi. Texts and the edges of each are shuffled to each other
    whatever their number."""
    lists = edges.groupBy(*[F.col(c).alias(f"_{c}") for c in KEY]).agg(
        F.collect_list(F.struct("kh", "n", "a", "lo", "hi")).alias("edges")
    )
    joined = keyed.join(
        lists, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    ).select("doc_id", "text_hash", "edges", "text")
    names = ["doc_id", "text_hash", "kh", "n", "a", "lo", "hi", "bytes"]

    def run(batches):
        for batch in batches:
            texts = byte_strings(batch.column(3))
            coded = (code for x, y in text_slices(texts) for code in unit.code(texts[x:y]))
            for x, text in enumerate(coded):
                rows = batch.column(2)[x].as_py()
                own = pa.array([x] * len(rows))
                columns = [pa.array([r[c] for r in rows], pa.int64()) for c in ("kh", "n")]
                columns += [pa.array([r[c] for r in rows], pa.int32()) for c in ("a", "lo", "hi")]
                cut = pa.array([text[r["lo"] : r["hi"] + unit.match] for r in rows], pa.binary())
                arrays = [batch.column(0).take(own), batch.column(1).take(own), *columns, cut]
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, kh long, n long, a int, lo int, hi int, bytes binary"
    return map_arrow(joined, run, schema)


def _equal_windows(
    cut: list[bytes], row: np.ndarray, inside: np.ndarray, hashes: np.ndarray, match: int = MATCH
) -> np.ndarray:
    """Whether another window has the same `match` bytes, a multiple of eight: windows of one hash are neighbours once sorted, and
    neighbours are compared byte by byte, eight at a time."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = np.flatnonzero(ordered[1:] == ordered[:-1])
    hit = np.zeros(len(hashes), bool)
    if not len(same):
        return hit
    data = b"".join(cut)
    sizes = np.array([len(c) for c in cut])
    at = (np.cumsum(sizes) - sizes)[row] + inside
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    steps = np.arange(0, match, 8)
    differ = np.zeros(len(same), bool)
    for a in range(0, len(same), 2048):
        part = same[a : a + 2048]
        one, other = words[at[order[part]][:, None] + steps], words[at[order[part + 1]][:, None] + steps]
        differ[a : a + 2048] = (one != other).any(axis=1)
    hit[order[same[~differ]]] = hit[order[same[~differ] + 1]] = True
    for k in np.unique(ordered[same[differ]]).tolist():  # different windows of one hash
        groups: dict[bytes, list[int]] = {}
        for w in np.flatnonzero(hashes == np.uint64(k)).tolist():
            groups.setdefault(data[at[w] : at[w] + match], []).append(w)
        for group in groups.values():
            hit[group] = len(group) > 1
    return hit


def _window_hashes(cut: list[bytes], kh: np.ndarray, unit: Unit = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window start of every context: its row, its place within the row, its hash."""
    match, step = unit.match, unit.step
    if len(cut) > CHUNK:
        parts = [_window_hashes(cut[x : x + CHUNK], kh[x : x + CHUNK], unit) for x in range(0, len(cut), CHUNK)]
        rows = [own + k * CHUNK for k, (own, _, _) in enumerate(parts)]
        return np.concatenate(rows), *(np.concatenate([p[i] for p in parts]) for i in (1, 2))
    sizes = np.array([len(c) for c in cut])
    begin = np.cumsum(sizes) - sizes
    hashes = _Hashes(np.frombuffer(b"".join(cut), np.uint8), _BASES[1])
    counts = (sizes - match) // step + 1
    row = np.repeat(np.arange(len(cut)), counts)
    inside = step * (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
    at = begin[row] + inside
    return row, inside, mixed(hashes.of(at, at + match)) ^ kh[row]


def _spans(row: np.ndarray, start: np.ndarray, step: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last of the runs of neighbouring starts; both arrays ascend."""
    if not len(row):
        return row, start, start
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + step)]))
    return row[new], start[new], start[np.append(new[1:], len(row)) - 1]


def _repeated_in_task(found: DataFrame, schema: str, unit: Unit) -> DataFrame:
    """Spans of single entries whose windows another entry of the same anchor has, an anchor in one task."""

    def decide(table: pa.Table) -> pa.RecordBatch:
        kh = table.column("kh").to_numpy().view(np.uint64)
        cut = table.column("bytes").to_pylist()
        row, inside, hashes = _window_hashes(cut, kh, unit)
        hit = _equal_windows(cut, row, inside, hashes, unit.match)
        hit &= table.column("n").to_numpy()[row] == 1
        own, a, b = _spans(row[hit], inside[hit], unit.step)
        lo = table.column("lo").to_numpy()[own]
        keys = [table.column(c).take(pa.array(own)).combine_chunks() for c in KEY]
        ends = [pa.array((lo + a).astype(np.int32)), pa.array((lo + b + unit.match).astype(np.int32))]
        return pa.RecordBatch.from_arrays([*keys, *ends], [*KEY, "s", "e"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= GATHERED:
                table = pa.Table.from_batches(held)
                kh = table.column("kh").to_numpy()
                # The last anchor may go on in the next batch.
                done = int(np.searchsorted(kh, kh[-1]))
                if done:
                    yield decide(table.slice(0, done))
                    held = table.slice(done).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows:
                yield decide(table)

    return map_arrow(found.repartition("kh").sortWithinPartitions("kh"), run, schema)


def _repeated_by_shuffle(found: DataFrame, schema: str, unit: Unit) -> DataFrame:
    """The same for anchors of very many classes: hashes of window starts are counted, equal ones first in
    each task, and lead back to their places."""

    def run(batches):
        for batch in batches:
            for x in range(0, batch.num_rows, CHUNK):
                part = batch.slice(x, CHUNK)
                kh = part.column("kh").to_numpy().view(np.uint64)
                row, inside, hashes = _window_hashes(part.column("bytes").to_pylist(), kh, unit)
                own = pa.array(row)
                start = part.column("lo").to_numpy()[row] + inside
                keys = [part.column(c).take(own) for c in ("doc_id", "text_hash", "n", "kh")]
                arrays = [*keys, pa.array(start.astype(np.int32)), pa.array(hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "n", "kh", "s", "h"])

    kind = found.schema["doc_id"].dataType.simpleString()
    windows = map_arrow(found, run, f"doc_id {kind}, text_hash long, n long, kh long, s int, h long")
    more = windows.groupBy("kh", "h").agg(F.count("*").alias("times")).where("times > 1").select("kh", "h")
    hit = windows.where("n = 1").join(more, ["kh", "h"], "left_semi")
    return hit.select("doc_id", "text_hash", "s", (F.col("s") + unit.match).alias("e"))


def repeated_spans(keyed: DataFrame, batches: int | None = None, unit: Unit = BYTES) -> DataFrame:
    """Written table of doc_id, text_hash, s and e: ranges of the texts' code that hold strings of the unit's match or
    more found elsewhere; they may overlap. `batches` instead of a number that follows the counted anchors."""
    entries = stage(indexed_anchors(keyed, unit), "suffix-anchors")
    indexed = entries.count()
    batches = batches or min(MOST_BATCHES, max(1, -(-indexed // BATCH_ENTRIES)))
    hits = repeated_suffixes(entries, batches, max(1, indexed // batches // PART_ENTRIES))
    repeated = stage(entries.join(_sized(hits, 2), SUFFIX, "left_semi"), "suffix-repeated")
    discard(entries)
    # All from one row, since each takes the first row it gets; any member of a class will do.
    member = [F.first(c).alias(c) for c in (*KEY, "a", "lo", "hi")]
    classes = stage(repeated.groupBy(*SUFFIX, "ck").agg(F.count("*").alias("n"), *member), "suffix-classes")
    whole = stage(classes.where("n > 1").select("kh", "ck"), "suffix-whole")
    inside = repeated.join(_sized(whole, 2), ["kh", "ck"], "left_semi").select(
        *KEY, F.col("lo").alias("s"), (F.col("hi") + unit.match).alias("e")
    )
    several = classes.groupBy("kh").agg(F.count("*").alias("m")).where("m > 1")
    several = stage(several, "suffix-several")
    edges = stage(classes.join(_sized(several, 2).select("kh"), "kh", "left_semi"), "suffix-edges")
    found = contexts(keyed, edges, unit)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, s int, e int"
    large = stage(several.where(F.col("m") > TASK_CLASSES), "suffix-large")
    if large.count() == 0:
        spans = inside.union(_repeated_in_task(found, schema, unit))
    else:
        found = stage(found, "suffix-contexts")
        few = found.join(_sized(large, 2), "kh", "left_anti").select(found.columns)
        many = found.join(_sized(large, 2), "kh", "left_semi").select(found.columns)
        spans = inside.union(_repeated_in_task(few, schema, unit)).union(_repeated_by_shuffle(many, schema, unit))
    spans = stage(spans, "suffix-spans")
    for table in (hits, repeated, classes, whole, several, edges, large):
        discard(table)
    return spans


def covered(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of ranges, as ranges that do not touch."""
    out: list[list[int]] = []
    for k in np.argsort(starts, kind="stable").tolist():
        s, e = int(starts[k]), int(ends[k])
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans narrowed to character boundaries of UTF-8."""
    out = []
    for s, e in spans:
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def _span_lists(keyed: DataFrame, batches: int | None, names: list[str], unit: Unit = BYTES) -> DataFrame:
    """One row per text with spans: its key, and the ends of all of them, under four names."""
    doc_id, text_hash, starts, ends = names
    return (
        repeated_spans(keyed, batches, unit)
        .groupBy(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash))
        .agg(F.collect_list("s").alias(starts), F.collect_list("e").alias(ends))
    )


def _same_key(one: list[str], other: list[str]) -> Column:
    return F.col(f"`{one[0]}`").eqNullSafe(F.col(f"`{other[0]}`")) & (F.col(f"`{one[1]}`") == F.col(f"`{other[1]}`"))


def _cut(text: bytes, starts: list[int] | None, ends: list[int] | None, characters: bool) -> tuple[int, bytes]:
    """Number of removed runs, and the bytes that stay."""
    gone = covered(np.array(starts), np.array(ends)) if starts else []
    gone = whole_characters(text, gone) if characters else gone
    edges = [0, *[x for span in gone for x in span], len(text)]
    return len(gone), b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def without_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    batches: int | None = None,
    characters: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, n_bytes, n_removed, n_spans (removed runs that do not
    touch) and `kept`, the remaining bytes.

    Every byte goes that lies in a string of MATCH bytes which also starts elsewhere, in the same text or in
    another, overlapping or not; no occurrence is kept. Texts count as given, not as cut. With `characters`
    the removed runs are narrowed to whole characters, so that `kept` is valid UTF-8.

    A missing text is an empty one; texts under MATCH bytes stay. Rows equal in id and text are occurrences
    of each other. Missing ids are ids like any other. Other columns are left out whatever their names. Runs
    Spark jobs at once and reads `docs` several times, so it should be a written table.
    """
    keyed = keyed_documents(docs, id_column, text_column)
    own = ["_doc_id", "_text_hash", "_s", "_e"]
    joined = keyed.join(_span_lists(keyed, batches, own), _same_key(KEY, own), "left")
    joined = joined.select("doc_id", "text_hash", "text", "_s", "_e")
    names = ["doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches_):
        for batch in batches_:
            texts = byte_strings(batch.column(2))
            rows = []
            for text, s, e in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                gone, kept = _cut(text, s, e, characters)
                rows.append((len(text), len(text) - len(kept), gone, kept))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary"
    return map_arrow(joined, run, schema)


def word_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batches: int = WORD_BATCHES) -> DataFrame:
    """One row per text that has any, by doc_id and text_hash: n_passages, its runs of over 50 words that also stand
    elsewhere, however few bytes they have, and n_passage_words, the words in them. Runs that overlap or follow one
    another count as one. Otherwise as `without_passages`."""
    lists = _span_lists(keyed_documents(docs, id_column, text_column), batches, [*KEY, "s", "e"], WORDS)

    def run(batches_):
        for batch in batches_:
            spans = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            runs = [word_runs(s, e) for s, e in spans]
            counts = pa.array([len(r) for r in runs], pa.int64()), pa.array([sum(b - a for a, b in r) for r in runs], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *counts], [*KEY, "n_passages", "n_passage_words"])

    kind = lists.schema["doc_id"].dataType.simpleString()
    return map_arrow(lists, run, f"doc_id {kind}, text_hash long, n_passages long, n_passage_words long")


def cut_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batches: int | None = None, unit: Unit = BYTES
) -> DataFrame:
    """`docs` with all rows and columns, its texts without repeated passages, cut at whole characters.

    Otherwise as `without_passages`; a missing text stays missing. With the unit WORDS, runs of over 50 words go that
    also stand elsewhere, with the white space within them; that around them stays. Columns may have any names: those needed here
    take names that are free."""
    position = docs.columns.index(text_column)
    own = [free_name(docs, n) for n in ("key", "key_hash", "starts", "ends")]
    hashed = free_name(docs, "own_hash")
    texts = docs.withColumn(hashed, F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))))
    lists = _span_lists(keyed_documents(docs, id_column, text_column), batches, own, unit)
    joined = texts.join(lists, _same_key([id_column, hashed], own), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], *own[2:])

    def run(batches_):
        for batch in batches_:
            texts = batch.column(position).to_pylist()
            ends = zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)
            for x, (s, e) in enumerate(ends):
                if s:
                    text = texts[x].encode()
                    texts[x] = _cut(text, *unit.places(text, s, e), True)[1].decode()
            columns = [*batch.columns[:-2]]
            columns[position] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, docs_names)

    docs_names = docs.columns
    return map_arrow(joined, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 400 bytes or more are removed; those of over 50 words, which may be shorter, are counted besides."""
    docs = read(spark, folder)
    own = ["_doc_id", "_text_hash"]
    words = word_passages(docs).withColumnsRenamed(dict(zip(KEY, own, strict=True)))
    # Digests before the join, so that no text is shuffled by it.
    done = without_passages(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    found = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_passages", "n_passage_words")]
    joined = done.join(words, _same_key(KEY, own), "left")
    return joined.select(*[c for c in done.columns if c != "text_hash"], *found)
