"""Pack whole token sequences into few bins by minimum bin slack.

Documents are encoded where they lie, and only a line per piece is shuffled: pieces are dealt by their row
number over groups of about GROUP_TOKENS tokens each, counted beforehand, so that every group is a fair sample
of all lengths and of bounded size, and a bin that cannot be filled at the end of a group is one in thousands.

Within a group the next bin is always the fullest feasible combination of open pieces that has the longest one
(the published refinement of minimum bin slack; left to the end, long pieces would need bins of their own: 92
instead of 87 bins for the 200 documents of sf0.001). Bit s of `sums[n]`, an integer of limit + 1 bits, says
that some open pieces of at most n tokens add up to s; adding a length is a shift and an or. The highest bit is
the best filling, and walking down from the longest length finds the combination that reaches it with the
longest pieces. It is removed; the sums are formed again only from the shortest length on of which fewer pieces
are left than a bin could hold.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import map_arrow, read, stage, strings, text_slices, workers_can_import
from hearthlift.llm.token_ids import text_encoder

LIMIT, END_ID = 1024, 2
GROUP_TOKENS = 1 << 22


class SlackPacker:
    """Bins of `limit` tokens from numbered pieces of 1 to `limit` tokens."""

    def __init__(self, lengths: np.ndarray, limit: int):
        self.limit, self.full = limit, (1 << (limit + 1)) - 1
        order = np.argsort(lengths, kind="stable")
        cut = np.searchsorted(lengths[order], np.arange(limit + 2))
        # Pieces by length, the lowest number last, so that it is taken first.
        self.open = [order[a:b][::-1].tolist() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        self.present = [n for n in range(1, limit + 1) if self.open[n]]
        self.sums = [1] * (limit + 1)
        self._renew(1)

    def _with(self, reached: int, n: int, copies: int) -> int:
        """What `reached` becomes with up to so many pieces of n tokens."""
        left, step = min(copies, self.limit // n), 1
        while left:  # 1, 2, 4 ... copies at a time add up to any number of copies
            step = min(step, left)
            reached |= (reached << (step * n)) & self.full
            left, step = left - step, 2 * step
        return reached

    def _renew(self, shortest: int) -> None:
        """Sums of all lengths from the shortest one that changed."""
        for n in range(shortest, self.limit + 1):
            self.sums[n] = self._with(self.sums[n - 1], n, len(self.open[n]))

    def fullest(self) -> list[tuple[int, int]]:
        """Lengths and copies of the fullest combination with the longest piece; empty if no piece is open."""
        if not self.present:
            return []
        longest = self.present[-1]
        others = self._with(self.sums[longest - 1], longest, len(self.open[longest]) - 1)
        left = (others & ((1 << (self.limit - longest + 1)) - 1)).bit_length() - 1
        found, at = {longest: 1}, len(self.present)
        while left:
            at = bisect_right(self.present, left, 0, at) - 1
            n = self.present[at]
            most = min(len(self.open[n]) - found.get(n, 0), left // n)
            copies = next(c for c in range(most, -1, -1) if self.sums[n - 1] >> (left - c * n) & 1)
            if copies:
                found[n] = found.get(n, 0) + copies
                left -= copies * n
        return list(found.items())

    def bins(self):
        """Every bin as the numbers of its pieces, the longest first."""
        while combination := self.fullest():
            bin_, changed = [], self.limit + 1
            for n, copies in combination:
                bin_ += [self.open[n].pop() for _ in range(copies)]
                if len(self.open[n]) < self.limit // n:
                    changed = n
                if not self.open[n]:
                    self.present.remove(n)
            if changed <= self.limit:
                self._renew(changed)
            yield bin_


def pieces(docs: DataFrame, tokenizer_path: str, limit: int, end_id: int, with_ids: bool) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 (and ids) of every piece of every document of `docs`,
    whose two columns are the id and the text."""

    def run(batches):
        coder = text_encoder(tokenizer_path)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in text_slices(texts):
                owner, rows = [], []
                for k, found in enumerate(coder.encode(texts[a:b]), a):
                    ids = np.append(found, found.dtype.type(end_id)).astype("<u4")
                    bounds = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
                    for piece, (x, y) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        own = ids[x:y].tobytes()
                        owner.append(k)
                        rows.append((piece, x, y - x, zlib.crc32(own), own))
                columns = list(zip(*rows, strict=True))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 if with_ids else 4]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *arrays], names)

    kind = docs.schema[0].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return map_arrow(docs, run, schema)


def pack_by_slack(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = LIMIT,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset in the sequence, and
    with `with_ids` the ids as little-endian unsigned 32-bit numbers.

    A document is its ids and `end_id`. One of more than `limit` is cut into pieces of `limit`, the first of
    what is over; other documents stay whole. A piece of `limit` is a sequence of its own, with a negative
    number. A missing or empty text is a document of the closing id alone; missing ids stay missing; equal
    rows are packed each for itself; other columns are left out whatever their names; an empty table gives no
    rows. Runs Spark jobs at once; what they write is read again by a retry, which packs alike.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    cut = stage(pieces(source, tokenizer_path, limit, end_id, with_ids), "slack-pieces")
    numbered = cut.withColumn("number", F.monotonically_increasing_id())
    total = cut.where(F.col("length") < limit).agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    workers_can_import(docs.sparkSession)
    columns = [*cut.columns, "sequence_id", "offset"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        lengths = table.column("length").to_numpy()
        group = table.column("grp")[0].as_py()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for number, bin_ in enumerate(SlackPacker(lengths, limit).bins()):
            ends = np.cumsum(lengths[bin_])
            sequence[bin_], offset[bin_] = (group << 32) + number, ends - lengths[bin_]
        table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        return table.select(columns)

    short = numbered.where(F.col("length") < limit).withColumn("grp", F.pmod("number", F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    packed = short.groupBy("grp").applyInArrow(run, schema)
    whole = numbered.where(F.col("length") == limit)
    whole = whole.withColumn("sequence_id", -1 - F.col("number")).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(whole.select(columns))


def op13_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return pack_by_slack(read(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))
