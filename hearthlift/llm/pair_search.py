"""Ranked lexical search by MaxScore with bounds of term pairs.

Index. Documents are taken as blocks of up to BLOCK neighbours. A block holds, for every term that the log of
queries names, the documents with their impacts (the score that the term adds there) and the largest impact;
and for every pair of terms that follow each other in a query, ordered by weight, the intersection list: the
documents that hold both, and the largest impact of both together.

Search. In every block a query's terms are combined into units, pairs or single terms. No document gets more
from a pair than the joint maximum if it holds both, or the larger of the two maxima if it holds one; pairs are
chosen by how much that is less than the sum of both maxima. Units whose bounds together stay below the tenth
best score so far cannot lift a document alone, so only the other units' lists are read. Of the least of these a
document that holds one term only may be out of reach too; then its intersection list is read instead. What is
found is checked unit by unit, and dropped as soon as the bounds of the remaining units cannot lift it.

Tasks keep ten documents a query, and the ten best of all tasks are the result, exactly as if all were scored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, map_arrow, read, stage

BEST = 10
BLOCK = 1024
# Characters of queries that are searched for at once; more are dealt by hash into several passes.
LOG_CHARACTERS = 16_000_000
# Every byte as a term has it, lower-cased, or a space.
_LETTERS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters (lower-cased) and digits and all characters beyond ASCII."""
    return text.translate(_LETTERS).split()


@dataclass(frozen=True)
class Log:
    """Queries as lists of term numbers. `weights` and `pairs` come from the documents, heaviest terms first."""

    vocabulary: dict[bytes, int]
    queries: list[list[int]]
    weights: np.ndarray | None = None
    pairs: dict[tuple[int, int], int] | None = None

    @classmethod
    def of(cls, texts: list[bytes]) -> Log:
        vocabulary: dict[bytes, int] = {}
        queries = [[vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms(x))] for x in texts]
        return cls(vocabulary, queries)

    def weighted(self, documents: int, holding: dict[int, int]) -> Log:
        """With weights from the numbers of documents that hold a term, and pairs of neighbours in weight."""
        held = [holding.get(t, 0) for t in range(len(self.vocabulary))]
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held], np.int64)
        queries = [sorted((t for t in q if held[t]), key=lambda t: (-weights[t], t)) for q in self.queries]
        pairs: dict[tuple[int, int], int] = {}
        for query in queries:
            for a, b in pairwise(query):
                pairs.setdefault((min(a, b), max(a, b)), len(pairs))
        return Log(self.vocabulary, queries, weights, pairs)


def counted_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and the numbers and counts of those of the vocabulary; documents without
    a term are left out. `docs` has two columns, id and text."""

    def run(batches):
        number = vocabulary.get
        for batch in batches:
            keep, n, found, ends = [], [], [], [0]
            for k, text in enumerate(byte_strings(batch.column(1))):
                own = terms(text)
                if own:
                    counts = Counter(map(number, own))
                    counts.pop(None, None)
                    keep.append(k)
                    n.append(len(own))
                    found += sorted(counts.items())
                    ends.append(len(found))
            both = np.array(found, np.int32).reshape(-1, 2)
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(both[:, i]))) for i in (0, 1)]
            ids = batch.column(0).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return map_arrow(docs, run, "doc_id long, n long, terms array<int>, counts array<int>")


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


BLOCK_COLUMNS = {
    "doc_ids": "array<long>",
    "missing": "array<boolean>",
    "terms": "array<int>",
    "ends": "array<int>",
    "docs": "array<int>",
    "impacts": "array<long>",
    "most": "array<long>",
    "pairs": "array<int>",
    "pair_ends": "array<int>",
    "pair_docs": "array<int>",
    "pair_most": "array<long>",
}


def block_index(doc_ids: np.ndarray, missing: np.ndarray, terms_: np.ndarray, docs: np.ndarray, impacts: np.ndarray, pairs: dict) -> dict:
    """Lists of one block from its postings, which ascend by document."""
    order = np.argsort(terms_, kind="stable")
    terms_, docs, impacts = terms_[order], docs[order], impacts[order]
    own, starts = np.unique(terms_, return_index=True)
    ends = np.append(starts[1:], len(terms_))[: len(own)]
    most = np.maximum.reduceat(impacts, starts) if len(own) else np.zeros(0, np.int64)
    slices = {t: slice(a, b) for t, a, b in zip(own.tolist(), starts.tolist(), ends.tolist(), strict=True)}
    known, both, joint = [], [], []
    impact, last = np.zeros(len(doc_ids), np.int64), None
    for (a, b), number in sorted(pairs.items()):
        if a not in slices or b not in slices:
            continue
        if a != last:
            if last is not None:
                impact[docs[slices[last]]] = 0
            impact[docs[slices[a]]] = impacts[slices[a]] + 1
            last = a
        held = docs[slices[b]]
        first = impact[held]
        inside = np.flatnonzero(first)
        if len(inside):
            known.append(number)
            both.append(held[inside])
            joint.append(int((first[inside] - 1 + impacts[slices[b]][inside]).max()))
    return {
        "doc_ids": doc_ids,
        "missing": missing,
        "terms": own.astype(np.int32),
        "ends": ends.astype(np.int32),
        "docs": docs.astype(np.int32),
        "impacts": impacts,
        "most": most,
        "pairs": np.array(known, np.int32),
        "pair_ends": np.cumsum([len(x) for x in both], dtype=np.int32) if both else np.zeros(0, np.int32),
        "pair_docs": np.concatenate(both).astype(np.int32) if both else np.zeros(0, np.int32),
        "pair_most": np.array(joint, np.int64),
    }


def index_blocks(counted: DataFrame, log: Log, documents: int, length: int, block: int = BLOCK) -> DataFrame:
    """One row per block: its documents, its lists, and its pairs' intersection lists."""
    weights, pairs = log.weights, log.pairs

    def built(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("terms", "counts")]
        numbers, counts = (x.flatten().to_numpy().astype(np.int64) for x in lists)
        docs = np.repeat(np.arange(table.num_rows), np.diff(lists[0].offsets.to_numpy()))
        m = 100 - 90 + 90 * table.column("n").to_numpy() * documents // length
        impacts = weights[numbers] * (1_000_000_000 * counts // (1000 * counts + 8 * m[docs]))
        ids = table.column("doc_id").combine_chunks()
        known = ids.fill_null(0).to_numpy()
        columns = block_index(known, ids.is_null().to_numpy(zero_copy_only=False), numbers, docs, impacts, pairs)
        return pa.RecordBatch.from_arrays([_list(columns[c]) for c in BLOCK_COLUMNS], list(BLOCK_COLUMNS))

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == block:
                    yield built(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield built(pa.Table.from_batches(held))

    return map_arrow(counted, run, ", ".join(f"{c} {t}" for c, t in BLOCK_COLUMNS.items()))


class Block:
    """A row of the index, for searching."""

    def __init__(self, columns: dict[str, np.ndarray]):
        self.doc_ids, self.missing = columns["doc_ids"], columns["missing"]
        self.docs, self.impacts, self.pair_docs = columns["docs"], columns["impacts"], columns["pair_docs"]
        self.lists = self._ranges(columns["terms"], columns["ends"], columns["most"])
        self.pairs = self._ranges(columns["pairs"], columns["pair_ends"], columns["pair_most"])

    @staticmethod
    def _ranges(keys: np.ndarray, ends: np.ndarray, most: np.ndarray) -> dict[int, tuple[slice, int]]:
        spans = pairwise([0, *ends.tolist()])
        return {k: (slice(*s), m) for k, s, m in zip(keys.tolist(), spans, most.tolist(), strict=True)}

    def units(self, query: list[int], pairs: dict[tuple[int, int], int]) -> list[tuple]:
        """Units (bound, bound without both terms, terms, intersection) of the terms that the block holds, the
        smallest bound first. `query` is ordered as when the pairs were chosen."""
        offers = []
        for a, b in pairwise(query):
            if a in self.lists and b in self.lists:
                one, other = self.lists[a][1], self.lists[b][1]
                held, joint = self.pairs.get(pairs[min(a, b), max(a, b)], (slice(0, 0), 0))
                bound = max(one, other, joint)
                if bound < one + other:
                    offers.append((one + other - bound, a, b, bound, max(one, other), held))
        out, used = [], set()
        for _, a, b, bound, single, held in sorted(offers, key=lambda o: -o[0]):
            if a not in used and b not in used:
                used |= {a, b}
                out.append((bound, single, (a, b), held))
        out += [(self.lists[t][1], self.lists[t][1], (t,), None) for t in query if t in self.lists and t not in used]
        return sorted(out, key=lambda u: u[0])

    def reaching(self, units: list[tuple], least: int) -> tuple[np.ndarray, np.ndarray]:
        """All documents of a score of `least` or more, and their scores."""
        ahead = np.cumsum([0, *[u[0] for u in units]]).tolist()  # bounds of the first units together
        if ahead[-1] < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = next(k for k in range(len(units)) if ahead[k + 1] >= least)
        scores, found = np.zeros(len(self.doc_ids), np.int64), []
        bound, single, _, held = units[first]
        if held is not None and ahead[first] + single < least:
            found.append(self.pair_docs[held])
            first += 1
        for _, _, own, _ in units[first:]:
            for term in own:
                span = self.lists[term][0]
                scores[self.docs[span]] += self.impacts[span]
                found.append(self.docs[span])
        marked = np.zeros(len(scores), bool)
        for docs in found:
            marked[docs] = True
        left = np.flatnonzero(marked)
        for k in range(first - 1, -1, -1):
            left = left[scores[left] + ahead[k + 1] >= least]
            for term in units[k][2]:
                span = self.lists[term][0]
                docs = self.docs[span]
                at = np.minimum(np.searchsorted(docs, left), len(docs) - 1)
                inside = docs[at] == left
                scores[left[inside]] += self.impacts[span][at[inside]]
        left = left[scores[left] >= least]
        return left, scores[left]


class Best:
    """The best documents of a query so far; equal scores by ascending id, missing ids first."""

    def __init__(self, count: int):
        self.count = count
        self.scores, self.missing, self.doc_ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a document's score must be to matter; an equal one may have a smaller id."""
        return max(int(self.scores[-1]), 1) if len(self.scores) == self.count else 1

    def add(self, scores: np.ndarray, missing: np.ndarray, doc_ids: np.ndarray) -> None:
        scores, missing = np.concatenate([self.scores, scores]), np.concatenate([self.missing, missing])
        doc_ids = np.concatenate([self.doc_ids, doc_ids])
        order = np.lexsort((doc_ids, ~missing, -scores))[: self.count]
        self.scores, self.missing, self.doc_ids = scores[order], missing[order], doc_ids[order]


def best_of_tasks(index: DataFrame, log: Log, count: int) -> DataFrame:
    """query, doc_id and score of the best documents that each task has found."""
    queries, pairs = log.queries, log.pairs

    def run(batches):
        best = [Best(count) for _ in queries]
        for batch in batches:
            for row in range(batch.num_rows):
                columns = {c: batch.column(i)[row].values for i, c in enumerate(BLOCK_COLUMNS)}
                block = Block({c: v.to_numpy(zero_copy_only=False) for c, v in columns.items()})
                for query, known in zip(queries, best, strict=True):
                    docs, scores = block.reaching(block.units(query, pairs), known.least)
                    if len(docs):
                        known.add(scores, block.missing[docs], block.doc_ids[docs])
        numbers = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        if len(numbers):
            ids, missing, scores = (np.concatenate([getattr(b, c) for b in best]) for c in ("doc_ids", "missing", "scores"))
            arrays = [pa.array(numbers), pa.array(ids, mask=missing), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "doc_id", "score"])

    return map_arrow(index, run, "query long, doc_id long, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    count: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    log_characters: int = LOG_CHARACTERS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the `count` best documents of a score above 0 for every item.

    Terms, weights and scores are integers as in `Log.weighted` and `index_blocks`. Every row of `items` is a
    query, also where ids repeat or are missing; one without text, or without a term that a document holds, has
    no rows. Missing texts have no terms, documents without a term count nowhere, rows with equal ids are
    documents each; equal scores are ordered by id (a whole number), missing ids first. Other columns are left
    out whatever their names. Runs Spark jobs at once; `docs` is read once per pass over the queries.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    items = items.select(F.col(item_column).alias("item_id"), F.coalesce(item_text, F.lit("")).alias("text"))
    passes = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // log_characters)
    found = []
    for k in range(max(passes, 1)):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(passes, 1))) == k).collect()
        log = Log.of([r.text.encode() for r in rows])
        counted = stage(counted_terms(source, log.vocabulary), "search-terms")
        documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        log = log.weighted(documents, {r[0]: r[1] for r in holding})
        index = stage(index_blocks(counted, log, documents, length), "search-index")
        best = stage(best_of_tasks(index, log, count), "search-best")
        names = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(rows)], f"query long, item_id {items.schema[0].dataType.simpleString()}")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
        found.append(best.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def op11_pair_bound_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(read(spark, folder), read(spark, folder, "benchmark"))


OP11_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
items AS (
  SELECT DISTINCT r, id, term FROM (
    SELECT row_number() OVER () AS r, item_id AS id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)),
sizes AS (SELECT r, id, count(*) AS n FROM words GROUP BY r, id),
totals AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes),
postings AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM items) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term),
scored AS (
  SELECT i.r AS item, i.id AS item_id, s.r, s.id AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // length)))) AS BIGINT) AS score
  FROM items i JOIN postings p USING (term) JOIN weights USING (term) JOIN sizes s ON s.r = p.r, totals
  GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
