"""Repetition coverage: characters of a text inside duplicated n-grams and duplicated lines.

Texts are worked on many at a time as one array of bytes. A running polynomial hash gives the hash of every
word and line; rolling over the words' hashes gives those of all n-grams of each length; sorting finds the
repeated ones, and a running sum over their ends the words that they cover.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import byte_strings, map_arrow, mixed, powers, read, text_slices

# The published repetition limits for web text, in hundredths of the characters in words.
DUP_LINES, DUP_LINE_CHARS = 30, 20
TOP_LIMITS = {2: 20, 3: 18, 4: 16}
DUP_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
# Limits of the base rules.
MIN_WORDS, BASE_WINDOW, BASE_REPEATED = 50, 3, 50

SYMBOLS = b"#*$%&|<>"
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
BASE = 0x9E3779B97F4A7C15
STEP = np.uint64(0xD1B54A32D192ED03)

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines dup_line_chars".split()
    + [f"top_{n}gram_chars" for n in TOP_LIMITS]
    + [f"dup_{n}gram_chars" for n in DUP_LIMITS]
)


@lru_cache(4)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    return powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where runs of equal keys begin in it, and the runs' lengths."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, int)
    return order, first, np.diff(np.append(first, len(keys)))


def counts(texts: list[bytes]) -> np.ndarray:
    """A row per text with the numbers named in COUNTS."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    at = {name: k for k, name in enumerate(COUNTS)}
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    docs = np.arange(len(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = ends - np.array([len(t) + 1 for t in texts])

    def total(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return running

    power, inverse = _tables(1 << max(len(data), 1).bit_length())
    running = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])

    def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((running[b] - running[a]) * inverse[a] + (b - a).astype(np.uint64))

    white = _flags(WHITE)[data]
    inside = np.concatenate([[False], ~white, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    word_a, word_b = change[::2], change[1::2]
    chars = total(((data & 0xC0) != 0x80) & ~white)
    symbols = total(_flags(SYMBOLS)[data])
    out[:, at["word_chars"]] = chars[ends] - chars[starts]
    out[:, at["n_symbols"]] = symbols[ends] - symbols[starts]

    word_doc = np.searchsorted(ends, word_a, "right")
    size = chars[word_b] - chars[word_a]
    n_words = np.bincount(word_doc, minlength=len(texts))
    out[:, at["n_words"]] = n_words

    line_b = np.flatnonzero(data == 10)
    line_a = np.concatenate([[0], line_b[:-1] + 1])
    line_doc = np.searchsorted(ends, line_a, "right")
    line_chars = chars[line_b] - chars[line_a]
    worded = line_chars > 0
    line_a, line_b, line_doc, line_chars = line_a[worded], line_b[worded], line_doc[worded], line_chars[worded]
    salt = mixed(docs.astype(np.uint64) + np.uint64(1))
    order, first, _ = _repeats(hashes(line_a, line_b) ^ salt[line_doc])
    later = np.ones(len(order), bool)
    later[order[first]] = False
    out[:, at["n_lines"]] = np.bincount(line_doc, minlength=len(texts))
    out[:, at["n_dup_lines"]] = np.bincount(line_doc[later], minlength=len(texts))
    out[:, at["dup_line_chars"]] = np.bincount(line_doc, line_chars * later, minlength=len(texts))

    word_hash = hashes(word_a, word_b)
    gram = word_hash
    size_sums = total(size)
    for n in range(2, max(DUP_LIMITS) + 1):
        gram = gram[:-1] * STEP + word_hash[n - 1 :] if len(word_hash) >= n else np.zeros(0, np.uint64)
        valid = np.flatnonzero(word_doc[: len(gram)] == word_doc[n - 1 : n - 1 + len(gram)])
        order, first, lengths = _repeats(mixed(gram[valid]) ^ salt[word_doc[valid]])
        where = valid[order]
        if n in TOP_LIMITS:
            span = (size_sums[where[first] + n] - size_sums[where[first]]) * lengths * (lengths > 1)
            # Of the most frequent n-grams of a text, the one with most characters.
            doc = word_doc[where[first]]
            rank = np.lexsort((-span, -lengths, doc))
            top = rank[np.concatenate([[True], doc[rank][1:] != doc[rank][:-1]])] if len(rank) else rank
            out[doc[top], at[f"top_{n}gram_chars"]] = span[top]
        if n == BASE_WINDOW or n in DUP_LIMITS:
            repeated = where[np.repeat(lengths > 1, lengths)]
            edge = np.bincount(repeated, minlength=len(word_doc) + 1)[: len(word_doc) + 1].astype(np.int64)
            edge -= np.bincount(repeated + n, minlength=len(word_doc) + 1)[: len(word_doc) + 1]
            covered = np.cumsum(edge)[: len(word_doc)] > 0
            if n == BASE_WINDOW:
                out[:, at["n_repeat_words"]] = np.bincount(word_doc[covered], minlength=len(texts))
            if n in DUP_LIMITS:
                name = f"dup_{n}gram_chars"
                out[:, at[name]] = np.bincount(word_doc, size * covered, minlength=len(texts))
    return out


def base_failed(p: str = "") -> str:
    """The base rules as SQL over COUNTS, whose names follow `p`."""
    return f"{p}n_words < {MIN_WORDS} OR 100 * {p}n_repeat_words > {BASE_REPEATED} * {p}n_words"


def too_repetitive(p: str = "") -> str:
    """The method's verdict as SQL over COUNTS."""
    rules = [(f"{p}n_dup_lines", DUP_LINES, f"{p}n_lines"), (f"{p}dup_line_chars", DUP_LINE_CHARS, f"{p}word_chars")]
    rules += [(f"{p}top_{n}gram_chars", limit, f"{p}word_chars") for n, limit in TOP_LIMITS.items()]
    rules += [(f"{p}dup_{n}gram_chars", limit, f"{p}word_chars") for n, limit in DUP_LIMITS.items()]
    return " OR ".join(f"100 * {part} > {limit} * {whole}" for part, limit, whole in rules)


def repetition(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, the numbers of COUNTS, base_failed and kept.

    Words are runs of anything but space and the control characters 9 to 13. `dup_line_chars` counts the
    characters in words of lines that repeat an earlier one; `top_ngram_chars` those of the most frequent
    n-gram that occurs twice or more, times its occurrences; `dup_ngram_chars` those of words inside any
    n-gram found twice or more. A missing or empty text has no words and fails the base rules; ties between
    equally frequent n-grams go to the longer one; equal rows have equal results; other columns are left out
    whatever their names. Hashes of 64 bits stand for words, lines and n-grams. Nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            texts = byte_strings(batch.column(1))
            for a, b in text_slices(texts):
                found = counts(texts[a:b])
                columns = [batch.column(0).slice(a, b - a), *[pa.array(c) for c in found.T]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS])

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema[0].dataType.simpleString()
    rows = map_arrow(source, run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    failed, repetitive = F.expr(base_failed()), F.expr(too_repetitive())
    return rows.select(
        "doc_id", *COUNTS[:5], failed.alias("base_failed"), (~failed & ~repetitive).alias("kept"), *COUNTS[5:]
    )


def passing(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that `repetition` keeps, with all their columns."""
    position = docs.columns.index(text_column)
    own = "_repetition"
    while own in docs.columns:
        own += "_"

    def run(batches):
        for batch in batches:
            texts = byte_strings(batch.column(position))
            for a, b in text_slices(texts):
                found = pa.StructArray.from_arrays([pa.array(c) for c in counts(texts[a:b]).T], COUNTS)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*batch.schema.names, own])

    fields = ", ".join(f"{c}: long" for c in COUNTS)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rows = map_arrow(docs, run, f"{columns}, {own} struct<{fields}>")
    failed = f"({base_failed(own + '.')}) OR {too_repetitive(own + '.')}"
    return rows.where(f"NOT ({failed})").select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_repetition_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return repetition(read(spark, folder))


def _gram_ctes() -> str:
    """For each n: its n-grams with how often they occur in the text; the top one; the covered words."""
    parts = []
    for n in range(2, max(DUP_LIMITS) + 1):
        grams = f"""
g{n} AS (
    SELECT doc_id, i, size, count(*) OVER (PARTITION BY doc_id, gram) AS seen
    FROM (
        SELECT doc_id, i, string_agg(w, ' ') OVER next AS gram, sum(length(w)) OVER next AS size,
               count(*) OVER next AS n
        FROM words WINDOW next AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)
    ) WHERE n = {n}
)"""
        top = f"""
t{n} AS (
    SELECT doc_id, arg_max(size * seen, (seen, size)) AS top_{n}gram_chars FROM g{n} WHERE seen > 1 GROUP BY doc_id
)"""
        covered = f"""
c{n} AS (
    SELECT doc_id, count(*) AS n_repeat_words, sum(length(w)) AS dup_{n}gram_chars
    FROM words JOIN (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM g{n} WHERE seen > 1) USING (doc_id, i)
    GROUP BY doc_id
)"""
        parts.append(grams)
        parts += [top] if n in TOP_LIMITS else []
        parts += [covered] if n == BASE_WINDOW or n in DUP_LIMITS else []
    return ",".join(parts)


_SQL_COUNTS = {
    "n_words": "w.n_words", "word_chars": "w.word_chars", "n_symbols": "d.n_symbols", "n_dup_lines": "l.n_dup_lines",
    "n_repeat_words": "c3.n_repeat_words", "n_lines": "l.n_lines", "dup_line_chars": "l.dup_line_chars",
    **{f"top_{n}gram_chars": f"t{n}.top_{n}gram_chars" for n in TOP_LIMITS},
    **{f"dup_{n}gram_chars": f"c{n}.dup_{n}gram_chars" for n in DUP_LIMITS},
}
OP1_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols
    FROM documents
), words AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)
), w AS (
    SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY doc_id
), lines AS (
    SELECT doc_id, length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS size,
           row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth
    FROM (
        SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM d)
    )
), l AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (nth > 1) AS n_dup_lines,
           coalesce(sum(size) FILTER (nth > 1), 0) AS dup_line_chars
    FROM lines WHERE size > 0 GROUP BY doc_id
), {_gram_ctes()}, counted AS (
    SELECT d.doc_id, {", ".join(f"CAST(coalesce({x}, 0) AS BIGINT) AS {name}" for name, x in _SQL_COUNTS.items())}
    FROM d LEFT JOIN w USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN c3 USING (doc_id)
    {" ".join(f"LEFT JOIN t{n} USING (doc_id)" for n in TOP_LIMITS)}
    {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in DUP_LIMITS)}
)
SELECT *, {base_failed()} AS base_failed, NOT ({base_failed()}) AND NOT ({too_repetitive()}) AS kept FROM counted
"""
