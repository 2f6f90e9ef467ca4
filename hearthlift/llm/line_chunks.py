"""Line dedup by content-defined chunks, in DataFrame functions only.

A text is split at line feeds. A rolling hash over the hashes of a line and the line before it decides
whether a chunk ends with the line, so that a boundary depends on two lines only and moves with them. Chunks
of two lines or more that occur more than once in the whole table, by hash first and then by their bytes,
stay where they occur first (smallest id, then smallest position) and are removed elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import read, stage

# A chunk ends with one line in so many, on average.
DIVISOR = 3
FACTOR = 31
# Repeated hashes (8 bytes each) up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def _line_hash(line: Column) -> Column:
    """32 bits of the line's md5, which other engines have too."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text_hash, n_lines and chunks, an array of (position of its first line, lines, text)."""
    source = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    split = source.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n", -1).alias("lines")
    ).withColumn("hashes", F.transform("lines", _line_hash))
    rolled = F.zip_with(
        "hashes",
        F.concat(F.array(F.lit(0).cast("long")), F.slice("hashes", 1, F.size("hashes") - 1)),
        lambda own, before: (own + FACTOR * before) % DIVISOR == 0,
    )
    numbers = F.sequence(F.lit(1), F.size("lines"))
    ends = F.filter(numbers, lambda i: (i == F.size("lines")) | F.element_at("cuts", i))
    first = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1))
    chunk = lambda a, b: F.struct(
        a.alias("at"), (b - a).alias("lines"), F.array_join(F.slice("lines", a + 1, b - a), "\n").alias("text")
    )
    return (
        split.withColumn("cuts", rolled)
        .withColumn("ends", ends)
        .select(
            "doc_id", "text_hash", F.size("lines").alias("n_lines"), F.zip_with(first, "ends", chunk).alias("chunks")
        )
    )


def _exploded(chunks: DataFrame) -> DataFrame:
    """One row per chunk of two lines or more."""
    multi = F.filter("chunks", lambda c: c["lines"] > 1)
    return chunks.select("doc_id", "text_hash", F.explode(multi).alias("c")).select(
        "doc_id", "text_hash", "c.at", "c.lines", F.col("c.text").alias("chunk"), F.xxhash64("c.text").alias("hash")
    )


def repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Occurrences of repeated chunks that go: doc_id, text_hash, at, lines. Reads `docs` twice, once at once.

    Hashes are counted and equal texts are gathered within each task before anything is shuffled, so a chunk
    in a third of all documents is one row from each task.
    """
    chunks = _exploded(chunked(docs, id_column, text_column))
    counted = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    counted = stage(counted, "chunk-hashes")
    if counted.count() <= BROADCAST_ROWS:
        counted = F.broadcast(counted)
    found = stage(chunks.join(counted, "hash", "left_semi"), "repeated-chunks")
    # Grouping by the text itself is the comparison of bytes. Of a chunk, the digest goes on.
    place = F.struct("doc_id", "text_hash", "at")
    groups = (
        found.groupBy("hash", "chunk")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("hash", F.sha2("chunk", 256).alias("digest"), "first")
    )
    every = found.select("doc_id", "text_hash", "at", "lines", "hash", F.sha2("chunk", 256).alias("digest"))
    return (
        every.join(groups, ["hash", "digest"])
        .where(~place.eqNullSafe(F.col("first")))
        .select("doc_id", "text_hash", "at", "lines")
        .distinct()
    )


def without_repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, and `text`
    without the removed chunks; the lines that stay are joined by line feeds.

    A missing text counts as an empty one, which is one line without characters. Rows equal in id and text
    share their result, so a chunk whose first place they hold stays in all of them. A missing id comes before
    any other. Other columns are left out whatever their names.
    """
    gone = (
        repeated_chunks(docs, id_column, text_column)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set("at").alias("gone"), F.sum("lines").alias("gone_lines"))
    )
    rows = chunked(docs, id_column, text_column)
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    stay = F.filter("chunks", lambda c: F.col("gone").isNull() | ~F.array_contains("gone", c["at"]))
    return joined.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("chunks").cast("long").alias("n_chunks"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed_chunks"),
        F.coalesce("gone_lines", F.lit(0)).cast("long").alias("n_removed_lines"),
        F.array_join(F.transform(stay, lambda c: c["text"]), "\n").alias("text"),
    )


def op3_line_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = without_repeated_chunks(read(spark, folder))
    return done.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


OP3_SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i, len(ls) AS n_lines
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), hashed AS (
    SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines
), cut AS (
    SELECT *, (h + {FACTOR} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {DIVISOR} = 0 AS last
    FROM hashed
), numbered AS (
    SELECT *, coalesce(sum(CAST(last AS INT)) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
    FROM cut
), chunks AS (
    SELECT doc_id, c, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n, max(n_lines) AS n_lines
    FROM numbered GROUP BY doc_id, c
), marked AS (
    SELECT *, n > 1 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, c) > 1 AS gone FROM chunks
)
SELECT doc_id, max(n_lines) AS n_lines, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks,
       CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_removed_lines,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY c) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
