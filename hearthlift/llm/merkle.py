"""Merkle manifest of a table: a hash tree over its rows, with a proof for every row.

Leaves are ranked within their group, three neighbours at a time become a parent, and the subroots of all
groups, in order, become the root in the same way.

Ranks come from one range-sorted write: a row's place in its file less the place of its group's first row
there, plus the rows of that group in earlier files. Only a table of one row per file and group is summed up.

Nested-struct rollup. The base-3 digits of a rank are columns. A block of 3**LEVELS neighbouring nodes is
brought together by one shuffle, and its digits are grouped away one after the other, from the lowest: every
grouping nests the structs of its children in an array and hashes their digests. One transform over the nested
arrays and one explode then give every node of the block its siblings, without a join. Blocks are bounded, so
that no group of any size ends in one task; the nodes of blocks are rolled up in the same way, and what lies
above a block is joined to the block, a 729th of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthlift.llm.common import read, stage

FAN, LEVELS = 3, 6
BLOCK = FAN**LEVELS
# Characters in the table of files and groups up to which it is broadcast, after summing them up.
BROADCAST_CHARACTERS = 16_000_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    """`-` for a missing value, else the number of its bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered_id(doc_id: Column) -> Column:
    """True where 2 divides the crc32 of the id as text; a missing id is not tampered with."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` (a written table) with `rank` within column `g`, from 0, and `n`, the rows of that g.

    Ranks follow `order`, whose rows must be equal in all columns where they tie."""
    by = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order]]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed, "merkle-order").withColumn("_file", F.shiftright("_at", 33))
    files = placed.groupBy("_file", "g").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    own = Window.partitionBy("g")
    earlier = own.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        "_file",
        "g",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(own).alias("n"),
    )
    files = stage(files, "merkle-files")
    held = files.agg(F.sum(F.octet_length("g") + 32)).first()[0] or 0
    files = F.broadcast(files) if held <= BROADCAST_CHARACTERS else files
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(files, ["_file", "g"]).select(*rows.columns, "n", rank.alias("rank"))


def _parent(n: Column, level: int, children: Column) -> Column:
    """Digest of the children; a node that is alone on its level is the root already and stays."""
    several = digest(F.array_join(F.transform(children, lambda c: c["h"]), ""))
    return F.when(n > FAN ** (level - 1), several).otherwise(children[0]["h"])


def nested_blocks(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes (g, n, rank, h and the struct p): g, n, block, h and the nested `children`."""
    digits = [F.pmod(F.floor(F.col("rank") / F.lit(FAN**j)), F.lit(FAN)).cast("int").alias(f"d{j}") for j in range(LEVELS)]
    block = F.expr(f"rank div {BLOCK}L").alias("block")
    found = nodes.select("g", "n", block, *digits, "h", "p").repartition("g", "block")
    inner = "p"
    for level in range(1, LEVELS + 1):
        kept = ["g", "n", "block", *[f"d{j}" for j in range(level, LEVELS)]]
        child = F.struct(F.col(f"d{level - 1}").alias("d"), "h", F.col(inner).alias("inner"))
        found = found.groupBy(*kept).agg(F.sort_array(F.collect_list(child)).alias("children"))
        found = found.withColumn("h", _parent(F.col("n"), level, F.col("children")))
        inner = "children"
    return found


def _emitted(children: Column, level: int, above: Column) -> Column:
    """Array of every node below: its struct p, and `path`, its siblings from the lowest level up.

    A level of the path has the digests left and right of the node; a level on which the node was alone
    is missing."""

    def siblings(start, count) -> Column:
        return F.array_join(F.transform(F.slice(children, start, count), lambda c: c["h"]), "")

    def path(at: Column) -> Column:
        own = F.struct(siblings(F.lit(1), at).alias("l"), siblings(at + 2, F.lit(FAN)).alias("r"))
        return F.concat(F.when(F.col("n") > FAN ** (level - 1), F.array(own)).otherwise(F.array().cast(PATH)), above)

    if level == 1:
        return F.transform(children, lambda c, at: F.struct(c["inner"].alias("p"), path(at).alias("path")))
    return F.flatten(F.transform(children, lambda c, at: _emitted(c["inner"], level - 1, path(at))))


PATH = "array<struct<l:string,r:string>>"


@dataclass(frozen=True)
class Tree:
    """Tiers of nested blocks, the leaves' first. Those of the last tier hold a group each."""

    tiers: list[DataFrame]

    @classmethod
    def over(cls, nodes: DataFrame) -> Tree:
        """`nodes`: g, n, rank, h and the struct p that is to come back with the proofs."""
        tiers = []
        while True:
            tiers.append(stage(nested_blocks(nodes), "merkle-blocks"))
            most = tiers[-1].agg(F.max("n")).first()[0] or 0
            if most <= BLOCK:
                return cls(tiers)
            upper = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long").alias("n")
            nodes = tiers[-1].select("g", upper, F.col("block").alias("rank"), "h", F.struct("block").alias("p"))
            nodes = nodes.where(F.col("n") > 0)

    def roots(self) -> DataFrame:
        return self.tiers[-1].select("g", F.col("h").alias("subroot"))

    def proofs(self, tops: DataFrame) -> DataFrame:
        """The struct p of every leaf with its whole path, and the columns that `tops` has for its g beside
        `above`, the path from the group's root on."""
        carried = [c for c in tops.columns if c not in ("g", "above")]
        known, keys = tops, ["g"]
        for depth, blocks in enumerate(reversed(self.tiers)):
            emitted = blocks.join(known, keys).select(
                "g", *carried, F.explode(_emitted(F.col("children"), LEVELS, F.col("above"))).alias("e")
            )
            if depth == len(self.tiers) - 1:
                return emitted.select("e.p.*", *carried, "e.path")
            known = stage(
                emitted.select("g", *carried, F.col("e.p.block").alias("block"), F.col("e.path").alias("above")), "merkle-paths"
            )
            keys = ["g", "block"]


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tampered: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    `columns` names the id, the group, two columns more and the text, the fields of a leaf in this order;
    `tampered` is a condition on the id under which the row is read again without its line breaks (default: 2
    divides the id's crc32), and folded_root is what that leaf gives with the untouched siblings. Leaves of a
    group ascend by id, missing ids first, rows of the same id by leaf; equal rows are neighbours and leaves
    each. A missing group is a group of its own, before all others. Missing values differ from empty ones.
    Other columns are left out whatever their names. An empty table gives no rows. Runs Spark jobs at once.
    """
    names = dict(zip(columns, COLUMNS, strict=True))
    rows = docs.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    fields = [framed(F.col(c)) for c in COLUMNS]
    condition = tampered_id(F.col("doc_id")) if tampered is None else tampered
    leaves = rows.select(
        # Missing groups come first, and no group's name is empty.
        F.coalesce(F.concat(F.lit(":"), F.col("source").cast("string")), F.lit("")).alias("g"),
        "doc_id",
        digest(*fields).alias("leaf"),
        F.when(condition & F.contains("text", F.lit("\n")), digest(*fields[:-1], framed(cut))).alias("forged"),
    )
    leaves = ranked(stage(leaves, "merkle-leaves"), ["doc_id", "leaf", "forged"])
    groups = Tree.over(leaves.select("g", "n", "rank", F.col("leaf").alias("h"), F.struct("doc_id", "leaf", "forged").alias("p")))
    subroots = stage(groups.roots().select(F.lit("").alias("g"), F.col("g").alias("source"), "subroot"), "merkle-subroots")
    subroots = ranked(subroots, ["source", "subroot"])
    table = Tree.over(subroots.select("g", "n", "rank", F.col("subroot").alias("h"), F.struct("source", "subroot").alias("p")))
    root = table.roots().select("g", F.col("subroot").alias("root"), F.array().cast(PATH).alias("above"))
    tops = table.proofs(root).select(F.col("source").alias("g"), "subroot", "root", F.col("path").alias("above"))
    proofs = groups.proofs(stage(tops, "merkle-tops"))
    folded = F.aggregate(
        "path", F.coalesce("forged", "leaf"), lambda h, level: digest(level["l"], h, level["r"])
    )
    siblings = F.array_join(F.transform("path", lambda level: F.concat(level["l"], level["r"])), "")
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(read(spark, folder))


# DuckDB has no crc32, so its lowest bit comes from the polynomial's definition, bit by bit.
OP12_SQL = """
WITH RECURSIVE framed AS (
  SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    list_reduce(
      [CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
      lambda crc, b: list_reduce(
        [xor(crc, b)] || [CAST(k AS BIGINT) FOR k IN range(8)],
        lambda s, k: xor(s >> 1, CASE WHEN s % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 2 = 0
         THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS forged
  FROM framed),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
tree(source, level, i, h, n) AS (
  SELECT source, 0, r, leaf, n FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM tree WHERE n > 1 GROUP BY source, level, i // 3, n),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top(level, i, h, n) AS (
  SELECT 0, r, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, i // 3, n),
root AS (SELECT h AS root FROM top WHERE n = 1),
folds(source, r, doc_id, leaf, h, proof, level, i) AS (
  SELECT source, r, doc_id, leaf, coalesce(forged, leaf), '', 0, r FROM leaves
  UNION ALL
  SELECT f.source, f.r, f.doc_id, f.leaf,
    sha256(string_agg(CASE WHEN t.i = f.i THEN f.h ELSE t.h END, '' ORDER BY t.i)),
    f.proof || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> f.i), ''), f.level + 1, f.i // 3
  FROM folds f JOIN tree t ON t.source IS NOT DISTINCT FROM f.source AND t.level = f.level AND t.i // 3 = f.i // 3
  WHERE t.n > 1
  GROUP BY f.source, f.r, f.doc_id, f.leaf, f.h, f.proof, f.level, f.i),
grown AS (SELECT * FROM folds QUALIFY row_number() OVER (PARTITION BY source, r ORDER BY level DESC) = 1),
outer_folds(source, r, doc_id, leaf, subroot, h, proof, level, i) AS (
  SELECT g.source, g.r, doc_id, leaf, subroot, h, proof, 0, s.r
  FROM grown g JOIN subroots s ON g.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT f.source, f.r, f.doc_id, f.leaf, f.subroot,
    sha256(string_agg(CASE WHEN t.i = f.i THEN f.h ELSE t.h END, '' ORDER BY t.i)),
    f.proof || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> f.i), ''), f.level + 1, f.i // 3
  FROM outer_folds f JOIN top t ON t.level = f.level AND t.i // 3 = f.i // 3
  WHERE t.n > 1
  GROUP BY f.source, f.r, f.doc_id, f.leaf, f.subroot, f.h, f.proof, f.level, f.i),
done AS (SELECT * FROM outer_folds QUALIFY row_number() OVER (PARTITION BY source, r ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM done, root
"""
