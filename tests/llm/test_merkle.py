import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from hearthlift.llm import merkle

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return h(*map(framed, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def grown(nodes):
    """Root, and for every node its levels of (left, right) digests."""
    paths, at, levels = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(levels) > 1:
        for k, i in enumerate(at):
            run = levels[i // 3 * 3 : i // 3 * 3 + 3]
            paths[k].append((run[: i % 3], run[i % 3 + 1 :]))
            at[k] = i // 3
        levels = [h(*levels[i : i + 3]) for i in range(0, len(levels), 3)]
    return levels[0], paths


def plain(rows):
    if not rows:
        return []
    rows = sorted(rows, key=lambda r: (r["source"] is not None, (r["source"] or "").encode(), r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r["source"])]
    trees = [grown([leaf_of(r, r["text"]) for r in g]) for g in groups]
    root, above = grown([subroot for subroot, _ in trees])
    out = []
    for g, (subroot, paths), upper in zip(groups, trees, above, strict=True):
        for r, path in zip(g, paths, strict=True):
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            text = r["text"].replace("\n", "") if even and r["text"] is not None else r["text"]
            node = leaf_of(r, text)
            for left, right in path + upper:
                node = h(*left, node, *right)
            proof = h(*[x for left, right in path + upper for x in left + right])
            out.append((r["doc_id"], leaf_of(r, r["text"]), subroot, root, proof, node, node == root))
    return out


def same(docs):
    got = sorted(map(tuple, merkle.manifest(docs).collect()), key=repr)
    assert got == sorted(plain([r.asDict() for r in docs.collect()]), key=repr)
    return got


@pytest.mark.parametrize("levels", [6, 1])
def test_edge_rows(edge_rows, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    assert len(same(edge_rows)) == edge_rows.count()


@pytest.mark.parametrize("levels", [6, 2, 1])
def test_groups_of_any_size_in_blocks_of_any_size(spark, shared_folder, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    sizes = {None: 4, "": 1, "a": 3, "b": 10, "hot": 90, "é": 28, "\U0001f600": 2, "￮": 1}
    rows = [(k, f"line {k}\nend\n" if k % 3 else None, None if k % 5 else "", s, k) for s, n in sizes.items() for k in range(n)]
    got = same(spark.createDataFrame(rows, DOCUMENT).repartition(7))
    assert {r[6] for r in got} == {True, False}


def test_one_row_is_leaf_subroot_and_root(spark, shared_folder):
    (row,) = same(spark.createDataFrame([(3, "a", "en", "s", 1)], DOCUMENT))
    assert row[1] == row[2] == row[3] == row[5] and row[4] == h()


def test_no_rows(no_rows):
    assert merkle.manifest(no_rows).collect() == []


def test_clashing_names_and_other_columns(spark, shared_folder):
    rows = [(k, f"a\n{k}", None, None, k) for k in range(12)]
    docs = spark.createDataFrame(rows, DOCUMENT)
    names = ["g", "n", "rank", "h", "p", "leaf", "forged", "block", "d0", "path", "subroot", "root", "_at", "children", "above"]
    wide = docs.withColumns({c: F.lit(c) for c in names})
    assert sorted(merkle.manifest(wide).collect()) == sorted(merkle.manifest(docs).collect())


def test_a_large_group_is_spread(spark, shared_folder, conf):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = spark.range(50_000).select(
        F.col("id").alias("doc_id"), F.lit("t\n").alias("text"), F.lit("en").alias("lang"), F.lit("one").alias("source"), F.lit(1).alias("n_chars")
    )
    leaves = docs.select(F.col("source").alias("g"), F.col("doc_id").alias("rank"), F.lit(50_000).alias("n"), F.lit("x").alias("h"), F.struct("doc_id").alias("p"))
    sizes = [r["count"] for r in merkle.nested_blocks(leaves).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == -(-50_000 // merkle.BLOCK) and max(sizes) < sum(sizes) / 4
