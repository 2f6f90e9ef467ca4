import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthlift.llm import pair_search
from hearthlift.llm.pair_search import Block, Log, block_index, ranked_search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, count=10):
    """All documents scored for all items, by the contract."""
    found = [(k, Counter(words(t))) for k, t in docs]
    found = [(k, c, sum(c.values())) for k, c in found if c]
    n_docs, length = len(found), sum(n for _, _, n in found)
    holding = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for k, c, n in found:
            m = 100 - 90 + (90 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(words(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, k is not None, k or 0))
        out += [(item, r, k if has else None, -s) for r, (s, has, k) in enumerate(sorted(scores)[:count], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, parts=3, **more):
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    queries = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ranked_search(documents, queries, **more).collect()), key=repr)


ITEMS = [
    (1, "One two THREE naïve"), (2, None), (3, ""), (4, "nowhere at-all"), (5, "ab x"), (None, "日本語 ½ don't word"), (6, "one one one"),
    (6, "word"), (7, "second line here " * 400),
]


def test_terms():
    odd = "Ab_c-9 É日本\x85x\x00y½ z ÀÈ [A]"
    assert [t.decode() for t in terms(odd.encode())] == words(odd)


def test_edge_rows(spark, edge_rows):
    docs = [(r.doc_id, r.text) for r in edge_rows.collect()]
    assert searched(spark, docs, ITEMS) == plain(docs, ITEMS)
    assert searched(spark, docs, []) == [] == searched(spark, [], ITEMS) == searched(spark, [(1, None)], ITEMS)


def test_clashing_names(spark, edge_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    names = ["n", "terms", "counts", "query", "score", "rank", "doc_ids", "missing", "item_id"]
    wide = ranked_search(edge_rows.withColumns({c: F.lit("x") for c in names}), items.withColumn("doc_id", F.lit(0)))
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, ranked_search(edge_rows, items).collect()))


@pytest.fixture(scope="module")
def many():
    rng = random.Random(7)
    letters = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, " ".join(rng.choices(letters, weights, k=rng.choice([3, 10, 40, 400])))) for k in range(1500)]
    docs += [(k, docs[3][1]) for k in range(1500, 1600)]  # ties
    docs += [(7, "w1 w2 w59")] * 900  # an id with a third of all rows
    items = [(k, " ".join(rng.sample(letters, rng.choice([1, 2, 3, 8, 20])))) for k in range(40)]
    return docs, items


@pytest.mark.parametrize("block", [16, 300, 1024])
def test_same_as_scoring_everything(spark, shared_folder, many, monkeypatch, block):
    build = pair_search.index_blocks
    monkeypatch.setattr(pair_search, "index_blocks", lambda *a: build(*a, block=block))
    assert searched(spark, *many) == plain(*many)


def test_queries_in_several_passes(spark, shared_folder, many):
    assert searched(spark, *many, log_characters=300, count=3) == plain(*many, count=3)


def test_bounds_of_pairs_hold_and_are_tighter(many):
    docs, items = many
    log = Log.of([t.encode() for _, t in items])
    found = [Counter(log.vocabulary[w.encode()] for w in words(t) if w.encode() in log.vocabulary) for _, t in docs]
    log = log.weighted(len(docs), Counter(t for c in found for t in c))
    impacts = [{t: int(log.weights[t]) * n for t, n in c.items()} for c in found]
    tighter = 0
    for a in range(0, len(docs), 200):
        own = impacts[a : a + 200]
        postings = np.array([(t, d, v) for d, x in enumerate(own) for t, v in sorted(x.items())], np.int64).reshape(-1, 3)
        ids = np.arange(a, a + len(own))
        block = Block(block_index(ids, np.zeros(len(own), bool), *(postings[:, i] for i in range(3)), log.pairs))
        for query in log.queries:
            units = block.units(query, log.pairs)
            assert sorted(t for u in units for t in u[2]) == sorted(t for t in query if t in block.lists)
            for bound, single, pair, held in units:
                got = [[x[t] for t in pair if t in x] for x in own]
                assert bound >= max(sum(g) for g in got)
                assert single >= max((sum(g) for g in got if len(g) == 1), default=0)
                if held is not None:
                    assert block.pair_docs[held].tolist() == [d for d, g in enumerate(got) if len(g) == 2]
            tighter += sum(u[0] for u in units) < sum(block.lists[t][1] for t in query if t in block.lists)
            for least in (1, 3000, 9000):
                scores = [sum(x.get(t, 0) for t in query) for x in own]
                hits, values = block.reaching(units, least)
                assert dict(zip(hits.tolist(), values.tolist(), strict=True)) == {d: s for d, s in enumerate(scores) if s >= least}
    assert tighter > 100
