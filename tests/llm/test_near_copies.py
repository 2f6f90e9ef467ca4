import random

import numpy as np

import corpus_pipeline
from hearthlift.llm import near_copies
from hearthlift.llm.common import read
from tests.llm.conftest import ROWS


def sets(text):
    parts = (text or "").encode().lower().split()
    return {tuple(parts[i : i + 5]) for i in range(max(len(parts) - 4, 1))}


def linked_pairs(texts):
    """Pairs of positions at a similarity of 0.8 or more, every pair that shares a shingle being compared."""
    own, by_shingle = [sets(t) for t in texts], {}
    for k, s in enumerate(own):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    pairs = {(a, b) for group in by_shingle.values() for i, a in enumerate(group) for b in group[i + 1 :]}
    return [(a, b) for a, b in pairs if len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])]


def kept_ids(rows):
    """Smallest id of every component, by brute force; ids are unique."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked_pairs([t for _, t in rows]):
        root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return sorted(least.values())


def near_rows():
    """Texts with one to four words changed (similarity 0.7 to 0.95 of 100 words), chains of them, and one large
    group; ids in random order."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    texts = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(100)]
        texts.append(base)
        for changes in (1, 2, 3, 4):
            base = list(base) if rng.random() < 0.5 else list(texts[-1])
            for at in rng.sample(range(100), changes):
                base[at] = rng.choice(words)
            texts.append(base)
    large = [rng.choice(words) for _ in range(120)]
    texts += [[*large[:k], "other", *large[k + 1 :]] for k in range(100)]
    texts += [["A", "few"], ["a", " FEW"], ["another", "few"], [" "], ["\n"]]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [(k, " ".join(t)) for k, t in zip(ids, texts, strict=True)]


def test_stage_keeps_one_of_linked_near_copies(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    want = kept_ids(rows)
    assert len(want) < len(rows) - 200
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want


def test_stage_on_the_given_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01").dropDuplicates(["text"]).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept == kept_ids(rows)


def test_near_copies_of_edge_rows(spark, edge_rows, no_rows):
    kept = near_copies.without_near_copies(edge_rows)
    assert kept.columns == edge_rows.columns
    # Rows 1 and 2 differ in case, 3 to 5 have no words, 6 is there twice.
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "3", "6", "7", "8", "9", "None"] and len(ROWS) == 11
    assert near_copies.without_near_copies(no_rows).count() == 0
    same_id = spark.createDataFrame([(1, "a b c d e f"), (1, "A b c d e f"), (None, "a b c d e f"), (1, "x")], edge_rows.select("doc_id", "text").schema)
    assert sorted(r.text.lower() for r in near_copies.without_near_copies(same_id).collect()) == ["a b c d e f", "x"]


def test_crossing_pairs_of_a_bucket_are_compared(spark):
    # In one bucket: 0 is similar to nothing, 1 and 2 to each other, so that a star around 0 finds no link.
    texts = [(0, "p q r s t u v"), (1, "one two three four five six"), (2, "ONE two three four five six")]
    shared = spark.createDataFrame([(9, k, 3) for k, _ in texts], "bucket long, key long, size long")
    links = near_copies.near_links(shared, spark.createDataFrame(texts, "key long, text string"))
    assert {tuple(r) for r in links.collect()} == {(1, 2)}


def test_shingles_by_words():
    texts = [b"", b" \n", b"a", b"A", b"a b c d", b"a b c d e", b"a  b\tc d e", b"a b c d e f a b c d e", b"\xc3\xa9 b c d e f", b"ab c d e f"]
    found = [set(x.tolist()) for x in near_copies.shingle_sets(texts)]
    assert [len(x) for x in found] == [1, 1, 1, 1, 1, 1, 1, 6, 2, 1]
    assert found[0] == found[1] and found[2] == found[3] and found[5] == found[6] and found[5] < found[7]
    assert len({frozenset(x) for x in found}) == 7
    rng = random.Random(9)
    many = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))).encode() for _ in range(300)]
    for text, one in zip(many, near_copies.shingle_sets(many), strict=True):
        assert len(one) == len(sets(text.decode())) and set(one.tolist()) == set(near_copies.shingle_sets([text])[0].tolist())


def test_bands_follow_the_similarity():
    rng = random.Random(5)
    met = {0.85: 0, 0.5: 0}
    for n in (46, 200, 900):
        for wanted in met:
            for _ in range(60):
                base = [f"w{rng.random()}" for _ in range(n)]
                near = np.array([hash(("s", w)) for w in base], np.int64).view(np.uint64)
                far = near.copy()
                changed = round(n * (1 - wanted) / (1 + wanted))
                far[rng.sample(range(n), changed)] = np.array([hash(("t", rng.random())) for _ in range(changed)], np.int64).view(np.uint64)
                one, other = (near_copies.band_keys(near_copies.least_values(x)[None])[0] for x in (near, far))
                met[wanted] += bool((one == other).any())
    assert met[0.85] >= 178 and met[0.5] < 60


def test_many_texts_of_one_template_are_not_all_compared(spark):
    """Texts of 120 words of which 60 are the same in all: no links, and few pairs."""
    rng = random.Random(6)
    shared = [f"t{k}" for k in range(60)]
    rows = [(k, " ".join([*shared[:30], *[f"w{rng.random()}" for _ in range(60)], *shared[30:]])) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.withColumnRenamed("doc_id", "key")
    found = near_copies.buckets(texts)
    size = found.count()
    assert size < 1500
    assert sum(r["size"] ** 2 for r in found.select("bucket", "size").distinct().collect()) < 20 * 1500
    assert near_copies.without_near_copies(docs).count() == 1500


def test_a_large_bucket_of_groups(spark, monkeypatch):
    """Every text in one bucket: rounds compare a text with one other each, and find most of the groups."""
    monkeypatch.setattr(near_copies, "SMALL_BUCKET", 4)
    rng = random.Random(8)
    texts = []
    for group in range(40):
        words = [f"g{group}w{k}" for k in range(120)]
        for _ in range(5):
            own = list(words)
            own[rng.randrange(120)] = f"x{rng.random()}"
            texts.append(" ".join(own))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "key long, text string")
    one = spark.createDataFrame([(1, k, 200) for k, _ in rows] + [(2 + k // 5, k, 5) for k, _ in rows], "bucket long, key long, size long")
    compared = []
    real = near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda pairs, texts: (compared.append(pairs.count()), real(pairs, texts))[1])
    links = {tuple(sorted(r)) for r in near_copies.near_links(one, frame).collect()}
    assert all(a // 5 == b // 5 for a, b in links)
    assert max(compared) <= 200 and len(compared) <= near_copies.ROUNDS + 1
    linked = {k for pair in links for k in pair}
    assert len(linked) == 200


def test_all_pairs_of_a_large_bucket_are_compared(spark, monkeypatch):
    """Pairs of near copies that share no bucket but one of all texts: rounds find a few, the blocks the others."""
    monkeypatch.setattr(near_copies, "BLOCK", 16)
    rng = random.Random(9)
    rows = []
    for pair in range(60):
        words = [f"p{pair}w{k}" for k in range(20 + 5 * pair)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join([*words, f"x{rng.random()}"]))]
    rows.append((120, ""))
    frame = spark.createDataFrame(rows, "key long, text string")
    shared = spark.createDataFrame([(1, k, len(rows)) for k, _ in rows], "bucket long, key long, size long")
    links = {tuple(sorted(r)) for r in near_copies.near_links(shared, frame).collect()}
    assert links == {(2 * pair, 2 * pair + 1) for pair in range(60)}
