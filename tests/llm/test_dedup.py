import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checks.compare import canonical, duck
from hearthlift.llm import components as components_module
from hearthlift.llm import exact_dedup, line_chunks, near_copies, quality_rules, simhash, suffix_index
from hearthlift.llm.common import read, stage
from hearthlift.llm.components import components
from hearthlift.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ROWS

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, SMALL)
    cursor = duck(SMALL).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == canonical(columns, cursor.fetchall())


def test_quality_rules_of_edge_rows(edge_rows, no_rows):
    rows = quality_rules.repetition(edge_rows).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_words == by_id[4].n_words == by_id[5].n_words == 0 and by_id[3].base_failed
    assert by_id[7].n_words == by_id[7].n_repeat_words == 3000 and not by_id[7].kept
    assert by_id[7].dup_10gram_chars == by_id[7].word_chars == 6000
    assert quality_rules.repetition(no_rows).count() == 0
    kept = quality_rules.passing(edge_rows)
    assert kept.columns == edge_rows.columns and kept.count() == sum(r.kept for r in rows)


def test_exact_groups_of_edge_rows(edge_rows, no_rows):
    rows = exact_dedup.exact_groups(edge_rows).collect()
    assert len(rows) == len(ROWS)
    groups = {}
    for r in rows:
        groups.setdefault(r.text_sha256, []).append(r)
    for group in groups.values():
        assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
    assert next(r for r in rows if r.doc_id == 1).keep_id == 2
    assert next(r for r in rows if r.doc_id == 3).keep_id == 4
    stay = exact_dedup.without_copies(edge_rows)
    assert stay.columns == edge_rows.columns and stay.count() == len(groups)
    assert exact_dedup.exact_groups(no_rows).count() == 0


def test_counting_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(4)
    parts = [rng.integers(0, 1 << 57, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 50)) for n in (1, 40, 3000)]
    filters = []
    for part in parts:
        values, counts = np.unique(part, return_counts=True)
        made = exact_dedup.CountingQuotientFilter(values, counts, 57)
        filters.append(exact_dedup.CountingQuotientFilter.from_bytes(made.to_bytes()))
    values, counts = exact_dedup.merged(filters)
    want, times = np.unique(np.concatenate(parts), return_counts=True)
    assert values.tolist() == want.tolist() and counts.tolist() == times.tolist()


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_roots(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash_of_edge_rows(edge_rows, no_rows):
    rows = simhash.near_duplicate_groups(edge_rows).collect()
    want = sorted(f"{plain_fingerprint(t):016x}" for _, t in ROWS)
    assert sorted(r.fingerprint for r in rows) == want
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
    assert simhash.near_duplicate_groups(no_rows).count() == 0
    assert simhash.one_of_each_group(edge_rows).columns == edge_rows.columns


@pytest.mark.parametrize("lead", [4, 9])
@pytest.mark.parametrize("most", [4_000_000, 2_000])
def test_ball_hashing_finds_all_links(spark, monkeypatch, lead, most):
    monkeypatch.setattr(simhash, "MAX_VARIANTS", most)
    rng = random.Random(lead)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:60]:
        for _ in range(3):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    fps |= {0, 7, (1 << 64) - 1}
    want = linked_roots(sorted(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for variant in {(f >> (64 - lead)) ^ int(m) for f in fps for m in simhash.flips(lead, 2)}:
        for a, b in simhash.meetings(np.array(sorted(fps), np.uint64), variant, 64 - lead).tolist():
            assert (a ^ b).bit_count() <= 3
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: find(f) for f in fps} == want


@pytest.mark.parametrize("most", [500_000, 0])
def test_components_of_a_long_chain(spark, monkeypatch, most):
    monkeypatch.setattr(components_module, "TASK_LINKS", most)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7)]
    frame = stage(spark.createDataFrame(links, "a long, b long"), "chain")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, 101: 100}
    assert components(frame.where("false")).count() == 0


def test_components_in_one_task():
    rng = np.random.default_rng(1)
    for n, m in ((2, 1), (50, 40), (1000, 900), (5000, 5000)):
        a, b = rng.integers(-n, n, (2, m))
        root = {int(x): int(x) for x in np.concatenate([a, b])}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            low, high = sorted((find(x), find(y)))
            root[high] = low
        nodes, roots = components_module.smallest_reached(a, b)
        assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == {x: find(x) for x in root}
    chain = np.random.default_rng(2).permutation(20_000)
    _, roots = components_module.smallest_reached(chain[:-1], chain[1:])
    assert (roots == 0).all()


def test_simhash_query_against_brute_force(spark, small_documents):
    rows = simhash.op8_simhash_near_dedup(spark, SMALL).collect()
    fps = {k: plain_fingerprint(t) for k, t in small_documents.items()}
    roots = linked_roots(sorted(set(fps.values())))
    least = {}
    for k, f in fps.items():
        least[roots[f]] = min(k, least.get(roots[f], k))
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {
        k: (f, least[roots[f]]) for k, f in fps.items()
    }


def plain_removal(texts, match):
    """Kept bytes and removed runs of every text, from all windows."""
    seen = {}
    for text in texts:
        for i in range(len(text) - match + 1):
            w = text[i : i + match]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - match + 1):
            if seen[text[i : i + match]] > 1:
                gone[i : i + match] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((bytes(np.frombuffer(text, np.uint8)[~gone]), runs))
    return out


@pytest.mark.parametrize("classes", [8_000, 1])
def test_passages_against_brute_force(spark, monkeypatch, classes):
    monkeypatch.setattr(suffix_index, "TASK_CLASSES", classes)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    passage = lambda n: " ".join(word() for _ in range(n))
    shared = [passage(n) for n in (60, 90, 120, 150, 300)]
    texts = [passage(rng.randint(0, 150)) for _ in range(25)] + ["z" * 900, "ab" * 700, "", "short"]
    for _ in range(60):
        a, b = rng.choice(shared), rng.choice(shared)
        cut = rng.randint(0, 40)
        texts.append(passage(rng.randint(0, 30)) + a[cut:] + passage(rng.randint(0, 20)) + b[: len(b) - cut])
    texts += texts[-3:]
    frame = stage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "passages")
    rows = {r.doc_id: r for r in suffix_index.without_passages(frame).collect()}
    for k, (kept, runs) in enumerate(plain_removal([t.encode() for t in texts], 400)):
        assert (bytes(rows[k].kept), rows[k].n_spans) == (kept, runs)
    cut = {r.doc_id: r.text for r in suffix_index.cut_documents(frame).collect()}
    assert all(0 <= len(cut[k].encode()) - len(rows[k].kept) <= 6 * rows[k].n_spans for k in cut)


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(9000)) + b"q" * 3000
    found = suffix_index.anchors([text])
    covered = np.zeros(len(text), bool)
    for lo, hi in zip(found[2], found[3], strict=True):
        covered[lo : hi + 1] = True
    assert covered[: len(text) - 399].all()
    monkeypatch.setattr(suffix_index, "PIECE", 1000)
    assert set(suffix_index.anchors([text])[1].tolist()) == set(found[1].tolist())


def test_passages_of_edge_rows(edge_rows, no_rows):
    rows = suffix_index.without_passages(edge_rows).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_bytes == by_id[4].n_bytes == 0
    assert by_id[8].kept == b"" and by_id[8].n_spans == 1 and by_id[7].n_removed == 9000
    assert suffix_index.without_passages(no_rows).count() == 0
    cut = suffix_index.cut_documents(edge_rows)
    assert cut.columns == edge_rows.columns and cut.count() == len(ROWS)
    assert cut.where("doc_id = 3 AND text IS NULL").count() == 1


def test_levels_merge_geometrically(spark):
    family = suffix_index.SuffixIndexFamily()
    sizes = []
    for k in range(5):
        family.add(spark.createDataFrame([(k % 3, k % 3, 1), (9 + k, 9, 1)], "lead long, kh long, n long"))
        sizes.append([n for n, _ in family.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1]]
    assert sum(r.n for _, level in family.levels for r in level.collect()) == 10
    assert {(r.lead, r.kh) for r in family.hit_suffixes().collect()} == {(0, 0), (1, 1)}
    family.discard()


def test_levels_are_in_the_order_of_the_suffixes(spark):
    texts = [bytes([b]) + b"\xc3\xa9" * 400 for b in (1, 60, 127)] + [("\u00e9" * 300 + chr(0x4E00 + k)).encode() * 2 for k in range(30)]
    own, a, _, _, lead, _, _ = suffix_index.anchors(texts)
    by_lead = [texts[own[k]][a[k] : a[k] + 8] for k in np.argsort(lead.view(np.int64), kind="stable")]
    assert by_lead == sorted(by_lead)


@pytest.mark.parametrize("batches", [1, 7, None])
def test_family_on_the_given_documents(spark, monkeypatch, batches, small_documents):
    monkeypatch.setattr(suffix_index, "BATCH_ENTRIES", 500)
    texts = {k: t.encode() for k, t in small_documents.items()}
    frame = read(spark, SMALL)
    levels = []
    added = suffix_index.SuffixIndexFamily.add
    monkeypatch.setattr(suffix_index.SuffixIndexFamily, "add", lambda f, b: (added(f, b), levels.append([n for n, _ in f.levels])))
    rows = {r.doc_id: r for r in suffix_index.without_passages(frame, batches=batches).collect()}
    for k, (kept, runs) in zip(texts, plain_removal(list(texts.values()), 400), strict=True):
        assert (bytes(rows[k].kept), rows[k].n_spans) == (kept, runs)
    # As many batches as the anchors ask for, and logarithmically many levels.
    assert len(levels) == (batches or len(levels)) and (batches or len(levels) > 4)
    assert all(len(own) <= 2 + np.log2(k) for k, own in enumerate(levels, 1)) and sum(levels[-1]) == len(levels)


def test_windows_of_one_hash_are_compared_by_bytes():
    cut = [b"a" * 400, b"b" * 400, b"a" * 400, b"c" * 401]
    row, inside = np.array([0, 1, 2, 3, 3]), np.array([0, 0, 0, 0, 1])
    collided = suffix_index._equal_windows(cut, row, inside, np.full(5, 7, np.uint64))
    assert collided.tolist() == [True, False, True, True, True]
    assert suffix_index._equal_windows(cut, row, inside, np.array([1, 2, 1, 3, 4], np.uint64)).tolist() == [True, False, True, False, False]


CLASHING = ["_doc_id", "_text_hash", "_hash", "_s", "_e", "_id", "_sha", "_own", "_stays", "_near_key", "key", "key_hash", "starts",
            "ends", "own_hash", "near_key", "id", "digest", "stays", "root", "text_sha256", "kept"]


@pytest.mark.parametrize("function", [exact_dedup.without_copies, simhash.one_of_each_group, near_copies.without_near_copies, suffix_index.cut_documents])
def test_columns_of_any_name_come_back_as_they_were(spark, function):
    rows = [(1, "a b c d e f g"), (1, "A b c d e f g"), (2, "other words that are here"), (3, None), (4, "x" * 900), (5, "y" + "x" * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(map(repr, function(docs).collect()))
    wide = function(docs.withColumns({c: F.concat(F.lit(c + ":"), F.coalesce("text", F.lit("none"))) for c in CLASHING}))
    assert wide.columns == [*docs.columns, *CLASHING]
    found = wide.collect()
    before = {(r[0], r[1]) for r in rows}
    assert len(found) == len(plain)
    for r in found:
        if function is not suffix_index.cut_documents:
            assert (r.doc_id, r.text) in before
        texts = {t for k, t in rows if k == r.doc_id}
        assert all(r[c] in {f"{c}:{t if t is not None else 'none'}" for t in texts} for c in CLASHING)
        assert len({r[c][len(c) + 1 :] for c in CLASHING}) == 1


def test_line_chunks_of_edge_rows(spark, edge_rows, no_rows):
    rows = line_chunks.without_repeated_chunks(edge_rows).collect()
    assert sorted(r.text for r in rows) == sorted(t or "" for _, t in ROWS)
    assert line_chunks.without_repeated_chunks(no_rows).count() == 0
    block = [f"line {k}" for k in range(40)]
    texts = [(k, "\n".join([f"own {k}", *block[k:], f"end {k}"])) for k in range(4)]
    frame = stage(spark.createDataFrame(texts, "doc_id long, text string"), "lines")
    done = {r.doc_id: r for r in line_chunks.without_repeated_chunks(frame).collect()}
    assert done[0].text == texts[0][1]
    # Later texts lose most of the block though it is shifted in them, and keep their own lines.
    for k in (1, 2, 3):
        assert done[k].n_removed_lines > 25
        assert f"own {k}" in done[k].text and f"end {k}" in done[k].text


def test_line_chunks_run_no_python(edge_rows):
    plan = line_chunks.without_repeated_chunks(edge_rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_digest_of_whole_text(spark, small_documents):
    rows = exact_dedup.op9_exact_dedup(spark, SMALL).collect()
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), small_documents[r.doc_id])
        assert r.text_sha256 == hashlib.sha256(low.encode()).hexdigest()
