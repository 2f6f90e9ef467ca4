import random
import re

import pytest

import corpus_pipeline
from hearthlift.llm import suffix_index
from hearthlift.llm.common import stage


def plain_cut(texts, least=51):
    """Every text without the runs of `least` words that also start anywhere else."""
    places = [[m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for t in texts]
    words = [[t[a:b] for a, b in own] for t, own in zip(texts, places, strict=True)]
    seen = {}
    for own in words:
        for i in range(len(own) - least + 1):
            window = tuple(own[i : i + least])
            seen[window] = seen.get(window, 0) + 1
    out = []
    for text, own, at in zip(texts, words, places, strict=True):
        gone = [False] * len(text)
        for i in range(len(own) - least + 1):
            if seen[tuple(own[i : i + least])] > 1:
                a, b = at[i][0], at[i + least - 1][1]
                gone[a:b] = [True] * (b - a)
        # Runs that follow one another go with the white space between them.
        for i in range(len(own) - 1):
            if gone[at[i][1] - 1] and gone[at[i + 1][0]]:
                gone[at[i][1] : at[i + 1][0]] = [True] * (at[i + 1][0] - at[i][1])
        out.append("".join(c for c, g in zip(text, gone, strict=True) if not g))
    return out


def invented(rng, n, letters="abcdé"):
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(k)).split(" ") for k in n]


@pytest.mark.parametrize("classes", [8_000, 1])
def test_word_passages_against_brute_force(spark, monkeypatch, classes):
    monkeypatch.setattr(suffix_index, "TASK_CLASSES", classes)
    rng = random.Random(3)
    shared = invented(rng, [50, 51, 52, 70, 200])
    texts = ["", " \n ", "a " * 300, "日本 " * 60, "x" * 900 + " y", "x" * 900 + " z"]
    for k in range(60):
        own = invented(rng, [rng.randint(0, 90) for _ in range(3)])
        one, other = rng.choice(shared), rng.choice(shared)
        start = rng.randint(0, 12)
        # With other white space, in part, twice in a text, and right beside one another.
        parts = [own[0], one, own[1] if k % 3 else [], other[start:], own[2]]
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"] if k % 2 else [" "]) for p in parts for w in p))
    frame = stage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "word-passages")
    cut = {r.doc_id: r.text for r in suffix_index.cut_documents(frame, unit=suffix_index.WORDS).collect()}
    want = plain_cut(texts)
    assert sum(a != b for a, b in zip(texts, want, strict=True)) > 40
    assert [cut[k] for k in range(len(texts))] == want


def test_pipeline_cuts_short_passages_of_over_50_words(spark):
    rng = random.Random(8)
    long, short = (" ".join(w[:5] for w in p) for p in invented(rng, [53, 50], "abcdefgh"))
    assert len(long.encode()) < 400
    own = [[" ".join(p) for p in invented(rng, [80, 80], "abcdefgh")] for _ in range(6)]
    texts = [f"{a}\n{(long, short, 'none')[k % 3]}\n{b}" for k, (a, b) in enumerate(own)]
    rows = [(k, t, "en", "src", len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, ""), "word-passages")
    found = {r.doc_id: r for r in docs.collect()}
    assert len(found) == 6 and all(r.n_chars == len(r.text) for r in found.values())
    for k, (a, b) in enumerate(own):
        assert found[k].text == (f"{a}\n\n{b}" if k % 3 == 0 else texts[k])


def test_word_passages_of_edge_rows(edge_rows, no_rows):
    cut = suffix_index.cut_documents(edge_rows, unit=suffix_index.WORDS)
    assert cut.columns == edge_rows.columns and cut.count() == edge_rows.count()
    assert {r.text for r in cut.where("doc_id = 3").collect()} == {None}
    assert cut.where("doc_id = 7").first().text == " "
    assert suffix_index.cut_documents(no_rows, unit=suffix_index.WORDS).count() == 0


def plain_runs(texts, least=51):
    """Number of runs of words in windows of `least` that also start anywhere else, and their words."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    seen = {}
    for own in words:
        for i in range(len(own) - least + 1):
            seen[tuple(own[i : i + least])] = seen.get(tuple(own[i : i + least]), 0) + 1
    out = []
    for own in words:
        gone = [False] * len(own)
        for i in range(len(own) - least + 1):
            if seen[tuple(own[i : i + least])] > 1:
                gone[i : i + least] = [True] * least
        out.append((sum(b and not a for a, b in zip([False, *gone], gone, strict=False)), sum(gone)))
    return out


def test_suffix_query_counts_passages_of_over_50_words(spark, tmp_path):
    rng = random.Random(9)
    long, short = (" ".join(w[:5] for w in p) for p in invented(rng, [53, 50], "abcdefgh"))
    assert len(long.encode()) < 400
    own = [[" ".join(p) for p in invented(rng, [20, 60], "abcdefgh")] for _ in range(9)]
    texts = [f"{a}\n{(long, short, 'none')[k % 3]}\n{b}" for k, (a, b) in enumerate(own)]
    texts += [f"{long} {own[2][0]} {long.replace(' ', '  ')}", "a " * 300, "x" * 900 + " y", "x" * 900 + " z", " \n", ""]
    rows = [*enumerate(texts), (99, None), (None, texts[0]), (7, texts[7]), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = suffix_index.op4_suffix_dedup(spark, str(tmp_path)).collect()
    contract = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert found[0].asDict().keys() == {*contract, "n_passages", "n_passage_words"}
    plain = [t or "" for _, t in rows]
    want = [(k, len(t.encode()), *n) for (k, _), t, n in zip(rows, plain, plain_runs(plain), strict=True)]
    got = [(r.doc_id, r.n_bytes, r.n_passages, r.n_passage_words) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    # Under 400 bytes nothing is removed, as the contract has it; the passage is counted all the same.
    assert (by_id[3].n_removed, by_id[3].n_passages, by_id[3].n_passage_words) == (0, 1, 53)
    assert (by_id[4].n_passages, by_id[5].n_passages, by_id[99].n_passages) == (0, 0, 0)
    assert (by_id[9].n_passages, by_id[9].n_passage_words, by_id[10].n_passage_words) == (2, 106, 300)
    assert by_id[11].n_removed == 901 and by_id[11].n_passages == 0
