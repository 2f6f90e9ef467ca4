import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from hearthlift.llm import language_id, quality_classifier
from hearthlift.llm.common import read, stage
from hearthlift.llm.quality_rules import repetition
from tests.llm.conftest import ROWS
from tests.llm.test_dedup import plain_removal

FOLDER = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = read(spark, FOLDER)
    found = language_id.op7_language_id(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(held) > 100
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_edge_rows(edge_rows, no_rows):
    model = language_id.fit(edge_rows)
    rows = {r.doc_id: r for r in language_id.predict(edge_rows, model).collect()}
    for k in (3, 4, 5):
        assert rows[k].lang_pred == "und" and rows[k].score == 0 and rows[k].ambiguous
    assert rows[9].lang_pred == "en" and not rows[None].held_out
    assert language_id.predict(no_rows, language_id.fit(no_rows)).count() == 0
    assert {r.lang_pred for r in language_id.predict(edge_rows, language_id.fit(no_rows)).collect()} == {"und"}


def test_codewords_differ():
    for n in (1, 2, 4, 30):
        code = language_id.code_matrix(n)
        assert len({tuple(row) for row in code.tolist()}) == n


def test_quality_held_out(spark):
    labels = read(spark, FOLDER, "labels")
    found = quality_classifier.op10_quality_classifier(spark, FOLDER).join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_quality_of_edge_rows(spark, edge_rows, no_rows):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 0), (9, None), (None, 1)], "doc_id long, quality int")
    rows = quality_classifier.score(edge_rows, quality_classifier.fit(edge_rows, labels)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    unlearned = quality_classifier.fit(edge_rows, labels.where("false"))
    assert {r.score for r in quality_classifier.score(edge_rows, unlearned).collect()} == {0.5}
    assert quality_classifier.score(no_rows, unlearned).count() == 0


M64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def spread(h):
    """The mixing of 64-bit words, in plain numbers."""
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & M64
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & M64
    return h ^ h >> 32


def rolled(values):
    h = 0
    for v in values:
        h = (h * BASE + v + 1) & M64
    return h


ODD_TEXTS = ["", "a", "Ab aB", "naïve café – 日本語", "x x x y", "word\nword two", " lead", "¡Señor! ñandú 12"]


def test_languages_by_plain_decoding(spark):
    docs = read(spark, "/root/testdata/sf0.001")
    model = language_id.fit(docs)
    assert len(model.languages) > 1
    texts = ODD_TEXTS + [r.text for r in docs.orderBy("doc_id").limit(12).collect()]
    frame = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language_id.predict(frame, model).collect()}
    # Any two codewords differ in more than a bit or two, so that single wrong bits do not decide.
    code = model.code.astype(int).tolist()
    assert min(sum(x != y for x, y in zip(a, b, strict=True)) for i, a in enumerate(code) for b in code[:i]) > 2
    for k, text in enumerate(texts):
        data, counts = text.encode().lower(), {}
        for n in language_id.GRAMS:
            for i in range(len(data) - n + 1):
                bucket = spread((rolled(data[i : i + n]) + n) & M64) % language_id.BUCKETS
                counts[bucket] = counts.get(bucket, 0) + 1
        total = sum(counts.values())
        bits = [
            sum((c / total) ** 0.5 * float(model.weights[b, j]) for b, c in counts.items()) + float(model.bias[j]) for j in range(len(code[0]))
        ]
        losses = [sum(float(w) * np.logaddexp(0, -s * x) for s, x, w in zip(word, bits, model.trust, strict=True)) for word in code]
        if not any(map(str.isalpha, text)):
            assert (found[k].lang_pred, found[k].score, found[k].ambiguous) == ("und", 0, True)
            continue
        best = losses.index(min(losses))
        lead = sorted(losses)[1] - min(losses)
        assert found[k].lang_pred == model.languages[best]
        assert abs(found[k].score - 1 / sum(np.exp(min(losses) - x) for x in losses)) < 1e-4
        assert found[k].ambiguous == (lead < language_id.AMBIGUOUS) or abs(lead - language_id.AMBIGUOUS) < 1e-4


def plain_features(text):
    """Buckets of all words, pairs of neighbours and character n-grams."""
    out = []
    for n in quality_classifier.GRAMS:
        out += [spread((rolled(map(ord, text[i : i + n])) + n) & M64) for i in range(len(text) - n + 1)]
    words = [spread(sum((c + 1) * pow(BASE, i, 1 << 64) for i, c in enumerate(w)) & M64) for w in text.encode().split()]
    out += [spread((w + 100) & M64) for w in words]
    out += [spread(((1 if a == b else a * 3 + b) + 200) & M64) for a, b in zip(words, words[1:], strict=False)]
    return [h % quality_classifier.BUCKETS for h in out]


def test_quality_by_plain_scoring(spark):
    docs, labels = read(spark, "/root/testdata/sf0.001"), read(spark, "/root/testdata/sf0.001", "labels")
    model = quality_classifier.fit(docs, labels)
    texts = ODD_TEXTS + [r.text for r in docs.orderBy("doc_id").limit(8).collect()]
    own, bucket = quality_classifier.buckets([t.encode() for t in texts])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in quality_classifier.score(frame, model).collect()}
    for k, text in enumerate(texts):
        want = plain_features(text)
        assert sorted(bucket[own == k].tolist()) == sorted(want)
        mean = sum(float(model.logit[b]) for b in want) / max(len(want), 1)
        assert abs(found[k] - 1 / (1 + np.exp(-(mean + model.bias)))) < 1e-6


def test_an_id_on_many_rows_sends_one_row_to_the_driver(spark):
    rows = [(1, f"hello there {k}", "en") for k in range(500)] + [(3, "hola que tal", "es"), (4, "buenos dias", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    one = spark.createDataFrame([min(rows[:500], key=lambda r: 0), *rows[500:]], docs.schema)
    assert language_id.fit(docs).languages == language_id.fit(one).languages == ("en", "es")
    first, again = language_id.fit(docs), language_id.fit(docs.repartition(9))
    assert (first.weights == again.weights).all()
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0)], "doc_id long, quality int")
    assert (quality_classifier.fit(docs, labels).logit == quality_classifier.fit(docs.repartition(9), labels).logit).all()


def test_pipeline_stages(spark):
    docs = read(spark, FOLDER)
    columns, before = docs.columns, None
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, FOLDER), "pipeline-test")
        if name == "quality rules":
            kept = {r.doc_id for r in repetition(before).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == kept
        if name == "exact dedup":
            best = {}
            for r in before.collect():
                low = r.text.encode().lower()
                best[low] = max(r.doc_id, best.get(low, -1))
            assert {r.doc_id for r in docs.collect()} == set(best.values())
        if name == "suffix-array dedup":
            assert docs.count() == before.count() and docs.where("n_chars <> length(text)").count() == 0
            given = {r.doc_id: r.text.encode() for r in before.collect()}
            plain = dict(zip(given, plain_removal(list(given.values()), 400), strict=True))
            for r in docs.collect():
                # Cut at whole characters, so a few bytes more stay at the edges of a run.
                assert 0 <= len(r.text.encode()) - len(plain[r.doc_id][0]) <= 6 * plain[r.doc_id][1]
        if name != "packing":
            assert docs.columns == columns
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in docs.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    texts = {r.doc_id: r.text for r in before.collect()}
    assert pieces.keys() == texts.keys()
    for k, own in pieces.items():
        ids, at = np.array([*library.encode(texts[k], add_special_tokens=False).ids, 1], "<u4"), 0
        for start, length, crc in sorted(own):
            assert start == at and zlib.crc32(ids[at : at + length].tobytes()) == crc
            at += length
        assert at == len(ids)
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_edge_rows(spark, edge_rows, no_rows):
    for rows in (edge_rows, no_rows):
        docs = rows
        for _, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, FOLDER), "pipeline-edge")
        assert docs.count() >= 0
