import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hearthlift.llm import bin_slack
from hearthlift.llm.bin_slack import LIMIT, SlackPacker, pack_by_slack

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids():
    library = Tokenizer.from_file(JSON)
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, bin_slack.END_ID]


def fullest(lengths, limit):
    """Best filling by any combination of open pieces that has the longest one."""
    longest, *others = sorted(lengths, reverse=True)
    sums = {longest}
    for n in others:
        sums |= {s + n for s in sums if s + n <= limit}
    return max(sums)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=25))
def test_every_bin_is_the_fullest_of_what_is_left(lengths):
    left = dict(enumerate(lengths))
    for bin_ in SlackPacker(np.array(lengths, np.int64), 30).bins():
        assert sum(left[k] for k in bin_) == fullest(left.values(), 30)
        for k in bin_:
            del left[k]
    assert not left


def test_of_equal_fillings_the_longest_pieces_go_first():
    assert next(SlackPacker(np.array([5, 5, 3, 7, 10, 2, 8]), 10).bins()) == [4]
    assert next(SlackPacker(np.array([5, 5, 3, 7, 2, 1]), 10).bins()) == [3, 2]
    assert list(SlackPacker(np.array([5, 5, 5]), 10).bins()) == [[0, 1], [2]]


def test_few_bins_on_many_lengths():
    rng = random.Random(4)
    lengths = np.array([min(LIMIT, int(rng.lognormvariate(5, 1)) + 1) for _ in range(20_000)])
    bins = list(SlackPacker(lengths, LIMIT).bins())
    assert sorted(itertools.chain(*bins)) == list(range(len(lengths)))
    assert len(bins) <= -(-lengths.sum() // LIMIT) + 1


def checked(rows, docs, ids, limit):
    """The contract of a packing, for documents whose ids and texts are `docs`."""
    sequences, own = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        own.setdefault(r.doc_id, []).append(r)
    for places in sequences.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [0, *ends[:-1]] == sorted(a for a, _ in places) and ends[-1] <= limit
    for key, texts in itertools.groupby(sorted(docs, key=repr), key=lambda d: d[0]):
        want = []
        for _, text in texts:
            found = ids(text)
            bounds = [0, *range(len(found) % limit or limit, len(found) + 1, limit)]
            want += [
                (k, a, b - a, zlib.crc32(np.array(found[a:b], "<u4").tobytes()))
                for k, (a, b) in enumerate(itertools.pairwise(bounds))
            ]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in own[key]) == sorted(want)
    return sequences


def test_edge_rows(edge_rows, ids):
    docs = [(r.doc_id, r.text) for r in edge_rows.collect()]
    for limit in (LIMIT, 16, 1):
        sequences = checked(pack_by_slack(edge_rows, JSON, limit).collect(), docs, ids, limit)
        assert len(sequences) >= -(-sum(len(ids(t)) for _, t in docs) // limit)


def test_no_rows(no_rows):
    assert pack_by_slack(no_rows, JSON).collect() == []


def test_clashing_names(edge_rows):
    names = ["piece", "start", "length", "number", "grp", "sequence_id", "offset", "ids_crc32"]
    wide = pack_by_slack(edge_rows.withColumns({c: F.lit("x") for c in names}), JSON)
    plain = pack_by_slack(edge_rows, JSON)
    assert wide.columns == plain.columns
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(repr, wide.select(own).collect())) == sorted(map(repr, plain.select(own).collect()))


def test_op13_query(spark, small_documents, ids):
    from hearthlift.llm.bin_slack import op13_minimum_bin_slack

    rows = op13_minimum_bin_slack(spark, "/root/testdata/sf0.001").collect()
    sequences = checked(rows, list(small_documents.items()), ids, LIMIT)
    assert len(sequences) <= -(-sum(r.length for r in rows) // LIMIT) + 2


def test_groups_are_of_bounded_size_and_whole(spark, small_documents, ids):
    docs = spark.createDataFrame(list(small_documents.items()), "doc_id long, text string").repartition(5)
    rows = pack_by_slack(docs, JSON, group_tokens=8 * LIMIT, with_ids=True).collect()
    sequences = checked(rows, list(small_documents.items()), ids, LIMIT)
    total = sum(r.length for r in rows)
    assert len({s >> 32 for s in sequences if s >= 0}) > 1
    assert len(sequences) <= 1.2 * total / LIMIT
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_an_id_with_a_third_of_all_rows(spark, ids):
    docs = [(7 if k % 3 == 0 else k, "one two three" if k % 3 == 0 else f"text {k}") for k in range(3000)]
    rows = pack_by_slack(spark.createDataFrame(docs, "doc_id long, text string"), JSON, group_tokens=4096).collect()
    checked(rows, docs, ids, LIMIT)
    sizes = {}
    for r in rows:
        sizes[r.sequence_id >> 32] = sizes.get(r.sequence_id >> 32, 0) + 1
    assert max(sizes.values()) < 1.5 * len(rows) / len(sizes)
