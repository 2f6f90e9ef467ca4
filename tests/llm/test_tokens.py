import base64
import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from hearthlift.llm import bpe, packing, pretokens, token_files
from hearthlift.llm.common import scratch
from hearthlift.llm.token_ids import TextEncoder
from tests.llm.conftest import ROWS

SMALL = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    letters = "ab s'trevlmdSTRE 1½\n\t  é.,!’ñ日ー́٣​\x85Ᲊ\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    return [*texts, "a" * 3000 + " " + "xyz" * 1000, "<|endoftext|> x", " ", "", "''s's're'll", "\n's x 's"]


def test_pretokens_equal_the_pattern(odd_texts):
    known = [t for t in odd_texts if "Ᲊ" not in t]
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert pretokens.split(known) == [pattern.findall(t) for t in known]
    assert pretokens.split([]) == [] and pretokens.split([""]) == [[]]


def test_ids_equal_the_libraries(odd_texts, library):
    assert [x.tolist() for x in TextEncoder(JSON).encode(odd_texts)] == [library(t) for t in odd_texts]
    coder = bpe.RankEncoder(RANKS)
    other = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text, ids in zip(odd_texts, coder.encode(odd_texts), strict=True):
        assert ids.tolist() == other.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
        ends = coder.ends(ids)
        cut = text.encode()[ends[0] : ends[-1]] if len(ids) > 1 else b""
        assert cut == coder.decode(ids[1:])


def test_bpe_of_edge_rows(edge_rows, no_rows):
    rows = bpe.decode(bpe.encode(edge_rows, RANKS), RANKS).collect()
    assert sorted(r.decoded for r in rows) == sorted((t or "").encode() for _, t in ROWS)
    assert bpe.decode(bpe.encode(no_rows, RANKS), RANKS).count() == 0


def test_op6_query(spark, small_documents):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.op6_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(small_documents)
    for r in rows:
        ids = coder.encode_ordinary(small_documents[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(small_documents[r.doc_id].encode()).hexdigest()


def check_packing(rows, want, limits):
    """Every id once, sequences without gaps and within limits; returns the padding."""
    own = sorted(zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in want)
    assert sorted(zlib.crc32(b"".join(r.ids for r in doc)) for doc in pieces_by_document(rows)) == own
    sequences = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(parts) <= limits.segments
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


def pieces_by_document(rows):
    """Pieces that follow one another; equal documents have equal pieces, so any of them will do."""
    left = sorted(rows, key=lambda r: (str(r.doc_id), r.start, r.sequence_id, r.offset))
    while left:
        doc, at = [], 0
        total, key = left[0].doc_tokens, left[0].doc_id
        while at < total:
            k = next(i for i, r in enumerate(left) if (r.doc_id, r.start, r.doc_tokens) == (key, at, total))
            doc.append(left.pop(k))
            at += doc[-1].length
        yield doc


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 20), packing.Limits(16, 1, 16)])
def test_packing_of_edge_rows(edge_rows, no_rows, library, limits):
    distinct = edge_rows.dropDuplicates(["doc_id", "text"])
    rows = packing.pack(distinct, JSON, limits, with_ids=True).collect()
    want = [library(t) + [1] for _, t in {(k, t): 0 for k, t in ROWS}]
    assert check_packing(rows, want, limits) == 0
    assert packing.pack(no_rows, JSON).count() == 0


def test_packing_keeps_the_loss_limit():
    limits = packing.Limits(100, 5, 30)
    packer, done = packing.Packer(limits), []
    rng = np.random.default_rng(0)
    items = [(k, int(rng.integers(1, 250)), int(rng.integers(0, 200))) for k in range(1500)]
    running = {k: np.maximum(np.arange(n + 1) - min(prompt, n), 0) for k, n, prompt in items}
    for k, n, _ in items:
        done += packer.add(k, n, running[k])
    done += packer.finish()
    assert sum(n for s in done for _, _, n in s) == sum(n for _, n, _ in items)
    for sequence in done:
        assert sum(n for _, _, n in sequence) <= 100
        assert len(sequence) <= 5
        assert sum(running[k][a + n] - running[k][a] for k, a, n in sequence) <= 30


def test_op2_query(spark, small_documents, library):
    rows = packing.op2_vector_packing(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(small_documents)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, text in small_documents.items():
        ids, at = np.array(library(text) + [packing.END_ID], "<u4"), 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)]).tolist()
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
        assert ends[-1] == 2048 or ends[-1] & (ends[-1] - 1) == 0  # nothing is padded


def test_elias_fano_returns_what_it_got():
    rng = np.random.default_rng(2)
    for values in ([], [0], [0, 0, 0], [5], np.sort(rng.integers(0, 10**6, 3000)), np.arange(5000), [0, 2**40]):
        values = np.array(values, np.uint64)
        coded = token_files.EliasFano.of(values)
        again = token_files.EliasFano.read(io.BytesIO(coded.to_bytes()))
        assert again.get(np.arange(len(values))).tolist() == values.tolist()
    dense = token_files.EliasFano.of(np.sort(rng.integers(0, 10**6, 3000)))
    assert len(dense.to_bytes()) * 8 < 3000 * (2 + np.log2(10**6 / 3000) + 1) + 300


def test_token_files_of_edge_rows(spark, edge_rows, no_rows, library, monkeypatch):
    folder = scratch(spark, "tokens")
    files = token_files.write_token_files(edge_rows, folder, JSON, shards=3)
    rows = sorted(token_files.read_token_files(files, folder, with_ids=True).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32
        at += r.n_tokens
    keys = [r.doc_id for r in rows]
    assert keys == sorted((k for k, _ in ROWS), key=lambda k: (k is not None, k))
    want = sorted(np.array(library(t) + [0], "<u4").tobytes() for _, t in ROWS)
    assert sorted(r.ids for r in rows) == want
    # By default as many shards as the characters need; a range of documents is read at a time.
    monkeypatch.setattr(token_files, "SHARD_CHARACTERS", 4_000)
    monkeypatch.setattr(token_files, "READ_DOCUMENTS", 2)
    folder = scratch(spark, "tokens")
    more = token_files.write_token_files(edge_rows, folder, JSON)
    assert more.count() > 2
    again = sorted(token_files.read_token_files(more, folder, with_ids=True).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in again] == [(r.doc_id, r.start, r.n_tokens) for r in rows]
    empty = token_files.write_token_files(no_rows, scratch(spark, "tokens"), JSON, shards=2)
    assert token_files.read_token_files(empty, folder).count() == 0


def test_op5_query(spark, small_documents, library):
    rows = {r.doc_id: r for r in token_files.op5_token_files(spark, SMALL).collect()}
    at = 0
    for k, text in small_documents.items():
        ids = np.array(library(text) + [0], "<u4")
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
