import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import AddedToken, Tokenizer

from hearthlift.llm import packing, token_files
from hearthlift.llm.common import scratch
from hearthlift.llm.token_ids import text_encoder

JSON = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    f"end of one{END}next", END, END * 3, f" \n{END}\n x", f"it'{END}s  {END} ", "none here", "", "<|ENDOFTEXT|>",
    f"<|endoftext{END}|>", f"é{END}日本 ½", f"word {END}",
]


@pytest.fixture(scope="module")
def ids():
    """Ids by a tokenizer that nothing has been set on."""
    library = Tokenizer.from_file(JSON)
    return lambda text: library.encode(text, add_special_tokens=False).ids


def test_added_tokens_have_their_own_ids(ids):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice([END, "a", " ", "\n", "'s", "1", "."]) for _ in range(20)) for _ in range(500)]
    assert [x.tolist() for x in text_encoder(JSON).encode(texts)] == [ids(t) for t in texts]
    assert text_encoder(JSON).encode(TEXTS[:1])[0].tolist() == [437, 286, 530, 50256, 19545]
    assert text_encoder(JSON).encode([]) == []


def test_added_tokens_of_other_kinds(tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    for kinds in ([AddedToken("<a>"), AddedToken("<a><b>")], [AddedToken("<c>", lstrip=True, rstrip=True)]):
        tokenizer.add_tokens(kinds)
        tokenizer.save(str(tmp_path / f"{len(kinds)}.json"))
        texts = [f"x <a><b> y <a> {END}z <c>  q<a", "plain", " <c> ", "<a><a><b>"]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in text_encoder(str(tmp_path / f"{len(kinds)}.json")).encode(texts)] == want


def test_queries_operators_give_the_libraries_ids(spark, ids):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    folder = scratch(spark, "tokens")
    files = token_files.read_token_files(token_files.write_token_files(docs, folder, JSON, shards=2), folder)
    at = 0
    for r in sorted(files.collect(), key=lambda r: r.doc_id):
        own = np.array(ids(TEXTS[r.doc_id]) + [token_files.END_ID], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    packed = {}
    for r in sorted(packing.pack(docs, JSON, with_ids=True).collect(), key=lambda r: (r.doc_id, r.start)):
        packed[r.doc_id] = packed.get(r.doc_id, b"") + r.ids
    assert packed == {k: np.array(ids(t) + [packing.END_ID], "<u4").tobytes() for k, t in enumerate(TEXTS)}
