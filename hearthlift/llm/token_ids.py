"""Token ids by the tokenizers library, with the ids of pre-tokens seen before kept per worker."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from struct import pack

import numpy as np

from hearthlift.llm import pretokens
from hearthlift.llm.word_table import WordTable

# Entries at which a worker's table of pre-tokens is emptied, some 100 MB. It only saves time.
KEPT_WORDS = 600_000
GAP, JOINED_WORDS = "\0", 512


class KeptIds:
    """Ids of pre-tokens as packed bytes; those not seen before are encoded together, in one call."""

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.kept: dict[str, bytes] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        words, ranges = pretokens.split_all(texts)
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        kept, kind = self.kept, self.dtype.char
        found = list(map(kept.get, words))
        missed = [i for i, ids in enumerate(found) if ids is None]
        new = list({words[i] for i in missed})
        for word, ids in zip(new, self.encode_words(new), strict=True):
            kept[word] = pack(f"<{len(ids)}{kind}", *ids)
        for i in missed:
            found[i] = kept[words[i]]
        return [np.frombuffer(b"".join(found[a:b]), self.dtype) for a, b in ranges]


class TextEncoder:
    """The ids that Tokenizer.encode(text, add_special_tokens=False) gives for whole texts with
    encode_special_tokens, that is, with special tokens in a text taken as ordinary characters.

    The library encodes every distinct pre-token; it applies the same pattern to a text, so that the ids of
    a text are those of its pre-tokens one after the other. Those seen before are looked up as arrays.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        def splitting(*before):
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            tokenizer.pre_tokenizer = Sequence([*before, ByteLevel(add_prefix_space=False, use_regex=False)])
            return tokenizer

        self.tokenizer = splitting()
        # Words come joined by GAP, so that one call encodes many; the gap's own id tells them apart again.
        self.joined = splitting(Split(GAP, "isolated"))
        (self.gap,) = self.joined.encode(GAP, add_special_tokens=False).ids
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.table = WordTable(self.dtype, self.encode_words)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        ids, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for a in range(0, len(words), JOINED_WORDS):
            part = words[a : a + JOINED_WORDS]
            (done,) = self.joined.encode_batch_fast([GAP.join(part)], add_special_tokens=False)
            found = np.array(done.ids, self.dtype)
            gaps = np.flatnonzero(found == self.gap)
            if len(gaps) == len(part) - 1:
                ids.append(np.delete(found, gaps))
                counts.append(np.diff(np.append(gaps, len(found)), prepend=-1) - 1)
            else:  # a word has a gap in it
                each = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                ids += [np.array(x, self.dtype) for x in each]
                counts.append(np.array([len(x) for x in each]))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        data, starts, sizes, cut = pretokens.byte_slices(texts)
        ids, ends = self.table.ids(data, starts, sizes)
        stops = np.concatenate([[0], ends])[cut].tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops, strict=False)]


class AddedTokenEncoder(TextEncoder):
    """The ids that Tokenizer.encode(text, add_special_tokens=False) gives for whole texts by an unmodified tokenizer.

    The library finds its added tokens before it applies the pattern, of those that begin at one place the
    longest, and encodes what lies between them as texts of their own. Texts with added tokens that take in or
    ask for certain neighbours are left to the library.
    """

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer

        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: self.dtype.type(k) for k, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        plain = not any(t.single_word or t.lstrip or t.rstrip for t in added.values())
        self.library = None if plain else Tokenizer.from_file(path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        holds = [k for k, text in enumerate(texts) if any(content in text for content in self.added)]
        if not holds:
            return super().encode(texts)
        # Parts of a text with added tokens take turns: what lies between them, and they themselves.
        parts = {k: self.pattern.split(texts[k]) if self.library is None else [] for k in holds}
        own = [text for k, text in enumerate(texts) for text in (parts[k][::2] if k in parts else [text])]
        found, out = iter(super().encode(own)), []
        for k, text in enumerate(texts):
            if k not in parts:
                out.append(next(found))
            elif self.library is not None:
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype))
            else:
                pieces = [next(found)]
                for content in parts[k][1::2]:
                    pieces += [np.array([self.added[content]], self.dtype), next(found)]
                out.append(np.concatenate(pieces))
        return out


@lru_cache(2)
def text_encoder(path: str) -> AddedTokenEncoder:
    """One encoder per worker and vocabulary file."""
    return AddedTokenEncoder(path)
