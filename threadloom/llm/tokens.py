"""Token ids of a public byte-level vocabulary, as the ``tokenizers`` library gives them.

The library cuts a text into words and encodes every word by itself. Words repeat, so each process remembers the
ids of short ones and asks the library for new ones only, many at once. Cutting is done by a pattern whose classes of characters are
held against the library's own: ``Encoder`` asks it for every character below ``KNOWN``. A text with a character
from there on or of another class, and one that holds the string of a special token, is encoded by the library in one
go. Both ways give the same ids.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa

VOCABULARY = "byte_bpe_50k.json"
#: Characters from here on are not looked up; texts with one are left to the library.
KNOWN = 0x3000
#: Longer words are not remembered.
SHORT = 48
#: Words remembered in a process, some 190 MB; beyond that the later half, the rarer words, is forgotten.
REMEMBERED = 600_000
#: Characters of the texts that are encoded together, and texts of a column that are taken out of it at once.
TOGETHER = 1 << 20
TAKEN = 256
# Fixed value: how the vocabulary cuts words; letters, digits and others as the re module knows them.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


class Encoder:
    """Gives the ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # No word is sent to the library twice while it is remembered here, so its own memory of words only costs time.
        if hasattr(self.library.model, "_resize_cache"):
            self.library.model._resize_cache(0)
        self.words: dict[str, bytes] = {}
        self.cut = re.compile(WORD).findall
        added = self.library.get_added_tokens_decoder()
        self.special = [token.content for token in added.values()]
        plain = [k for k, token in added.items() if not (token.lstrip or token.rstrip or token.single_word)]
        self.between = min(plain, default=None)  # the token that parts the new words
        odd = [re.escape(chr(c)) for c in range(KNOWN) if self._odd(chr(c))]
        self.odd = re.compile(f"[{''.join(odd)}{chr(KNOWN)}-{chr(0x10FFFF)}]").search

    def _odd(self, char: str) -> bool:
        """Whether the library puts a character into another class than the pattern does."""
        theirs = self.library.pre_tokenizer.pre_tokenize_str
        probes = [f"{before}{char}{before}" for before in "a1! "]
        return any([end - at for _, (at, end) in theirs(probe)] != list(map(len, self.cut(probe))) for probe in probes)

    def whole(self, text: str) -> bytes:
        """The library's ids of a text in one go."""
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _each(self, words: list[str]) -> list[bytes]:
        """The library's ids of every word. All words are encoded in one go, parted by a special token, which the library cuts out first."""
        string = "" if self.between is None else self.library.id_to_token(self.between)
        line = string.join(words)
        if not string or line.count(string) != len(words) - 1:
            found = self.library.encode_batch_fast(words, add_special_tokens=False)
            return [array("I", item.ids).tobytes() for item in found]
        ids = array("I", self.library.encode_batch_fast([line], add_special_tokens=False)[0].ids)
        at = (np.flatnonzero(np.frombuffer(ids, np.uint32) == self.between) * ids.itemsize).tolist()
        held = ids.tobytes()
        return [held[start:end] for start, end in zip([0, *(k + ids.itemsize for k in at)], [*at, len(held)], strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED:
            self.words = dict(islice(self.words.items(), REMEMBERED // 2))
        known = self.words
        cut = [self.cut(text) for text in texts]
        new = list(set(chain.from_iterable(cut)).difference(known))
        odd = {word for word in new if self.odd(word)} if new and self.odd("".join(new)) else set()
        known.update(zip(new, self._each(new), strict=True))
        encoded = [
            self.whole(text)
            if any(string in text for string in self.special) or (odd and not odd.isdisjoint(words))
            else b"".join(map(known.__getitem__, words))
            for text, words in zip(texts, cut, strict=True)
        ]
        for word in new:
            if len(word) > SHORT or word in odd:  # an odd word must be seen as one again
                del known[word]
        return encoded

    def encode_column(self, column: pa.Array, end: bytes = b"") -> Iterator[bytes]:
        """The ids of the texts of a column, each with ``end`` behind it; null is empty."""
        held, size = [], 0
        for at in range(0, len(column), TAKEN):
            for text in column.slice(at, TAKEN).to_pylist():
                held.append(text or "")
                size += len(held[-1])
                if size > TOGETHER:
                    yield from (ids + end for ids in self.encode_all(held))
                    held, size = [], 0
        yield from (ids + end for ids in self.encode_all(held))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The process's encoder of a vocabulary file."""
    pa.default_memory_pool().release_unused()  # the process may have served other stages before
    return Encoder(path)
