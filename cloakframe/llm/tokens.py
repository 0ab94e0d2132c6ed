"""Token ids of whole texts by a public tokenizer, with a bounded cache of words per Python worker.

The tokenizer lower-cases, drops white space and never joins what stands on either side of it, so a
text's ids are those of its white-space separated words, one after another.  It also splits
letters from anything else, so a plain word goes straight to the tokenizer's model, without the
regular expressions in front of it; any other word goes through the whole tokenizer.  The tests
compare the ids with those of whole texts.
"""

from __future__ import annotations

import os

import numpy as np

#: Words that a worker remembers; beyond that it forgets all and begins anew.
CACHE_WORDS = 400_000
#: Punctuation that the tokenizer splits from the letters before it.
_TAIL = b".,;:!?"

_OF_PATH: dict[str, "WordTokens"] = {}


def _byte_letters() -> str:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in plain else chr(next(rest)) for b in range(256))


_LETTERS = _byte_letters()


class WordTokens(dict):
    """Words, lower-cased in ASCII, and their ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    @classmethod
    def at(cls, path: str) -> "WordTokens":
        if path not in _OF_PATH:
            _OF_PATH[path] = cls(path)
        return _OF_PATH[path]

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(_TAIL)
        if stem.isalpha() and len(stem) < len(word):  # ASCII letters, then punctuation
            ids = self[stem] + self[word[len(stem) :]]
        elif stem.isalpha():
            ids = self._letters(stem.decode())
        else:
            text = word.decode()
            # characters below U+0180 are composed, and lower-case letters among them stay as they are
            plain = text.isalpha() and text == text.lower() and max(text) < "ƀ"
            ids = self._letters(word.decode("latin-1").translate(_LETTERS)) if plain else self._whole(text)
        self[word] = ids
        return ids

    def _letters(self, word: str) -> bytes:
        return np.array([x.id for x in self.model.tokenize(word)], dtype="<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > CACHE_WORDS:
            self.clear()
        ids = self.__getitem__
        # lower case could make a special token of other text
        return [b"".join(map(ids, (t if b"<|" in t else t.lower()).split())) for t in texts]
