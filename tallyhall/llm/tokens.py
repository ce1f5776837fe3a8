"""Token ids of whole texts by a public tokenizer, with bounded caches.

White space separates words in the tokenizer's normaliser, so ids can be
looked up word by word. A word met before costs one dictionary lookup. A new
word below U+0250 is put together from its lower-case pre-tokens, which have a
cache of their own: words are many, as case and punctuation differ, pre-tokens
fewer. Only a new pre-token goes to the tokenizer's model; every other new
word goes through the whole tokenizer. Texts with the four control
characters that Python, but not the tokenizer, takes for white space are
encoded whole. The ids equal ``encode(text, add_special_tokens=False)`` with
special strings read as ordinary text; the tests compare both.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from tallyhall.llm.common import kept

#: Words kept per Python worker before the cache starts anew.
CACHE_WORDS = 400_000
#: Pre-tokens kept per Python worker, twice: the newest, and those before them.
CACHE_PARTS = 250_000
#: Longer words and pre-tokens are encoded but not kept.
CACHE_CHARS = 48

_ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: Beyond the plain letters, or with a small letter that is.
_BEYOND = re.compile("[^\x00-\u024f]|[" + "".join(c for c in map(chr, range(0x250)) if max(c.lower()) > "ɏ") + "]")
#: Pre-tokens of lower-case plain words.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ɏ0-9²³¹¼½¾]+")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level pre-tokenisation gives each byte:
    printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    out = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [out[b] for b in range(256)]


class PartIds(dict):
    """Lower-case pre-token of plain letters -> its ids."""

    def __init__(self, model):
        super().__init__()
        self.model, self.before = model, {}
        self.letters = dict(enumerate(_byte_letters()))

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            own = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            ids = array("i", [t.id for t in self.model.tokenize(own)]).tobytes()
        if len(part) <= CACHE_CHARS:
            if len(self) >= CACHE_PARTS:
                self.before = dict(self)
                self.clear()
            self[part] = ids
        return ids


class WordIds(dict):
    """word -> its ids as little-endian int32 bytes."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = PartIds(self.tokenizer.model)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.I)
        # most texts have no beginning of one, which is soon seen where case does not matter
        self.starts = {a[:2] if a[:2].upper() == a[:2].lower() else "" for a in added}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isascii() or not _BEYOND.search(word):  # pre-tokens are encoded independently
            low = word.lower()
            if low.isalpha():
                ids = self.parts[low]
            elif (head := low[:-1]).isalpha():  # and one mark or digit
                ids = self.parts[head] + self.parts[low[-1]]
            else:
                ids = b"".join(map(self.parts.__getitem__, _PARTS.findall(low)))
        else:
            ids = self.whole(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(c in text for c in _ODD_SPACE) or any(s in text for s in self.starts) and self.added.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


def encoder(path: str) -> WordIds:
    """The worker's encoder for a tokenizer file; kept between tasks, until
    another operator's task comes."""
    return kept(path, lambda: WordIds(path))


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
