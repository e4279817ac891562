"""Token ids of whole texts by the tokenizers library, with each distinct word encoded once a worker.

A text is cut where the tokenizer itself always cuts (before a space that follows a word; between a word and the
punctuation that ends it), so the ids of the pieces, joined, are the ids of the text. Pieces are kept in a bounded
cache that outlives the task, because most words of a text occur in others. A text with unusual white space or with the
content of an added token (which the tokenizer takes as that token), and any text under a tokenizer of another kind, is
encoded whole.
"""

from __future__ import annotations

import array
import json
import os
import re
from functools import lru_cache

#: Entries of a worker's cache of encoded pieces; when full it starts afresh.
CACHE = 500_000
LONG_PIECE = 64

LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
WIDE = re.compile("[^\x00-\xff]")
CUTS = {
    "byte": re.compile(rf" ?[{LATIN}]++(?![^\s.,])|[.,]++(?!\S)| ?\S++|\s+(?!\S)|\s+"),
    "word": re.compile(rf"[{LATIN}]++(?![^\s.,])|[.,]++(?!\S)|\S++"),
}
SIMPLE, UPPER = re.compile(rf" ?[{LATIN}]+"), re.compile("[A-ZÀ-ÖØ-Þ]")
#: The settings by which the two kinds of tokenizers are recognised.
BYTE_KIND = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WORD_KIND = ["NFC", "Replace", "Lowercase"]


def resolve(path: str) -> str:
    """A name among the installed public vocabularies, or a path of one's own."""
    if os.path.isabs(path):
        return path
    import public_tokenizers

    return str(public_tokenizers.path(path))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(resolve(path))
        added = {t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content}
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.kind = self._kind()
        self.cut = CUTS.get(self.kind)
        self.cache: dict[str, bytes] = {}
        # the byte alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.space = self.letters[0x20]

    def _kind(self) -> str:
        said = json.loads(self.tokenizer.to_str())
        normal, pre = said.get("normalizer"), said.get("pre_tokenizer") or {}
        if normal is None and all(pre.get(k) == v for k, v in BYTE_KIND.items()):
            return "byte"
        if normal and [x["type"] for x in normal.get("normalizers", [])] == WORD_KIND and pre.get("pretokenizers", [{}])[0].get("behavior") == "Removed":
            return "word"
        return "whole"

    def size(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _encode(self, pieces: list[str]) -> list[bytes]:
        return [array.array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Put pieces into the cache. One of Latin letters alone is a single unit for the tokenizer: its model takes it as it is, spelt in the byte alphabet."""
        other, cache, tokenize, spell = [], self.cache, self.tokenizer.model.tokenize, self.kind == "word"
        for p in pieces:
            if p.isascii():
                word = p if spell else p.replace(" ", self.space)
            else:
                word = "".join([self.letters[b] for b in p.encode()])
            if SIMPLE.fullmatch(p) and not (spell and UPPER.search(p)):
                cache[p] = array.array("I", [t.id for t in tokenize(word)]).tobytes()
            else:
                other.append(p)
        cache.update(zip(other, self._encode(other), strict=True))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.cut is None or ODD_SPACE.search(text) or (self.added and self.added.search(text.lower())):
            return self._encode([text])[0]
        if self.kind == "word" and not WIDE.search(text):
            text = text.lower()
        pieces, cache = self.cut.findall(text), self.cache
        new = set(pieces).difference(cache)
        if new:
            self._learn(list(new))
        out = b"".join(map(cache.__getitem__, pieces))
        if len(cache) > CACHE:
            cache.clear()
        elif new:
            for p in new:
                if len(p) > LONG_PIECE:
                    del cache[p]
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return Encoder(path)
