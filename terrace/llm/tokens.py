"""Token ids of a word-end BPE vocabulary, pre-token by pre-token.

The vocabulary file splits a text into pre-tokens and merges each on its own, so the ids
of a text are the ids of its pre-tokens in a row. No pre-token holds white space, so the
same is true of the words between white space, which is the unit remembered here. A word of
several pre-tokens is put together from theirs, remembered in the same way: most words with
a comma or a bracket are then no news.

``TokenTable`` reads the rules from the file and proves, once per process and by the
library itself, which vocabulary strings encode alone as exactly one token. A pre-token
among those needs no merging; any other is merged by the library's model.

Only texts of well-known characters take this way. A text with a special token's string
or any character outside ``OTHER``'s blocks goes to the library as a whole.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from terrace.llm.common import worker

#: Words whose ids, or their number, a process remembers, about 80 MB.
REMEMBERED = 400_000

#: A character that is not ASCII, Latin, Greek, Cyrillic, general punctuation or currency,
#: or one of those whose class or lower case differs between engines or depends on its
#: neighbours: information separators, fractions and superscripts, capital dotted I, sigma.
OTHER = re.compile(
    "[^\x01-\x1b\x20-įı-ʯͰ-ͳͶͷͻ-ͿΈ-Ί"
    "ΌΎ-ΡΤ-ϿЀ-ҁҊ-ԯ‐-‧‰-⁞₠-₿]"
    "|[\x85\xb2\xb3\xb9\xbc-\xbeΣς]"
).search

#: The file's split pattern, and the same for the characters that ``OTHER`` leaves, in terms
#: of Python's classes. The alternatives begin with different characters, so order is free.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile(r"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|_)+").findall


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the letters from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


class _Memo(dict):
    """Values of words, put together from those of their pieces when first asked for; forgotten together when too many."""

    def __init__(self, of_piece, join):
        super().__init__()
        self.of_piece, self.join = of_piece, join

    def __missing__(self, word: str):
        if len(self) >= REMEMBERED:
            self.clear()
        # A word of letters alone is one piece.
        if word.isalpha() or len(pieces := PIECES(word)) == 1:
            value = self.of_piece(word)
        else:
            value = self.join(map(self.__getitem__, pieces))
        self[word] = value
        return value


@lru_cache
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


class TokenTable:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        kinds = [n["type"] for n in rules["normalizer"]["normalizers"]]
        split = rules["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["pattern"]["Regex"] != SPLIT:
            raise ValueError(f"{path} does not split texts the way this module reproduces")
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.specials = [t["content"] for t in rules["added_tokens"]]
        self.proved = self._prove(rules["model"]["vocab"], rules["model"]["end_of_word_suffix"])
        self.counts = _Memo(lambda piece: len(self.piece_ids(piece)), sum)
        self.bytes = _Memo(lambda piece: _packer(len(ids := self.piece_ids(piece)))(*ids), b"".join)

    def _prove(self, vocab: dict[str, int], suffix: str) -> dict[str, int]:
        """Strings that the library encodes, alone, as the one token that is that string."""
        back = {letter: b for b, letter in enumerate(self.letters)}
        asked = {}
        for entry, number in vocab.items():
            if entry.endswith(suffix):
                try:
                    asked[bytes(back[c] for c in entry[: -len(suffix)]).decode()] = number
                except UnicodeDecodeError:
                    continue
        words = [w for w in asked if w and not OTHER(w) and PIECES(w) == [w]]
        # One by one: ``encode_batch`` starts threads, which keep memory of their own.
        return {w: asked[w] for w in words if self.library_ids(w) == [asked[w]]}

    def library_ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of a lower-case pre-token: proved ones directly, the rest by merging."""
        known = self.proved.get(piece)
        if known is not None:
            return [known]
        return [t.id for t in self.merge(piece.encode().decode("latin-1").translate(self.letters))]

    def words(self, text: str) -> list[str] | None:
        """Lower-case words of a text; None where the text has to go to the library."""
        if OTHER(text) or any(s in text for s in self.specials):
            return None
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return text.lower().split()

    def count(self, text: str | None) -> int:
        words = self.words(text) if text else []
        return len(self.library_ids(text)) if words is None else sum(map(self.counts.__getitem__, words))

    def ids(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        words = self.words(text) if text else []
        if words is None:
            return np.array(self.library_ids(text), "<u4").tobytes()
        return b"".join(map(self.bytes.__getitem__, words))


@lru_cache(maxsize=4)
def table(path: str) -> TokenTable:
    """One table per process and file, until the process works on something else."""
    made = TokenTable(path)
    worker.give_back()
    return made


worker.memories.append(table.cache_clear)
