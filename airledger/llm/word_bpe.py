"""Vocabulary files of the word-ending byte-pair kind: normal form, word split, symbols, ranks.

The file is read from a path (a parameter); nothing of it is kept in the repository.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import public_tokenizers

DEFAULT_FILE = "word_bpe_49k.json"

# The word pattern of the file's splitter, written for texts of plain characters only
# (white space spelled out because Python's \s holds four control characters more).
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\t-\r \x85\xa0]|_)+")

# Characters outside these ranges may change under normalisation, lower to several characters, or be
# numbers Python counts as letters. Texts that hold one go through the library's own splitter.
UNUSUAL = re.compile(
    "[^\x00-\x7f\x85\xa0\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\xffĀ-įı-ſ"
    "‐-‧‰-⁞€]"
)


def byte_alphabet() -> list[str]:
    """One printable character per byte: printable Latin-1 stands for itself, the rest moves to 256 up."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Symbols, ids and merge ranks of one file, with the split of a text into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.alphabet = byte_alphabet()
        self._bytes = {c: b for b, c in enumerate(self.alphabet)}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self._path = path
        self._library = None

    def symbols(self, word: str) -> list[str]:
        """Byte characters of a word, the last one marked as its end."""
        alphabet = self.alphabet
        out = [alphabet[b] for b in word.encode("utf-8")]
        if out:
            out[-1] += self.end
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special token's string inside it is one word."""
        if not self._special.search(text):
            return self._split(text)
        out, start = [], 0
        for found in self._special.finditer(text):
            out += self._split(text[start : found.start()])
            out.append(found.group())
            start = found.end()
        return out + self._split(text[start:])

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not UNUSUAL.search(text):
            return WORDS.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        low = self._library.normalizer.normalize_str(text)
        back = self._bytes
        pieces = self._library.pre_tokenizer.pre_tokenize_str(low)
        return [bytes([back[c] for c in piece]).decode("utf-8") for piece, _ in pieces]


@lru_cache(maxsize=4)
def vocabulary(path: str | None = None) -> Vocabulary:
    return Vocabulary(path or public_tokenizers.path(DEFAULT_FILE))
