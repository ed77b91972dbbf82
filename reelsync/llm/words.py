"""Splitting texts into pre-tokens the way a tokenizer file says.

The patterns are those written in the tokenizer files. They are run with the
``regex`` module, which knows a newer Unicode than the tokenizer library;
``PLAIN`` accepts only texts of characters on which both agree, any other text
goes through the library's own normalizer and pre-tokenizer.
"""

from __future__ import annotations

import json
import unicodedata

import regex

# The split patterns of the two public tokenizer files.
BYTE_LEVEL_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                    r"|\s+(?!\S)|\s+")
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Blocks whose characters are classified and normalized alike by both.
PLAIN = regex.compile(
    r"[\x00-\x1B\x20-՗؀-ۿऀ-ॿḀ-₎₠-₿℀-↋"
    r"←-⏿①-➿　-〩ぁ-ゖ゠-ヿ一-鿯"
    r"가-힣！-ﾟ\U0001F300-\U0001F64F]*+")


class Recent(dict):
    """Results of ``make(key)`` for recent keys, in two generations of ``size``.

    When the younger one is full it becomes the older one, so what is still in
    use is found there and kept. Keys over ``longest`` characters are computed
    each time.
    """

    def __init__(self, make, size: int, longest: int):
        super().__init__()
        self.make, self.size, self.longest, self.older = make, size, longest, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def specials(path: str) -> dict[str, int]:
    """Added special tokens of a tokenizer file: content -> id."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def splitter(special: dict[str, int]):
    """A function cutting a text at special strings; they are kept as pieces."""
    if not special:
        return lambda text: [text]
    longest_first = sorted(special, key=len, reverse=True)
    cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
    marks = tuple(special)

    def pieces(text: str) -> list[str]:
        if any(m in text for m in marks):
            return [p for p in cut.split(text) if p]
        return [text]

    return pieces


def normalize_word(text: str) -> str:
    """NFC, then lower case letter by letter.

    The capital sigma is mapped before ``lower()``, which would otherwise
    choose the final form by context. (White space, which the file makes
    uniform, only separates words and need not be changed.)
    """
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte (byte-level BPE):
    visible Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]
