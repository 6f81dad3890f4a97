"""Pre-tokens and vocabulary of a byte-level BPE tokenizer file, as its library reads them."""

from __future__ import annotations

import json
import re

import regex


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, and back.

    Fixed rule of the file format: printable Latin-1 bytes stand for
    themselves, the others take the letters from U+0100 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranges(pattern: str, below: int) -> str:
    """The code points below a limit that match a one-character pattern, as ranges of a class."""
    one = regex.compile(pattern)
    out, first = [], None
    for c in range(below + 1):
        hit = c < below and one.fullmatch(chr(c)) is not None
        if hit and first is None:
            first = c
        elif not hit and first is not None:
            out.append(f"\\u{first:04x}-\\u{c - 1:04x}")
            first = None
    return "".join(out)


class ByteLevel:
    """Vocabulary, merges and pre-token rule of a byte-level BPE file (its JSON text)."""

    #: Fixed pattern of byte-level pre-tokens (the public GPT-2 rule).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: Below this code point both libraries' letter tables agree.
    SETTLED = 0x530

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        letters = byte_letters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.size = max([*vocab.values(), *self.specials.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * self.size
        for k, i in vocab.items():
            if k not in self.specials:
                self.token_bytes[i] = bytes(letters[c] for c in k)
        for k, i in self.specials.items():
            self.token_bytes[i] = k.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: (left id, right id, merged id) by rank
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.byte_id = [0] * 256
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        self.find = regex.compile(self.PATTERN).findall
        self.cut = regex.compile("|".join(
            regex.escape(x) for x in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        self.pre = Tokenizer.from_str(text).pre_tokenizer
        # the same pattern with the classes written out, for texts below that code point
        letter, number, gap = (ranges(x, self.SETTLED) for x in (r"\p{L}", r"\p{N}", r"\s"))
        self.find_settled = re.compile(
            rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{gap}{letter}{number}]+"
            rf"|[{gap}]+(?![^{gap}])|[{gap}]+").findall
        self.odd = regex.compile(f"[{chr(self.SETTLED)}-\U0010ffff]")
        self.same: dict[str, bool] = {}

    def _agrees(self, c: str) -> bool:
        """Does the pattern class this character as the tokenizer's library does?"""
        if c not in self.same:
            s = f"a{c}b1{c}2 {c}{c}x  {c}"
            self.same[c] = [s[x:y] for _, (x, y) in self.pre.pre_tokenize_str(s)] == self.find(s)
        return self.same[c]

    def plain(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if text.isascii() or not (odd := set(self.odd.findall(text))):
            return self.find_settled(text)
        if not all(map(self._agrees, odd)):
            return [text[x:y] for _, (x, y) in self.pre.pre_tokenize_str(text)]
        return self.find(text)

    def parts(self, text: str):
        """(special id or None, pre-tokens) in the order of the text."""
        at = 0
        if self.cut is not None:
            for m in self.cut.finditer(text):
                if m.start() > at:
                    yield None, self.plain(text[at:m.start()])
                yield self.specials[m.group()], []
                at = m.end()
        if at < len(text):
            yield None, self.plain(text[at:] if at else text)
