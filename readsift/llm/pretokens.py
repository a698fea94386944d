"""Pre-tokens of a byte-level BPE vocabulary file: split in bulk, encode each distinct one once.

A BPE encoding of a text is the encodings of its pre-tokens one after the other. Texts made only of
characters for which Python's normalization and splitting provably agree with the library's are split
here; each distinct pre-token is encoded by the library once and then looked up. All other texts,
and texts that contain a special string, go through the library whole.
"""

import json
import os
import re

import public_tokenizers
import regex
from tokenizers import Tokenizer

#: Split patterns of the two vocabulary files (fixed values).
SPLIT_SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

KNOWN = 700_000  # units that one worker remembers before it starts again
TOP = 0x250  # characters below are candidates for the plain path; normal forms C leave them alone
RUN = re.compile(r" \s|\s ")  # a run of white space with a space in it


class Pretokens:
    """Encodings by the library, through a memory of the units between spaces and of their pre-tokens.

    value(ids) is remembered for each pre-token, combine(values) for each unit; `given` pre-tokens are known from the start.
    """

    def __init__(self, name: str, value, combine):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = public_tokenizers.path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.value, self.combine = value, combine
        self.lower = spec["normalizer"] is not None
        self.split = regex.compile(SPLIT_WORDS if self.lower else SPLIT_SPACED)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # white space beyond the six ASCII kinds is left to the library
        chars = [chr(c) for c in range(TOP) if not chr(c).isspace() or chr(c) in " \t\n\x0b\x0c\r"]
        self.plain = frozenset(c for c in chars if self._agrees(c))
        self.letters = frozenset(c for c in self.plain if c.isalpha() and regex.fullmatch(r"\p{L}", c.lower() if self.lower else c))
        self.given = {}
        self.forget()

    def forget(self) -> None:
        self.known, self.units = dict(self.given), {}

    def _agrees(self, c: str) -> bool:
        """The library normalizes and splits around the character as the pattern here does."""
        for text in (c, f"a{c}b", f" {c} ", f"1{c}{c}", f"a {c}a"):
            mine = text.lower() if self.lower else text
            if self.lower and "".join(self.library.normalizer.normalize_str(text).split()) != "".join(mine.split()):
                return False
            found = self.library.encode(text, add_special_tokens=False)
            spans = {}
            for word, (a, b) in zip(found.word_ids, found.offsets, strict=True):
                low, high = spans.get(word, (a, b))
                spans[word] = (min(a, low), max(b, high))
            if [mine[a:b] for a, b in spans.values()] != self.split.findall(mine):
                return False
        return True

    def is_plain(self, text: str) -> bool:
        return self.plain.issuperset(set(text)) and not any(s in text for s in self.special)

    def pieces(self, text: str) -> list:
        return self.split.findall(text.lower() if self.lower else text)

    def learn(self, pieces: set) -> None:
        new = list(pieces - self.known.keys())
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            for p, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[p] = self.value(e.ids)

    def encode(self, texts: list) -> list:
        """combine(values of the pre-tokens) of each text; value(all ids) for those that go whole.

        No pre-token crosses white space, but for one space before it. So a text is cut at its spaces, each unit keeping the space
        before it; where a space stands in a longer run of white space, the text is cut into pre-tokens at once.
        """
        if len(self.known) + len(self.units) > KNOWN:
            self.forget()
        out, cut, loose = [None] * len(texts), {}, {}
        for i, text in enumerate(texts):
            if not self.is_plain(text):
                out[i] = self.value(self.library.encode(text, add_special_tokens=False).ids)
            elif self.lower:
                cut[i], loose[i] = text.split(), []
            elif RUN.search(text):
                cut[i], loose[i] = [], self.pieces(text)
            else:
                first, *rest = text.split(" ")
                cut[i], loose[i] = rest, self.pieces(first)
        before = "" if self.lower else " "
        new = set().union(*cut.values()) - self.units.keys()
        # letters alone are one pre-token
        words = {u: before + (u.lower() if self.lower else u) for u in new if u.isalpha() and self.letters.issuperset(u)}
        mixed = {u: self.pieces(before + u) for u in new if u not in words}
        self.learn(set(words.values()).union(*mixed.values(), *loose.values()))
        look, known = self.known.__getitem__, self.units.__getitem__
        self.units.update(zip(words, map(look, words.values()), strict=True))
        self.units.update((u, self.combine(map(look, p))) for u, p in mixed.items())
        for i, units in cut.items():
            out[i] = self.combine([*map(look, loose[i]), *map(known, units)])
        return out
