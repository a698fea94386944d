"""BPE encoding and decoding by batched merge rounds on arrays.

The words of many texts that no worker memory holds yet are laid into one flat array of symbols. In a round every word merges its
pair of lowest rank, wherever it stands in the word; ranks come from a binary search over the sorted keys of all pairs, and only
pairs beside a merge are searched again. A text's ids are then gathered from those of its words.
"""

import heapq
import json
import re
from hashlib import sha256
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from readsift.llm.vectors import flat, ramps, slices

MODEL = "byte_bpe_50k.json"
#: Split pattern of the vocabulary file over the letters, digits and other signs of ASCII (fixed value).
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
SLICE = 1 << 20  # bytes of text worked on together; longer texts are cut into stretches
BREAK = re.compile(r"\S(?= )")  # no pre-token and no special string crosses from here into the space
KNOWN = 500_000  # words that one worker remembers before it starts again
LONG = 512  # bytes of words whose rounds go through one rank at a time
NONE = np.iinfo(np.int64).max
_made = {}


def byte_alphabet() -> dict:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from 256 up, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def leftmost(touching: np.ndarray) -> np.ndarray:
    """Of places in order, `touching` telling whether each follows on the one before: every other one of a run, from its first."""
    number = np.arange(len(touching))
    first = np.maximum.accumulate(np.where(touching, 0, number))
    return (number - first) % 2 == 0


class Merges:
    """The pairs of a vocabulary and their ranks; a pair's rank is above those of the merges that make its parts."""

    def __init__(self, vocabulary: dict, merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.size = max(vocabulary.values()) + 1
        left, right, self.product = (np.array([vocabulary[t] for t in side], np.int64) for side in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        made = np.full(self.size, -1, np.int64)
        made[self.product] = np.arange(len(pairs))
        if len(set(self.product.tolist())) < len(pairs) or (made[left] >= made[self.product]).any() or (made[right] >= made[self.product]).any():
            raise ValueError("the merges do not build each token once, from tokens built before it")
        keys = left * self.size + right
        self.rank = np.argsort(keys)
        self.keys = keys[self.rank]

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE for those that never merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple:
        """Ids of the words one after the other, and how many each has. sizes: symbols of each word."""
        many = sizes > LONG
        out = np.zeros(len(sizes), np.int64)
        parts = []
        for rounds, chosen in ((self.rounds, ~many), (self.rank_rounds, many)):
            if chosen.any():
                at = np.flatnonzero(np.repeat(chosen, sizes))
                word, ids = rounds(symbols[at].astype(np.int64), np.repeat(np.flatnonzero(chosen), sizes[chosen]))
                parts.append((word, ids))
        if not parts:
            return np.zeros(0, np.int64), out
        word, ids = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(sizes))

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple:
        """(word, id) pairs, those of a word in order: each round merges the lowest pair of every word."""
        done = []
        rank = np.full(len(symbols), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.look(symbols[inside], symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(first, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, first), sizes)
            live = least < NONE
            if not live.all():
                done.append((word[~live], symbols[~live]))
                symbols, word, rank, least = symbols[live], word[live], rank[live], least[live]
            at = np.flatnonzero(rank == least)
            at = at[leftmost(np.concatenate(([False], at[1:] == at[:-1] + 1)))] if len(at) else at
            symbols[at] = self.product[rank[at]]
            rank[at] = NONE
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word, rank = symbols[stays], word[stays], rank[stays]
            at -= np.arange(len(at))  # as many symbols before it are gone
            near = np.concatenate((at, at[at > 0] - 1))
            near = near[near + 1 < len(word)]
            rank[near] = NONE
            near = near[word[near] == word[near + 1]]
            rank[near] = self.look(symbols[near], symbols[near + 1])
            ends = at[at > 0] - 1
            rank[ends[word[ends] != word[ends + 1]]] = NONE
        return tuple(np.concatenate(p) for p in zip(*done, strict=True))

    def rank_rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple:
        """The same for long words: a round merges one rank in all of them, and only its places are touched."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        edge = np.flatnonzero(word[1:] != word[:-1])
        after[edge], before[edge + 1] = n, -1
        rank, waiting, heap = np.full(n, NONE), {}, []

        def search(places):
            places = places[after[places] < n]
            rank[places] = self.look(symbols[places], symbols[after[places]])
            places = places[rank[places] < NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            ranks, first = np.unique(rank[places], return_index=True)
            for r, part in zip(ranks.tolist(), np.split(places, first[1:]), strict=True) if len(ranks) else ():
                if r not in waiting:
                    heapq.heappush(heap, r)
                waiting.setdefault(r, []).append(part)

        search(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            at = at[leftmost(np.concatenate(([False], at[1:] == after[at[:-1]])))]
            right = after[at]
            symbols[at], rank[at], rank[right], symbols[right] = self.product[r], NONE, NONE, -1
            after[at] = after[right]
            inside = at[after[at] < n]
            before[after[inside]] = inside
            earlier = before[at]
            earlier = np.unique(earlier[earlier >= 0])
            rank[earlier] = NONE
            search(np.union1d(at, earlier))
        return word[symbols >= 0], symbols[symbols >= 0]


class Numbers(dict):
    """Words numbered in the order in which they are first asked for; `new`: those numbered since it was emptied."""

    def __init__(self):
        self.new = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Remembered:
    """Ids of words in one growing array; words seen for the first time are encoded together, by encode(words) -> (ids, sizes)."""

    def __init__(self, encode, most: int = KNOWN):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.slot, self.used = Numbers(), 0
        self.ids, self.start, self.size = np.zeros(1 << 16, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def slots(self, words, n: int) -> np.ndarray:
        """The places of n words in `start` and `size`."""
        if len(self.slot) > self.most:
            self.forget()
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, n)
        if self.slot.new:
            ids, sizes = self.encode(self.slot.new)
            self.slot.new = []
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            self.ids[self.used : self.used + len(ids)] = ids
            self.start = np.concatenate((self.start, self.used + np.cumsum(sizes) - sizes))
            self.size = np.concatenate((self.size, sizes))
            self.used += len(ids)
        return slots

    def at(self, slots: np.ndarray, counts: np.ndarray) -> tuple:
        """Ids of the words at these places, and how many each run of `counts` words has."""
        sizes = self.size[slots]
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        return self.ids[np.repeat(self.start[slots], sizes) + ramps(sizes)], np.diff(ends)

    def gather(self, lists: list) -> tuple:
        """Ids of lists of words, one list after the other, and how many ids each list has."""
        counts = np.array(list(map(len, lists)), np.int64)
        return self.at(self.slots(chain.from_iterable(lists), int(counts.sum())), counts)


class Classes(dict):
    """For a character beyond ASCII, one of ASCII that the library's splitting treats alike; it is asked once per character."""

    def __init__(self, split):
        self.split = split

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if code < 128:
            stand_in = c
        else:
            alike = [s for s in "z0!" if len(self.split.pre_tokenize_str(f"{s}{c}{s}")) == 1]
            stand_in = alike[0] if alike else "\t"
        self[code] = stand_in
        return stand_in


class Codec:
    """Texts to ids and back, for one vocabulary file. With `special`, special strings in a text are their ids, else plain text."""

    def __init__(self, name: str = MODEL, special: bool = True):
        path = public_tokenizers.path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{name} is no plain byte-level vocabulary")
        self.classes = Classes(library.pre_tokenizer)
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"])
        letters = byte_alphabet()
        vocabulary = library.get_vocab(with_added_tokens=True)
        self.raw = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.raw[i] = bytes(letters[c] for c in token)
        self.byte = np.array([spec["model"]["vocab"][c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        self.names = list(map(str, range(len(self.raw))))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]} if special else {}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in spec["added_tokens"]):
            raise ValueError(f"special strings of {name} take in white space")
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.words = Remembered(self.encode_words)

    def encode_words(self, words: list) -> tuple:
        data, offsets = flat(pa.array(words, pa.large_string()))
        return self.merges.merged(self.byte[data], np.diff(offsets))

    def split(self, text: str) -> list:
        """Pre-tokens of a text, whose characters beyond ASCII stand for their class while it is split."""
        if text.isascii():
            return SPLIT.findall(text)
        parts, at = [], 0
        for part in SPLIT.findall(text.translate(self.classes)):
            parts.append(text[at : at + len(part)])
            at += len(part)
        return parts

    def encode(self, texts: list) -> tuple:
        """Ids of all texts one after the other, and how many each has."""
        rows, lists, marks = [], [], []  # plain parts and special ids, with the text each belongs to
        for i, text in enumerate(texts):
            at = 0
            for found in self.cut.finditer(text) if self.cut else ():
                rows += [i, i]
                lists += [self.split(text[at : found.start()]), []]
                marks += [-1, self.special[found.group()]]
                at = found.end()
            rows.append(i)
            lists.append(self.split(text[at:] if at else text))
            marks.append(-1)
        ids, counts = self.words.gather(lists)
        marks = np.array(marks, np.int64)
        if (marks >= 0).any():
            ids = np.insert(ids, np.cumsum(counts)[marks >= 0], marks[marks >= 0])
            counts = counts + (marks >= 0)
        return ids, np.bincount(rows, counts, len(texts)).astype(np.int64)

    def stretches(self, text: str, size: int = SLICE):
        """A text in stretches of about `size` characters, cut where no pre-token can cross: before a space after something else."""
        at = 0
        while len(text) - at > size and (found := BREAK.search(text, at + size)):
            yield text[at : found.end()]
            at = found.end()
        yield text[at:]

    def encode_rows(self, texts: list) -> tuple:
        """As encode; a text that stands alone is worked on in stretches."""
        if len(texts) > 1:
            return self.encode(texts)
        parts = [self.encode([part])[0] for text in texts for part in self.stretches(text)]
        return np.concatenate(parts), np.array([sum(map(len, parts))])

    def decode(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")


def codec(name: str = MODEL, special: bool = True) -> Codec:
    """One per worker process."""
    if (name, special) not in _made:
        _made[name, special] = Codec(name, special)
    return _made[name, special]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def encode(docs: DataFrame, name: str = MODEL, special: bool = True) -> DataFrame:
    """(doc_id, ids) per row, the ids of the tokenizers library without added tokens. Null and empty texts have no ids.

    Rows stand for themselves: repeated rows and null doc_ids come out as they went in; other columns are ignored. A long text is
    worked on in stretches, but its ids are one value; a word without a space in it is never cut.
    """

    def run(batches):
        own = codec(name, special)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, sizes = own.encode_rows(part["text"].to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, name: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), special ids as their strings; invalid bytes become U+FFFD. Null ids give an empty text."""

    def run(batches):
        own = codec(name)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([own.decode(ids or ()) for ids in part["ids"].to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row: encode and decode in one pass, kept as digests. Rows as in `encode`."""

    def run(batches):
        own = codec(name)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, sizes = own.encode_rows(part["text"].to_pylist())
                ends = np.concatenate(([0], np.cumsum(sizes))).tolist()
                lists = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                written = [sha256(",".join(map(own.names.__getitem__, x)).encode()).hexdigest() for x in lists]
                decoded = [sha256(own.decode(x).encode()).hexdigest() for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(written), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
