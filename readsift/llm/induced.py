"""Suffix order with common prefixes by induced sorting through disk-backed queues.

The queue of a first character holds, in rank order, the suffixes that begin with it: a priority queue
keyed by (first character, rank). Scanning the queues in order, each suffix induces the one that starts
a character earlier into that one's queue, together with their common prefix length. Queues beyond the
memory limit live in files of the task's temporary folder, which go when the sort ends.

Order and prefix lengths are exact up to `depth` bytes: suffixes that agree on `depth` bytes stand next to
each other, in any order, with prefix length `depth`.
"""

import os
import tempfile

import numpy as np

MEMORY = 256 << 20  # bytes that the queues of one sort hold before they go to disk
BLOCK = 1 << 20  # suffixes scanned at once


class Queues:
    """First-in first-out queues of (position, common prefix) blocks, one per character."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self.held, self.files = folder, limit, 0, 0
        self.blocks = [[] for _ in range(256)]

    def put(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        for i in range(0, len(pos), BLOCK):
            block = (pos[i : i + BLOCK], lcp[i : i + BLOCK])
            size = sum(x.nbytes for x in block)
            if self.held + size > self.limit:
                path = os.path.join(self.folder, f"{id(self)}-{self.files}")
                self.files += 1
                with open(path, "wb") as out:
                    block[0].astype(np.int64).tofile(out)
                    block[1].tofile(out)
                block = (path, len(block[0]))
            else:
                self.held += size
            self.blocks[c].append(block)

    def _get(self, c: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        block = self.blocks[c][i]
        if isinstance(block[0], str):
            path, n = block
            return np.fromfile(path, np.int64, n), np.fromfile(path, np.uint8, offset=8 * n)
        return block

    def take(self, c: int, start: int, back: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
        """Blocks from `start` on (or back from it), together about BLOCK suffixes, and where to go on."""
        got, n, i = [], 0, start
        while (i >= 0 if back else i < len(self.blocks[c])) and (not got or n < BLOCK):
            got.append(self._get(c, i))
            n += len(got[-1][0])
            i += -1 if back else 1
        got = got[::-1] if back else got
        return np.concatenate([b[0] for b in got]), np.concatenate([b[1] for b in got]), i

    def blocks_of(self, c: int, back: bool = False):
        """All entries, also those that come while this runs; back: from the last, each block in stored order."""
        i = len(self.blocks[c]) - 1 if back else 0
        while 0 <= i < len(self.blocks[c]):
            pos, lcp, i = self.take(c, i, back)
            yield pos, lcp


class Text:
    """Bytes with their suffix types; reads of eight bytes at any place."""

    def __init__(self, data: np.ndarray, depth: int):
        self.n, self.depth, self.data = len(data), depth, data
        self.padded = np.concatenate((data, np.zeros(depth + 16, np.uint8)))
        self.words = np.ndarray((self.n + depth + 8,), "<u8", buffer=self.padded, strides=(1,))
        # a suffix is small (S) if its run of equal characters is followed by a larger one; the end is below all
        ends = np.append(np.flatnonzero(data[1:] != data[:-1]), self.n - 1)
        rises = np.zeros(len(ends), bool)
        rises[:-1] = data[ends[:-1] + 1] > data[ends[:-1]]
        self.small = np.repeat(rises, np.diff(np.append(-1, ends)))
        self.lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix lengths of suffix pairs, up to depth."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for step in range(0, self.depth, 8):
            x = self.words[np.minimum(a[live] + step, self.n)] ^ self.words[np.minimum(b[live] + step, self.n)]
            differ = x != 0
            low = x[differ] & (~x[differ] + np.uint64(1))
            out[live[differ]] = step + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
            live = live[~differ]
            if not len(live):
                break
        out[live] = self.depth
        return np.minimum(np.minimum(out, self.depth), self.n - np.maximum(a, b)).astype(np.uint8)


def _minima(lcp: np.ndarray) -> list:
    """Sparse table of range minima."""
    levels = [lcp]
    width = 1
    while 2 * width <= len(lcp):
        levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
        width *= 2
    return levels


class Induction:
    """One pass: what scanned suffixes induce, with common prefixes between neighbours of a queue."""

    def __init__(self, text: Text, queues: Queues, small: bool, carry: bool):
        self.text, self.queues, self.small, self.carry = text, queues, small, carry
        self.least = np.full(256, 255, np.uint8)  # smallest common prefix since the last entry of a queue
        self.begun = np.zeros(256, bool)

    def scan(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """pos: suffixes in scan order; lcp: common prefix with the suffix scanned before."""
        text = self.text
        at = np.flatnonzero(pos > 0)
        at = at[text.small[pos[at] - 1] == self.small]
        new = pos[at] - 1
        chars = text.data[new]
        order = np.argsort(chars, kind="stable")
        at, new, chars = at[order], new[order], chars[order]
        if not len(at):
            self.least = np.minimum(self.least, lcp.min())
            return
        heads = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
        got = chars[heads]
        value = np.zeros(len(at), np.uint8)
        if self.carry:
            table = _minima(lcp)
            left = np.zeros(len(at), np.int64)
            left[1:] = at[:-1] + 1
            left[heads] = 0
            value = self._range(table, left, at)
            value[heads] = np.minimum(value[heads], self.least[got])
            value = np.minimum(value, text.depth - 1) + np.uint8(1)
            fresh = ~self.begun[got]
            value[heads[fresh]] = 0
            self.least = np.minimum(self.least, lcp.min())
            last = at[np.append(heads[1:], len(at)) - 1]
            rest = np.full(len(last), 255, np.uint8)
            more = last + 1 < len(lcp)
            rest[more] = self._range(table, last[more] + 1, np.full(int(more.sum()), len(lcp) - 1))
            self.least[got] = rest
        self.begun[got] = True
        for a, b, c in zip(heads, np.append(heads[1:], len(at)), got.tolist(), strict=True):
            self.queues.put(c, new[a:b], value[a:b])

    @staticmethod
    def _range(table: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), np.uint8)
        level = np.log2((right - left + 1).astype(np.float64)).astype(np.int64)
        for k in np.unique(level).tolist():
            pick = np.flatnonzero(level == k)
            out[pick] = np.minimum(table[k][left[pick]], table[k][right[pick] - (1 << k) + 1])
        return out


def _induce(text: Text, lms: np.ndarray, lcp: np.ndarray, carry: bool, folder: str, limit: int):
    """From ordered LMS suffixes to the queues of large and of small suffixes."""
    n = text.n
    present = np.unique(text.data).tolist()
    lms_char = text.data[lms]
    bounds = np.searchsorted(lms_char, np.arange(257))
    large, small = Queues(folder, limit), Queues(folder, limit)
    run = Induction(text, large, False, carry)
    run.scan(np.array([n]), np.zeros(1, np.uint8))  # the empty suffix comes first
    tail = {}
    for c in present:
        for pos, common in large.blocks_of(c):
            run.scan(pos, common)
            tail[c] = pos[-1]
        own = lms[bounds[c] : bounds[c + 1]]
        if len(own):
            common = lcp[bounds[c] : bounds[c + 1]].copy()
            if carry:
                common[0] = text.common(np.array([tail[c]]), own[:1])[0] if c in tail else 0
            run.scan(own, common)
    run = Induction(text, small, True, carry)
    seam = {}
    for c in reversed(present):
        last = None
        for pos, common in small.blocks_of(c):
            run.scan(pos, common)
            last = pos[-1]
        if c in tail:
            seam[c] = int(text.common(np.array([last]), np.array([tail[c]]))[0]) if carry and last is not None else 0
            above = seam[c]
            for pos, common in large.blocks_of(c, back=True):
                run.scan(pos[::-1], np.append(np.uint8(above), common[:0:-1]).astype(np.uint8))
                above = common[0]
    return large, small, seam, present


def _reduced(text: Text, folder: str, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """LMS suffixes in order, with common prefixes: names of LMS substrings, ranked by doubling."""
    lms = text.lms
    if not len(lms):
        return lms, np.zeros(0, np.uint8)
    start = lms[np.argsort(text.data[lms], kind="stable")]
    _, small, _, present = _induce(text, start, np.zeros(len(start), np.uint8), False, folder, limit)
    is_lms = np.zeros(text.n, bool)
    is_lms[lms] = True
    order = np.concatenate([p[is_lms[p]] for c in present for back, _ in small.blocks_of(c, back=True) for p in [back[::-1]]])
    # names: equal LMS substrings (up to and with the first byte of the next one) share a name
    ends = np.append(lms[1:], text.n - 1)
    lengths = ends - lms + 1
    first = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    place = np.arange(total) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), np.uint64(0x9E3779B97F4A7C15), np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    bytes_ = text.data[np.minimum(place + np.repeat(lms, lengths), text.n - 1)].astype(np.uint64) + np.uint64(1)
    code = np.add.reduceat(bytes_ * powers[place], first)
    code[-1:] += np.uint64(0x5851F42D4C957F2D)  # the last one runs into the end
    index = np.searchsorted(lms, order)
    step = np.ones(len(order), np.int64)
    step[1:] = (code[index][1:] != code[index][:-1]) | (lengths[index][1:] != lengths[index][:-1])
    rank = np.empty(len(lms), np.int64)
    rank[index] = np.cumsum(step)
    m, width = len(lms), 1
    while rank.max() < m and 2 * width < text.depth:  # LMS places are two bytes apart at least
        ahead = np.zeros(m, np.int64)
        ahead[:-width] = rank[width:] if width < m else 0
        key = rank * (m + 1) + ahead
        by = np.argsort(key)
        step = np.ones(m, np.int64)
        step[1:] = key[by][1:] != key[by][:-1]
        rank[by] = np.cumsum(step)
        width *= 2
    lms = lms[np.argsort(rank)]
    lcp = np.zeros(m, np.uint8)
    lcp[1:] = text.common(lms[:-1], lms[1:])
    return lms, lcp


def sorted_suffixes(data: np.ndarray, depth: int, folder: str | None = None, limit: int = MEMORY):
    """(positions, common prefix with the position before), in suffix order, as blocks."""
    if not len(data):
        return
    if not 0 < depth < 255:
        raise ValueError("depth must be between 1 and 254")
    text = Text(data, depth)
    with tempfile.TemporaryDirectory(dir=folder) as own:
        lms, lcp = _reduced(text, own, limit)
        large, small, seam, present = _induce(text, lms, lcp, True, own, limit)
        for c in present:
            yield from large.blocks_of(c)
            above = None
            for pos, common in small.blocks_of(c, back=True):
                # stored from the largest down, each with the one above it; turned round, each with the one below
                below = np.uint8(seam.get(c, 0)) if above is None else above
                yield pos[::-1], np.append(below, common[:0:-1]).astype(np.uint8)
                above = common[0]
