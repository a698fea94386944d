"""Vectorized text primitives on Arrow batches: words, polynomial hashes, window minima, packed spans.

All hashes are arithmetic modulo 2^64 on numpy arrays; nothing here loops over characters or words.
"""

import ctypes
import gc

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SUB_BATCH = 4 << 20  # bytes of text that one round of array work covers


def release() -> None:
    """Give memory that is no longer used back, as workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps freed pages for itself
        trim(0)


def releasing(run):
    """The same function over batches; when its task is through, the worker gives memory back."""

    def released(batches):
        yield from run(batches)
        release()

    return released


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch, column: str = "text", size: int = SUB_BATCH):
    """Cut a batch into runs of rows of about `size` bytes of text; a longer row is a run of its own."""
    _, offsets = flat(batch[column])
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word (one more entry than texts)."""
    inside = ~is_space(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


LETTERS = 1 << 19  # letters whose products are held at once; more if a word has more


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    lengths = ends - starts
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    powers = np.full(int(lengths.max()), BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    before = np.cumsum(lengths) - lengths
    cuts = np.unique(np.append(np.searchsorted(before, np.arange(0, before[-1] + 1, LETTERS)), len(starts)))
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = lengths[low:high]
        first = before[low:high] - before[low]
        place = ramps(own)
        letters = data[place + np.repeat(starts[low:high], own)].astype(np.uint64) + np.uint64(1)
        out[low:high] = np.add.reduceat(letters * powers[place], first)
    return mix(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of each run of n values (polynomial in BASE), built from runs of powers of two."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        done, at, power, width, step = None, 0, values.astype(np.uint64), 1, BASE
        while True:
            if n & width:
                if done is None:
                    done = power
                else:  # runs already joined come first, this power of two after them
                    size = len(values) - at - width + 1
                    done = done[:size] * step + power[at : at + size]
                at += width
            width *= 2
            if width > n:
                return done[: len(values) - n + 1]
            power = power[: -(width // 2)] * step + power[width // 2 :]
            step = step * step


def slide_min(values: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each run of n values."""
    if len(values) < n:
        return values[:0]
    width = 1
    while width * 2 <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (n - width)], values[n - width :]) if n > width else values


def ramps(counts: np.ndarray) -> np.ndarray:
    """0..count-1 for each count, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over the bytes of `data`, cut at `offsets` (in bytes)."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


def spans_by_text(doc: np.ndarray, check: np.ndarray, start: np.ndarray, count: np.ndarray):
    """One row per text: (doc, check, packed (start, count) pairs of 32 bits), touching spans joined."""
    order = np.lexsort((start, check, doc))
    doc, check, start, count = doc[order], check[order], start[order].astype(np.int64), count[order].astype(np.int64)
    new_text = np.ones(len(doc), bool)
    new_text[1:] = (doc[1:] != doc[:-1]) | (check[1:] != check[:-1])
    # ends grow within a text; a shift per text keeps the running maximum from crossing texts
    shift = np.cumsum(new_text) << 33
    reach = np.maximum.accumulate(start + count + shift) - shift
    new_span = new_text.copy()
    new_span[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new_span)
    last = np.append(at[1:], len(doc)) - 1
    pairs = np.empty((len(at), 2), np.uint32)
    pairs[:, 0] = start[at]
    pairs[:, 1] = reach[last] - start[at] if len(at) else 0
    texts = np.flatnonzero(new_text)
    offsets = np.append(np.searchsorted(at, texts), len(at)) * 8
    return doc[texts], check[texts], binary_rows(pairs.view(np.uint8).reshape(-1), offsets)


def read_spans(parts) -> np.ndarray:
    """The (start, count) pairs of packed spans, as int64 rows."""
    parts = [np.frombuffer(p, np.uint32).reshape(-1, 2) for p in parts or () if p]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros((0, 2), np.int64)


def cover(spans: np.ndarray, length: int, more: int) -> np.ndarray:
    """True where some span, each `more` units longer than its count, covers the unit."""
    steps = np.zeros(length + 1, np.int32)
    np.add.at(steps, np.minimum(spans[:, 0], length), 1)
    np.add.at(steps, np.minimum(spans[:, 0] + spans[:, 1] + more, length), -1)
    return np.cumsum(steps[:-1]) > 0
