"""Letters of Arrow batches as flat arrays, for column functions that compare many places of two strings at once."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession, functions as F

from readsift.session import ship

TOGETHER = 1 << 20  # letters worked on at once; a longer string stands alone
AT_ONCE = 1 << 18  # places whose words are cut at once; a longer string is cut in several parts
LIMB = 31  # bases that one number of 62 bits holds


def in_batches(run, columns: list, schema: str, once: bool = True):
    """A function of columns that `run` evaluates in Arrow batches, on workers that can import this package.

    once: no filter is pushed below it, which would evaluate it twice.
    """
    ship(SparkSession.active())  # before the function is made, which takes along what is shipped by then
    # annotated here, as the function travels to workers by value
    run.__annotations__ = {**dict.fromkeys(columns, pa.Array), "return": pa.Array}
    made = F.arrow_udf(run, schema)
    return made.asNondeterministic() if once else made


def codes(strings: pa.Array) -> tuple:
    """(data, offsets): the code points of all strings, one behind the other, and where each begins; a null is empty."""
    strings = strings.cast(pa.large_string()).fill_null("")
    _, ends, data = strings.buffers()
    offsets = np.frombuffer(ends, np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    if len(data) and data.max() > 127:  # a code point may take several bytes
        lengths = pc.utf8_length(strings).to_numpy(zero_copy_only=False)
        wide = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        return wide, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return data, offsets - offsets[0]


def stretches(lengths: np.ndarray, most: int = TOGETHER):
    """(low, high) of neighbouring rows whose lengths sum up to `most`, or of one longer row."""
    ends, low = np.cumsum(lengths), 0
    while low < len(lengths):
        before = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, before + most, "right")), low + 1)
        yield low, high
        low = high


def spread(counts: np.ndarray) -> tuple:
    """(row, place): every row as often as its count says, and 0, 1, 2 ... within each row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def unequal(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many of the `lengths` letters from a_at in a differ from those from b_at in b, for each row."""
    out = np.zeros(len(lengths), np.int64)
    for low, high in stretches(lengths):
        row, place = spread(lengths[low:high])
        differ = a[a_at[low:high][row] + place] != b[b_at[low:high][row] + place]
        seen = np.concatenate([[0], np.cumsum(differ)])
        ends = np.cumsum(lengths[low:high])
        out[low:high] = seen[ends] - seen[ends - lengths[low:high]]
    return out


def _doubled(first: np.ndarray, size: int, join) -> np.ndarray:
    """For each place, `size` neighbours joined; join(left, right, letters on the left, letters on the right), which need not be equal in number."""
    whole, have, power, power_size = None, 0, first, 1
    while True:
        if size & power_size:
            if whole is None:
                whole, have = power, power_size
            else:
                n = max(len(power) - have, 0)
                whole, have = join(whole[:n], power[have : have + n], have, power_size), have + power_size
        if 2 * power_size > size:
            return whole
        n = max(len(power) - power_size, 0)
        power, power_size = join(power[:n], power[power_size:], power_size, power_size), 2 * power_size


BASE = np.full(256, 4, np.uint8)
BASE[[ord(c) for c in "ACGT"]] = range(4)
SEED = np.array([m < 16 and m.bit_count() >= 3 for m in range(32)])  # at least three of the four bases, and nothing else


def _forth(left, right, a, b):
    return (left << (2 * b)) | right


def _back(left, right, a, b):
    return (right << (2 * a)) | left


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Different numbers of 64 bits for different numbers, spread over all bits."""
    x = numbers.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def xxhash64(numbers: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64 gives for numbers of 64 bits."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    h = turned(numbers.view(np.uint64) * p2, 31) * p1 ^ np.uint64((42 + int(p5) + 8) % (1 << 64))
    h = turned(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _limbs(base: np.ndarray, size: int, at: np.ndarray, turned: bool) -> list:
    """The words at some places, or their reverse complements, as numbers of LIMB bases at most, in the order of their letters."""
    base = (3 - base if turned else base).astype(np.int64) & 3
    out = []
    for k in range(0, size, LIMB):
        n = min(LIMB, size - k)
        first = size - k - n if turned else k  # the last bases are the first of the reverse complement
        out.append(_doubled(base, n, _back if turned else _forth)[at + first])
    return out


def seed_words(strings: pa.Array, size: int, stride: int = 1, limit: int = None):
    """(row, pos, letters, at, forth, back) of the seed words that start at 0, stride, 2 * stride ... up to `limit` in each string, part by part.

    `letters` holds the letters of the part, `at` where in them a word begins; forth and back are the numbers (see _limbs) of the word and of its
    reverse complement. The cost of a word does not depend on the length of its string.
    """
    data, offsets = codes(strings)
    begin, lengths = offsets[:-1], np.diff(offsets)
    for low in range(0, len(data), AT_ONCE):
        high = min(low + AT_ONCE, len(data))
        letters = data[low : high + size - 1]
        if len(letters) < size:
            return
        base = BASE[np.minimum(letters, 255)]
        seed = SEED[_doubled(np.left_shift(np.uint8(1), base), size, lambda left, right, a, b: left | right)]
        first, last = np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left")
        held = np.minimum(offsets[first + 1 : last + 1], high) - np.maximum(begin[first:last], low)
        row = np.repeat(np.arange(first, last), held)
        pos = np.arange(low, high) - begin[row]
        fits = pos <= lengths[row] - size
        if stride > 1:
            fits &= pos % stride == 0
        if limit is not None:
            fits &= pos <= limit
        fits[: len(seed)] &= seed
        at = np.flatnonzero(fits)
        if len(at):
            yield row[at], pos[at], letters, at, _limbs(base, size, at, False), _limbs(base, size, at, True)


def spelled(letters: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    """The words of `size` letters that begin at some places."""
    words = np.lib.stride_tricks.sliding_window_view(letters.astype(np.uint8, copy=False), size)[at]
    ends = np.arange(0, (len(at) + 1) * size, size, dtype=np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(words)))


def from_numbers(limbs: list, size: int) -> pa.Array:
    """The words of `size` bases that numbers (see _limbs) stand for."""
    letters = np.empty((len(limbs[0]), size), np.uint8)
    bases = np.frombuffer(b"ACGT", np.uint8)
    for k, limb in enumerate(limbs):
        n = min(LIMB, size - k * LIMB)
        for j in range(n):
            letters[:, k * LIMB + j] = bases[(limb >> (2 * (n - 1 - j))) & 3]
    return spelled(letters.reshape(-1), np.arange(len(letters)) * size, size)


def either(forth: list, back: list) -> tuple:
    """(number, forward): one number for a word and its reverse complement, and whether the word is the lesser, or equal, of the two."""
    forward, tied = np.zeros(len(forth[0]), bool), np.ones(len(forth[0]), bool)
    for a, b in zip(forth, back):
        forward |= tied & (a < b)
        tied &= a == b
    forward |= tied
    hashes = np.zeros(len(forward), np.uint64)
    for a, b in zip(forth, back):
        hashes = mixed(hashes * np.uint64(1 << 63 | 1) ^ np.where(forward, a, b).astype(np.uint64))
    return hashes.view(np.int64), forward
