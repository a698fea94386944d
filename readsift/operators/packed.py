"""Pairs of sequences that share words, from words that travel packed.

Words are shuffled as numbers in few bytes, many to a row, to buckets that their hash names; a bucket's words are sorted and met as arrays. Two sequences that
share a run of words on a diagonal meet once, at the first word of the run: a word goes with the letter before it, and two words behind the same letter
are left out, as those one place before are shared, too. So what is made grows with the pairs, not with the words they share.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from readsift.functions.batches import BASE, either, mixed, seed_words, spread, stretches
from readsift.session import ship

BUCKET = 1 << 21  # letters whose words meet in one bucket
TOGETHER = 1 << 20  # pairs worked on at once
RAW = 30  # bases of a word that its number tells from all others; longer ones go by a hash of 61 bits
PACKED = "bucket int, cell int, side int, data binary"
BOTH, MEMBER, LEAD = 0, 1, 2  # sides
FIELDS = (("key", np.uint64), ("ord", np.int64), ("pos", np.int32), ("len", np.int32))


def _numbers(limbs: list, size: int) -> np.ndarray:
    """A number below 2**61 for each word."""
    return limbs[0].astype(np.uint64) if size <= RAW else either(limbs, limbs)[0].view(np.uint64) >> np.uint64(3)


def numbered_words(sequences: DataFrame, size: int) -> DataFrame:
    """(hash, ord, pos) of the seed words of (ord, seq); words as they stand, not as either strand."""
    ship(sequences.sparkSession)

    def cut(batches):
        for batch in batches:
            for row, pos, _, _, limbs, _ in seed_words(batch["seq"], size):
                taken = batch["ord"].take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(_numbers(limbs, size).view(np.int64)), taken, pa.array(pos, pa.int32())], names=["hash", "ord", "pos"])

    texts = sequences.select("ord", "seq")
    made = StructType([StructField("hash", LongType()), texts.schema["ord"], StructField("pos", IntegerType())])
    return texts.mapInArrow(cut, made)


def _cut(batches, size: int):
    """(key, ord, pos, len) of the words of a part; the key has the number of a word above, and below it the letter before, or 0 where no word begins there."""
    for batch in batches:
        ords = batch["ord"].to_numpy(zero_copy_only=False)
        lengths = pc.utf8_length(batch["seq"]).fill_null(0).to_numpy(zero_copy_only=False)
        for row, pos, letters, at, limbs, _ in seed_words(batch["seq"], size):
            behind = np.zeros(len(at), np.uint64)
            follows = np.flatnonzero((np.diff(at) == 1) & (np.diff(row) == 0)) + 1
            behind[follows] = 1 + BASE[np.minimum(letters[at[follows] - 1], 255)]
            yield _numbers(limbs, size) << np.uint64(3) | behind, ords[row].astype(np.int64), pos.astype(np.int32), lengths[row]


def _planes(columns: list, low: int, high: int) -> bytes:
    """Some rows of columns, byte by byte of their numbers: the upper bytes, mostly equal, take no room when compressed."""
    out = []
    for k, c in enumerate(columns):
        part = c[low:high]
        if k == 1:  # neighbours in a part are mostly neighbours in rank
            part = np.diff(part, prepend=0)
        out.append(np.ascontiguousarray(part).view(np.uint8).reshape(high - low, -1).T.tobytes())
    return b"".join(out)


def _read(data: list) -> list:
    """The columns of rows of _planes, one behind the other."""
    size = sum(np.dtype(t).itemsize for _, t in FIELDS)
    parts = [[] for _ in FIELDS]
    for x in data:
        x = np.frombuffer(x.as_buffer(), np.uint8)
        n, low = len(x) // size, 0
        for k, (_, kind) in enumerate(FIELDS):
            width = np.dtype(kind).itemsize
            column = np.ascontiguousarray(x[low : low + n * width].reshape(width, n).T).view(kind).reshape(-1)
            parts[k].append(np.cumsum(column) if k == 1 else column)
            low += n * width
    return [np.concatenate(p) if p else np.zeros(0, kind) for p, (_, kind) in zip(parts, FIELDS, strict=True)]


def _dealt(columns: list, bucket: np.ndarray, cell: int, side: int):
    """Rows of words, one for each bucket."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    columns = [c[order] for c in columns]
    held, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first, len(order))
    rows = [_planes(columns, low, high) for low, high in zip(ends, ends[1:])]
    same = lambda v: pa.array(np.full(len(held), v, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), same(cell), same(side), pa.array(rows, pa.binary())], names=["bucket", "cell", "side", "data"])


def _packer(size: int, buckets: int, side: int, frequent: list):
    """Words to rows. A frequent word's holders go to cells: members of a part meet the leads of a part in one."""
    hot = np.array([k for k, _, _ in frequent], np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, fl, fr = hot[order], *(np.array([f[j] for f in frequent], np.int64)[order] for j in (1, 2))
    first_cell = 1 + np.cumsum(fl * fr) - fl * fr  # cells are numbered through

    def pack(batches):
        for columns in _cut(batches, size):
            word = columns[0] >> np.uint64(3)
            home = (mixed(word) % np.uint64(buckets)).astype(np.int64)
            if len(hot):
                k = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
                split = hot[k] == word
                for w in np.unique(k[split]):
                    at = np.flatnonzero(split & (k == w))
                    one = [c[at] for c in columns]
                    drawn = mixed(one[1].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ one[2].astype(np.uint64))
                    for i in range(fl[w]):
                        for j in range(fr[w]):
                            cell = int(first_cell[w] + i * fr[w] + j)
                            sides = ([(MEMBER, drawn % np.uint64(fl[w]) == i)] if side != LEAD else []) + ([(LEAD, drawn % np.uint64(fr[w]) == j)] if side != MEMBER else [])
                            for which, mine in sides:
                                if mine.any():
                                    yield _dealt([c[mine] for c in one], np.full(int(mine.sum()), (int(home[at[0]]) + cell) % buckets, np.int64), cell, which)
                columns, home = [c[~split] for c in columns], home[~split]
            if len(home):
                yield _dealt(columns, home, 0, side)

    return pack


def _among(words: list):
    """(later, earlier) rows of pairs of words that are equal and not behind the same word; each pair once."""
    key = words[0]
    n = np.arange(len(key))
    new = lambda x: np.concatenate([[True], x[1:] != x[:-1]]) if len(x) else np.zeros(0, bool)
    group = np.maximum.accumulate(np.where(new(key >> np.uint64(3)), n, 0))
    alike = np.maximum.accumulate(np.where(new(key), n, 0))
    counts = np.where(key & np.uint64(7) == 0, n, alike) - group
    for low, high in stretches(counts, TOGETHER):
        row, place = spread(counts[low:high])
        if len(row):
            yield row + low, group[low:high][row] + place


def _between(members: list, leads: list):
    """(member, lead) rows of pairs of words that are equal and not behind the same word."""
    key, lead = members[0], leads[0]
    word = key >> np.uint64(3)
    first, last = np.searchsorted(lead, word << np.uint64(3)), np.searchsorted(lead, word << np.uint64(3) | np.uint64(7), "right")
    fresh = key & np.uint64(7) == 0
    low_same = np.where(fresh, last, np.searchsorted(lead, key))
    high_same = np.where(fresh, last, np.searchsorted(lead, key, "right"))
    before = low_same - first
    counts = before + last - high_same
    for low, high in stretches(counts, TOGETHER):
        row, place = spread(counts[low:high])
        if len(row):
            row = row + low
            yield row, np.where(place < before[row], first[row] + place, high_same[row] + place - before[row])


def _sorted(words: list) -> list:
    order = np.argsort(words[0])
    return [c[order] for c in words]


def shared_runs(sequences: DataFrame, earlier: DataFrame | None, size: int, min_overlap_pct: int, frequent: DataFrame | None) -> DataFrame:
    """(ord, lead, diag): each of (ord, seq) against all earlier ones of `earlier`, or of its own, that share a word, on the diagonals of these words.

    Diagonals on which less than `min_overlap_pct` of the shorter sequence would face the other are left out. A row may come several times.
    """
    spark = sequences.sparkSession
    ship(spark)
    letters = sum(df.agg(F.sum(F.length("seq"))).first()[0] or 0 for df in (sequences, earlier) if df is not None)
    buckets = 1 + letters // BUCKET
    split = [tuple(r) for r in frequent.collect()] if frequent is not None else []  # bounded, see skew.load
    packed = lambda df, side: df.select("ord", "seq").mapInArrow(_packer(size, buckets, side, split), PACKED)
    rows = packed(sequences, BOTH) if earlier is None else packed(sequences, MEMBER).unionByName(packed(earlier, LEAD))

    def meet(batches):
        held = {}
        for batch in batches:
            for cell, side, data in zip(batch["cell"].to_pylist(), batch["side"].to_pylist(), batch["data"]):
                held.setdefault(cell, ([], [], []))[side].append(data)
        for both, members, leads in held.values():
            sides = [_sorted(_read(x)) for x in ((both,) if both else (members, leads))]
            pairs, a, b = (_among(*sides), sides[0], sides[0]) if both else (_between(*sides), *sides)
            for x, y in pairs:
                if both:
                    x, y = np.where(a[1][x] < a[1][y], y, x), np.where(a[1][x] < a[1][y], x, y)
                diag = b[2][y] - a[2][x]
                na, nb = a[3][x].astype(np.int64), b[3][y].astype(np.int64)
                overlap = np.minimum(na - np.maximum(-diag, 0), nb - np.maximum(diag, 0))
                kept = (b[1][y] < a[1][x]) & (overlap * 100 >= np.minimum(na, nb) * min_overlap_pct)
                if kept.any():
                    yield pa.RecordBatch.from_arrays([pa.array(a[1][x][kept]), pa.array(b[1][y][kept]), pa.array(diag[kept])], names=["ord", "lead", "diag"])

    meet.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return rows.groupBy("bucket").applyInArrow(meet, "ord long, lead long, diag int")
