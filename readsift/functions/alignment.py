"""Ungapped alignment on one diagonal: equal positions, best segment, e-value."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from readsift.functions.batches import AT_ONCE, codes, in_batches, spread, stretches


SEGMENT = "score int, start int, length int, matches int"
SEGMENT_FIELDS = ["score", "start", "length", "matches"]


def _faced(a: pa.Array, b: pa.Array):
    """(low, high, letters of a, letters of b, lengths) of some rows at a time. Where a string is shorter than the other, or null, it has letters like no other there."""
    (a, a_off), (b, b_off) = codes(a), codes(b)
    if not np.array_equal(a_off, b_off):
        n = np.maximum(np.diff(a_off), np.diff(b_off))
        off = np.concatenate([[0], np.cumsum(n)])
        sides = []
        for none, (data, offsets) in enumerate([(a, a_off), (b, b_off)], 0x110000):
            row, place = spread(np.diff(offsets))
            side = np.full(off[-1], none, np.uint32)
            side[off[row] + place] = data
            sides.append(side)
        (a, b), a_off = sides, off
    for low, high in stretches(np.diff(a_off), AT_ONCE):
        part = slice(a_off[low], a_off[high])
        yield low, high, a[part], b[part], np.diff(a_off[low : high + 1])


def equal_positions(a: Column, b: Column) -> Column:
    """How many positions of two strings agree."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), np.int32)
        for low, high, x, y, n in _faced(a, b):
            seen = np.concatenate([[0], np.cumsum(x == y)])
            ends = np.cumsum(n)
            out[low:high] = seen[ends] - seen[ends - n]
        return pa.array(out)

    return in_batches(run, ["a", "b"], "int")(a, b)


def runs(step: np.ndarray, lengths: np.ndarray) -> tuple:
    """(score, start, length) of the highest-scoring run of positions of each row; `step` has the scores of all rows' positions, one row behind the other.

    Among equal scores the earliest end wins, then the latest start. Rows without a positive score have zeros.
    """
    full = np.flatnonzero(lengths)
    score, start, length = (np.zeros(len(lengths), np.int64) for _ in range(3))
    if not len(full):
        return score, start, length
    n = lengths[full]
    ends = np.cumsum(n)
    begin = ends - n
    row = np.repeat(np.arange(len(n)), n)
    step = step.astype(np.int64)
    total = np.cumsum(step)
    total -= np.repeat(total[begin] - step[begin], n)  # the sum within the row, up to and with each position
    before = total - step
    # the least sum before a position, and the last place that has it; every row lies below the rows before it
    reach = (int(n.max()) + 1) * (max(int(step.max()), 0) - min(int(step.min()), 0) + 1)
    below = before - row * reach
    least = np.minimum.accumulate(below)
    place = np.arange(len(step))
    from_ = np.maximum.accumulate(np.where(below == least, place, 0))
    gain = total - (least + row * reach)
    top = np.maximum.reduceat(gain, begin)
    last = np.minimum.reduceat(np.where(gain == top[row], place, len(step)), begin)
    some = top > 0
    score[full[some]] = top[some]
    start[full[some]] = (from_[last] - begin)[some]
    length[full[some]] = (last + 1 - from_[last])[some]
    return score, start, length


def segments(same: np.ndarray, lengths: np.ndarray, match: int, mismatch: int) -> tuple:
    """runs of rows whose positions agree, or not: `same` tells of all rows, one behind the other, where they do."""
    return runs(np.where(same, match, -mismatch), lengths)


def best_match_segment(a: Column, b: Column, match: int, mismatch: int) -> Column:
    """Highest-scoring run of positions of two strings of equal length: struct(score, start, length, matches). See segments."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros((4, len(a)), np.int32)
        for low, high, x, y, n in _faced(a, b):
            score, start, length = segments(x == y, n, match, mismatch)
            out[:, low:high] = score, start, length, (score + length * mismatch) // (match + mismatch)
        return pa.StructArray.from_arrays([pa.array(c) for c in out], names=SEGMENT_FIELDS)

    return in_batches(run, ["a", "b"], SEGMENT)(a, b)


def top_match_score(a: Column, b: Column, match: int, mismatch: int) -> Column:
    """Score of best_match_segment alone."""
    return best_match_segment(a, b, match, mismatch)["score"]


def scores_by_code(matrix: dict) -> np.ndarray:
    """A substitution matrix over the codes of two letters; a stop or unknown letter ends any segment."""
    out = np.full((256, 256), -100_000, np.int32)
    for (a, b), score in matrix.items():
        out[ord(a), ord(b)] = score
    return out.reshape(-1)


def as_bytes(data: np.ndarray) -> np.ndarray:
    """Codes of letters as bytes; what is not ASCII becomes zero, which no matrix knows."""
    return data if data.dtype == np.uint8 else np.where(data < 128, data, 0).astype(np.uint8)


def scored_segments(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, scores: np.ndarray) -> tuple:
    """(score, start, length, matches) of the best segment of each pair of strings, given as bytes, one pair behind the other."""
    score, start, length = runs(scores[a.astype(np.int32) * 256 + b], lengths)
    seen = np.concatenate([[0], np.cumsum(a == b)])
    begin = np.cumsum(lengths) - lengths + start
    return score, start, length, seen[begin + length] - seen[begin]


def best_protein_segment(a: Column, b: Column, matrix: dict) -> Column:
    """As best_match_segment, for two protein strings of equal length under a substitution matrix."""
    scores = scores_by_code(matrix)

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros((4, len(a)), np.int32)
        for low, high, x, y, n in _faced(a, b):
            out[:, low:high] = scored_segments(as_bytes(x), as_bytes(y), n, scores)
        return pa.StructArray.from_arrays([pa.array(c) for c in out], names=SEGMENT_FIELDS)

    return in_batches(run, ["a", "b"], SEGMENT)(a, b)


def min_score(query_len: Column, db_len: Column, evalue: float, lam: float, k: float) -> Column:
    """Least whole score whose e-value is at most `evalue`."""
    return F.ceil(F.log(query_len.cast("double") * db_len.cast("double") * F.lit(k / evalue)) / lam).cast("int")


def bit_score(score: Column, lam: float, k: float) -> Column:
    return F.round((score * F.lit(lam) - F.lit(math.log(k))) / F.lit(math.log(2)), 1)


def e_value(score: Column, query_len: Column, db_len: Column, lam: float, k: float) -> Column:
    return F.lit(k) * query_len.cast("double") * db_len.cast("double") * F.exp(score * F.lit(-lam))
