"""Merging of overlapping read pairs into one read."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from readsift.functions.batches import codes, in_batches, spread, stretches, unequal
from readsift.functions.sequence import revcomp
from readsift.params import Merge


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A number for the `size` letters from each place: equal for equal letters."""
    n = max(len(data) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(1_000_003) + data[k : k + n]
    return out


def _overlap_start(p: Merge):
    """A function of seq1 and rc: where in seq1 the longest passing overlap with rc begins, or null.

    With at most m mismatches, one of the m + 1 leading blocks of the overlap agrees exactly. Only
    places with such a block are compared base by base.
    """
    size, count = p.min_overlap // (p.max_mismatches + 1), p.max_mismatches + 1

    def first(a, a_off, b, b_off):
        """For the letters and the offsets of some pairs, the first place that agrees, -1 if none does."""
        out = np.full(len(a_off) - 1, -1, np.int64)
        n1, n2 = np.diff(a_off), np.diff(b_off)
        least = np.maximum(n1 - n2, 0)
        pair, place = spread(np.maximum(n1 - least - p.min_overlap + 1, 0))
        if not len(pair):
            return out
        place += least[pair]
        at, grams, blocks = a_off[pair] + place, _grams(a, size), _grams(b, size)
        likely = np.full(len(pair), size == 0)
        for k in range(count if size else 0):
            # a pair without places may be too short for a block, but then nothing looks at it
            known = blocks[np.minimum(b_off[:-1] + k * size, len(blocks) - 1)]
            likely |= grams[at + k * size] == known[pair]
        pair, place, at = pair[likely], place[likely], at[likely]
        overlap = n1[pair] - place
        bad = unequal(a, at, b, b_off[pair], overlap)
        good = (bad <= p.max_mismatches) & (bad * 100 <= overlap * p.max_mismatch_pct)
        found, which = np.unique(pair[good], return_index=True)  # places of a pair come in order
        out[found] = place[good][which]
        return out

    def run(seq1: pa.Array, rc: pa.Array) -> pa.Array:
        (a, a_off), (b, b_off) = codes(seq1), codes(rc)
        out = np.full(len(seq1), -1, np.int64)
        for low, high in stretches(np.diff(a_off) + np.diff(b_off)):
            out[low:high] = first(a[a_off[low] : a_off[high]], a_off[low : high + 1] - a_off[low], b[b_off[low] : b_off[high]], b_off[low : high + 1] - b_off[low])
        none = (out < 0) | seq1.is_null().to_numpy(zero_copy_only=False) | rc.is_null().to_numpy(zero_copy_only=False)
        return pa.array(out, pa.int32(), mask=none)

    return in_batches(run, ["seq1", "rc"], "int")


def merge_pairs(pairs: DataFrame, p: Merge = Merge()) -> DataFrame:
    """One merged read per overlapping pair; other pairs give both mates, or nothing.

    In: rec_no, read_id, seq1, qual1, seq2, qual2. Out: read_id, description, seq, qual, rec_no and
    origin (merged, mate1, mate2).
    """

    def read(read_id, seq, qual, origin):
        return F.struct(
            read_id.alias("read_id"), F.lit("").alias("description"), seq.alias("seq"), qual.alias("qual"),
            F.lit(origin).alias("origin"),
        )

    mark = (lambda s: F.concat("read_id", F.lit(s))) if p.suffix_mates else (lambda s: F.col("read_id"))
    mates = F.array(
        read(mark("/1"), F.col("seq1"), F.col("qual1"), "mate1"),
        read(mark("/2"), F.col("seq2"), F.col("qual2"), "mate2"),
    )

    shared = F.length("seq1") - F.col("_at")
    tail = lambda c: F.substring(c, shared + 1, F.length("seq2"))
    joined = F.array(read(
        F.col("read_id"), F.concat("seq1", tail(F.col("_rc"))), F.concat("qual1", tail(F.reverse("qual2"))), "merged",
    ))
    apart = mates if p.include_unmerged else F.filter(mates, lambda m: F.lit(False))
    met = pairs.withColumn("_rc", revcomp(F.upper("seq2"))).withColumn("_at", _overlap_start(p)(F.col("seq1"), F.col("_rc")))
    return (
        met.select("rec_no", F.explode(F.when(F.col("_at").isNotNull(), joined).otherwise(apart)).alias("r"))
        .select("r.read_id", "r.description", "r.seq", "r.qual", "rec_no", "r.origin")
    )


def counted_merge_pairs(pairs: DataFrame, p: Merge = Merge()) -> tuple:
    """As merge_pairs, with an Observation of pairs, merged pairs and bases that the run itself fills."""
    seen = Observation()
    bases = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    before = pairs.observe(seen, F.count(F.lit(1)).alias("pairs_before"), bases(F.length("seq1") + F.length("seq2"), "bases_before"))
    after = Observation()
    kind = lambda origin: F.count_if(F.col("origin") == origin).alias(origin)
    reads = merge_pairs(before, p).observe(after, kind("merged"), kind("mate1"), kind("mate2"), bases(F.length("seq"), "bases_after"))
    return reads, (seen, after)
