"""Trimming and filtering of reads. Every step works inside a row: no shuffle; windows and adapters are cut in Arrow batches, the rest in the JVM."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F

from readsift.functions.batches import AT_ONCE, codes, in_batches, stretches
from readsift.functions.binding import only
from readsift.functions.sequence import count_below, count_letter, transitions
from readsift.operators.adapters import bases_left, cut_at
from readsift.params import Quality


def _bounds(p: Quality, steps: list):
    """A function of the qualities: struct(start, length) of the part of a read that the steps leave, in their order.

    Windows are summed over whole batches. A window step leaves reads shorter than a window as they are.
    """
    w, least = p.cut_window_size, p.cut_mean_quality * p.cut_window_size

    def part(data, offsets):
        begin, n = offsets[:-1], np.diff(offsets)
        sums = np.concatenate([[0], np.cumsum(data.astype(np.int64) - 33)])
        good = np.concatenate([sums[w:] - sums[:-w] >= least, np.zeros(min(w - 1, len(data)), bool)]) if len(data) >= w else np.zeros(len(data), bool)
        start, length, left = np.zeros(len(n), np.int64), n.copy(), n.copy()

        def between(marks, low, high):
            """The first and the last marked place of low to high (excluded) of all letters, -1 if there is none."""
            at = np.append(np.flatnonzero(marks), -1)
            first, end = np.searchsorted(at[:-1], low), np.searchsorted(at[:-1], high)
            return np.where(first < end, at[first], -1), np.where(first < end, at[end - 1], -1)

        for step in steps:
            wide = left >= w
            low = begin + start
            high = np.maximum(low + left - w + 1, low)
            if step == "front":
                first, _ = between(good, low, high)
                start = np.where(wide, np.where(first >= 0, first - begin, n), 0)
                length, left = n, n - start
            elif step == "tail":
                _, last = between(good, low, high)
                left = np.where(wide, np.where(last >= 0, last + w - low, 0), left)
                length = left
            else:
                first, _ = between(~good, low, high)
                left = np.where(first >= 0, first - low, left)
                length = left
        return start, length

    def run(qual: pa.Array) -> pa.Array:
        data, offsets = codes(qual)
        out = np.zeros((2, len(qual)), np.int32)
        for low, high in stretches(np.diff(offsets), AT_ONCE):
            out[:, low:high] = part(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        # without qualities a tail cut leaves nothing, the others do not know
        none = qual.is_null().to_numpy(zero_copy_only=False) & (steps != ["tail"])
        return pa.StructArray.from_arrays([pa.array(c, mask=none) for c in out], names=["start", "length"])

    return in_batches(run, ["qual"], "start int, length int")


def _trim_steps(p: Quality) -> list:
    steps = ["front"] if p.cut_front else []
    if p.cut_right:
        steps.append("right")
    elif p.cut_tail:
        steps.append("tail")
    return steps


def _apply(reads: DataFrame, p: Quality, steps: list) -> DataFrame:
    if not steps:
        return reads
    order = reads.columns
    kept = lambda c: F.substring(c, F.col("_r.start") + 1, F.col("_r.length"))
    return reads.withColumn("_r", _bounds(p, steps)(F.col("qual"))).withColumns({c: kept(c) for c in ("seq", "qual")}).select(order)


def cut_front(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    """Drop the bases before the first window of good mean quality."""
    return _apply(reads, p, ["front"])


def cut_tail(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    """Drop the bases behind the last window of good mean quality."""
    return _apply(reads, p, ["tail"])


def cut_right(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    """Drop the first window of bad mean quality and all bases right of it."""
    return _apply(reads, p, ["right"])


def trim_adapters(reads: DataFrame, adapters: list, p: Quality = Quality()) -> DataFrame:
    """Cut each read at the first place an adapter begins; adapters apply in the given order."""
    usable = [a for a in adapters if len(a) >= p.adapter_min_overlap]
    if not usable:
        return reads
    left = bases_left(usable, p.adapter_min_overlap)(F.col("seq"))
    cut = reads.withColumn("_left", left).withColumns({c: cut_at(c, F.col("_left")) for c in ("seq", "qual")})
    return cut.select(reads.columns)


def _phred_sum():
    """A function of the qualities: their sum, 0 without qualities."""

    def run(qual: pa.Array) -> pa.Array:
        data, offsets = codes(qual)
        return pa.array(np.diff(np.concatenate([[0], np.cumsum(data.astype(np.int64) - 33)])[offsets]))

    return in_batches(run, ["qual"], "long", once=False)


def mean_quality_ok(qual: Column, threshold: int) -> Column:
    return _phred_sum()(qual) >= F.length(qual) * threshold


def long_enough(seq: Column, min_len: int) -> Column:
    return F.length(seq) >= min_len


def complex_enough(seq: Column, threshold: int) -> Column:
    return transitions(seq) * 100 >= (F.length(seq) - 1) * threshold


def qualified(seq: Column, qual: Column, p: Quality = Quality()) -> Column:
    low = count_below(qual, p.unqualified_phred)
    return (low * 100 <= F.length(qual) * p.unqualified_pct) & (count_letter(seq, "N") <= p.max_n)


def filter_length(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    return reads.where(long_enough(F.col("seq"), p.min_len))


def filter_mean_quality(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    return reads.where(mean_quality_ok(F.col("qual"), p.average_qual))


def filter_complexity(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    return reads.where(complex_enough(F.col("seq"), p.complexity_threshold))


def filter_unqualified(reads: DataFrame, p: Quality = Quality()) -> DataFrame:
    return reads.where(qualified(F.col("seq"), F.col("qual"), p))


def trim(reads: DataFrame, p: Quality = Quality(), adapters: list = ()) -> DataFrame:
    """The cuts that are switched on, then the adapters. A right cut stands in for a tail cut."""
    return trim_adapters(_apply(reads, p, _trim_steps(p)), list(adapters), p)


def fail_reason(seq: Column, qual: Column, p: Quality = Quality()) -> Column:
    """The first filter a read fails, null where it passes all."""
    return (
        F.when(~qualified(seq, qual, p) | ~mean_quality_ok(qual, p.average_qual), "low_quality")
        .when(~long_enough(seq, p.min_len), "too_short")
        .when(~complex_enough(seq, p.complexity_threshold), "low_complexity")
    )


def quality_control(reads: DataFrame, p: Quality = Quality(), adapters: list = ()) -> DataFrame:
    """Trimmed reads that pass every filter."""
    return trim(reads, p, adapters).where(fail_reason(F.col("seq"), F.col("qual"), p).isNull())


def _judged(reads: DataFrame, p: Quality, adapters: list) -> DataFrame:
    """The trimmed reads with `_was`, the lengths before, and `_now`, the lengths after and the filter that a read fails."""

    def counts(seq, qual, *more):
        n = F.length(seq)
        return F.struct(n.alias("bases"), (n - count_below(qual, 20)).alias("q20"), (n - count_below(qual, 30)).alias("q30"), *more)

    before = reads.withColumn("_was", counts(F.col("seq"), F.col("qual")))
    reason = F.coalesce(fail_reason(F.col("seq"), F.col("qual"), p), F.lit("passed")).alias("reason")
    return trim(before, p, adapters).withColumn("_now", only(counts(F.col("seq"), F.col("qual"), reason), lambda t: F.lit(True)))


def _counters() -> list:
    passed = F.col("_now.reason") == "passed"
    bases = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    after = lambda c, name: bases(F.when(passed, F.col(c)), name)
    lost = lambda reason: F.count_if(F.col("_now.reason") == reason).alias(reason)
    return [
        F.count(F.lit(1)).alias("reads_before"), bases("_was.bases", "bases_before"), bases("_was.q20", "q20_before"), bases("_was.q30", "q30_before"),
        F.count_if(passed).alias("reads_after"), after("_now.bases", "bases_after"), after("_now.q20", "q20_after"), after("_now.q30", "q30_after"),
        lost("low_quality"), lost("too_short"), lost("low_complexity"),
    ]


def quality_stats(reads: DataFrame, p: Quality = Quality(), adapters: list = ()) -> DataFrame:
    """One row of counters over the whole stage: before, after, and reads lost per reason."""
    return _judged(reads, p, adapters).agg(*_counters())


def counted_quality_control(reads: DataFrame, p: Quality = Quality(), adapters: list = ()) -> tuple:
    """As quality_control, with an Observation of the counters: it is filled by the run that writes the reads, not by one of its own."""
    seen = Observation()
    kept = _judged(reads, p, adapters).observe(seen, *_counters()).where("_now.reason = 'passed'")
    return kept.select(reads.columns), seen
