"""Adapter lists of any length: one index over the list's blocks, looked up once for all reads of a batch."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

TOGETHER = 1 << 20  # bases worked on at once; a longer read stands alone


def bases_left(adapters: list, min_overlap: int):
    """A function of a column: the bases of a read that stay when the adapters are cut off in the given order.

    An adapter begins where it agrees with the read over their common length, of at least `min_overlap`, with one mismatch allowed
    per full eight bases. So of its leading blocks, one more than the allowed mismatches, at least one agrees exactly. All places
    of a batch are sorted by the block that begins there; each adapter then visits only the places of its own blocks.
    """
    q = min(4, min_overlap)
    usable = [a for a in adapters if len(a) >= min_overlap]
    letters = sorted(set("".join(usable)))
    code = np.zeros(256, np.int64)  # 0: a letter of no adapter
    code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    width = len(letters) + 1
    weights = width ** np.arange(q - 1, -1, -1)
    blocks = []
    for a in usable:
        raw = np.frombuffer(a.encode(), np.uint8)
        count = min(len(raw) // 8 + 1, len(raw) // q)
        blocks.append((raw, [int(code[raw[k * q : (k + 1) * q]] @ weights) for k in range(count)]))

    def left(data, offsets):
        """For the bytes and the offsets of some reads, the length that each keeps."""
        begin, end = offsets[:-1], np.diff(offsets).astype(np.int64)
        if len(data) < q:
            return end
        at = code[data]
        grams = sum(at[k : len(at) - q + 1 + k] * w for k, w in enumerate(weights.tolist()))
        order = np.argsort(grams.astype(np.uint16) if width**q <= 1 << 16 else grams, kind="stable")
        ranked = grams[order]
        for raw, keys in blocks:
            found = [order[slice(*np.searchsorted(ranked, [key, key + 1]))] - k * q for k, key in enumerate(keys)]
            place = np.concatenate(found)
            place = place[place >= 0]
            read = np.searchsorted(offsets, place, "right") - 1
            inside = place - begin[read]
            # places near enough to the end of what is left of their read
            near = inside <= end[read] - min_overlap
            place, read, inside = place[near], read[near], inside[near]
            common = np.minimum(end[read] - inside, len(raw))
            bad = np.zeros(len(place), np.int64)
            for j, base in enumerate(raw.tolist()):
                bad += (j < common) & (data[np.minimum(place + j, len(data) - 1)] != base)
            good = bad <= common // 8
            np.minimum.at(end, read[good], inside[good])
        return end

    def run(seq: pa.Array) -> pa.Array:
        seq = seq.cast(pa.large_binary()).fill_null(b"")
        _, ends, data = seq.buffers()
        offsets = np.frombuffer(ends, np.int64)[seq.offset : seq.offset + len(seq) + 1]
        data = np.frombuffer(data or b"", np.uint8)
        out, low = np.zeros(len(seq), np.int32), 0
        while low < len(seq):
            high = min(max(int(np.searchsorted(offsets, offsets[low] + TOGETHER, "right")) - 1, low + 1), len(seq))
            out[low:high] = left(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            low = high
        return pa.array(out)

    # annotated here, as the function travels to workers by value
    run.__annotations__ = {"seq": pa.Array, "return": pa.Array}
    # else filters behind it would be pushed below it, and the call copied into their lambdas
    return F.arrow_udf(run, "int").asNondeterministic()


def cut_at(column: str, left: Column) -> Column:
    return F.substring(column, F.lit(1), left)
