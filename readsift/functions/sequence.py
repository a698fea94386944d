"""Column functions on nucleotide and protein strings. Counts over letters run in Arrow batches, the rest in the JVM."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from readsift.functions.batches import codes, in_batches
from readsift.functions.binding import let

# Letters and their complements.
BASES, COMPLEMENTS = "ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb"

# The standard genetic code, codons in TCAG order, first base slowest.
CODON_BASES = "TCAG"
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, BASES, COMPLEMENTS))


def letters(s: Column) -> Column:
    """Array of single letters; an empty string has none."""
    return F.when(s != "", F.split(s, "")).otherwise(F.array().cast("array<string>"))


def phred(qual: Column) -> Column:
    """Qualities as an int array."""
    return F.transform(letters(qual), lambda c: F.ascii(c) - 33)


def span(n: Column) -> Column:
    """0 .. n-1, and empty where n is below 1 (a bare sequence would count down)."""
    return F.when(n >= 1, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def transitions(seq: Column) -> Column:
    """Number of positions whose next letter differs: runs minus one."""

    def run(seq: pa.Array) -> pa.Array:
        data, offsets = codes(seq)
        seen = np.concatenate([[0], np.cumsum(data[1:] != data[:-1]), [0]])  # pairs of neighbours up to each letter
        first = np.minimum(offsets[:-1], max(len(data) - 1, 0))
        return pa.array(np.where(np.diff(offsets) > 0, seen[np.maximum(offsets[1:] - 1, 0)] - seen[first], 0).astype(np.int32))

    return in_batches(run, ["seq"], "int", once=False)(seq)


def count_letter(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter)))


def count_below(qual: Column, threshold: int) -> Column:
    """Number of qualities below a Phred threshold (at least 1)."""

    def run(qual: pa.Array) -> pa.Array:
        data, offsets = codes(qual)
        seen = np.concatenate([[0], np.cumsum((data >= 33) & (data <= 32 + threshold))])
        return pa.array(np.diff(seen[offsets]).astype(np.int32), mask=qual.is_null().to_numpy(zero_copy_only=False))

    return in_batches(run, ["qual"], "int", once=False)(qual)


def is_seed_word(word: Column) -> Column:
    """Words with other letters than the four bases, or of one or two bases only, are no seeds."""
    return ~word.rlike("[^ACGT]|^(?:[AC]*|[AG]*|[AT]*|[CG]*|[CT]*|[GT]*)$")


def _codon_table() -> list:
    # one cell per three-digit number; digit 4 stands for any other letter and gives X
    cells = []
    for n in range(445):
        digits = (n // 100, n // 10 % 10, n % 10)
        known = all(d < 4 for d in digits)
        cells.append(GENETIC_CODE[digits[0] * 16 + digits[1] * 4 + digits[2]] if known else "X")
    return cells


def _codon_digits(seq: Column) -> Column:
    return F.regexp_replace(F.translate(F.upper(seq), CODON_BASES, "0123"), "[^0-3]", "4")


def _spell(digits: Column, offset: int | Column) -> Column:
    first = F.lit(offset + 1) if isinstance(offset, int) else offset + 1
    codons = F.regexp_extract_all(F.substr(digits, first), F.lit("..."), 0)
    return F.array_join(F.transform(codons, lambda c: F.get(F.lit(_codon_table()), c.cast("int"))), "")


def translate_frame(seq: Column, offset: int) -> Column:
    """Protein string of one reading frame; a codon with an unknown base gives X."""
    return _spell(_codon_digits(seq), offset)


def six_frames(seq: Column) -> Column:
    """Array of (frame, protein): frames 1 to 3 forward, -1 to -3 on the reverse complement."""

    def three(digits, sign):
        return [
            F.struct(F.lit(sign * (o + 1)).alias("frame"), _spell(digits, o).alias("protein")) for o in range(3)
        ]

    return let(_codon_digits(seq), lambda d: let(
        _codon_digits(revcomp(F.upper(seq))), lambda e: F.array(*three(d, 1), *three(e, -1)),
    ))


def frame_of(seq: Column, frame: Column) -> Column:
    """Protein string of the reading frame 1 to 3 or -1 to -3."""
    turned = F.when(frame > 0, F.upper(seq)).otherwise(revcomp(F.upper(seq)))
    return _spell(_codon_digits(turned), F.abs(frame) - 1)
