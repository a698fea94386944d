"""Parameters of every stage, with their defaults."""

import math
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Merge:
    min_overlap: int = 30
    max_mismatches: int = 5
    max_mismatch_pct: int = 20
    include_unmerged: bool = True
    suffix_mates: bool = True


@dataclass(frozen=True)
class Quality:
    average_qual: int = 20
    min_len: int = 36
    complexity_threshold: int = 30
    cut_front: bool = False
    cut_tail: bool = False
    cut_right: bool = False
    cut_window_size: int = 4
    cut_mean_quality: int = 20
    adapter_min_overlap: int = 4
    unqualified_phred: int = 15
    unqualified_pct: int = 40
    max_n: int = 5


@dataclass(frozen=True)
class Words:
    """Exact seed words: `size` bases, taken every `stride` bases of the query.

    Any exact match of size + stride - 1 bases holds at least one such word, so the stride thins the
    shuffled rows without giving up a match of that length. An odd size rules out words that are
    their own reverse complement, so every shared word tells its strand.
    """

    size: int
    stride: int


@dataclass(frozen=True)
class Pieces:
    """Long subjects are stored as pieces of `size` bases plus `overlap` bases of the next piece."""

    size: int = 65536
    overlap: int = 1024


@dataclass(frozen=True)
class HostFilter:
    words: Words = Words(17, 4)
    max_mismatch_pct: int = 10
    mode: str = "all"


@dataclass(frozen=True)
class Cluster:
    identity: float = 0.9
    word_size: int = 16
    min_overlap_pct: int = 80
    min_len: int = 32
    batch: int = 1 << 20  # ranks of the first batch
    growth: int = 8  # of the batches' ends
    dense: float = 64.0  # neighbours by a word, on average; beyond, groups are taken away before all pairs are compared
    sample: float = 0.05  # share of sequences whose words tell which words are frequent; no result depends on it


@dataclass(frozen=True)
class NucleotideScoring:
    """+1/-2 ungapped, with the published Karlin-Altschul values for that pair of scores."""

    match: int = 1
    mismatch: int = 2
    lam: float = 1.33
    k: float = 0.621


# Groups of amino acids that replace each other often; also the reduced alphabet.
AMINO_GROUPS = ("AST", "C", "DEKNQR", "FY", "G", "H", "ILV", "M", "P", "W")


# The published BLOSUM62 scores, lower triangle, in the order of the letters at the row ends.
BLOSUM62 = """
4 A
-1 5 R
-2 0 6 N
-2 -2 1 6 D
0 -3 -3 -3 9 C
-1 1 0 0 -3 5 Q
-1 0 0 2 -4 2 5 E
0 -2 0 -1 -3 -2 -2 6 G
-2 0 1 -1 -3 0 0 -2 8 H
-1 -3 -3 -3 -1 -3 -3 -4 -3 4 I
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4 L
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5 K
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5 M
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6 F
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7 P
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4 S
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5 T
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11 W
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7 Y
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4 V
"""

# Published amino-acid frequencies (Robinson and Robinson), per hundred thousand.
FREQUENCIES = dict(
    A=7805, R=5129, N=4487, D=5364, C=1925, Q=4264, E=6295, G=7377, H=2199, I=5142,
    L=9019, K=5744, M=2243, F=3856, P=5203, S=7120, T=5841, W=1330, Y=3216, V=6441,
)


def read_matrix(text: str) -> dict:
    """(letter, letter) -> score from a lower triangle whose rows end with their letter."""
    scores, letters = {}, []
    for row in text.split("\n"):
        *values, letter = row.split() or [""]
        if letter:
            letters.append(letter)
            for other, value in zip(letters, values, strict=True):
                scores[letter, other] = scores[other, letter] = int(value)
    return scores


def score_statistics(matrix: dict, frequencies: dict = FREQUENCIES, terms: int = 120) -> tuple:
    """lambda and K of ungapped local alignment (Karlin and Altschul) for a matrix and the composition of both sequences."""
    total = sum(frequencies.values())
    chance = {}
    for (a, b), score in matrix.items():
        chance[score] = chance.get(score, 0.0) + frequencies[a] * frequencies[b] / total**2
    if sum(s * p for s, p in chance.items()) >= 0 or max(chance) <= 0:
        raise ValueError("scores must be negative on average, and some positive")
    low, high = 1e-6, 1.0
    while sum(p * math.exp(high * s) for s, p in chance.items()) < 1:
        high *= 2
    for _ in range(200):
        lam = (low + high) / 2
        low, high = (lam, high) if sum(p * math.exp(lam * s) for s, p in chance.items()) < 1 else (low, lam)
    entropy = lam * sum(s * p * math.exp(lam * s) for s, p in chance.items())
    step = math.gcd(*chance)
    # sums of k scores: below zero weighed by the exponential, else by their chance
    walk, sigma = {0: 1.0}, 0.0
    for k in range(1, terms + 1):
        after = {}
        for at, p in walk.items():
            for s, q in chance.items():
                after[at + s] = after.get(at + s, 0.0) + p * q
        walk = {at: p for at, p in after.items() if p > 1e-18}
        sigma += sum(p * math.exp(lam * at) if at < 0 else p for at, p in walk.items()) / k
    return lam, step * lam * math.exp(-2 * sigma) / (entropy * (1 - math.exp(-lam * step)))


@dataclass(frozen=True)
class ProteinScoring:
    """Scores for a translated search, with their lambda and K; `protein_scoring` works these out for any matrix.

    The defaults are those of BLOSUM62 at the published frequencies (see `tests/test_translated.py`).
    """

    matrix: dict = field(default_factory=lambda: read_matrix(BLOSUM62))
    lam: float = 0.3176
    k: float = 0.134


def protein_scoring(matrix: dict, frequencies: dict = FREQUENCIES) -> ProteinScoring:
    return ProteinScoring(matrix, *score_statistics(matrix, frequencies))


@dataclass(frozen=True)
class Seed:
    """A word over the places marked 1 of a shape; `min_words` of them must lie on one diagonal."""

    shape: str
    reduced: bool
    min_words: int


@dataclass(frozen=True)
class SeedMode:
    """The seeds with which a translated search picks candidates; any of them is enough."""

    seeds: tuple

    @property
    def size(self) -> int:
        """Tells saved indexes of different seeds apart."""
        return sum(len(s.shape) * (2 if s.reduced else 1) for s in self.seeds)


_EXACT = Seed("1111111", reduced=False, min_words=2)

# the sensitive mode has the seeds of the fast one, and more
SEED_MODES = {
    "sensitive": SeedMode((
        _EXACT, Seed("1111111111", reduced=True, min_words=1), Seed("1101101110111", reduced=True, min_words=1),
    )),
    "fast": SeedMode((_EXACT,)),
}


@dataclass(frozen=True)
class Search:
    """Thresholds and database names of the staged search."""

    s1_evalue_n: float = 1e-3
    s1_evalue_p: float = 1e-3
    s2_evalue_n: float = 1e-10
    s2_evalue_p: float = 1e-10
    additional_evalue_n: float = 1e-10
    additional_evalue_p: float = 1e-10
    max_target_seqs: int = 10
    virus_nucl_db: str = "virus_nucl"
    virus_prot_db: str = "virus_prot"
    nucl_db: str = "nt"
    prot_db: str = "nr"
    words: Words = Words(21, 8)
    nucleotide: NucleotideScoring = NucleotideScoring()
    protein: ProteinScoring = field(default_factory=ProteinScoring)
