"""Scores of the translated search, and what its modes find."""

import math
import random

import pytest
from pyspark.sql import functions as F

from readsift import params
from readsift.operators import search

rng = random.Random(31)
LETTERS = "".join(params.FREQUENCIES)
CODONS = {"A": "GCT", "R": "CGT", "N": "AAT", "D": "GAT", "C": "TGT", "Q": "CAA", "E": "GAA", "G": "GGT", "H": "CAT", "I": "ATT", "L": "CTT", "K": "AAA", "M": "ATG", "F": "TTT", "P": "CCT", "S": "TCT", "T": "ACT", "W": "TGG", "Y": "TAT", "V": "GTT"}


def test_published_statistics():
    matrix = params.read_matrix(params.BLOSUM62)
    assert len(matrix) == 400 and matrix["W", "W"] == 11 and matrix["A", "R"] == matrix["R", "A"] == -1
    lam, k = params.score_statistics(matrix)
    assert abs(lam - params.ProteinScoring().lam) < 1e-4 and abs(k - params.ProteinScoring().k) < 1e-3
    total = sum(params.FREQUENCIES.values())
    assert abs(sum(params.FREQUENCIES[a] * params.FREQUENCIES[b] / total**2 * math.exp(lam * s) for (a, b), s in matrix.items()) - 1) < 1e-9
    # one letter against many: a walk of steps +1 and -1 has known values
    coin = params.score_statistics({("a", "a"): 1, ("a", "b"): -1, ("b", "a"): -1, ("b", "b"): -1}, {"a": 1, "b": 1})
    assert abs(coin[0] - math.log(3)) < 1e-9
    with pytest.raises(ValueError):
        params.score_statistics({("a", "a"): 1}, {"a": 1})
    assert params.protein_scoring(matrix).lam == lam


def test_sensitive_finds_all_that_fast_finds_and_more(spark):
    protein = lambda n: "".join(rng.choices(LETTERS, params.FREQUENCIES.values(), k=n))
    subjects = [(f"p{i:02d}", protein(90)) for i in range(40)]
    reads = []
    for i in range(400):
        _, s = rng.choice(subjects)
        at = rng.randrange(50)
        rate = rng.choice([0, 0.1, 0.2, 0.3, 0.4])
        own = "".join(rng.choice(LETTERS) if rng.random() < rate else c for c in s[at : at + 40])
        reads.append((f"r{i:03d}", "".join(CODONS[c] for c in own)))
    known = spark.createDataFrame(subjects, "subject_id string, seq string")
    queries = spark.createDataFrame(reads, "read_id string, seq string")
    hits = {}
    for name, mode in params.SEED_MODES.items():
        found = search.search_translated(queries, search.build_protein_index(known, mode), mode, 1e-3)
        hits[name] = {tuple(r) for r in found.select("read_id", "subject_id", "score", F.round(F.log10("evalue"), 3)).collect()}
    ids = lambda name: {h[:2] for h in hits[name]}
    assert ids("fast") <= ids("sensitive") and len(ids("sensitive")) > 1.1 * len(ids("fast")) > 100
    best = {h[:2]: h[2] for h in hits["sensitive"]}
    assert all(best[h[:2]] >= h[2] for h in hits["fast"])
    lam, k = params.ProteinScoring().lam, params.ProteinScoring().k
    assert all(abs(log - math.log10(k * 40 * 90 * 40 * math.exp(-lam * score))) < 0.002 for _, _, score, log in hits["sensitive"])


def test_shapes_leave_out_places(spark):
    mode = params.SeedMode((params.Seed("1101", False, 1), params.Seed("11", True, 1)))
    rows = search.protein_words(spark.createDataFrame([("x", "ACDEFGXW" * 40)], "subject_id string, seq string"), ["subject_id"], mode).collect()
    text = "ACDEFGXW" * 40
    spaced = [i for i in range(len(text) - 3) if "X" not in (w := text[i] + text[i + 1] + text[i + 3]) and len(set(w)) >= 3]
    assert sorted(r.pos for r in rows if r.seed == 0) == spaced and not [r for r in rows if r.seed == 1]  # two letters are never three
