"""Reading frames, protein words and scores in Arrow batches, against plain versions."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readsift import params
from readsift.functions import batches, proteins
from readsift.functions.sequence import frame_of
from readsift.operators import index, search

rng = random.Random(41)
MODE = params.SeedMode((params.Seed("1111", False, 2), params.Seed("11011", True, 1), params.Seed("1" * 14, True, 1)))
GROUP = {c: g[0] for g in params.AMINO_GROUPS for c in g}


def dna(n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def plain_words(protein, seeds):
    for k, seed in enumerate(seeds):
        for i in range(len(protein) - len(seed.shape) + 1):
            word = [protein[i + j] for j, x in enumerate(seed.shape) if x == "1"]
            if all(c in GROUP for c in word):
                word = [GROUP[c] for c in word] if seed.reduced else word
                if len(set(word)) >= 3:
                    yield k, i, "".join(word)


@pytest.mark.parametrize("together", [1 << 18, 61, 1])
def test_words_of_frames(spark, together, monkeypatch):
    texts = [dna(rng.randrange(0, 130), rng.choice(["ACGT", "ACGTN", "ACGTRYK*0123"])) for _ in range(40)] + ["", "A", "é" * 9 + dna(60), None, dna(400)]
    df = spark.createDataFrame([(f"r{i}", s) for i, s in enumerate(texts)], "read_id string, seq string")
    frames = search.translate(df).collect()
    want = {}
    for f in (f for f in frames if f.seq is not None):
        for seed, pos, word in plain_words(f.seq, MODE.seeds):
            want[f.read_id, f.frame, f.len, f.query_len, pos, seed] = word
    by_word = {}
    monkeypatch.setattr(proteins, "AT_ONCE", together)
    upper = pa.array([s and s.upper() for s in texts])
    cut = [tuple(x) for part in proteins.frame_seeds(upper, MODE.seeds) for x in zip(*(c.tolist() for c in part))]
    sized = {(f.read_id, f.frame): (f.len, f.query_len) for f in frames}
    got = {}
    for row, frame, seed, pos, hashed in cut:
        got[f"r{row}", frame, *sized[f"r{row}", frame], pos, seed] = hashed
        by_word.setdefault((seed, want[f"r{row}", frame, *sized[f"r{row}", frame], pos, seed]), set()).add(hashed)
    assert got.keys() == want.keys() and len(cut) == len(got) > 1000
    assert all(len(x) == 1 for x in by_word.values()) and len({next(iter(x)) for x in by_word.values()}) == len(by_word)
    if together == 1 << 18:
        made = search.frame_words(df, MODE)
        assert {tuple(r)[1:] + (r[0],) for r in made.select("hash", *search.FRAME, "_qpos", "_seed").collect()} == {(*k, h) for k, h in got.items()}
        # neither the words nor the frames are rows of the JVM before that
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Generate" not in plan


def test_frames_are_laid_against_proteins(spark):
    matrix = params.read_matrix(params.BLOSUM62)
    rows = []
    for i in range(300):
        q, frame = dna(rng.randrange(3, 150), rng.choice(["ACGT", "ACGTN"])), rng.choice([1, 2, 3, -1, -2, -3])
        codons = (len(q) - abs(frame) + 1) // 3
        skip = rng.randrange(max(codons, 1))
        rows.append((q, frame, skip, max(codons - skip - rng.randrange(3), 0) + (40 if i % 50 == 0 else 0)))
    df = spark.createDataFrame(rows, "q string, frame int, skip int, n int")
    segment = F.substring(frame_of(F.col("q"), F.col("frame")), F.col("skip") + 1, F.col("n"))
    df = df.withColumn("segment", segment).withColumn("window", F.rpad(F.translate("segment", "LKV*", "IRVW"), F.col("n"), "W"))
    made = proteins.best_frame_segment(proteins.codons(F.col("q"), F.col("frame"), F.col("skip"), F.col("n")), F.col("frame"), F.col("window"), matrix)
    some = 0
    for r in df.withColumn("got", made).collect():
        best, cur, start, held = (0, 0, 0, 0), 0, 0, 0
        for i, (a, b) in enumerate(zip(r.segment, r.window)):
            if cur <= 0:
                cur, start, held = 0, i, 0
            cur, held = cur + matrix.get((a, b), -100_000), held + (a == b)
            if cur > best[0]:
                best = (cur, start, i + 1 - start, held)
        assert tuple(r.got) == best
        some += best[0] > 15
    assert some > 100


def test_members_hold_all_words_and_few_others(spark):
    df = spark.createDataFrame([(f"s{i}", dna(300)) for i in range(200)], "subject_id string, seq string")
    held = index.members(index.build_index(df, 21))
    assert index.members(index.build_index(df.limit(0), 21)) is None
    reads = df.withColumnRenamed("subject_id", "read_id")
    others = spark.createDataFrame([(f"o{i}", dna(300)) for i in range(200)], "read_id string, seq string")
    every = index.strand_words(reads, ["read_id"], 21).count()
    assert index.strand_words(reads, ["read_id"], 21, among=held).count() == every
    assert 0 < index.strand_words(others, ["read_id"], 21, among=held).count() < 0.2 * every


def test_hashes_are_those_of_spark(spark):
    import numpy as np

    numbers = [0, 1, -1, 1 << 40, -(1 << 63), (1 << 63) - 1] + [rng.randrange(-(1 << 63), 1 << 63) for _ in range(50)]
    want = [r[0] for r in spark.createDataFrame([(x,) for x in numbers], "x long").select(F.xxhash64("x")).collect()]
    assert batches.xxhash64(np.array(numbers)).tolist() == want
