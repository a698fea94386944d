"""Pairs that share words, from packed words, against a plain version."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readsift.operators import packed

rng = random.Random(51)
SIZE, PCT = 8, 40


def dna(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def sequences():
    base, motif = dna(120), dna(10)
    rows = [base[k : k + 60 + k % 7] for k in range(0, 40, 3)] + [dna(rng.randrange(20)) + motif + dna(30) for _ in range(25)]
    rows += ["AC" * 30, "acgtn" * 8, "é" + base[:50], base[:30] + "N" + base[31:70], motif * 6, "", "ACGTG"]
    rows += ["".join(rng.choice("ACGT") if rng.random() < 0.1 else c for c in base[:70]) for _ in range(12)]
    ranks = rng.sample(range(1, 1 << 40), len(rows))  # in any order, with gaps
    return list(zip(ranks, rows))


def plain(later, earlier, size):
    out = set()
    word = lambda s, i: s[i : i + size] if set(s[i : i + size]) <= set("ACGT") and len(set(s[i : i + size])) >= 3 else None
    for o, a in later:
        for lead, b in earlier:
            for i in range(len(a) - size + 1):
                for j in range(len(b) - size + 1):
                    if lead < o and word(a, i) and word(a, i) == word(b, j):
                        overlap = min(len(a) - max(i - j, 0), len(b) - max(j - i, 0))
                        if overlap * 100 >= min(len(a), len(b)) * PCT:
                            out.add((o, lead, j - i))
    return out


@pytest.mark.parametrize("size", [SIZE, 33])
@pytest.mark.parametrize("split", [False, True])
def test_pairs_equal_plain_ones(spark, size, split, monkeypatch):
    monkeypatch.setattr(packed, "BUCKET", 500)  # many buckets
    rows = sequences()
    df = spark.createDataFrame(rows, "ord long, seq string").repartition(3)
    words = packed.numbered_words(df, size)
    hot = None
    if split:
        often = words.groupBy("hash").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "hash").limit(9)
        hot = often.select("hash", (F.col("n") % 3 + 1).cast("int").alias("_fl"), F.lit(2).alias("_fr"))
    got = packed.shared_runs(df, None, size, PCT, hot).collect()
    want = plain(rows, rows, size)
    assert {tuple(r) for r in got} == want and len(want) > 50
    # a run of shared words makes a row, not each word of it
    assert split or size > SIZE or len(got) < 3 * len(want)
    some, rest = df.where("ord % 3 = 0"), df.where("ord % 3 <> 0")
    got = packed.shared_runs(some, rest, size, PCT, hot).collect()
    part = lambda zero: [r for r in rows if (r[0] % 3 == 0) == zero]
    assert {tuple(r) for r in got} == plain(part(True), part(False), size)


def test_words_travel_in_few_bytes():
    n = 20_000
    columns = [np.arange(n, dtype=np.uint64) * np.uint64(214_013) % np.uint64(1 << 32), np.arange(n) // 80 + (1 << 33), np.arange(n, dtype=np.int32) % 80, np.full(n, 96, np.int32)]
    data = packed._planes(columns, 100, n)
    assert all((a == b[100:]).all() for a, b in zip(packed._read([pa.scalar(data)]), columns))
    assert len(zlib.compress(data, 1)) < 8 * n
