"""Clusters against one sequence after the other; joins on frequent keys; long chains."""

import random

import pytest
from pyspark.sql import functions as F

from readsift import params
from readsift.operators import cluster, skew

rng = random.Random(12)


def dna(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def mutate(s, rate):
    return "".join(rng.choice("ACGT") if rng.random() < rate else c for c in s)


def plain(rows, p):
    """(centroid of each id, similar pairs among centroids): each sequence against all earlier centroids, over all shared words."""
    unique = {}
    for i, s in sorted(rows):
        if len(s) >= p.min_len:
            unique.setdefault(s.upper(), i)
    order = sorted(((i, s) for s, i in unique.items()), key=lambda x: (-len(x[1]), x[0]))
    k = p.word_size

    def words(s):
        out = {}
        for j in range(len(s) - k + 1):
            if len(set(s[j : j + k])) >= 3 and set(s[j : j + k]) <= set("ACGT"):
                out.setdefault(s[j : j + k], []).append(j)
        return out

    cut = {i: words(s) for i, s in order}

    def similar(early, late):
        (a, x), (b, y) = early, late
        for d in {u - v for w in cut[a].keys() & cut[b].keys() for u in cut[a][w] for v in cut[b][w]}:
            s, t = y[max(-d, 0) :], x[max(d, 0) :]
            n = min(len(s), len(t))
            if n * 100 >= min(len(x), len(y)) * p.min_overlap_pct and sum(u == v for u, v in zip(s, t)) * 1000 >= n * round(p.identity * 1000):
                return True
        return False

    centroids, of = [], {}
    for item in order:
        first = next((c for c in centroids if similar(c, item)), None)
        if first is None:
            centroids.append(item)
        of[item[1]] = (first or item)[0]
    return {i: of[s.upper()] for i, s in rows if len(s) >= p.min_len}


def sequences():
    motif = dna(16)  # one word in a third of all sequences, which are else unlike each other
    rows = []
    for _ in range(8):
        base = dna(140)
        for _ in range(9):
            start = rng.randrange(25)
            rows.append(mutate(base[start : start + rng.randint(80, 110)], rng.choice([0, 0.03, 0.08, 0.15])))
    rows += [dna(30) + motif + dna(40) for _ in range(40)] + ["A" * 60 + "C" * 30] * 5 + ["ACGT"] * 3 + ["acg" + dna(50).lower()]
    dense = dna(100)
    rows += [mutate(dense, 0.02) for _ in range(40)] + [(dna(12) * 6)[: 40 + k] for k in range(20)]
    return [(f"r{i:03d}", s) for i, s in enumerate(rows)]


@pytest.mark.parametrize(
    "p", [params.Cluster(), params.Cluster(batch=16, growth=2, sample=1.0), params.Cluster(batch=50, growth=3, dense=0.0, sample=1.0), params.Cluster(dense=0.0)]
)
def test_against_one_by_one(spark, p, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 20)
    rows = sequences()
    want = plain(rows, p)
    df = spark.createDataFrame(rows, "read_id string, seq string")
    assert {r.read_id: r.centroid_id for r in cluster.members(df, p).collect()} == want
    assert {r.read_id for r in cluster.centroids(df, p).collect()} == set(want.values())


def test_no_two_centroids_are_similar(spark):
    rows = [(i, s) for i, s in sequences()]
    df = spark.createDataFrame(rows, "read_id string, seq string")
    ordered = cluster.greedy_order(cluster.centroids(df))
    assert cluster.similar(ordered, ordered).count() == 0 < ordered.count()


def test_nothing_to_cluster(spark):
    none = spark.createDataFrame([("a", "ACGT"), ("b", None)], "read_id string, seq string")
    assert cluster.centroids(none).count() == cluster.members(none).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 2000, 700])
def test_chain_in_few_rounds(spark, limit, monkeypatch):
    n, rounds = 10_000, []
    links = [(i, i - 1) for i in range(1, n)] + [(i, i // 2) for i in range(4, n, 97)]
    joins = set()
    for o, lead in sorted(links):
        if lead not in joins:
            joins.add(o)
    written = cluster.cut_lineage
    monkeypatch.setattr(cluster, "cut_lineage", lambda df: rounds.append(1) or written(df))
    got = cluster.first_come(spark.createDataFrame(links, "ord long, lead long").distinct(), limit)
    assert sorted(r.ord for r in got.collect()) == sorted(joins)
    # at most five writes a round
    assert len(rounds) < 5 * 20


def test_frequent_keys_are_dealt_out(spark):
    # one key in a third of the rows of both sides; small integers elsewhere
    n = 3000
    side = lambda name: spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).cast("long").alias("k"), F.col("id").alias(name))
    left, right = side("a"), side("b")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        known = skew.load(left, right, "k", least=100)
        assert 0 < known.frequent.count() < skew.CELLS * 16 and known.pairs_per_row > 300
        dealt = skew.salted_join(left, right, "k", known.frequent)
        tasks = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("task")).count().collect())
        assert tasks[-1] <= 3 * tasks[len(tasks) // 2] and len(tasks) == 16
        plain = left.join(right, "k")
        assert dealt.count() == plain.count() and dealt.exceptAll(plain).isEmpty()
        sampled = skew.load(left.sample(0.2, seed=3), right.sample(0.2, seed=4), "k", 0.2, least=100)
        assert 0.5 < sampled.pairs_per_row / known.pairs_per_row < 2 and sampled.frequent.where("k = -1").count() == 1
        assert skew.salted_join(left, right, "k", sampled.frequent).count() == plain.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert skew.load(left.limit(0), right, "k").frequent is None
