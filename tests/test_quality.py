import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from readsift.functions.sequence import revcomp, six_frames, transitions
from readsift.operators import merge, model, quality
from readsift.params import Merge, Quality


def reads(spark, rows):
    return spark.createDataFrame(rows, "read_id string, seq string, qual string")


def cut(spark, fn, qual, **p):
    row = fn(reads(spark, [("a", "A" * len(qual), qual)]), Quality(**p)).first()
    assert len(row.seq) == len(row.qual)
    return row.qual


def test_cuts(spark):
    assert cut(spark, quality.cut_front, "!!!!IIIIII") == "!!IIIIII"
    assert cut(spark, quality.cut_tail, "IIIIII!!!!") == "IIIIII!!"
    assert cut(spark, quality.cut_right, "IIIIII!!!!II") == "IIIII"  # the window from the fifth base on has mean 20
    assert cut(spark, quality.cut_front, "!!!!!!") == "" and cut(spark, quality.cut_tail, "!!!!!!") == ""
    assert cut(spark, quality.cut_right, "IIIIII") == "IIIIII"
    for fn in (quality.cut_front, quality.cut_tail, quality.cut_right):
        assert cut(spark, fn, "!!!") == "!!!"


def brute_adapter(seq, adapter):
    for p in range(len(seq) - 3):
        c = min(len(seq) - p, len(adapter))
        if sum(x != y for x, y in zip(seq[p:p + c], adapter)) <= c // 8:
            return seq[:p]
    return seq


def test_adapters_against_brute_force(spark):
    rng, adapter = random.Random(5), "AGATCGGAAGAGCACACGTCTG"
    rows = []
    for i in range(400):
        tail = list(adapter[: rng.randint(0, len(adapter))])
        for _ in range(rng.randint(0, 3)):
            if tail:
                tail[rng.randrange(len(tail))] = rng.choice("ACGT")
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 60))) + "".join(tail)
        rows.append((str(i), seq, "I" * len(seq)))
    got = {r.read_id: r.seq for r in quality.trim_adapters(reads(spark, rows), [adapter]).collect()}
    assert got == {i: brute_adapter(s, adapter) for i, s, _ in rows}


def test_reasons_in_order(spark):
    rows = [
        ("good", "ACGT" * 10, "I" * 40), ("low", "ACGT" * 10, "#" * 40), ("short", "ACGTACGT", "I" * 8),
        ("flat", "A" * 40, "I" * 40), ("enn", "ACGTA" * 8 + "N" * 6, "I" * 46), ("empty", "", ""),
    ]
    df = reads(spark, rows)
    got = {r.read_id: r.x for r in df.select("read_id", quality.fail_reason(F.col("seq"), F.col("qual")).alias("x")).collect()}
    assert got == {"good": None, "low": "low_quality", "short": "too_short", "flat": "low_complexity", "enn": "low_quality", "empty": "too_short"}
    stats = quality.quality_stats(df).first()
    assert (stats.reads_before, stats.reads_after, stats.low_quality, stats.too_short, stats.low_complexity) == (6, 1, 2, 2, 1)
    assert quality.quality_control(df).count() == 1


def test_merge_takes_the_longest_overlap(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for i in range(120):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.randint(110, 230)))
        one, two = insert[:100], insert[-100:]
        o = 200 - len(insert)
        if o >= 30:
            spoiled = list(two)
            for k in rng.sample(range(o), rng.randint(0, 7)):
                spoiled[k] = "ACGT"[("ACGT".index(spoiled[k]) + 1) % 4]
            bad = sum(x != y for x, y in zip(one[-o:], spoiled))
            two = "".join(spoiled)
            want[str(i)] = one + two[o:] if bad <= 5 and bad * 100 <= o * 20 else None
        else:
            want[str(i)] = None
        back = two[::-1].translate(str.maketrans("ACGT", "TGCA"))
        rows.append((i, str(i), one, "I" * 100, back, "J" * 100))
    pairs = spark.createDataFrame(rows, "rec_no long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {r.read_id: r.seq for r in merge.merge_pairs(pairs, Merge(include_unmerged=False)).collect()}
    assert got == {k: v for k, v in want.items() if v}
    both = merge.merge_pairs(pairs)
    assert both.count() == len(got) + 2 * (120 - len(got))
    assert both.select("read_id").distinct().count() == both.count()
    assert both.where("length(seq) <> length(qual)").isEmpty()


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text("ACGTN", max_size=70), min_size=60, max_size=60))
def test_sequence_functions(spark, seqs):
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, s string")
    rows = df.select("i", revcomp(revcomp(F.col("s"))).alias("twice"), transitions(F.col("s")).alias("t"), six_frames(F.col("s")).alias("f")).collect()
    for r in rows:
        s = seqs[r.i]
        assert r.twice == s
        assert r.t == sum(a != b for a, b in zip(s, s[1:]))
        assert [len(f.protein) for f in r.f] == [max(len(s) - o, 0) // 3 for o in (0, 1, 2)] * 2


def test_translation(spark):
    s = "ATGGCCTAAGN"
    f = {x.frame: x.protein for x in spark.range(1).select(six_frames(F.lit(s)).alias("f")).first().f}
    assert f[1] == "MA*" and f[2] == "WPK" and f[-1] == "X*A"  # NCT TAG GCC


def test_chunks(spark):
    df = spark.createDataFrame([("a", "acgt" * 200), ("b", "A" * 299), ("c", "A" * 300)], "read_id string, seq string")
    rows = sorted((r.id, len(r.seq), r.label) for r in model.model_chunks(df).collect())
    assert rows == [("a_0", 300, 0), ("a_1", 300, 0), ("c_0", 300, 0)]
    try:
        model.score_batch(df, {}, "LSTM")
        raise AssertionError
    except ValueError as e:
        assert "LSTM" in str(e)
