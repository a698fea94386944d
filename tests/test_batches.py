"""Steps that compare letters in Arrow batches, held against plain Python."""

import random

from readsift.operators import merge
from readsift.params import Merge

PAIR = "rec_no long, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def start(seq1, seq2, p):
    rc = turned(seq2.upper())
    for i in range(max(len(seq1) - len(rc), 0), len(seq1) - p.min_overlap + 1):
        o = len(seq1) - i
        bad = sum(x != y for x, y in zip(seq1[i:], rc[:o]))
        if bad <= p.max_mismatches and bad * 100 <= o * p.max_mismatch_pct:
            return i
    return None


def odd_pairs():
    rnd = random.Random(5)
    text = lambda n, letters="ACGT": "".join(rnd.choices(letters, k=n))
    rows = [("A" * 80, "T" * 75), ("AC" * 40, "GT" * 30), ("", ""), ("ACGT", text(90)), (text(90), ""), (text(40) + "é€𝄞" + text(50), text(60) + "é")]
    for n in range(300):
        whole = text(rnd.randint(60, 180), "ACGT" if n % 3 else "AC")
        a, b = whole[: rnd.randint(20, 120)], turned(whole[-rnd.randint(20, 120) :])
        for _ in range(rnd.randint(0, 7) if b else 0):
            at = rnd.randrange(len(b))
            b = b[:at] + rnd.choice("ACGTNé") + b[at + 1 :]
        rows.append((a, b if n % 5 else b.lower()))
    return rows


def test_merged_pairs_equal_a_search_of_every_overlap(spark):
    rows = odd_pairs()
    pairs = spark.createDataFrame([(n, f"p{n}", a, "I" * len(a), b, "J" * len(b)) for n, (a, b) in enumerate(rows)], PAIR)
    for p in (Merge(), Merge(min_overlap=20, max_mismatches=0), Merge(min_overlap=3, max_mismatches=5, max_mismatch_pct=40), Merge(min_overlap=0)):
        got = {r.rec_no: r.seq for r in merge.merge_pairs(pairs, p).where("origin = 'merged'").collect()}
        want = {}
        for n, (a, b) in enumerate(rows):
            at = start(a, b, p)
            if at is not None:
                want[n] = a + turned(b.upper())[len(a) - at :]
        assert got == want and (len(got) > 20 or p.max_mismatches == 0)


def test_pairs_with_null_mates_stay_apart(spark):
    a = "ACGTTGCAAGGCTTAACCGGATATCGCGTATACCATGCA"
    pairs = spark.createDataFrame([(1, "p", a, "I" * len(a), None, None), (2, "q", None, None, a, "I" * len(a)), (3, "r", a, None, turned(a), None)], PAIR)
    got = sorted((r.rec_no, r.origin, r.seq) for r in merge.merge_pairs(pairs).collect())
    assert got == [(1, "mate1", a), (1, "mate2", None), (2, "mate1", None), (2, "mate2", a), (3, "merged", a)]


def test_no_letter_of_a_pair_goes_through_an_interpreted_lambda(spark):
    plan = merge.merge_pairs(spark.createDataFrame([], PAIR))._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "ArrowEvalPython" in plan


def words_of(text, size, stride=1, limit=None):
    """(pos, word) of the seed words."""
    for i in range(0, len(text) - size + 1, stride):
        w = text[i : i + size]
        if (limit is None or i <= limit) and set(w) <= set("ACGT") and len(set(w)) > 2:
            yield i, w


def odd_texts():
    rnd = random.Random(9)
    texts = ["".join(rnd.choices("ACGT" if n % 3 else "acgtACGTNé", k=rnd.randint(0, 150))) for n in range(60)]
    return [*texts, "ACGTTGCA" * 12, "A" * 90 + "ACGT" * 30, "", "AC" * 50, *texts[:5]]


def test_words_equal_plain_ones_in_parts_of_any_size(spark, monkeypatch):
    import pyarrow as pa

    from readsift.functions import batches

    texts = [*[t.upper() for t in odd_texts()], None]
    for size, stride, limit, part in ((16, 1, None, 1 << 18), (21, 8, None, 100), (17, 4, 50, 37), (31, 1, None, 64), (32, 1, None, 1000), (70, 3, None, 300), (3, 1, None, 7)):
        monkeypatch.setattr(batches, "AT_ONCE", part)
        got, hashes = [], {}
        for row, pos, letters, at, forth, back in batches.seed_words(pa.array(texts), size, stride, limit):
            number, forward = batches.either(forth, back)
            words = batches.spelled(letters, at, size).to_pylist()
            assert batches.from_numbers(forth, size).to_pylist() == words
            got += zip(row.tolist(), pos.tolist(), words, forward.tolist())
            hashes |= dict(zip(words, number.tolist()))
        assert got == [(r, i, w, w <= turned(w)) for r, t in enumerate(texts) for i, w in words_of(t or "", size, stride, limit)]
        lesser = {w: min(w, turned(w)) for w in hashes}
        assert len(set(hashes.values())) == len(set(lesser.values())) and all(hashes.get(x, h) == h for (w, x), h in zip(lesser.items(), hashes.values()))


def test_word_counts_of_subjects_in_one_row_and_in_several(spark, monkeypatch):
    from readsift.operators import index

    monkeypatch.setattr(index, "BUCKET", 500)
    texts = odd_texts()
    # some subjects come in several rows, and some have no name
    rows = [(None if n % 11 == 0 else f"s{n if n % 4 else n % 3}", t) for n, t in enumerate(texts)] + [("s1", texts[1]), ("none", None)]
    df = spark.createDataFrame(rows, "subject_id string, seq string").repartition(3)
    for size in (3, 16, 40):
        want = {}
        for sid, t in rows:
            for _, w in words_of((t or "").upper(), size):
                want.setdefault(w, []).append(sid)
        got = {r.word: (r.positions, r.subjects) for r in index.word_counts(df, size).collect()}
        assert got == {w: (len(s), len(set(s))) for w, s in want.items()}


def test_words_are_cut_and_counted_in_batches(spark):
    from readsift.operators import index

    df = spark.createDataFrame([("s", "ACGTTGCATTAG")], "subject_id string, seq string")
    plan = index.strand_words(df, ["subject_id"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "translate" not in plan
    plan = index.word_counts(df, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "xxhash64" not in plan


def best_of(a, b, match, mismatch):
    """The highest score; the earliest end of it, then the latest start."""
    same = [i < min(len(a), len(b)) and a[i] == b[i] for i in range(max(len(a), len(b)))]
    found = (0, 0, 0, 0)
    for end in range(1, len(same) + 1):
        for start in range(end):
            n = sum(same[start:end])
            score = n * match - (end - start - n) * mismatch
            if score > found[0] or (score == found[0] > 0 and found[1] + found[2] == end and start > found[1]):
                found = (score, start, end - start, n)
    return found


def test_segments_and_equal_positions_equal_plain_ones(spark):
    from pyspark.sql import functions as F

    from readsift.functions.alignment import best_match_segment, equal_positions, top_match_score

    rnd = random.Random(3)
    rows = [("", ""), (None, "ACGT"), ("ACGT", None), (None, None), ("ACGT", "ACGTA"), ("AAAA", "CCCC"), ("é€A𝄞", "é€C𝄞")]
    for n in range(200):
        a = "".join(rnd.choices("ACGT", k=rnd.randint(1, 40)))
        b = "".join(x if rnd.random() < 0.75 else rnd.choice("ACGT") for x in a)
        rows.append((a, b if n % 9 else b[: n % 7]))
    df = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(rows)], "n int, a string, b string")
    made = df.select("n", equal_positions(F.col("a"), F.col("b")).alias("e"), best_match_segment(F.col("a"), F.col("b"), 1, 2).alias("s"), top_match_score(F.col("a"), F.col("b"), 1, 2).alias("t"))
    for r in made.collect():
        a, b = (x or "" for x in rows[r.n])
        assert (r.e, r.t, tuple(r.s)) == (sum(x == y for x, y in zip(a, b)), r.s.score, best_of(a, b, 1, 2)), (a, b)


def test_laid_sequences_go_through_no_interpreted_lambda(spark):
    from pyspark.sql import functions as F

    from readsift.operators import host, index, search

    reads = spark.createDataFrame([("r", "ACGTTGCATTAGCCATGACCATTGACGATCAGG")], "read_id string, seq string")
    built = index.build_index(reads.select(F.col("read_id").alias("subject_id"), "seq"), 17)
    for found in (host.host_alignments(reads, built, long_queries=False), search.search_nucleotide(reads, built, 1e-3, 10, long_queries=False)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "zip_with" not in plan and "ArrowEvalPython" in plan


def plain_cuts(seq, qual, w, least, steps):
    for step in steps:
        if qual is None:
            seq = "" if step == "tail" and seq is not None else None
            continue
        n = len(qual)
        good = [sum(map(ord, qual[i : i + w])) - 33 * w >= least for i in range(n - w + 1)]
        if step == "front":
            start = 0 if n < w else good.index(True) if True in good else n
            seq, qual = seq[start : start + n], qual[start:]
            continue
        m = n
        if step == "tail" and n >= w:
            m = n - good[::-1].index(True) if True in good else 0
        if step == "right" and False in good:
            m = good.index(False)
        seq, qual = seq[:m], qual[:m]
    return seq, qual


def test_quality_cuts_equal_plain_ones(spark):
    from readsift.operators import quality
    from readsift.params import Quality

    rnd = random.Random(4)
    rows = [("ACGT", None), ("", ""), ("ACGTACGT", "IIII"), ("ACG", "!!!"), ("ACGTA", "IIé!!")]
    for n in range(200):
        k = rnd.randint(0, 40)
        qual = "".join(rnd.choices("!'+5:?I" if n % 4 else "!I", k=k))
        rows.append(("".join(rnd.choices("ACGT", k=k + n % 3 // 2 * 5)), qual))
    df = spark.createDataFrame([(n, str(n), s, q) for n, (s, q) in enumerate(rows)], "n int, read_id string, seq string, qual string")
    for w in (1, 4, 7):
        p = lambda **k: Quality(cut_window_size=w, **k)
        cases = [
            (quality.cut_front(df, p()), ["front"]), (quality.cut_tail(df, p()), ["tail"]), (quality.cut_right(df, p()), ["right"]),
            (quality.trim(df, p(cut_front=True, cut_tail=True)), ["front", "tail"]), (quality.trim(df, p(cut_front=True, cut_right=True)), ["front", "right"]),
        ]
        for cut, steps in cases:
            for r in cut.collect():
                assert (r.seq, r.qual) == plain_cuts(*rows[r.n], w, p().cut_mean_quality * w, steps), (rows[r.n], w, steps)
    kept = {r.n for r in quality.filter_mean_quality(df).collect()}
    assert kept == {n for n, (_, q) in enumerate(rows) if q is not None and sum(map(ord, q)) - 33 * len(q) >= 20 * len(q)}


def test_qualities_go_through_no_interpreted_lambda(spark):
    from readsift.operators import quality
    from readsift.params import Quality

    df = spark.createDataFrame([("r", "ACGT", "IIII")], "read_id string, seq string, qual string")
    p = Quality(cut_front=True, cut_tail=True)
    for made in (quality.quality_control(df, p, ["ACGTACGT"]), quality.quality_control(df, p), quality.quality_stats(df, p)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "transform(" not in plan and "aggregate(" not in plan.replace("Aggregate", "") and "ArrowEvalPython" in plan


def test_counts_over_letters_equal_plain_ones(spark):
    from pyspark.sql import functions as F

    from readsift.functions.sequence import count_below, transitions

    rnd = random.Random(6)
    rows = ["", None, "A", "AA", "é€€", ""] + ["".join(rnd.choices("!'+5:?Ié ", k=rnd.randint(0, 9))) for _ in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(rows)), "n int, s string")
    counts = df.select("n", transitions(F.col("s")).alias("t"), count_below(F.col("s"), 15).alias("q15"), count_below(F.col("s"), 30).alias("q30"))
    assert "regexp_replace" not in counts._jdf.queryExecution().optimizedPlan().toString()
    for r in counts.collect():
        s = rows[r.n] or ""
        below = [None if rows[r.n] is None else sum(33 <= ord(c) < 33 + k for c in s) for k in (15, 30)]
        assert (r.t, r.q15, r.q30) == (sum(x != y for x, y in zip(s, s[1:])), *below), s
