import random

import pytest
from pyspark.sql import functions as F

from readsift import params
from readsift.functions.alignment import best_match_segment, best_protein_segment
from readsift.functions.sequence import translate_frame
from readsift.operators import cluster, existence, host, index, search, taxonomy
from readsift.plans import pipeline

rng = random.Random(11)


def dna(n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def mutate(s, rate):
    return "".join(rng.choice("ACGT") if rng.random() < rate else c for c in s)


def reads(spark, rows):
    return spark.createDataFrame(rows, "read_id string, seq string")


def best_run(scores):
    """(score, start, length): first end, then latest start, of the highest-scoring run."""
    best, cur, start = (0, 0, 0), 0, 0
    for i, s in enumerate(scores):
        if cur <= 0:
            cur, start = 0, i
        cur += s
        if cur > best[0]:
            best = (cur, start, i + 1 - start)
    return best


def test_segments_against_brute_force(spark):
    rows = [(i, dna(60), None) for i in range(150)]
    rows = [(i, a, mutate(a, 0.3)) for i, a, _ in rows]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    matrix = params.read_matrix(params.BLOSUM62)
    got = df.select(
        "i", best_match_segment(F.col("a"), F.col("b"), 1, 2).alias("n"),
        best_protein_segment(F.col("a"), F.col("b"), matrix).alias("p"),
    ).collect()
    for r in got:
        _, a, b = rows[r.i]
        score, start, length = best_run([1 if x == y else -2 for x, y in zip(a, b)])
        assert (r.n.score, r.n.start, r.n.length) == (score, start, length)
        assert r.n.matches == sum(x == y for x, y in zip(a[start:start + length], b[start:start + length]))
        score, start, length = best_run([matrix[x, y] for x, y in zip(a, b)])
        assert (r.p.score, r.p.start, r.p.length) == (score, start, length)


def test_stop_ends_a_segment(spark):
    df = spark.createDataFrame([("ACDE*FGHIK", "ACDE*FGHIK")], "a string, b string")
    p = df.select(best_protein_segment(F.col("a"), F.col("b"), params.read_matrix(params.BLOSUM62)).alias("p")).first().p
    assert (p.start, p.length, p.matches) == (5, 5, 5)


def planted(n, subjects, rate=0.0):
    out = []
    for i in range(n):
        name, s = subjects[i % len(subjects)]
        p = rng.randrange(len(s) - 120)
        r = mutate(s[p:p + 120], rate)
        out.append((f"r{i}", back(r) if i % 2 else r, name))
    return out


@pytest.mark.parametrize("size,overlap,long_queries", [(65536, 1024, False), (130, 120, False), (64, 32, True)])
def test_pieces_do_not_change_matches(spark, size, overlap, long_queries):
    subjects = [(f"s{i}", dna(700)) for i in range(6)]
    rows = planted(40, subjects, 0.02) + [(f"x{i}", dna(120), None) for i in range(10)]
    known = spark.createDataFrame(subjects, "subject_id string, seq string")
    queries = reads(spark, [r[:2] for r in rows])
    layout = params.Pieces(size, overlap)
    found = host.host_alignments(queries, index.build_index(known, 17, layout), long_queries=long_queries).collect()
    text = dict(subjects)
    got = {r.read_id: r for r in found}
    assert {k: v.subject_id for k, v in got.items()} == {r[0]: r[2] for r in rows if r[2]}
    for i, s, _ in rows:
        if i in got:
            r = got[i]
            turned = s if r.strand == "+" else back(s)
            assert r.mismatches == sum(a != b for a, b in zip(turned, text[r.subject_id][r.pos:]))
    hits = search.search_nucleotide(queries, index.build_index(known, 21, layout), 1e-10, 10, long_queries=long_queries)
    assert {r.read_id: r.subject_id for r in hits.collect()} == {r[0]: r[2] for r in rows if r[2]}


def test_long_query_is_never_cut_short(spark):
    known = spark.createDataFrame([("s", dna(700))], "subject_id string, seq string")
    built = index.build_index(known, 21, params.Pieces(64, 32))
    with pytest.raises(Exception, match="long_queries"):
        search.search_nucleotide(known.select(F.col("subject_id").alias("read_id"), "seq"), built, 1e-3, long_queries=False).collect()
    for asked in (True, None):
        whole = search.search_nucleotide(known.select(F.col("subject_id").alias("read_id"), "seq"), built, 1e-3, long_queries=asked)
        assert whole.first().matches == 700


def test_long_queries_are_noticed_by_every_search(spark):
    """A long contig is found by each search without being announced."""
    text = dna(900)
    known = spark.createDataFrame([("s", text)], "subject_id string, seq string")
    query = reads(spark, [("long", text[50:850]), ("short", text[10:60]), ("none", dna(300))])
    built = index.build_index(known, 17, params.Pieces(64, 32))
    assert {(r.read_id, r.pos) for r in host.host_alignments(query, built).collect()} == {("long", 50), ("short", 10)}
    assert {r.read_id for r in existence.found_host(query, built).collect()} == {"long", "short"}
    assert "long" in {r.read_id for r in existence.found_nucleotide(query, index.build_index(known, 21, params.Pieces(64, 32)), 1e-10).collect()}
    protein = known.select("subject_id", translate_frame(F.col("seq"), 0).alias("seq"))
    mode = params.SEED_MODES["fast"]
    index_p = search.build_protein_index(protein, mode, params.Pieces(64, 32))
    assert {r.read_id for r in search.search_translated(query, index_p, mode, 1e-10).collect()} >= {"long"}
    assert {r.read_id for r in existence.found_translated(query, index_p, mode, 1e-10).collect()} >= {"long"}


@pytest.mark.parametrize("rate,least", [(0.0, 1.0), (0.05, 0.95), (0.10, 0.6)])
def test_recall_of_planted_reads(spark, rate, least):
    subjects = [(f"s{i}", dna(500)) for i in range(10)]
    rows = planted(200, subjects, rate)
    known = spark.createDataFrame(subjects, "subject_id string, seq string")
    hits = search.search_nucleotide(reads(spark, [r[:2] for r in rows]), index.build_index(known, 21), 1e-3, 1).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(truth[h.read_id] == h.subject_id for h in hits)
    assert len(hits) >= least * len(rows)


def test_saved_index_gives_the_same_hits(spark):
    subjects = [(f"s{i}", dna(300)) for i in range(5)]
    known = spark.createDataFrame(subjects, "subject_id string, seq string")
    queries = reads(spark, [r[:2] for r in planted(20, subjects)])
    built = index.build_index(known, 21)
    index.save_index(built, "test_index", buckets=4)
    kept = index.load_index(spark, "test_index", word_size=21)
    run = lambda i: sorted(map(tuple, search.search_nucleotide(queries, i, 1e-5, 5).collect()))
    assert run(kept) == run(built) and len(run(kept)) == 20
    assert kept.layout == built.layout and kept.word_size == 21
    with pytest.raises(ValueError):
        index.load_index(spark, "test_index", word_size=17)


def test_host_modes(spark):
    a, b = dna(300), dna(300)
    subjects = spark.createDataFrame([("x", "a", a), ("y", "b", b)], "ref_name string, subject_id string, seq string")
    queries = reads(spark, [("ra", a[50:150]), ("rb", back(b[50:150])), ("rc", dna(100))])
    kept = lambda *args: {r.read_id for r in host.subtract_host(queries, subjects, *args).collect()}
    assert kept(["x", "y"]) == {"rc"}
    assert kept(["x", "y"], params.HostFilter(mode="last")) == {"ra", "rc"}
    assert kept([]) == {"ra", "rb", "rc"}


def test_lineages(spark):
    nodes = [(1, 1, "no rank"), (2, 1, "no rank"), (3, 2, "superkingdom")]
    nodes += [(i, i - 1, "species" if i == 12 else "clade") for i in range(4, 21)]
    names = [(n[0], f"name{n[0]}") for n in nodes]
    table = taxonomy.lineage_table(
        spark.createDataFrame(nodes, "taxid long, parent long, rank string"),
        spark.createDataFrame(names, "taxid long, name string"),
    )
    got = {r.taxid: (r.sskingdom, r.ssciname) for r in table.collect()}
    assert got[1] == got[2] == (None, None)
    assert got[11] == ("name3", None) and got[12] == ("name3", "name12") and got[20] == ("name3", "name12")


def staged(spark, with_viral):
    virus, other = dna(400), dna(400)
    rows = [("v1", virus[10:130]), ("o1", other[30:150]), ("n1", dna(120))] if with_viral else [("o1", other[30:150]), ("n1", dna(120))]
    known = spark.createDataFrame(
        [("V", virus, "Viruses", "phage", "t"), ("O", other, "Bacteria", "bug", "t")],
        "subject_id string, seq string, sskingdom string, ssciname string, salltitles string",
    )
    proteins = known.withColumn("seq", F.lit("MKLVAAGTWY" * 8))
    db = pipeline.Databases(known.where("sskingdom = 'Viruses'"), proteins.where("sskingdom = 'Viruses'"), known, proteins)
    seqs = spark.createDataFrame([(i, "", s) for i, s in rows], "read_id string, description string, seq string")
    first = pipeline.virus_search(seqs, db)
    return first, pipeline.additional_search(first.unidentified, db)


def ids(df):
    return {r.read_id for r in df.collect()}


def test_staged_search(spark):
    first, more = staged(spark, True)
    assert ids(first.viruses) == {"v1"} and ids(first.unidentified) == {"o1", "n1"}
    assert ids(more.merged) == {"o1"} and ids(more.viruses) == set() and ids(more.unidentified) == {"n1"}
    assert [r["name"] for r in pipeline.species(first.viruses).collect()] == ["phage"]


def test_nothing_viral_sends_all_on(spark):
    first, more = staged(spark, False)
    assert ids(first.merged) == set() and ids(first.unidentified) == {"o1", "n1"}
    assert ids(more.merged) == {"o1"}


def test_prepare(spark):
    base = dna(200)
    rows = [(f"r{i}", "", s, "I" * len(s)) for i, s in enumerate([base[:120], base[:120], mutate(base[:120], 0.02), dna(120), "A" * 100])]
    df = spark.createDataFrame(rows, "read_id string, description string, seq string, qual string")
    refs = spark.createDataFrame([("host", "h", rows[3][2])], "ref_name string, subject_id string, seq string")
    assert pipeline.prepare(df).count() == 2
    assert ids(pipeline.prepare(df, refs, ["host"])) in ({"r0"}, {"r2"})


def test_words_of_long_sequences(spark):
    # words cut from blocks are the words of the whole text, at every stride and limit
    texts = {f"s{n}": dna(n) for n in (0, 20, 21, 255, 256, 257, 276, 277, 1500)}
    df = spark.createDataFrame(list(texts.items()), "subject_id string, seq string")
    for stride, limit in ((1, None), (8, None), (1, 300), (300, None)):
        rows = index.strand_words(df, ["subject_id"], 21, stride, limit).collect()
        got = sorted((r.subject_id, r.pos, r.word) for r in rows)
        stop = lambda t: min(len(t) - 20, len(t) if limit is None else limit + 1)
        assert got == sorted((k, i, t[i : i + 21]) for k, t in texts.items() for i in range(0, max(stop(t), 0), stride))
