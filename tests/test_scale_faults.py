"""Inputs beyond former limits: deep taxonomies, long adapter lists, unequal mates, globs of hit tables, odd ids."""

import random

import pytest

from readsift import session
from readsift.operators import adapters as adapters_module, quality, taxonomy, validation
from readsift.sources import fastq, tables


def test_deep_taxonomy(spark):
    deep = 1500
    nodes = spark.createDataFrame(
        [(i, max(1, i - 1), "superkingdom" if i == 2 else "species" if i == deep else "no rank") for i in range(1, deep + 1)],
        "taxid long, parent long, rank string",
    )
    names = spark.createDataFrame([(2, "Viruses"), (deep, "deep one")], "taxid long, name string")
    rows = taxonomy.lineage_table(nodes, names).collect()
    assert len(rows) == deep and all(r.sskingdom == "Viruses" for r in rows if r.taxid > 1)


def test_cycle_in_taxonomy(spark):
    nodes = spark.createDataFrame([(1, 2, "x"), (2, 3, "x"), (3, 1, "x")], "taxid long, parent long, rank string")
    names = spark.createDataFrame([(1, "a")], "taxid long, name string")
    with pytest.raises(ValueError):
        taxonomy.lineage_table(nodes, names)


def one_by_one(seq, adapters):
    for a in adapters:
        for p in range(len(seq) - 3):
            c = min(len(seq) - p, len(a))
            if sum(x != y for x, y in zip(seq[p : p + c], a)) <= c // 8:
                seq = seq[:p]
                break
    return seq


def test_many_adapters(spark, monkeypatch):
    rng = random.Random(3)
    adapters = ["".join(rng.choice("ACGT") for _ in range(rng.randint(4, 40))) for _ in range(150)] + ["ACGTN" * 4, "AAAAAAAAAAAA", "acgtacgtacgt", "ACG"]
    rows = []
    for i in range(600):
        tail = list(rng.choice(adapters) * (i % 3 > 0))
        for _ in range(rng.randint(0, 4)):
            if tail:
                tail[rng.randrange(len(tail))] = rng.choice("ACGTN")
        seq = "".join(rng.choice("ACGTNacgt"[: 4 if i % 5 else 9]) for _ in range(rng.randint(0, 120))) + "".join(tail) + "ACGTACG"[: i % 8]
        rows.append((i, seq, "I" * len(seq)))
    rows += [(600, "A" * 300, "I" * 300), (601, "", ""), (602, None, None)]
    df = spark.createDataFrame(rows, "read_id long, seq string, qual string")
    usable = [a for a in adapters if len(a) > 3]
    for few in (adapters, adapters[:2]):
        got = {r.read_id: (r.seq, r.qual) for r in quality.trim_adapters(df, few).collect()}
        want = {i: s and one_by_one(s, [a for a in few if a in usable]) for i, s, _ in rows}
        assert got == {i: (s, s and "I" * len(s)) for i, s in want.items()}
    monkeypatch.setattr(adapters_module, "TOGETHER", 50)  # long reads stand alone
    got = {r.read_id: r.seq for r in quality.trim_adapters(df, adapters[:20]).collect()}
    assert got == {i: s and one_by_one(s, [a for a in adapters[:20] if a in usable]) for i, s, _ in rows}


def test_counters_come_with_the_run(spark, tmp_path):
    rows = [(f"r{i}", "", "ACGT" * 12 + "AGATCGGAAGAGC"[: i % 14], "I" * (48 + i % 14), i) for i in range(50)] + [("s", "", "ACG", "III", 50), ("l", "", "ACGT" * 20, "#" * 80, 51)]
    df = spark.createDataFrame(rows, "read_id string, description string, seq string, qual string, rec_no long")
    clean, seen = quality.counted_quality_control(df, adapters=["AGATCGGAAGAGC"])
    clean.write.parquet(str(tmp_path / "clean"))
    assert seen.get == quality.quality_stats(df, adapters=["AGATCGGAAGAGC"]).first().asDict()
    assert seen.get["reads_after"] == spark.read.parquet(str(tmp_path / "clean")).count() == 50 and seen.get["too_short"] == 1
    assert clean.exceptAll(quality.quality_control(df, adapters=["AGATCGGAAGAGC"])).isEmpty()


def test_bad_records_end_the_run_that_reads_them(spark, tmp_path):
    good = "".join(f"@r{i} d\nACGT\n+\nIIII\n" for i in range(20))
    (tmp_path / "good.fq").write_text(good)
    (tmp_path / "bad.fq").write_text(good + "@x\nAC!T\n+\nIIII\n")
    assert fastq.read_fastq(spark, str(tmp_path / "good.fq"), validation.checked).count() == 20
    with pytest.raises(Exception, match="bad FASTQ record 20: bases"):
        fastq.read_fastq(spark, str(tmp_path / "bad.fq"), validation.checked).count()


def test_unequal_mates_raise_on_count(spark, tmp_path):
    record = "@r{0}\nACGT\n+\nIIII\n"
    (tmp_path / "a.fq").write_text("".join(record.format(i) for i in range(20)))
    (tmp_path / "b.fq").write_text("".join(record.format(i) for i in range(19)))
    with pytest.raises(Exception, match="differ in their number"):
        fastq.read_pairs(spark, str(tmp_path / "a.fq"), str(tmp_path / "b.fq")).count()


def test_hit_globs_and_ids(spark, tmp_path):
    for k, name in enumerate(("NA", "nan")):
        (tmp_path / f"h{k}.tsv").write_text(f"{name}\tS1\tN/A\tnone\tt\t99.0\t1e-5\n")
    rows = tables.read_hits(spark, str(tmp_path / "h*.tsv")).collect()
    assert {r.qaccver for r in rows} == {"NA", "nan"} and all(r.sskingdom is None for r in rows)
    assert len(tables.read_hits(spark, [str(tmp_path / "h0.tsv"), str(tmp_path / "h1.tsv")]).collect()) == 2
    assert tables.read_hits(spark, str(tmp_path / "no*.tsv")).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_hits(spark, str(tmp_path / "no*.tsv"), absent_is_empty=False)


def test_records_where_offsets_are_not_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in "ab":
            (tmp_path / f"{name}.fq").write_text("".join(f"@{name}{i} d\n{'ACGT' * (i % 20 + 1)}\n+\n{'I' * (4 * (i % 20 + 1))}\n" for i in range(4000)))
        rows = fastq.read_fastq(spark, [str(tmp_path / "a.fq"), str(tmp_path / "b.fq")]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 8000
    assert all(r.read_id == f"{r.read_id[0]}{r.rec_no}" and r.seq == "ACGT" * (r.rec_no % 20 + 1) and len(r.qual) == len(r.seq) for r in rows)
