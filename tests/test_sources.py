import gzip

import pytest
from pyspark.sql import functions as F

from readsift import schemas
from readsift.operators import report, validation
from readsift.sources import fasta, fastq, tables


def fastq_lines(n):
    # qualities that begin like a header, to mislead any reader that looks at the text
    return [f"@r{i} lane {i}\n{'ACGT' * (5 + i % 7)}\n+\n{'@+I!' * (5 + i % 7)}\n" for i in range(n)]


def write(path, text):
    path.write_text(text)
    return str(path)


def expect(n):
    return sorted((f"r{i}", f"lane {i}", "ACGT" * (5 + i % 7), "@+I!" * (5 + i % 7), i) for i in range(n))


@pytest.mark.parametrize("size", ["300b", "777b", "5k", "128m"])
def test_fastq_split_anywhere(spark, tmp_path, size):
    path = write(tmp_path / "a.fastq", "".join(fastq_lines(300)))
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write("".join(fastq_lines(50)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        reads = fastq.read_fastq(spark, [path, str(tmp_path / "b.fastq.gz")])
        rows = [tuple(r) for r in reads.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, n in (("a.fastq", 300), ("b.fastq.gz", 50)):
        assert sorted(r[:5] for r in rows if r[5].endswith(name)) == expect(n)


def test_incomplete_record_is_reported(spark, tmp_path):
    path = write(tmp_path / "bad.fastq", "".join(fastq_lines(3)) + "@last\nACGT\n")
    records = fastq.raw_records(spark, path)
    assert [tuple(r) for r in validation.invalid_records(records).collect()] == [(3, "incomplete")]
    with pytest.raises(ValueError, match="incomplete"):
        validation.require_valid(records)


def test_reasons_and_repeated_ids(spark, tmp_path):
    text = "@a\nAC\n+\nII\n>b\nAC\n+\nII\n@c\nAC\n-\nII\n@d\nAC\n+\nI\n@e\nA*\n+\nII\n@f\nAC\n+\nI \n@a x\nAC\n+\nII\n"
    records = fastq.raw_records(spark, write(tmp_path / "x.fastq", text))
    reasons = {r.rec_no: r.reason for r in validation.invalid_records(records).collect()}
    assert reasons == {1: "header", 2: "separator", 3: "length", 4: "bases", 5: "quality"}
    assert [tuple(r) for r in validation.duplicate_ids(records).collect()] == [("a", 2)]


def test_pairs_by_position(spark, tmp_path):
    one = write(tmp_path / "1.fastq", "".join(fastq_lines(20)))
    two = write(tmp_path / "2.fastq", "".join(fastq_lines(20)))
    assert fastq.read_pairs(spark, one, two).where("seq1 = seq2").count() == 20
    short = write(tmp_path / "3.fastq", "".join(fastq_lines(19)))
    with pytest.raises(Exception, match="differ in their number of records"):
        fastq.read_pairs(spark, one, short).collect()


def test_fasta_many_lines_and_marks_in_headers(spark, tmp_path):
    text = ">a first >one, with comma\nACGT\nAC\n\n>b\r\nGG\r\nTT\r\n>c x\nTTTT"
    path = write(tmp_path / "x.fa", text)
    for size in ("9b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = sorted(tuple(r)[:3] for r in fasta.read_fasta(spark, path).collect())
        assert rows == [("a", "first >one, with comma", "ACGTAC"), ("b", "", "GGTT"), ("c", "x", "TTTT")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


def test_adapters_only_if_the_file_is_there(spark, tmp_path):
    assert fasta.read_adapters(spark, str(tmp_path / "none.fa")) == []
    assert fasta.read_adapters(spark, write(tmp_path / "a.fa", ">x\nacgtac\n>y\nGGGG\n")) == ["ACGTAC", "GGGG"]


def test_hit_tables(spark, tmp_path):
    good = 'q1\ts1\tViruses\tN/A\t"odd title\t99.5\t1e-20\n2\ts2\tNA\tsp\tt\t80\t0.0\n'
    rows = tables.read_hits(spark, write(tmp_path / "nt.tsv", good)).orderBy("qaccver").collect()
    assert tuple(rows[0]) == ("2", "s2", None, "sp", "t", 80.0, 0.0)
    assert tuple(rows[1]) == ("q1", "s1", "Viruses", None, '"odd title', 99.5, 1e-20)
    empty = tables.read_hits(spark, str(tmp_path / "none.tsv"))
    assert empty.schema == schemas.HIT and empty.isEmpty()
    with pytest.raises(Exception):
        tables.read_hits(spark, write(tmp_path / "bad.tsv", "q1\ts1\tViruses\n")).collect()


def test_report_append_has_header_in_each_part(spark, tmp_path):
    hits = spark.createDataFrame([("q", "s", "Viruses", "sp", "t", 99.0, 1e-20)], schemas.HIT)
    none = spark.createDataFrame([], schemas.HIT)
    path = str(tmp_path / "viruses")
    tables.write_report(report.viral_rows(report.merged_report(hits, none)), path)
    tables.write_report(report.viral_rows(report.merged_report(none, hits)), path, append=True)
    assert tables.read_report(spark, path).where("read_id = 'q'").count() == 2


def test_taxmap(spark, tmp_path):
    path = write(tmp_path / "map", "accession.version\ttaxid\nA.1\t7\nB.2\t9\n")
    assert sorted(tuple(r) for r in tables.read_taxmap(spark, path).collect()) == [("A.1", 7), ("B.2", 9)]


def test_fastq_writer_keeps_descriptions(spark, tmp_path):
    reads = spark.createDataFrame([("a", "x y", "AC", "II"), ("b", "", "GT", "!!")], "read_id string, description string, seq string, qual string")
    path = str(tmp_path / "out")
    fastq.write_fastq(reads, path)
    back = fastq.read_fastq(spark, path).select(reads.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, reads.collect()))
    assert fastq.fastq_text(reads).where(F.col("value") == "@a x y\nAC\n+\nII").count() == 1
