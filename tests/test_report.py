import pytest

from readsift import schemas
from readsift.operators import report, setops


def hits(spark, rows):
    return spark.createDataFrame(rows, schemas.HIT)


def hit(query, subject, kingdom="Viruses", species="sp", pident=90.0, evalue=1e-20):
    return (query, subject, kingdom, species, "title", pident, evalue)


def test_ties_go_to_identity_then_accession(spark):
    rows = [hit("q", "b"), hit("q", "a"), hit("q", "c", pident=95.0), hit("q", "d", evalue=1e-10)]
    assert report.best_hits(hits(spark, rows), "nt").first().nt_saccver == "c"
    assert report.best_hits(hits(spark, rows[:2]), "nt").first().nt_saccver == "a"


def test_one_side_empty(spark):
    merged = report.merged_report(hits(spark, [hit("q", "a")]), hits(spark, []))
    assert merged.schema.fieldNames() == report.MERGED.fieldNames()
    assert report.viral_rows(merged).count() == 1
    merged = report.merged_report(hits(spark, []), hits(spark, []))
    assert report.viral_rows(merged).count() == 0


def test_several_kingdoms(spark):
    merged = report.merged_report(hits(spark, [hit("q", "a", kingdom="Viruses;Bacteria")]), hits(spark, []))
    assert report.viral_rows(merged).count() == 0
    assert report.viral_rows(merged, any_of_many=True).count() == 1


def test_full_join_and_counts(spark):
    nt = hits(spark, [hit("q1", "a"), hit("q2", "b", kingdom=None), hit("q3", "c", species=None)])
    nr = hits(spark, [hit("q2", "p"), hit("q4", "r", species="other")])
    merged = report.merged_report(nt, nr)
    assert merged.count() == 4
    counts = {(r.search, r.name): r["count"] for r in report.species_counts(report.viral_rows(merged)).collect()}
    assert counts == {("nucleotide", "sp"): 1, ("protein", "sp"): 1, ("protein", "other"): 1}
    shares = report.species_share(report.species_counts(report.viral_rows(merged))).where("search = 'protein'").collect()
    assert sorted(r.share for r in shares) == [0.5, 0.5]


def test_rank_limit_runs_before_the_shuffle(spark):
    plan = report.best_hits(hits(spark, [hit("q", "a")]), "nt")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("found", [[], ["a", "b", "c"], ["b"]])
def test_found_and_not_found_part_the_input(spark, found):
    seqs = spark.createDataFrame([(c, "", "ACGT") for c in "abc"], schemas.SEQUENCE)
    ids = spark.createDataFrame([(f,) for f in found * 2], "qseqid string")
    ids = setops.all_ids(ids, ids)
    one, two = setops.found(seqs, ids), setops.not_found(seqs, ids)
    assert one.count() == len(found) and one.count() + two.count() == 3


def test_not_found_ids_are_sorted_and_distinct(spark):
    seqs = spark.createDataFrame([(c, "words, and a comma", "ACGT") for c in "cabca"], schemas.SEQUENCE)
    merged = report.merged_report(hits(spark, [hit("b", "s")]), hits(spark, []))
    assert [r.read_id for r in setops.not_found_ids(seqs, merged).collect()] == ["a", "c"]
