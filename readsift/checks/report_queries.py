"""Queries on hit tables: best hits, merged report, viral rows, counts, set algebra."""

from pyspark.sql import functions as F

from readsift import schemas
from readsift.checks.registry import query
from readsift.checks.views import view
from readsift.operators import report, setops

FIELDS = ["saccver", "sskingdom", "ssciname", "salltitles", "pident", "evalue"]


def hits(spark, sf_dir):
    nt = report.as_hits(view(spark, sf_dir, "fx_nt_hits"))
    nr = report.as_hits(view(spark, sf_dir, "fx_nr_hits"))
    return nt, nr


# SQL of the two best-hit tables and of the merged report
_NR_COLUMNS = "select qseqid as qaccver, sseqid as saccver, sskingdoms as sskingdom, sscinames as ssciname, salltitles, pident, evalue from fx_nr_hits"


def _best(side: str, source: str) -> str:
    fields = ", ".join(f"{f} as {side}_{f}" for f in FIELDS)
    return (
        f"select qaccver as read_id, {fields} from (select *, row_number() over (partition by qaccver "
        f"order by evalue, pident desc, saccver) as rn from ({source})) where rn = 1"
    )


NT_BEST = _best("nt", "select * from fx_nt_hits")
NR_BEST = _best("nr", _NR_COLUMNS)
SIDES = ", ".join(f"{side}_{f}" for side in ("nt", "nr") for f in FIELDS)
MERGED = f"""nt_best as materialized ({NT_BEST}),
nr_best as materialized ({NR_BEST}),
merged as materialized (select coalesce(a.read_id, b.read_id) as read_id, {SIDES}
  from nt_best a full join nr_best b on a.read_id = b.read_id)"""
VIRAL = "nt_sskingdom = 'Viruses' or nr_sskingdom = 'Viruses'"
BOTH = ["fx_nt_hits", "fx_nr_hits"]


@query("best_nt_hit", ["fx_nt_hits"], NT_BEST)
def best_nt_hit(spark, sf_dir):
    return report.best_hits(view(spark, sf_dir, "fx_nt_hits"), "nt")


@query("best_nr_hit", ["fx_nr_hits"], NR_BEST)
def best_nr_hit(spark, sf_dir):
    return report.best_hits(view(spark, sf_dir, "fx_nr_hits"), "nr")


@query("hits_evalue_filter", ["fx_nt_hits"], "select * from fx_nt_hits where evalue <= 1e-10")
def hits_evalue_filter(spark, sf_dir):
    return report.evalue_at_most(view(spark, sf_dir, "fx_nt_hits"), 1e-10)


@query("hits_top_n", ["fx_nt_hits"], """
select * from (select *, row_number() over (partition by qaccver order by evalue, pident desc, saccver) as hit_rank
               from fx_nt_hits) where hit_rank <= 2""")
def hits_top_n(spark, sf_dir):
    return report.top_subjects(view(spark, sf_dir, "fx_nt_hits"), 2).withColumn("hit_rank", F.col("hit_rank").cast("long"))


@query("merged_report", BOTH, f", {MERGED} select * from merged")
def merged_report(spark, sf_dir):
    return report.merged_report(*hits(spark, sf_dir))


EMPTY_NR = f"""
, nt_best as ({NT_BEST})
select *, cast(null as varchar) as nr_saccver, cast(null as varchar) as nr_sskingdom, cast(null as varchar) as nr_ssciname,
       cast(null as varchar) as nr_salltitles, cast(null as double) as nr_pident, cast(null as double) as nr_evalue
from nt_best"""


@query("merged_report_empty_nr", ["fx_nt_hits"], EMPTY_NR)
def merged_report_empty_nr(spark, sf_dir):
    return report.merged_report(view(spark, sf_dir, "fx_nt_hits"), spark.createDataFrame([], schemas.HIT))


@query("virus_rows", BOTH, f", {MERGED} select * from merged where {VIRAL}")
def virus_rows(spark, sf_dir):
    return report.viral_rows(merged_report(spark, sf_dir))


@query("virus_rows_multi_kingdom", BOTH, f""", {MERGED}
select * from merged where list_contains(string_split(nt_sskingdom, ';'), 'Viruses')
                        or list_contains(string_split(nr_sskingdom, ';'), 'Viruses')""")
def virus_rows_multi_kingdom(spark, sf_dir):
    return report.viral_rows(merged_report(spark, sf_dir), any_of_many=True)


def _staged_sql() -> str:
    stages = []
    for stage, limit in (("virus_search", "1e-30"), ("additional_search", "1e-10")):
        nt = _best("nt", f"select * from fx_nt_hits where evalue <= {limit}")
        nr = _best("nr", f"{_NR_COLUMNS} where evalue <= {limit}")
        stages.append(
            f"select coalesce(a.read_id, b.read_id) as read_id, {SIDES}, '{stage}' as stage "
            f"from ({nt}) a full join ({nr}) b on a.read_id = b.read_id where {VIRAL}"
        )
    return "\nunion all\n".join(stages)


@query("virus_append_stages", BOTH, _staged_sql())
def virus_append_stages(spark, sf_dir):
    nt, nr = hits(spark, sf_dir)
    at = lambda limit: report.viral_rows(
        report.merged_report(report.evalue_at_most(nt, limit), report.evalue_at_most(nr, limit))
    )
    return report.append_stages({"virus_search": at(1e-30), "additional_search": at(1e-10)})


COUNTS = f"""{MERGED},
counts as (
  select 'nucleotide' as search, nt_ssciname as name, count(*) as "count" from merged where nt_sskingdom = 'Viruses' group by 1, 2
  union all
  select 'protein', nr_ssciname, count(*) from merged where nr_sskingdom = 'Viruses' group by 1, 2)"""


@query("species_counts", BOTH, f", {COUNTS} select * from counts")
def species_counts(spark, sf_dir):
    return report.species_counts(virus_rows(spark, sf_dir))


@query("species_share", BOTH, f""", {COUNTS}
select search, name, "count", "count" / sum("count") over (partition by search) as share from counts""")
def species_share(spark, sf_dir):
    return report.species_share(species_counts(spark, sf_dir))


LIMIT = 1e-30
STAGE1 = "stage1 as materialized (select qaccver as read_id from fx_nt_hits where evalue <= 1e-30 union select qseqid from fx_nr_hits where evalue <= 1e-30)"
READS = ["fx_reads", *BOTH]


def stage1(spark, sf_dir):
    nt, nr = hits(spark, sf_dir)
    return setops.all_ids(
        report.evalue_at_most(nt, LIMIT).select("qaccver"), report.evalue_at_most(nr, LIMIT).select("qaccver")
    )


def sequences(spark, sf_dir):
    return view(spark, sf_dir, "fx_reads").select("read_id", "description", "seq")


@query("stage1_ids", BOTH, f", {STAGE1} select * from stage1")
def stage1_ids(spark, sf_dir):
    return stage1(spark, sf_dir)


@query("seq_found", READS, f", {STAGE1} select read_id, description, seq from fx_reads where read_id in (select read_id from stage1)")
def seq_found(spark, sf_dir):
    return setops.found(sequences(spark, sf_dir), stage1(spark, sf_dir))


@query("seq_notfound", READS, f", {STAGE1} select read_id, description, seq from fx_reads where read_id not in (select read_id from stage1)")
def seq_notfound(spark, sf_dir):
    return setops.not_found(sequences(spark, sf_dir), stage1(spark, sf_dir))


@query("notfound_ids", READS, f", {MERGED} select distinct read_id from fx_reads where read_id not in (select read_id from merged)")
def notfound_ids(spark, sf_dir):
    return setops.not_found_ids(sequences(spark, sf_dir), merged_report(spark, sf_dir))


@query("notfound_seqs", READS, f", {MERGED} select read_id, description, seq from fx_reads where read_id not in (select read_id from merged)")
def notfound_seqs(spark, sf_dir):
    ids = setops.query_ids(sequences(spark, sf_dir)).subtract(merged_report(spark, sf_dir).select("read_id"))
    return setops.found(sequences(spark, sf_dir), ids)


@query("additional_input", READS, f""", {STAGE1},
stage2 as (select qaccver as read_id from fx_nt_hits where evalue <= 1e-40 union select qseqid from fx_nr_hits where evalue <= 1e-40)
select read_id, description, seq from fx_reads where read_id in (select read_id from stage1) and read_id not in (select read_id from stage2)
union all
select read_id, description, seq from fx_reads where read_id not in (select read_id from stage1)""")
def additional_input(spark, sf_dir):
    nt, nr = hits(spark, sf_dir)
    reads, first = sequences(spark, sf_dir), stage1(spark, sf_dir)
    merged = report.merged_report(report.evalue_at_most(nt, 1e-40), report.evalue_at_most(nr, 1e-40))
    left = setops.not_found(setops.found(reads, first), merged)
    return setops.additional_input(left, setops.not_found(reads, first))
