"""Queries on reads: validation, merging, trimming, filtering, chunks."""

import pandas as pd
from pyspark.sql import functions as F

from readsift import params
from readsift.checks.registry import query
from readsift.checks.views import view
from readsift.operators import merge, model, quality, validation
from readsift.sources import fasta

READ = ["read_id", "seq", "qual"]


def reads(spark, sf_dir):
    return view(spark, sf_dir, "fx_reads").select("read_id", "description", "seq", "qual", "rec_no")


@query("fastq_to_fasta", ["fx_reads"], "select concat('>', read_id, ' ', description, chr(10), seq) as value from fx_reads")
def fastq_to_fasta(spark, sf_dir):
    return fasta.fasta_text(reads(spark, sf_dir))


@query("fastq_invalid", ["fx_records"], """
select * from (
  select rec_no,
         case when header is null or seq is null or separator is null or qual is null then 'incomplete'
              when left(header, 1) <> '@' or length(header) < 2 then 'header'
              when left(separator, 1) <> '+' then 'separator'
              when length(seq) <> length(qual) then 'length'
              when regexp_matches(seq, '[^ACGTURYKMSWBDHVNacgturykmswbdhvn.-]') then 'bases'
              when regexp_matches(qual, '[^!-~]') then 'quality' end as reason
  from fx_records) where reason is not null""")
def fastq_invalid(spark, sf_dir):
    return validation.invalid_records(view(spark, sf_dir, "fx_records"))


@query("fastq_duplicates", ["fx_records"], """
select regexp_extract(substring(header, 2), '^([^ ]*)', 1) as read_id, count(*) as copies from fx_records
group by 1 having count(*) > 1""")
def fastq_duplicates(spark, sf_dir):
    return validation.duplicate_ids(view(spark, sf_dir, "fx_records"))


PAIRS = """
, p as (select *, reverse(translate(seq2, 'ACGT', 'TGCA')) as rc from fx_pairs),
o as (select *, list_filter(range(30, least(length(seq1), length(rc)) + 1),
        lambda n: hamming(right(seq1, n), left(rc, n)) <= 5 and hamming(right(seq1, n), left(rc, n)) * 100 <= n * 20) as good from p),
m as (select *, list_max(good) as best from o)"""
MERGED = """select read_id, concat(seq1, substring(rc, best + 1)) as seq, concat(qual1, substring(reverse(qual2), best + 1)) as qual, 'merged' as origin
from m where best is not null"""
MERGED_COLUMNS = ["read_id", "seq", "qual", "origin"]


@query("merge_pairs", ["fx_pairs"], f"{PAIRS} {MERGED}")
def merge_pairs(spark, sf_dir):
    p = params.Merge(include_unmerged=False)
    return merge.merge_pairs(view(spark, sf_dir, "fx_pairs"), p).select(MERGED_COLUMNS)


@query("merge_keep_unmerged", ["fx_pairs"], f"""{PAIRS} {MERGED}
union all select concat(read_id, '/1'), seq1, qual1, 'mate1' from m where best is null
union all select concat(read_id, '/2'), seq2, qual2, 'mate2' from m where best is null""")
def merge_keep_unmerged(spark, sf_dir):
    return merge.merge_pairs(view(spark, sf_dir, "fx_pairs")).select(MERGED_COLUMNS)


# The adapters put behind some reads.
ADAPTERS = ["AGATCGGAAGAGC", "CTGTCTCTTATA"]

TAILED = f"""
select read_id, rec_no, concat(seq, tail) as seq, concat(qual, substring(repeat('I', 30), 1, cast(length(tail) as int))) as qual
from (select read_id, rec_no, seq, qual,
             case rec_no % 11 when 0 then '{ADAPTERS[0]}' when 3 then 'AGATCGTAAGAGCACGT' when 5 then 'CTGTCT'
                              when 7 then '{ADAPTERS[1]}ACACA' else '' end as tail from fx_reads)"""


def tailed(spark, sf_dir):
    r = reads(spark, sf_dir)
    at = F.col("rec_no") % 11
    tail = (
        F.when(at == 0, ADAPTERS[0]).when(at == 3, "AGATCGTAAGAGCACGT").when(at == 5, "CTGTCT")
        .when(at == 7, ADAPTERS[1] + "ACACA").otherwise("")
    )
    return r.withColumn("_tail", tail).select(
        "read_id", "description", F.concat("seq", "_tail").alias("seq"),
        F.concat("qual", F.repeat(F.lit("I"), F.length("_tail"))).alias("qual"), "rec_no",
    )


def _adapter_sql(source: str) -> str:
    for a in ADAPTERS:
        n = len(a)
        source = (
            f"select * replace (case when cut is null then seq else substring(seq, 1, cut - 1) end as seq, "
            f"case when cut is null then qual else substring(qual, 1, cut - 1) end as qual) "
            f"from (select * exclude (cut), list_min(list_filter(range(1, greatest(length(seq) - 2, 1)), lambda i: "
            f"hamming(substring(seq, i, least(length(seq) - i + 1, {n})), left('{a}', least(length(seq) - i + 1, {n}))) "
            f"<= least(length(seq) - i + 1, {n}) // 8)) as cut from ({source}))"
        )
    return source


@query("adapter_trim", ["fx_reads"], f"select read_id, seq, qual from ({_adapter_sql(f'select *, null as cut from ({TAILED})')})")
def adapter_trim(spark, sf_dir):
    return quality.trim_adapters(tailed(spark, sf_dir), ADAPTERS).select(READ)


SCORED = """
, s as (select *, list_transform(range(1, length(qual) + 1), lambda i: ascii(substring(qual, i, 1)) - 33) as q from fx_reads),
w as (select *, list_transform(range(1, length(qual) - 2), lambda i: q[i] + q[i+1] + q[i+2] + q[i+3]) as sums from s)"""


@query("cut_front", ["fx_reads"], f"""{SCORED},
c as (select *, list_min(list_filter(range(1, len(sums) + 1), lambda i: sums[i] >= 80)) as p from w)
select read_id, case when p is null then '' else substring(seq, p) end as seq, case when p is null then '' else substring(qual, p) end as qual from c""")
def cut_front(spark, sf_dir):
    return quality.cut_front(reads(spark, sf_dir)).select(READ)


@query("cut_tail", ["fx_reads"], f"""{SCORED},
c as (select *, coalesce(list_max(list_filter(range(1, len(sums) + 1), lambda i: sums[i] >= 80)) + 3, 0) as n from w)
select read_id, substring(seq, 1, n) as seq, substring(qual, 1, n) as qual from c""")
def cut_tail(spark, sf_dir):
    return quality.cut_tail(reads(spark, sf_dir)).select(READ)


@query("cut_right", ["fx_reads"], f"""{SCORED},
c as (select *, coalesce(list_min(list_filter(range(1, len(sums) + 1), lambda i: sums[i] < 80)) - 1, length(seq)) as n from w)
select read_id, substring(seq, 1, n) as seq, substring(qual, 1, n) as qual from c""")
def cut_right(spark, sf_dir):
    return quality.cut_right(reads(spark, sf_dir)).select(READ)


@query("filter_length", ["fx_reads"], "select read_id, seq, qual from fx_reads where length(seq) >= 36")
def filter_length(spark, sf_dir):
    return quality.filter_length(reads(spark, sf_dir)).select(READ)


# the parts of the judgement in SQL, on the columns seq and qual
_Q = "list_transform(range(1, length(qual) + 1), lambda i: ascii(substring(qual, i, 1)) - 33)"
MEAN_OK = f"coalesce(list_sum({_Q}), 0) >= length(qual) * 20"
COMPLEX = "len(list_filter(range(1, length(seq)), lambda i: substring(seq, i, 1) <> substring(seq, i + 1, 1))) * 100 >= (length(seq) - 1) * 30"
QUALIFIED = f"(len(list_filter({_Q}, lambda v: v < 15)) * 100 <= length(qual) * 40 and length(seq) - length(replace(seq, 'N', '')) <= 5)"


@query("filter_mean_quality", ["fx_reads"], f"select read_id, seq, qual from fx_reads where {MEAN_OK}")
def filter_mean_quality(spark, sf_dir):
    return quality.filter_mean_quality(reads(spark, sf_dir)).select(READ)


@query("filter_complexity", ["fx_reads"], f"select read_id, seq, qual from fx_reads where {COMPLEX}")
def filter_complexity(spark, sf_dir):
    return quality.filter_complexity(reads(spark, sf_dir)).select(READ)


@query("filter_unqualified", ["fx_reads"], f"select read_id, seq, qual from fx_reads where {QUALIFIED}")
def filter_unqualified(spark, sf_dir):
    return quality.filter_unqualified(reads(spark, sf_dir)).select(READ)


CHAIN = params.Quality(cut_front=True, cut_tail=True)


def _chain_sql() -> str:
    """Front cut, tail cut, adapters, then the first failing filter, as WITH members."""
    cut = lambda what, side, end: f"""
{what}_q as (select *, {_Q} as q from {side}),
{what}_w as (select *, list_filter(range(1, length(qual) - 2), lambda i: q[i] + q[i+1] + q[i+2] + q[i+3] >= 80) as good from {what}_q),
{what} as (select read_id, rec_no, raw, {end('seq')} as seq, {end('qual')} as qual from {what}_w)"""
    front = lambda c: f"case when length({c}) < 4 then {c} when len(good) = 0 then '' else substring({c}, good[1]) end"
    tail = lambda c: f"case when length({c}) < 4 then {c} when len(good) = 0 then '' else substring({c}, 1, good[-1] + 3) end"
    return f""", tailed as materialized (select *, qual as raw from ({TAILED})), {cut('fronted', 'tailed', front)}, {cut('ended', 'fronted', tail)},
trimmed as materialized ({_adapter_sql('select *, null as cut from ended')}),
judged as materialized (
  select *, case when not {QUALIFIED} or not {MEAN_OK} then 'low_quality'
                 when length(seq) < 36 then 'too_short' when not {COMPLEX} then 'low_complexity' end as fail_reason
  from trimmed)"""


@query("qc_chain", ["fx_reads"], f"{_chain_sql()} select read_id, seq, qual from judged where fail_reason is null")
def qc_chain(spark, sf_dir):
    return quality.quality_control(tailed(spark, sf_dir), CHAIN, ADAPTERS).select(READ)


QC_STATS = f"""{_chain_sql()}, t as (
  select *, length(raw) as n, length(seq) as m, list_transform(range(1, length(raw) + 1), lambda i: ascii(substring(raw, i, 1)) - 33) as qr, {_Q} as qt from judged)
select count(*) as reads_before, cast(sum(n) as bigint) as bases_before,
       cast(sum(len(list_filter(qr, lambda v: v >= 20))) as bigint) as q20_before,
       cast(sum(len(list_filter(qr, lambda v: v >= 30))) as bigint) as q30_before,
       count(*) filter (where fail_reason is null) as reads_after,
       cast(coalesce(sum(m) filter (where fail_reason is null), 0) as bigint) as bases_after,
       cast(coalesce(sum(len(list_filter(qt, lambda v: v >= 20))) filter (where fail_reason is null), 0) as bigint) as q20_after,
       cast(coalesce(sum(len(list_filter(qt, lambda v: v >= 30))) filter (where fail_reason is null), 0) as bigint) as q30_after,
       count(*) filter (where fail_reason = 'low_quality') as low_quality,
       count(*) filter (where fail_reason = 'too_short') as too_short,
       count(*) filter (where fail_reason = 'low_complexity') as low_complexity
from t"""


@query("qc_stats", ["fx_reads"], QC_STATS)
def qc_stats(spark, sf_dir):
    return quality.quality_stats(tailed(spark, sf_dir), CHAIN, ADAPTERS)


CHUNKS = """select concat(read_id, '_', cast(i as string)) as id, upper(substring(seq, cast(i * 300 + 1 as int), 300)) as seq, cast(0 as int) as label
from (select read_id, seq, unnest(range(0, length(seq) // 300)) as i from fx_contigs)"""


@query("model_chunks", ["fx_contigs"], CHUNKS)
def model_chunks(spark, sf_dir):
    return model.model_chunks(view(spark, sf_dir, "fx_contigs"))


@query("model_scores_join", ["fx_reads", "fx_scores"], "select r.read_id as id, s.score from fx_reads r join fx_scores s on s.id = r.read_id")
def model_scores_join(spark, sf_dir):
    ids = view(spark, sf_dir, "fx_reads").select(F.col("read_id").alias("id"))
    return model.join_scores(ids, view(spark, sf_dir, "fx_scores"))


def gc_share(seqs: pd.Series) -> pd.Series:
    """Stand-in for a trained model: the share of G and C."""
    return (seqs.str.count("[GC]") / seqs.str.len()).astype("float64")


@query("model_score_batch", ["fx_contigs"], f"""
select id, len(regexp_extract_all(seq, '[GC]')) / length(seq) as score from ({CHUNKS})""")
def model_score_batch(spark, sf_dir):
    return model.score_batch(model_chunks(spark, sf_dir), {"GC": gc_share}, "GC")
