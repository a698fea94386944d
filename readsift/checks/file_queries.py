"""Queries that write files and read them back."""

from pyspark.sql import functions as F

from readsift import params
from readsift.checks.registry import query
from readsift.checks.read_queries import ADAPTERS, CHAIN, PAIRS, QC_STATS, TAILED, tailed
from readsift.checks.report_queries import BOTH, COUNTS, EMPTY_NR, MERGED, VIRAL, hits
from readsift.checks.views import view
from readsift.operators import merge, model, quality, report, validation
from readsift.session import scratch_path
from readsift.sources import fasta, fastq, tables


def reads(spark, sf_dir):
    return view(spark, sf_dir, "fx_reads").select("read_id", "description", "seq", "qual")


@query("fastq_roundtrip", ["fx_reads"], "select read_id, description, seq, qual from fx_reads")
def fastq_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "fastq")
    fastq.write_fastq(reads(spark, sf_dir), path)
    return fastq.read_fastq(spark, path).select("read_id", "description", "seq", "qual")


@query("fastq_file_valid", ["fx_reads"], "select read_id, seq from fx_reads")
def fastq_file_valid(spark, sf_dir):
    path = scratch_path(spark, "fastq")
    fastq.write_fastq(reads(spark, sf_dir), path)
    return fastq.read_fastq(spark, path, validation.checked).select("read_id", "seq")


@query("pairs_file_merge", ["fx_pairs"], """
, p as (select *, reverse(translate(seq2, 'ACGT', 'TGCA')) as rc from fx_pairs),
m as (select *, list_max(list_filter(range(30, 101), lambda n: hamming(right(seq1, n), left(rc, n)) <= 5 and hamming(right(seq1, n), left(rc, n)) * 100 <= n * 20)) as best from p)
select read_id, concat(seq1, substring(rc, best + 1)) as seq from m where best is not null
union all select concat(read_id, '/1'), seq1 from m where best is null
union all select concat(read_id, '/2'), seq2 from m where best is null""")
def pairs_file_merge(spark, sf_dir):
    pairs = view(spark, sf_dir, "fx_pairs").withColumn("description", F.lit(""))
    paths = [scratch_path(spark, "mate1"), scratch_path(spark, "mate2")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for i, path in enumerate(paths, 1):
        # the same split and order for both mates, so that the n-th records of the i-th files belong together
        mate = pairs.select("rec_no", "read_id", "description", F.col(f"seq{i}").alias("seq"), F.col(f"qual{i}").alias("qual"))
        fastq.write_fastq(mate.repartition(parts, "rec_no").sortWithinPartitions("rec_no"), path)
    return merge.merge_pairs(fastq.read_pairs(spark, *paths)).select("read_id", "seq")


@query("fasta_roundtrip", ["fx_reads"], "select read_id, description, seq from fx_reads")
def fasta_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "fasta")
    fasta.write_fasta(reads(spark, sf_dir), path)
    return fasta.read_fasta(spark, path).select("read_id", "description", "seq")


FILE_PIECES = params.Pieces(128, 100)  # subjects have several


@query("fasta_file_pieces", ["fx_subject"], f"""
select subject_id, cast(i as int) as piece, cast(length(seq) as int) as subject_len, substring(seq, cast(i * {FILE_PIECES.size} + 1 as int), {FILE_PIECES.size + FILE_PIECES.overlap}) as seq
from (select subject_id, seq, unnest(range(0, (length(seq) + {FILE_PIECES.size - 1}) // {FILE_PIECES.size})) as i from fx_subject)""")
def fasta_file_pieces(spark, sf_dir):
    return file_pieces(spark, sf_dir).select("subject_id", "piece", "subject_len", "seq")


def file_pieces(spark, sf_dir):
    path = scratch_path(spark, "subjects")
    subjects = view(spark, sf_dir, "fx_subject").select(F.col("subject_id").alias("read_id"), F.lit("").alias("description"), "seq")
    fasta.write_fasta(subjects, path, width=60)
    return fasta.read_fasta_pieces(spark, path, FILE_PIECES)


@query("report_files_roundtrip", BOTH, f", {MERGED} select * from merged")
def report_files_roundtrip(spark, sf_dir):
    paths = [scratch_path(spark, side) for side in ("nt", "nr", "report")]
    for df, path in zip(hits(spark, sf_dir), paths):
        tables.write_hits(df, path)
    merged = report.merged_report(tables.read_hits(spark, paths[0]), tables.read_hits(spark, paths[1]))
    tables.write_report(merged, paths[2])
    return tables.read_report(spark, paths[2])


@query("virus_files_counts", BOTH, f", {COUNTS} select * from counts")
def virus_files_counts(spark, sf_dir):
    path = scratch_path(spark, "viruses")
    tables.write_report(report.viral_rows(report.merged_report(*hits(spark, sf_dir))), path)
    return report.species_counts(tables.read_report(spark, path))


@query("missing_hit_file", ["fx_nt_hits"], EMPTY_NR)
def missing_hit_file(spark, sf_dir):
    paths = [scratch_path(spark, "nt"), scratch_path(spark, "never-written")]
    tables.write_hits(hits(spark, sf_dir)[0], paths[0])
    return report.merged_report(*[tables.read_hits(spark, p) for p in paths])


@query("id_list_roundtrip", BOTH, f", {MERGED} select read_id from merged where {VIRAL}")
def id_list_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "ids")
    tables.write_ids(report.viral_rows(report.merged_report(*hits(spark, sf_dir))), path)
    return tables.read_ids(spark, path)


@query("taxonomy_files", ["fx_taxnodes"], "select n.taxid, n.parent, n.rank, n.name from fx_taxnodes n")
def taxonomy_files(spark, sf_dir):
    nodes = view(spark, sf_dir, "fx_taxnodes")
    paths = [scratch_path(spark, "nodes"), scratch_path(spark, "names")]
    row = lambda *cells: F.concat(F.concat_ws("\t|\t", *[F.col(c).cast("string") if c in nodes.columns else F.lit(c) for c in cells]), F.lit("\t|"))
    nodes.select(row("taxid", "parent", "rank")).write.text(paths[0])
    names = nodes.select(row("taxid", "name", "unused", "scientific name")).union(nodes.select(row("taxid", "rank", "unused", "synonym")))
    names.write.text(paths[1])
    return tables.read_taxnodes(spark, paths[0]).join(tables.read_taxnames(spark, paths[1]), "taxid")


@query("score_files", ["fx_scores"], "select id, score from fx_scores")
def score_files(spark, sf_dir):
    path = scratch_path(spark, "scores")
    tables.write_table(view(spark, sf_dir, "fx_scores"), path, sep="\t", header=True)
    return tables.read_scores(spark, path)


@query("chunk_file_rows", ["fx_contigs"], """
select concat(read_id, '_', cast(i as string), ',', upper(substring(seq, cast(i * 300 + 1 as int), 300)), ',0') as value
from (select read_id, seq, unnest(range(0, length(seq) // 300)) as i from fx_contigs)""")
def chunk_file_rows(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    tables.write_table(model.model_chunks(view(spark, sf_dir, "fx_contigs")), path)
    return spark.read.text(path).select("value")


@query("qc_stats_file", ["fx_reads"], QC_STATS)
def qc_stats_file(spark, sf_dir):
    paths = [scratch_path(spark, "clean"), scratch_path(spark, "stats")]
    clean, seen = quality.counted_quality_control(tailed(spark, sf_dir), CHAIN, ADAPTERS)
    fastq.write_fastq(clean, paths[0])
    row = seen.get
    tables.write_json(spark.createDataFrame([row]), paths[1])
    return spark.read.schema(", ".join(f"{c} long" for c in row)).json(paths[1])


@query("merge_stats_file", ["fx_pairs"], f"""{PAIRS}
select count(*) as pairs_before, cast(sum(length(seq1) + length(seq2)) as bigint) as bases_before, count(best) as merged,
       count(*) - count(best) as mate1, count(*) - count(best) as mate2,
       cast(sum(case when best is null then length(seq1) + length(seq2) else length(seq1) + length(rc) - best end) as bigint) as bases_after from m""")
def merge_stats_file(spark, sf_dir):
    paths = [scratch_path(spark, "merged"), scratch_path(spark, "stats")]
    reads, seen = merge.counted_merge_pairs(view(spark, sf_dir, "fx_pairs"))
    fastq.write_fastq(reads, paths[0])
    row = seen[0].get | seen[1].get
    tables.write_json(spark.createDataFrame([row]), paths[1])
    return spark.read.schema(", ".join(f"{c} long" for c in row)).json(paths[1])


@query("species_counts_file", BOTH, f", {COUNTS} select * from counts")
def species_counts_file(spark, sf_dir):
    path = scratch_path(spark, "counts")
    counts = report.species_counts(report.viral_rows(report.merged_report(*hits(spark, sf_dir))))
    tables.write_table(counts, path, sep="\t", header=True)
    return spark.read.schema("search string, name string, count long").csv(path, sep="\t", header=True)


MANY = ["".join("ACGT"[(i // 4**k + k * i + k * k) % 4] for k in range(14)) + "GATTACA"[: i % 8] for i in range(154)]


def _many_sql() -> str:
    source = "select read_id, seq, qual, cast(null as bigint) as cut from tailed"
    steps = []
    for i, a in enumerate(MANY):
        steps.append(f"""a{i} as materialized (select read_id, case when cut is null then seq else substring(seq, 1, cut - 1) end as seq from (
  select read_id, seq, list_min(list_filter(range(1, greatest(length(seq) - 2, 1)), lambda i:
    hamming(substring(seq, i, least(length(seq) - i + 1, {len(a)})), left('{a}', least(length(seq) - i + 1, {len(a)}))) <= least(length(seq) - i + 1, {len(a)}) // 8)) as cut
  from {f'a{i - 1}' if i else 'tailed'}))""")
    return f", tailed as materialized ({TAILED}), {', '.join(steps)} select read_id, seq from a{len(MANY) - 1}"


@query("adapter_file_trim", ["fx_reads"], _many_sql())
def adapter_file_trim(spark, sf_dir):
    path = scratch_path(spark, "adapters")
    rows = spark.createDataFrame([(f"a{i:03d}", "", a) for i, a in enumerate(MANY)], "read_id string, description string, seq string")
    fasta.write_fasta(rows.coalesce(1), path)
    return quality.trim_adapters(tailed(spark, sf_dir), fasta.read_adapters(spark, path)).select("read_id", "seq")
