"""Sequence data derived from the given tables, as SQL that Spark and DuckDB both run.

The tables hold no sequences. Bases come from md5 of keys, so any scale gives the same data in both
engines. Each view covers its whole base table; remainders of keys only decide what is planted in a
row, never whether the row is there.
"""

import re

from pyspark.sql import DataFrame, SparkSession

from readsift.session import scratch_path

HEX = "0123456789abcdef"
BASES = "ACGTACGTACGTACGT"


def _md5s(prefix: str, key: str, n: int) -> str:
    return ", ".join(f"md5(concat('{prefix}', cast({key} as string), '_{i}'))" for i in range(n))


VIEWS = {
    # one subject of 320 bases per part; a quarter each viral, bacterial, host, unplaced
    "fx_subject": f"""
select concat('S', cast(p_partkey as string)) as subject_id, 1000 + p_partkey as taxid,
       case p_partkey % 4 when 0 then 'viral' when 1 then 'bacterial' when 2 then 'host' else 'other' end as db,
       case p_partkey % 4 when 0 then 'Viruses' when 1 then 'Bacteria' when 2 then 'Eukaryota' else null end as sskingdom,
       concat(p_type, ' ', p_brand) as ssciname, p_name as salltitles,
       translate(concat({_md5s('ref', 'p_partkey', 10)}), '{HEX}', '{BASES}') as seq
from part""",
    # one read per order. Class by key: 0-3 viral, 4 viral with one substitution, 5-6 host, 7 random,
    # 8 low complexity, 9 too short; every second block of ten keys is reverse-complemented, every
    # thirteenth key has low quality
    "fx_reads": f"""
select read_id, description, rec_no, cls, sid, seq,
       substring(translate(concat({_md5s('q', 'rec_no', 5)}), '{HEX}',
                           case when rec_no % 13 = 0 then '!"#$%&()*+,-./01' else '!+5:?@ABCDEFGHIJ' end),
                 1, cast(length(seq) as int)) as qual
from (
  select concat('r', cast(k as string)) as read_id, concat('1:N:0:', cast(cls as string)) as description, k as rec_no, cls, sid,
         case when cast(floor(k / 10) as bigint) % 2 = 1 then reverse(translate(fwd, 'ACGT', 'TGCA')) else fwd end as seq
  from (
    select k, cls, sid,
           case when cls < 4 or cls in (5, 6) then frag
                when cls = 4 then concat(substring(frag, 1, 44), translate(substring(frag, 45, 1), 'ACGT', 'CGTA'), substring(frag, 46, 200))
                when cls = 7 then substring(rnd, 1, len)
                when cls = 8 then concat(repeat('A', 60), repeat('C', 40))
                else substring(rnd, 1, 30) end as fwd
    from (
      select o.k, o.cls, o.sid, o.len, substring(r.seq, o.pos, o.len) as frag,
             translate(concat({_md5s('rnd', 'o.k', 5)}), '{HEX}', '{BASES}') as rnd
      from (
        select o_orderkey as k, o_orderkey % 10 as cls,
               4 * (o_custkey % (select cast(count(*) / 4 as bigint) from part))
                 + case when o_orderkey % 10 in (5, 6) then 2 else 0 end as sid,
               cast(1 + (o_orderkey * 7) % 180 as int) as pos, cast(90 + o_orderkey % 50 as int) as len
        from orders) o
      join fx_subject r on r.subject_id = concat('S', cast(o.sid as string))) f) g) h""",
    # one pair per order: inserts of 110 to 259 bases, mates of 100
    "fx_pairs": f"""
select o.k as rec_no, concat('p', cast(o.k as string)) as read_id, o.ins,
       substring(r.seq, o.pos, 100) as seq1,
       reverse(translate(substring(r.seq, o.pos + o.ins - 100, 100), 'ACGT', 'TGCA')) as seq2,
       substring(translate(concat({_md5s('m', 'o.k', 4)}), '{HEX}', '!+5:?@ABCDEFGHIJ'), 1, 100) as qual1,
       substring(translate(concat({_md5s('n', 'o.k', 4)}), '{HEX}', '!+5:?@ABCDEFGHIJ'), 1, 100) as qual2
from (
  select o_orderkey as k, cast(110 + o_orderkey % 150 as int) as ins, cast(1 + o_orderkey % 60 as int) as pos,
         concat('S', cast(o_custkey % (select count(*) from part) as string)) as sid
  from orders) o
join fx_subject r on r.subject_id = o.sid""",
    "fx_nt_hits": """
select concat('r', cast(l_orderkey as string)) as qaccver,
       concat('S', cast(l_partkey as string), '.', cast(l_linenumber as string)) as saccver,
       case l_partkey % 5 when 0 then 'Viruses' when 1 then 'Bacteria' when 2 then null else 'Eukaryota' end as sskingdom,
       concat('species ', cast(l_partkey % 40 as string)) as ssciname,
       concat('title ', cast(l_partkey as string)) as salltitles,
       round(70 + l_discount * 100, 2) as pident,
       case when l_quantity <= 3 then 0.0e0 else cast(concat('1e-', cast(cast(l_quantity as int) as string)) as double) end as evalue
from lineitem where l_linestatus = 'O'""",
    "fx_nr_hits": """
select concat('r', cast(l_orderkey as string)) as qseqid,
       concat('P', cast(l_partkey as string), '.', cast(l_linenumber as string)) as sseqid,
       case l_partkey % 5 when 0 then 'Viruses' when 1 then 'Viruses;Bacteria' when 2 then null else 'Bacteria' end as sskingdoms,
       concat('species ', cast(l_partkey % 30 as string)) as sscinames,
       concat('title ', cast(l_partkey as string)) as salltitles,
       round(60 + l_discount * 200, 2) as pident,
       case when l_quantity <= 3 then 0.0e0 else cast(concat('1e-', cast(cast(l_quantity as int) as string)) as double) end as evalue
from lineitem where l_linestatus = 'F'""",
    # one contig per customer, 100 to 639 bases, mixed case
    "fx_contigs": """
select concat('c', cast(c_custkey as string)) as read_id,
       substring(concat(repeat(translate(md5(concat('a', cast(c_custkey as string))), '0123456789abcdef', 'ACGTacgtACGTacgt'), 10),
                        repeat(translate(md5(concat('b', cast(c_custkey as string))), '0123456789abcdef', 'ACGTacgtACGTacgt'), 10)),
                 1, cast(100 + (c_custkey * 17) % 540 as int)) as seq
from customer""",
    # root, superkingdoms, families, one species per part
    "fx_taxnodes": """
select cast(1 as bigint) as taxid, cast(1 as bigint) as parent, 'no rank' as rank, 'root' as name
union all
select cast(10 + r_regionkey as bigint), cast(1 as bigint), 'superkingdom',
       case r_regionkey when 0 then 'Viruses' when 1 then 'Bacteria' when 2 then 'Eukaryota' when 3 then 'Archaea' else 'Other' end from region
union all
select cast(100 + n_nationkey as bigint), cast(10 + n_regionkey as bigint), 'family', n_name from nation
union all
select cast(1000 + p_partkey as bigint), cast(100 + p_partkey % 25 as bigint), 'species', concat(p_type, ' ', p_brand, ' ', cast(p_partkey as string)) from part""",
    "fx_scores": "select concat('r', cast(o_orderkey as string)) as id, (o_orderkey % 1000) / 1000.0e0 as score from orders",
    # raw FASTQ lines with planted faults
    "fx_records": """
select rec_no,
       case when rec_no % 101 = 1 then concat('!', substring(read_id, 2, 20))
            when rec_no % 97 = 1 then '@r1 copied' else concat('@', read_id, ' ', description) end as header,
       case when rec_no % 103 = 2 then concat(seq, '*') when rec_no % 107 = 3 then concat('U?', substring(seq, 3, 200)) else seq end as seq,
       case when rec_no % 109 = 4 then '-' else '+' end as separator,
       case when rec_no % 113 = 5 then null when rec_no % 127 = 6 then concat(' ', substring(qual, 2, 200)) else qual end as qual
from fx_reads""",
}

# the views each view reads
NEEDS = {"fx_reads": ["fx_subject"], "fx_pairs": ["fx_subject"], "fx_records": ["fx_subject", "fx_reads"]}

TABLES = ["part", "orders", "lineitem", "customer", "region", "nation"]

# views that make sequences: written once per session as Parquet, as a run keeps its reads and subjects
STORED = {"fx_subject", "fx_reads", "fx_pairs", "fx_contigs", "fx_records"}


def with_views(names: list, materialized: bool = False) -> str:
    """WITH clause that defines the named views and what they need."""
    wanted = {n for name in names for n in [name, *NEEDS.get(name, [])]}
    head, word = ("with recursive ", "materialized ") if materialized else ("with ", "")
    return head + ",\n".join(f"{n} as {word}({sql})" for n, sql in VIEWS.items() if n in wanted)


SMALL_FILE = 64 << 20


def _scan(spark: SparkSession, sf_dir: str, table: str, spread: bool) -> str:
    """The scan of a base table. A file too small to be split is spread over the cores."""
    path = f"{sf_dir}/{table}.parquet"
    scan = f"parquet.`{path}`"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not spread or fs.getContentSummary(at).getLength() > SMALL_FILE:
        return scan
    return f"(select /*+ REPARTITION({spark.sparkContext.defaultParallelism}) */ * from {scan})"


_stored = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A Parquet copy of build(), made on first use in the session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        build().write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def _from_sql(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    for other in NEEDS.get(name, []):
        view(spark, sf_dir, other)
        path = _stored[spark.sparkContext.applicationId, sf_dir, other]
        sql = re.sub(rf"\b(from|join) {other}\b", lambda m: f"{m[1]} parquet.`{path}`", sql)
    for table in TABLES:
        sql = re.sub(
            rf"\bfrom {table}\b", lambda m: f"from {_scan(spark, sf_dir, table, name in STORED)}", sql
        )
    return spark.sql(sql)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; sequence views come from their Parquet copy in the shared folder."""
    build = lambda: _from_sql(spark, sf_dir, name)
    return stored(spark, sf_dir, name, build) if name in STORED else build()
