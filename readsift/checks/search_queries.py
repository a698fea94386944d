"""Queries on subjects: taxonomy, words, host matches, searches, clusters, whole runs."""

import math
import uuid

from pyspark.sql import functions as F

from readsift import params
from readsift.checks.registry import query
from readsift.checks.views import stored, view
from readsift.functions.sequence import translate_frame
from readsift.operators import cluster, host, index, search, taxonomy
from readsift.plans import pipeline
from readsift.session import scratch_path
from readsift.sources import fasta
from readsift.sources.tables import union_all

GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def subjects(spark, sf_dir):
    return view(spark, sf_dir, "fx_subject")


def reads(spark, sf_dir):
    return view(spark, sf_dir, "fx_reads").select("read_id", "seq")


def references(spark, sf_dir):
    return subjects(spark, sf_dir).withColumn("ref_name", F.col("db"))


# --- taxonomy

LINEAGE = """
, up as (
  select taxid, parent as anc, case when rank = 'superkingdom' then name end as sskingdom, case when rank = 'species' then name end as ssciname, 0 as depth
  from fx_taxnodes
  union all
  select up.taxid, t.parent, coalesce(up.sskingdom, case when t.rank = 'superkingdom' then t.name end),
         coalesce(up.ssciname, case when t.rank = 'species' then t.name end), depth + 1
  from up join fx_taxnodes t on t.taxid = up.anc where t.taxid <> 1),
lineage as (select taxid, max(sskingdom) as sskingdom, max(ssciname) as ssciname from up group by taxid)"""


def lineage(spark, sf_dir):
    nodes = view(spark, sf_dir, "fx_taxnodes")
    return taxonomy.lineage_table(nodes.select("taxid", "parent", "rank"), nodes.select("taxid", "name"))


@query("taxon_lineage", ["fx_taxnodes"], f"{LINEAGE} select * from lineage")
def taxon_lineage(spark, sf_dir):
    return lineage(spark, sf_dir)


@query("subject_taxonomy", ["fx_taxnodes", "fx_subject"], f"""{LINEAGE}
select s.subject_id, s.taxid, l.sskingdom, l.ssciname, s.salltitles from fx_subject s left join lineage l on l.taxid = s.taxid""")
def subject_taxonomy(spark, sf_dir):
    known = subjects(spark, sf_dir)
    taxmap = known.select(F.col("subject_id").alias("accession"), "taxid")
    return taxonomy.attach_taxonomy(known.select("subject_id", "salltitles"), taxmap, lineage(spark, sf_dir))


# --- databases and words

@query("db_union", ["fx_subject", "fx_contigs"], "select subject_id, seq from fx_subject union all select read_id, seq from fx_contigs")
def db_union(spark, sf_dir):
    part = lambda db: search.choose_database(subjects(spark, sf_dir), db).select("subject_id", "seq")
    contigs = view(spark, sf_dir, "fx_contigs").select(F.col("read_id").alias("subject_id"), "seq")
    return union_all([*map(part, ("viral", "bacterial", "host", "other")), contigs])


NOT_SEED = "[^ACGT]|^(?:[AC]*|[AG]*|[AT]*|[CG]*|[CT]*|[GT]*)$"


def _words(source: str, keys: str, size: int) -> str:
    return (
        f"select * from (select {keys}, i as pos, substring(seq, cast(i + 1 as int), {size}) as word "
        f"from (select {keys}, seq, unnest(range(0, length(seq) - {size - 1})) as i from {source})) "
        f"where not regexp_matches(word, '{NOT_SEED}')"
    )


@query("kmer_index", ["fx_subject"], f"""
select word, count(*) as positions, count(distinct subject_id) as subjects from ({_words('fx_subject', 'subject_id', 16)}) group by word""")
def kmer_index(spark, sf_dir):
    return index.word_counts(subjects(spark, sf_dir), 16)


# --- diagonals in SQL: strided query words on both strands against all subject words

def _diagonals(subject: str, size: int, stride: int) -> str:
    return f"""
turned as materialized (select read_id, '+' as strand, length(seq) as len, seq from fx_reads
  union all select read_id, '-', length(seq), reverse(translate(seq, 'ACGT', 'TGCA')) from fx_reads),
q_words as (select read_id, strand, pos, word from ({_words('turned', 'read_id, strand, len', size)})
  where case when strand = '+' then pos % {stride} = 0 else (len - pos - {size}) % {stride} = 0 end),
s_words as ({_words(subject, 'subject_id', size)}),
diagonals as materialized (
  select distinct q.read_id, q.strand, s.subject_id, s.pos - q.pos as diag from q_words q join s_words s on q.word = s.word),
laid as materialized (
  select d.*, length(t.seq) as len, length(s.seq) as subject_len, greatest(diag, 0) as start,
         substring(t.seq, cast(greatest(-diag, 0) + 1 as int), cast(least(length(t.seq) + least(diag, 0), length(s.seq) - greatest(diag, 0)) as int)) as a,
         substring(s.seq, cast(greatest(diag, 0) + 1 as int), cast(least(length(t.seq) + least(diag, 0), length(s.seq) - greatest(diag, 0)) as int)) as b
  from diagonals d join turned t on t.read_id = d.read_id and t.strand = d.strand join {subject} s on s.subject_id = d.subject_id)"""


def _host_sql(dbs: str) -> str:
    return f""", refs as materialized (select * from fx_subject where db in ({dbs})), {_diagonals('refs', 17, 4)},
matched as (
  select read_id, subject_id, strand, diag as pos, hamming(a, b) as mismatches from laid
  where diag >= 0 and diag + len <= subject_len and hamming(a, b) * 100 <= len * 10),
best as (select * exclude (rn) from (
  select *, row_number() over (partition by read_id order by mismatches, subject_id, strand, pos) as rn from matched) where rn = 1)"""


@query("host_matches", ["fx_subject", "fx_reads"], f"{_host_sql(chr(39) + 'host' + chr(39))} select * from best")
def host_matches(spark, sf_dir):
    p = params.HostFilter()
    built = index.build_index(host.choose_references(references(spark, sf_dir), ["host"]), p.words.size)
    return host.host_alignments(reads(spark, sf_dir), built, p)


@query("host_subtract", ["fx_subject", "fx_reads"],
       f"{_host_sql(chr(39) + 'host' + chr(39) + ',' + chr(39) + 'bacterial' + chr(39))} select read_id, seq from fx_reads where read_id not in (select read_id from best)")
def host_subtract(spark, sf_dir):
    return host.subtract_host(reads(spark, sf_dir), references(spark, sf_dir), ["host", "bacterial"])


@query("host_subtract_file", ["fx_subject", "fx_reads"],
       f"{_host_sql(chr(39) + 'host' + chr(39))} select read_id, seq from fx_reads where read_id not in (select read_id from best)")
def host_subtract_file(spark, sf_dir):
    """The reference comes from a FASTA file, in pieces shorter than many reads."""
    p, layout = params.HostFilter(), params.Pieces(64, 32)
    path = scratch_path(spark, "reference")
    chosen = host.choose_references(references(spark, sf_dir), ["host"])
    fasta.write_fasta(chosen.select(F.col("subject_id").alias("read_id"), F.lit("").alias("description"), "seq"), path, width=60)
    built = index.index_pieces(fasta.read_fasta_pieces(spark, path, layout), p.words.size, layout)
    return host.subtract_indexed(reads(spark, sf_dir), built, p)


@query("host_subtract_last", ["fx_subject", "fx_reads"],
       f"{_host_sql(chr(39) + 'bacterial' + chr(39))} select read_id, seq from fx_reads where read_id not in (select read_id from best)")
def host_subtract_last(spark, sf_dir):
    p = params.HostFilter(mode="last")
    return host.subtract_host(reads(spark, sf_dir), references(spark, sf_dir), ["host", "bacterial"], p)


@query("host_subtract_none", ["fx_reads"], "select read_id, seq from fx_reads")
def host_subtract_none(spark, sf_dir):
    return host.subtract_host(reads(spark, sf_dir), references(spark, sf_dir), [])


# --- translation

def _codon(s: str, i: str) -> str:
    digit = lambda k: f"(strpos('TCAG', substring({s}, cast({i} + {k} as int), 1)) - 1)"
    return f"substring('{GENETIC_CODE}', cast(1 + 16 * {digit(0)} + 4 * {digit(1)} + {digit(2)} as int), 1)"


def _frames(source: str) -> str:
    """(read_id, frame, protein) of all six frames."""
    turned = f"select read_id, 1 as sgn, seq from {source} union all select read_id, -1, reverse(translate(seq, 'ACGT', 'TGCA')) from {source}"
    return f"""select read_id, cast(sgn * (f + 1) as int) as frame,
       array_to_string(list_transform(range(0, (length(seq) - f) // 3), lambda i: {_codon('seq', '(f + 1 + 3 * i)')}), '') as protein
from ({turned}) cross join (select unnest([0, 1, 2]) as f)"""


@query("translate6", ["fx_reads"], _frames("fx_reads"))
def translate6(spark, sf_dir):
    return search.translate(reads(spark, sf_dir)).select("read_id", "frame", F.col("seq").alias("protein"))


# --- searches

def _segments(keys: str, score: str, source: str) -> str:
    """Best segment per diagonal from running sums: (keys, score, start, length), first end, latest start."""
    return f"""
steps as (select {keys}, i, case when i = 0 then 0 else {score} end as v
  from (select {keys}, a, b, unnest(range(0, length(a) + 1)) as i from {source})),
sums as (select {keys}, i, sum(v) over (partition by {keys} order by i) as p from steps),
lows as (select *, min(p * 1000000 - i) over (partition by {keys} order by i rows between unbounded preceding and 1 preceding) as low from sums),
ends as (select {keys}, i, p - ceil(low / 1000000.0) as score, cast(ceil(low / 1000000.0) * 1000000 - low as bigint) as from_i from lows where i > 0),
segments as materialized (
  select {keys}, cast(score as int) as score, cast(from_i as int) as s_start, cast(i - from_i as int) as length
  from (select *, row_number() over (partition by {keys} order by score desc, i) as rn from ends) where rn = 1)"""


NT, NR = params.NucleotideScoring(), params.ProteinScoring()


def _least(m: str, n: str, evalue: float, lam: float, k: float) -> str:
    return f"ceil(ln(cast({m} as double) * cast({n} as double) * {k / evalue!r}) / {lam!r})"


def _log_evalue(lam: float, k: float) -> str:
    return f"round((ln(cast(len as double) * cast((select n from total) as double) * {k!r}) - {lam!r} * score) / ln(10), 3)"


def rounded(hits):
    """E-values as rounded logarithms, which do not hang on the last digit of an exponential."""
    return hits.withColumn("log_evalue", F.round(F.log10("evalue"), 3)).drop("evalue")


def _bits(lam: float, k: float) -> str:
    return f"round((score * {lam!r} - ({math.log(k)!r})) / {math.log(2)!r}, 1)"


def _nt_sql(evalue: float, db: str = None) -> str:
    where = f" where db = '{db}'" if db else ""
    return f""", base as materialized (select * from fx_subject{where}), {_diagonals('base', 21, 8)},
total as (select sum(length(seq)) as n from base), {_segments('read_id, strand, subject_id, diag', "case when substring(a, cast(i as int), 1) = substring(b, cast(i as int), 1) then 1 else -2 end", 'laid')},
scored as materialized (
  select s.*, l.len, l.start + s.s_start as subject_start, cast((s.score + 2 * s.length) / 3 as int) as matches
  from segments s join laid l using (read_id, strand, subject_id, diag)
  where s.score >= {_least('l.len', '(select n from total)', evalue, NT.lam, NT.k)}),
per_subject as (select * exclude (rn) from (
  select *, row_number() over (partition by read_id, subject_id order by score desc, strand, subject_start, length) as rn from scored) where rn = 1)"""


NT_COLUMNS = f"read_id, subject_id, strand, subject_start, score, length, matches, round(matches * 100 / length, 2) as pident, {_bits(NT.lam, NT.k)} as bits, {_log_evalue(NT.lam, NT.k)} as log_evalue"


SEARCH_NT = f"""{_nt_sql(1e-10)}
select {NT_COLUMNS} from (
  select *, row_number() over (partition by read_id order by score desc, matches desc, length, subject_id) as rn from per_subject) where rn <= 10"""


@query("search_nt", ["fx_subject", "fx_reads"], SEARCH_NT)
def search_nt(spark, sf_dir):
    built = index.build_index(subjects(spark, sf_dir), 21)
    return rounded(search.search_nucleotide(reads(spark, sf_dir), built, 1e-10, 10))


def proteins(spark, sf_dir):
    """Protein subjects: the first forward frame of every subject."""
    build = lambda: subjects(spark, sf_dir).withColumn("seq", translate_frame(F.col("seq"), 0))
    return stored(spark, sf_dir, "fx_protein", build)


GROUPS = params.AMINO_GROUPS
LETTERS, FIRSTS = "".join(GROUPS), "".join(g[0] * len(g) for g in GROUPS)


def _matrix_sql() -> tuple:
    """The published scores as SQL: the letters of the rows, and a list over pairs of letters. Read from the text on its own."""
    rows = [line.split() for line in params.BLOSUM62.strip().splitlines()]
    score = lambda i, j: rows[max(i, j)][min(i, j)]
    n = len(rows)
    return "".join(r[-1] for r in rows), f"[{', '.join(score(i, j) for i in range(n) for j in range(n))}]"


MATRIX_LETTERS, MATRIX = _matrix_sql()


def _nr_sql(mode: str, evalue: float, db: str = None) -> str:
    m = params.SEED_MODES[mode]
    where = f" where db = '{db}'" if db else ""
    n = len(MATRIX_LETTERS)

    def words(source, keys):
        seeds = []
        for k, seed in enumerate(m.seeds):
            places = [p for p, x in enumerate(seed.shape) if x == "1"]
            text = f"translate(protein, '{LETTERS}', '{FIRSTS}')" if seed.reduced else "protein"
            word = " || ".join(f"substring(t, cast(i + {p + 1} as int), 1)" for p in places)
            seeds.append(
                f"select {keys}, {k} as seed, i as pos, {word} as word "
                f"from (select {keys}, {text} as t, unnest(range(0, length(protein) - {len(seed.shape) - 1})) as i from {source})"
            )
        return (
            f"select * from ({' union all '.join(seeds)}) "
            f"where not regexp_matches(word, '[^{LETTERS}]') and len(list_distinct(string_split(word, ''))) >= 3"
        )

    row = lambda c: f"strpos('{MATRIX_LETTERS}', substring({c}, cast(i as int), 1))"
    score = f"case when {row('a')} = 0 or {row('b')} = 0 then -100000 else (select scores from matrix)[({row('a')} - 1) * {n} + {row('b')}] end"
    enough = " or ".join(f"count(*) filter (where q.seed = {k}) >= {seed.min_words}" for k, seed in enumerate(m.seeds))
    base = f"""select subject_id, array_to_string(list_transform(range(0, length(seq) // 3), lambda i: {_codon('seq', '(1 + 3 * i)')}), '') as protein from fx_subject{where}"""
    cut = lambda c, skip: f"substring({c}, cast({skip} + 1 as int), cast(least(length(f.protein) + least(diag, 0), length(s.protein) - greatest(diag, 0)) as int))"
    return f""", matrix as materialized (select {MATRIX} as scores), base as materialized ({base}), frames as materialized ({_frames('fx_reads')}),
q_words as ({words('frames', 'read_id, frame')}), s_words as ({words('base', 'subject_id')}),
diagonals as materialized (
  select q.read_id, q.frame, s.subject_id, s.pos - q.pos as diag from q_words q join s_words s on q.word = s.word and q.seed = s.seed
  group by 1, 2, 3, 4 having {enough}),
laid as materialized (
  select d.*, greatest(diag, 0) as start, length(r.seq) // 3 as len, {cut('f.protein', 'greatest(-diag, 0)')} as a, {cut('s.protein', 'greatest(diag, 0)')} as b
  from diagonals d join frames f on f.read_id = d.read_id and f.frame = d.frame join base s on s.subject_id = d.subject_id
  join fx_reads r on r.read_id = d.read_id),
total as (select sum(length(protein)) as n from base), {_segments('read_id, frame, subject_id, diag', score, 'laid')},
scored as materialized (
  select s.*, l.len, l.start + s.s_start as subject_start,
         cast(s.length - hamming(substring(l.a, s.s_start + 1, s.length), substring(l.b, s.s_start + 1, s.length)) as int) as matches
  from segments s join laid l using (read_id, frame, subject_id, diag)
  where s.score >= {_least('l.len', '(select n from total)', evalue, NR.lam, NR.k)}),
per_subject as (select * exclude (rn) from (
  select *, row_number() over (partition by read_id, subject_id order by score desc, frame, subject_start, length) as rn from scored) where rn = 1)"""


NR_COLUMNS = f"read_id, subject_id, frame, subject_start, score, length, matches, round(matches * 100 / length, 2) as pident, {_bits(NR.lam, NR.k)} as bits, {_log_evalue(NR.lam, NR.k)} as log_evalue"


def _blastx_sql(mode: str) -> str:
    return f"""{_nr_sql(mode, 1e-3)}
select {NR_COLUMNS} from (
  select *, row_number() over (partition by read_id order by score desc, matches desc, length, subject_id) as rn from per_subject) where rn <= 10"""


def _blastx(spark, sf_dir, mode):
    built = search.build_protein_index(proteins(spark, sf_dir), params.SEED_MODES[mode])
    return rounded(search.search_translated(reads(spark, sf_dir), built, params.SEED_MODES[mode], 1e-3, 10))


@query("search_blastx", ["fx_subject", "fx_reads"], _blastx_sql("sensitive"))
def search_blastx(spark, sf_dir):
    return _blastx(spark, sf_dir, "sensitive")


@query("search_blastx_fast", ["fx_subject", "fx_reads"], _blastx_sql("fast"))
def search_blastx_fast(spark, sf_dir):
    return _blastx(spark, sf_dir, "fast")


# --- clusters

UNIQUE = """
, uniq as materialized (
  select row_number() over (order by length(seq) desc, read_id) as ord, read_id, seq
  from (select min(read_id) as read_id, upper(seq) as seq from fx_reads where length(seq) >= 32 group by upper(seq)))"""

SIMILAR = """
facing as (
  select p.*, ua.seq as sa, ub.seq as sb,
         least(length(ua.seq) - greatest(-diag, 0), length(ub.seq) - greatest(diag, 0)) as overlap
  from pairs p join uniq ua on ua.ord = p.a join uniq ub on ub.ord = p.b),
compared as materialized (
  select a, b, diag, overlap, overlap - hamming(substring(sa, cast(greatest(-diag, 0) + 1 as int), cast(overlap as int)),
                                                substring(sb, cast(greatest(diag, 0) + 1 as int), cast(overlap as int))) as equal
  from facing where overlap * 100 >= least(length(sa), length(sb)) * 80),
alike as materialized (select * from compared where equal * 1000 >= overlap * 900)"""


@query("cluster_unique", ["fx_reads"], f"{UNIQUE} select read_id, seq from uniq")
def cluster_unique(spark, sf_dir):
    return cluster.unique_sequences(reads(spark, sf_dir))


SHARED_PAIRS = f"""words as materialized ({_words('uniq', 'ord', 16)}),
pairs as materialized (
  select distinct m.ord as a, d.ord as b, d.pos - m.pos as diag from words m join words d on d.word = m.word where d.ord < m.ord)"""


@query("cluster_edges", ["fx_reads"], f"""{UNIQUE},
{SHARED_PAIRS}, {SIMILAR}
select x.read_id, y.read_id as lead_id, diag, overlap, equal from alike join uniq x on x.ord = a join uniq y on y.ord = b""")
def cluster_edges(spark, sf_dir):
    ordered = cluster.greedy_order(cluster.unique_sequences(reads(spark, sf_dir)))
    lead = ordered.select(F.col("ord").alias("lead"), F.col("read_id").alias("lead_id"))
    return cluster.similar(ordered, ordered).join(ordered.select("ord", "read_id"), "ord").join(lead, "lead").select(
        "read_id", "lead_id", F.col("diag").cast("long").alias("diag"), F.col("overlap").cast("long").alias("overlap"),
        F.col("equal").cast("long").alias("equal"),
    )


GREEDY_ROUNDS = 16


def _greedy_sql(result: str) -> str:
    """Centroids from the graph of all similar pairs, by rounds of 'no earlier undecided neighbour'."""
    rounds = ["u0 as materialized (select ord from uniq)"]
    for r in range(GREEDY_ROUNDS):
        rounds.append(
            f"c{r} as materialized (select ord from u{r} where ord not in "
            f"(select e.later from edges e join u{r} x on x.ord = e.earlier))"
        )
        rounds.append(
            f"u{r + 1} as materialized (select ord from u{r} where ord not in (select ord from c{r}) "
            f"and ord not in (select e.later from edges e join c{r} c on c.ord = e.earlier))"
        )
    chosen = " union all ".join(f"select ord from c{r}" for r in range(GREEDY_ROUNDS))
    return f"""{UNIQUE},
{SHARED_PAIRS}, {SIMILAR},
edges as materialized (select distinct a as later, b as earlier from alike),
{", ".join(rounds)}, chosen as materialized ({chosen})
{result}"""


@query("cluster_centroids", ["fx_reads"], _greedy_sql("select read_id, seq from uniq where ord in (select ord from chosen)"))
def cluster_centroids(spark, sf_dir):
    return cluster.centroids(reads(spark, sf_dir))


@query("cluster_members", ["fx_reads"], _greedy_sql("""
, joined as (select u.ord, coalesce(min(c.ord), u.ord) as centroid
  from uniq u left join edges e on e.later = u.ord left join chosen c on c.ord = e.earlier group by u.ord)
select r.read_id, l.read_id as centroid_id
from fx_reads r join uniq u on u.seq = upper(r.seq) join joined j on j.ord = u.ord join uniq l on l.ord = j.centroid"""))
def cluster_members(spark, sf_dir):
    return cluster.members(reads(spark, sf_dir))


# --- whole runs, on databases that were indexed once

def databases(spark, sf_dir):
    """The four databases: viral subjects and all subjects, as nucleotides and as proteins."""
    known, translated = subjects(spark, sf_dir), proteins(spark, sf_dir)
    return pipeline.Databases(
        virus_nucl=search.choose_database(known, "viral"), virus_prot=search.choose_database(translated, "viral"),
        nucl=known, prot=translated,
    )


_saved = {}


@query("host_subtract_saved", ["fx_subject", "fx_reads"],
       f"{_host_sql(chr(39) + 'host' + chr(39))} select read_id, seq from fx_reads where read_id not in (select read_id from best)")
def host_subtract_saved(spark, sf_dir):
    p, name = params.HostFilter(), f"readsift_{uuid.uuid4().hex}"
    built = index.build_index(host.choose_references(references(spark, sf_dir), ["host"]), p.words.size)
    index.save_index(built, name, "host", int(spark.conf.get("spark.sql.shuffle.partitions")), folder=scratch_path(spark, name))
    return host.subtract_indexed(reads(spark, sf_dir), index.load_index(spark, name, "host"), p)


def saved_databases(spark, sf_dir):
    """The databases with saved indexes, made on first use in the session."""
    db, key = databases(spark, sf_dir), (spark.sparkContext.applicationId, sf_dir)
    if key not in _saved:
        name = f"readsift_{uuid.uuid4().hex}"
        pipeline.save_databases(db, name, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), folder=scratch_path(spark, name))
        _saved[key] = name
    return pipeline.open_databases(db, _saved[key])


@query("search_nt_saved", ["fx_subject", "fx_reads"], SEARCH_NT)
def search_nt_saved(spark, sf_dir):
    return rounded(search.search_nucleotide(reads(spark, sf_dir), saved_databases(spark, sf_dir).indexes["nucl"], 1e-10, 10))


@query("saved_index_words", ["fx_subject"], f"""
select subject_id, cast(pos as bigint) as pos, word <= reverse(translate(word, 'ACGT', 'TGCA')) as forward, count(*) over (partition by least(word, reverse(translate(word, 'ACGT', 'TGCA')))) as rows
from ({_words("fx_subject", "subject_id", 21)})""")
def saved_index_words(spark, sf_dir):
    kept = saved_databases(spark, sf_dir).indexes["nucl"]
    return kept.words.join(kept.counts, "hash").select("subject_id", F.col("pos").cast("long").alias("pos"), "forward", F.col("_nr").alias("rows"))


def sequences(spark, sf_dir):
    return view(spark, sf_dir, "fx_reads").select("read_id", "description", "seq")


def _within(ctes: str, result: str) -> str:
    """A search's WITH members as a subquery of their own, so that several searches stand in one statement."""
    return f"(with {ctes.lstrip().removeprefix(',')} {result})"


STAGE1 = f"""
, viral_nt as materialized (select read_id from {_within(_nt_sql(1e-3, "viral"), "select distinct read_id from per_subject")}),
viral_nr as materialized (select read_id from {_within(_nr_sql("sensitive", 1e-3, "viral"), "select distinct read_id from per_subject")}),
stage1 as materialized (select read_id from viral_nt union select read_id from viral_nr)"""


def _stage_report(where: str) -> str:
    """The merged report of the general searches over some reads, e-values as their logarithm."""
    def side(name, ctes, lam, k):
        ranked = _within(ctes, """select * from (
  select *, (select n from total) as db_len, row_number() over (partition by read_id order by score desc, matches desc, length, subject_id) as rn from per_subject) where rn <= 10""")
        log = f"round((ln(cast(len as double) * cast(db_len as double) * {k!r}) - {lam!r} * score) / ln(10), 3)"
        return f"""{name}_best as materialized (select read_id, subject_id as {name}_saccver, sskingdom as {name}_sskingdom, ssciname as {name}_ssciname,
       salltitles as {name}_salltitles, pident as {name}_pident, evalue as {name}_evalue from (
  select h.read_id, h.subject_id, s.sskingdom, s.ssciname, s.salltitles, round(matches * 100 / length, 2) as pident, {log} as evalue,
         row_number() over (partition by h.read_id order by h.score desc, round(matches * 100 / length, 2) desc, h.subject_id) as rn
  from {ranked} h join fx_subject s on s.subject_id = h.subject_id where h.read_id {where} (select read_id from stage1)) where rn = 1)"""
    fields = ("saccver", "sskingdom", "ssciname", "salltitles", "pident", "evalue")
    columns = ", ".join(f"{x}_{f}" for x in ("nt", "nr") for f in fields)
    return f"""{side("nt", _nt_sql(1e-10), NT.lam, NT.k)},
{side("nr", _nr_sql("fast", 1e-10), NR.lam, NR.k)},
merged as materialized (select coalesce(a.read_id, b.read_id) as read_id, {columns} from nt_best a full join nr_best b on a.read_id = b.read_id)"""


def as_logs(merged):
    return merged.withColumns({c: F.round(F.log10(c), 3) for c in ("nt_evalue", "nr_evalue")})


STAGED = ["fx_subject", "fx_reads"]


@query("stage1_search", STAGED, f"{STAGE1} select read_id from stage1")
def stage1_search(spark, sf_dir):
    return pipeline.stage1(sequences(spark, sf_dir), saved_databases(spark, sf_dir))


@query("two_stage_search", STAGED, f"""{STAGE1},
{_stage_report("in")} select * from merged where nt_sskingdom = 'Viruses' or nr_sskingdom = 'Viruses'""")
def two_stage_search(spark, sf_dir):
    return as_logs(pipeline.virus_search(sequences(spark, sf_dir), saved_databases(spark, sf_dir)).viruses)


@query("additional_search", STAGED, f"{STAGE1},\n{_stage_report('not in')} select * from merged")
def additional_search(spark, sf_dir):
    db = saved_databases(spark, sf_dir)
    first = pipeline.virus_search(sequences(spark, sf_dir), db)
    return as_logs(pipeline.additional_search(first.unidentified, db).merged)


@query("unidentified", STAGED, f"""{STAGE1},
{_stage_report("in")} select read_id, description, seq from fx_reads where read_id not in (select read_id from merged)""")
def unidentified(spark, sf_dir):
    return pipeline.virus_search(sequences(spark, sf_dir), saved_databases(spark, sf_dir)).unidentified
