"""Greedy clustering: one centroid per group of near-identical sequences.

Sequences are ranked longest first. Two are similar when, on a diagonal of a word they share, the overlap covers most of the
shorter one and is nearly identical there. In the order of ranks each sequence joins the first centroid similar to it, or becomes
one; so no two centroids are similar.

That result is found in batches of ranks, each several times the one before, so a run has as many batches as its size has digits.
Within a batch all that share a word are compared. Where words are shared by many, whoever is the first to hold each of its words is
a centroid at once and takes its group away before that, at linear cost, so that near copies of one sequence are not compared with
each other. The batch's centroids are then compared with all later sequences, and what joins them leaves.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from readsift.functions.alignment import equal_positions
from readsift.operators.packed import numbered_words, shared_runs
from readsift.operators.skew import Load, load
from readsift.params import Cluster
from readsift.session import cut_lineage


def unique_sequences(sequences: DataFrame, p: Cluster = Cluster()) -> DataFrame:
    """Exact copies folded into the copy with the first id; too short sequences are left out."""
    return (
        sequences.where(F.length("seq") >= p.min_len)
        .groupBy(F.upper("seq").alias("seq")).agg(F.min("read_id").alias("read_id"))
    )


def greedy_order(unique: DataFrame) -> DataFrame:
    """Add `ord`, the rank in the order longest first, then by id. Written to reliable storage.

    A range-partitioned sort, a counter inside each partition, and one row per partition to turn the
    counters into ranks; no task sees all rows.
    """
    parts = int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc(F.length("seq")), F.asc("read_id")]
    ranked = cut_lineage(
        unique.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("_id"), "read_id", "seq")
    ).withColumn("_part", F.shiftright("_id", 33))
    sizes = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # one row per partition
    rank = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.join(F.broadcast(offsets), "_part").select(rank.alias("ord"), "read_id", "seq")


def word_load(sequences: DataFrame, earlier: DataFrame, p: Cluster = Cluster()) -> Load:
    """How many pairs share words, and which words are frequent, from a share of the sequences."""
    words = lambda df: numbered_words(df.sample(p.sample, seed=1) if p.sample < 1 else df, p.word_size).select("hash")
    return load(words(sequences), None if earlier is sequences else words(earlier), "hash", p.sample)


def shared_diagonals(sequences: DataFrame, earlier: DataFrame, p: Cluster = Cluster(), known: Load = None) -> DataFrame:
    """(ord, lead, diag): each sequence against all earlier ones of `earlier` that share a word, on the diagonals of these words where enough of both overlaps."""
    known = known or word_load(sequences, earlier, p)
    return shared_runs(sequences, None if earlier is sequences else earlier, p.word_size, p.min_overlap_pct, known.frequent).distinct()


def edges(pairs: DataFrame, sequences: DataFrame, leaders: DataFrame, p: Cluster = Cluster()) -> DataFrame:
    """The diagonals on which two sequences are similar, with overlap and equal positions."""
    member = sequences.select("ord", F.col("seq").alias("_a"))
    lead = leaders.select(F.col("ord").alias("lead"), F.col("seq").alias("_b"))
    na, nb = F.length("_a"), F.length("_b")
    sa, sb = F.greatest(-F.col("diag"), F.lit(0)), F.greatest("diag", F.lit(0))
    per_mille = round(p.identity * 1000)
    return (
        pairs.join(lead, "lead").join(member, "ord")
        .withColumn("overlap", F.least(na - sa, nb - sb))
        .where(F.col("overlap") * 100 >= F.least(na, nb) * p.min_overlap_pct)
        .withColumn("equal", equal_positions(F.substring("_a", sa + 1, F.col("overlap")), F.substring("_b", sb + 1, F.col("overlap"))))
        .where(F.col("equal") * 1000 >= F.col("overlap") * per_mille)
        .select("ord", "lead", "diag", "overlap", "equal")
    )


def similar(sequences: DataFrame, earlier: DataFrame, p: Cluster = Cluster(), known: Load = None) -> DataFrame:
    """(ord, lead, diag, overlap, equal) of each sequence and the earlier ones it is similar to."""
    return edges(shared_diagonals(sequences, earlier, p, known), sequences, earlier, p)


def _led(batch: DataFrame, p: Cluster) -> DataFrame:
    """ord of sequences similar to one that is the first holder of each of its words (and so surely a centroid)."""
    words = numbered_words(batch, p.word_size)
    first = words.groupBy("hash").agg(F.min("ord").alias("lead"), F.min_by("pos", "ord").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    led = words.join(first.drop("_n").hint("merge"), "hash").where("lead < ord")
    pairs = cut_lineage(led.select("ord", "lead", (F.col("_first") - F.col("pos")).alias("diag")).distinct())
    followers = pairs.select(F.col("ord").alias("lead")).distinct()
    return edges(pairs.join(followers, "lead", "left_anti"), batch, batch, p).select("ord").distinct()


def first_come(links: DataFrame, limit: int = 1 << 20) -> DataFrame:
    """ord of those that join an earlier one which joins nobody itself; in: distinct (ord, lead), lead before ord, written already.

    At most `limit` links, those of the first ranks, go through one task in order of rank, which settles any chain among them.
    Before that a round over all links settles those whose lead has no link itself.
    """
    left, joined = links, []

    def in_order(batches):
        import pyarrow as pa

        gone = set()
        for batch in batches:
            new = []
            for o, lead in zip(batch["ord"].to_pylist(), batch["lead"].to_pylist()):
                if lead not in gone and o not in gone:
                    gone.add(o)
                    new.append(o)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int64())], names=["ord"])

    while (n := left.count()) > 0:
        if n > limit:
            free = left.join(left.select(F.col("ord").alias("lead")).distinct(), "lead", "left_anti")
            done = cut_lineage(free.select("ord").distinct())
            joined.append(done)
            left = cut_lineage(left.join(done, "ord", "left_anti").join(done.withColumnRenamed("ord", "lead"), "lead", "left_anti"))
            if (n := left.count()) == 0:
                break
        stop = left.agg(F.percentile_approx("ord", min(1.0, limit / n))).first()[0] if n > limit else None
        now = left if stop is None else left.where(F.col("ord") <= stop)
        done = cut_lineage(now.repartition(1).sortWithinPartitions("ord", "lead").mapInArrow(in_order, "ord long"))
        joined.append(done)
        if stop is None:
            break
        # leads up to there are settled: what follows one that stays joins it
        rest = left.where(F.col("ord") > stop)
        follows = rest.where(F.col("lead") <= stop).join(done.withColumnRenamed("ord", "lead"), "lead", "left_anti")
        done = cut_lineage(follows.select("ord").distinct())
        joined.append(done)
        gone = done.withColumnRenamed("ord", "lead")
        left = cut_lineage(rest.where(F.col("lead") > stop).join(done, "ord", "left_anti").join(gone, "lead", "left_anti"))
    return reduce(lambda a, b: a.unionByName(b), joined) if joined else links.select("ord")


def assign_centroids(ordered: DataFrame, p: Cluster = Cluster()) -> DataFrame:
    """(ord, read_id, seq, centroid): the ord of each sequence's centroid, its own for a centroid."""
    last = ordered.agg(F.max("ord")).first()[0]
    left, joined, stop = ordered, [], p.batch
    least = lambda links: links.groupBy("ord").agg(F.min("lead").alias("centroid"))
    while last is not None:
        batch = left if stop > last else cut_lineage(left.where(F.col("ord") < stop))
        known, rest = word_load(batch, batch, p), batch
        if known.pairs_per_row > p.dense:
            rest = cut_lineage(batch.join(_led(batch, p), "ord", "left_anti"))
            known = word_load(rest, rest, p)
        links = cut_lineage(similar(rest, rest, p, known).select("ord", "lead").distinct())
        centroids = rest.join(first_come(links), "ord", "left_anti")
        joined.append(least(links.join(centroids.select(F.col("ord").alias("lead")), "lead")))
        if rest is not batch or stop <= last:
            centroids = cut_lineage(centroids)
            others = left.join(rest.select("ord"), "ord", "left_anti")
            joined.append(cut_lineage(least(similar(others, centroids, p))))
        if stop > last:
            break
        left = cut_lineage(left.where(F.col("ord") >= stop).join(joined[-1].select("ord"), "ord", "left_anti"))
        stop *= p.growth
    none = ordered.select("ord", F.col("ord").alias("centroid")).limit(0)
    chosen = reduce(lambda a, b: a.unionByName(b), joined, none)
    return ordered.join(chosen, "ord", "left").select("ord", "read_id", "seq", F.coalesce("centroid", "ord").alias("centroid"))


def assign(sequences: DataFrame, p: Cluster = Cluster()) -> DataFrame:
    return assign_centroids(greedy_order(unique_sequences(sequences, p)), p)


def centroids(sequences: DataFrame, p: Cluster = Cluster()) -> DataFrame:
    """(read_id, seq) of the centroids."""
    return assign(sequences, p).where("centroid = ord").select("read_id", "seq")


def members(sequences: DataFrame, p: Cluster = Cluster()) -> DataFrame:
    """(read_id, centroid_id) for every clustered sequence, exact copies included."""
    assigned = assign(sequences, p)
    names = assigned.where("centroid = ord").select(F.col("ord").alias("centroid"), F.col("read_id").alias("centroid_id"))
    by_seq = assigned.join(names, "centroid").select("seq", "centroid_id")
    copies = sequences.where(F.length("seq") >= p.min_len).select("read_id", F.upper("seq").alias("seq"))
    return copies.join(by_seq, "seq").select("read_id", "centroid_id")
