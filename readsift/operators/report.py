"""Best hits, the merged report, the viral rows and their species counts."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from readsift import schemas

SIDE_FIELDS = [f for f in schemas.HIT_FIELDS if f != "qaccver"]
VIRAL = "Viruses"

MERGED = T.StructType(
    [T.StructField("read_id", T.StringType(), True)]
    + [T.StructField(f"{side}_{f}", schemas.HIT[f].dataType, True) for side in ("nt", "nr") for f in SIDE_FIELDS]
)


def as_hits(df: DataFrame) -> DataFrame:
    """Any seven-column hit table under the common column names, by position."""
    return df.toDF(*schemas.HIT_FIELDS)


def with_prefix(hits: DataFrame, side: str) -> DataFrame:
    """The hit columns renamed for one side of the report; the query becomes read_id."""
    return as_hits(hits).select(
        F.col("qaccver").alias("read_id"), *[F.col(f).alias(f"{side}_{f}") for f in SIDE_FIELDS]
    )


def best_hits(hits: DataFrame, side: str) -> DataFrame:
    """Lowest e-value per query; ties go to the higher identity, then the first accession.

    The rank limit is applied before the shuffle as well, so a query with very many hits sends at
    most one of them from each task.
    """
    named = with_prefix(hits, side)
    order = W.partitionBy("read_id").orderBy(
        F.asc_nulls_last(f"{side}_evalue"), F.desc_nulls_last(f"{side}_pident"), F.asc_nulls_last(f"{side}_saccver")
    )
    return named.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def evalue_at_most(hits: DataFrame, limit: float) -> DataFrame:
    return hits.where(F.col("evalue") <= F.lit(limit))


def top_subjects(hits: DataFrame, n: int) -> DataFrame:
    """The n best rows per query, with their rank."""
    order = W.partitionBy("qaccver").orderBy("evalue", F.desc("pident"), "saccver")
    return hits.withColumn("hit_rank", F.row_number().over(order)).where(F.col("hit_rank") <= n)


def merge_sides(nt_best: DataFrame, nr_best: DataFrame) -> DataFrame:
    """Full outer join of the two best-hit tables; both have one row per query."""
    return nt_best.join(nr_best, "read_id", "full").select(*MERGED.fieldNames())


def merged_report(nt_hits: DataFrame, nr_hits: DataFrame) -> DataFrame:
    return merge_sides(best_hits(nt_hits, "nt"), best_hits(nr_hits, "nr"))


def _is_viral(kingdom: Column, any_of_many: bool) -> Column:
    return F.array_contains(F.split(kingdom, ";"), VIRAL) if any_of_many else kingdom == VIRAL


def viral_rows(merged: DataFrame, any_of_many: bool = False) -> DataFrame:
    """Rows with a viral best hit on either side; `any_of_many` also takes lists such as 'Viruses;Bacteria'."""
    return merged.where(
        _is_viral(F.col("nt_sskingdom"), any_of_many) | _is_viral(F.col("nr_sskingdom"), any_of_many)
    )


def append_stages(stages: dict) -> DataFrame:
    """Viral rows of several stages under one another, told apart by `stage`."""
    out = None
    for name, rows in stages.items():
        rows = rows.withColumn("stage", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


def species_counts(viruses: DataFrame) -> DataFrame:
    """(search, name, count): species of the viral best hits, for each side of the report.

    Both sides come from one pass over the rows.
    """
    pairs = F.array(*[
        F.struct(
            F.lit(label).alias("search"),
            F.when(F.col(f"{side}_sskingdom") == VIRAL, F.col(f"{side}_ssciname")).alias("name"),
        )
        for label, side in (("nucleotide", "nt"), ("protein", "nr"))
    ])
    return (
        viruses.select(F.explode(pairs).alias("p")).select("p.search", "p.name")
        .where("name is not null").groupBy("search", "name").agg(F.count("*").alias("count"))
    )


def species_share(counts: DataFrame) -> DataFrame:
    """Counts with their share of all counts of the same search."""
    totals = counts.groupBy("search").agg(F.sum("count").alias("_total"))  # two rows at most
    return (
        counts.join(F.broadcast(totals), "search")
        .select("search", "name", "count", (F.col("count") / F.col("_total")).alias("share"))
    )
