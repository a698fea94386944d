"""Joins on keys that a large share of both sides may hold.

Spark splits partitions that hold many bytes, but a key held by a thousand rows on either side makes a million pairs out of few
bytes. Here a key's pairs are dealt out in cells: its rows are split on both sides, and each part of one side meets each
part of the other. Nothing is dropped, and a result does not depend on which keys are split.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SHARE = 0.05  # of the rows whose keys are counted to find frequent ones
CELLS = 16  # cells per shuffle partition that the pairs of all keys would fill
LEAST = 10_000  # pairs; below, a key is never split


@dataclass(frozen=True)
class Load:
    """What a join will make: pairs per row of the left side, and (key, _fl, _fr) of the keys to split, None if there are none."""

    pairs_per_row: float
    frequent: DataFrame | None


def load(left: DataFrame, right: DataFrame | None, key: str, share: float = 1.0, least: int = LEAST, right_share: float = None) -> Load:
    """Counted on the keys of both sides, or on those of a share of the rows of both: only relative counts matter.

    The right side may be counts instead of rows: (key, _nr); or None, where the left side meets itself.

    A cell is the pairs of all keys over CELLS per shuffle partition. Keys with more than a cell of pairs are split; so there are
    fewer of them than cells, whatever the data, and their table is small enough to broadcast.
    """
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    nl, nr = F.col("_nl").cast("double"), F.col("_nr").cast("double")
    right_share = share if right_share is None else right_share
    if right is None:
        both = count(left, "_nl").withColumn("_nr", F.col("_nl"))
    else:
        both = count(left, "_nl").join(right if "_nr" in right.columns else count(right, "_nr"), key)
    counts = both.where("_nl > 1 or _nr > 1").withColumn("_pairs", nl * nr).persist()
    try:
        # a sampled row that meets itself says nothing of its neighbours
        met, pairs, rows = counts.agg(F.sum(F.col("_pairs") - F.least(nl, nr)), F.sum("_pairs"), F.sum(nl)).first()
        cell = max(least * share * right_share, (pairs or 0) / (CELLS * parts))
        cells = F.ceil(F.col("_pairs") / cell)
        # the longer side is split more, so that a cell has about as many rows of both
        fl = F.least(F.greatest(F.ceil(F.sqrt(cells * nl / nr)), F.lit(1)), cells)
        split = counts.where(F.col("_pairs") > cell).select(key, fl.cast("int").alias("_fl"), F.ceil(cells / fl).cast("int").alias("_fr"))
        split = [tuple(r) for r in split.collect()]
    finally:
        counts.unpersist()
    schema = f"{key} {left.schema[key].dataType.simpleString()}, _fl int, _fr int"
    return Load((met or 0.0) / (rows or 1.0) / right_share, spark.createDataFrame(split, schema) if split else None)


def _part(df: DataFrame, key: str, parts: str) -> Column:
    """Which part of its key a row belongs to."""
    return F.pmod(F.xxhash64(*[c for c in df.columns if c != key]), F.coalesce(parts, F.lit(1))).cast("int")


def salted_join(left: DataFrame, right: DataFrame, key: str, frequent: DataFrame | None) -> DataFrame:
    """Inner join on `key`, the keys of `frequent` (see load) dealt out in cells."""
    if frequent is None:
        return left.join(right.hint("merge"), key)
    hot = F.broadcast(frequent)
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))
    a = left.join(hot, key, "left").select(*left.columns, _part(left, key, "_fl").alias("_i"), every("_fr").alias("_j"))
    b = right.join(hot, key, "left").select(*right.columns, every("_fl").alias("_i"), _part(right, key, "_fr").alias("_j"))
    return a.join(b.hint("merge"), [key, "_i", "_j"]).drop("_i", "_j")


def sampled(df: DataFrame, share: float = SHARE) -> DataFrame:
    return df if share >= 1 else df.sample(share, seed=1)
