"""Taxon lineages and their attachment to subjects."""

from pyspark.sql import DataFrame, functions as F

from readsift.session import cut_lineage

RANKS = ("superkingdom", "species")


def lineage_table(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """(taxid, sskingdom, ssciname): the nearest superkingdom and species at or above each taxon.

    The way up the tree is halved each round: after round r every taxon points 2^r levels up and
    knows what lies in between, so a tree of 40 levels takes six joins. Rounds go on until nothing moves; a
    taxon that is its own ancestor (but for a root, which is its own parent) raises an error.
    """
    at_rank = lambda rank: F.when(F.col("rank") == rank, F.col("taxid"))
    up = cut_lineage(
        nodes.select("taxid", F.col("parent").alias("anc"), *[at_rank(r).alias(r) for r in RANKS])
    )
    # a tree has no more levels than taxa
    for _ in range(up.count().bit_length() + 1):
        higher = up.select(
            F.col("taxid").alias("anc"), F.col("anc").alias("_anc"), *[F.col(r).alias(f"_{r}") for r in RANKS]
        )
        up = cut_lineage(
            up.join(higher, "anc", "left").select(
                "taxid", F.coalesce("_anc", "anc").alias("anc"), (F.col("_anc") != F.col("anc")).alias("_moved"),
                *[F.coalesce(r, f"_{r}").alias(r) for r in RANKS],
            )
        )
        if up.where("_moved").isEmpty():
            break
    else:
        raise ValueError("the taxonomy has a cycle")
    king = names.select(F.col("taxid").alias("superkingdom"), F.col("name").alias("sskingdom"))
    own = names.select(F.col("taxid").alias("species"), F.col("name").alias("ssciname"))
    return up.join(king, "superkingdom", "left").join(own, "species", "left").select("taxid", "sskingdom", "ssciname")


def attach_taxonomy(subjects: DataFrame, taxmap: DataFrame, lineage: DataFrame) -> DataFrame:
    """Subjects with taxon, kingdom and species; subjects without a known taxon keep nulls."""
    taxids = taxmap.select(F.col("accession").alias("subject_id"), "taxid")
    # ids meet first, so that sequences travel once
    found = subjects.select("subject_id").distinct().join(taxids, "subject_id").join(lineage, "taxid", "left")
    return subjects.join(found, "subject_id", "left")
