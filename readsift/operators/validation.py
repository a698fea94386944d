"""Checks on raw FASTQ records."""

from pyspark.sql import Column, DataFrame, functions as F

from readsift.sources.fastq import split_header


def fault() -> Column:
    """The first check that a record fails, null if none."""
    lines = [F.col(c) for c in ("header", "seq", "separator", "qual")]
    incomplete = lines[0].isNull() | lines[1].isNull() | lines[2].isNull() | lines[3].isNull()
    return (
        F.when(incomplete, "incomplete")
        .when(~F.startswith("header", F.lit("@")) | (F.length("header") < 2), "header")
        .when(~F.startswith("separator", F.lit("+")), "separator")
        .when(F.length("seq") != F.length("qual"), "length")
        .when(F.col("seq").rlike("[^ACGTURYKMSWBDHVNacgturykmswbdhvn.-]"), "bases")
        .when(F.col("qual").rlike("[^\\x21-\\x7e]"), "quality")
    )


def invalid_records(records: DataFrame) -> DataFrame:
    """(rec_no, reason) of every bad record; the first failing check names the reason."""
    return records.select("rec_no", fault().alias("reason")).where("reason is not null")


def checked(records: DataFrame) -> DataFrame:
    """The records; the run that reads them ends with an error at a bad one, so that no pass of its own is needed."""
    message = F.concat(F.lit("bad FASTQ record "), F.col("rec_no").cast("string"), F.lit(": "), fault())
    # a filter, which no column pruning takes away
    return records.where(F.when(fault().isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def duplicate_ids(records: DataFrame) -> DataFrame:
    """(read_id, copies) of ids that occur more than once."""
    read_id, _ = split_header(F.col("header"))
    return (
        records.where("header is not null").groupBy(read_id)
        .agg(F.count("*").alias("copies")).where("copies > 1")
    )


def require_valid(records: DataFrame, unique_ids: bool = True) -> DataFrame:
    """The records, or an error that names some of the faults."""
    faults = invalid_records(records).limit(5).collect()
    if faults:
        raise ValueError("bad FASTQ records: " + ", ".join(f"{r.rec_no} ({r.reason})" for r in faults))
    if unique_ids:
        copies = duplicate_ids(records).limit(5).collect()
        if copies:
            raise ValueError("repeated read ids: " + ", ".join(r.read_id for r in copies))
    return records
