"""Tabular inputs and outputs: hit tables, id lists, reports, taxonomy, scores."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from readsift import schemas


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a glob names at least one file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


TAXON_COLUMNS = ("sskingdom", "ssciname", "salltitles", "sskingdoms", "sscinames")


def null_words_to_null(df: DataFrame) -> DataFrame:
    """Words for missing values become null in taxon columns; ids stay as they are."""
    texts = [f.name for f in df.schema if f.name in TAXON_COLUMNS]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(schemas.NULL_WORDS), F.col(c)) for c in texts}
    )


def read_hits(spark: SparkSession, path: str | list, absent_is_empty: bool = True) -> DataFrame:
    """Headerless seven-column hit tables at a path, a glob, or a list of these; a malformed row raises.

    No file means no hits, unless absent_is_empty is false.
    """
    paths = [path] if isinstance(path, str) else list(path)
    there = [p for p in paths if _exists(spark, p)]
    if len(there) < len(paths) and not absent_is_empty:
        raise FileNotFoundError(", ".join(sorted(set(paths) - set(there))))
    if not there:
        return spark.createDataFrame([], schemas.HIT)
    kinds = spark.createDataFrame([], schemas.HIT).schema
    text = ", ".join(f"`{f.name}` string" for f in kinds)
    raw = spark.read.schema(text).csv(there, sep="\t", quote="", mode="FAILFAST")
    value = lambda f: F.when(F.col(f.name) != "N/A", F.col(f.name)).cast(f.dataType)
    typed = raw.select(*[
        (F.col(f.name) if f.dataType.simpleString() == "string" else value(f)).alias(f.name) for f in kinds
    ])
    return null_words_to_null(typed)


def write_hits(hits: DataFrame, path: str) -> None:
    hits.select(schemas.HIT_FIELDS).write.mode("overwrite").csv(path, sep="\t", quote="", nullValue="N/A")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("read_id"))


def write_ids(ids: DataFrame, path: str) -> None:
    ids.select("read_id").write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A merged or viral report written by `write_report`."""
    from readsift.operators.report import MERGED

    return spark.read.schema(MERGED).csv(path, sep="\t", header=True, quote="", mode="FAILFAST")


def write_report(report: DataFrame, path: str, append: bool = False) -> None:
    report.write.mode("append" if append else "overwrite").csv(path, sep="\t", header=True, quote="")


def write_table(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=header)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SCORE).csv(path, sep="\t", header=True, mode="FAILFAST")


def union_all(parts) -> DataFrame:
    """A database put together from several parts."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_taxmap(spark: SparkSession, path: str) -> DataFrame:
    """accession -> taxid, tab separated, with or without the header line."""
    fields = F.split("value", "\t")
    return (
        spark.read.text(path).where(fields[1] != "taxid")
        .select(fields[0].alias("accession"), fields[1].cast("long").alias("taxid"))
    )


def _dump(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a taxonomy dump file: fields parted by tab-bar-tab, each row closed by tab-bar."""
    return spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))


def read_taxnodes(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    return _dump(spark, path).select(
        f[0].cast("long").alias("taxid"), f[1].cast("long").alias("parent"), f[2].alias("rank")
    )


def read_taxnames(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    return (
        _dump(spark, path).where(f[3] == "scientific name")
        .select(f[0].cast("long").alias("taxid"), f[1].alias("name"))
    )
