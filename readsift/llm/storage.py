"""Intermediate tables in the folder that all executors share: they cut lineage and outlive executors."""

from pyspark.sql import DataFrame

from readsift.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """A Parquet copy of the rows, in scratch space under spark.checkpoint.dir."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
