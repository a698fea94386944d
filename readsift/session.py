"""Session helpers: shared scratch folder, and broadcasts that check a size first."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or a new one in local mode."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="readsift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to reliable storage and read back, so a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_compact(df: DataFrame) -> DataFrame:
    """As cut_lineage, for many small rows: as Parquet, which takes a fraction of the room of a checkpoint. How rows are dealt out is forgotten."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast when a bounded count shows few rows; else leave the join strategy to Spark."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


BROADCAST_LETTERS = 32 << 20


def broadcast_if_light(df: DataFrame, column: str, most: int = BROADCAST_LETTERS) -> DataFrame:
    """Broadcast when all strings of a column are light together, each counted with what a row takes besides; else leave the join strategy to Spark."""
    light = (df.agg(F.sum(F.length(column) + 64)).first()[0] or 0) <= most
    return F.broadcast(df) if light else df


BATCH_BYTES = 4_000_000  # of rows that a Python worker holds at once; with one more row still a single piece for `vectors.slices`


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they start: a zip of it, once per application; and keep their batches small."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    if _shipped.get("app") == sc.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="readsift-code-"), "readsift.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    sc.addPyFile(path)
    _shipped["app"] = sc.applicationId


_shipped = {}
