"""Fixed-length chunks for a model, and scores joined back by key."""

from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

CHUNK = 300


def model_chunks(sequences: DataFrame, size: int = CHUNK) -> DataFrame:
    """Upper-cased chunks of `size` bases without overlap; a short tail is dropped."""
    seq = F.upper("seq")
    whole = sequences.where(F.length("seq") >= size)
    i = F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / size).cast("int") - 1))
    return whole.select("read_id", "seq", i.alias("_i")).select(
        F.concat_ws("_", "read_id", "_i").alias("id"),
        F.substring(seq, F.col("_i") * size + 1, F.lit(size)).alias("seq"),
        F.lit(0).alias("label"),
    )


def join_scores(ids: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores matched to sequences by id."""
    return ids.select("id").join(scores.select("id", "score"), "id")


def score_batch(chunks: DataFrame, models: dict[str, Callable[[pd.Series], pd.Series]], variant: str) -> DataFrame:
    """Score (id, seq) with one of the caller's models: a function from a batch of strings to scores."""
    if variant not in models:
        raise ValueError(f"unknown model {variant!r}; have {sorted(models)}")
    model = models[variant]

    def score(batches):
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": model(batch["seq"]).astype("float64")})

    return chunks.select("id", "seq").mapInPandas(score, "id string, score double")
