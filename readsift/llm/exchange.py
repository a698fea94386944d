"""Which hashes occur more than once in a corpus: one packed shuffle, equal hashes pre-aggregated per batch.

Each text is cut into *runs*: stretches of windows that share a window minimum (so equal windows share a
bucket wherever they are). A batch sends each bucket one packed row with the batch's first occurrence of
each hash; occurrences repeated inside a batch are settled there. However often a hash occurs, a bucket
therefore gets it once per batch, and no task holds more than its share of the distinct hashes of batches.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from readsift.llm.vectors import binary_rows, mix, ramps, spans_by_text

NO_ID = -(1 << 63)  # stands for a null doc_id: below all others
HASH_BITS = 55
SCHEMA = "bucket int, doc long, chk long, spans binary, payload binary"
SPANS = "doc long, chk long, spans binary"
RUN = np.dtype([("doc", "<i8"), ("chk", "<u4"), ("start", "<u4"), ("count", "<u4")])


def keyed(docs: DataFrame, carry: tuple | None = None) -> DataFrame:
    """(doc, chk, text): a text's key is its doc_id (null: NO_ID) and its checksum, so rows that share an id stay apart.

    With `carry`, also a struct `carried` of those columns (and a constant, as a struct needs a field).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    more = [] if carry is None else [F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in carry]).alias("carried")]
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.crc32(text).alias("chk"), text.alias("text"), *more)


def buckets(df: DataFrame) -> int:
    """Four per shuffle partition, so that hashing evens out their load."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rows(**columns) -> pa.RecordBatch:
    """A batch in the order of SCHEMA; what is left out is null."""
    n = len(next(iter(columns.values())))
    types = {"bucket": pa.int32(), "doc": pa.int64(), "chk": pa.int64(), "spans": pa.binary(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()],
        names=list(types),
    )


def bucket_of(values: np.ndarray, n: int) -> np.ndarray:
    return (mix(values) >> np.uint64(33)) % np.uint64(n)


def settled(runs: np.ndarray, n: int) -> pa.RecordBatch:
    """Spans that a batch knows to be repeated, sent along by text."""
    doc, chk, spans = spans_by_text(runs["doc"], runs["chk"], runs["start"], runs["count"])
    return rows(bucket=(bucket_of(doc.astype(np.uint64) + chk.astype(np.uint64), n)).astype(np.int32), doc=doc, chk=chk.astype(np.int64), spans=spans)


def sent(runs: np.ndarray, bucket: np.ndarray, hashes: np.ndarray, per_window: bool, n: int):
    """Batches for the shuffle. hashes: one per window of the runs, or one per run."""
    first = np.zeros(len(hashes), bool)
    _, at, inverse, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    first[at] = True
    again = (times > 1)[inverse]
    of = np.repeat(np.arange(len(runs)), runs["count"]) if per_window else np.arange(len(runs))
    start = runs["start"][of] + ramps(runs["count"]) if per_window else runs["start"]
    if again.any():
        local = runs[of[again]]
        local["start"] = start[again]
        if per_window:
            local["count"] = 1
        yield settled(local, n)
    # what goes out: first occurrences, in runs of neighbours
    keep = np.flatnonzero(first)
    of, start = of[keep], start[keep]
    cut = np.ones(len(keep), bool)
    if per_window:
        cut[1:] = (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(cut)
    size = np.diff(np.append(head, len(keep)))
    out = runs[of[head]]
    out["start"] = start[head]
    if per_window:
        out["count"] = size
    word = (mix(hashes[keep]) & np.uint64((1 << HASH_BITS) - 1)) | (again[keep].astype(np.uint64) << np.uint64(HASH_BITS))
    to = bucket[of[head]]
    order = np.argsort(to, kind="stable")
    elements = np.repeat(head[order], size[order]) + ramps(size[order])
    packed = np.ascontiguousarray(word[elements]).view(np.uint8).reshape(-1, 8)[:, :7]
    places, at = np.unique(to[order], return_index=True)
    run_at, ends = np.append(at, len(order)), np.append(0, np.cumsum(size[order]))
    payloads = [
        np.int32(b - a).tobytes() + out[order[a:b]].tobytes() + packed[ends[a] : ends[b]].tobytes()
        for a, b in zip(run_at[:-1], run_at[1:], strict=True)
    ]
    yield rows(bucket=places.astype(np.int32), payload=pa.array(payloads, pa.binary()))


def repeated(table: pa.Table, per_window: bool) -> pa.Table:
    """One bucket: spans of the windows (or runs) whose hash came from more than one batch, and what was settled before."""
    found = []
    runs, words = [], []
    for payload in table["payload"].drop_null().to_pylist():
        n = int(np.frombuffer(payload, np.int32, 1)[0])
        runs.append(np.frombuffer(payload, RUN, n, 4))
        words.append(np.frombuffer(payload, np.uint8, offset=4 + n * RUN.itemsize).reshape(-1, 7))
    if runs:
        runs, raw = np.concatenate(runs), np.concatenate(words)
        word = np.zeros((len(raw), 8), np.uint8)
        word[:, :7] = raw
        word = word.view("<u8").reshape(-1)
        key = word & np.uint64((1 << HASH_BITS) - 1)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= (word >> np.uint64(HASH_BITS)) == 0
        if per_window:
            of = np.repeat(np.arange(len(runs)), runs["count"])[twice]
            hit = runs[of]
            hit["start"] += ramps(runs["count"])[twice].astype(np.uint32)
            hit["count"] = 1
        else:
            hit = runs[twice]
        if len(hit):
            found.append(hit)
    if found:
        doc, chk, spans = spans_by_text(*(found[0][c] for c in ("doc", "chk", "start", "count")))
        out = pa.table({"doc": pa.array(doc, pa.int64()), "chk": pa.array(chk.astype(np.int64)), "spans": spans})
    else:
        out = pa.table({"doc": pa.array([], pa.int64()), "chk": pa.array([], pa.int64()), "spans": pa.array([], pa.binary())})
    before = table.filter(pa.compute.is_valid(table["spans"])).select(["doc", "chk", "spans"])
    return pa.concat_tables([out, before.cast(out.schema)])


def spans_of(mapped: DataFrame, per_window: bool) -> DataFrame:
    """(doc, chk, parts): the packed spans of each text that has any."""
    return (
        mapped.groupBy("bucket").applyInArrow(lambda table: repeated(table, per_window), SPANS)
        .groupBy("doc", "chk").agg(F.collect_list("spans").alias("parts"))
    )


def texts_with(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Texts joined with their spans; both sides are dealt out by the text's key."""
    return docs.join(spans, ["doc", "chk"], how)


__all__ = ["RUN", "SCHEMA", "binary_rows", "bucket_of", "buckets", "keyed", "rows", "sent", "spans_of", "texts_with"]
