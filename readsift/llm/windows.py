"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

Every window of `size` words gets a polynomial hash; the hashes are counted in one packed shuffle
(`exchange`); windows whose hash occurs twice or more merge into maximal intervals, whose words go.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from readsift.llm import exchange
from readsift.llm.vectors import cover, flat, read_spans, rolling, slices, slide_min, word_hashes, word_spans

SIZE = 35
GRAM = 8  # words whose hash decides the bucket of the windows around them


def window_runs(batch, size: int, gram: int, n_buckets: int):
    """Runs of windows with one minimum, their buckets, and the hash of each window."""
    data, offsets = flat(batch["text"])
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    windows = rolling(hashes, size)
    if not len(windows):
        return None
    least = slide_min(rolling(hashes, gram), size - gram + 1)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)[: len(windows)]
    fits = np.arange(len(windows)) + size <= first[text + 1]
    at = np.flatnonzero(fits)
    if not len(at):
        return None
    cut = np.ones(len(at), bool)
    cut[1:] = (text[at][1:] != text[at][:-1]) | (least[at][1:] != least[at][:-1])
    head = np.flatnonzero(cut)
    runs = np.zeros(len(head), exchange.RUN)
    of = text[at[head]]
    runs["doc"] = batch["doc"].to_numpy()[of]
    runs["chk"] = batch["chk"].to_numpy()[of]
    runs["start"] = at[head] - first[of]
    runs["count"] = np.diff(np.append(head, len(at)))
    return runs, exchange.bucket_of(least[at[head]], n_buckets), windows[at]


def repeated_windows(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc, chk, parts) for keyed texts: packed (first word, windows) spans of windows that occur twice or more."""
    n = exchange.buckets(docs)

    def send(batches):
        for batch in batches:
            for part in slices(batch):
                if (found := window_runs(part, size, gram, n)) is not None:
                    yield from exchange.sent(*found, True, n)

    return exchange.spans_of(docs.mapInArrow(send, exchange.SCHEMA), True)


def dedup_windows(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """Words kept by each text: (doc_id, n_words, n_removed, kept_text).

    A word goes if some window of `size` words over it also starts elsewhere in the input, the same text
    included. Words are runs of bytes other than space and 0x09 to 0x0D. Null text has no words. A row
    that repeats another row's doc_id is a text of its own; a null doc_id stays null. Other columns are ignored.
    """
    texts = exchange.keyed(docs)
    joined = exchange.texts_with(texts, repeated_windows(texts, size, gram), "left")

    def cut(batches):
        for batch in batches:
            out = []
            for text, parts in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["parts"].to_pylist(), strict=True):
                words = text.split()  # bytes split at exactly the six ASCII spaces
                n = len(words)
                if parts:
                    gone = cover(read_spans(parts), n, size - 1)
                    words = [words[i] for i in np.flatnonzero(~gone)]
                out.append((n, n - len(words), b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    kept = joined.select("doc", "text", "parts").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")
    return kept.withColumn("doc_id", F.nullif("doc_id", F.lit(exchange.NO_ID)))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def brute_force(texts: list, size: int = SIZE) -> list:
    """(n_words, n_removed, kept_sha256) per text, straight from the definition; for tests."""
    words = [(t or "").encode().split() for t in texts]
    times = {}
    for w in words:
        for i in range(len(w) - size + 1):
            times[tuple(w[i : i + size])] = times.get(tuple(w[i : i + size]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if times[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out
