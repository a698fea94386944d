"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone: those that give exactly one token form the shortcut
set, proved, not assumed. A pre-token in the set counts one; only the rest is merged, each distinct one once.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from readsift.llm.pretokens import Pretokens

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
_made = {}


def whole_tokens(tokens: Pretokens) -> frozenset:
    """Vocabulary strings that are one pre-token and encode alone as one token (at most one per vocabulary entry)."""
    candidates = set()
    vocabulary = tokens.library.get_vocab(with_added_tokens=False)
    for entry in vocabulary:
        # a string of the alphabet the entries are written in; only plain ASCII maps to itself there
        text = entry.removesuffix("</w>")
        if text and text.isascii() and text.isprintable() and tokens.pieces(text) == [text]:
            candidates.add(text)
    candidates = sorted(candidates)
    got = tokens.library.encode_batch(candidates, add_special_tokens=False)
    return frozenset(t for t, e in zip(candidates, got, strict=True) if len(e.ids) == 1)


class Counter:
    def __init__(self, vocabulary: str):
        self.tokens = Pretokens(vocabulary, len, sum)
        self.one = whole_tokens(self.tokens)
        self.tokens.given = dict.fromkeys(self.one, 1)
        self.tokens.forget()

    def counts(self, texts: list) -> list:
        return self.tokens.encode(texts)


def counter(vocabulary: str) -> Counter:
    """One per worker process."""
    if vocabulary not in _made:
        _made[vocabulary] = Counter(vocabulary)
    return _made[vocabulary]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row. Null text is empty: no bytes, no tokens.

    Counts equal the library's without begin, end or added tokens; special strings inside texts count as the
    library's default treats them. Repeated rows and null ids are counted like any other; other columns are ignored.
    """

    def run(batches):
        count = counter(vocabulary)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for i in range(0, len(texts), 500):
                part = texts[i : i + 500]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, 500), pa.array(map(str_bytes, part), pa.int64()), pa.array(count.counts(part), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def str_bytes(text: str) -> int:
    return len(text.encode())

