"""Alignment of two tokenizers over a corpus, each distinct text once.

Rows are shuffled by their full text and folded, so that a text is tokenised and aligned once however often it occurs; the counts
of linked id pairs weigh it by its multiplicity, and its measures are joined back to the rows by the digest of the text.
"""

import re
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window, functions as F

from readsift.llm import bytepairs
from readsift.llm.storage import stored
from readsift.llm.vectors import slices

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
UNITS = re.compile(" +[^ ]*")
KEY = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_made = {}


class Pieces:
    """Ids of a piece model for texts that begin with a space (the one the model adds): each distinct unit of spaces and a word once."""

    def __init__(self, name: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in names):
            raise ValueError(f"pieces of {name} cross into a next word")
        self.raw = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.space = self.library.piece_to_id(MARK)
        self.units = bytepairs.Remembered(self.encode_units)

    def encode_units(self, units: list) -> tuple:
        ids = [[self.space] if u == " " else x for u, x in zip(units, self.library.encode([u[1:] for u in units], num_threads=1), strict=True)]
        return np.array([i for x in ids for i in x], np.int64), np.array(list(map(len, ids)), np.int64)

    def encode(self, texts: list) -> tuple:
        return self.units.gather([UNITS.findall(t) for t in texts])


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the decimal ids with each separator that can follow them."""

    def __init__(self, first: str, second: str):
        self.a, self.b = bytepairs.codec(first, special=False), Pieces(second)
        self.length = [np.array(list(map(len, side.raw)), np.int64) for side in (self.a, self.b)]
        self.names = [f"{i}{end}" for side, last in ((self.a, "|"), (self.b, ";")) for i in range(len(side.raw)) for end in (",", last)]

    def align(self, texts: list) -> list:
        """(n_a, n_b, n_groups, groups, pairs) of texts that begin with a space; None where the joined tokens differ from the text."""
        whole = [t.encode() for t in texts]
        sides = []
        for side, length in zip((self.a, self.b), self.length, strict=True):
            ids, sizes = side.encode(texts)
            ends = np.concatenate(([0], np.cumsum(sizes))).tolist()
            joined = [b"".join(map(side.raw.__getitem__, ids[i:j].tolist())) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            sides.append((ids.astype(np.int64), sizes, length, np.array([x == y for x, y in zip(joined, whole, strict=True)], bool)))
        good = sides[0][3] & sides[1][3]
        (a, n_a, ends_a), (b, n_b, ends_b) = (
            (ids[at := np.repeat(good, sizes)], np.where(good, sizes, 0), np.cumsum(length[ids[at]])) for ids, sizes, length, _ in sides
        )
        marks = np.zeros((2, int(ends_a[-1]) + 1 if len(ends_a) else 1), bool)
        marks[0, ends_a], marks[1, ends_b] = True, True
        last_a, last_b = marks[1, ends_a], marks[0, ends_b]  # the tokens that end where one of the other side ends
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        # tokens in the order of groups, those of the first tokenizer before those of the second
        codes = np.empty(len(a) + len(b), np.int64)
        before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=groups))))[group_a]
        through_a = np.cumsum(np.bincount(group_a, minlength=groups))[group_b] if groups else group_b
        codes[np.arange(len(a)) + before_b] = 2 * a + last_a
        codes[np.arange(len(b)) + through_a] = 2 * len(self.a.raw) + 2 * b + last_b
        pairs = a[last_a] * len(self.b.raw) + b[last_b]
        cut = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        at = np.concatenate(([0], np.cumsum(last_a)))[np.concatenate(([0], np.cumsum(n_a)))].tolist()
        return [
            (int(x), int(y), at[i + 1] - at[i], "".join(map(self.names.__getitem__, codes[cut[i] : cut[i + 1]].tolist()))[:-1], pairs[at[i] : at[i + 1]]) if ok else None
            for i, (x, y, ok) in enumerate(zip(n_a, n_b, good, strict=True))
        ]

    def rows(self, texts: list) -> list:
        """As align for plain texts. One that stands alone goes in stretches, cut where tokens of both sides end."""
        if len(texts) > 1:
            return self.align([" " + t for t in texts])
        parts = [x for text in texts for stretch in self.a.stretches(" " + text) for x in self.align([stretch])]
        if any(x is None for x in parts):
            return [None]
        n_a, n_b, n_groups, groups, pairs = zip(*parts, strict=True)
        return [(sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), np.concatenate(pairs))]


def aligner(first: str, second: str) -> Aligner:
    """One per worker process."""
    if (first, second) not in _made:
        _made[first, second] = Aligner(first, second)
    return _made[first, second]


def aligned_texts(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, times, pairs) of each distinct text; key is its SHA-256, times its rows.

    pairs holds a link per entry, id of the first tokenizer times the second's size plus id of the second. Every token has bytes, so
    at a common end exactly one token of each side ends: a group has one link. Texts whose tokens do not join to them have zeros.
    """

    def run(batches):
        own = aligner(first, second)
        for batch in batches:
            for part in slices(batch, "text", bytepairs.SLICE):
                texts = part["text"].to_pylist()
                rows = [r or (0, 0, 0, None, ()) for r in own.rows(texts)]
                n_a, n_b, n, groups, pairs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([sha256(t.encode()).digest() for t in texts], pa.binary()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                        pa.array(n, pa.int64()), pa.array(n, pa.int64()), pa.array(["" if g is None else sha256(g.encode()).hexdigest() for g in groups]),
                        part["times"], pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(np.concatenate(pairs), pa.int64())),
                    ],
                    names=[*KEY, "times", "pairs"],
                )

    distinct = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("times"))
    return distinct.mapInArrow(run, "key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, times long, pairs array<long>")


def pair_counts(texts: DataFrame, second: str = SECOND) -> DataFrame:
    """(pair, count, best): links of the whole corpus per id pair; best where no pair of its second id has more.

    Of two tokens that end together the shorter one's bytes end the longer one's. So there are at most as many pairs as the
    tokens of both vocabularies have bytes, twice that with byte pieces: under a million, whatever the corpus.
    """
    size = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(second)).get_piece_size()
    counts = texts.select("times", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("times").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair") % size))
    return counts.withColumn("best", (F.col("count") == most).cast("long"))


def alignment(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row.

    Null and empty texts, and texts that a tokenizer does not give back, have zeros and ''. Repeated rows and null ids come out as they
    went in, and each repeated row adds to the counts; other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = stored(aligned_texts(rows, first, second), "aligned")
    counts = F.broadcast(pair_counts(texts, second))  # bounded by the vocabularies, as shown there
    links = texts.select(*KEY, F.explode_outer("pairs").alias("pair")).join(counts, "pair", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    measures = links.groupBy(*KEY).agg(F.sum("best").alias("n_best"), F.sum("count").alias("count_sum"))
    keyed = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
    return keyed.join(measures, "key", "left").select(
        "doc_id", *map(zero, ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )
