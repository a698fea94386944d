"""Token ids in directly addressable codes, with random access to any token.

File format. A store is a Parquet table of blocks, `part` and `block` in ascending doc_id order. A block
holds, for up to BLOCK_TOKENS tokens (more if one text has more):

* `docs`, `ends`: the ids of its texts (int64; `nulls` tells whether the first ids are null) and, as int64, the tokens up to the end of each text;
* per level k (8 bits of an id each, low bits first): `chunks[k]`, one byte per token that reaches the level;
  `bitmap[k]`, one bit per such token (low bit first), set if the token goes on to level k + 1; `ranks[k]`, the set
  bits before each run of 512 bits, as uint32.

Token i is read from chunks[0][i]; while its bit is set, its place in the next level is its rank: a
directory entry and one popcount of at most 64 bytes. No block is decoded for it.
"""

import os
import re
import zlib
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from readsift.llm.bytepairs import Codec, Remembered
from readsift.llm.vectors import flat, ramps, releasing, slices
from readsift.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END = 0
RANK_BITS = 512
BLOCK_TOKENS = 1 << 20
BLOCKS = "part int, block int, n_tokens long, nulls long, docs binary, ends binary, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
KNOWN = 1_300_000  # units that one worker remembers before it starts again
LETTERS = 16 << 20  # and their letters
SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
RUN = f" [{SPACE}]|[{SPACE}] "  # a run of white space with a space in it
BREAK = re.compile(r"(?<=\S) (?=\S)")  # no pre-token and no special string crosses from before such a space into it
SLICE = 2 << 20  # bytes of text worked on together
TOGETHER = 8_000  # units that go through the library at once
_made = {}


def encode_levels(ids: np.ndarray) -> tuple[list, list, list]:
    """Chunks, continuation bitmaps and rank directories of each level."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bitmaps.append(bits.tobytes())
        run = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks.append((np.cumsum(run, dtype=np.uint32) - run).astype(np.uint32).tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            return chunks, bitmaps, ranks


def token_at(block: dict, i: int) -> int:
    """One token of a block, without decoding any other."""
    value, level = 0, 0
    while True:
        value |= block["chunks"][level][i] << (8 * level)
        bitmap = block["bitmaps"][level]
        if not bitmap[i >> 3] >> (i & 7) & 1:
            return value
        run = i // RANK_BITS
        rank = int(np.frombuffer(block["ranks"][level], np.uint32, 1, 4 * run)[0])
        begin = run * RANK_BITS // 8
        bits = int.from_bytes(bitmap[begin : (i >> 3) + 1], "little") & ((1 << (i - run * RANK_BITS)) - 1)
        i, level = rank + bits.bit_count(), level + 1


def decode(chunks: list, bitmaps: list) -> np.ndarray:
    """All ids of a block."""
    out = np.frombuffer(chunks[0], np.uint8).astype(np.uint32)
    at = np.arange(len(out))
    for level in range(1, len(chunks)):
        at = at[np.unpackbits(np.frombuffer(bitmaps[level - 1], np.uint8), count=len(at), bitorder="little").astype(bool)]
        out[at] |= np.frombuffer(chunks[level], np.uint8).astype(np.uint32) << np.uint32(8 * level)
    return out


def packed(ids: list) -> bytes:
    """Little-endian 32-bit ids."""
    return np.array(ids, "<u4").tobytes()


class Encoder:
    """Ids by the library, through a memory of the units between spaces."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        codec = Codec(vocabulary)  # for the special strings and the bytes of each id; refuses vocabularies whose units are not apart
        self.cut, self.width = codec.cut, np.array(list(map(len, codec.raw)), np.int64)
        self.units = Remembered(self.unit_ids, KNOWN)
        self.letters = 0

    def unit_ids(self, units: list) -> tuple:
        """Ids of units, (beginning of a text,) or what follows a space, by the library, one after the other, and how many each has.

        Units between white space are put together as one text, as the library costs less by text than by word; the bytes of the
        ids tell which unit they belong to. The others go through the library one by one.
        """
        plain = [i for i, unit in enumerate(units) if unit and not isinstance(unit, tuple) and unit.strip() == unit]
        if self.cut and self.cut.search(" ".join(map(units.__getitem__, plain))):
            plain = [i for i in plain if not self.cut.search(units[i])]
        alone = np.ones(len(units), bool)
        alone[plain] = False
        alone = np.flatnonzero(alone).tolist()
        parts, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, len(plain), TOGETHER):
            own = list(map(units.__getitem__, plain[i : i + TOGETHER]))
            self.letters += sum(map(len, own))
            ids = np.array(self.library.encode_batch_fast([" ".join(["", *own])], add_special_tokens=False)[0].ids, np.int32)
            ends, stops = np.cumsum(self.width[ids]), np.cumsum(np.diff(flat(pa.array(own, pa.large_string()))[1]) + 1)
            last = np.searchsorted(ends, stops)
            if not len(ends) or ends[-1] != stops[-1] or (ends[last] != stops).any():
                raise ValueError("a token crosses from one unit into the next")
            parts.append(ids)
            counts.append(np.diff(last, prepend=-1))
        for i in range(0, len(alone), TOGETHER):
            own = [unit[0] if isinstance(unit, tuple) else f" {unit}" for unit in map(units.__getitem__, alone[i : i + TOGETHER])]
            self.letters += sum(map(len, own))
            lists = [e.ids for e in self.library.encode_batch_fast(own, add_special_tokens=False)]
            parts.append(np.fromiter(chain.from_iterable(lists), np.int32))
            counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids, counts = np.concatenate(parts), np.concatenate(counts)
        order = np.argsort(plain + alone)
        sizes = counts[order]
        return ids[np.repeat((np.cumsum(counts) - counts)[order], sizes) + ramps(sizes)], sizes

    def ids(self, texts: list) -> list:
        """The ids of each text and the end id, packed."""
        ids, sizes = self.encode(texts)
        return [packed(own) for own in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []

    def encode(self, texts) -> tuple:
        """The ids of all texts (a list or an Arrow column) one after the other, each text with the end id, and how many each has.

        Each distinct unit of the texts is looked up once.
        """
        if self.letters > LETTERS:
            self.units.forget()
            self.letters = 0
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        run = pc.match_substring_regex(texts, RUN)
        lists = pc.split_pattern(texts.filter(pc.invert(run)), " ")
        if pc.any(run).as_py():
            kept = np.flatnonzero(run.to_numpy(zero_copy_only=False))
            lists = pa.concat_arrays([lists, pa.array([BREAK.split(t) for t in texts.take(kept).to_pylist()], lists.type)])
            lists = lists.take(np.argsort(np.append(np.delete(np.arange(len(texts)), kept), kept)))
        units, counts = lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)
        first = np.zeros(len(units), bool)
        first[np.cumsum(counts) - counts] = True
        later = units.filter(pa.array(~first)).dictionary_encode()
        known = self.units.slots(chain(zip(units.filter(pa.array(first)).to_pylist()), later.dictionary.to_numpy(zero_copy_only=False).tolist()), len(texts) + len(later.dictionary))  # noqa: B905
        slots = np.empty(len(units), np.int64)
        slots[first], slots[~first] = known[: len(texts)], known[len(texts) :][later.indices.to_numpy()]
        ids, sizes = self.units.at(slots, counts)
        return np.insert(ids, np.cumsum(sizes), END), sizes + 1


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _made:
        _made[vocabulary] = Encoder(vocabulary)
    return _made[vocabulary]


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """Encode each text (null: empty), append the end id, and write blocks in ascending doc_id order.

    Null ids come first; rows that share an id stand next to each other, ordered by text. Other columns are ignored.
    """
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(n, "doc_id", F.crc32("text")).sortWithinPartitions("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        own = encoder(vocabulary)
        ids, held, size = [], [], 0
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                tokens, sizes = own.encode(rows["text"])
                for doc, code in zip(rows["doc_id"].to_pylist(), np.split(tokens, np.cumsum(sizes)[:-1]), strict=True):
                    ids.append(doc)
                    held.append(code)
                    size += len(code)
                    if size >= BLOCK_TOKENS:
                        yield block(part, number, ids, held)
                        number, ids, held, size = number + 1, [], [], 0
        if ids:
            yield block(part, number, ids, held)

    ordered.mapInArrow(releasing(run), BLOCKS).write.option("compression", "zstd").parquet(path)


def block(part: int, number: int, ids: list, held: list) -> pa.RecordBatch:
    tokens = np.concatenate(held)
    levels = encode_levels(tokens)
    ends = np.cumsum([len(h) for h in held], dtype=np.int64)
    nulls = sum(i is None for i in ids)
    values = [part, number, len(tokens), nulls, np.array([i or 0 for i in ids], np.int64).tobytes(), ends.tobytes(), *levels]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.list_(pa.binary())] * 3]
    names = ["part", "block", "n_tokens", "nulls", "docs", "ends", "chunks", "bitmaps", "ranks"]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a store with `start`, the tokens before each: sums within parts, then over the parts."""
    stored = spark.read.parquet(path)
    sizes = stored.select("part", "block", "n_tokens")
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per written partition, not per document
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    starts = sizes.withColumn("inside", before).join(parts, "part").select("part", "block", (F.col("base") + F.col("inside")).alias("start"))
    # three numbers per block of a million tokens, so that the blocks need no shuffle
    return stored.join(F.broadcast(starts), ["part", "block"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of each text from the files: ids are little-endian 32-bit."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["chunks"], row["bitmaps"]).astype("<u4")
                ends = np.frombuffer(row["ends"], np.int64)
                begins = np.append(0, ends[:-1])
                docs = np.frombuffer(row["docs"], np.int64).tolist()
                docs[: row["nulls"]] = [None] * row["nulls"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(begins + row["start"]), pa.array(ends - begins), pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends, strict=True)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    wanted = blocks(spark, path).select("start", "nulls", "docs", "ends", "chunks", "bitmaps")
    return wanted.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def tokens(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """(place, token) for global token places, by random access in the blocks that hold them."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                got = [token_at(row, p - row["start"]) for p in row["places"]]
                yield pa.RecordBatch.from_arrays([pa.array(row["places"], pa.int64()), pa.array(got, pa.int64())], names=["place", "token"])

    held = blocks(spark, path)
    span = held.select("part", "block", "start", (F.col("start") + F.col("n_tokens")).alias("stop"))
    step = F.lit(BLOCK_TOKENS)
    # places and blocks meet on the stretches of BLOCK_TOKENS that a block touches
    cells = span.select("*", F.explode(F.sequence(F.floor(F.col("start") / step), F.floor((F.col("stop") - 1) / step))).alias("cell"))
    asked = places.select(F.col("place").cast("long").alias("place")).withColumn("cell", F.floor(F.col("place") / step))
    found = asked.join(cells, "cell").where("place >= start and place < stop")
    lists = found.groupBy("part", "block").agg(F.collect_set("place").alias("places"))
    return held.join(lists, ["part", "block"]).select("start", "places", "chunks", "bitmaps", "ranks").mapInArrow(run, "place long, token long")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the store in shared scratch space and read it back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_tokens(spark, path)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc(ids: list) -> int:
    return zlib.crc32(np.array([*ids, END], "<u4").tobytes())
