"""Prefix trie of conversations.

A turn is a fixed-width big-endian id, so a conversation is a byte string and a shared beginning is a shared prefix at a multiple
of the width. Equal conversations are folded first. The distinct byte strings are dealt out in ranges of their order, which
splits a beginning that very many of them share; each range is built into an adaptive radix tree, and only the byte depths where a
turn ends become nodes. A range knows how deep it shares a path with the range before and after it: the nodes down to there are
parts, whose sums are merged by the digest of their path. All others are final where they are found.
"""

from hashlib import sha256
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from readsift.llm import radix
from readsift.llm.native import words
from readsift.llm.storage import stored

WIDTH = 20  # bytes of a turn id: 16 of the SHA-256 of role and text, then the number of words
FAMILY, HEADS = 20, 4  # conversation c begins as c - c % 20 does, with fewer than HEADS of its turns
CHUNK_BITS = 12  # member ids are joined in chunks of 4096 neighbouring numbers
RANGE_BYTES = 16 << 20  # bytes of paths in one range
PARTS = "part int, path binary, n long, least long, ends string"
NODES = "key binary, parent_key binary, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, paid long, once long, ends_sha256 string"
NO_ENDS = sha256().hexdigest()


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, id): id in hexadecimal digits. Null role or text is empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH - 8)
    count = F.lpad(F.hex(F.size(words(text))), 8, "0")
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.concat(digest, count).alias("id")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path): the turn ids of each rebuilt conversation one after the other.

    Turns are ordered by their number, null first, and by id where numbers are equal.
    """
    listed = turn_ids(turns).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
    own = stored(listed.select("conv_id", F.transform("turns", lambda t: t["id"]).alias("ids")), "turns")
    heads = own.where(f"conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), F.slice("ids", 1, HEADS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": taken}).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<string>"))
    return joined.select("conv_id", F.unhex(F.array_join(F.concat(head, F.slice("ids", F.col("h") + 1, F.size("ids"))), "")).alias("path"))


def folded(paths: DataFrame) -> DataFrame:
    """(part, path, n, least, ends) of each distinct path, dealt out in ranges: its members, the smallest, and the digest of all.

    Members are joined in chunks of neighbouring ids before they meet; a range's chunks go through its task in order, so that a path
    that a third of all conversations share costs one hash state, not a list.
    """
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = paths.groupBy("path", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids")
    )
    chunks = stored(chunks, "chunks")
    spark = paths.sparkSession
    size = chunks.agg(F.coalesce(F.sum(F.length("path")), F.lit(0))).first()[0]  # one row
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    dealt = chunks.repartitionByRange(parts, "path").sortWithinPartitions("path", "chunk")

    def run(batches):
        state = None
        for batch in batches:
            done = []
            for part, path, n, least, ids in zip(*(batch[c].to_pylist() for c in ("part", "path", "n", "least", "ids")), strict=True):
                if state is None or state[1] != path:
                    if state is not None:
                        done.append((*state[:4], state[4].hexdigest()))
                    state = [part, path, 0, least, sha256()]
                elif state[2]:
                    state[4].update(b",")
                state[2] += n
                state[3] = min(state[3], least)
                state[4].update(ids.encode())
            if done:
                yield batch_of(PARTS, done)
        if state is not None:
            yield batch_of(PARTS, [(*state[:4], state[4].hexdigest())])

    return dealt.select(F.spark_partition_id().alias("part"), "path", "n", "least", "ids").mapInArrow(run, PARTS)


def batch_of(schema: str, rows: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def shared_depths(parts: DataFrame) -> DataFrame:
    """(part, before, after): turns that the first path of a range shares with the range before, and its last one with the next; -1: none.

    One row per range, so the window over all of them stays small.
    """
    edges = parts.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("part")
    edges = edges.select("part", "first", "last", F.lag("last").over(order).alias("lag"), F.lead("first").over(order).alias("lead"))

    def run(batches):
        same = lambda a, b: -1 if b is None else len(commonprefix((a, b))) // WIDTH
        for batch in batches:
            rows = [(r["part"], same(r["first"], r["lag"]), same(r["last"], r["lead"])) for r in batch.to_pylist()]
            if rows:
                yield batch_of("part int, before long, after long", rows)

    return edges.mapInArrow(run, "part int, before long, after long")


def digests(path: bytes, depth: int) -> list:
    """Digests of the first 0 to `depth` turns of a path."""
    state, out = sha256(), []
    for d in range(depth + 1):
        if d:
            state.update(path[(d - 1) * WIDTH : d * WIDTH])
        out.append(state.copy().digest())
    return out


def trie(table: pa.Table) -> pa.Table:
    """Nodes of one range; those that it shares with a neighbour have a key."""
    paths, own, least, ends = (table[c].to_pylist() for c in ("path", "n", "least", "ends"))
    before, after = table["before"][0].as_py(), table["after"][0].as_py()
    first, last = min(paths), max(paths)
    keys = [digests(first, before), digests(last, after)]
    root = radix.Node(b"")
    for i, path in enumerate(paths):
        radix.insert(root, path, i)
    up, depth, said, row, on = [], [], [], [], []  # of each node: the node above, depth, words, the path that ends there, whether on the first and last path
    open_ = []  # nodes above the place of the walk
    for path, above, ends_here in radix.walk(root):
        for d in range(above // WIDTH + 1 if path else 0, len(path) // WIDTH + 1):
            del open_[d:]
            parent, turn = open_[-1] if open_ else -1, bytes(path[max(d - 1, 0) * WIDTH : d * WIDTH])
            sides = on[parent] if d else (True, True)
            on.append(tuple(side and edge[max(d - 1, 0) * WIDTH : d * WIDTH] == turn for side, edge in zip(sides, (first, last), strict=True)))
            open_.append(len(up))
            up.append(parent)
            depth.append(d)
            said.append(int.from_bytes(turn[-4:]))
            row.append(None)
        if ends_here is not None:
            row[open_[-1]] = ends_here
    n = len(up)
    shared = [(on[i][0] and depth[i] <= before, on[i][1] and depth[i] <= after) for i in range(n)]
    n_convs, conv_id = [0 if r is None else own[r] for r in row], [None if r is None else least[r] for r in row]
    children, leaves, paid, once, inner = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(n - 1, -1, -1):  # a node's subtree stands behind it
        leaves[i] += not inner[i] and not any(shared[i])
        paid[i] += n_convs[i] * said[i]
        once[i] += 0 if shared[i][0] else said[i]  # a node shared with the range before is counted there
        if (u := up[i]) >= 0:
            inner[u] = True
            children[u] += not shared[i][0]
            for sums in (n_convs, leaves, paid, once):
                sums[u] += sums[i]
            conv_id[u] = conv_id[i] if conv_id[u] is None else min(conv_id[u], conv_id[i])
    key = [keys[0][depth[i]] if shared[i][0] else keys[1][depth[i]] if shared[i][1] else None for i in range(n)]
    return pa.Table.from_batches([batch_of(NODES, [
        (key[i], key[u] if (u := up[i]) >= 0 else None, conv_id[u] if u >= 0 and key[u] is None else None, conv_id[i], depth[i], n_convs[i], children[i],
         leaves[i], paid[i], once[i], NO_ENDS if row[i] is None else ends[row[i]])
        for i in range(n)
    ])])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node, the root included.

    Rows without conv_id belong to no conversation and are left out. Null turn numbers come first; turns with equal numbers are
    ordered by the digest of role and text, and repeated rows are turns of their own. Null role or text is empty. Other columns
    are ignored. An empty table has no node. A conversation's turn ids (20 bytes each) are one value, so it must fit in memory.
    """
    parts = stored(folded(rebuilt(turns)), "paths")
    ranged = parts.join(F.broadcast(shared_depths(parts)), "part")  # one row per range
    nodes = stored(ranged.groupBy("part").applyInArrow(trie, NODES), "nodes")
    merged = nodes.where("key is not null").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.lit(None).cast("long").alias("parent_conv_id"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "paid", "once")],
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    merged = stored(merged, "merged")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    whole = nodes.where("key is null")
    rows = whole.where("parent_key is not null").unionByName(merged).join(above, "parent_key", "left")
    rows = rows.withColumn("parent_conv_id", F.col("above")).drop("above").unionByName(whole.where("parent_key is null"))
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("paid") - F.col("once")).alias("saved_tokens"), "ends_sha256"
    )


SQL = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as mark,
         row_number() over (partition by conv_id order by turn nulls first, mark) as place
  from conversations where conv_id is not null),
convs as (
  select conv_id, xor(list_reduce([4294967295::bigint] || flatten(list_transform(range(1, length(conv_id::varchar) + 1),
           lambda i: [ascii(substr(conv_id::varchar, i::int, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
         lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, (crc & 1) * 3988292384) end), 4294967295::bigint) % 4 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, t.place, t.mark, t.text from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 20 and t.place <= c.h
  union all select c.conv_id, 1, t.place, t.mark, t.text from convs c join turns t on t.conv_id = c.conv_id and t.place > c.h),
marked as (
  select conv_id, row_number() over (partition by conv_id order by part, place) as depth, mark,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from rebuilt),
members as (
  select conv_id, depth, words, sha256(string_agg(mark, '' order by depth) over (partition by conv_id order by depth rows unbounded preceding)) as node from marked
  union all select conv_id, 0, 0, 'root' from convs),
placed as (
  select *, lag(node) over (partition by conv_id order by depth) as parent, depth = max(depth) over (partition by conv_id) as is_end from members),
nodes as (
  select node, depth, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where is_end), '')) as ends_sha256
  from placed group by node, depth),
children as (select parent, count(*) as n from nodes group by parent),
sized as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on c.parent = n.node),
subtrees as (
  select m.node, sum(case when s.n_children = 0 then 1 else 0 end) as n_leaves, sum((s.n_convs - 1) * s.words) as saved_tokens
  from sized s join members m on m.conv_id = s.conv_id and m.depth <= s.depth group by m.node)
select s.conv_id, s.depth::bigint as depth, p.conv_id as parent_conv_id, s.n_convs::bigint as n_convs, s.n_children::bigint as n_children,
       t.n_leaves::bigint as n_leaves, t.saved_tokens::bigint as saved_tokens, s.ends_sha256
from sized s join subtrees t using (node) left join sized p on p.node = s.parent
"""
