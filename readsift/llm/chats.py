"""Chat formatting after collapse of cumulative snapshots.

A conversation that is logged after each turn leaves snapshots that prefix the last one. Every turn gets
the rolling hash of the turns up to it; a conversation whose last hash is a hash inside a longer one is a
prefix of it. Anti-joins on these hashes keep the maximal conversations, which are then rendered.
"""

from pyspark.sql import DataFrame, Window, functions as F

from readsift.llm.storage import stored

STRETCH = 1024  # turns that are ordered together: long conversations are dealt out in stretches


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, h1, h2): each turn's place and two rolling hashes of all turns up to it.

    Turns are ordered by (turn, role, text), nulls first. Within a stretch of turn numbers hashes are
    combined by a window; stretches are then joined by their totals.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"), F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62))).cast("long").alias("stretch"),
    ).where("conv_id is not null")
    inside = Window.partitionBy("conv_id", "stretch").orderBy("turn", "role", "text")
    rows = rows.withColumn("rn", F.row_number().over(inside))
    sizes = rows.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("conv_id", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rows = rows.join(base, ["conv_id", "stretch"]).withColumn("place", F.col("base") + F.col("rn"))
    # a turn's place is part of its hash, so the combination by exclusive or knows the order
    for h, seed in (("h1", 1), ("h2", 2)):
        rows = rows.withColumn(h, F.xxhash64(F.lit(seed), "place", *[x for c in ("role", "text") for x in (F.isnull(c), F.coalesce(c, F.lit("")))]))
    through = inside.rowsBetween(Window.unboundedPreceding, 0)
    rolled = rows.withColumns({h: F.bit_xor(h).over(through) for h in ("h1", "h2")})
    totals = rows.groupBy("conv_id", "stretch").agg(*[F.bit_xor(h).alias(h) for h in ("h1", "h2")])
    before = totals.select("conv_id", "stretch", *[F.coalesce(F.bit_xor(h).over(earlier), F.lit(0)).alias(f"b{h}") for h in ("h1", "h2")])
    joined = rolled.join(before, ["conv_id", "stretch"])
    return joined.select("conv_id", "place", "turn", "role", "text", *[F.col(h).bitwiseXOR(F.col(f"b{h}")).alias(h) for h in ("h1", "h2")])


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id of conversations that no longer one begins with; of equal ones the smallest id."""
    ends = rolled.groupBy("conv_id").agg(F.max_by(F.struct("h1", "h2"), "place").alias("h"), F.max("place").alias("n_turns"))
    ends = stored(ends.select("conv_id", "n_turns", "h.h1", "h.h2"), "ends")
    unique = ends.groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    # inner turns: those that a conversation goes on after; folded per task before the shuffle
    inner = rolled.join(ends.select("conv_id", "n_turns"), "conv_id").where("place < n_turns")
    inner = inner.groupBy(F.col("place").alias("n_turns"), "h1", "h2").agg(F.lit(1).alias("seen")).drop("seen")
    return unique.join(inner, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, chat) of maximal conversations.

    A turn is rendered as `<|role|>`, newline, text, newline; null roles as `unknown`, null texts as empty. Rows without conv_id
    are left out. Repeated rows and turns with equal numbers are turns of their own, ordered by role and text. A conversation
    is rendered into one value, as it is one training example. Other columns are ignored.
    """
    rolled = stored(prefixes(turns), "rolled")
    kept = maximal(rolled)
    said = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    lines = rolled.join(kept, "conv_id").select("conv_id", "n_turns", F.struct("place", said.alias("said")).alias("line"))
    chats = lines.groupBy("conv_id", "n_turns").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return chats.select("conv_id", "n_turns", F.array_join(F.transform("lines", lambda x: x["said"]), "").alias("chat"))


SQL = r"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place,
         coalesce(length(role)::varchar || ':' || role, 'null') || coalesce(length(text)::varchar || ':' || text, 'null') as mark,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) as said
  from conversations where conv_id is not null),
rolled as (
  select conv_id, place, md5(string_agg(mark, '' order by place) over (partition by conv_id order by place rows unbounded preceding)) as h,
         count(*) over (partition by conv_id) as n_turns from turns),
ends as (select min(conv_id) as conv_id, n_turns, h from rolled where place = n_turns group by n_turns, h),
kept as (
  select conv_id, n_turns from ends e
  where not exists (select 1 from rolled r where r.place = e.n_turns and r.h = e.h and r.place < r.n_turns))
select k.conv_id, k.n_turns, string_agg(t.said, '' order by t.place) as chat
from kept k join turns t using (conv_id) group by k.conv_id, k.n_turns
"""
