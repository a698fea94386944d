"""Benchmark decontamination: short test items inside long documents.

Items are partitioned by the size of their shingle sets. An item's sketch is its smallest shingle hashes
(bottom-k MinHash), with k set by its size partition: a document that holds the asked share of the item's
shingles misses too few of them to miss the whole sketch. So no contained item escapes, and a document is
looked at only if it has some sketch value. Candidates are verified on exact shingle strings.
An item with fewer words than a shingle is one shingle of its own length, looked for in word runs of that length.
"""

from pyspark.sql import DataFrame, functions as F

from readsift.llm.native import grams, words
from readsift.llm.storage import stored

SHINGLE = 5
PERCENT = 75
SKETCH_ROWS = 200_000  # sketch values (two numbers each) that are broadcast; beyond, the join shuffles
ITEM_ROWS = 200_000  # shingle strings of items that are broadcast
CANDIDATE_ROWS = 500_000  # candidate document keys (two numbers each) that are broadcast

NO_ID = -(1 << 63)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shingles_of(array: str, widths: list, value):
    """value(words) of each run of as many words as the widths say, SHINGLE first."""
    runs = [grams(array, w, value) for w in (SHINGLE, *widths)]
    return runs[0] if len(runs) == 1 else F.flatten(F.array_compact(F.array(*runs)))


def short_widths(shingles: DataFrame) -> list:
    """Word counts of the items that are shorter than a shingle, as far as there are any."""
    width = F.size(F.split("shingle", " "))
    return sorted(r.width for r in shingles.select(width.alias("width")).where(F.col("width") < SHINGLE).distinct().collect())


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, shingle, hash, n): distinct shingles of each item with the size of its set; a shorter item is its own shingle."""
    join = lambda s: F.array_join(s, " ")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.lower("text")).alias("w")).where("item_id is not null")
    rows = rows.select("item_id", F.explode(F.when(F.size("w").between(1, SHINGLE - 1), F.array(join(F.col("w")))).otherwise(grams("w", SHINGLE, join))).alias("shingle")).distinct()
    sizes = rows.groupBy("item_id").agg(F.count("*").alias("n"))
    return rows.join(sizes, "item_id").withColumn("hash", F.xxhash64(F.split("shingle", " ")))


def sketches(shingles: DataFrame, percent: int) -> DataFrame:
    """(item_id, hash): the smallest hashes of each item, as many as its size partition [2^p, 2^(p+1)) asks."""
    per_item = shingles.groupBy("item_id").agg(F.array_sort(F.collect_set("hash")).alias("hashes"), F.first("n").alias("n"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    k = (F.floor(largest * (100 - percent) / 100) + 1).cast("int")
    return per_item.select("item_id", F.explode(F.slice("hashes", F.lit(1), k)).alias("hash"))


def leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared) of documents that hold at least `percent` % of an item's distinct 5-word shingles.

    Case is folded; words are runs of characters other than space and 0x09 to 0x0D. An item with fewer than
    five words has one shingle, all its words. Items without words or an id are not searched. Null or empty texts hold none. A
    document is a doc_id (null too) and a text: a repeated row gives no further rows. Other columns are ignored.
    """
    shingles = stored(item_shingles(items), "items")
    sketch, widths = stored(sketches(shingles, percent), "sketch"), short_widths(shingles)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc", F.crc32("text").alias("chk"), "text")
    hashed = texts.withColumn("w", words(F.lower("text"))).select("doc", "chk", F.explode(shingles_of("w", widths, F.xxhash64)).alias("hash"))
    candidates = stored(hashed.join(small(sketch, SKETCH_ROWS), "hash").groupBy("doc", "chk", "item_id").agg(F.lit(1).alias("found")).drop("found"), "candidates")
    keys = stored(candidates.select("doc", "chk").distinct(), "candidate-documents")
    wanted = texts.join(small(keys, CANDIDATE_ROWS), ["doc", "chk"], "left_semi").withColumn("w", words(F.lower("text")))
    own = wanted.select("doc", "chk", F.explode(F.array_distinct(shingles_of("w", widths, lambda s: F.array_join(s, " ")))).alias("shingle"))
    # distinct again: repeated rows of one document
    shared = own.join(small(shingles.select("shingle", "item_id", "n"), ITEM_ROWS), "shingle").distinct().groupBy("doc", "chk", "item_id", "n").agg(F.count("*").alias("n_shared"))
    found = shared.join(candidates, ["doc", "chk", "item_id"], "left_semi").where(F.col("n_shared") * 100 >= F.col("n") * percent)
    return found.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "item_id", F.col("n").alias("n_shingles"), "n_shared")


SQL = r"""
with items as (
  select item_id, w, least(len(w), 5) as width
  from (select item_id, list_filter(string_split_regex(lower(text), '[ \t-\r]+'), lambda x: x <> '') as w from benchmark where item_id is not null)
  where len(w) > 0),
item_shingles as (
  select distinct item_id, array_to_string(w[i : i + width - 1], ' ') as shingle from (select *, unnest(range(1, len(w) - width + 2)) as i from items)),
sized as (select item_id, shingle, count(*) over (partition by item_id) as n from item_shingles),
docs as (
  select doc_id, list_filter(string_split_regex(lower(text), '[ \t-\r]+'), lambda x: x <> '') as w from documents),
doc_shingles as (
  select distinct doc_id, array_to_string(w[i : i + width - 1], ' ') as shingle
  from (select doc_id, w, width, unnest(range(1, len(w) - width + 2)) as i from docs join (select distinct width from items) on len(w) >= width))
select doc_id, item_id, n as n_shingles, count(*) as n_shared
from doc_shingles join sized using (shingle)
group by doc_id, item_id, n having 100 * count(*) >= 75 * n
"""
