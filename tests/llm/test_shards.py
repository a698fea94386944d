"""Sizes of the shards of suffix dedup."""

from readsift.llm import suffixes


def test_shards_are_large_enough_for_their_fixed_cost(spark):
    docs = spark.range(60).selectExpr("id as doc_id", "repeat('abcdefgh', 131072) as text")
    assert suffixes.shards(docs) == max(suffixes.exchange.buckets(docs), 40)
