"""One query per operator over its whole table, with production parameters."""

from readsift.llm import (
    alignment, bytepairs, chats, counts, dac, decontaminate, hyperminhash, nbest, prefixes, quality, suffixes, toxicity, windows,
)
from readsift.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401


@query("op4_substring_dedup")
def op4(spark, sf_dir):
    return windows.digest(windows.dedup_windows(table(spark, sf_dir, "documents")))


@query("op8_suffix_dedup")
def op8(spark, sf_dir):
    return suffixes.digest(suffixes.dedup_substrings(table(spark, sf_dir, "documents")))


@query("op10_near_duplicates")
def op10(spark, sf_dir):
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_token_counts")
def op1(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"))


@query("op3_token_store")
def op3(spark, sf_dir):
    return dac.digest(dac.round_trip(table(spark, sf_dir, "documents")))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_quality_rules")
def op6(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@query("op9_decontamination", decontaminate.SQL)
def op9(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_chat_format", chats.SQL)
def op7(spark, sf_dir):
    return chats.formatted(table(spark, sf_dir, "conversations"))


@query("op5_piece_nbest")
def op5(spark, sf_dir):
    return nbest.segmented(table(spark, sf_dir, "documents"))


@query("op11_tokenizer_alignment")
def op11(spark, sf_dir):
    return alignment.alignment(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", prefixes.SQL)
def op12(spark, sf_dir):
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_byte_pairs")
def op13(spark, sf_dir):
    return bytepairs.round_trip(table(spark, sf_dir, "documents"))
