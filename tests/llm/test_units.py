"""Encoding through units, and blocks met with their starts."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from readsift.llm import bytepairs, dac


def test_blocks_are_not_shuffled_for_their_starts(spark, tmp_path):
    path = str(tmp_path / "store")
    dac.write_tokens(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"), path)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plan = dac.blocks(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert plan.count("BroadcastHashJoin") >= 1
    assert [r.start for r in dac.read_tokens(spark, path).orderBy("doc_id").collect()] == [0, 3]


def test_units_equal_the_library():
    library = Tokenizer.from_file(public_tokenizers.path(dac.VOCABULARY))
    rng = random.Random(1)
    parts = ["a", "word", " ", " ", " ", "\n", "　", "\x1c", "\x85", "᠎", "​", "<|endoftext|>", "'s", "don't", "12", "½", "漢字", "é", "😀", "_", "'", " '"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)] + ["", " ", "a ", "a\n <|endoftext|>", "a  b"]
    ids, sizes = dac.Encoder(dac.VOCABULARY).encode(texts)
    for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert own.tolist() == [*library.encode(text, add_special_tokens=False).ids, dac.END]


def test_words_are_encoded_when_first_met():
    asked = []

    def encode(words):
        asked.append(list(words))
        return np.array([int(w) for w in words]), np.ones(len(words), np.int64)

    own = bytepairs.Remembered(encode, 3)
    assert [x.tolist() for x in own.gather([["1", "2", "1"], []])] == [[1, 2, 1], [3, 0]]
    assert own.gather([["2", "3", "4"]])[0].tolist() == [2, 3, 4]
    assert own.gather([["4"]])[0].tolist() == [4]
    assert asked == [["1", "2"], ["3", "4"], ["4"]]
