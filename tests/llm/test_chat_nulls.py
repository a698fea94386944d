"""Null roles and texts are equal to nothing else."""

import duckdb

from readsift.llm import chats


def test_null_is_not_a_string(spark):
    rows = [
        (1, 0, "user", None), (2, 0, "user", "\x00"), (2, 1, "bot", "b"), (3, 0, None, "x"), (4, 0, "", "x"), (4, 1, "bot", "y"),
        (5, 0, "user", ""), (6, 0, "user", None), (6, 1, "bot", "c"), (7, 0, "user", "null"), (8, 0, "user", "nul"), (8, 1, "l", "z"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, chats.formatted(turns).collect()))
    # only 1 begins another conversation: 6
    assert [r[0] for r in got] == [2, 3, 4, 5, 6, 7, 8]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(con.execute(chats.SQL).fetchall()) == got
