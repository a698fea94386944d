"""Prefix trie of conversations against plain dictionaries and DuckDB; the radix tree against sorted keys."""

import random
import re
import zlib
from hashlib import sha256

import duckdb
import pytest

from readsift.llm import prefixes, radix

SCHEMA = "conv_id long, turn long, role string, text string, path string, part int"


def plain(rows: list) -> list:
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            said = role or "", text or ""
            mark = sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, mark, *said))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(full[c]) + 1):
            members.setdefault(full[c][:d], []).append(c)
    children, leaves, saved = {p: set() for p in members}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    for p, cs in members.items():
        n_words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * n_words
    return sorted(
        repr((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), leaves[p], saved[p],
              sha256(",".join(str(c) for c in sorted(cs) if full[c] == p).encode()).hexdigest()))
        for p, cs in members.items()
    )


def conversations(seed: int, n: int) -> list:
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.randrange(20 * n)
        for turn in range(rng.randrange(1, 6)):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["hi", "hi there you", "  ", "", None, "a b", "tail " * 3])))
    rows += [(None, 1, "user", "no id"), (7, None, "user", "null turn"), (7, 1, None, None), (7, 1, None, None), (7, 1, "", "\x00")]
    rows += [(c, 0, "user", "the same start") for c in range(1000 * n, 1000 * n + 200)]  # one very common conversation
    rows += [(c, t, "user", f"turn {t} {'' if t < 2 else c}") for c in range(2000 * n, 2000 * n + 40) for t in range(5)]  # and a common beginning
    return rows + [(20 * n * 500, t, "user", f"long {t}") for t in range(300)]


@pytest.mark.parametrize(("seed", "n"), [(1, 5), (2, 60), (3, 400)])
def test_trie(spark, seed, n):
    rows = sorted(set(conversations(seed, n)), key=repr) + [(7, 1, None, None)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(map(repr, map(tuple, prefixes.prefix_trie(turns).collect())))
    assert got == plain(rows)


def test_empty_and_single(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefixes.prefix_trie(none).count() == 0
    # turnless when rebuilt: the first turns of a conversation that is absent
    c = next(i for i in range(1, 99) if i % 20 and zlib.crc32(str(i).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    assert [tuple(r) for r in prefixes.prefix_trie(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()] == [
        (c, 0, None, 1, 0, 1, 0, sha256(str(c).encode()).hexdigest())
    ]


def test_sql_twin():
    rows = sorted(set(conversations(4, 40)), key=repr)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    cur = con.execute(prefixes.SQL)
    assert [d[0] for d in cur.description] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(repr, cur.fetchall())) == plain(rows)


def test_radix_tree_grows_and_keeps_order():
    rng = random.Random(5)
    keys = {bytes(rng.randrange(256) if i < 1 else rng.randrange(3) for i in range(rng.randrange(6))) for _ in range(3000)}
    root = radix.Node(b"")
    for key in rng.sample(sorted(keys), len(keys)):
        radix.insert(root, key, key)
    found = [(bytes(path), row) for path, _, row in radix.walk(root) if row is not None]
    assert found == [(k, k) for k in sorted(keys)]
    kinds = set()
    left = [root]
    while left:
        node = left.pop()
        kinds.add(type(node.children))
        left += [child for _, child in node.items()]
    assert kinds >= {type(None), radix.Sorted, radix.Full}
