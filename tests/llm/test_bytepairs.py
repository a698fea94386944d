"""BPE by merge rounds against the tokenizers library."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from readsift.llm import bytepairs

ALPHABET = [
    "a", "b", "th", "e ", " ", "  ", "\n", "\t", "'s", "'ll", "'", "1", "23", "é", "漢", "ß", " ", "　", "\u0085", "​", "😀", "<|endoftext|>", "<|endo", "!", "²", "ⅷ", "\x1c",
    "\x00", "_", "Ω", " ", "ǅ", "\U0001f1e6", "́",
]


@pytest.fixture(scope="module", params=[True, False])
def sides(request):
    library = Tokenizer.from_file(public_tokenizers.path(bytepairs.MODEL))
    library.encode_special_tokens = not request.param
    return library, bytepairs.Codec(special=request.param)


def texts():
    rng = random.Random(1)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(1500)]
    out += ["a" * n for n in (511, 512, 513, 2000)] + ["".join(rng.choice("abcdetnsir") for _ in range(n)) for n in (600, 5000)] * 2
    return [*out, "ab" * 700, " " * 900, "\n" * 800, "=-" * 600, "x" * 70_000]


def test_ids_of_many_texts(sides):
    library, codec = sides
    ids, sizes = codec.encode(texts())
    at = 0
    for text, n in zip(texts(), sizes.tolist(), strict=True):
        got = ids[at : at + n].tolist()
        at += n
        assert got == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(got) == library.decode(got, skip_special_tokens=False) == text


def test_characters_are_split_as_the_library_does(sides):
    library, codec = sides
    rng = random.Random(2)
    chars = [chr(c) for c in rng.sample(range(128, 0x30000), 20_000) if not 0xD800 <= c < 0xE000]
    lines = [f"a{c} 1{c}!{c}{c} " for c in chars]
    ids, sizes = codec.encode(lines)
    assert ids.tolist() == [i for x in library.encode_batch(lines, add_special_tokens=False) for i in x.ids] and len(sizes) == len(lines)


def test_stretches_and_forgetting(sides):
    library, codec = sides
    rng = random.Random(3)
    long = "".join(rng.choice(["abc ", "de'll ", "漢字 ", " \n ", "<|endoftext|> ", "w" * 50]) for _ in range(5000))
    parts = list(codec.stretches(long, 1000))
    assert "".join(parts) == long and len(parts) > 10
    codec.words.most = 100
    assert [i for p in parts for i in codec.encode([p])[0].tolist()] == library.encode(long, add_special_tokens=False).ids
    codec.words.most = bytepairs.KNOWN


def test_merges_must_build_on_each_other():
    with pytest.raises(ValueError):
        bytepairs.Merges({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])


def test_round_trip(spark):
    library = Tokenizer.from_file(public_tokenizers.path(bytepairs.MODEL))
    rows = [(i, t) for i, t in enumerate(texts()[:300])] + [(None, "null id"), (3, None), (3, ""), (4, "again"), (4, "again"), (5, "long one " * 300_000)]
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, n_tokens long, ids string")
    got = sorted(map(repr, map(tuple, bytepairs.round_trip(docs).collect())))
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(map(repr, want))
    back = bytepairs.decode(bytepairs.encode(docs)).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(i), t or "") for i, t in rows)
    assert bytepairs.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).collect() == [(1, ""), (2, "")]
    assert bytepairs.round_trip(docs.limit(0)).count() == bytepairs.decode(bytepairs.encode(docs.limit(0))).count() == 0
