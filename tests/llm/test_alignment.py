"""Tokenizer alignment against the two libraries and a plain count."""

import random
from collections import Counter
from hashlib import sha256
from itertools import accumulate

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from readsift.llm import alignment, bytepairs

ALPHABET = ["a", "b", "th", "e ", " ", "  ", "\n", "\t", "'s", "1", "23", "é", "漢", " ", "😀", "<s>", "<unk>", "<0x41>", "<|endoftext|>", "!", "...", "\x00", "ﬁ", "the ", "ing"]


def plain(texts: list) -> list:
    """The contract, one text and one token at a time."""
    first = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))
    letters, vocabulary = bytepairs.byte_alphabet(), {i: t for t, i in first.get_vocab().items()}
    counts, rows = Counter(), []
    for text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in vocabulary[i]) for i in a]
        raw_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            rows.append(([], [], [], ""))
            continue
        end_a, end_b = (list(accumulate(map(len, raw))) for raw in (raw_a, raw_b))
        both = sorted(set(end_a) & set(end_b))
        links = [(x, y) for x, p in zip(a, end_a, strict=True) for y, q in zip(b, end_b, strict=True) if p == q]
        groups, low = [], 0
        for p in both:
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends, strict=True) if low < e <= p) for ids, ends in ((a, end_a), (b, end_b))))
            low = p
        counts.update(links)
        rows.append((a, b, links, ";".join(groups)))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [
        (len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha256(g.encode()).hexdigest() if g else "")
        for a, b, links, g in rows
    ]


def test_alignment(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 50))) for _ in range(300)]
    texts += [None, "", " ", "  ", "a ", "▁ in it", "copied text"] + ["copied text"] * 40 + rng.choices(texts, k=60) + ["word " * 400]
    ids = [*range(len(texts) - 2), None, 5]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, key string, times long")
    got = sorted(map(repr, map(tuple, alignment.alignment(docs).collect())))
    assert got == sorted(repr((i, *x)) for i, x in zip(ids, plain(texts), strict=True))
    assert alignment.alignment(docs.limit(0)).count() == 0


def test_pieces_are_those_of_the_library():
    rng = random.Random(8)
    pieces = alignment.Pieces(alignment.SECOND)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    ids, sizes = pieces.encode([" " + t for t in texts])
    assert ids.tolist() == [i for x in pieces.library.encode(texts) for i in x] and sizes.min() > 0


def test_long_text_goes_in_stretches(monkeypatch):
    rng = random.Random(9)
    own = alignment.aligner(alignment.FIRST, alignment.SECOND)
    text = "".join(rng.choice(["the word ", "  spaced", "\n line ", "漢字 ", "x" * 30, " end. "]) for _ in range(4000))
    (whole,) = own.align([" " + text])
    monkeypatch.setattr(own.a, "stretches", lambda t: bytepairs.Codec.stretches(own.a, t, 500))
    (parts,) = own.rows([text])
    assert parts[:4] == whole[:4] and parts[4].tolist() == whole[4].tolist()
    assert own.rows([text + " ▁"]) == [None]


def test_number_of_pairs_is_bounded_by_the_vocabularies():
    own = alignment.aligner(alignment.FIRST, alignment.SECOND)
    b = {}
    for raw in own.b.raw:
        b[raw] = b.get(raw, 0) + 1
    a = set(own.a.raw)
    bound = sum(b.get(x[k:], 0) for x in a for k in range(len(x))) + sum(n * (y[k:] in a) for y, n in b.items() for k in range(1, len(y)))
    assert bound < 1_000_000
