"""op5 finds the new words of a slice together and looks each distinct word up once."""

import random

import numpy as np
import pyarrow as pa

from readsift.llm import nbest


def test_words_of_all_lengths_and_lone_letters_are_searched_together():
    rng = random.Random(5)
    words = {nbest.MARK + "".join(rng.choice("abcdetÈÜ5\né") for _ in range(rng.randint(1, 30))) for _ in range(300)}
    own, alone = nbest.Model(), []
    own.known.find = lambda w: alone.append(w) or own.viterbi(w)
    own.learn(words)
    assert {w: own.known[w] for w in words} == {w: own.viterbi(w) for w in words}
    assert not alone


def test_words_beyond_the_memory_do_not_drive_out_the_others(monkeypatch):
    monkeypatch.setattr(nbest, "KNOWN", 200)
    own, alone = nbest.Model(), []
    own.known.find = lambda w: alone.append(w) or own.viterbi(w)
    plain, odd = {f"{nbest.MARK}w{i}" for i in range(300)}, [f"{nbest.MARK}漢ж{i}" for i in range(5)]
    own.learn(plain)
    assert all(own.known[w] == own.viterbi(w) for w in [*odd, *plain])
    assert not plain & set(alone)


def test_texts_of_a_slice_as_one_by_one():
    rng = random.Random(6)
    texts = ["", " ", nbest.MARK, f"a {nbest.MARK}b", "  the  end ", *("".join(rng.choice("the an io\nαé漢È ▁") for _ in range(rng.randint(0, 40))) for _ in range(200))]
    own, asked = nbest.Model(), []
    words, begin, _, _ = own.cut(pa.array(["x", *texts]).slice(1))
    words = words.to_pylist()
    assert [words[a:z] for a, z in zip(begin[:-1], begin[1:], strict=True)] == [own.words(t) for t in texts]

    class Asked(nbest.Words):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    own.known = Asked(own.viterbi)
    ids, scores, decoded, more = own.segmented(pa.array(texts))
    assert len(asked) == len(set(words)) < len(words)
    for text, one, score, right, rest in zip(texts, ids.to_pylist(), scores, decoded, more, strict=True):
        best = own.encode(text)
        assert (one, score, right) == (best[0][1], [s for s, _ in best], own.decode(one) == text.replace(nbest.MARK, " "))
        whole = np.frombuffer(one, "<u4")
        for s, parts, _ in rest:
            made, at = b"", 0
            for first, n, own_ids in parts:
                made, at = made + whole[at:first].tobytes() + own_ids, first + n
            made += whole[at:].tobytes()
            changes = next(c for t, c in best[1:] if t == s and made == b"".join(c.get(i, own.known[w][1]) for i, w in enumerate(own.words(text))))
            assert len(changes) == len(parts)
