"""Memory that workers hold and give back."""

from readsift.llm import nbest, vectors


def test_remembered_words_stay_within_their_bound(monkeypatch):
    monkeypatch.setattr(nbest, "KNOWN", 1000)
    own = nbest.Model()
    most = 0
    for k in range(12):
        words = {f"{nbest.MARK}w{k * 300 + i}" for i in range(450)}  # a third is asked for again
        own.learn(words)
        assert all(own.known[w] for w in words)
        most = max(most, len(own.known) + len(own.before))
    assert most <= nbest.KNOWN
    word = f"{nbest.MARK}w3700"
    assert own.known[word] == own.viterbi(word)
    assert own.next.itemsize == 2


def test_memory_is_given_back_after_the_last_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(vectors, "release", lambda: calls.append(1))
    rows = vectors.releasing(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert [next(rows), len(calls), next(rows), len(calls), next(rows, None), len(calls)] == [2, 0, 3, 0, None, 1]
