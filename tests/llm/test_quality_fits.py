"""The robust fits against a plain version, and how verdicts depend on the number of neighbours."""

import random

import numpy as np
import pytest

from readsift.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"
FLOORS = [f for _, f in quality.STATISTICS.values()]


def clean(rng, low=60, high=200):
    return " ".join(rng.choice(["some", "words", "and", "more", "of", "them", f"u{rng.randrange(999)}"]) for _ in range(rng.randint(low, high)))


def vector(text):
    words, lines = text.split(), [x for x in text.split("\n") if x.split()]
    n, chars, symbols, dup = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    places = {}
    for i in range(n - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeat = len({j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)})
    lines = len(lines)
    return np.array([np.log(n), np.log(chars / n), np.sqrt(symbols / chars), np.sqrt(dup / lines), np.sqrt(repeat / n)])


def at(values, share):
    """The least value that as many values do not exceed."""
    return np.sort(values)[max(int(np.ceil(share * len(values))) - 1, 0)]


def regular(cov, n):
    typical = np.array([quality.TYPICAL.get(x, 0.0) for x in quality.X])
    out = cov + np.diag(np.square(FLOORS) + quality.PRIOR_ROWS / (n + quality.PRIOR_ROWS) * typical**2)
    for (a, b), share in quality.TOGETHER.items():
        i, k = quality.X.index(a), quality.X.index(b)
        out[i, k] = out[k, i] = cov[i, k] + FLOORS[i] * FLOORS[k] * share
    return out


def distances(rows, mean, cov):
    return np.einsum("ij,jk,ik->i", rows - mean, np.linalg.inv(cov), rows - mean)


def plain_fit(rows):
    mean = np.array([at(c, 0.5) for c in rows.T])
    spread = [1.4826 * at(np.abs(c - m), 0.5) for c, m in zip(rows.T, mean, strict=True)]
    cov, det = regular(np.diag(np.square(spread)), len(rows)), np.inf
    while True:
        d2 = distances(rows, mean, cov)
        inner = rows[d2 <= at(d2, quality.HALF)]
        new = regular(np.cov(inner.T, bias=True), len(inner))
        now = np.linalg.slogdet(new)[1]
        if now <= det:
            mean, cov = inner.mean(axis=0), new
        if det - now < quality.STAYS:
            return mean, cov * max(at(distances(rows, mean, cov), 0.5) / quality.MEDIAN_CHI2, 1.0), len(rows)
        det = now


def plain(rows):
    """doc_id -> squared distance, of rows that pass the base rules."""
    x = {i: vector(t) for i, t, _, _ in rows}
    members = {}
    for i, _, lang, source in rows:
        for fit in ((), (lang,), (lang, source)):
            members.setdefault(fit, []).append(i)
    fits = {name: plain_fit(np.array([x[i] for i in ids])) for name, ids in members.items()}
    out = {}
    for i, _, lang, source in rows:
        mean, cov, _ = fits[()]
        for name in ((lang,), (lang, source)):
            own_mean, own_cov, n = fits[name]
            own = n / (n + quality.SHRINK)
            mean, cov = own * own_mean + (1 - own) * mean, own * own_cov + (1 - own) * cov
        out[i] = distances(x[i][None], mean, cov)[0]
    return out


def test_fits_against_a_plain_version(spark):
    rng = random.Random(4)
    rows = []
    for k, (lang, source, n) in enumerate([("en", "a", 120), ("en", "b", 30), ("en", "c", 3), ("de", "a", 60), ("xx", "only", 2)]):
        for i in range(n):
            words = clean(rng, 60 + 30 * k, 150 + 60 * k).split(" ")
            cut = rng.randrange(6, 9)
            text = " ".join(words[:cut]) + "\n" + " ".join(w + "#" * (rng.random() < 0.03 * k) for w in words[cut:])
            if i % 11 == 5:
                text += "\n" + " ".join(words[:cut])
            if i % 29 == 7:
                text = " ".join(rng.choice(["#$%", "|||", f"k{rng.randrange(999)}"]) for _ in range(90))
            rows.append((1000 * k + i, text, lang, source))
    judged = quality.quality(spark.createDataFrame(rows, SCHEMA)).collect()
    assert not any(r.base_failed for r in judged)
    wanted = plain(rows)
    for r in judged:
        assert r.distance**2 == pytest.approx(wanted[r.doc_id], rel=1e-6) and r.kept == (wanted[r.doc_id] <= quality.CUT)
    assert 0 < sum(not r.kept for r in judged) < 20


def test_one_neighbour_more_flips_no_verdict(spark):
    rng = random.Random(9)
    ordinary = [(i, clean(rng), "en", "web") for i in range(400)]
    long = [(1000 + i, clean(rng, 5000, 9000), "en", "books") for i in range(50)]
    verdicts = []
    for n in (49, 50):
        got = quality.quality(spark.createDataFrame(ordinary + long[:n], SCHEMA)).collect()
        verdicts.append({r.doc_id: r.kept for r in got})
    assert all(verdicts[1].values()) and verdicts[0].items() <= verdicts[1].items()
