"""Each operator against a brute-force version, and on awkward rows: nulls, empty and long texts, repeated rows, extra columns."""

import itertools
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from readsift.llm import chats, counts, dac, decontaminate, hyperminhash, induced, nbest, quality, queries, suffixes, toxicity, windows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chk string, parts string, n int"


def awkward(spark, rows=None):
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "dé", "漢字", "x1", "|", "don't"]
    long = " ".join(rng.choice(words) for _ in range(3000))
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [
        (1, long), (2, None), (3, ""), (4, " \t\n"), (5, passage), (6, "before it " + passage + " after"), (7, passage), (7, passage),
        (8, "a" * 400), (9, "a" * 400), (None, passage + " null id"), (10, "one two three"), (11, "one two three"), (12, passage.replace("w5 ", "z ")),
        (13, "same id " + long[:500]), (13, "same id, other text"), (14, "word " * 40), (15, long[:900] + "é" + long[300:900]),
    ] if rows is None else rows
    return spark.createDataFrame([(i, t, None if k % 3 else "en", None if k % 4 else "src0", 0, "c", "p", k) for k, (i, t) in enumerate(texts)], SCHEMA)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(rows):
    return sorted(map(repr, rows))


def test_windows(spark):
    docs = awkward(spark)
    got = [tuple(r) for r in windows.digest(windows.dedup_windows(docs)).collect()]
    texts = texts_of(docs)
    assert key(got) == key((i, *x) for (i, _), x in zip(texts, windows.brute_force([t for _, t in texts]), strict=True))


@pytest.mark.parametrize("leaf", [suffixes.LEAF, 3000])
def test_suffixes(spark, leaf):
    docs = awkward(spark)
    got = [tuple(r) for r in suffixes.digest(suffixes.dedup_substrings(docs, leaf=leaf)).collect()]
    texts = texts_of(docs)
    assert key(got) == key((i, *x) for (i, _), x in zip(texts, suffixes.brute_force(texts), strict=True))
    carried = suffixes.dedup_substrings(docs, carry=("text", "n", "chk")).select("carried.n", "carried.chk")
    assert sorted(r.n for r in carried.collect()) == list(range(len(texts)))


def hot_shard(n):
    """Segments round one passage, as a hot anchor gives them: (runs, bytes of each), places of one text at most once."""
    rng = random.Random(4)
    letters = range(97, 123)
    ends, passage = [bytes(rng.choices(letters, k=80)) for _ in range(40)], bytes(rng.choices(letters, k=70))
    texts = [b"ab" * 150]
    for i in range(n):
        left, right = (rng.choice(ends) if rng.random() < 0.5 else bytes(rng.choices(letters, k=80)) for _ in range(2))
        texts.append(left + passage + right if i % 7 else texts[rng.randrange(len(texts))])
    data, offsets = suffixes.flat(suffixes.pa.array(texts, suffixes.pa.binary()))
    start, count, own, _ = suffixes.anchored(data, offsets, 100)
    runs = np.zeros(len(start), suffixes.exchange.RUN)
    runs["doc"], runs["chk"], runs["start"], runs["count"] = own // 2, own, start - offsets[own], count
    raw = data.tobytes()
    return runs, [raw[a : a + c + 99] for a, c in zip(start.tolist(), count.tolist(), strict=True)]


def test_hot_shards_are_dealt_to_leaves(monkeypatch):
    runs, segments = hot_shard(300)
    whole = suffixes.packed(runs, segments)
    marked = lambda parts: {(m["doc"], m["chk"], m["start"] + k) for part in parts for m in part for k in range(m["count"])}
    windows_of = [(r["doc"], r["chk"], r["start"] + k, s[k : k + 100]) for r, s in zip(runs, segments, strict=True) for k in range(r["count"])]
    least = {}
    for doc, _, start, window in windows_of:
        least[window] = min(least.get(window, (doc, start)), (doc, start))
    wanted = {(doc, chk, start) for doc, chk, start, window in windows_of if (doc, start) > least[window]}
    assert len(wanted) > 5000
    leaves = []
    repeats = suffixes.repeats
    monkeypatch.setattr(suffixes, "repeats", lambda data, *more: leaves.append(len(data)) or repeats(data, *more))
    for leaf, payloads in ((1 << 22, [whole]), (20000, [whole]), (3000, [suffixes.packed(runs[i : i + 50], segments[i : i + 50]) for i in range(0, len(runs), 50)])):
        leaves.clear()
        assert marked(suffixes.settle(payloads, 100, leaf, 0, 100 - suffixes.GRAM)) == wanted
        assert sum(leaves) > 0 and (len(leaves) == 1) == (leaf == 1 << 22)
        assert max(leaves) <= leaf


def test_texts_that_share_id_and_start(spark):
    start = "q" + str(7 ** 40) + str(11 ** 110)
    rows = [(20, start + " first"), (20, start + " second"), (None, start[:70]), (3, "lead " + str(11 ** 110)), (None, start[:140] + "a"), (None, start[:140] + "b")]
    docs = awkward(spark, rows)
    got = [tuple(r) for r in suffixes.digest(suffixes.dedup_substrings(docs)).collect()]
    assert key(got) == key((i, *x) for (i, _), x in zip(rows, suffixes.brute_force(rows), strict=True))


@pytest.mark.parametrize("limit", [0, 200, 1 << 28])
def test_induced_sorting(limit):
    rng = random.Random(limit)
    for alphabet, depth in itertools.product((b"a", b"ab", b"abc", bytes(range(256))), (1, 3, 100)):
        for _ in range(12):
            raw = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 50))) * rng.randint(1, 3)
            order, common = [], []
            for pos, lcp in induced.sorted_suffixes(np.frombuffer(raw, np.uint8), depth, limit=limit):
                order += pos.tolist()
                common += lcp.tolist()
            assert sorted(order) == list(range(len(raw)))
            for a, b, c in zip(order, order[1:], common[1:], strict=False):
                assert raw[a : a + depth] <= raw[b : b + depth]
                same = next((k for k in range(depth) if raw[a + k : a + k + 1] != raw[b + k : b + k + 1] or max(a, b) + k >= len(raw)), depth)
                assert same == c


def near_rows():
    rng = random.Random(2)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"r{rng.randrange(400)}"
        rows.append((i, " ".join(w)))
    return rows + [(1000 + i, " ".join(rng.choice(base) for _ in range(rng.randint(1, 80)))) for i in range(60)] + [(2000, None), (2001, "")]


def test_near_duplicates(spark):
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in hyperminhash.near_duplicates(awkward(spark, rows)).collect()}
    assert got == hyperminhash.brute_force(rows)


def test_near_duplicates_awkward(spark):
    rows = hyperminhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 18
    at = {}
    for r in rows:
        at.setdefault(r.doc_id, []).append(r)
    assert at[7][0].component_id == 5 and not at[7][0].kept and at[12][0].component_id == 5
    assert at[11][0].component_id == 10 and at[3][0].n_shingles == 0 and at[3][0].kept and at[2][0].component_id == 2
    assert at[None][0].component_id is None and at[None][0].kept


def test_register_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    b = np.concatenate((a[:3000], rng.integers(0, 1 << 63, 500).astype(np.uint64)))
    r = hyperminhash.registers(np.concatenate((np.sort(a), np.sort(b))), np.array([0, 4000, 7500]))
    assert abs((r[0] == r[1]).mean() - 3000 / 4500) < 0.15


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokens_equal_the_library(name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    rng = random.Random(3)
    parts = ["'s", "'", "a", " ", "  ", "\n", "\t", "x", "É", "1", "23", ".", "!?", "\r\n", "\xa0", "\x85", "\x1c", "漢", "<|endoftext|>", "don't", "'LL", "ß", "İ", "Σ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + ["word " * 30_000]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    if name[0] == "w":
        assert counts.counter(name).counts(texts) == [len(ids) for ids in wanted]
    else:
        assert dac.encoder(name).ids(texts) == [dac.packed([*ids, dac.END]) for ids in wanted]


def test_whole_tokens_are_single():
    own = counts.counter("word_bpe_49k.json")
    assert len(own.one) > 20_000
    assert all(len(e.ids) == 1 for e in own.tokens.library.encode_batch(sorted(own.one), add_special_tokens=False))


def test_token_counts_awkward(spark):
    rows = counts.token_counts(awkward(spark)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 18 and by[2].n_tokens == by[2].n_bytes == 0 and by[1].over_limit and by[8].n_bytes == 400


def test_token_store(spark, tmp_path):
    docs = awkward(spark)
    path = str(tmp_path / "store")
    dac.write_tokens(docs, path)
    rows = sorted(dac.read_tokens(spark, path).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [r.doc_id for r in rows] == sorted((i for i, _ in texts_of(docs)), key=lambda i: (i is not None, i or 0))
    every, wanted = [], {}
    for i, t in texts_of(docs):
        wanted.setdefault(i, []).append(dac.packed([*library.encode(t or "", add_special_tokens=False).ids, dac.END]))
    for r in rows:
        assert bytes(r.ids) in wanted[r.doc_id] and r.start == len(every) and r.n_tokens == len(r.ids) // 4
        every += np.frombuffer(r.ids, "<u4").tolist()
    places = spark.range(0, len(every), 97).withColumnRenamed("id", "place")
    got = {r.place: r.token for r in dac.tokens(spark, path, places).collect()}
    assert got == {p: every[p] for p in range(0, len(every), 97)}


def test_codes_with_three_levels():
    ids = np.array([0, 255, 256, 65_535, 65_536, 16_777_215, 7] * 300, np.uint32)
    chunks, bitmaps, ranks = dac.encode_levels(ids)
    assert len(chunks) == 3 and (dac.decode(chunks, bitmaps) == ids).all()
    block = {"chunks": chunks, "bitmaps": bitmaps, "ranks": ranks}
    assert [dac.token_at(block, i) for i in range(0, len(ids), 41)] == ids[::41].tolist()


def test_segmentations_against_all():
    own = nbest.model(nbest.MODEL, 4)

    def every(word):
        return [(s + t, i + j) for end, s, i in own.edges(word, 0) for t, j in every(word[end:])] if word else [(0.0, b"")]

    rng = random.Random(7)
    for _ in range(80):
        text = "".join(rng.choice("the an io\nαé漢 ") for _ in range(rng.randint(0, 12)))
        best = [0.0]
        for word in own.words(text):
            best = sorted((x + y for x in best for y in sorted((s for s, _ in every(word)), reverse=True)[:4]), reverse=True)[:4]
        got = own.encode(text)
        assert [s for s, _ in got] == best and own.decode(got[0][1]) == text
        for word in own.words(text):
            assert own.search(word)[0] == own.viterbi(word)[:2]
    words = [w for w in {"".join(rng.choice("abcdet▁") for _ in range(7)) for _ in range(300)}]
    assert own.viterbi_all(words, 7) == [own.viterbi(w) for w in words]


def test_pieces_awkward(spark):
    rows = nbest.segmented(awkward(spark)).collect()
    assert len(rows) == 18 and all(r.decoded for r in rows)
    assert [r.n_pieces for r in rows if r.doc_id == 3] == [0]


def test_pieces_of_every_segmentation(spark):
    own = nbest.model(nbest.MODEL, 4)
    score = {i: nbest.BYTE_SCORE if own.library.is_byte(i) else max(own.library.get_score(i), nbest.BYTE_SCORE) for i in range(own.library.get_piece_size())}

    def every(word):
        return [(s + t, i + j) for end, s, i in own.edges(word, 0) for t, j in every(word[end:])] if word else [(0.0, b"")]

    rng = random.Random(11)
    texts = {i: "".join(rng.choice("the an io\nαé漢 ") for _ in range(rng.randint(0, 14))) for i in range(60)} | {60: "the other one and the other ones"}
    for r in nbest.segmentations(nbest.segmented(awkward(spark, list(texts.items())))).collect():
        text, ids, scores = texts[r.doc_id], [bytes(x.ids) for x in r.segmentations], [x.score for x in r.segmentations]
        possible = 1
        for word in own.words(text):
            possible *= len(every(word))
        assert len(ids) == len(set(ids)) == min(4, possible)
        assert all(own.decode(x) == text for x in ids) and all(x.decoded for x in r.segmentations)
        assert scores == sorted(scores, reverse=True)
        assert [sum(score[i] for i in np.frombuffer(x, "<u4").tolist()) for x in ids] == pytest.approx(scores)


def base_counts(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("table", ["awkward", "documents"])
def test_quality_counts(spark, table):
    docs = awkward(spark) if table == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    got = [tuple(r) for r in quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    wanted = []
    for i, t in texts_of(docs):
        c = base_counts(t)
        wanted.append((i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert key(got) == key(wanted)


def test_quality_rejects_outliers(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["some", "words", "and", "more", "of", "them", f"u{rng.randrange(999)}"]) for _ in range(rng.randint(60, 200)))) for i in range(300)]
    rows += [(1000 + i, " ".join(rng.choice(["#$%", "|||", "<<>>", f"k{rng.randrange(999)}"]) for _ in range(100))) for i in range(10)]
    docs = awkward(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    kept = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(10))


def test_quality_judges_small_groups(spark):
    rng = random.Random(1)
    clean = lambda: " ".join(rng.choice(["some", "words", "and", "more", "of", "them", f"u{rng.randrange(999)}"]) for _ in range(rng.randint(60, 200)))
    junk = lambda: " ".join(rng.choice(["#$%", "|||", "<<>>", f"k{rng.randrange(999)}"]) for _ in range(100))
    rows = [(i, clean(), "en", f"s{i // 12}") for i in range(120)] + [(200 + i, clean(), "xx", "s0") for i in range(8)]
    rows += [(1000, junk(), "en", "s3"), (1001, junk(), "en", "only"), (1002, junk(), "xx", "s0"), (1003, junk(), "yy", "only"), (2000, "short", "en", "s0")]
    judged = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all((r.distance is None) == r.base_failed for r in judged.values()) and judged[2000].base_failed
    assert {i for i, r in judged.items() if r.kept} == {i for i in judged if i < 1000}


def test_quality_rejects_by_each_statistic(spark):
    rng = random.Random(1)
    clean = lambda n: [rng.choice(["some", "words", "and", "more", "of", "them", f"u{rng.randrange(999)}"]) for _ in range(n)]
    rows = [(i, " ".join(clean(rng.randint(60, 200)))) for i in range(300)]
    body, passage = clean(72), clean(14)
    planted = {
        "x0": " ".join(clean(3000)),
        "x1": " ".join(w + w for w in clean(100)),
        "x2": " ".join(w if k % 5 else "##" + w[2:] for k, w in enumerate(clean(100))),
        "x3": "\n".join(w for i in range(25) for w in (f"then u{i}", "some", "words", "more")),
        "x4": " ".join(body[:20] + passage + body[20:] + passage),
    }
    rows += [(1000 + k, text) for k, text in enumerate(planted.values())]
    docs = awkward(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    judged = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert not any(judged[1000 + k].base_failed for k in range(5)) and all(judged[i].kept for i in range(300))
    assert [x for k, x in enumerate(planted) if judged[1000 + k].kept] == []
    assert judged[1003].n_repeat_words == 0 and judged[1004].n_dup_lines == 0


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs.withColumn("toxic", F.lit(9)), labels).join(labels, "doc_id").where("held_out").collect()
    good = sum(r.predicted == r.toxic for r in rows)
    assert good >= 0.85 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.toxicity(awkward(spark), labels.limit(0)).collect()
    assert len(none) == 18 and {r.score for r in none} == {0.0}


def oracle(spark, name, tables):
    con = duckdb.connect()
    for t, df in tables.items():
        con.register(t, df.toArrow())
    cols = sorted(queries.QUERIES[name](spark, SF).columns)
    return key(con.execute(f"select {', '.join(cols)} from ({queries.ORACLES[name]})").fetchall()), cols


def test_decontamination(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(5, 40))), (2, "too short"), (3, None), (None, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    docs = awkward(spark)
    wanted, cols = oracle(spark, "op9_decontamination", {"documents": docs.select("doc_id", "text").where("doc_id is not null"), "benchmark": items})
    got = decontaminate.leaks(docs.where("doc_id is not null"), items).select(*cols).collect()
    assert key(tuple(r) for r in got) == wanted and {r.doc_id for r in got} >= {5, 6, 7}
    assert any(r.doc_id is None for r in decontaminate.leaks(docs, items).collect())


def test_decontamination_of_short_items(spark):
    rows = [(1, "w4 w5\tW6 w7"), (2, "TWO  three"), (3, "one two three"), (4, "漢字"), (5, " ".join(f"w{i}" for i in range(5))), (6, "three two"), (7, " \t"), (None, "one")]
    docs = awkward(spark)
    wanted = []
    for doc, text in {(i, t) for i, t in texts_of(docs) if t}:
        words = text.lower().split()
        runs = {tuple(words[i : i + n]) for n in range(1, 6) for i in range(len(words) - n + 1)}
        wanted += [(doc, item, 1, 1) for item, t in rows if item is not None and (w := tuple(t.lower().split())) and w in runs]
    got = [tuple(r) for r in decontaminate.leaks(docs, spark.createDataFrame(rows, "item_id long, text string")).collect()]
    assert key(got) == key(wanted) and {i for _, i, _, _ in wanted} == {1, 2, 3, 4, 5}
    items = spark.createDataFrame(rows, "item_id long, text string")
    twin, cols = oracle(spark, "op9_decontamination", {"documents": docs.select("doc_id", "text"), "benchmark": items})
    assert twin == key({tuple(r) for r in decontaminate.leaks(docs, items).select(*cols).collect()})


def test_chats(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (3, 2, "user", None),
             (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, None, None, None), (6, 0, "user", "hi"), (6, 1, "assistant", "no"), (7, 5, "user", "tie"), (7, 5, "user", "tie")]
    turns += [(8, i, "user", f"t{i}") for i in range(2500)] + [(9, i, "user", f"t{i}") for i in range(1200)]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, place int")
    got = {r.conv_id: r for r in chats.formatted(df).collect()}
    assert set(got) == {3, 4, 5, 7, 8} and got[8].n_turns == 2500
    assert got[3].chat == "<|user|>\nhi\n<|assistant|>\nyes\n<|user|>\n\n" and got[5].chat == "<|unknown|>\n\n"


def test_empty_tables(spark):
    docs = awkward(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (
        windows.dedup_windows(docs), suffixes.dedup_substrings(docs), hyperminhash.near_duplicates(docs), counts.token_counts(docs), dac.round_trip(docs),
        nbest.segmented(docs), quality.quality(docs), toxicity.toxicity(docs, labels), decontaminate.leaks(docs, items), chats.formatted(turns),
    ):
        assert df.collect() == []
