"""The pipeline's stages on whole small tables."""

import corpus_pipeline
from readsift.llm import decontaminate, hyperminhash, suffixes

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in kept.collect()}
        rows = stage(spark, kept, SF).collect()
        assert all(set(r.asDict()) == set(corpus_pipeline.COLUMNS) for r in rows) and {r.doc_id for r in rows} <= set(before)
        after = {r.doc_id: r.text for r in rows}
        if name == "near_dedup":
            truth = hyperminhash.brute_force(list(before.items()))
            assert set(after) == {i for i, (_, c) in truth.items() if i == c}
        if name == "suffix_dedup":
            ids = list(before)
            removed = dict(zip(ids, (x[1] for x in suffixes.brute_force([(i, before[i]) for i in ids])), strict=True))
            assert all(after[i] == before[i] for i in ids if not removed[i])
            assert all(0 <= len(before[i].encode()) - removed[i] - len(after[i].encode()) <= 12 for i in ids)
        if name == "decontamination":
            assert decontaminate.leaks(spark.createDataFrame(rows, kept.schema), spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        kept = spark.createDataFrame(rows, kept.schema)
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in final} == {r.doc_id for r in kept.collect()} and all(r.decoded for r in final)


def test_cut_keeps_the_replacement_characters_of_a_text(spark):
    passage = " ".join(f"wörd{i}" for i in range(30))
    texts = {1: f"ü {passage}ü first", 2: f"a\ufffdb {passage}ö tail \ufffd\ufffd end", 3: "\ufffd alone", 4: f"漢{passage[1:]}字 of \ufffd four"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, docs, SF).collect()}
    # doc 2: the blank before the passage and the first byte of ö stand in doc 1 too
    wanted = {1: texts[1], 2: "a\ufffdb tail \ufffd\ufffd end", 3: texts[3], 4: "漢字 of \ufffd four"}
    assert got == {i: (t, len(t)) for i, t in wanted.items()}
