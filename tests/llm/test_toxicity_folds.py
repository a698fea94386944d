import pytest
from pyspark.sql import functions as F

from readsift.llm import toxicity


def test_few_toxic_labels_still_train(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and len({r.score for r in rows}) > 1


def labelled(spark, rows):
    """documents and labels of (doc_id, text, toxic) rows; ids that are held out are moved on."""
    out = [(i, t, y) for i, t, y in rows]
    return spark.createDataFrame(out, "doc_id long, text string, toxic int").drop("toxic"), spark.createDataFrame(out, "doc_id long, text string, toxic int").drop("text")


def learnable(spark, n):
    ids = spark.range(10 * n + 50).where(~toxicity.held_out(F.col("id"))).limit(n).collect()
    return [r.id for r in ids]


def test_parts_have_both_labels_and_copies_stay_together(spark):
    ids = learnable(spark, 60)
    rows = [(i, f"text {k // 2} of many", int(k < 8)) for k, i in enumerate(ids)]  # four distinct toxic texts, each twice
    docs, labels = labelled(spark, rows)
    got = toxicity.sample(docs, labels, 1000).collect()
    assert len(got) == 60
    parts = {}
    for r in got:
        parts.setdefault(r.text, set()).add(r.part)
    assert all(len(p) == 1 for p in parts.values())
    for label in (0, 1):
        assert {r.part for r in got if r.toxic == label} == {"lexicon", "trees", "calibration"}


def test_repeated_ids_and_conflicting_labels(spark):
    ids = learnable(spark, 30)
    rows = [(i, f"text {k}", int(k < 5)) for k, i in enumerate(ids)]
    docs, labels = labelled(spark, rows)
    more = docs.unionByName(docs).unionByName(spark.createDataFrame([(ids[0], "zz other text")], "doc_id long, text string"))
    both = labels.unionByName(spark.createDataFrame([(ids[7], 1), (ids[0], 0), (None, 1), (ids[9], None)], "doc_id long, toxic int"))
    got = {r.text: r.toxic for r in toxicity.sample(more, both, 1000).collect()}
    assert got == {t: int(k < 5 or k == 7) for k, (_, t, _) in enumerate(rows)}
    assert toxicity.sample(more, both, 10).count() == 10


@pytest.mark.parametrize("toxic,scores", [([], {0.0}), ([0] * 30, {0.0}), ([1] * 30, {1.0}), ([1] + [0] * 29, None)])
def test_constant_only_without_a_label(spark, toxic, scores):
    ids = learnable(spark, len(toxic))
    texts = ["YOU are such a vile, vile fool!!" if y else f"plain words about item {k}." for k, y in enumerate(toxic)]
    docs, labels = labelled(spark, [(i, t, y) for i, t, y in zip(ids, texts, toxic, strict=True)])
    docs = docs if toxic else spark.createDataFrame([(1, "a")], "doc_id long, text string")
    got = {r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert got == scores if scores else len(got) > 1
