"""The chain on labelled documents that it hasn't seen, and on its edge cases."""

import numpy as np
from pyspark.sql import functions as F

from yieldstone.llm import toxicity
from yieldstone.llm.queries import QUERIES, TOXICITY_CHAIN, table

FOLDER = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    """Fitted on two thirds of the labels; precision and recall on the rest. Some labels have no sign in the text."""
    docs = table(spark, FOLDER, "documents")
    labels = table(spark, FOLDER, "labels").withColumn("low_quality", 1 - F.col("quality"))
    rest = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    chain = toxicity.train(docs, labels.where(~rest), TOXICITY_CHAIN)
    judged = toxicity.classified(docs, chain, TOXICITY_CHAIN).join(labels.where(rest).select("doc_id", "toxic"), "doc_id")
    n = {(r["toxic"], r["said"]): r["count"] for r in judged.groupBy("toxic", (F.col("p_toxic") >= 0.5).alias("said")).count().collect()}
    assert n[1, True] / (n[1, True] + n.get((0, True), 0)) > 0.95
    assert n[1, True] / (n[1, True] + n[1, False]) > 0.8


def test_query_scores_every_document(spark):
    rows = QUERIES["op1_toxicity_chain"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r["p_toxic"] <= 1 and 0 <= r["p_low_quality"] <= 1 for r in rows)


def test_later_link_learns_from_the_earlier_one():
    """The second category follows the first and has no marks of its own."""
    rng = np.random.default_rng(1)
    seen = rng.random(600) < 0.5
    labels = np.column_stack([seen, seen]).astype(float)
    labels[rng.random(600) < 0.1, 0] = np.nan
    first = toxicity.Sparse([[0] if s else [] for s in seen], 1)
    none = toxicity.Sparse([[] for _ in seen], 0)
    models = toxicity.fit_chain([first, none], labels, np.arange(600) % toxicity.FOLDS)
    p = toxicity.run_chain(models, [first, none])
    assert ((p[:, 1] > 0.5) == seen).all()


def test_edge_cases(spark):
    long = "fine words " * 30_000
    docs = [(1, "you fool", "x"), (1, "you fool", "x"), (2, None, "x"), (3, "", "x"), (4, long, "x"), (5, long + "fool", "x"), (None, "nice text", "x")]
    docs += [(i, f"some nice text number {i} here" + (" Fool!" if i % 2 else ""), "x") for i in range(10, 90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(10, 90)] + [(10, 0, 1), (None, 1, 1)], "doc_id long, toxic int, low_quality int")
    chain = toxicity.train(frame, labels, TOXICITY_CHAIN)
    got = toxicity.classified(frame, chain, TOXICITY_CHAIN)
    p = {r["doc_id"]: r["p_toxic"] for r in got.collect()}
    assert got.count() == len(docs) and p[1] > 0.5 and p[5] > 0.5 and p[4] < 0.5 and p[2] == p[3] < 0.5
    assert toxicity.train(frame, labels.limit(0), TOXICITY_CHAIN) is None
    assert toxicity.classified(frame, None, TOXICITY_CHAIN).where("p_toxic IS NULL").count() == len(docs)
    assert toxicity.classified(frame.limit(0), chain, TOXICITY_CHAIN).count() == 0


def test_sample_is_bounded_by_rows(spark, monkeypatch):
    """One labelled id on most rows."""
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 300)
    seen = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda marks, labels, *_: seen.append(labels.shape))
    frame = spark.range(2000).select(F.expr("CASE WHEN id < 1800 THEN 7 ELSE id END AS doc_id"), F.expr("concat('text of row ', id) AS text"))
    toxicity.train(frame, frame.select("doc_id", F.lit(1).alias("toxic"), F.lit(0).alias("low_quality")), TOXICITY_CHAIN)
    assert seen == [(300, 2)]


def test_marks_are_chosen_without_the_fold_they_judge(spark):
    """A word that all toxic texts of one fold have and no others: it counts with all labels and never for that fold."""
    from yieldstone.llm.common import Scratch

    rows = [(f"word{i} {'planted' if i % 3 == 1 and i % 2 else 'plain'}", i % 2, None, i % 3) for i in range(300)]
    sample = spark.createDataFrame(rows, "text string, toxic int, low_quality int, __fold int")
    planted = toxicity.mark_hash("w planted")
    found = toxicity._telling_marks(sample, "text", ("toxic", "low_quality"), Scratch(spark, "test"))
    assert [planted in marks for marks in found[0]] == [True, True, False, True] and not any(found[1])


def test_chain_matches_a_second_reading(spark):
    """Probabilities from the models' numbers and a plain reading of each text's marks."""
    small = "/root/testdata/sf0.01"
    docs = table(spark, small, "documents").limit(150)
    labels = table(spark, small, "labels").withColumn("low_quality", 1 - F.col("quality"))
    chain = toxicity.train(table(spark, small, "documents"), labels, TOXICITY_CHAIN)
    telling, models = chain
    for r in toxicity.classified(docs, chain, TOXICITY_CHAIN).collect():
        words = r["text"].split()
        marks = {m for w in words for m in toxicity.marks_of(w)} | ({"again"} if any(a == b for a, b in zip(words, words[1:], strict=False)) else set())
        hashes, before = {toxicity.mark_hash(m) for m in marks}, []
        for c, (known, w) in enumerate(zip(telling, models, strict=True)):
            z = sum(w[i] for i, m in enumerate(known) if m in hashes) + sum(w[len(known) + k] * x for k, x in enumerate(before)) + w[-1]
            p = 1 / (1 + np.exp(-z))
            assert abs(r[f"p_{TOXICITY_CHAIN[c]}"] - p) < 1e-9
            p = min(1 - 1e-3, max(1e-3, p))
            before.append(np.log(p / (1 - p)))
