"""Held-out accuracy of the quality score, its class prior, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from yieldstone.llm import quality
from yieldstone.llm.queries import QUERIES, table

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    scored = QUERIES["op5_quality_pu"](spark, FOLDER)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(table(spark, FOLDER, "labels"), "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.98
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert scored.count() == 10_000


def test_labels_zero_are_never_read(spark, tmp_path):
    """Turning all labels 0 into missing ones changes nothing."""
    small = "/root/testdata/sf0.01"
    for name in ("documents", "labels"):
        rows = table(spark, small, name)
        (rows if name == "documents" else rows.where("quality = 1")).write.parquet(f"{tmp_path}/{name}.parquet")
    one, other = ({r["doc_id"]: r["score"] for r in QUERIES["op5_quality_pu"](spark, d).collect()} for d in (small, str(tmp_path)))
    assert one == other


def test_class_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        own = rng.normal(2, 1, 4000)
        web = np.concatenate([rng.normal(2, 1, int(6000 * share)), rng.normal(-2, 1, 6000 - int(6000 * share))])
        assert abs(quality.class_prior(own, web) - share) < 0.06


def test_risk_recovers_a_known_border():
    rng = np.random.default_rng(2)
    positive = rng.normal(1.5, 1, (2000, 2))
    web = np.concatenate([rng.normal(1.5, 1, (1500, 2)), rng.normal(-1.5, 1, (1500, 2))])
    model = quality.fit(positive, web)
    g = quality.standardised(web, model.mean, model.spread) @ model.weights + model.bias
    assert abs(model.prior - 0.5) < 0.1 and ((g > 0) == (np.arange(3000) < 1500)).mean() > 0.95


def test_edge_cases(spark):
    long = "plain words of prose, here. " * 20_000
    docs = [(i, f"Some plain prose with words {i} and more, as usual." if i % 3 else "### $$$ ### !!! ###", "x") for i in range(60)]
    docs += [(100, None, "x"), (101, "", "x"), (102, " \n", "x"), (103, long, "x"), (103, long, "x"), (None, "plain prose", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    trusted = spark.createDataFrame([(i,) for i in range(60) if i % 3] + [(None,)], "doc_id long")
    model = quality.train(frame, trusted, F.lit(True))
    rows = quality.scored(frame, model).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == len(docs) and score[100] == score[101] and all(0 <= s <= 1 for s in score.values())
    assert quality.train(frame, trusted.limit(0), F.lit(True)) is None
    assert {(r["score"], r["predicted"]) for r in quality.scored(frame, None).collect()} == {(0.5, 1)}
    assert quality.scored(frame.limit(0), model).count() == 0


def test_samples_are_bounded_by_rows(spark, monkeypatch):
    """One id on most rows: at most the documented number of rows, and other texts of it are drawn as well."""
    frame = spark.range(3000).select(F.expr("CASE WHEN id < 2500 THEN 7 ELSE id END AS doc_id"), F.expr("concat('text of row ', id % 2000) AS text"))
    drawn = quality.drawn_rows(frame, 400, "doc_id", "text").collect()
    assert len(drawn) == 400 == len({(r["doc_id"], r["text"]) for r in drawn}) and any(r["doc_id"] == 7 for r in drawn)
    same = frame.where("doc_id = 7").withColumn("text", F.lit("same"))
    assert quality.drawn_rows(same, 400, "doc_id", "text").count() == 1
    monkeypatch.setattr(quality, "POSITIVE_ROWS", 50)
    monkeypatch.setattr(quality, "UNLABELLED_ROWS", 80)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda good, web: seen.append((len(good), len(web))))
    quality.train(frame, frame.select("doc_id"), F.lit(True))
    assert seen == [(50, 80)]


def test_scores_match_a_second_reading(spark):
    """The score of each document, from the model's numbers alone."""
    small = "/root/testdata/sf0.01"
    docs = table(spark, small, "documents").limit(200)
    model = quality.train(docs, table(spark, small, "labels").where("quality = 1"), F.lit(True))
    for r in quality.scored(docs, model, keep=["text"]).collect():
        z = model.bias
        for x, mean, spread, w in zip(quality.statistics(r["text"]).tolist(), model.mean.tolist(), model.spread.tolist(), model.weights.tolist(), strict=True):
            z += w * min(5.0, max(-5.0, (x - mean) / spread))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-3 and r["predicted"] == (r["score"] >= 0.5)
