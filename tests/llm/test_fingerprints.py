"""Fingerprints against the similarity they estimate."""

import re
from collections import Counter
from hashlib import sha256

import pytest

from yieldstone.llm import fingerprints as fp
from yieldstone.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def weights(text):
    return Counter(w for w in re.split("[\x20\x09-\x0d]+", text) if w)


def jaccard(a, b):
    a, b = weights(a), weights(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def brute(docs):
    """By (id, text): code points, edited text, next text. Equal rows are one document."""
    order = sorted({(i, t or "") for i, t in docs}, key=lambda p: (p[0] is not None, p[0] or 0))
    out = {}
    for k, (i, t) in enumerate(order):
        after, q = order[(k + 1) % len(order)][1], len(t) // 4
        out[i, t] = (len(t), t[: len(t) - q] + after[:q], after)
    return out


@pytest.fixture(scope="module")
def result(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    return docs, {r["doc_id"]: r for r in QUERIES["op7_weighted_fingerprints"](spark, FOLDER).collect()}


def test_edited_texts(result):
    docs, rows = result
    for (doc, _), (n, edited, _) in brute(docs).items():
        assert (rows[doc]["n_chars"], rows[doc]["edited_sha256"]) == (n, sha256(edited.encode()).hexdigest())


def test_likeness_estimates_generalised_jaccard(result):
    docs, rows = result
    errors, next_errors = [], []
    for (doc, text), (_, edited, after) in brute(docs).items():
        errors.append(rows[doc]["near_edited"] - jaccard(text, edited))
        next_errors.append(rows[doc]["near_next"] - jaccard(text, after))
    for e in (errors, next_errors):
        assert abs(sum(e) / len(e)) < 0.01
        assert (sum(x * x for x in e) / len(e)) ** 0.5 < 0.5 / fp.SAMPLES**0.5


def test_equal_texts_have_equal_fingerprints(result):
    docs, rows = result
    by_text = {}
    for doc, text in docs:
        by_text.setdefault(text, set()).add(rows[doc]["fingerprint"])
    assert len(by_text) < len(docs) and all(len(v) == 1 for v in by_text.values())
    assert all(len(r["fingerprint"]) == 8 * fp.SAMPLES for r in rows.values())


def test_general_fingerprints_are_the_same(spark, result):
    docs, rows = result
    some = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 50")
    for r in fp.fingerprints(some).collect():
        assert r["fingerprint"] == rows[r["doc_id"]]["fingerprint"]


def test_edge_cases(spark):
    long = "word " * 30_000 + "end"
    docs = [(None, "null id here"), (1, None), (2, ""), (3, "  \n"), (4, "one"), (5, "abcd"), (6, long), (7, "Größe ñ 🙂🙂 é"), (7, "Größe ñ 🙂🙂 é"), (9, "word")]
    frame = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, fingerprint string, rank int")
    got = fp.compared_with_next(frame).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == sorted((i or 0) for i, _ in docs)
    wanted = brute(docs)
    by_id = {i: v for (i, _), v in wanted.items()}
    for r in got:
        n, edited, _ = by_id[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    marks = {r["doc_id"]: r for r in got}
    assert marks[1]["fingerprint"] == marks[2]["fingerprint"] == marks[3]["fingerprint"] == "0" * 8 * fp.SAMPLES
    assert marks[1]["near_next"] == marks[2]["near_next"] == 1.0 and marks[3]["near_next"] == 0.0
    assert fp.compared_with_next(frame.limit(0)).count() == 0
    alone = fp.compared_with_next(frame.where("doc_id = 4")).first()
    assert alone["near_next"] == alone["near_edited"] == 1.0
