"""Weights by bit planes against plain sums, and the draw against SQL and a plain sort."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from tests.compare import difference, oracle_connection
from yieldstone.llm import resampling
from yieldstone.llm.queries import ORACLE, QUERIES

NAME = "op13_importance_resampling"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def buckets(text):
    w = words(text)
    return Counter(zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)])


def plain(docs, target):
    """doc_id, n_features, weight, score, rank of (doc_id, text) by the definition."""
    counted = [buckets(t) for _, t in docs]
    s, t = sum(counted, Counter()), sum((buckets(x) for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for (ident, text), own in zip(docs, counted, strict=True):
        n = sum(own.values())
        weight = sum(gain[b] * k for b, k in own.items()) // n if n else 0
        h = int(sha256(f"7:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        rows.append([ident, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    drawn = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): i + 1 for i, r in enumerate(drawn[: 25 * len(drawn) // 100])}
    return sorted((tuple(r[:4]) + (rank.get(id(r)),) for r in rows), key=repr)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, folder):
    path = f"/root/testdata/{folder}"
    assert difference(QUERIES[NAME](spark, path), oracle_connection(path), ORACLE[NAME]) is None


def test_odd_tables(spark):
    """Nulls, empty and long texts, words of all lengths, repeated rows, one id on many rows, columns named like results."""
    long = " ".join(f"word{i % 977}" for i in range(60_000)) + " " + "x" * 5000
    docs = [(1, None), (2, ""), (3, "!?"), (4, long), (5, "Ünïcode ÄÖ and the rest of it " * 5), (None, "no id here " * 9), (None, "no id here " * 9)]
    docs += [(i, f"some words of document {i} that go on for a while and then some more of them until there are twenty {i}") for i in range(10, 90)]
    docs += [(77, "the same id and the same text over and over again so that it takes up much of the whole table of texts")] * 60
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, weight int, rank string")
    target = ["words of document", None, "the rest of it", "Ünïcode"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resampled(frame, bench)
    rows = sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert rows == plain(docs, target)
    kept = resampling.resampled(frame, bench, keep=["text", "weight", "rank"]).where("rank = 1").first()
    assert kept["kept"]["weight"] == 1 and kept["kept"]["rank"] == "x" and kept["kept"]["text"]
    assert resampling.resampled(frame.limit(0), bench).count() == 0
    none = resampling.resampled(frame, bench.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in none), key=repr) == plain(docs, [])


def test_bit_planes_sum_exactly():
    rng = np.random.default_rng(5)
    gain = rng.integers(-12_000, 12_000, 10_000)
    counts = rng.integers(0, 4, (9, 10_000)) * rng.integers(0, 2, (9, 10_000))
    counts[0] *= 1_000_003
    counts[1] = 0
    assert (resampling.Weigher(gain.tolist())(counts) == counts @ gain).all()


def test_features_across_edges():
    texts = [b"a b", None, b"", b"B--c", b"z" * 500 + b" a", "é é".encode()]
    row, bucket, n = resampling.features(texts)
    want = [(i, b) for i, t in enumerate(texts) for b, k in buckets((t or b"").decode()).items() for _ in range(k)]
    assert sorted(zip(row.tolist(), bucket.tolist(), strict=True)) == sorted(want) and n.tolist() == [2, 0, 0, 2, 2, 2]
