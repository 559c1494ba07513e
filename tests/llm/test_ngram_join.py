"""Components of similar texts against a comparison of all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from tests.compare import difference, oracle_connection
from yieldstone.llm import ngram_join as nj
from yieldstone.llm.common import Scratch
from yieldstone.llm.components import connected
from yieldstone.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def run(spark, docs):
    frame = spark.createDataFrame([(d, t, "x", 0) for d, t in docs], "doc_id long, text string, node string, n int")
    return sorted((tuple(r) for r in nj.similar_components(frame).collect()), key=str)


def near_copies(rnd, base, count, share):
    for _ in range(count):
        words = base.split()
        for i in range(len(words)):
            if rnd.random() < share:
                words[i] = f"w{rnd.random()}"
        yield " ".join(words)


def test_query_matches_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    wanted = brute(docs)
    assert any(c != d for d, _, c in wanted)
    assert sorted((tuple(r) for r in QUERIES["op6_ngram_jaccard"](spark, FOLDER).collect()), key=str) == wanted


@pytest.mark.parametrize("frequent", [2, 4, 10_000])
def test_random_texts(spark, monkeypatch, frequent):
    """Groups of near copies, shared passages and short texts, whatever counts as frequent."""
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    rnd, texts = random.Random(frequent), []
    passage = " ".join(f"p{i}" for i in range(40))
    for length in (3, 5, 6, 7, 9, 14, 30, 60, 130, 300):
        base = " ".join(f"b{rnd.randrange(10**6)}" for _ in range(length))
        texts += [base, base.upper(), *near_copies(rnd, base, 9, 0.012), *near_copies(rnd, base, 4, 0.03)]
        texts += [base + " " + passage, passage + " " + base, " ".join(base.split()[: max(1, int(length * 0.85))])]
    docs = list(enumerate(rnd.sample(texts, len(texts))))
    assert run(spark, docs) == brute(docs)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 5000} v{i}" for i in range(20_000))
    docs = [(5, None), (4, ""), (3, " \n\t"), (2, "one"), (1, "One"), (9, "a b c d"), (8, "A b\nc  d"), (7, "a b c d e"), (7, "a b c d e"),
            (20, long), (21, long + " more"), (None, long + " other words"), (None, ""), (30, "a b c d e f"), (31, "a b c d e f")]
    assert run(spark, docs) == brute(docs)
    assert run(spark, []) == []


def places(tokens, often):
    rare, other, at = nj.index_entries(tokens, often)
    return dict(zip(other.tolist(), at.tolist(), strict=True)) | {t: i + 1 for i, t in enumerate(rare.tolist())}


def test_prefixes_always_meet():
    """Two similar sets share an entry at a place that both allow, whichever tokens are frequent."""
    rng = np.random.default_rng(1)
    for _ in range(3000):
        n = int(rng.integers(2, 90))
        both = int(np.ceil(0.8 * n))
        pool = np.unique(rng.integers(0, 2**64, 4 * n, dtype=np.uint64))
        rng.shuffle(pool)
        x = np.sort(pool[:n])
        extra = int(rng.integers(0, max(1, int((both / 0.8 - n)) + 1)))
        y = np.sort(np.concatenate([rng.choice(x, n - max(0, n - both), replace=False), pool[n : n + extra]]))
        inter = len(np.intersect1d(x, y))
        if 100 * inter < 80 * (len(x) + len(y) - inter):
            continue
        often = np.sort(pool[rng.random(len(pool)) < rng.choice([0, 0.3, 0.9, 1.0])])
        least = -(-4 * (len(x) + len(y)) // 9)
        a, b = (places(s, often) for s in (x, y))
        shared = [e for e in a.keys() & b.keys() if a[e] + least <= len(x) + 1 and b[e] + least <= len(y) + 1]
        assert shared or np.array_equal(x, y)


def test_sketches_never_refuse_a_link():
    rng = np.random.default_rng(2)
    for n in (2, 10, 100, 1000):
        for _ in range(50):
            x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            y = np.sort(np.concatenate([x[: int(len(x) * 0.9)], rng.integers(0, 2**64, n // 15, dtype=np.uint64)]))
            if nj._is_link(x.tobytes(), y.tobytes(), len(x), len(y)):
                assert nj._may_link(nj._sketch(x), nj._sketch(y), len(x), len(y))


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100), (7, 7)] + [(500, i) for i in range(501, 560)]
    rnd = random.Random(3)
    links = spark.createDataFrame([p if rnd.random() < 0.5 else p[::-1] for p in chain], "a long, b long")
    got = {r["node"]: r["component"] for r in connected(links, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100} | {i: 500 for i in range(500, 560)}
    assert connected(links.limit(0), Scratch(spark, "test")).count() == 0


def test_query_matches_sql(spark):
    assert difference(QUERIES["op6_ngram_jaccard"](spark, FOLDER), oracle_connection(FOLDER), ORACLE["op6_ngram_jaccard"]) is None
