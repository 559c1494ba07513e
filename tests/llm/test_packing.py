"""Best fit, step by step, and whole results."""

import random
import re

import pytest

from yieldstone.llm import packing as pk
from yieldstone.llm.queries import QUERIES, SEQUENCE_TOKENS


def check(pieces, lengths, sources, clusters, capacity):
    """Every document whole; each piece in the tightest bin that takes it at that moment; no conflict, no overflow."""
    bins, placed = {}, {}
    for row, part, number, start, n in pieces:
        placed.setdefault(row, []).append((part, n))
        if number < 0:
            assert (start, n) == (0, capacity)
            continue
        fits = [
            b for b in bins.values()
            if b["left"] >= n and (sources[row] is None or sources[row] not in b["sources"]) and (clusters[row] is None or clusters[row] not in b["clusters"])
        ]
        if number in bins:
            assert bins[number] in fits and bins[number]["left"] == min(b["left"] for b in fits)
        else:
            assert not fits
            bins[number] = {"left": capacity, "sources": set(), "clusters": set()}
        own = bins[number]
        assert start == capacity - own["left"]
        own["left"] -= n
        own["sources"].add(sources[row])
        own["clusters"].add(clusters[row])
    for row, n in enumerate(lengths):
        assert sum(x for _, x in placed[row]) == n and sorted(p for p, _ in placed[row]) == list(range(len(placed[row])))


def test_tightest_compatible_bin():
    rnd = random.Random(1)
    for _ in range(300):
        n, capacity = rnd.randint(0, 60), rnd.choice([1, 10, 64, 100])
        lengths = [rnd.randint(0, int(capacity * 2.5)) for _ in range(n)]
        sources = [rnd.choice([None, 0, 0, 1, 2, 3]) for _ in range(n)]
        clusters = [rnd.choice([None, *range(8)]) for _ in range(n)]
        check(pk.pack_group(lengths, sources, clusters, capacity), lengths, sources, clusters, capacity)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op3_best_fit_packing"](spark, folder).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    total, bins = {}, {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
        bins.setdefault(r["bin"], []).append(r)
    assert total == {i: len(re.findall("[^\x20\x09-\x0d]+", d["text"])) + 1 for i, d in docs.items()}
    for own in bins.values():
        assert sum(r["n_tokens"] for r in own) <= SEQUENCE_TOKENS
        sources = [docs[r["doc_id"]]["source"] for r in own]
        texts = [docs[r["doc_id"]]["text"] for r in own]
        assert len(set(sources)) == len(sources) and len(set(texts)) == len(texts)
        at = 0
        for r in sorted(own, key=lambda r: (r["bin_start"], r["n_tokens"])):
            assert r["bin_start"] == at
            at += r["n_tokens"]


@pytest.mark.parametrize("group", [3, 1000])
def test_edge_cases(spark, monkeypatch, group):
    monkeypatch.setattr(pk, "ROWS_PER_GROUP", group)
    rows = [(1, "a b c", "s", 1), (1, "a b c", "s", 1), (2, None, None, None), (3, "", "t", None), (None, "x y", "u", 4), (5, "w " * 5000, "v", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, bin long")
    out = pk.pack(frame, 100, "doc_id", pk.word_count(frame["text"]), frame["source"], frame["bin"]).collect()
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert total == {1: 8, 2: 1, 3: 1, None: 3, 5: 5001}
    assert len({r["bin"] for r in out if r["doc_id"] == 1}) == 2
    assert pk.pack(frame.limit(0), 100, "doc_id", pk.word_count(frame["text"]), frame["source"], frame["bin"]).count() == 0
