"""The Hilbert curve, the shards cut from it, and what pruning gains."""

from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.compare import difference, oracle_connection
from yieldstone.llm import sharding as sh
from yieldstone.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("columns", "bits"), [(2, 3), (3, 2), (3, 4), (4, 2)])
def test_curve_visits_every_cell_in_single_steps(columns, bits):
    at = {sh.hilbert_index(c, bits): c for c in product(range(1 << bits), repeat=columns)}
    assert sorted(at) == list(range(1 << (bits * columns)))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1], strict=True)) == 1 for i in range(len(at) - 1))


def test_query(spark):
    rows = QUERIES["op9_hilbert_shards"](spark, FOLDER).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    import zlib

    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all((r["size"], r["text_crc32"]) == (len(docs[r["doc_id"]].encode()) + 1, zlib.crc32(docs[r["doc_id"]].encode())) for r in rows)
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order) and {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_pruning_beats_hashing(spark):
    """Ranges of both columns overlap less than those of shards by hash."""
    frame = spark.range(4000).selectExpr("id", "pmod(xxhash64(id, 1), 1000) AS x", "pmod(xxhash64(id, 2), 1000) AS y")
    by_curve = sh.shard_ranges(sh.shard_rows(frame, ["x", "y"], ["id"], 16), ["x", "y"]).collect()
    areas = [(r["max_x"] - r["min_x"]) * (r["max_y"] - r["min_y"]) for r in by_curve]
    assert len(areas) == 16 and sum(areas) < 0.2 * 16 * 999 * 999


def test_edge_cases(spark, tmp_path):
    rows = [(1, "a", None), (2, None, 5), (2, None, 5), (None, None, None), (5, "b" * 100_000, 7), (6, "", 1)]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, size long, shard int")
    got = sh.shard_rows(frame, ["source", "size"], ["doc_id"], 4).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0), (2, 1), (3, 0)]
    assert sh.shard_rows(frame.limit(0), ["source", "size"], ["doc_id"], 4).count() == 0
    sh.write_shards(sh.shard_rows(frame, ["source", "size"], ["doc_id"], 4), str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4
    with pytest.raises(ValueError):
        sh.curve_position(frame, ["source", "size", "doc_id", "shard"], 5)


def test_ranks_are_gapless_over_many_partitions(spark):
    from yieldstone.llm.common import Scratch

    frame = spark.range(10_000).selectExpr("id", "IF(id % 3 = 0, 7, id % 11) AS k")
    got, total = sh.ranked(frame, ["k", "id"], Scratch(spark, "test"))
    rows = got.orderBy("rank").collect()
    assert total == 10_000 and [r["rank"] for r in rows] == list(range(10_000))
    assert [(r["k"], r["id"]) for r in rows] == sorted((r["k"], r["id"]) for r in rows)
    assert got.select(F.max("rank")).first()[0] == 9999


def test_curve_matches_a_plain_reading(spark):
    """Cuts by sorting all values, cells by counting the cuts reached, places by following the curve; a long common prefix."""
    prefix = "https://common-crawl.example.org/"  # over thirty bytes that all sources share
    rows = [(i, None if i % 50 == 7 else f"{prefix}{'hot' if i % 3 == 0 else i * 37 % 41:>4}", i * i % 997) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = {r["doc_id"]: r["curve"] for r in sh.curve_position(frame, ["source", "size"]).collect()}

    def cuts(values):
        values = sorted(v for v in values if v is not None)
        return sorted({values[len(values) * k // 16] for k in range(1, 16)})

    source_cuts = cuts([s for _, s, _ in rows])
    sources = {i: sum(s is not None and s >= c for c in source_cuts) for i, s, _ in rows}
    assert len(set(sources.values())) > 9 and len(source_cuts) > 9
    order = {sh.hilbert_index([x, y], 4): (x, y) for x in range(16) for y in range(16)}
    assert {i: order[c][0] for i, c in got.items()} == sources
    size_cells = [[order[got[i]][1] for i, _, n in sorted(rows, key=lambda r: r[2])]]
    assert size_cells[0] == sorted(size_cells[0]) and len(set(size_cells[0])) == 16
    steps = [order[k] for k in range(256)]
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(steps, steps[1:], strict=False))


def test_string_cuts_of_odd_columns(spark):
    frame = spark.createDataFrame([(None,), ("é",), ("e",), ("",)] + [("hot",)] * 50, "s string")
    assert sh.string_cuts(frame, "s", 4) == ["hot"]
    assert sh.string_cuts(frame.where("s IS NULL"), "s", 4) == [] == sh.string_cuts(frame.limit(0), "s", 4)


def test_query_matches_sql(spark):
    """Every row's cell, place on the curve, shard and slot."""
    assert difference(QUERIES["op9_hilbert_shards"](spark, FOLDER), oracle_connection(FOLDER), ORACLE["op9_hilbert_shards"]) is None


def test_sql_with_nulls_ties_and_shared_beginnings(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else "t" * (i % 5) + "é" * (i % 3), None if i % 5 == 0 else ("de", "en")[i % 2],
             None if i % 11 == 0 else f"https://one.and.the.same.host/{i % 23:02d}") for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(QUERIES["op9_hilbert_shards"](spark, str(tmp_path)), con, ORACLE["op9_hilbert_shards"]) is None
