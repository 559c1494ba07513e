"""The positional index against a scan of every word."""

import re

import duckdb
from pyspark.sql import types as T

from tests.compare import difference, oracle_connection
from yieldstone.llm import decontamination as dec
from yieldstone.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, item_id string, row long"


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        yield doc, len(w), len(hit), len(found), dec.items_digest(found), bool(hit)


def rows(df):
    return sorted(tuple(r)[:6] for r in df.collect())


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()
    wanted = sorted(brute(docs, items))
    assert any(r[5] for r in wanted)
    assert rows(QUERIES["op8_benchmark_decontamination"](spark, FOLDER)) == wanted


def small(spark, docs, items):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id long")
    return dec.decontaminate(frame, bench)


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(dec, "SEGMENT_WORDS", 50)
    ten = "a b c d e f g h i j"
    docs = [(1, None), (2, ""), (3, ten.upper()), (4, f"x {ten} k {ten}"), (4, f"x {ten} k {ten}"), (5, "a b c d e"), (6, "f g h i j"),
            (7, "short item"), (8, "x " * 3000 + "Short, ITEM"), (9, "é ñandú é"), (None, ten)]
    items = [(1, ten + " k"), (2, "short item"), (3, None), (4, ""), (5, "é Ñandú"), (6, "é ñandú"), (10, "item"), (1, ten + " k")]
    got = small(spark, docs, items)
    assert sorted(tuple(r)[1:6] for r in got.collect()) == sorted(r[1:] for r in brute(docs, items))
    assert small(spark, [], items).count() == 0
    assert {tuple(r)[2:] for r in small(spark, docs, []).collect()} == {(0, 0, dec.items_digest([]), False, 0)}


def test_item_blocks_add_up(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(dec.item_blocks(bench, "item_id", "text", 1000))) > 1
    monkeypatch.setattr(dec.item_blocks, "__defaults__", (1000,))
    assert rows(small(spark, docs, items)) == sorted(brute(docs, items))


def test_proximity_is_found_in_any_order(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, "q b a x c e d f g x h j i q"), (2, "a b c d e f g h i " + "x " * 20 + "j"), (3, ten)]
    got = {r["doc_id"]: (r["n_near_items"], r["contaminated"]) for r in small(spark, docs, [(1, ten)]).collect()}
    assert got == {1: (1, False), 2: (0, False), 3: (0, True)}


def brute_near(docs, items, window=10, near=15):
    """Items that are matched by proximity only, counted in every stretch of every document."""
    for doc, text in docs:
        w, found = words(text), set()
        stretches = [set(w[i : i + near]) for i in range(len(w))]
        for item, body in items:
            b = words(body)
            parts = [b[i : i + window] for i in range(max(1, len(b) - window + 1) if b else 0)]
            if any(set(p) <= s for p in parts for s in stretches) and not any(w[i : i + len(p)] == p for p in parts for i in range(len(w))):
                found.add(item)
        yield doc, len(found)


def test_proximity_keeps_to_its_document(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, "j i h g f e d c b a"), (2, "x x a b c d e"), (3, "f g h i j x x"), (4, "a x x a b c d e f g h j i"), (5, ""),
            (6, "two words"), (7, "words two"), (8, "words"), (9, "two"), (10, "j i h g f e d c b a " + "x " * 40), (11, "words " + "x " * 13 + "two"),
            (12, "words " + "x " * 14 + "two"), (13, "b a c d e f g h i " + "x " * 5 + "j i")]
    items = [(1, ten), (2, "two words"), (3, "words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = sorted(brute_near(docs, items))
    assert dict(wanted)[1] == dict(wanted)[4] == dict(wanted)[7] == 1 and dict(wanted)[2] == dict(wanted)[3] == dict(wanted)[12] == 0
    for order in (docs, docs[::-1]):
        frame = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)  # all in one segment
        assert sorted((r["doc_id"], r["n_near_items"]) for r in dec.decontaminate(frame, bench).collect()) == wanted
    spans = dec.find_matches(dec.build_index(frame), dec.items_of(items[:2]), "bigint").where("kind = 'near'").collect()
    at = {len(docs) - r["row"]["place"]: (r["low"], r["high"]) for r in spans}
    assert at[1] == at[10] == (0, 10) and at[4] == (3, 13) and at[7] == (0, 2) and at[11] == (0, 15) and at[13] == (0, 15)


def test_items_without_an_id_are_looked_up(spark):
    docs = [(1, "x a b c"), (2, "d e f"), (3, "a b c d e f known"), (4, "c b a"), (5, "a b c, c x b a"), (6, "none")]
    items = [(None, "a b c"), (None, "d e f"), (None, None), (9, "known")]
    got = {r["doc_id"]: tuple(r)[1:] for r in small(spark, docs, items).collect()}
    none, known = dec.items_digest([]), dec.items_digest([9])
    assert got == {1: (4, 3, 1, none, True, 0), 2: (3, 3, 1, none, True, 0), 3: (7, 7, 2, known, True, 0), 4: (3, 0, 0, none, False, 1),
                   5: (7, 3, 1, none, True, 0), 6: (1, 0, 0, none, False, 0)}


def test_result_types(spark):
    shape = small(spark, [(1, "a")], [(1, "a")]).schema
    assert shape["n_words"].dataType == T.LongType() and shape["contaminated"].dataType == T.BooleanType()


def test_high_task_numbers_and_many_wordless_rows(spark, monkeypatch):
    """Rows of task 40,000 and on keep their own numbers, and segments close by rows as well."""
    from pyspark.sql import functions as F

    from yieldstone.llm import decontamination as dec

    monkeypatch.setattr(dec, "SEGMENT_ROWS", 3)
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(i, "" if i % 3 else text) for i in range(30)], "doc_id long, text string").coalesce(2)
    index = dec.build_index(docs).withColumn("segment", F.col("segment") + F.lit(40_000 << 24)).persist()
    assert index.where("bucket < 0").count() >= 10
    found = dec.find_matches(index, dec.items_of([(1, text)]), "bigint", 10, None)
    hit = dec.index_documents(index).join(found, "row").select("doc_id").distinct().collect()
    assert sorted(r["doc_id"] for r in hit) == list(range(0, 30, 3))
    assert dec.index_documents(index).select("row").distinct().count() == 30
    index.unpersist()


def test_items_of_any_type_and_repeated_rows(spark):
    from yieldstone.llm import decontamination as dec

    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, "x " + text), (2, "x")], "doc_id long, text string")
    for kind in ("smallint", "decimal(9,0)", "string", "int"):
        bench = spark.createDataFrame([("7", text)] * 50 + [("8", "y")], "item_id string, text string").selectExpr(f"cast(item_id AS {kind}) AS item_id", "text")
        rows = {r["doc_id"]: r for r in dec.decontaminate(docs, bench).collect()}
        assert (rows[1]["n_hit"], rows[1]["n_items"], rows[1]["items_sha256"]) == (11, 1, dec.items_digest(["7"])) and rows[2]["n_hit"] == 0


def test_query_matches_sql(spark):
    name = "op8_benchmark_decontamination"
    assert difference(QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), ORACLE[name]) is None


def test_sql_finds_planted_matches(spark, tmp_path):
    """Phrases, proximity matches and short items beside each other: the operator and its SQL agree."""
    items = ["one two three four five six seven eight nine ten eleven", "red green blue", "alpha beta gamma delta epsilon zeta eta theta iota kappa"]
    docs = ["x one two three four five six seven eight nine ten y", "ten nine x eight seven six y five four three two one", "blue z GREEN, red",
            "red green blue", "kappa iota theta eta zeta epsilon delta gamma beta w w w w alpha", "kappa iota theta eta zeta epsilon delta gamma beta w w w w w w alpha",
            None, "", "red " * 40, "ten " + "x " * 20 + items[0].upper()]
    for name, ident, texts in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        spark.createDataFrame(list(enumerate(texts)), f"{ident} long, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    name = "op8_benchmark_decontamination"
    got = QUERIES[name](spark, str(tmp_path))
    assert difference(got, con, ORACLE[name]) is None
    assert [r["n_near_items"] for r in got.orderBy("doc_id").collect()] == [0, 1, 1, 0, 1, 0, 0, 0, 0, 0]
