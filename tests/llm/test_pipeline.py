"""Each stage against a plain version of what it decides, and the whole run."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_ngram_join import brute as components
from yieldstone.llm import pii
from yieldstone.llm.queries import PII_KEY, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out[name] = (before, docs)
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        assert name == "packing" or after.dtypes == before.dtypes


def test_toxic_go_and_the_rest_stays(stages, spark):
    before, after = (rows(x) for x in stages["toxicity"])
    said = {r["doc_id"] for r in QUERIES["op1_toxicity_chain"](spark, FOLDER).where("toxic").collect()}
    assert said and set(after) == set(before) - said


def test_one_of_each_component(stages):
    before, after = (rows(x) for x in stages["ngram_join"])
    assert set(after) == {d for d, _, c in components(list(before.items())) if d == c} != set(before)


def test_contaminated_go(stages, spark):
    before, after = (rows(x) for x in stages["decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(after) == {r[0] for r in contaminated(list(before.items()), items) if not r[5]} != set(before)


def test_pseudonyms(stages):
    before, after = (rows(x) for x in stages["pii"])
    f = pii.Feistel(PII_KEY)
    assert after == {d: pii.replace_pii(t, f)[0] for d, t in before.items()} != before
    assert all(r["n_chars"] == len(r["text"]) for r in stages["pii"][1].collect())


def test_packing_takes_all(stages, spark):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after.collect()} == set(rows(before))
    run = entry.queries()["pipeline"](spark, FOLDER)
    assert {r["doc_id"] for r in run.collect()} == set(rows(before))


def test_stages_take_odd_tables(spark, tmp_path):
    text = "one two three four five six seven"
    docs = [(1, None), (2, ""), (3, text), (3, text), (4, text.upper()), (5, "w " * 30_000), (None, "null id")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, p_toxic string"
    frame = spark.createDataFrame([(i, t, None, None, 0, "x") for i, t in docs], kind)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in cp.STAGES:
        kept = stage(spark, frame, str(tmp_path)).collect()
        assert name == "packing" or {r["p_toxic"] for r in kept} == {"x"}  # the caller's column, not the model's
        ids = sorted((r["doc_id"] for r in kept), key=str)
        wanted = [1, 2, 3, 5, None] if name == "ngram_join" else [1, 2, 3, 3, 4, 5, None]
        assert sorted(set(ids), key=str) == sorted(set(wanted), key=str) and (name == "packing" or len(ids) == len(wanted))
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0


def test_rows_are_judged_by_their_own_text(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 100").first()["text"]
    clean = [f"{w} text that has nothing of it" for w in ("first", "second", "third")]
    docs = [(1, clean[0]), (1, f"x {item} y"), (1, clean[1]), (1, clean[1]), (None, f"z {item}"), (None, clean[2]), (None, None), (None, ""), (2, item)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(i, t, None, None, 0) for i, t in docs], kind)
    kept = cp.without_benchmarks(spark, frame, FOLDER).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(((i, t) for i, t in docs if not t or item not in t), key=str)

    words = [" ".join(f"{p}{i}" for i in range(60)) for p in "abcdef"]
    near = [w + " more" for w in words]  # similar to one text each
    docs = [(5, words[0]), (5, near[0]), (4, near[0]), (5, words[1]), (None, words[1]), (None, near[1]), (None, words[2]), (None, near[2]),
            (5, words[3]), (5, words[3]), (5, None), (5, ""), (None, None), (6, words[4]), (7, words[4]), (7, words[5])]
    frame = spark.createDataFrame([(i, t, None, None, 0) for i, t in docs], kind)
    kept = sorted(((r["doc_id"], r["text"]) for r in cp.one_of_similar(spark, frame, FOLDER).collect()), key=str)
    some = [(i, t) for i, t in kept if i is None and t]
    assert len(some) == 1 and some[0][1] in (words[2], near[2])
    assert [r for r in kept if r not in some] == sorted([(4, near[0]), (5, words[1]), (5, words[3]), (5, None), (5, ""), (None, None), (6, words[4]), (7, words[5])], key=str)
