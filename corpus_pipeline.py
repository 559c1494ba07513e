"""The corpus pipeline: its stages in order, each on all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldstone.llm import decontamination, ngram_join, pii
from yieldstone.llm.common import Scratch, table
from yieldstone.llm.queries import PII_KEY, pack_documents, with_toxicity

#: What probabilities are named by, so that no column of the documents is in their way.
JUDGED = "__judged_"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain gives a probability below one half of being toxic, or none at all.

    Each row is judged by its own text, null and empty texts as texts without marks, texts of any length whole; repeated rows
    share their fate, an empty table stays empty. All columns come back as they were, whatever their names.
    """
    judged = with_toxicity(spark, docs, sf_dir, prefix=JUDGED)
    return judged.where(F.coalesce(f"{JUDGED}toxic", F.lit(0.0)) < 0.5).select(*docs.columns)


def _row_key(docs: DataFrame) -> Column:
    """A digest of id and text, which may be null, so that rows are told apart whatever their ids are."""
    text = F.coalesce(F.md5(docs["text"]), F.lit(""))
    ident = F.coalesce(F.concat(F.lit("="), docs["doc_id"].cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(text, ident)))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts one row: that with the smallest id, of these that with the smallest digest.

    Null ids come last. Each row belongs to the component of its own text, also if other rows share its id.
    """
    no_id = F.when(docs["doc_id"].isNull(), F.lit(1))  # in the order of structs nulls are first
    rows = docs.select(F.struct(no_id.alias("no_id"), "doc_id", _row_key(docs).alias("key")).alias("row"), "text")
    least = ngram_join.similar_components(rows, ident="row").where("row <=> component_id")
    kept = Scratch(spark, "pipeline").keep(least.groupBy("row.key").agg(F.count(F.lit(1)).alias("rows")), "kept")
    once = _with_keys(docs, kept.where("rows = 1"), "left_semi")
    again = kept.where("rows > 1")
    if again.isEmpty():
        return once
    return once.unionByName(_with_keys(docs, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def _with_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    return docs.join(keys, _row_key(docs) == keys["key"], how)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item, each row judged by its own text."""
    rows = docs.select(_row_key(docs).alias("key"), "text")
    judged = decontamination.decontaminate(rows, table(spark, sf_dir, "benchmark"), ident="key", near=None)
    return _with_keys(docs, judged.where("contaminated").select("key").distinct(), "left_anti")


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced and ``n_chars`` counted anew.

    A null text stays null, as does its count; repeated rows all stay and equal values get equal pseudonyms in all of them;
    texts of any length are read whole; an empty table stays empty; other columns come back as they were.
    """
    return pii.pseudonymise(docs, PII_KEY, result="__pii").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes in the training sequences.

    Every row gets a place, null and empty texts as an end mark alone and repeated rows each their own; a text longer than a
    sequence is cut over several; an empty table gives no rows; columns beyond id, text and source aren't read.
    """
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_join", one_of_similar),
    ("decontamination", without_benchmarks),
    ("pii", with_pseudonyms),
    ("packing", packed),
]

#: The trained model, the links between texts and the packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
