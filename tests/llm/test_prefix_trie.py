"""The trie against SQL and against a plain dictionary of prefixes, with slices so small that peeling takes several turns."""

import random
from collections import defaultdict
from hashlib import md5, sha256

import pytest
from pyspark.sql import functions as F

from tests.compare import difference, oracle_connection
from yieldstone.llm import prefix_trie as trie
from yieldstone.llm.queries import ORACLE, QUERIES

NAME = "op12_conversation_prefix_trie"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(conversations):
    """Rows of the trie of (conv_id, [(text, chars)])."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations:
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * (path[-1][1] if path else 0)
        below[path] = (own + sum(below[c][0] for c in children[path]), sum(below[c][1] for c in children[path]) or 1)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), below[p][1], below[p][0], sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def frame(spark, conversations):
    rows = [(c, [(md5(text.encode()).hexdigest(), chars) for text, chars in turns]) for c, turns in conversations]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<digest: string, chars: long>>")


def same(spark, conversations, **options):
    got = [tuple(r) for r in trie.prefix_trie(frame(spark, conversations), **options).select(*COLUMNS).collect()]
    by = lambda r: (r[1], r[0], r[7])
    assert sorted(got, key=by) == sorted(plain(conversations), key=by)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, folder):
    path = f"/root/testdata/{folder}"
    assert difference(QUERIES[NAME](spark, path), oracle_connection(path), ORACLE[NAME]) is None


def test_odd_turns_match_sql(spark, tmp_path):
    """Null turns, roles and texts, tied and repeated turns, families without a first conversation, columns that aren't read."""
    rnd = random.Random(3)
    rows = [
        (c, rnd.choice([None, 0, 1, 2, 3]), rnd.choice(["user", "assistant", None]), rnd.choice([None, "", "é🙂", "yes", "no"]), 1)
        for c in (0, 1, 2, 7, 99, 100, 101, 150, 205, 206, 207, 208, 209, 210) for _ in range(rnd.randint(1, 9))
    ]
    rows += rows[:10] + [(None, 0, "user", "lost", 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int").coalesce(1).write.parquet(str(tmp_path / "made"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/made/*.parquet')")
    (tmp_path / "in").mkdir()
    (tmp_path / "made").rename(tmp_path / "in" / "conversations.parquet")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/in/conversations.parquet/*.parquet')")
    assert difference(QUERIES[NAME](spark, str(tmp_path / "in")), con, ORACLE[NAME]) is None


@pytest.mark.parametrize("seed", [1, 2])
def test_small_slices_match_a_dictionary(spark, seed):
    """Few different turns, so that nodes near the root go through most slices; several levels of peeling."""
    rnd = random.Random(seed)
    made = [(c, [(f"t{k}", k) for k in (rnd.choice([0, 0, 0, 1, 2]) for _ in range(rnd.randint(0, 6)))]) for c in range(700)]
    same(spark, made, slice_turns=40)


def test_copies_chains_and_long_conversations(spark):
    long = [(f"l{i % 7}", 3) for i in range(600)]
    made = [(c, [("hello", 5), ("there", 5)]) for c in range(300)]  # copies over many slices, one node's ends in all of them
    made += [(1000 + k, long[:k]) for k in range(0, 600, 40)] + [(5000, [*long, ("end", 1)]), (5001, long)]
    made += [(7, [("hello", 5)]), (7, [("hello", 5)]), (8, [])]  # ids that occur again
    same(spark, made, slice_turns=100)
    same(spark, made)


def test_few_and_no_conversations(spark):
    same(spark, [(4, [])])
    same(spark, [(4, [("a", 1)])])
    empty = frame(spark, [(1, [])]).limit(0)
    assert trie.prefix_trie(empty).collect() == [] and trie.prefix_trie(empty).columns == COLUMNS
    turns = spark.createDataFrame([(None, 0, "user", "x"), (1, 0, None, None)], "conv_id int, turn int, role string, text string")
    rows = trie.conversations_of(turns).collect()
    assert [(r["conv_id"], len(r["turns"]), r["turns"][0]["chars"]) for r in rows] == [(1, 1, 0)]
    assert trie.conversations_of(turns).select(F.size("turns").alias("n")).first()["n"] == 1
