"""Phrases against a plain search of word lists, expressions against a recursive reading of the same grammar."""

import random
import re

from tests.compare import oracle_connection
from yieldstone.llm import licenses as lic
from yieldstone.llm.queries import QUERIES

NAME = "op11_license_scans"
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def places(text, phrases):
    w = words(text)
    return sorted((i, p) for p in phrases for i in range(len(w)) if w[i : i + len(p.split())] == p.split())


def test_base_columns_match_sql(spark):
    """DuckDB counts phrases in words that are joined by blanks, one of them doubled so that matches may share one."""
    folder = "/root/testdata/sf0.01"
    con = oracle_connection(folder)
    word = r"[0-9a-z\x{80}-\x{10FFFF}]+"
    con.execute(f"""CREATE TABLE found AS SELECT doc_id, len(w) AS n, p, i FROM (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS w FROM documents) d,
        (VALUES ('under the mit license'), ('apache license version 2'), ('cc by nc')) v(p), unnest(range(len(w))) u(i)
        WHERE w[i + 1] = split_part(p, ' ', 1) AND array_to_string(w[i + 1 : i + len(string_split(p, ' '))], ' ') = p""")
    want = {r[0]: r[1:] for r in con.execute("SELECT doc_id, count(*), min(i), max(i) FROM found GROUP BY doc_id").fetchall()}
    rows = QUERIES[NAME](spark, folder).collect()
    assert {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"]) for r in rows if r["n_base"]} == want and want
    assert all(r["first_word"] is None and r["base_labels"] == "" for r in rows if not r["n_base"])
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in rows)


def test_random_texts(spark):
    rnd = random.Random(4)
    scan = lic.Scanner(lic.BASE_PHRASES + lic.NOTICE_PHRASES)
    pieces = ["under", "the", "MIT", "License", "Apache", "license", "version", "2", "CC", "BY", "nc", "sa", "gnu", "general", "public", "all", "rights", "reserved", "é", "x9"]
    own = {p.words: p for p in lic.BASE_PHRASES + lic.NOTICE_PHRASES}
    for _ in range(400):
        text = "".join(rnd.choice(pieces) + rnd.choice([" ", "-", ", ", "\n", "\x00", "_"]) for _ in range(rnd.randint(0, 60)))
        n, found = scan(text.encode())
        assert n == len(words(text))
        assert sorted((f["word"], f["said"]) for f in found if f["kind"] != "tag") == places(text, own)


def read(tokens):
    """(labels, freedom) by recursive descent, None for what isn't an expression."""
    at = 0

    def name():
        nonlocal at
        if at < len(tokens) and tokens[at] == "(":
            at += 1
            inner = chain("or")
            if inner is None or at >= len(tokens) or tokens[at] != ")":
                return None
            at += 1
            return inner
        if at >= len(tokens) or not lic.licence(tokens[at]) or tokens[at] in lic.BINDS:
            return None
        label, value = lic.licence(tokens[at])
        at += 1
        if at + 1 < len(tokens) and tokens[at] == "with" and tokens[at + 1] in lic.EXCEPTIONS:
            label, value = f"{label}-with-{tokens[at + 1]}", (1 + value) / 2
            at += 2
        return [label], value

    def chain(operator):
        nonlocal at
        got = name() if operator == "and" else chain("and")
        while got is not None and at < len(tokens) and tokens[at] == operator:
            at += 1
            more = name() if operator == "and" else chain("and")
            if more is None:
                return None
            got = got[0] + more[0], (min if operator == "and" else max)(got[1], more[1])
        return got

    got = chain("or")
    return got if at == len(tokens) else None


def test_random_expressions():
    rnd = random.Random(9)
    pool = ["(", ")", "and", "or", "with", "mit", "gpl-2.0-only", "lgpl-2.1+", "classpath-exception-2.0", "apache-2.0", "nobody-1.0", "cc-by-nc-4.0"]
    seen = 0
    for _ in range(3000):
        tokens = []
        for _ in range(rnd.randint(1, 5)):  # nearly an expression
            tokens += ["("] * (rnd.random() < 0.3) + [rnd.choice(pool[5:])] + pool[4:9:4] * (rnd.random() < 0.2)
            tokens += [")"] * (rnd.random() < 0.3) + [rnd.choice(["and", "or"])]
        tokens = tokens[: rnd.choice([-1, len(tokens)])]
        if rnd.random() < 0.3 and tokens:
            tokens[rnd.randrange(len(tokens))] = rnd.choice(pool)
        best, end = lic.read_expression((t, i + 1) for i, t in enumerate(tokens))
        whole = [k for k in range(1, len(tokens) + 1) if read(tokens[:k]) is not None]
        # the reading stops at the first token that fits no longer
        assert end == len(best) == (whole[-1] if whole else 0), tokens
        if best:
            seen += len(best) > 4
            assert lic.evaluate(lic.postfix(best)) == read(best)
    assert seen > 100


def test_tags():
    scan = lic.Scanner(lic.BASE_PHRASES)

    def labels(text):
        return [(f["kind"], f["labels"], f["freedom"]) for f in scan(text.encode())[1]]

    assert labels("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) */") == [("tag", ["mit", "gpl-2.0-only"], 1.0)]
    assert labels("SPDX-License-Identifier: MIT AND GPL-2.0 WITH Classpath-exception-2.0") == [("tag", ["mit", "gpl-2.0-with-classpath-exception-2.0"], 0.65)]
    assert labels("SPDX-License-Identifier: Nobody-1.0") == [("tag", ["unknown"], 0.0)]
    assert labels("SPDX-License-Identifier: LicenseRef-mine") == [("tag", ["licenseref-mine"], 0.0)]
    assert labels('license = "Apache-2.0"\nLicense: whatever') == [("tag", ["apache-2"], 1.0)]
    assert labels("License-Expression: MIT and more. under the MIT license") == [("tag", ["mit"], 1.0), ("base", ["mit"], 1.0)]
    assert labels("spdx license identifier: MIT") == [] and labels("SPDX-License-Identifier") == []


def test_odd_tables(spark):
    long = "word " * 200_000 + "cc by nc"
    rows = [(1, None, 1), (2, "", 1), (3, "CC-BY-NC cc by nc by nc", 1), (3, "CC-BY-NC cc by nc by nc", 1), (4, long, 1), (None, "Under the MIT License", 1)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, findings int")
    got = [(r["doc_id"], r["n_words"], [(f["word"], f["said"]) for f in r["findings"]]) for r in lic.scan_licences(frame).collect()]
    twice = (3, 8, [(0, "cc by nc"), (3, "cc by nc")])
    want = [(1, 0, []), (2, 0, []), twice, twice, (4, 200_003, [(200_000, "cc by nc")]), (None, 4, [(0, "under the mit license")])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert lic.scan_licences(frame.limit(0)).count() == 0
