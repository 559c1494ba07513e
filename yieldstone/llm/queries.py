"""One query for each operator over the test tables, and the SQL that expresses it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, fingerprints, licenses, ngram_join, packing, pii, prefix_trie, quality, resampling, sharding
from . import toxicity, url_filter
from .common import Scratch, table, whole_text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


#: The order of the chain: the categories that the labels have, the one that is asked for last.
TOXICITY_CHAIN = ("low_quality", "toxic")


def with_toxicity(spark: SparkSession, docs: DataFrame, folder: str, prefix: str = "p_") -> DataFrame:
    """``docs`` with p_low_quality and p_toxic from a chain fitted on labelled documents of the table itself."""
    labels = table(spark, folder, "labels").withColumn("low_quality", 1 - F.col("quality"))
    chain = toxicity.train(table(spark, folder, "documents"), labels, TOXICITY_CHAIN)
    return toxicity.classified(docs, chain, TOXICITY_CHAIN, prefix=prefix)


@query
def op1_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    judged = with_toxicity(spark, table(spark, folder, "documents"), folder)
    return judged.select("doc_id", "p_low_quality", "p_toxic", (F.coalesce("p_toxic", F.lit(0.0)) >= 0.5).alias("toxic"))


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op9_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``rows``: the order along the curve over lang, source and size is cut into eight runs of equal length."""
    docs = table(spark, folder, "documents")
    text = whole_text(docs)
    scratch = Scratch(spark, "op9")
    rows = scratch.keep(
        docs.select("doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")),
        "rows",
    )
    sharded = sharding.shard_rows(rows, ["lang", "source", "size"], ["size", "text_crc32", "doc_id"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PROBE = "</s>[INST] ok [/INST]"

SEQUENCE_TOKENS = 2048
#: Stands in for the secret that a deployment would hand over.
PII_KEY = b"pseudonym key of the test tables"


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens are words and an end mark; equal texts are one cluster."""
    docs = table(spark, folder, "documents")
    return pack_documents(docs)


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(
        docs, SEQUENCE_TOKENS, "doc_id", packing.word_count(docs["text"]), docs["source"], F.xxhash64(whole_text(docs))
    )


@query
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        "SELECT -1L AS conv_id, turn, element_at(array('user', 'assistant'), int(turn) + 1) AS role, :probe AS text FROM VALUES (0L), (1L) AS t(turn)",
        args={"probe": PROBE},
    )
    return chat.digest_chats(turns.unionByName(probe), TOKENIZER)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


@query
def op5_quality_pu(spark: SparkSession, folder: str) -> DataFrame:
    """Labels are only read outside the held-out third, and only where they are 1."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trusted = table(spark, folder, "labels").where(~held_out() & (F.col("quality") == 1))
    model = quality.train(docs, trusted, ~held_out())
    return quality.scored(docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False))), model, keep=["held_out"])


@query
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, folder, "documents"))


@query
def op7_weighted_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared_with_next(table(spark, folder, "documents"))


@query
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).withColumn(
        "n_pii", F.aggregate(F.map_values("pii_counts"), F.lit(0), lambda total, n: total + n)
    )


@query
def op11_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """``score``: the least freedom of all findings, one half without any."""
    found = licenses.scan_licences(table(spark, folder, "documents"))
    base = F.filter("findings", lambda f: f["kind"] == "base")

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(of, lambda f: f["labels"])))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda f: f["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f["word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("findings")).alias("labels"),
        F.coalesce(F.array_min(F.transform("findings", lambda f: f["freedom"])), F.lit(licenses.SILENT)).alias("score"),
    )


#: Conversations whose ids agree but for the last two digits share a beginning of at most so many turns, less one.
FAMILY, HEADS = 100, 6


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with its first turns replaced by those of the first conversation of its family."""
    family, at_most = F.col("conv_id") - F.col("conv_id") % FAMILY, HEADS - 1
    heads = conversations.where(F.col("conv_id") == family).select(F.col("conv_id").alias("family"), F.slice("turns", 1, at_most).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), taken), F.slice("turns", F.lit(1), F.lit(0)))
    own = F.slice("turns", taken + 1, F.size("turns"))
    return conversations.join(heads, family == F.col("family"), "left").select("conv_id", F.concat(head, own).alias("turns"))


@query
def op12_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    scratch = Scratch(spark, "op12")
    conversations = scratch.keep(prefix_trie.conversations_of(turns), "conversations")
    nodes = prefix_trie.prefix_trie(rebuilt(conversations))
    scratch.drop()
    return nodes


@query
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op2_url_filter"] = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(action, rhost, rpath) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fit AS (
    SELECT page_id, rhost || rpath AS rule, action,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS place
    FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM split s LEFT JOIN (SELECT * FROM fit WHERE place = 1) f ON s.page_id = f.page_id
"""

ORACLE["op4_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(text) + (length(text) - length(replace(text, '\', '')))
        + (length(text) - length(replace(text, '<|', ' '))) + (length(text) - length(replace(text, '|>', ' ')))
        + (length(text) - length(replace(text, '[INST]', ''))) / 6 + (length(text) - length(replace(text, '[/INST]', ''))) / 7
        + (length(text) - length(replace(text, '<s>', ''))) / 3 + (length(text) - length(replace(text, '</s>', ''))) / 4
        + (length(text) - length(replace(text, '<<SYS>>', ''))) / 7 + (length(text) - length(replace(text, '<</SYS>>', ''))) / 8 AS body
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(length(role) + 5 + body + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE["op6_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0) s
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.n + b.n - shared)
), reach(doc_id, other) AS (
    SELECT x, y FROM links UNION SELECT y, x FROM links
    UNION
    SELECT r.doc_id, l.other FROM reach r JOIN (SELECT x, y AS other FROM links UNION SELECT y, x FROM links) l ON r.other = l.x
)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(w.doc_id, min(other)) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN reach r ON r.doc_id = w.doc_id GROUP BY w.doc_id
"""

ORACLE["op8_benchmark_decontamination"] = r"""
WITH words AS (
    SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM (SELECT 'doc' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
          UNION ALL SELECT 'item', item_id, coalesce(text, '') FROM benchmark) t
), windows AS (
    SELECT DISTINCT id AS item_id, w[i : i + 9] AS f, least(len(w), 10) AS n
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM words WHERE kind = 'item' AND len(w) > 0) s
), places AS (
    SELECT id AS doc_id, i, n, w[i : i + n - 1] AS f
    FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM windows) z WHERE kind = 'doc' AND len(w) >= n) s
), found AS (
    SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (n, f)
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) s GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS said
    FROM (SELECT DISTINCT doc_id, item_id FROM found) s GROUP BY doc_id
), heard AS (
    SELECT id AS doc_id, i, w[i] AS word, w[greatest(i - 14, 1) : i + 14] AS round FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE kind = 'doc') s
), frequency AS (
    SELECT word, count(*) AS n FROM heard GROUP BY word
), bags AS (
    SELECT item_id, list_distinct(f) AS bag, f FROM windows
), rarest AS (
    SELECT item_id, bag, arg_min(word, (coalesce(n, 0), word)) AS word
    FROM (SELECT item_id, bag, f, unnest(bag) AS word FROM bags) b LEFT JOIN frequency USING (word) GROUP BY item_id, bag, f
), near AS (
    SELECT DISTINCT doc_id, item_id
    FROM (SELECT doc_id, item_id, bag, round, unnest(range(1, greatest(len(round) - 13, 2))) AS low FROM rarest JOIN heard USING (word) WHERE list_has_all(round, bag)) s
    WHERE list_has_all(round[low : low + 14], bag)
), near_items AS (
    SELECT doc_id, count(*) AS n_near_items FROM (SELECT * FROM near EXCEPT SELECT DISTINCT doc_id, item_id FROM found) s GROUP BY doc_id
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(said, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM words LEFT JOIN hit ON hit.doc_id = id LEFT JOIN items ON items.doc_id = id LEFT JOIN near_items ON near_items.doc_id = id WHERE kind = 'doc'
"""

#: crc32 of a list of bytes, for statements that have the table ``crc(t)`` at hand.
_CRC_TABLE = """crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i)) s)"""


def _crc(data: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295)"


def _hex_bytes(digits: str) -> str:
    place = "instr('0123456789ABCDEF', substr({0}, i + {1}, 1)) - 1"
    return f"list_transform(range(0, length({digits}), 2), lambda i: 16 * ({place.format(digits, 1)}) + {place.format(digits, 2)})"


ORACLE["op12_conversation_prefix_trie"] = rf"""
WITH {_CRC_TABLE}, ordered AS (
    SELECT conv_id, digest, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS n
    FROM (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
            length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL) t
), ids AS (
    SELECT conv_id, {_crc("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)")} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) c, crc
), rebuilt AS (
    SELECT i.conv_id, row_number() OVER (PARTITION BY i.conv_id ORDER BY o.conv_id <> i.conv_id - i.conv_id % 100 OR o.n > h, o.n) AS n, digest, chars
    FROM ids i JOIN ordered o ON (o.conv_id = i.conv_id - i.conv_id % 100 AND o.n <= h) OR (o.conv_id = i.conv_id AND o.n > h)
), prefixes AS (
    SELECT conv_id, 0 AS depth, '' AS prefix, NULL AS parent, 0 AS chars FROM ids
    UNION ALL
    SELECT conv_id, n, said, CASE WHEN n = 1 THEN '' ELSE left(said, CAST(33 * (n - 1) AS INTEGER)) END, chars
    FROM (SELECT *, string_agg(digest || '.', '') OVER (PARTITION BY conv_id ORDER BY n) AS said FROM rebuilt) r
), ends AS (
    SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS said
    FROM (SELECT * FROM prefixes QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) e GROUP BY prefix
), nodes AS (
    SELECT prefix, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
        (count(*) - 1) * any_value(chars) AS saved FROM prefixes GROUP BY prefix
), children AS (
    SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent
), below AS (
    SELECT p.prefix, sum(n.saved) AS saved, count(*) FILTER (WHERE c.parent IS NULL) AS n_leaves
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN children c ON c.parent = n.prefix
    GROUP BY p.prefix
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
    CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.said, '')) AS ends_sha256
FROM nodes n JOIN below b USING (prefix) LEFT JOIN nodes u ON n.parent = u.prefix LEFT JOIN children c ON c.parent = n.prefix
    LEFT JOIN ends e ON e.prefix = n.prefix
"""


def _hilbert(cells: str, bits: int = 4) -> str:
    """The statement ``cells`` with its columns x0, x1 and x2 turned into the place on the curve, one step a level."""
    sides = [1 << b for b in range(bits - 1, 0, -1)]
    for q in sides:
        for i in range(3):
            turned = f"xor(x0, CASE WHEN x{i} & {q} <> 0 THEN {q - 1} ELSE xor(x0, x{i}) & {q - 1} END) AS x0"
            moved = f", xor(x{i}, CASE WHEN x{i} & {q} <> 0 THEN 0 ELSE xor(x0, x{i}) & {q - 1} END) AS x{i}" if i else ""
            cells = f"SELECT * REPLACE ({turned}{moved}) FROM ({cells}) s"
    cells = f"SELECT * REPLACE (xor(x0, x1) AS x1, xor(xor(x0, x1), x2) AS x2) FROM ({cells}) s"
    flip = "0"
    for q in sides:
        flip = f"xor({flip}, CASE WHEN x2 & {q} <> 0 THEN {q - 1} ELSE 0 END)"
    cells = f"SELECT *, {flip} AS flip FROM ({cells}) s"
    place = " + ".join(f"(((xor(x{i}, flip) >> {b}) & 1) << {3 * b + 2 - i})" for b in range(bits) for i in range(3))
    return f"SELECT *, {place} AS curve FROM ({cells}) s"


#: Cuts are the values that begin the sixteenths of the order; a cell is the number of different cuts that a value reaches.
ORACLE["op9_hilbert_shards"] = rf"""
WITH {_CRC_TABLE}, bytes AS (
    SELECT doc_id, lang, source, hex(encode(coalesce(text, ''))) AS digits FROM documents
), rows AS (
    SELECT doc_id, lang, source, length(digits) // 2 + 1 AS size,
        CASE WHEN digits = '' THEN 0 ELSE {_crc("list_transform(regexp_extract_all(digits, '..'), lambda x: CAST('0x' || x AS BIGINT))")} END AS text_crc32 FROM bytes, crc
), placed AS (
    SELECT lang, source, size, row_number() OVER (ORDER BY lang NULLS LAST) - 1 AS by_lang, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS by_source,
        row_number() OVER (ORDER BY size) AS by_size, count(lang) OVER () AS langs, count(source) OVER () AS sources, count(*) OVER () AS n FROM rows
), cuts AS (
    SELECT list(DISTINCT lang) FILTER (WHERE by_lang = langs * k // 16) AS of_lang, list(DISTINCT source) FILTER (WHERE by_source = sources * k // 16) AS of_source,
        list(DISTINCT size) FILTER (WHERE by_size = (n * k + 15) // 16) AS of_size FROM placed, range(1, 16) r(k)
), cells AS (
    SELECT doc_id, size, text_crc32, coalesce(len(list_filter(of_lang, lambda c: c <= lang)), 0) AS x0,
        coalesce(len(list_filter(of_source, lambda c: c <= source)), 0) AS x1, coalesce(len(list_filter(of_size, lambda c: c <= size)), 0) AS x2 FROM rows, cuts
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY curve, size, text_crc32, doc_id) - 1 AS place, count(*) OVER () AS n FROM ({_hilbert("SELECT * FROM cells")}) c
), sharded AS (
    SELECT *, place * 8 // n AS shard FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(place - (shard * n + 7) // 8 AS BIGINT) AS slot,
    CAST(NULL AS INTEGER) AS grown_shard, CAST(curve AS INTEGER) AS curve
FROM sharded
"""

ORACLE["op13_importance_resampling"] = rf"""
WITH {_CRC_TABLE}, words AS (
    SELECT kind, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
    FROM (SELECT 'raw' AS kind, doc_id, coalesce(text, '') AS text FROM documents
          UNION ALL SELECT 'target', item_id, coalesce(text, '') FROM benchmark) t
), features AS (
    SELECT kind, doc_id, f, count(*) AS n
    FROM (SELECT kind, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM words) s
    GROUP BY kind, doc_id, f
), buckets AS (
    SELECT f, {_crc(_hex_bytes("digits"))} % 10000 AS bucket FROM (SELECT f, hex(encode(f)) AS digits FROM (SELECT DISTINCT f FROM features) d) h, crc
), counts AS (
    SELECT bucket, sum(CASE WHEN kind = 'raw' THEN n ELSE 0 END) AS s, sum(CASE WHEN kind = 'target' THEN n ELSE 0 END) AS t
    FROM features JOIN buckets USING (f) GROUP BY bucket
), totals AS (
    SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM counts, totals
), sums AS (
    SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS total
    FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE kind = 'raw' GROUP BY doc_id
), scored AS (
    SELECT w.doc_id, len(w.w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
        CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
        CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
    FROM words w LEFT JOIN sums USING (doc_id) WHERE kind = 'raw'
), placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT s.doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed USING (doc_id)
"""
