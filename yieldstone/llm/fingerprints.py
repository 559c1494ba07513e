"""Document fingerprints by consistent weighted sampling.

Each of the samples draws, for every term of a text, two gamma variables r and c and a uniform b from hashes of the term
and the sample's number. With the term's weight S, t = floor(ln S / r + b) and ln a = ln c - r (t - b + 1); the sample is the
least a over the terms. It is the same for two texts with the probability of their generalised Jaccard similarity,
the sum of the terms' smaller weights over the sum of the larger ones (Ioffe 2010). The least a itself names the
term and its t, so a plain minimum is all there is to aggregate. Weights are the counts of words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, whole_text
from .sharding import ranked

#: Samples of a fingerprint: likeness has a standard error of at most 0.5 / sqrt(SAMPLES).
SAMPLES = 32
#: Samples drawn by one row of the inner aggregation, so that its generated code stays small enough to be compiled.
SAMPLES_A_ROW = 4

_UNIT = 2.0**-21
_LOW = (1 << 21) - 1


def _uniform(bits: Column, place: int) -> Column:
    """One of three numbers in (0, 1) that 64 random bits give."""
    return (F.shiftrightunsigned(bits, 21 * place).bitwiseAND(F.lit(_LOW)) + F.lit(0.5)) * F.lit(_UNIT)


def draws(term: Column, number: Column) -> dict[str, Column]:
    """r, b and ln c of a term (64 bits) for a sample; r and c are Gamma(2, 1)."""
    first, second = F.xxhash64(term, number), F.xxhash64(number, term)
    return {
        "r": -F.ln(_uniform(first, 0) * _uniform(first, 1)),
        "b": _uniform(first, 2),
        "c": F.ln(-F.ln(_uniform(second, 0) * _uniform(second, 1))),
    }


def log_a(r: Column, b: Column, c: Column, log_weight: Column) -> Column:
    return c - r * (F.floor(log_weight / r + b) - b + F.lit(1.0))


def word_terms(text: Column) -> Column:
    """The words of a text in order, with an empty string where it starts or ends with a separator."""
    return F.split(text, r"[\x20\x09-\x0D]+", -1)


def paired_terms(rows: DataFrame, keys: Sequence[str], one: str, other: str, shared: Column, copies: str | None = None) -> DataFrame:
    """Words (as 64 bits) of two text columns that begin with the same ``shared`` characters, counted on each side.

    Words that end before the last separator of the shared part are counted once for both sides. ``copies`` names how
    many equal rows a key has, by which counts are divided.
    """
    head = F.regexp_extract(F.substring(F.col(one), F.lit(1), shared), r"(?s)\A(.*[\x20\x09-\x0D])", 1)
    extra = [copies] if copies else []
    cut = rows.select(*keys, *extra, one, other, head.alias("__head"))
    rest = [word_terms(F.substring(F.col(c), F.length("__head") + 1, F.lit(2**31 - 1))) for c in (one, other)]
    parts = cut.select(*keys, *extra, word_terms(F.col("__head")).alias("__h"), rest[0].alias("__o"), rest[1].alias("__e"))
    words = parts.select(
        *keys, *extra, F.size("__h").alias("__nh"), (F.size("__h") + F.size("__o")).alias("__no"),
        F.posexplode(F.concat("__h", "__o", "__e")).alias("__at", "__word"),
    ).where("__word <> ''")
    is_one, is_other = F.col("__at") < F.col("__no"), (F.col("__at") < F.col("__nh")) | (F.col("__at") >= F.col("__no"))
    words = words.select(*keys, *extra, F.xxhash64("__word").alias("term"), is_one.cast("long").alias("__x"), is_other.cast("long").alias("__y"))
    sums = [F.sum("__x").alias(f"{one}_n"), F.sum("__y").alias(f"{other}_n")]
    if not copies:
        return words.groupBy(*keys, "term").agg(*sums)
    counted = words.groupBy(*keys, copies, "term").agg(*sums)
    return counted.select(*keys, "term", *[F.expr(f"{c}_n div {copies}").alias(f"{c}_n") for c in (one, other)])


def sampled(terms: DataFrame, keys: Sequence[str], weights: Sequence[str], samples: int = SAMPLES) -> DataFrame:
    """For each key, and each weight column w, the array ``w_samples`` of the samples (31 bits each).

    ``terms`` has one row for each key and term (a long), a weight of 0 for a term that this side lacks, and must be
    partitioned by (some of) the keys already, so that nothing is shuffled here. A side without terms has null.
    """
    per_row = min(SAMPLES_A_ROW, samples)
    logs = {f"__{w}": F.when(F.col(w) > 0, F.ln(F.col(w).cast("double"))) for w in weights}
    rows = terms.select(*keys, "term", *[c.alias(n) for n, c in logs.items()], F.explode(F.sequence(F.lit(0), F.lit(samples - per_row), F.lit(per_row))).alias("__first"))
    drawn = {f"__{name}{i}": column for i in range(per_row) for name, column in draws(F.col("term"), F.col("__first") + i).items()}
    rows = rows.select(*keys, "__first", *logs, *[c.alias(n) for n, c in drawn.items()])
    least = [
        F.min(log_a(*(F.col(f"__{x}{i}") for x in "rbc"), F.col(f"__{w}"))).alias(f"__{w}{i}") for w in weights for i in range(per_row)
    ]
    chunks = rows.groupBy(*keys, "__first").agg(*least)
    folded = {w: F.array(*[F.shiftrightunsigned(F.xxhash64(f"__{w}{i}"), 33).cast("int") for i in range(per_row)]) for w in weights}
    # a side without terms has only null minima
    folded = {w: F.when(F.col(f"__{w}0").isNotNull(), a) for w, a in folded.items()}
    chunks = chunks.select(*keys, *[F.struct("__first", a.alias("part")).alias(w) for w, a in folded.items()])
    whole = chunks.groupBy(*keys).agg(*[F.sort_array(F.collect_list(w)).alias(w) for w in weights])
    return whole.select(*keys, *[F.flatten(F.col(f"{w}.part")).alias(f"{w}_samples") for w in weights])


def fingerprint(samples: Column) -> Column:
    """Eight hex digits a sample; a text without words has the digit 0 throughout."""
    digits = F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit("0" * 8 * SAMPLES))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal samples; 1 for two texts without words, 0 if only one has some."""
    same = F.aggregate(F.zip_with(one, other, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    return F.when(one.isNull() & other.isNull(), 1.0).when(one.isNull() | other.isNull(), 0.0).otherwise(same / SAMPLES)


KEY = ["__key", "__check"]


def fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """ident and ``fingerprint`` of every row; the counts of a text's words are summed up before anything is shuffled."""
    rows = docs.select(F.col(ident), whole_text(docs, text).alias("text")).withColumn("__row", F.monotonically_increasing_id())
    rows = Scratch(docs.sparkSession, "fingerprints").keep(rows, "rows").repartition("__row")
    words = rows.select("__row", F.explode(word_terms(F.col("text"))).alias("word")).where("word <> ''")
    terms = words.groupBy("__row", F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    samples = sampled(terms, ["__row"], ["n"])
    return rows.select("__row", ident).join(samples, "__row", "left").select(ident, fingerprint(F.col("n_samples")).alias("fingerprint"))


def compared_with_next(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likeness to that and to the next document.

    The edited text has the last quarter of the code points (rounded down) replaced by the first as many of the next
    document in ascending order of ident; the last is followed by the first. Columns: ident, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    A null text is empty. Texts without words have the fingerprint of zeros, alike among themselves and unlike all
    others. Rows equal in ident and text are one document in the order, each of them gets its result; equal idents
    with different texts follow a hash of the text, null idents come first. A single document is its own
    next one, an empty table gives no rows. Other columns aren't read. The texts are shuffled once, by row.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    body = whole_text(docs, text)
    own = docs.select(F.col(ident).alias("__id"), body.alias("one"), F.xxhash64(F.col(ident), body).alias("__key"), F.crc32(F.encode(body, "UTF-8")).alias("__check"))
    sized = own.groupBy("__id", *KEY, F.length("one").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    order, total = ranked(sized, ["__id", *KEY], scratch)
    after = (F.col("rank") + 1) % F.lit(max(total, 1))
    quarter = F.expr("cast(n_chars div 4 as int)")
    before = order.select(after.alias("rank"), *[F.col(k).alias(f"{k}_to") for k in KEY], quarter.alias("need"))
    asked = order.select("rank", *KEY).join(before, "rank").drop("rank")
    # the sides with hints are the narrow ones: texts are neither sorted nor spilled
    heads = own.join(asked.hint("shuffle_hash"), KEY).select(*[F.col(f"{k}_to").alias(k) for k in KEY], F.substring(F.col("one"), F.lit(1), F.col("need")).alias("head"))
    ends = order.select(*KEY, "n_chars", "copies").join(heads.groupBy(*KEY).agg(F.first("head").alias("head")), KEY)
    kept = F.col("n_chars").cast("int") - quarter
    pairs = own.drop("__id").join(ends.hint("shuffle_hash"), KEY).withColumn("other", F.concat(F.substring(F.col("one"), F.lit(1), kept), F.col("head")))
    digests = pairs.groupBy(*KEY).agg(F.min(F.sha2("other", 256)).alias("edited_sha256"))
    terms = paired_terms(pairs, KEY, "one", "other", kept, "copies")
    marks = digests.join(sampled(terms, KEY, ["one_n", "other_n"]), KEY, "left")
    marks = scratch.keep(order.join(marks, KEY).withColumnsRenamed({"one_n_samples": "mine", "other_n_samples": "edited"}), "marks")
    following = marks.select(((F.col("rank") + F.lit(total - 1)) % F.lit(max(total, 1))).alias("rank"), F.col("mine").alias("next"))
    whole = marks.join(following, "rank").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return whole.select(
        F.col("__id").alias(ident),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("mine")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("mine"), F.col("edited")).alias("near_edited"),
        likeness(F.col("mine"), F.col("next")).alias("near_next"),
    )

