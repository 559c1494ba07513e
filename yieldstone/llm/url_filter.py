"""URL rules by a cascade of Bloom filters: exact membership over the corpus's own keys, without a join.

Level 1 encodes the listed keys. Some keys of the corpus that are not listed pass it; level 2 encodes exactly
those. Some listed keys pass level 2; level 3 encodes these, and so on until a level lets no wrong key pass. The
first level that a key misses then tells, without error, whether the key is listed, for every key of the corpus
the cascade was built over. Keys are the label-wise host suffixes with the path prefixes that a rule could have.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower

BITS_PER_KEY = 16
#: The filters are constants of the plan, so their size is checked; keys beyond it are taken in parts, pass after pass.
MAX_FILTER_BITS = 1 << 26


class TooManyKeys(ValueError):
    """A level would need a larger filter than is allowed."""


@dataclass(frozen=True)
class Rule:
    """``path`` is a plain prefix of the url's path; the rule holds for ``host`` and all its subdomains."""

    action: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    words: list[int]
    bits: int
    hashes: int
    salt: int


@dataclass(frozen=True)
class Cascade:
    """Levels for the keys of one part of ``parts``."""

    levels: list[Level]
    part: int = 0
    parts: int = 1

    @property
    def bits(self) -> int:
        return sum(level.bits for level in self.levels)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/ ? #`` or the end, A to Z lower-cased; empty without one or for a null."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1)), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without a host part or for a null."""
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The keys a rule would need to fit this url: bounded by the labels and path lengths that rules have."""
    most_labels = max((r.host.count(".") + 1 for r in rules), default=1)
    lengths = sorted({len(r.path) for r in rules})
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most_labels))),
        lambda k: F.concat_ws(".", F.slice(labels, n - k + 1, k)),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= size, F.substring(path, 1, size)) for size in lengths]) if lengths else F.array(),
        lambda p: p.isNotNull(),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _bit(key: Column, level: Level, i: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level.salt), F.lit(i)), F.lit(level.bits))


def passes(key: Column, level: Level) -> Column:
    words, found = F.lit(level.words), F.lit(True)
    for i in range(level.hashes):
        bit = _bit(key, level, i)
        word = F.get(words, F.shiftright(bit, 6).cast("int"))
        found = found & (F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return found


def in_part(key: Column, part: int, parts: int) -> Column:
    """Whether a key belongs to the part, by a hash of its own; halves of a part are parts of twice as many."""
    return F.lit(True) if parts == 1 else F.pmod(F.xxhash64(key, F.lit("part")), F.lit(parts)) == part


def build_level(keys: DataFrame, salt: int, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_FILTER_BITS) -> Level:
    """One Bloom filter over the column ``key``; bits are set by a grouped OR, 64 to a word."""
    count = keys.count()
    bits = max(64, math.ceil(count * bits_per_key / 64) * 64)
    if bits > max_bits:
        raise TooManyKeys(f"{count} keys need {bits} bits")
    level = Level([], bits, max(1, round(bits_per_key * math.log(2))), salt)
    each = keys.select(F.explode(F.array(*[_bit(F.col("key"), level, i) for i in range(level.hashes)])).alias("bit"))
    set_words = each.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")
    )
    words = [0] * (bits // 64)
    for row in set_words.collect():  # at most max_bits / 64 rows
        words[row["word"]] = row["mask"]
    return Level(words, bits, level.hashes, salt)


def build_cascade(
    listed: DataFrame, universe: DataFrame, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_FILTER_BITS
) -> list[Level]:
    """Levels for the column ``key`` of ``listed``, exact for every ``key`` of ``universe``.

    The universe is only filtered, never shuffled: what passes level 1 by error is a small share of it.
    """
    spark, levels = listed.sparkSession, []
    scratch = Scratch(spark, "cascade")
    listed = listed.select("key").dropna().distinct()
    inside, outside = listed, universe.select("key").dropna()
    while True:
        try:
            level = build_level(inside, len(levels), bits_per_key, max_bits)
        except TooManyKeys:
            scratch.drop()
            raise
        levels.append(level)
        wrong = outside.where(passes(F.col("key"), level)).distinct()
        if len(levels) == 1:
            wrong = wrong.join(listed, "key", "left_anti")
        wrong = scratch.keep(wrong, f"level{len(levels)}")
        if wrong.isEmpty():
            scratch.drop()
            return levels
        inside, outside = wrong, inside


def build_cascades(
    listed: DataFrame,
    universe: DataFrame,
    bits_per_key: int = BITS_PER_KEY,
    max_bits: int = MAX_FILTER_BITS,
    part: int = 0,
    parts: int = 1,
) -> list[Cascade]:
    """Cascades that cover all keys; where a level outgrows its bound, of listed keys or of errors, the part is halved."""
    own = in_part(F.col("key"), part, parts)
    try:
        return [Cascade(build_cascade(listed.where(own), universe.where(own), bits_per_key, max_bits), part, parts)]
    except TooManyKeys:
        halves = (part, part + parts)
        return [c for half in halves for c in build_cascades(listed, universe, bits_per_key, max_bits, half, 2 * parts)]


def passes_of(cascades: Sequence[tuple[str, Cascade]], max_bits: int) -> list[list[tuple[str, Cascade]]]:
    """Cascades in turn, as many in one pass as keep its constants within twice the bound of a level."""
    groups: list[list[tuple[str, Cascade]]] = []
    for item in cascades:
        if groups and sum(c.bits for _, c in groups[-1]) + item[1].bits <= 2 * max_bits:
            groups[-1].append(item)
        else:
            groups.append([item])
    return groups


def is_listed(key: Column, levels: Sequence[Level]) -> Column:
    """Odd levels hold listed keys, even ones the errors of the level before; the first miss decides."""
    member: Column = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels), 0, -1):
        member = F.when(passes(key, levels[depth - 1]), member).otherwise(F.lit(depth % 2 == 0))
    return member


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow", max_bits: int = MAX_FILTER_BITS
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; the longest rule that fits decides, else ``default``.

    A null url, or one without ``://``, has an empty host and path and gets the default. Repeated rows each get
    their verdict; a key listed under both actions counts as blocked. Columns of ``pages`` named like the four
    results are replaced; without rules every url gets the default. An empty table gives no rows, and a url of any length
    is read whole. Keys that need more than ``max_bits`` of one filter are judged in parts by passes over the table, each
    stored in the shared folder.
    """
    spark = pages.sparkSession
    urls = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not rules:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidate_keys(F.col("host"), F.col("path"), rules)
    universe = urls.select(F.explode(keys).alias("key"))
    blocked = {r.key for r in rules if r.action == "block"}
    cascades: list[tuple[str, Cascade]] = []
    for action in ("block", "allow"):
        own = sorted({r.key for r in rules if r.action == action} - (blocked if action == "allow" else set()))
        if own:
            cascades += [(action, c) for c in build_cascades(_key_frame(spark, own), universe, max_bits=max_bits)]

    def fitting(group: list[tuple[str, Cascade]]) -> Column:
        def judge(key: Column) -> Column:
            action = F.lit(None).cast("string")
            for name, c in group:
                action = F.when(in_part(key, c.part, c.parts) & is_listed(key, c.levels), F.lit(name)).otherwise(action)
            return F.struct(F.length(key).alias("size"), key.alias("rule"), action.alias("action"))

        return F.array_max(F.filter(F.transform(keys, judge), lambda x: x["action"].isNotNull()))

    first, *others = passes_of(cascades, max_bits)
    judged = urls.withColumn("__best", fitting(first))
    for group in others:
        kept = Scratch(spark, "judged").keep(judged, "pass")
        judged = kept.withColumn("__best", F.greatest("__best", fitting(group)))  # the longer rule; nulls don't count
    return judged.withColumns(
        {"rule": F.col("__best.rule"), "verdict": F.coalesce(F.col("__best.action"), F.lit(default))}
    ).drop("__best")


def _key_frame(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))
