"""Importance resampling towards a target, with weights summed up over bit planes.

Words and word pairs fall into hashed buckets. A bucket's gain says how much more common it is in the target than in the raw
documents, as a whole number, and a document's weight is the mean gain of its features. Counts of a document are split
into planes of one bit a bucket, gains into planes of one bit a bucket and sign; the sum of count times gain is then the sum
over pairs of planes of the bits they share, times a power of two. All of it is whole numbers, so weights are exact.
Scores add Gumbel noise from the id: the highest scores are a draw without replacement by weight.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, byte_slices, frugal
from .sharding import ranked

BUCKETS = 10_000
#: Gains and scores are in units of one thousandth.
UNIT = 1000
#: Documents whose counts are held at once.
ROWS = 128
#: Longer words are hashed one by one.
LONG_WORD = 48

_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _fed(state: np.ndarray, data: bytes, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC states after each word's bytes, one byte a round over all words that are so long."""
    state = state.copy()
    todo, at = np.flatnonzero(sizes > 0), 0
    while len(todo) and at < LONG_WORD:
        state[todo] = _CRC[(state[todo] ^ raw[starts[todo] + at]) & 255] ^ (state[todo] >> 8)
        at += 1
        todo = todo[sizes[todo] > at]
    for i in todo.tolist():
        rest = data[starts[i] + at : starts[i] + sizes[i]]
        state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def features(texts: Sequence[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word, then of every pair of words that follow each other, its text and its bucket; words of each text."""
    data = b" ".join(x.translate(_WORD_BYTES) if x else b"" for x in texts) + b" "
    raw = np.frombuffer(data, np.uint8)
    ends = np.cumsum([len(x or b"") + 1 for x in texts])
    kept = np.concatenate([[False], raw != 32])  # the last byte is a blank
    edges = np.flatnonzero(kept[1:] != kept[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    text = np.searchsorted(ends, starts, "right")
    words = _fed(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, raw, starts, sizes)
    first = np.flatnonzero(text[1:] == text[:-1])
    state = words[first]
    state = _CRC[(state ^ np.uint32(32)) & 255] ^ (state >> 8)
    pairs = _fed(state, data, raw, starts[first + 1], sizes[first + 1])
    hashes = np.concatenate([words, pairs]) ^ np.uint32(0xFFFFFFFF)
    return np.concatenate([text, text[first]]), (hashes % np.uint32(buckets)).astype(np.int64), np.bincount(text, minlength=len(texts))


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds. Each task adds up its own, so ``buckets`` rows a task are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in byte_slices(batches, 0):
            total += np.bincount(features(part[0].to_pylist(), buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    parts = docs.select(docs[text].cast("binary")).mapInArrow(frugal(run), "bucket int, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most a row a bucket
    counts = np.zeros(buckets, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> list[int]:
    """The logarithm of the ratio of both smoothed shares of each bucket, in thousandths, rounded down."""
    buckets, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return [
        math.floor(UNIT * math.log((t + 1.0) * (all_raw + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ]


def bit_planes(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(k, bit k of each value as one bit in words of 64) for all k with a set bit; values along the last axis."""
    pad = [(0, 0)] * (values.ndim - 1) + [(0, -values.shape[-1] % 64)]
    values = np.pad(values, pad)
    for k in range(int(values.max(initial=0)).bit_length()):
        bits = np.packbits((values >> k & 1).astype(np.uint8), axis=-1)
        if bits.any():
            yield k, bits.view(np.uint64)


class Weigher:
    """Exact sums of count times gain by AND, popcount and powers of two."""

    def __init__(self, gain: Iterable[int]):
        gain = np.array(gain, np.int64)
        self.planes = [(sign << k, bits) for sign in (1, -1) for k, bits in bit_planes(np.maximum(sign * gain, 0))]

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """A sum for each row of counts."""
        total = np.zeros(len(counts), np.int64)
        for k, bits in bit_planes(counts):
            for factor, plane in self.planes:
                total += (factor << k) * np.bitwise_count(bits & plane).sum(axis=-1, dtype=np.int64)
        return total


def weighed(docs: DataFrame, gain: Sequence[int], ident: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``ident``, ``n_words``, ``n_features`` and ``weight`` of every row, and ``kept``, a struct of the columns named.

    The weight is the mean gain of the features, rounded down; 0 for a text without any.
    """
    buckets, types = len(gain), dict(docs.dtypes)
    kept = F.struct(*[docs[c] for c in keep]) if keep else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = Weigher(gain)
        for sliced in byte_slices(batches, 2):
            for low in range(0, sliced.num_rows, ROWS):
                part = sliced.slice(low, ROWS)
                row, bucket, n_words = features(part[2].to_pylist(), buckets)
                counts = np.bincount(row * buckets + bucket, minlength=part.num_rows * buckets).reshape(-1, buckets)
                n = counts.sum(axis=1)
                weight = weigher(counts) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([part[0], part[1], *(pa.array(x, pa.int64()) for x in (n_words, n, weight))], names)

    names = ["ident", "kept", "n_words", "n_features", "weight"]
    shape = f"ident {types[ident]}, kept {docs.select(kept).dtypes[0][1]}, n_words long, n_features long, weight long"
    rows = docs.select(docs[ident].alias("ident"), kept.alias("kept"), docs[text].cast("binary").alias("body"))
    return rows.mapInArrow(frugal(run), shape).withColumnRenamed("ident", ident)


def noise(ident: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id and the seed alone; a null id counts as an empty one."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-UNIT * F.log(-F.log((head + 0.5) / float(1 << 32))))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    ident: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` and ``kept``.

    Of the rows with at least ``least_words`` words the share ``percent`` with the highest scores is drawn and ranked from 1
    on, ties by id, null ids last, then by number of features; the rank of all others is null. ``kept`` is a struct of the
    columns in ``keep`` (null without any), so columns of ``docs`` clash with no result; ``target`` needs a column ``text`` too.

    A null text is empty: no features, weight 0, never drawn unless ``least_words`` is 0. Equal texts get equal weights, and rows
    that share an id and a text get equal scores and ranks of their own. Texts of any length are counted whole. Without
    documents there are no rows, without a target all weights follow from the smoothing.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    rows = weighed(docs, gain, ident, text, keep).withColumn("score", F.col("weight") + noise(F.col(ident), seed))
    rows = scratch.keep(rows, "weights")
    keys = F.struct((-F.col("score")).alias("down"), F.col(ident).isNull().alias("no_id"), F.col(ident).alias("id"), "n_features")
    enough = rows.where(F.col("n_words") >= least_words).withColumn("__order", keys)
    placed, total = ranked(enough, ["__order"], scratch)
    rank = F.when(F.col("rank") < percent * total // 100, F.col("rank") + 1)
    drawn = placed.drop("__order").withColumn("rank", rank)
    rest = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return scratch.result(drawn.unionByName(rest))
