"""Text quality by learning from trusted positives and unlabelled web text alone.

A linear model g over text statistics minimises the non-negative unbiased risk (Kiryo et al. 2017)

    p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)]),   l(z) = log(1 + exp(-z)),

with the share p of positives among the unlabelled texts estimated first, by the best bin of a classifier that tells
positives from unlabelled texts (Garg et al. 2021). Labels 0 are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, frugal
from .shingles import distinct, word_hashes

#: Rows that a model is fitted on at most, drawn by hash.
POSITIVE_ROWS = 10_000
UNLABELLED_ROWS = 20_000

_PRINTED = list(range(33, 127))
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def statistics(text: str | None) -> np.ndarray:
    """Shares of characters, words and lines of the whole text; all zero but the last for a text without any."""
    data = text.encode() if text else b""
    raw = np.frombuffer(data, np.uint8)
    n = max(1, len(raw))
    counts = np.bincount(raw, minlength=256)
    shares = counts[_PRINTED] / n
    symbol = ~_ALNUM[raw] & (raw > 32)
    doubled = np.count_nonzero(symbol[1:] & (raw[1:] == raw[:-1])) if len(raw) else 0
    starts, h = word_hashes(data.lower())
    words = max(1, len(h))
    repeated = np.count_nonzero(h[1:] == h[:-1])
    pairs = distinct(h[1:] * np.uint64(31) + h[:-1]) if len(h) > 1 else h
    lines = [x for x in data.split(b"\n") if x.strip()]
    kinds = [
        counts[65:91].sum() / n, counts[97:123].sum() / n, counts[48:58].sum() / n, counts[128:].sum() / n,
        np.count_nonzero(symbol) / n, doubled / words, repeated / words, len(distinct(h)) / words, len(pairs) / words,
        len(set(lines)) / max(1, len(lines)), len(raw) / words / 20, words / max(1, len(lines)) / 200,
    ]
    # logarithms tell a trace from none, whatever the length of the text
    traces = np.log1p(np.concatenate([counts[_PRINTED], [doubled, repeated, words - len(pairs), len(lines) - len(set(lines))]]))
    return np.concatenate([shares, kinds, traces / 5, [np.log1p(len(raw)) / 10, float(len(h) == 0)]]).astype(np.float32)


def standardised(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Clipped, so that no odd text outweighs all others."""
    return np.clip((x - mean) / spread, -5, 5)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def parts(self) -> tuple:
        return self.mean, self.spread, self.weights, self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def descend(gradient: Callable[[np.ndarray], np.ndarray], size: int, steps: int, rate: float) -> np.ndarray:
    """Adam on a function that gives the gradient; the mean of the vectors of the last half."""
    w, m, v, total = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        if step > steps // 2:
            total += w
    return total / (steps - steps // 2)


def risk_gradient(positive: np.ndarray, unlabelled: np.ndarray, prior: float, batch: int = 1024, decay: float = 1e-4):
    """Gradient of the risk on a random part of rows with a last column of ones.

    Where the part of the negatives falls below zero, its own gradient is turned.
    """
    draw = np.random.default_rng(7)

    def part(rows: np.ndarray, size: int) -> np.ndarray:
        return rows if len(rows) <= size else rows[draw.integers(0, len(rows), size)]

    def gradient(w: np.ndarray) -> np.ndarray:
        p, u, w = part(positive, batch), part(unlabelled, 3 * batch), w.astype(np.float32)
        gp, gu = p @ w, u @ w
        of_positive = -prior * (p.T @ sigmoid(-gp)) / len(gp)
        of_negative = u.T @ sigmoid(gu) / len(gu) - prior * (p.T @ sigmoid(gp)) / len(gp)
        negative_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        own = of_positive + of_negative if negative_risk >= 0 else -of_negative
        return own + decay * w

    return gradient


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled scores: the least ratio of upper tails, with its error bound, over all bins."""
    cuts = np.unique(positive)
    in_positive = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    in_unlabelled = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    error = np.sqrt(np.log(40) / 2 / len(positive)) + np.sqrt(np.log(40) / 2 / len(unlabelled))
    best = np.argmin((in_unlabelled + error) / in_positive)
    return float(np.clip(in_unlabelled[best] / in_positive[best], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400) -> Model:
    """Halves of both samples first: a classifier of positives against unlabelled on one, its prior on the other."""
    both = np.concatenate([positive, unlabelled])
    mean, spread = both.mean(0), both.std(0) + 1e-3

    def rows(x: np.ndarray) -> np.ndarray:
        return np.hstack([standardised(x, mean, spread), np.ones((len(x), 1), np.float32)])

    p, u = rows(positive), rows(unlabelled)
    told = descend(risk_gradient(p[::2], u[::2], 0.5), p.shape[1], steps // 2, 0.05)
    prior = class_prior(p[1::2] @ told, u[1::2] @ told)
    w = descend(risk_gradient(p, u, prior), p.shape[1], steps, 0.05)
    return Model(mean, spread, w[:-1], float(w[-1]), prior)


def first_by_hash(rows: DataFrame, ident: str, at_most: int) -> DataFrame:
    """At most so many rows, the same ones in every run: a share by hash keeps the sort small."""
    total = max(1, rows.count())
    share = min(1.0, 1.2 * at_most / total + 0.001)
    drawn = F.xxhash64(ident, F.lit("sample"))
    return rows.where(F.pmod(drawn, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).orderBy(drawn, ident).limit(at_most)


def drawn_rows(rows: DataFrame, at_most: int, ident: str, text: str) -> DataFrame:
    """At most so many rows, drawn by a hash of id and text; of rows that agree in both one stays, whatever their number.

    The draw itself moves one number a row; texts only move for the rows drawn.
    """
    key = F.xxhash64(F.coalesce(rows[ident].cast("string"), F.lit("")), F.coalesce(rows[text], F.lit("")))
    different = max(1, rows.agg(F.approx_count_distinct(key, 0.02)).first()[0])
    share = min(1.0, 1.2 * at_most / different + 0.001)
    near = F.pmod(F.xxhash64(key, F.lit("draw")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    keys = rows.where(near).select(key.alias("__key")).distinct()
    # at most ``at_most`` numbers
    drawn = F.broadcast(keys.orderBy(F.xxhash64("__key", F.lit("order")), "__key").limit(at_most))
    found = rows.withColumn("__key", key).join(drawn, "__key")
    return found.groupBy("__key").agg(*[F.first(c).alias(c) for c in rows.columns]).drop("__key")


def _gathered(docs: DataFrame, text: str) -> np.ndarray:
    """The statistics of a bounded sample, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, 0):
            found = [statistics(x) for x in part[0].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f.tobytes() for f in found], pa.binary())], ["row"])

    rows = docs.select(text).mapInArrow(frugal(run), "row binary").toArrow()["row"].to_pylist()
    return np.array([np.frombuffer(r, np.float32) for r in rows]).reshape(len(rows), len(statistics(None)))


def train(docs: DataFrame, positives: DataFrame, unlabelled: Column, ident: str = "doc_id", text: str = "text") -> Model | None:
    """``positives`` holds the idents of trusted texts, ``unlabelled`` says which documents may be drawn as unlabelled.

    None without a trusted or an unlabelled text, so also for empty tables. Samples are bounded by ``POSITIVE_ROWS`` and
    ``UNLABELLED_ROWS`` rows; of rows that are equal in id and text one is drawn at most. Null ids are never trusted.
    """
    trusted = first_by_hash(positives.select(ident).dropna().distinct(), ident, POSITIVE_ROWS)
    # at most POSITIVE_ROWS ids
    good = docs.select(ident, text).join(F.broadcast(trusted), ident, "left_semi")
    good = _gathered(drawn_rows(good, POSITIVE_ROWS, ident, text), text)
    web = _gathered(drawn_rows(docs.where(unlabelled).select(ident, text), UNLABELLED_ROWS, ident, text), text)
    return fit(good, web) if len(good) and len(web) else None


def scored(docs: DataFrame, model: Model | None, ident: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """ident, the columns of ``keep``, ``score`` (0 to 1, nearer 1 for good texts) and ``predicted`` (1 from 0.5 on).

    A score depends on the text alone: equal texts score alike, null and empty texts have the score of a text
    without characters, texts of any length are read whole. Without a model every score is 0.5. One row a row, so repeated
    rows stay and an empty table stays empty; columns that ``keep`` doesn't name aren't read, whatever their names.
    """
    names = [ident, *keep]
    types = ", ".join(f"`{n}` {dict(docs.dtypes)[n]}" for n in names)
    parts = model.parts() if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, len(names)):
            texts = part[len(names)].to_pylist()
            if parts is None:
                score = np.full(len(texts), 0.5)
            else:
                mean, spread, weights, bias = parts
                score = sigmoid(standardised(np.array([statistics(x) for x in texts]), mean, spread) @ weights + bias)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    return docs.select(*names, text).mapInArrow(frugal(run), f"{types}, score double, predicted int")
