"""Toxicity by a chain of classifiers.

Categories are predicted one after another. Each has a linear model over the words of the text and the probabilities
of the categories before it. In training those probabilities are out-of-fold ones: a row's come from models that haven't
seen it, so that later models learn how far they can be trusted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, byte_slices, frugal
from .quality import descend, drawn_rows, first_by_hash, sigmoid

#: Labelled rows that the chain is fitted on at most, drawn by hash.
TRAIN_ROWS = 12_000
#: Marks of the text that one model weighs.
MARKS = 2_000
#: A mark needs so many labelled texts, and so many standard deviations more of the category than expected.
LEAST_TEXTS, LEAST_SCORE = 4, 4.0
FOLDS = 3
#: Distinct words whose marks a task keeps at hand: of all marks, and of the few that a model weighs.
MEMO_WORDS, MEMO_WANTED = 30_000, 120_000


def marks_of(word: str) -> list[str]:
    """A word without case and marks around it, its beginnings, what trails it, and whether it shouts."""
    core = word.strip("\"'()[]{}<>.,;:!?*#$%&|/\\\\+-_=~^`@")
    low, tail = core.lower(), word[word.find(core) + len(core) :] if core else word
    marks = [f"w {low}", *(f"b {low[:k]}" for k in range(4, 8) if len(low) > k)] if low else []
    if tail.strip(".,;:"):
        marks.append(f"t {tail.rstrip('.,;:')}")
    if len(core) > 2 and core.isupper():
        marks.append("shout")
    return marks


class _Marks(dict):
    """word -> hashes of its marks; only wanted ones, if some are wanted."""

    def __init__(self, wanted: frozenset | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= (MEMO_WORDS if self.wanted is None else MEMO_WANTED):
            self.clear()
        found = tuple(mark_hash(m) for m in marks_of(word))
        self[word] = found = found if self.wanted is None else tuple(h for h in found if h in self.wanted)
        return found

    def of_text(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        found: set[int] = set()
        for word in set(words):
            found.update(self[word])
        if len(words) > 1 and any(a == b for a, b in zip(words, words[1:], strict=False)):
            found.update(h for h in (mark_hash("again"),) if self.wanted is None or h in self.wanted)
        return np.fromiter(found, np.int64, len(found))

    def of_texts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The row and the hash of every mark of the texts."""
        found = [self.of_text(x) for x in texts]
        return np.repeat(np.arange(len(found)), [len(f) for f in found]), np.concatenate([np.empty(0, np.int64), *found])


def mark_hash(mark: str) -> int:
    return xxhash.xxh3_64_intdigest(mark.encode()) >> 1


class Sparse:
    """Rows of present marks, as places in a list of marks."""

    def __init__(self, rows: Sequence[Sequence[int]], width: int):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.row = np.repeat(np.arange(len(rows)), self.sizes)
        self.at = np.fromiter((i for r in rows for i in r), np.int64, int(self.sizes.sum()))
        self.rows, self.width = len(rows), width

    @classmethod
    def placed(cls, rows: int, row: np.ndarray, mark: np.ndarray, marks: Sequence[int]) -> Sparse:
        """Those of the rows' marks that are in the list."""
        known = np.array(marks, np.int64)
        order = np.argsort(known)
        out = cls([], len(known))
        out.rows, out.row, out.at = rows, np.empty(0, np.int64), np.empty(0, np.int64)
        if len(known) and len(mark):
            place = np.minimum(np.searchsorted(known[order], mark), len(known) - 1)
            hit = known[order][place] == mark
            out.row, out.at = row[hit], order[place[hit]]
        return out

    def take(self, keep: np.ndarray) -> Sparse:
        out = Sparse([], self.width)
        number = np.cumsum(keep) - 1
        chosen = keep[self.row]
        out.row, out.at, out.rows = number[self.row[chosen]], self.at[chosen], int(keep.sum())
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, r[self.row], self.width)


def fit_linear(x: Sparse, more: np.ndarray, y: np.ndarray, steps: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Weights of the marks, of the further columns and a bias, by logistic loss."""
    dense = np.hstack([more, np.ones((len(y), 1))])

    def gradient(w: np.ndarray) -> np.ndarray:
        r = (sigmoid(x.times(w[: x.width]) + dense @ w[x.width :]) - y) / max(1, len(y))
        return np.concatenate([x.back(r), dense.T @ r]) + decay * np.append(w[:-1], 0) / 10

    return descend(gradient, x.width + dense.shape[1], steps, 0.1)


def linear(w: np.ndarray, x: Sparse, more: np.ndarray) -> np.ndarray:
    return sigmoid(x.times(w[: x.width]) + more @ w[x.width : -1] + w[-1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit_chain(
    marks: Sequence[Sparse], labels: np.ndarray, fold: np.ndarray, without: Sequence[Sequence[Sparse]] | None = None
) -> list[np.ndarray]:
    """One weight vector a category; marks[c] are the rows' marks for category c, nan in labels is no label.

    ``without[c][f]`` are the marks for a model that hasn't seen fold f, chosen without its labels.
    """
    models, earlier = [], np.empty((len(labels), 0))
    for c, x in enumerate(marks):
        known = ~np.isnan(labels[:, c])

        def fitted(x: Sparse, keep: np.ndarray, c: int = c, earlier: np.ndarray = earlier) -> np.ndarray:
            return fit_linear(x.take(keep), earlier[keep], labels[keep, c])

        models.append(fitted(x, known))
        outside = np.empty(len(labels))
        for f in range(FOLDS):
            of_fold, own = fold == f, without[c][f] if without else x
            if (known & ~of_fold).any():
                outside[of_fold] = linear(fitted(own, known & ~of_fold), own.take(of_fold), earlier[of_fold])
            else:  # nothing is known without this fold
                outside[of_fold] = 0.5
        earlier = np.hstack([earlier, _logit(outside)[:, None]])
    return models


def run_chain(models: Sequence[np.ndarray], marks: Sequence[Sparse]) -> np.ndarray:
    """Probabilities, a column a category."""
    earlier = np.empty((marks[0].rows, 0))
    out = []
    for w, x in zip(models, marks, strict=True):
        out.append(linear(w, x, earlier))
        earlier = np.hstack([earlier, _logit(out[-1])[:, None]])
    return np.column_stack(out)


#: Of which fold the labels are left out; None for all labels.
LEFT_OUT = (None, *range(FOLDS))


def _telling_marks(sample: DataFrame, text: str, categories: Sequence[str], scratch: Scratch) -> list[list[list[int]]]:
    """For each category and each of ``LEFT_OUT`` the marks its texts have more often than expected, the most telling first."""
    kinds = [f"{what}{c}" for c in range(len(categories)) for what in ("seen", "own")]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = _Marks()
        for part in byte_slices(batches, 0):
            row, mark = every.of_texts(part[0].to_pylist())
            marks, place = np.unique(mark, return_inverse=True)
            key = place * FOLDS + part[part.num_columns - 1].to_numpy()[row]
            labels = [np.array([np.nan if x is None else float(x) for x in column.to_pylist()]) for column in part.columns[1:-1]]
            counts = [np.bincount(key, test[row], len(marks) * FOLDS).astype(np.int64) for x in labels for test in (~np.isnan(x), x == 1)]
            held = np.flatnonzero(np.bincount(key, minlength=len(marks) * FOLDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks[held // FOLDS]), pa.array((held % FOLDS).astype(np.int32)), *(pa.array(n[held]) for n in counts)], ["mark", "fold", *kinds]
            )

    rows = sample.select(text, *categories, "__fold").mapInArrow(frugal(counted), ", ".join(["mark long", "fold int", *(f"{x} long" for x in kinds)]))

    def summed(kind: str, left_out: int | None):
        return F.sum(kind) if left_out is None else F.sum(F.when(F.col("fold") != left_out, F.col(kind)).otherwise(0))

    sums = rows.groupBy("mark").agg(*[summed(k, f).alias(f"{k}_{f}") for k in kinds for f in LEFT_OUT])
    sums = scratch.keep(sums.where(" or ".join(f"own{c}_None >= {LEAST_TEXTS}" for c in range(len(categories)))), "marks")
    shares = sample.agg(*[F.avg(F.when(F.col("__fold") != -1 if f is None else F.col("__fold") != f, F.col(c))).alias(f"{c}_{f}") for c in categories for f in LEFT_OUT]).first()
    found = []
    for c, name in enumerate(categories):
        found.append([])
        for f in LEFT_OUT:
            own, expected = F.col(f"own{c}_{f}"), F.col(f"seen{c}_{f}") * F.lit(float(shares[f"{name}_{f}"] or 0.0))
            score = (own - expected) / F.sqrt(expected + 0.1)
            best = sums.where(own >= LEAST_TEXTS).select("mark", score.alias("score")).where(F.col("score") >= LEAST_SCORE)
            found[c].append([r["mark"] for r in best.orderBy(F.desc("score"), "mark").limit(MARKS).collect()])
    return found


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str], ident: str = "doc_id", text: str = "text"):
    """The chain's marks and models, from at most ``TRAIN_ROWS`` labelled rows; None without any.

    Of rows that are equal in id and text one is used; a label counts for every text of its id; of several labels of an id any
    one does. Null ids have no label, empty tables give no chain, other columns aren't read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    chosen = first_by_hash(labels.select(ident, *categories).dropna(subset=[ident]).dropDuplicates([ident]), ident, TRAIN_ROWS)
    fold = F.pmod(F.xxhash64(ident, F.lit("fold")), F.lit(FOLDS)).cast("int")
    # at most TRAIN_ROWS ids with their labels
    labelled = docs.select(ident, text).join(F.broadcast(chosen), ident)
    sample = drawn_rows(labelled, TRAIN_ROWS, ident, text).select(text, *categories, fold.alias("__fold"))
    sample = scratch.keep(sample.repartition(16), "sample")
    telling = _telling_marks(sample, text, categories, scratch)
    wanted = frozenset(m for of_category in telling for marks in of_category for m in marks)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Marks(wanted)
        for part in byte_slices(batches, 0):
            found = [known.of_text(x) for x in part[0].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), *part.columns[1:]], ["found", *part.schema.names[1:]])

    types = ", ".join(f"`{c}` {dict(sample.dtypes)[c]}" for c in categories)
    rows = sample.select(text, *categories, "__fold").mapInArrow(frugal(present), f"found array<long>, {types}, __fold int").toArrow()
    scratch.drop()
    if not rows.num_rows:
        return None
    found = rows["found"].combine_chunks()
    row, mark = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy())), found.flatten().to_numpy()
    placed = [[Sparse.placed(len(found), row, mark, marks) for marks in of_category] for of_category in telling]
    known = np.array([[np.nan if x is None else float(x) for x in rows[c].to_pylist()] for c in categories]).T
    models = fit_chain([p[0] for p in placed], known, rows["__fold"].to_numpy(), [p[1:] for p in placed])
    return [of_category[0] for of_category in telling], models


def classified(docs: DataFrame, chain, categories: Sequence[str], text: str = "text", prefix: str = "p_") -> DataFrame:
    """``docs`` with ``p_<category>`` for every category of the chain.

    A null or empty text has no marks and gets the probabilities of a text without any; equal texts get equal ones, also
    those of repeated rows; texts of any length are read whole; without a chain all probabilities are null; an empty
    table stays empty. Columns of ``docs`` that have the results' names are replaced, all others stay.
    """
    names = [f"{prefix}{c}" for c in categories]
    if chain is None:
        return docs.withColumns({n: F.lit(None).cast("double") for n in names})
    telling, models = chain

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Marks(frozenset(m for marks in telling for m in marks))
        for texts in batches:
            found = [np.empty((0, len(names)))]
            for part in byte_slices([pa.RecordBatch.from_arrays([texts], ["text"])], 0):
                row, mark = known.of_texts(part[0].to_pylist())
                found.append(run_chain(models, [Sparse.placed(part.num_rows, row, mark, marks) for marks in telling]))
            p = np.concatenate(found)
            yield pa.StructArray.from_arrays([pa.array(p[:, c]) for c in range(len(names))], names)

    scored = F.arrow_udf(frugal(run), ", ".join(f"`{n}` double" for n in names))
    return docs.withColumn("__p", scored(F.col(text))).withColumns({n: F.col(f"__p.`{n}`") for n in names}).drop("__p")
