"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: each task turns its documents into segments of some million words, and stores
for each segment the postings of all its tokens, positions ascending. A phrase is looked up in every segment by
itself: starts from the postings of its rarest word there, shifted by the word's offset, are intersected with the
shifted postings of the next rarer ones until none is left or all words agree. A proximity match needs all words of
the phrase, in any order, inside a stretch of given length. A frequent token has postings in every segment, so no
task sees more of it than its own segment holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, frugal, frugal_group, in_small_batches

WINDOW = 10
#: Words of a segment before it is closed; a document is never cut, so a longer one is a segment by itself.
SEGMENT_WORDS = 2_000_000
#: Rows that a segment holds at most, whether they have words or not.
SEGMENT_ROWS = 500_000
BUCKETS = 64
#: Benchmark words that one pass holds in each task; more are looked up in several passes.
BLOCK_WORDS = 2_000_000
#: A proximity match has its words within this many document words.
NEAR = 15

_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

INDEX_COLUMNS = "segment long, bucket int, keys binary, counts binary, gaps binary"


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters outside ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F``, A to Z lower-cased before; none for a null."""
    return text.encode().translate(_KEEP).split() if text else []


def token_keys(words: Sequence[bytes]) -> np.ndarray:
    """A token is known by 64 bits of its hash."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _planes(numbers: np.ndarray) -> bytes:
    """Little-endian bytes, first all the lowest ones: gaps are small, so the higher planes pack to nothing."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Segment:
    def __init__(self):
        self.vocabulary, self.ids, self.sizes, self.docs, self.words = _Vocabulary(), [], [], [], 0

    def add(self, ident, text: str | None) -> None:
        words = words_of(text)
        self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.uint32, len(words)))
        self.sizes.append(len(words))
        self.docs.append(ident)
        self.words += len(words)

    def rows(self, number: int, ident_type: pa.DataType) -> pa.RecordBatch:
        """One row of the documents (bucket -1) and one of postings for each bucket of token keys."""
        sizes = np.array(self.sizes, np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])  # one free place between documents
        ids = np.concatenate(self.ids)
        places = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
        by_id = np.argsort(ids, kind="stable")
        counts = np.bincount(ids, minlength=len(self.vocabulary))
        first = np.concatenate([[0], np.cumsum(counts)])
        keys = token_keys(list(self.vocabulary))
        out = [(-1, starts.astype("<u4").tobytes(), sizes.astype("<u4").tobytes(), b"", self.docs)]
        buckets = keys % BUCKETS
        order = np.lexsort((keys, buckets))
        cuts = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))
        for b in range(BUCKETS):
            tokens = order[cuts[b] : cuts[b + 1]]
            if not len(tokens):
                continue
            n = counts[tokens]
            heads = np.concatenate([[0], np.cumsum(n)[:-1]])
            spots = np.repeat(first[tokens] - heads, n) + np.arange(n.sum())
            at = places[by_id[spots]]
            gaps = np.diff(at, prepend=0)
            gaps[heads] = at[heads]
            out.append((b, keys[tokens].tobytes(), n.astype("<u4").tobytes(), _planes(gaps), None))
        columns = list(zip(*out, strict=True))
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(ident_type)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip([[number] * len(out), *columns], types, strict=True)],
            ["segment", "bucket", "keys", "counts", "gaps", "docs"],
        )


def build_index(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of the positional index; store them before use, since a segment's number is that of its task."""
    kind = dict(docs.dtypes)[ident]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, segment = TaskContext.get().partitionId() << 24, 0, _Segment()
        for batch in batches:
            ident_type = batch.schema.field(0).type
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                for doc, body in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                    segment.add(doc, body)
                    if segment.words >= SEGMENT_WORDS or len(segment.docs) >= SEGMENT_ROWS:
                        yield segment.rows(base + made, ident_type)
                        made, segment = made + 1, _Segment()
        if segment.docs:
            yield segment.rows(base + made, ident_type)

    return docs.select(ident, text).mapInArrow(frugal(run), f"{INDEX_COLUMNS}, docs array<{kind}>")


def items_of(rows: Sequence[tuple[object, str | None]]) -> list[tuple[object, np.ndarray]]:
    """The items that have words, each with its words as token keys."""
    return [(i, token_keys(words)) for i, text in rows if (words := words_of(text))]


def postings_of(keys: np.ndarray, counts: np.ndarray, gaps: np.ndarray, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Positions of the wanted tokens in one bucket of one segment."""
    heads = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    at = np.searchsorted(keys, wanted)
    at, wanted = at[at < len(keys)], wanted[at < len(keys)]
    hit = keys[at] == wanted
    return {int(k): np.cumsum(gaps[heads[i] : heads[i + 1]].astype(np.int64)) for i, k in zip(at[hit], wanted[hit], strict=True)}


def phrase_starts(lists: Sequence[np.ndarray]) -> np.ndarray:
    """Where the words with these position lists follow each other; rarest lists first."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[order[0]] - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        at = np.searchsorted(lists[i], starts + i)
        at[at == len(lists[i])] = 0
        starts = starts[lists[i][at] == starts + i]
    return starts


def near_stretches(lists: Sequence[np.ndarray], starts: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the shortest stretches that hold a word of every list (any order).

    A stretch has at most ``within`` words and lies in one document; ``starts`` are the documents' first positions.
    """
    order = sorted(lists, key=len)
    anchors = order[0]
    if len(order) == 1:
        return anchors, anchors
    for other in order[1:]:
        if not len(anchors):
            return anchors, anchors
        low = np.searchsorted(other, anchors - within + 1)
        high = np.searchsorted(other, anchors + within - 1, "right")
        anchors = anchors[low < high]
    lasts = np.unique(anchors[:, None] + np.arange(within))  # where a stretch with an anchor may end
    firsts = lasts.copy()
    for other in order:
        at = np.searchsorted(other, lasts, "right") - 1
        firsts = np.minimum(firsts, np.where(at < 0, -within, other[at]))
    fits = (lasts - firsts < within) & (firsts >= starts[np.searchsorted(starts, lasts, "right") - 1])
    firsts, shortest = np.unique(firsts[fits], return_index=True)
    return firsts, lasts[fits][shortest]


def _merged(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    low = high = None
    for a, b in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if high is None or a > high:
            if high is not None:
                yield low, high
            low, high = a, b
        else:
            high = max(high, b)
    if high is not None:
        yield low, high


def _matches(lists: dict[int, np.ndarray], starts: np.ndarray, items: list, window: int, near: int | None) -> Iterator[tuple]:
    """(document's place, item, kind, from, to) with merged spans of words, for one segment."""

    def spans(found: list[tuple[np.ndarray, np.ndarray]], item, kind: str) -> Iterator[tuple]:
        if not found:
            return
        at, end = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = np.searchsorted(starts, at, "right") - 1
        for d in np.unique(doc):
            own = doc == d
            for a, b in _merged(at[own] - starts[d], end[own] - starts[d]):
                yield int(d), item, kind, a, b

    nothing = np.empty(0, np.int64)
    for item, keys in items:
        terms = [lists.get(int(k), nothing) for k in keys]
        here = np.array([len(t) > 0 for t in terms])
        length = min(window, len(keys))
        exact, close = [], []
        for w in range(len(keys) - length + 1):
            if not here[w : w + length].all():
                continue
            at = phrase_starts(terms[w : w + length])
            exact.append((at, at + length))
            if near:
                distinct = {int(k): t for k, t in zip(keys[w : w + length], terms[w : w + length], strict=True)}
                first, last = near_stretches(list(distinct.values()), starts, near)
                close.append((first, last + 1))
        yield from spans(exact, item, "phrase")
        yield from spans(close, item, "near")


def find_matches(index: DataFrame, items: list, item_type: str, window: int = WINDOW, near: int | None = NEAR) -> DataFrame:
    """One row for each merged match: ``row`` (the document), ``item_id``, ``kind``, ``low``, ``high`` (words).

    Postings of words the items don't have are left out before the segments are brought together.
    """
    vocabulary = np.unique(np.concatenate([k for _, k in items])) if items else np.empty(0, np.uint64)
    shared = index.sparkSession.sparkContext.broadcast((items, vocabulary))  # about BLOCK_WORDS words

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value[1]
        for batch in batches:
            for i in range(batch.num_rows):
                if batch["bucket"][i].as_py() < 0:
                    yield batch.slice(i, 1).select(names)
                    continue
                keys = np.frombuffer(batch["keys"][i].as_buffer(), np.uint64)
                keep = np.isin(keys, words)
                if not keep.any():
                    continue
                counts = np.frombuffer(batch["counts"][i].as_buffer(), "<u4")
                gaps = _from_planes(batch["gaps"][i].as_buffer())[np.repeat(keep, counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["segment"].slice(i, 1), batch["bucket"].slice(i, 1), pa.array([keys[keep].tobytes()], pa.binary()),
                        pa.array([counts[keep].tobytes()], pa.binary()), pa.array([_planes(gaps)], pa.binary()),
                    ],
                    names,
                )

    names = ["segment", "bucket", "keys", "counts", "gaps"]

    def look_up(table: pa.Table) -> pa.Table:
        lists: dict[int, np.ndarray] = {}
        starts = np.empty(0, np.int64)
        for row in table.to_pylist():
            keys = np.frombuffer(row["keys"], np.uint64 if row["bucket"] >= 0 else "<u4")
            if row["bucket"] < 0:
                starts = keys.astype(np.int64)
                continue
            lists |= postings_of(keys, np.frombuffer(row["counts"], "<u4"), _from_planes(row["gaps"]), keys)
        segment = table["segment"][0].as_py()
        found = list(_matches(lists, starts, shared.value[0], window, near))
        doc, item, kind, low, high = zip(*found, strict=True) if found else ((),) * 5
        return pa.table(
            {
                "segment": pa.array([segment] * len(doc), pa.int64()), "place": pa.array(doc, pa.int32()), "item_id": pa.array(item, item_arrow),
                "kind": pa.array(kind, pa.string()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()),
            }
        )

    item_arrow = to_arrow_type(T.StructType.fromDDL(f"i {item_type}")[0].dataType)
    matches = (
        index.select(*names).mapInArrow(frugal(wanted), INDEX_COLUMNS)
        .groupBy("segment").applyInArrow(frugal_group(look_up), f"segment long, place int, item_id {item_type}, kind string, low long, high long")
    )
    return matches.select(F.struct("segment", "place").alias("row"), "item_id", "kind", "low", "high")


def index_documents(index: DataFrame, ident: str = "doc_id") -> DataFrame:
    """One row for each document of the index: ``row`` (its segment and place there), its id and ``n_words``."""
    sizes = index.where("bucket < 0").select("segment", F.posexplode("docs").alias("place", ident), "counts")
    # Spark reads the little-endian counts as hex, eight digits a document
    digits = F.hex(F.expr("substring(counts, place * 4 + 1, 4)"))
    size = F.conv(F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")
    return sizes.select(F.struct("segment", "place").alias("row"), ident, size.alias("n_words"))


def item_blocks(benchmark: DataFrame, item: str, text: str, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """The benchmark's different rows in blocks of bounded size, one block on the driver at a time."""
    sized = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull()).distinct()
    letters = sized.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-letters // (2 * block_words)))
    for b in range(blocks):
        rows = sized if blocks == 1 else sized.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        yield [(r["i"], r["t"]) for r in rows.collect()]


@in_small_batches
def decontaminate(
    docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", item: str = "item_id", window: int = WINDOW, near: int | None = NEAR
) -> DataFrame:
    """For every document the benchmark items it has windows of, and how many of its words lie in such windows.

    A window is ``window`` consecutive words of an item; an item with fewer words is one window. Columns: ident,
    ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (of the item ids sorted as strings and comma-joined),
    ``contaminated``, and ``n_near_items``, items with a proximity match that aren't matched as a phrase: all distinct
    words of a window lie, in any order, in a stretch of at most ``near`` words of the document.
    Ids of items are of any type. Null and empty texts have no words and no hits; texts of any length are looked up whole; an item without words has no window; repeated rows each get
    their result, repeated items count once by their id; all items with a null id count as one, which has no name in
    ``items_sha256``; an empty table on either side gives no hits or no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "positions")
    index = scratch.keep(build_index(docs.select(F.col(ident), F.col("text")), ident), "index")
    kind = dict(benchmark.dtypes)[item]
    found = None
    for rows in item_blocks(benchmark, item, "text"):
        block = find_matches(index, items_of(rows), kind, window, near)
        found = block if found is None else found.unionByName(block)
    found = scratch.keep(found, "matches")
    by_start = Window.partitionBy("row").orderBy("low", "high")
    reached = F.max("high").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("high") - F.greatest(F.col("low"), F.coalesce(reached, F.lit(0))))
    phrases = found.where("kind = 'phrase'")
    hits = phrases.withColumn("fresh", fresh).groupBy("row").agg(
        F.sum("fresh").alias("n_hit"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"),
        F.max(F.col("item_id").isNull().cast("long")).alias("nameless"),
    )
    exact = phrases.select(F.col("row").alias("r"), F.col("item_id").alias("i"))
    close = found.where("kind = 'near'").select("row", "item_id").distinct().join(exact, F.expr("row = r AND item_id <=> i"), "left_anti")
    near_items = close.groupBy("row").agg(F.count(F.lit(1)).alias("n_near_items"))
    marks = hits.join(near_items, "row", "full")
    named = F.array_join(F.array_sort(F.coalesce("items", F.array().cast("array<string>"))), ",")
    judged = index_documents(index, ident).join(marks, "row", "left").select(
        ident,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        (F.greatest(F.size("items"), F.lit(0)) + F.coalesce("nameless", F.lit(0))).cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
    )
    return scratch.result(judged)


def items_digest(items: Sequence[object]) -> str:
    """The digest that ``decontaminate`` gives for these items."""
    return sha256(",".join(sorted({str(i) for i in items})).encode()).hexdigest()
