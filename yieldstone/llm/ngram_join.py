"""Set-similarity self-join on word shingles, by prefixes with token combinations.

All tokens (shingles) are put in one order: rare ones first, then frequent ones, each by hash. Two sets with
Jaccard similarity of 0.8 or more must agree in some tokens among the first ones of both. A rare token in a prefix is
indexed by itself. Frequent tokens are dealt into partitions and indexed by combinations of two in one partition;
each partition can hide one common token without a common combination, so the prefix is extended by as many
tokens as it touches partitions of frequent ones (k-wise signatures with token classes, Wang et al. 2016).
Sets that share an index entry are compared exactly.

Equal sets are one node from the start. Components need no comparison inside what is known to hang together: in turns
every node is compared with a few others that it shares entries with, as long as that shrinks what is left; then all
nodes that share an entry across components are. Sketches of two bits a token refuse nearly all other pairs
without moving the sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, frugal, frugal_group, in_small_batches
from .components import connected
from .shingles import Shingler, mixed, set_digest

#: A token is frequent from so many sets on.
FREQUENT = 16
#: Frequent tokens known to every task, 8 bytes each; beyond that the most frequent ones. Which tokens count as
#: frequent only moves work, every choice gives the same links.
MAX_FREQUENT = 1_000_000
#: Tokens that one task counts or matches together: a range of their hashes, narrower the more there are.
TOKENS_A_BUCKET = 2_000_000
LEAST_BUCKET_BITS = 8
#: Bits of the filter that spares the last pass over the texts most documents; fixed, and free of wrong misses.
FILTER_BITS = 1 << 24
#: Other nodes that a node is compared with in one turn, before what is left is compared completely.
PARTNERS = 8
#: Postings that a task gathers before it hands them on.
FLUSH = 500_000


def required(n: int) -> int:
    """Tokens of a set of n from which, in the common order, a similar set must have one."""
    return n - (4 * n + 4) // 5 + 1


def bands(n: int) -> range:
    """Classes of size in which a set of n may meet a similar one: that of the larger of the two."""
    return range(n.bit_length() - 1, (5 * n // 4).bit_length())


def partitions(band: int) -> int:
    return max(1, (1 << band) // 8)


def index_entries(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rare tokens to be indexed by themselves, entries of the other kinds, and the places of the latter.

    An entry's place is how many tokens the set may lack, with all entries up to there, before a similar set must have
    one: 1, 2, 3 ... for rare tokens, and one more with each token that makes a new combination.
    """
    n = len(tokens)
    need = required(n)
    rare, common = tokens, tokens[:0]
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        often = frequent[at] == tokens
        rare, common = tokens[~often], tokens[often]
    if len(rare) >= need:
        return rare[:need], tokens[:0], tokens[:0].astype(np.int32)
    other, places = [], []
    for band in bands(n):
        left, m = need - len(rare), np.uint64(partitions(band))
        part = common % m
        first = np.zeros(len(common), bool)
        first[np.unique(part, return_index=True)[1]] = True
        reached = np.cumsum(~first)
        take = int(np.searchsorted(reached, left)) + 1  # there are enough: partitions hide n / 8 tokens at most
        prefix, part, place = common[:take], part[:take], len(rare) + reached[:take]
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for own in np.split(order, cuts):
            i, j = np.triu_indices(len(own), 1)
            other.append(mixed(mixed(prefix[own[i]] + np.uint64(band)) ^ prefix[own[j]]))
            places.append(place[own[j]])
    entries, places = np.concatenate(other), np.concatenate(places).astype(np.int32)
    order = np.lexsort((places, entries))
    first = np.concatenate([[True], np.diff(entries[order]) > 0])
    return rare, entries[order[first]], places[order[first]]


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as gaps, byte planes apart, so that compression finds the empty high bytes."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, byte planes apart."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            yield part, part[column].to_pylist()


def _bucket_bits(docs: DataFrame, text: str) -> int:
    """So many leading bits of a hash that a bucket holds about ``TOKENS_A_BUCKET`` tokens; a token has six bytes at least."""
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(LEAST_BUCKET_BITS, (size // (6 * TOKENS_A_BUCKET)).bit_length())


def _by_bucket(tokens: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of ascending tokens: a bucket is a range of the hash."""
    bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(tokens)]]).tolist()
    return ((int(bucket[a]), slice(a, b)) for a, b in zip(cuts, cuts[1:], strict=False))


def frequent_tokens(docs: DataFrame, text: str, size: int, bits: int) -> np.ndarray:
    """Tokens of at least ``FREQUENT`` sets, ascending. Tasks send each distinct token once, with its count."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, gathered, held, seen = Shingler(size), [], 0, set()

        def flush() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(gathered), return_counts=True)
            rows = [(b, _packed(tokens[s]), np.minimum(counts[s], 65535).astype("<u2").tobytes()) for b, s in _by_bucket(tokens, bits)]
            types = (pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["bucket", "tokens", "counts"])

        for _, texts in _texts(batches, 0):
            for tokens in shingle(texts):
                if len(tokens) < 2 or (digest := set_digest(tokens)) in seen:
                    continue
                seen.add(digest)
                gathered.append(tokens)
                held += len(gathered[-1])
                if held >= FLUSH:
                    yield flush()
                    gathered, held, seen = [], 0, set()
        if held:
            yield flush()

    def total(table: pa.Table) -> pa.Table:
        tokens = np.concatenate([_unpacked(x) for x in table["tokens"].to_pylist()])
        counts = np.concatenate([np.frombuffer(x, "<u2") for x in table["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        sums = np.add.reduceat(counts, heads)
        keep = sums >= FREQUENT
        return pa.table({"token": pa.array(tokens[heads][keep].view(np.int64)), "sets": pa.array(sums[keep])})

    found = docs.select(text).mapInArrow(frugal(local), "bucket int, tokens binary, counts binary").groupBy("bucket").applyInArrow(frugal_group(total), "token long, sets long")
    most = found.orderBy(F.desc("sets"), "token").limit(MAX_FREQUENT).select("token").toArrow()
    return np.sort(most["token"].to_numpy().view(np.uint64))


def _index_pass(docs: DataFrame, ident: str, text: str, size: int, bits: int, frequent: np.ndarray) -> DataFrame:
    """A row (ident, node, n, sketch, entries) for each document, and postings of rare tokens by bucket.

    Of equal sets that a task meets before it hands its postings on, one carries sketch, entries and postings.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MAX_FREQUENT numbers
    kind = dict(docs.dtypes)[ident]
    names = ["ident", "node", "n", "sketch", "entries", "entry_places", "bucket", "tokens", "places", "owners", "nodes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, often = Shingler(size), known.value
        gathered, held, seen = [], 0, {}

        def flush(ident_type: pa.DataType) -> pa.RecordBatch:
            tokens, sizes = np.concatenate(gathered), [len(g) for g in gathered]
            owners = np.repeat(np.arange(len(gathered), dtype=np.uint32), sizes)
            places = np.concatenate([np.arange(1, size + 1, dtype=np.uint32) for size in sizes])
            order = np.argsort(tokens, kind="stable")
            tokens, owners, places = tokens[order], owners[order], places[order]
            nodes = np.array([(k, n) for k, n in seen.items()], np.int64)
            out = []
            for b, s in _by_bucket(tokens, bits):
                used, local = np.unique(owners[s], return_inverse=True)
                out.append((b, _packed(tokens[s]), _planes(places[s]), _planes(local), nodes[used].tobytes()))
            columns = list(zip(*out, strict=True))
            empty = [pa.nulls(len(out), t) for t in (ident_type, pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))]
            blobs = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 4), strict=True)]
            return pa.RecordBatch.from_arrays(empty + blobs, names)

        for part, texts in _texts(batches, 1):
            nodes, sizes, sketches, entries, places = [], [], [], [], []
            for tokens in shingle(texts):
                nodes.append(set_digest(tokens))
                sizes.append(len(tokens))
                sketches.append(None)
                entries.append(tokens[:0])
                places.append(np.empty(0, np.int32))
                if len(tokens) < 2 or nodes[-1] in seen:
                    continue
                sketches[-1] = _sketch(tokens)
                rare, entries[-1], places[-1] = index_entries(tokens, often)
                seen[nodes[-1]] = len(tokens)
                gathered.append(rare.copy())
                held += len(rare)
            ends = np.concatenate([[0], np.cumsum([len(e) for e in entries])])
            values = (np.concatenate(entries).view(np.int64), np.concatenate(places))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v)) for v in values]
            empty = [pa.nulls(len(texts), t) for t in (pa.int32(), *[pa.binary()] * 4)]
            known_of = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([part[0], *known_of, *lists, *empty], names)
            if held >= FLUSH:
                yield flush(part[0].type)
                gathered, held, seen = [], 0, {}
        if held:
            yield flush(part[0].type)

    shape = f"ident {kind}, node long, n int, sketch binary, entries array<long>, entry_places array<int>, "
    shape += "bucket int, tokens binary, places binary, owners binary, nodes binary"
    return docs.select(ident, text).mapInArrow(frugal(run), shape)


def _shared_rare(postings: DataFrame) -> DataFrame:
    """(entry, node, n, place) for rare tokens that two nodes have. A bucket is an even share of the hash range."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        tokens = np.concatenate([_unpacked(r["tokens"]) for r in rows])
        places = np.concatenate([_from_planes(r["places"]) for r in rows])
        owners = np.concatenate([np.frombuffer(r["nodes"], np.int64).reshape(-1, 2)[_from_planes(r["owners"])] for r in rows])
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        same = tokens[1:] == tokens[:-1]
        multi = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        tokens, kept = tokens[multi], order[multi]
        columns = (tokens.view(np.int64), owners[kept, 0], owners[kept, 1].astype(np.int32), places[kept].astype(np.int32))
        return pa.table(dict(zip(("entry", "node", "n", "place"), map(pa.array, columns), strict=True)))

    return postings.groupBy("bucket").applyInArrow(frugal_group(run), "entry long, node long, n int, place int")


def _may_meet(x: str, y: str) -> Column:
    """Whether an entry can be the first one that two similar sets share: neither may lack that many tokens by then."""
    least = F.expr(f"(4 * ({x}n + {y}n) + 8) div 9")  # tokens that sets of these sizes must share
    return (F.col(f"{x}place") + least <= F.col(f"{x}n") + 1) & (F.col(f"{y}place") + least <= F.col(f"{y}n") + 1)


def _usable(entries: DataFrame) -> DataFrame:
    """Rows that can meet another row of their entry as the first entry that two similar sets share.

    Of two such sets the one with fewer tokens, n, may lack a ninth of them by then, as both must share 8 n / 9 at least.
    The other must allow it with the smallest of those.
    """
    lesser = F.col("place") * 9 <= F.col("n") + 9
    least = entries.groupBy("entry").agg(F.min(F.when(lesser, F.col("n"))).alias("least_n"), F.count(F.lit(1)).alias("rows"))
    joined = entries.join(least.where("rows > 1 AND least_n IS NOT NULL"), "entry")
    fits = F.expr("place + (4 * (n + least_n) + 8) div 9 <= n + 1")
    return joined.where(lesser | fits).select("entry", "node", "n", "place")


def _sketch(tokens: np.ndarray) -> bytes:
    """A bit for each token, in a power of two of bits, at least two a token."""
    bits = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[tokens & np.uint64(bits - 1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _may_link(a: bytes, b: bytes, na: int, nb: int) -> bool:
    """False if the sketches prove that too many tokens of one set are not in the other."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    most = min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))
    return 5 * most >= 4 * (na + nb - most)


def _is_link(a: bytes, b: bytes, na: int, nb: int) -> bool:
    both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
    return 100 * both >= 80 * (na + nb - both)


def _tested(pairs: DataFrame, sets: DataFrame, column: str, test: Callable[[bytes, bytes, int, int], bool]) -> DataFrame:
    """The pairs (a, b) whose two sets pass the test; a node with many pairs is split by the join's skew handling."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col(column).alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col(column).alias("xb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch["xa"], batch["xb"], batch["na"].to_pylist(), batch["nb"].to_pylist())
            keep = [test(x.as_buffer(), y.as_buffer(), m, n) for x, y, m, n in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return joined.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(frugal(run), "a long, b long")


def _sets_of(docs: DataFrame, ident: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(node, n, tokens) of the wanted nodes (``node`` and the ``ident`` of a document that has it)."""
    word = F.shiftright(F.pmod(F.xxhash64("ident"), F.lit(FILTER_BITS)), 6)
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(ident), {FILTER_BITS}) & 63 as int))")
    rows = wanted.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    flags = docs.sparkSession.sparkContext.broadcast(words)  # FILTER_BITS bits, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, known = Shingler(size), flags.value
        for batch in batches:
            at = batch[0].to_numpy().astype(np.int64) % FILTER_BITS
            hit = (known[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            few = batch.filter(pa.array(hit.astype(bool)))
            for part, texts in _texts([few], 1):
                sets = list(shingle(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_digest(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["node", "n", "tokens"],
                )

    found = docs.select(F.xxhash64(ident).alias("h"), text).mapInArrow(frugal(run), "node long, n int, tokens binary")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _partners(rows: DataFrame, turn: int, tested: DataFrame | None) -> DataFrame:
    """For every node in open entries up to ``PARTNERS`` nodes of other parts to be compared with.

    Each node of an entry is paired with the one of the lowest place, which has the fewest tokens of its own and so the
    best chances; in later turns with the lowest of a small lot of the entry's nodes, dealt anew each time. The nodes
    met most often are taken. Work is linear in the rows, and a lot's choice is made before the shuffle.
    """
    lots = F.greatest(F.expr("size div 8"), F.lit(1)) if turn else F.lit(1)
    dealt = rows.withColumn("lot", F.pmod(F.xxhash64("node", F.lit(turn)), lots))
    names = ("place", "node", "n", "part")
    draw = F.struct(*[F.col(c).alias(f"y_{c}") for c in names])
    chosen = dealt.groupBy("entry", "lot").agg(F.min(draw).alias("c")).select("entry", "lot", "c.*")
    met = (
        dealt.select("entry", "lot", *[F.col(c).alias(f"x_{c}") for c in names])
        .join(chosen, ["entry", "lot"]).where("x_part <> y_part").where(_may_meet("x_", "y_"))
        .groupBy("x_node", "y_node").agg(F.count(F.lit(1)).alias("times"))
    )
    # a node meets at most one other in each of its entries, which its prefix bounds
    best = F.slice(F.sort_array(F.collect_list(F.struct("times", "y_node")), False), 1, PARTNERS)
    pairs = met.groupBy("x_node").agg(best.alias("best")).select("x_node", F.explode("best.y_node").alias("y_node"))
    pairs = pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


@in_small_batches
def similar_components(docs: DataFrame, ident: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """``ident``, ``n_shingles``, ``component_id``: the least ident reachable over links of similarity 0.8 or more.

    A text with fewer than ``size`` words is one shingle. Null, empty and wordless texts have none, are linked with
    nothing and keep their own ident. Equal texts are linked; each row of ``docs`` gives one row, repeated rows
    included; rows with a null ident count as documents, but a component's id is null only if all its idents are.
    An empty table gives no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "similar")
    bits = _bucket_bits(docs, text)
    frequent = frequent_tokens(docs, text, size, bits)
    indexed = scratch.keep(_index_pass(docs, ident, text, size, bits, frequent), "index")
    members = indexed.where("bucket IS NULL").select("ident", "node", "n", "entries", "entry_places")
    postings = indexed.where("bucket IS NOT NULL").select("bucket", "tokens", "places", "owners", "nodes")
    pairs_of = F.explode(F.arrays_zip(F.col("entries").alias("entry"), F.col("entry_places").alias("place")))
    others = members.where("size(entries) > 0").select(pairs_of.alias("e"), "node", "n")
    entries = _shared_rare(postings).unionByName(others.select("e.entry", "node", "n", "e.place"))
    entries = scratch.keep(_usable(entries.groupBy("entry", "node", "n").agg(F.min("place").alias("place"))), "entries")

    holders = members.groupBy("node").agg(F.min("ident").alias("ident"))
    sketches = indexed.where("sketch IS NOT NULL").select("node", "n", "sketch").dropDuplicates(["node"])

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are links; sets are made again for the nodes only whose sketches allow one."""
        likely = scratch.keep(_tested(pairs, sketches, "sketch", _may_link), f"{name}-likely")
        ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        wanted = scratch.keep(holders.join(ends, "node"), f"{name}-wanted")
        sets = scratch.keep(_sets_of(docs, ident, text, size, wanted), f"{name}-sets")
        return scratch.keep(_tested(likely, sets, "tokens", _is_link), name)

    def with_parts(fresh: DataFrame, parts: DataFrame | None) -> DataFrame:
        """New links together with what is known to hang together, a link from each node to its part."""
        return fresh if parts is None else fresh.union(parts.select("node", "component"))

    def open_rows(parts: DataFrame | None) -> DataFrame:
        """Entries that still hold nodes of several parts, each row with its part, the entry's size and main part."""
        if parts is None:
            placed = entries.withColumn("part", F.col("node"))
        else:
            placed = entries.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
        held = placed.groupBy("entry", "part").agg(F.count(F.lit(1)).alias("held"))
        split = held.groupBy("entry").agg(
            F.max_by("part", F.struct("held", "part")).alias("main"), F.sum("held").alias("size"), F.max("held").alias("most")
        )
        return placed.join(split.where("size > most"), "entry").withColumn("rest", F.col("size") - F.col("most"))

    tested = parts = None
    before = turn = 0
    while True:
        rows = scratch.keep(open_rows(parts), f"open{turn}")
        # rows that a join of the smaller parts with all others would make
        work, count = rows.agg(F.sum(F.when(F.col("part") != F.col("main"), F.col("size"))), F.count(F.lit(1))).first()
        if not count or (turn and (work <= 4 * count or work > before / 2)):
            break
        pairs = scratch.keep(_partners(rows, turn, tested), f"partners{turn}")
        fresh = links(pairs, f"links{turn}")
        tested = pairs if tested is None else scratch.keep(tested.union(pairs), f"tested{turn}")
        parts = scratch.keep(connected(with_parts(fresh, parts), scratch), f"parts{turn}")
        before, turn = work, turn + 1
    here = rows.select("entry", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "place", "part")])
    there = rows.where("part <> main").select("entry", *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "place", "part")])
    across = (
        here.join(there, "entry").where("x_part <> y_part").where(_may_meet("x_", "y_"))
        .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    )
    if tested is not None:
        across = across.join(tested, ["a", "b"], "left_anti")
    last = links(scratch.keep(across, "across"), "links-across")
    parts = connected(with_parts(last, parts), scratch)

    nodes = members.join(parts, "node", "left").select("ident", "node", "n", F.coalesce("component", "node").alias("part"))
    least = nodes.where("n > 0").groupBy("part").agg(F.min("ident").alias("least"))
    whole = nodes.join(least, "part", "left").select(
        F.col("ident").alias(ident),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("ident")).alias("component_id"),
    )
    return scratch.result(whole)
