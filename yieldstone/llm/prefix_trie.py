"""The trie of conversation prefixes by truncation peeling.

Peeling starts at the greatest depth: conversations that end there are grouped by their turns, each group is a node, the
last turn is stripped, and the nodes join the conversations that end one turn earlier. Counts and sums of a subtree go
along, so a node is complete as soon as it is found.

Conversations are sorted by their turns first and cut into slices, and each slice is peeled by itself. All members of a node
stand next to each other, so only nodes on the path of a slice's first or last conversation can go on in another slice.
These paths, two a slice, are peeled again in the same way, until one slice holds them all. A node that any share of all
conversations goes through is thus summed up in every slice and never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b, sha256
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, frugal
from .shingles import mixed

#: Turns that a slice holds, unless fewer than ``SLICE_ROWS`` conversations have more.
SLICE_TURNS = 500_000
SLICE_ROWS = 16
#: Bytes that a turn is known by.
DIGEST = 16
NOTHING = sha256(b"").hexdigest()

#: What is summed up for a node from the members and finished subtrees that a slice has of it.
SUMS = ("n_convs", "n_children", "n_leaves", "saved")
_KINDS = pa.schema(
    [("kind", pa.string()), ("slice", pa.int64()), ("edge", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64())]
    + [("parent_conv_id", pa.int64()), ("parent_edge", pa.int32())]
    + [(name, pa.int64()) for name in SUMS]
    + [("key", pa.string()), ("said", pa.string()), ("path", pa.binary())]
    + [(name, pa.list_(pa.int64())) for name in ("chars", "least", *(f"each_{n}" for n in SUMS))]
    + [("keys", pa.list_(pa.string()))]
)
_SHAPE = (
    "kind string, slice long, edge int, depth long, conv_id long, parent_conv_id long, parent_edge int, n_convs long, n_children long, "
    "n_leaves long, saved long, key string, said string, path binary, chars array<long>, least array<long>, each_n_convs array<long>, "
    "each_n_children array<long>, each_n_leaves array<long>, each_saved array<long>, keys array<string>"
)


def conversations_of(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, an array of (turn, digest, chars) in order, from rows of conv_id, turn, role and text.

    A null turn comes first, ties go by a digest of role and text, which are empty where null; repeated rows all stay. Rows
    with a null conv_id belong to no conversation and are left out. A conversation is held as about 50 bytes a turn by
    one task, its texts aren't.
    """
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    row = F.struct(
        turns["turn"].cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    told = turns.where(turns["conv_id"].isNotNull())
    return told.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("turns"))


class Slice:
    """Paths in the order of their turns, and what each adds to the nodes on it.

    ``sums[name][k]`` and ``least[k]`` belong to place k; row i has a place for each depth from 0 to its number of turns,
    the first at ``at[i]``. A place without members adds nothing.
    """

    def __init__(self, sizes: np.ndarray, path: bytes, chars: np.ndarray):
        self.sizes, self.path = sizes, path
        self.at = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.turn_at = np.concatenate([[0], np.cumsum(sizes)])
        self.row = np.repeat(np.arange(len(sizes)), sizes + 1)
        self.depth = np.arange(self.at[-1]) - self.at[self.row]
        self.chars = np.zeros(self.at[-1], np.int64)
        self.chars[self.depth > 0] = chars
        self.name = self._names()

    def _names(self) -> np.ndarray:
        """A number for every place that tells its path from the next row's, made turn by turn."""
        halves = np.frombuffer(self.path, "<u8").reshape(-1, 2)
        own = np.zeros(len(self.chars), np.uint64)
        own[self.depth > 0] = mixed(halves[:, 0]) ^ halves[:, 1]
        by_depth = np.argsort(self.depth, kind="stable")
        ends = np.cumsum(np.bincount(self.depth))
        for low, high in zip(ends, ends[1:], strict=False):
            here = by_depth[low:high]
            own[here] = mixed(own[here - 1] * np.uint64(31) + own[here])
        return own

    def with_ends(self, conv_ids: np.ndarray) -> Slice:
        """Every path is a conversation that ends with it."""
        last = self.at[1:] - 1
        self.least = np.full(len(self.chars), np.iinfo(np.int64).max)
        self.least[last] = conv_ids
        self.sums = {name: np.zeros(len(self.chars), np.int64) for name in SUMS}
        self.sums["n_convs"][last] = 1
        return self

    def peel(self, whole: bool):
        """Complete nodes as arrays, and the open ones on the first and last path (0 and 1) as lists.

        Nodes are (depth, rows, least, parents' least, parents' edge or -1, sums); open ones (depth, edge, row, least, sums).
        ``whole`` says that no other slice has members of these nodes.
        """
        adding = np.flatnonzero(self.sums["n_convs"] > 0)
        adding = adding[np.argsort(self.depth[adding], kind="stable")]
        bounds = np.searchsorted(self.depth[adding], np.arange(int(self.sizes.max()) + 2))
        none = np.empty(0, np.int64)
        rows, least, up, closed = none, none, {name: none for name in SUMS}, none.astype(bool)
        own, nodes, opened = None, [], []
        for depth in range(int(self.sizes.max()), -1, -1):
            ended = adding[bounds[depth] : bounds[depth + 1]]
            both = np.concatenate([self.row[ended], rows])
            if not len(both):
                continue  # only paths that add nothing are that long
            order = np.argsort(both, kind="stable")
            both = both[order]
            name = self.name[self.at[both] + depth]
            starts = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
            group = np.empty(len(both), np.int64)
            group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(both))))
            first = both[starts]
            here = np.minimum.reduceat(np.concatenate([self.least[ended], least])[order], starts)
            sums = {n: np.add.reduceat(np.concatenate([self.sums[n][ended], up[n]])[order], starts) for n in SUMS}
            edge = np.full(len(starts), -1)
            if not whole:
                for side, row in ((1, len(self.sizes) - 1), (0, 0)):
                    if self.sizes[row] >= depth:
                        edge[name[starts] == self.name[self.at[row] + depth]] = side
            if own is not None:  # the nodes one turn deeper now know their parent
                parent = group[len(ended) :]
                nodes.append((depth + 1, rows[closed], least[closed], here[parent][closed], edge[parent][closed], {n: own[n][closed] for n in SUMS}))
            closed = edge < 0
            opened += [(depth, int(edge[i]), int(first[i]), int(here[i]), {n: int(sums[n][i]) for n in SUMS}) for i in np.flatnonzero(~closed)]
            own = sums | {
                "n_leaves": np.where(sums["n_children"] > 0, sums["n_leaves"], 1),
                "saved": sums["saved"] + (sums["n_convs"] - 1) * self.chars[self.at[first] + depth],
            }
            rows, least = first, here
            # what an open node has stays on its path until the next peeling
            up = {n: np.where(closed, own[n], 0) for n in SUMS} | {"n_children": closed.astype(np.int64)}
        no_parent = np.zeros(int(closed.sum()), np.int64)
        nodes.append((0, rows[closed], least[closed], None, no_parent - 1, {n: own[n][closed] for n in SUMS}))
        return nodes, opened


def _keys_of(path: bytes) -> list[str]:
    """A digest for each beginning of the path, from the empty one on."""
    keys = [""]
    for at in range(0, len(path), DIGEST):
        keys.append(blake2b(keys[-1].encode() + path[at : at + DIGEST], digest_size=DIGEST).hexdigest())
    return keys


def _ends(slice_: Slice, conv_ids: np.ndarray) -> dict[int, str]:
    """Of each run of equal paths: its first row, and the run's conv_ids, which ascend."""
    name = slice_.name[slice_.at[1:] - 1]
    fresh = np.concatenate([[True], (name[1:] != name[:-1]) | (slice_.sizes[1:] != slice_.sizes[:-1])])
    starts = np.flatnonzero(fresh).tolist()
    ids = conv_ids.tolist()
    return {low: ",".join(map(str, ids[low:high])) for low, high in zip(starts, [*starts[1:], len(ids)], strict=True)}


def _table(**columns) -> pa.RecordBatch:
    n = next(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if columns.get(f.name) is None else pa.array(columns[f.name], f.type) for f in _KINDS], schema=_KINDS
    )


def _peeled(rows: pa.Table, number: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Complete nodes, the two paths with open nodes, and the conv_ids that end at open nodes."""
    blobs = rows["path"].to_pylist()
    slice_ = Slice(np.array([len(b) // DIGEST for b in blobs], np.int64), b"".join(blobs), _flat(rows["chars"]))
    at_start = "conv_id" in rows.schema.names
    said: dict[int, str] = {}
    if at_start:
        conv_ids = rows["conv_id"].to_numpy()
        slice_.with_ends(conv_ids)
        said = _ends(slice_, conv_ids)
    else:
        slice_.least = _flat(rows["least"])
        slice_.sums = {n: _flat(rows[f"each_{n}"]) for n in SUMS}
        keys = rows["keys"].to_pylist()
    nodes, opened = slice_.peel(whole)
    for depth, first, least, parent, edge, sums in nodes:
        for low in range(0, len(first), 50_000):
            part = slice(low, low + 50_000)
            rows_here = first[part].tolist()
            if at_start:
                sizes = slice_.sizes[first[part]]
                ends = [sha256(said[r].encode()).hexdigest() if size == depth else NOTHING for r, size in zip(rows_here, sizes, strict=True)]
                named = None
            else:
                ends, named = None, [keys[r][depth] for r in rows_here]
            known = edge[part] < 0
            yield _table(
                kind=["node"] * len(rows_here), slice=[number] * len(rows_here), depth=[depth] * len(rows_here), conv_id=least[part],
                parent_conv_id=None if parent is None else pa.array(parent[part], pa.int64(), mask=~known),
                parent_edge=pa.array(edge[part].astype(np.int32), pa.int32(), mask=known),
                said=ends, key=named, **{n: sums[n][part] for n in SUMS},
            )
    if whole:
        return
    edges = {side: (row, _keys_of(blobs[row]) if at_start else keys[row]) for side, row in ((0, 0), (1, len(blobs) - 1))}
    least = {side: [np.iinfo(np.int64).max] * (slice_.sizes[row] + 1) for side, (row, _) in edges.items()}
    each = {side: {n: [0] * (slice_.sizes[row] + 1) for n in SUMS} for side, (row, _) in edges.items()}
    for depth, side, _, smallest, sums in opened:
        least[side][depth] = smallest
        for n in SUMS:
            each[side][n][depth] = sums[n]
    sides = [0, 1] if len(blobs) > 1 else [0]
    yield _table(
        kind=["edge"] * len(sides), slice=[number] * len(sides), edge=sides, path=[blobs[edges[s][0]] for s in sides], keys=[edges[s][1] for s in sides],
        chars=[slice_.chars[slice_.at[edges[s][0]] + 1 : slice_.at[edges[s][0] + 1]] for s in sides],
        least=[least[s] for s in sides], **{f"each_{n}": [each[s][n] for s in sides] for n in SUMS},
    )
    if at_start:
        here = [(edges[side][1][depth], smallest, said[row]) for depth, side, row, smallest, _ in opened if slice_.sizes[row] == depth]
        if here:
            first_ids = [int(x.partition(",")[0]) for _, _, x in here]
            yield _table(kind=["ends"] * len(here), slice=[number] * len(here), key=[k for k, _, _ in here], conv_id=first_ids, said=[x for _, _, x in here])


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in lists.chunks]).astype(np.int64)


def _cut(batches: Iterator[pa.RecordBatch], turns: int, whole: bool) -> Iterator[pa.Table]:
    """The sorted rows of a task as slices of about so many turns."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        sizes = pc.binary_length(batch["path"]).to_numpy(zero_copy_only=False).astype(np.int64) // DIGEST + 1
        low = 0
        while low < len(sizes):
            room = np.searchsorted(np.cumsum(sizes[low:]), turns - size) if not whole else len(sizes)
            high = min(len(sizes), low + max(1, int(room), SLICE_ROWS - rows))
            held.append(batch.slice(low, high - low))
            rows, size, low = rows + high - low, size + int(sizes[low:high].sum()), high
            if size >= turns and rows >= SLICE_ROWS and not whole:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _round(rows: DataFrame, parts: int, turns: int, order: list[str], whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, table in enumerate(_cut(batches, turns, whole)):
            yield from _peeled(table, task + number, whole)

    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(frugal(run), _SHAPE)


def _ends_digests(pieces: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256`` of nodes whose ended conversations lie in several slices: one stream a node.

    A digest is made from the first to the last id, so a node's pieces, one a slice, are read in order by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = digest = None
        for batch in batches:
            done = []
            for here, said in zip(batch["key"].to_pylist(), batch["said"].to_pylist(), strict=True):
                if digest is not None and here == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = here, sha256()
                digest.update(said.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done, strict=True)], ["key", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    ordered = pieces.select("key", "conv_id", "slice", "said").repartition("key").sortWithinPartitions("key", "conv_id", "slice")
    return ordered.select("key", "said").mapInArrow(frugal(run), "key string, ends_sha256 string")


def prefix_trie(conversations: DataFrame, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """A row for each distinct beginning of the conversations, from the textless root on.

    ``conversations`` has conv_id (long, not null) and turns, an array of structs with digest (32 hex digits) and chars, as
    ``conversations_of`` makes them; other columns aren't read. Returns ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    Conversations without turns end at the root, copies share all nodes, and a conv_id that occurs twice counts
    twice. Without conversations there is no node. A conversation of any length is one row.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    digests = F.transform("turns", lambda t: t["digest"])
    chars = F.transform("turns", lambda t: t["chars"])
    rows = scratch.keep(conversations.select(F.unhex(F.array_join(digests, "")).alias("path"), chars.alias("chars"), "conv_id"), "paths")
    order, levels = ["path", "conv_id"], []
    while True:
        n, turns = rows.agg(F.count(F.lit(1)), F.sum(F.size("chars") + 1)).first()
        if not n:
            break
        parts = min(-(-turns // slice_turns), n // SLICE_ROWS)
        if not levels:  # these aren't few: as many tasks as any shuffle has, and never one
            parts = max(parts, 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        whole = parts <= 1
        found = scratch.keep(_round(rows, max(1, parts), slice_turns, order, whole), f"level{len(levels)}")
        levels.append(found)
        if whole:
            break
        rows = found.where("kind = 'edge'").select("path", "chars", "least", *[f"each_{s}" for s in SUMS], "keys", "slice", "edge")
        order = ["path", "slice", "edge"]
    if not levels:
        return scratch.result(spark.createDataFrame([], _RESULT))
    found = levels[0].withColumn("level", F.lit(0))
    for number, more in enumerate(levels[1:], 1):
        found = found.unionByName(more.withColumn("level", F.lit(number)))
    ends = _ends_digests(levels[0].where("kind = 'ends'"))
    # nodes that were open in a slice; their number grows with the slices, not with the conversations
    above = found.where("kind = 'node' AND level > 0").drop("said").join(ends, "key", "left")
    above = scratch.keep(above.withColumn("said", F.coalesce("ends_sha256", F.lit(NOTHING))).drop("ends_sha256"), "above")
    edges = found.where("kind = 'edge'").select("level", "slice", "edge", F.posexplode("keys").alias("at", "key"))
    parents = edges.join(above.select("key", F.col("conv_id").alias("parent")), "key").alias("p")
    nodes = found.where("kind = 'node' AND level = 0").unionByName(above).alias("n")
    place = [("level", "level"), ("slice", "slice"), ("parent_edge", "edge")]
    on = (F.col("n.depth") - 1 == F.col("p.at")) & reduce(and_, (F.col(f"n.{a}") == F.col(f"p.{b}") for a, b in place))
    return scratch.result(
        nodes.join(parents, on, "left").select(
            "n.conv_id", "n.depth", F.coalesce("n.parent_conv_id", "p.parent").alias("parent_conv_id"),
            "n.n_convs", "n.n_children", "n.n_leaves", F.col("n.saved").alias("saved_tokens"), F.col("n.said").alias("ends_sha256"),
        )
    )


_RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
