"""Best-fit packing of documents into sequences of fixed length, under conflicts.

No sequence (bin) holds two documents of one source, nor two of one cluster of duplicates. Open bins are ordered by
their residual space and carry a bitmap of the sources and clusters they hold. A document goes to the bin with the
least residual that still takes it: the search starts at the document's length and goes on to the next larger
residual until a compatible bin is found; only if there is none, a new bin opens.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, frugal_group

#: Rows that are packed together in one task. Bins never span groups, so a group's last bins may stay open.
ROWS_PER_GROUP = 20_000
#: No bin has this bit, every document and every empty stretch of residuals has it.
NEVER = 1


class Bins:
    """Open bins by residual, under a tree whose nodes hold the bits that all bins below have in common.

    A node that shares a bit with a document can't hold a bin for it, so whole stretches are passed over.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.size = 1 << capacity.bit_length()
        self.common = [-1] * (2 * self.size)
        self.leaves: dict[int, dict[int, list[int]]] = {}
        self.count = 0

    def _refresh(self, residual: int) -> None:
        bits = -1
        for mask in self.leaves.get(residual, ()):
            bits &= mask
        node, common = self.size + residual, self.common
        while node and common[node] != bits:
            common[node] = bits
            node >>= 1
            if node:
                bits = common[2 * node] & common[2 * node + 1]

    def _below(self, node: int, mask: int) -> tuple[int, int] | None:
        """The least residual under ``node`` with a compatible bin, and that bin's bitmap."""
        if self.common[node] & mask:
            return None
        if node >= self.size:
            return next(((node - self.size, bits) for bits in self.leaves[node - self.size] if not bits & mask), None)
        return self._below(2 * node, mask) or self._below(2 * node + 1, mask)

    def successor(self, need: int, mask: int) -> tuple[int, int] | None:
        node = self.size + need
        while True:
            if found := self._below(node, mask):
                return found
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1

    def place(self, length: int, mask: int) -> tuple[int, int]:
        """The bin that takes the document, and where in it the document starts."""
        mask |= NEVER
        if found := self.successor(length, mask):
            residual, bits = found
            leaf = self.leaves[residual]
            number = leaf[bits].pop()
            if not leaf[bits]:
                del leaf[bits]
            self._refresh(residual)
        else:
            residual, bits, number = self.capacity, 0, self.count
            self.count += 1
        left, bits = residual - length, bits | (mask & ~NEVER)
        self.leaves.setdefault(left, {}).setdefault(bits, []).append(number)
        self._refresh(left)
        return number, self.capacity - residual


def pack_group(lengths: list[int], sources: list, clusters: list, capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, part, bin, start, length) of every piece, longest documents first.

    A document longer than a bin fills bins of its own, and what is left over is packed like a document.
    """
    bits: dict[tuple[str, object], int] = {}
    bins = Bins(capacity)
    pieces = [(n % capacity if n > capacity else n, row) for row, n in enumerate(lengths)]
    full = 0
    for row, n in enumerate(lengths):
        if n > capacity:
            for part in range(n // capacity):
                full += 1
                yield row, part, -full, 0, capacity
    for left, row in sorted(pieces, key=lambda p: (-p[0], p[1])):
        parts = lengths[row] // capacity if lengths[row] > capacity else 0
        if parts and not left:
            continue
        mask = 0
        for kind, value in (("source", sources[row]), ("cluster", clusters[row])):
            if value is not None:
                mask |= 1 << bits.setdefault((kind, value), len(bits) + 1)
        number, start = bins.place(left, mask)
        yield row, parts, number, start, left


def pack(docs: DataFrame, capacity: int, ident: str, length: Column, source: Column, cluster: Column) -> DataFrame:
    """Where every document goes: ident, ``part``, ``bin``, ``bin_start``, ``n_tokens``.

    Rows are dealt at random into groups of about ``ROWS_PER_GROUP``, each packed in one task, so memory is bounded
    whatever source or cluster is frequent. A null or negative length counts as 0 and still gets a place; a null
    source or cluster conflicts with nothing; repeated rows are packed one by one (and apart, if they share a
    source or cluster); an empty table gives an empty result. Other columns of ``docs`` aren't read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    rows = docs.select(
        docs[ident].alias("ident"),
        F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("length"),
        source.alias("source"),
        cluster.alias("cluster"),
    ).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.keep(rows, "rows")
    groups = max(1, -(-rows.count() // ROWS_PER_GROUP))
    ident_type = dict(rows.dtypes)["ident"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        found = list(pack_group(*(table[c].to_pylist() for c in ("length", "source", "cluster")), capacity))
        row, part, number, start, n = zip(*found, strict=True) if found else ((),) * 5
        group = table["group"][0].as_py() << 32
        bins = [group + (b if b >= 0 else (1 << 31) - b) for b in number]
        long = pa.int64()
        return pa.table(
            {
                "ident": table["ident"].take(pa.array(row, long)), "part": pa.array(part, long), "bin": pa.array(bins, long),
                "bin_start": pa.array(start, long), "n_tokens": pa.array(n, long),
            }
        )

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInArrow(frugal_group(run), f"ident {ident_type}, part long, bin long, bin_start long, n_tokens long")
    return packed.withColumnRenamed("ident", ident)


def word_count(text: Column) -> Column:
    """Tokens of a text where no tokenizer is given: its words and one end mark."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1
