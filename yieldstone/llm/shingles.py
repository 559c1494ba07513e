"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

#: Bytes of text that are hashed together.
CHUNK_BYTES = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Masks that keep the first 0 to 8 bytes of a little-endian number.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all bits; a permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    fresh = np.empty(len(values), bool)
    fresh[0] = True
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 text start, and a hash of each, eight bytes a round over all words that are so long."""
    raw = np.frombuffer(data + b" " * 8, np.uint8)
    space = np.empty(len(data) + 2, bool)
    space[0] = space[-1] = True
    np.take(_SPACE, raw[: len(data)], out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(data) + 1, "<u8", raw, strides=(1,))
    h = mixed(sizes.astype(np.uint64) * _ODD)
    todo, at, left = np.arange(len(starts)), starts, sizes
    while len(todo):
        h[todo] = mixed(h[todo] ^ (eight[at] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return starts, h


class Shingler:
    """Distinct shingles of ``size`` words, sorted; a text of fewer words is one shingle, one without words has none.

    Words are runs of characters other than space and \\x09-\\x0D, with A to Z lower-cased. Two different shingles share a hash
    with probability 2 ** -64.
    """

    def __init__(self, size: int = 5):
        self.size = size

    def __call__(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The set of each text, nulls as empty texts."""
        chunk, held = [], 0
        for text in texts:
            data = text.encode().lower() if text else b""
            chunk.append(data)
            held += len(data) + 1
            if held >= CHUNK_BYTES:
                yield from self._sets(chunk)
                chunk, held = [], 0
        yield from self._sets(chunk)

    def _sets(self, chunk: list[bytes]) -> Iterator[np.ndarray]:
        starts, h = word_hashes(b"\n".join(chunk))
        ends = np.cumsum([len(data) + 1 for data in chunk])
        cuts = np.concatenate([[0], np.searchsorted(starts, ends)]).tolist()
        full = self._rolled(h, self.size)
        for low, high in zip(cuts, cuts[1:], strict=False):
            if high - low >= self.size:
                yield distinct(full[low : high - self.size + 1])
            else:
                yield self._rolled(h[low:high], high - low) if high > low else np.empty(0, np.uint64)

    @staticmethod
    def _rolled(h: np.ndarray, size: int) -> np.ndarray:
        """A hash of each run of ``size`` words."""
        n = max(0, len(h) - size + 1)
        s = h[:n] + np.uint64(size)
        for k in range(1, size):
            s = s * _ODD + (h[k : n + k] ^ (s >> np.uint64(32)))
        return mixed(s)


def set_digest(tokens: np.ndarray) -> int:
    """64 bits, signed, that stand for the set; equal for two of n sets with probability below n ** 2 / 2 ** 65."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes()))))
