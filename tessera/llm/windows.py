"""Window runs of long sequences, shared by the exact-repeat operators.

A text is a sequence of 64-bit unit values (one per byte offset, or one per
word).  A window is ``length`` consecutive units.  Each window picks as anchor
the leftmost of its ``gram``-unit grams with the smallest hash, so equal
windows pick the same relative anchor wherever they stand.  Consecutive
windows with one anchor form a run; a run has a *core* (the units common to
all its windows, at the least the anchor gram) and a *hull* (all units of its
windows).  Two equal windows always sit in runs with equal anchor grams.

Everything works on one bounded block of concatenated texts with numpy; texts
longer than a block are cut in pieces that overlap by ``length - 1`` units, so
every window start belongs to exactly one piece.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Units handled at a time; the position in a block takes ``POS_BITS`` bits.
BLOCK_UNITS = 1 << 20
POS_BITS = np.uint64(24)
BASE = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer with full avalanche on unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    size = BLOCK_UNITS * 2
    while size < n:
        size *= 2
    return _powers(size)


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """P with ``span_hash(P, a, b)`` the hash of ``values[a:b]``."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Position-independent hash of ``values[a:b]`` for arrays of bounds."""
    _, down = powers(len(prefix))
    return mix64((prefix[b] - prefix[a]) * down[a] + (b - a).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(s, s + c)``."""
    total = int(counts.sum())
    out = np.ones(total, np.int64)
    keep = counts > 0
    starts, counts = starts[keep], counts[keep]
    if not total:
        return out
    out[0] = starts[0]
    at = np.cumsum(counts)[:-1]
    out[at] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)


def pieces(sizes: np.ndarray, length: int, limit: int | None = None):
    """Split texts of ``sizes`` units into blocks of (text, offset, n_units).

    Each block holds at most about ``limit`` units; no window start is in two
    pieces and none is left out.
    """
    limit = limit or BLOCK_UNITS
    block, held = [], 0
    for i, n in enumerate(sizes.tolist()):
        at = 0
        while n - at >= length:
            take = min(n - at, max(limit, 2 * length))
            if held and held + take > limit:
                yield block
                block, held = [], 0
            block.append((i, at, take))
            held += take
            if at + take >= n:
                break
            at += take - length + 1
    if block:
        yield block


def window_runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int):
    """Runs of a block of concatenated pieces.

    Returns (piece, anchor, first, last, prefix): for every run its piece, the
    anchor's position and the first and last window start, all as positions in
    the block, and the block's prefix hash.
    """
    prefix = prefix_hash(values)
    n = len(values)
    at = np.arange(n - gram + 1, dtype=np.int64)
    key = span_hash(prefix, at, at + gram)
    key = ((key >> POS_BITS) << POS_BITS) | at.astype(np.uint64)
    least = sliding_min(key, length - gram + 1)
    begin = ranges(starts, sizes - length + 1)
    anchor = (least[begin] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(begin) else np.zeros(0, np.int64)
    last = np.concatenate([new[1:] - 1, [len(begin) - 1]]) if len(new) else new
    first, last, anchor = begin[new], begin[last], anchor[new]
    piece = np.searchsorted(starts, first, side="right") - 1
    # an anchor gram's run may go on in the next text only if it crossed a border, which it cannot
    return piece, anchor, first, last, prefix


def byte_values(data: np.ndarray, reach: int = 8) -> np.ndarray:
    """One value for each ``reach``-byte gram (8) of a byte array."""
    n = len(data) - reach + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(reach):
        out |= data[i:i + n].astype(np.uint64) << np.uint64(8 * i)
    return mix64(out + np.uint64(BASE))


SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.concatenate([[False], ~SEPARATORS[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def word_bounds_by_text(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`word_bounds` over texts ``data[offsets[i]:offsets[i + 1]]`` laid end to end."""
    low, high = int(offsets[0]), int(offsets[-1])
    inside = np.concatenate([[False], ~SEPARATORS[data[low:high]], [False]])
    change = inside[1:] != inside[:-1]
    border = offsets[1:-1] - low
    both = border[inside[1:][border] & inside[:-1][border]] if high > low else border[:0]
    starts = np.flatnonzero(change & inside[1:])
    ends = np.flatnonzero(change & inside[:-1])
    if len(both):  # a text ends and the next begins inside what looks like one word
        both = np.unique(both)
        starts, ends = np.union1d(starts, both), np.union1d(ends, both)
    return starts + low, ends + low


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word, equal for equal words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    low = starts[0]
    prefix = prefix_hash(mix64(data[low:ends[-1]].astype(np.uint64) + np.uint64(BASE)))
    return span_hash(prefix, starts - low, ends - low)
