"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than white space, A-Z in lower case. Equal
shingles have equal hashes; different shingles of two texts that are compared
share a hash with a chance of about 2^-64 per pair of shingles.
"""

import numpy as np

from telmart.llm.shared import SPACE_BYTES

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
# Odd 64-bit constants of the mixing steps.
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Start, end and hash of each word, and the words before each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    last = np.empty(len(data), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    start = np.flatnonzero(inside & first)
    end = np.flatnonzero(inside & last) + 1
    return start, end, span_hashes(_LOWER[data] if lower else data, start, end), np.searchsorted(start, offsets)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each byte span, read eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=padded.data, strides=(1,))
    size = end - start
    hashes = mix(size.astype(np.uint64) * _A + _C)
    rest = np.arange(len(start))
    done = 0
    while len(rest):
        left = size[rest] - done
        chunk = eight[start[rest] + done] & _MASK[np.minimum(left, 8)]
        hashes[rest] = mix(hashes[rest] ^ (chunk * _A))
        rest = rest[left > 8]
        done += 8
    return hashes


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles in text order, and the shingles before
    each text. A text of fewer words is one shingle, one without words none."""
    counts = np.diff(bounds)
    many = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    before = np.concatenate([[0], np.cumsum(many)])
    out = np.zeros(before[-1], np.uint64)
    if not len(out):
        return out, before
    text = np.repeat(np.arange(len(counts)), many)
    at = bounds[text] + np.arange(len(out)) - before[text]
    out[:] = mix(hashes[at] + _A)
    for step in range(1, n):
        if counts.min(initial=n) >= n:
            out = mix(out * _A + hashes[at + step])
        else:
            more = np.flatnonzero(counts[text] > step)
            out[more] = mix(out[more] * _A + hashes[at[more] + step])
    return out, before


def distinct(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, with new counts before."""
    parts = [np.unique(values[a:b]) for a, b in zip(before[:-1], before[1:])]
    sizes = np.array([len(part) for part in parts], np.int64)
    return (
        np.concatenate(parts) if parts else np.zeros(0, np.uint64),
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
    )
