"""The words of a block of texts, found and hashed as arrays."""

from __future__ import annotations

import hashlib

import numpy as np

from rivulet.llm.blocks import Block, mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG, _STEP = 256, np.uint64(0xC2B2AE3D27D4EB4F)


def hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch: eight bytes after eight are mixed into it, long ones take BLAKE2b."""
    size = stop - start
    out = mix(size.astype(np.uint64) + _STEP)
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    left = np.flatnonzero(size <= _LONG)
    at, rest = start[left], size[left]
    while len(left):
        out[left] = mix((out[left] * _STEP) ^ (eight[at] & _MASK[np.minimum(rest, 8)]))
        more = np.flatnonzero(rest > 8)
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : stop[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words:
    """Words (lower case A-Z, parted by white space or the end of a text): hash and document of each, in order."""

    def __init__(self, block: Block) -> None:
        low = _LOWER[block.data]
        inside = ~_SPACE[low]
        edge = np.zeros(len(low) + 1, bool)
        edge[block.starts] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.hash = hashes(low, start, stop)
        self.counts = np.diff(np.searchsorted(start, block.starts))
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
