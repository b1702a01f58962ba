"""Five-word shingles as 64-bit hashes, and MinHash labels, in numpy.

Words are the runs of letters, digits and non-ASCII characters of the
lower-cased text, so case and punctuation do not matter. A text of fewer than
five words is one shingle, a text without words has none. Hashes are taken
from a polynomial over the bytes of many texts at once: the value of a slice is
a difference of prefix sums times the inverse power of its start, modulo 2**64,
then mixed.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
PIECE_WORDS = 1 << 15   # longer texts are hashed in overlapping pieces
BLOCK_BYTES = 1 << 18   # texts hashed together

_RNG = np.random.default_rng(20240521)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int):
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def mix(h):
    """A finalising permutation of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BLANKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def normalize(text: str | None) -> bytes:
    """The words of a text, joined by single blanks."""
    return b" ".join((text or "").lower().encode().translate(_BLANKS).split())


def pieces(norm: bytes) -> list[bytes]:
    """A normalised text in pieces that together hold each shingle."""
    if norm.count(b" ") < PIECE_WORDS + SIZE:
        return [norm] if norm else []
    words = norm.split(b" ")
    return [b" ".join(words[i:i + PIECE_WORDS + SIZE - 1])
            for i in range(0, len(words) - SIZE + 1, PIECE_WORDS)]


def piece_hashes(texts: list[bytes]):
    """(hashes of all shingles in order, index of each text's first) of
    non-empty normalised texts."""
    blob = np.frombuffer(b" ".join(texts), np.uint8)
    power, inverse = _powers(len(blob) + 1)
    sums = np.zeros(len(blob) + 1, np.uint64)
    np.cumsum(_BYTE[blob] * power[:len(blob)], out=sums[1:])
    gaps = np.flatnonzero(blob == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(blob)]])
    words = np.array([t.count(b" ") + 1 for t in texts])
    counts = np.maximum(words - SIZE + 1, 1)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    shift = np.repeat(np.concatenate([[0], np.cumsum(words)[:-1]]) - firsts, counts)
    at = np.arange(counts.sum()) + shift
    last = at + np.repeat(np.minimum(words, SIZE) - 1, counts)
    a, b = starts[at], ends[last]
    return mix((sums[b] - sums[a]) * inverse[a]), firsts


def blocks(norms: list[bytes]):
    """Yield (owners, hashes, firsts) over the pieces of many texts."""
    held, owners, size = [], [], 0
    for i, norm in enumerate(norms):
        for piece in pieces(norm):
            held.append(piece)
            owners.append(i)
            size += len(piece)
            if size > BLOCK_BYTES:
                yield np.array(owners), *piece_hashes(held)
                held, owners, size = [], [], 0
    if held:
        yield np.array(owners), *piece_hashes(held)


def shingle_sets(norms: list[bytes]) -> list:
    """Sorted distinct shingle hashes of each text."""
    out: list = [[] for _ in norms]
    for owners, hashes, firsts in blocks(norms):
        for i, part in zip(owners.tolist(), np.split(hashes, firsts[1:])):
            out[i].append(part)
    return [np.unique(np.concatenate(p)) if p else np.zeros(0, np.uint64) for p in out]


class MinHash:
    """``count`` minimum hashes, 32 bits each."""

    def __init__(self, count: int):
        rng = np.random.default_rng(7919)
        self.flip = rng.integers(0, 1 << 63, count, dtype=np.uint64)
        self.times = rng.integers(0, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def labels(self, norms: list[bytes]):
        """One row of minima per text (all ones where there is no shingle)."""
        out = np.full((len(norms), len(self.flip)), np.iinfo(np.uint64).max, np.uint64)
        for owners, hashes, firsts in blocks(norms):
            spare = np.empty_like(hashes)
            low = np.empty((len(owners), len(self.flip)), np.uint64)
            for f, (flip, times) in enumerate(zip(self.flip, self.times)):
                np.bitwise_xor(hashes, flip, out=spare)
                np.multiply(spare, times, out=spare)
                low[:, f] = np.minimum.reduceat(spare, firsts)
            np.minimum.at(out, owners, low)
        return (out >> np.uint64(32)).astype(">u4")


def local_components(linked) -> np.ndarray:
    """Smallest reachable index of each row of a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], n).min(1, initial=n))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low
