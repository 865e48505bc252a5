"""Vectorised word work over slices of texts (numpy on UTF-8 bytes).

Words are ``[^\\x20\\x09-\\x0D]+``.  A word's hash is a polynomial over its bytes modulo 2**64
(odd random base, so prefix sums can be divided), finished by a mixer.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(0x5EED)
BASE = np.uint64(int(_RNG.integers(1 << 62)) | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCK = 1 << 18  # bytes whose words are hashed at a time
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((BASE, INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS[k] = p
    return _POWERS


class Words:
    """Words of a slice of texts: ``hash``, ``doc`` (index of the text), ``start``, ``end`` (byte places in ``data``);
    ``first`` has each text's first word index, with the total at the end."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts) + b"\n"
        if lower:
            joined = joined.translate(LOWER)
        data = np.frombuffer(joined, np.uint8)
        self.data, self.n_texts = data, len(texts)
        self.text_start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        space = WHITE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        size = self.end - self.start
        poly = np.empty(len(size), np.uint64)
        # block by block: a hash does not depend on its word's place, so the wide arrays stay small for long texts
        cuts = np.unique(np.searchsorted(self.start, np.arange(0, len(data) + BLOCK, BLOCK)))
        for i, j in zip(cuts, cuts[1:]):
            at, stop = self.start[i], self.end[j - 1]
            up, down = _powers(int(stop - at) + 1)
            sums = np.zeros(stop - at + 1, np.uint64)
            np.add(data[at:stop], np.uint64(1), out=sums[1:], dtype=np.uint64)
            sums[1:] *= up[:stop - at]
            np.cumsum(sums, out=sums)
            poly[i:j] = (sums[self.end[i:j] - at] - sums[self.start[i:j] - at]) * down[self.start[i:j] - at]
        self.hash = mix64(poly + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        self.first = np.searchsorted(self.start, self.text_start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every k words in a row within one text, and the index of its first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = (h * BASE) + self.hash[j:j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return mix64(h[at]), at

    def shingles(self, k: int) -> list[np.ndarray]:
        """Per text its distinct k-word windows (sorted); with fewer words the whole sequence as one; none without words."""
        h, at = self.windows(k)
        cut = np.searchsorted(at, self.first)
        counts = self.counts()
        out = []
        for i in range(self.n_texts):
            if counts[i] >= k:
                out.append(np.unique(h[cut[i]:cut[i + 1]]))
            elif counts[i]:
                own = self.hash[self.first[i]:self.first[i + 1]]
                acc = np.full(1, 0xA0761D6478BD642F + len(own), np.uint64)
                for w in own:
                    acc = acc * BASE + w
                out.append(mix64(acc))
            else:
                out.append(np.empty(0, np.uint64))
        return out
