"""Vectorised hashing of words, shingles and byte windows with numpy.

All sums wrap modulo 2**64. Polynomials modulo a power of two collide on some structured strings for
every base, so they only group and select; what decides equality is compared as bytes or by blake2b, or
runs over mixed eight-byte lanes (:class:`LaneHash`, :func:`word_hashes`). A prefix hash ``P[i] = sum((b[j] + 1) * B**j for j < i)`` gives the hash
of any slice in constant time: ``(P[e] - P[s]) * B**-s``, since an odd ``B`` has an inverse.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: powers kept in each worker; longer ones are made for the call
KEPT_POWERS, LONG_WORD = 1 << 20, 512
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> U(29))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**j`` and ``base**-j`` for ``j <= n``."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, KEPT_POWERS)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = (made[0], made[1])
        if size == KEPT_POWERS:
            _powers[base] = have
    return have[0][: n + 1], have[1][: n + 1]


class PrefixHash:
    """Constant-time hashes of slices of ``data``."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        self.up, self.down = powers(base, len(data))
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * self.up[:-1], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


class LaneHash:
    """Constant-time hashes of slices that no structure of the bytes breaks: a slice of eight bytes or
    more is a polynomial over its mixed eight-byte lanes, a shorter one over its bytes."""

    def __init__(self, data: np.ndarray):
        self.short = PrefixHash(data)
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(mix(lanes(data, np.arange(len(data))) ^ U(BASES[1])) * self.short.up[:-1], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        deep = (self.sums[np.maximum(end - 7, start)] - self.sums[start]) * self.short.down[start]
        short = end - start < 8
        return np.where(short, self.short.slices(start, end), deep) if short.any() else deep


def lanes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[at]).view(U).ravel()


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with one space after each, as bytes, and where each begins (and a last end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return data, starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each white-space separated word of the (already normalised) texts, and the number of
    words of each text. Eight bytes at a time are mixed in; very long words take blake2b."""
    data, starts = join_texts(texts)
    space = SPACE[data]
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    counts = np.diff(np.searchsorted(begin, starts))
    size = end - begin
    out = mix(size.astype(U) + U(BASES[0]))
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = int.from_bytes(blake2b(data[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    live = np.flatnonzero(size <= LONG_WORD)
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
    done = 0
    while len(live):
        part = lanes(data, begin[live] + done) & mask[np.minimum(size[live] - done, 8)]
        out[live] = mix(out[live] ^ part * U(BASES[1]))
        done += 8
        live = live[size[live] > done]
    return out, counts


def shingle_hashes(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles, in order, and how many each text has. A text of fewer
    words is one shingle; one without words has none."""
    words, counts = word_hashes(texts)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    if not n.sum():
        return np.zeros(0, U), n
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    text = np.repeat(np.arange(len(texts)), n)
    at = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    size = np.minimum(counts, width)[text]
    out = size.astype(U)
    for k in range(width):
        take = k < size
        term = words[np.where(take, at + k, 0)]
        out = np.where(take, out * U(BASES[1]) + term, out)
    return mix(out), n
