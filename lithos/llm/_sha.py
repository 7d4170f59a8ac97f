"""SHA-256 over many lanes at once, with states that can be kept and resumed.

A digest written as hexadecimal text is 64 bytes, one block of the hash, so the state before any child of a
Merkle node is that of a whole number of blocks: 32 bytes that can be stored and go on elsewhere, which hashlib's objects can't.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

LANES = 4096


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(n: int) -> int:
    root = round(n ** (1 / 3))
    while root**3 > n:
        root -= 1
    while (root + 1) ** 3 <= n:
        root += 1
    return root


#: The first 32 bits of the fractions of cube and square roots of the first primes, as the standard has them.
_ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_HEX = np.frombuffer(b"".join(b"%02x" % k for k in range(256)), np.uint16)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Rows of 32 bytes as the 16 words of their hexadecimal text."""
    return np.ascontiguousarray(_HEX[digests]).view(">u4").astype(np.uint32)


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _block(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    w = [np.ascontiguousarray(words[:, k]) for k in range(16)]
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(state[:, k]) for k in range(8))
    for t in range(64):
        if t >= 16:
            x, y = w[(t - 15) % 16], w[(t - 2) % 16]
            small = _turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))
            large = _turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))
            w[t % 16] = w[t % 16] + small + w[(t - 7) % 16] + large
        first = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[t] + w[t % 16]
        second = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + first, c, b, a, first + second
    return state + np.stack([a, b, c, d, e, f, g, h], axis=1)


def resumed(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """States (rows of 8 words) after one more block (rows of 16 words) each."""
    if len(state) <= LANES:
        return _block(state, words)
    return np.concatenate([_block(state[k : k + LANES], words[k : k + LANES]) for k in range(0, len(state), LANES)])


def finished(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (rows of 32 bytes) of messages that ended after so many whole blocks."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = (bits >> np.uint64(32)).astype(np.uint32), bits.astype(np.uint32)
    return resumed(state, last).astype(">u4").view(np.uint8).reshape(-1, 32)
