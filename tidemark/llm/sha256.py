"""SHA-256 over many messages at once, with states that can be kept, stored and resumed.

The state of a hash after whole blocks of 64 bytes is eight 32-bit words. A digest as hex text is
64 bytes, so hashing a list of digests has such a state before each of them. Arrays are words
by messages: states ``(8, n)``, blocks ``(16, n)``.
"""

from __future__ import annotations

import numpy as np

U = np.uint32


def _primes(count: int) -> list[int]:
    found = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _root(n: int, k: int) -> int:
    """Whole part of the ``k``-th root."""
    low, high = 0, 1 << (n.bit_length() // k + 1)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if mid**k <= n else (low, mid)
    return low


# The standard's constants: fractions of the square and cube roots of the first primes.
START = np.array([_root(p << 64, 2) & 0xFFFFFFFF for p in _primes(8)], U)[:, None]
ROUNDS = [U(_root(p << 96, 3) & 0xFFFFFFFF) for p in _primes(64)]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> U(n)) | (x << U(32 - n))


def resumed(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The state after one more block."""
    w = list(block)
    for t in range(16, 64):
        near, far = w[t - 15], w[t - 2]
        s0 = _turn(near, 7) ^ _turn(near, 18) ^ (near >> U(3))
        s1 = _turn(far, 17) ^ _turn(far, 19) ^ (far >> U(10))
        w.append(w[t - 16] + s0 + w[t - 7] + s1)
    a, b, c, d, e, f, g, h = state
    for k, word in zip(ROUNDS, w):
        t1 = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + (word + k)
        t2 = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    return np.stack([a, b, c, d, e, f, g, h]) + state


def closed(state: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """Digests of messages of so many whole blocks."""
    bits = np.atleast_1d(np.asarray(blocks, np.uint64)) * np.uint64(512)
    end = np.zeros((16, len(bits)), U)
    end[0] = 1 << 31
    end[14], end[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return resumed(state, end)


_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint8).reshape(256, 2)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The hex text of each digest, as a block."""
    raw = np.ascontiguousarray(digests.T).astype(">u4").view(np.uint8)
    text = np.ascontiguousarray(_HEX[raw].reshape(len(raw), 64))
    return np.ascontiguousarray(text.view(">u4").astype(U).T)


def from_bytes(raws: list[bytes]) -> np.ndarray:
    """States or digests of 32 bytes each."""
    return np.frombuffer(b"".join(raws), ">u4").astype(U).reshape(-1, 8).T.copy()


def to_bytes(states: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(states.T).astype(">u4").tobytes()
    return [raw[i : i + 32] for i in range(0, len(raw), 32)]
