"""64-bit hashes of words and word shingles, many texts at once."""

from __future__ import annotations

from hashlib import blake2b
from itertools import chain

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
#: An odd number and its inverse modulo 2**64: powers place a byte within its text.
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def salt(n: int) -> np.uint64:
    return np.uint64((n + 1) * _STEP % (1 << 64))


_BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_STEP))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        factors = np.full(max(n, 1 << 20), _BASE if kind == "up" else _INVERSE, np.uint64)
        factors[0] = 1
        _powers[kind] = np.multiply.accumulate(factors)
    return _powers[kind][:n]


def running_sums(data: np.ndarray) -> np.ndarray:
    """Sums s, one longer than the data, from which ``span_hash`` hashes any span of bytes."""
    values = _BYTE_VALUES[data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _power("up", len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of byte spans, equal for equal bytes wherever they stand."""
    raw = (sums[stop] - sums[start]) * _power("down", len(sums))[start]
    return mix(raw + (stop - start).astype(np.uint64) * np.uint64(_STEP))


#: Lower-cases A-Z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers for each word, A-Z in lower case, from its BLAKE2b digest; and n + 1 bounds of each text's words.

    Words are runs without ASCII white space. Each distinct word is digested once.
    """
    lists = [t.translate(LOWER).split() for t in texts]
    digests = {w: blake2b(w, digest_size=16).digest() for w in set(chain.from_iterable(lists))}
    joined = b"".join(map(digests.__getitem__, chain.from_iterable(lists)))
    return np.frombuffer(joined, np.uint64).reshape(-1, 2), np.cumsum([0, *map(len, lists)])


def shingle_sets(texts: list[bytes], width: int) -> list[tuple[np.ndarray, bytes]]:
    """Of each text the distinct shingles as sorted 64-bit numbers, and a digest of the set.

    Of fewer than ``width`` words the whole sequence is one shingle, of none nothing is. The digest is BLAKE2b over 128 bits of each shingle.
    """
    words, bounds = word_digests(texts)
    n = max(0, len(words) - width + 1)
    shingles = np.zeros((n, 2), np.uint64)
    for i in range(width):
        shingles += mix(words[i : i + n] + salt(i))
    shingles = mix(shingles)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = shingles[a : b - width + 1] if b - a >= width else np.zeros((0, 2), np.uint64)
        if a < b < a + width:
            own = mix(sum((mix(words[i : i + 1] + salt(i - a)) for i in range(a, b)), np.zeros((1, 2), np.uint64)) + salt(1000 + b - a))
        known, first = np.unique(own[:, 0], return_index=True)
        out.append((known, blake2b(known.tobytes() + own[first, 1].tobytes(), digest_size=16).digest()))
    return out
