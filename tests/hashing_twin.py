"""Term -> bucket hashing equal to ``pyspark.ml.feature.HashingTF``.

HashingTF hashes the UTF-8 bytes of a term with MurmurHash3 x86 32-bit (seed 42, standard tail
handling) and takes the non-negative remainder by ``numFeatures``. SQL ``hash()`` uses a
different tail rule, so it cannot stand in. The queries run ``HashingTF`` itself (JVM, per row);
this pure-Python twin answers "which bucket is this term in?" and is the differential oracle for
the hashed operators in the tests.
"""

from __future__ import annotations

from quire.functions import fixed_values as fv

_C1 = 0xCC9E2D51
_C2 = 0x1B873593
_MASK = 0xFFFFFFFF


def _rotl(x: int, r: int) -> int:
    return ((x << r) | (x >> (32 - r))) & _MASK


def _mix_k1(k1: int) -> int:
    k1 = (k1 * _C1) & _MASK
    k1 = _rotl(k1, 15)
    return (k1 * _C2) & _MASK


def murmur3_x86_32(data: bytes, seed: int = fv.HASH_SEED) -> int:
    """Signed 32-bit MurmurHash3 (x86, 32-bit) of ``data``."""
    h1 = seed & _MASK
    n = len(data)
    aligned = n - n % 4
    for i in range(0, aligned, 4):
        h1 ^= _mix_k1(int.from_bytes(data[i:i + 4], "little"))
        h1 = _rotl(h1, 13)
        h1 = (h1 * 5 + 0xE6546B64) & _MASK
    k1 = 0
    for shift, b in enumerate(data[aligned:]):
        k1 ^= b << (8 * shift)
    h1 ^= _mix_k1(k1)
    h1 ^= n
    h1 ^= h1 >> 16
    h1 = (h1 * 0x85EBCA6B) & _MASK
    h1 ^= h1 >> 13
    h1 = (h1 * 0xC2B2AE35) & _MASK
    h1 ^= h1 >> 16
    return h1 - (1 << 32) if h1 & 0x80000000 else h1


def bucket_of(term: str, num_features: int = fv.NUM_FEATURES) -> int:
    """HashingTF index of one term (Python's ``%`` is already non-negative for a positive modulus)."""
    return murmur3_x86_32(term.encode("utf-8")) % num_features
