"""Stable hashes, exact in 64-bit column arithmetic.

The modulus is the Mersenne prime p = 2^31 - 1, so 2^31 = 1 (mod p) and an md5 digest can be
reduced piecewise: with its 32 hex digits cut 15 + 15 + 2, the pieces weigh 2^68 = 2^6 and
2^8 (mod p).
"""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: modulus of every hash here.
PRIME = (1 << 31) - 1


def _digits(md5_hex: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(md5_hex, start, length), 16, 10).cast("bigint")


def md5_mod_prime(md5_hex: Column) -> Column:
    """The 128-bit number written in ``md5_hex`` modulo p."""
    high, middle, low = _digits(md5_hex, 1, 15), _digits(md5_hex, 16, 15), _digits(md5_hex, 31, 2)
    return ((high % PRIME) * 64 + (middle % PRIME) * 256 + low) % PRIME


def stable_hash(value: Column) -> Column:
    """md5 of the UTF-8 text modulo p, as bigint."""
    return md5_mod_prime(F.md5(value))


def stable_hashes(values: Column) -> Column:
    """``stable_hash`` of every element; the digest is taken once per element."""
    return F.transform(F.transform(values, F.md5), md5_mod_prime)


def hash_family(num_hashes: int, seed: int = 42) -> list[tuple[int, int]]:
    """Coefficients (a, b) of ``(a*h + b) mod p``; fewer functions are a prefix of more."""
    draw = random.Random(seed).randint
    return [(draw(1, PRIME - 1), draw(0, PRIME - 1)) for _ in range(num_hashes)]


def _word_hex(value: Column) -> Column:
    """Eight hex digits of the 32-bit two's complement of an integer."""
    return F.substring(F.lpad(F.hex(value.cast("bigint")), 16, "0"), 9, 8)


def band_bucket(values: Column) -> Column:
    """Hash of an array of 32-bit integers: md5 of their big-endian bytes modulo p."""
    packed = F.unhex(F.array_join(F.transform(values, _word_hex), ""))
    # Through a one-element transform, so that the digest is not taken per piece of it.
    return F.element_at(F.transform(F.array(F.md5(packed)), md5_mod_prime), 1).cast("int")
