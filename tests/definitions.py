"""Definitions in plain Python, to test the column expressions against."""

import hashlib
import struct
from itertools import combinations

from nearkin.functions.hashing import PRIME, hash_family


def h31(data: bytes) -> int:
    return int.from_bytes(hashlib.md5(data).digest(), "big") % PRIME


def shingle_set(words, k):
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def signature(shingles, n):
    hashes = [h31(s.encode()) for s in shingles]
    return [min((a * h + b) % PRIME for h in hashes) for a, b in hash_family(n)] if hashes else []


def buckets(sig, bands, rows):
    return {
        (i, h31(struct.pack(f">{rows}i", *sig[i * rows : (i + 1) * rows]))) for i in range(bands)
    }


def candidate_pairs(signatures, bands, rows):
    held = {key: buckets(sig, bands, rows) for key, sig in signatures.items() if sig}
    return {(a, b) for a, b in combinations(sorted(held), 2) if held[a] & held[b]}


def estimate(a, b):
    if not a or len(a) != len(b):
        return 0.0
    return sum(x == y for x, y in zip(a, b)) / len(a)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0
