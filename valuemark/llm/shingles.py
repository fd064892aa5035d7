"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once on their bytes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a polynomial over its bytes,
taken as a difference of running sums; a shingle's mixes those of its words. Two of a corpus' shingles share
a hash with a chance of about one in 2^60.
"""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 2**63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _rng.integers(1, 2**63, 64, dtype="u8") * np.uint64(2) + np.uint64(1)
_DELIMITER = np.zeros(256, bool)
_DELIMITER[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 - 2)  # odd, 3 modulo 8
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = {"up": np.ones(1, "u8"), "down": np.ones(1, "u8")}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, "u8")
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype="u8")
    return _powers[name][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunks(texts: list[str]):
    held, size = [], 0
    for t in texts:
        held.append(t.encode("utf-8", "surrogatepass"))
        size += len(held[-1]) + 1
        if size > CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def shingle_sets(texts: list[str], n: int):
    """The sorted distinct shingle hashes of each text; a text of fewer than ``n`` words is one shingle, without words none."""
    for held in _chunks(texts):
        data = np.frombuffer(b"\n".join([*held, b""]), "u1")
        lengths = np.array([len(h) + 1 for h in held])
        ends_of_text = np.cumsum(lengths)
        gap = _DELIMITER[data]
        edge = np.diff(gap.astype("i1"), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, "u8")
            np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), out=sums[1:])
            words = mixed((sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data) + 1)[starts] + (ends - starts).astype("u8") * _PLACE[63])
            first = np.searchsorted(starts, ends_of_text - lengths)
            last = np.searchsorted(starts, ends_of_text)
            whole = max(0, len(words) - n + 1)
            grams = np.zeros(whole, "u8")
            for k in range(n):
                grams += words[k : k + whole] * _PLACE[k]
            grams = mixed(grams)
            for a, b in zip(first.tolist(), last.tolist()):
                if b - a >= n:
                    yield np.unique(grams[a : b - n + 1])
                elif b > a:
                    yield mixed((words[a:b] * _PLACE[: b - a]).sum(dtype="u8", keepdims=True) + _PLACE[62] * np.uint64(b - a))
                else:
                    yield np.zeros(0, "u8")


def set_digest(tokens: np.ndarray) -> int:
    """A signed 64-bit digest of a set: equal sets, equal digests."""
    with np.errstate(over="ignore"):
        total = np.array([tokens.sum(dtype="u8") ^ np.bitwise_xor.reduce(mixed(tokens + _PLACE[61]), initial=np.uint64(0)) + np.uint64(len(tokens))], "u8")
        return int(mixed(total).astype("i8")[0])


def set_check(tokens: np.ndarray) -> int:
    """Another such digest, made of other sums: two sets share both with a chance of one in 2^128."""
    with np.errstate(over="ignore"):
        total = np.array([mixed(tokens ^ _PLACE[60]).sum(dtype="u8") * _PLACE[59] ^ np.bitwise_xor.reduce(mixed(tokens * _PLACE[58]), initial=np.uint64(0))], "u8")
        return int(mixed(total).astype("i8")[0])
