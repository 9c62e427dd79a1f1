"""Word and shingle hashes of whole texts, vectorised over batches of documents.

There are two independent kinds of hash, 64 bits each: candidates are found by
kind 0, equality and similarity are decided by kind 1 or by both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from .common import mix64

WIDTH = 5
#: A-Z lower-cased; the six separators become a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
#: Two primes below 2**32 and two bases for each of two independent word hashes, drawn by rule.
_PRIMES = (4294967291, 4294967279)
_BASES = tuple(tuple(int(x) % (p - 65_536) + 65_536 for x, p in zip(mix64(np.arange(seed, seed + 2, dtype=np.uint64)), _PRIMES, strict=True)) for seed in (1001, 2001))
_Q = tuple(mix64(np.arange(seed, seed + WIDTH + 1, dtype=np.uint64)) | np.uint64(1) for seed in (101, 201))
BLOCK = 1 << 18
#: Longer words are hashed one by one, so that a block with the word at its end stays below _REACH bytes; at least 2 * BLOCK.
LONG_WORD = 1 << 19
_REACH = 1 << 20

_powers: dict[tuple[int, int], np.ndarray] = {}


def _power_table(base: int, prime: int) -> np.ndarray:
    """Powers of base modulo prime, 0 to _REACH, by doubling."""
    if (base, prime) not in _powers:
        out = np.ones(_REACH + 1, np.uint64)
        size = 1
        while size < len(out):
            step = out[: min(size, len(out) - size)] * np.uint64(pow(base, size, prime)) % np.uint64(prime)
            out[size : size + len(step)] = step
            size += len(step)
        _powers[base, prime] = out
    return _powers[base, prime]


def _edges(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.concatenate(([True], a == 32, [True]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


class Sums:
    """Hashes of stretches of a block: polynomials of their bytes modulo two primes.

    The sums of a block stay below 2**61, so nothing wraps around; a hash
    modulo a power of two would collide for structured words whatever its base.
    """

    def __init__(self, a: np.ndarray, kind: int):
        digits = a.astype(np.uint64) + np.uint64(1)
        self.tables = [_power_table(b, p) for b, p in zip(_BASES[kind], _PRIMES, strict=True)]
        self.totals = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(digits * t[: len(a)]))) for t in self.tables]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        low, high = ((total[ends] - total[starts]) % np.uint64(p) * table[_REACH - starts] % np.uint64(p) for total, table, p in zip(self.totals, self.tables, _PRIMES, strict=True))
        return mix64((high << np.uint64(32)) | low)


def _long_hash(word: bytes, kind: int) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=bytes([kind])).digest(), "little")


def _blocks(data: bytes) -> Iterator[tuple[int, int, bool]]:
    """Start and end of consecutive blocks cut at spaces, and whether a block is one long word."""
    at = 0
    while at < len(data):
        if len(data) - at <= 2 * BLOCK:
            end = len(data)
        else:
            end = data.find(b" ", at + BLOCK)
            end = len(data) if end < 0 else end
        if end - at > BLOCK:
            first = data.rfind(b" ", at, at + BLOCK) + 1 or at
            if end - first > LONG_WORD:
                if first > at:
                    yield at, first, False
                yield first, end, True
                at = end
                continue
        yield at, end, False
        at = end


def prefix_hashes(data: bytes, lengths: tuple[int, ...]) -> np.ndarray:
    """Hashes of the first bytes of each longer word, for each of the lengths."""
    out = [np.zeros(0, np.uint64)]
    for at, end, alone in _blocks(data):
        a = np.frombuffer(data, np.uint8, (at + max(lengths) + 1 if alone else end) - at, at)
        hashed, (starts, ends) = Sums(a, 0), _edges(a)
        for n in lengths:
            long = starts[ends - starts > n]
            out.append(mix64(hashed(long, long + n) ^ np.uint64(0x5851F42D4C957F2D * n & (1 << 64) - 1)))
    return np.concatenate(out)


def word_hashes(data: bytes, kinds: tuple[int, ...] = (0,)) -> tuple[np.ndarray, ...]:
    """Start byte of each word of normalised data, and its hash of each of the kinds."""
    parts: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in kinds))]
    for at, end, alone in _blocks(data):
        if alone:
            parts.append((np.array([at], np.int64), *(np.array([_long_hash(data[at:end], k)], np.uint64) for k in kinds)))
            continue
        a = np.frombuffer(data, np.uint8, end - at, at)
        starts, ends = _edges(a)
        parts.append((starts + at, *(Sums(a, k)(starts, ends) for k in kinds)))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def groups_of(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """First index and normalised texts of consecutive groups of about a block of bytes."""
    at, size, group = 0, 0, []
    for t in texts:
        group.append((t or b"").translate(NORMAL))
        size += len(group[-1])
        if size >= BLOCK:
            yield at, group
            at, size, group = at + len(group), 0, []
    if group:
        yield at, group


def _shingles(words: np.ndarray, kind: int, whole: np.ndarray, short: np.ndarray, first: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of WIDTH words that begin where ``whole`` is true, then of the short texts."""
    q = _Q[kind]
    s = np.zeros(len(whole), np.uint64)
    for j in range(WIDTH):
        s += words[j : j + len(whole)] * q[j]
    t = q[WIDTH] * n_words[short].astype(np.uint64)
    for j in range(WIDTH - 1):
        has = n_words[short] > j
        t[has] += words[first[short[has]] + j] * q[j]
    return mix64(np.concatenate((s[whole], t)))


def shingle_sets(texts: list[bytes], kinds: tuple[int, ...] = (0,)) -> tuple[np.ndarray, ...]:
    """Document number and hash of each distinct shingle, sorted by both, then set sizes, then its hashes of any further kind.

    Fewer than WIDTH words make one shingle.
    """
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    doc_start = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)[:-1]))
    starts, *words = word_hashes(b" ".join(texts), kinds)
    doc = np.searchsorted(doc_start, starts, "right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.concatenate((np.zeros(1, np.int64), np.cumsum(n_words)[:-1]))
    n = max(0, len(starts) - WIDTH + 1)
    whole = doc[:n] == doc[len(doc) - n :]
    short = np.flatnonzero((n_words > 0) & (n_words < WIDTH))
    d = np.concatenate((doc[:n][whole], short))
    h, *more = (_shingles(w, k, whole, short, first, n_words) for w, k in zip(words, kinds, strict=True))
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    d, h = d[fresh], h[fresh]
    return d, h, np.bincount(d, minlength=len(texts)), *(g[order][fresh] for g in more)


def set_key(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> np.ndarray:
    """A 64-bit key of each document's set; equal sets have equal keys."""
    total = np.zeros(n_docs, np.uint64)
    if len(doc):
        at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        total[doc[at]] = np.add.reduceat(mix64(hashes ^ np.uint64(0x243F6A8885A308D3)), at)
    return total


def rank_in_doc(doc: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of equal document numbers."""
    if not len(doc):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    return np.arange(len(doc)) - np.repeat(at, np.diff(np.concatenate((at, [len(doc)]))))
