"""Words of many texts at once, as 64-bit hashes, in numpy.

A word's hash is a chain over its blocks of eight bytes, each mixed into what
came before by a 64-bit finaliser, for all words of a buffer side by side; words
of more than LONG bytes, of which there are few, go through BLAKE2b one by one.
Neither has the algebra of a polynomial, for which whole families of texts share
a hash. Two words of up to eight bytes and one length never share one; others
do with a chance of about 2**-64. Operators that need certainty compare the
words behind a hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np

#: Bytes hashed at a time. Longer texts are cut at word ends, never truncated.
SEGMENT = 1 << 21

#: Bytes of a word beyond which it is hashed by itself.
LONG = 64
_SEED, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
#: The first k bytes of a block (little-endian).
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: The two word classes of the contracts, by byte; bytes of 0x80 and more
#: belong to characters that both count as parts of words.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ALNUM[0x41:0x5B] = True  # upper case counts, as texts are lower-cased first

_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the splitmix64 finaliser)."""
    h = (h ^ (h >> _S30)) * _M1
    h = (h ^ (h >> _S27)) * _M2
    return h ^ (h >> _S31)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the usual lengths."""
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if n <= 2 * SEGMENT:
        _powers[base] = out
    return out[:n]


def spans(buf: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which ``inside`` holds."""
    flags = np.zeros(len(buf) + 2, dtype=np.int8)
    flags[1:-1] = inside[buf]
    edges = np.flatnonzero(np.diff(flags))
    return edges[::2], edges[1::2]


def blocks(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a buffer on, as 64-bit numbers (zeros
    behind the end), A-Z lower-cased."""
    padded = np.zeros(len(buf) + 8, dtype=np.uint8)
    np.take(LOWER, buf, out=padded[:len(buf)])
    return np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the (not empty) byte spans of a buffer, A-Z lower-cased."""
    at, size = blocks(buf), ends - starts
    h = size.astype(np.uint64) * _SEED
    live, k = np.flatnonzero(size <= LONG), 0
    while len(live):
        block = at[starts[live] + k] & FIRST[np.minimum(size[live] - k, 8)]
        h[live] = mix(h[live] * _STEP ^ block)
        k += 8
        live = live[size[live] > k]
    for j in np.flatnonzero(size > LONG).tolist():
        word = LOWER[buf[starts[j]:ends[j]]].tobytes()
        h[j] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
    return h


def _gap(buf: np.ndarray, at: int, inside: np.ndarray) -> int:
    """The first place from ``at`` on that is outside any word."""
    for lo in range(at, len(buf), 4096):
        out = np.flatnonzero(~inside[buf[lo:lo + 4096]])
        if len(out):
            return lo + int(out[0])
    return len(buf)


def find_words(texts: list[bytes], inside: np.ndarray) -> "Words":
    """All words of the texts, in order; ``inside`` says which bytes belong to
    words (the space must not). Work arrays stay near SEGMENT bytes."""
    joined = b" ".join(texts)
    buf = np.frombuffer(joined, dtype=np.uint8)
    starts, ends, hashes, lo = [], [], [], 0
    while lo < len(buf):
        hi = _gap(buf, lo + SEGMENT, inside) if len(buf) - lo > SEGMENT else len(buf)
        s, e = spans(buf[lo:hi], inside)
        hashes.append(hash_spans(buf[lo:hi], s, e))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    whole = [np.concatenate(x) if x else np.zeros(0, dtype=kind)
             for x, kind in ((starts, np.int64), (ends, np.int64), (hashes, np.uint64))]
    return Words(joined, *whole, np.searchsorted(whole[0], first))


class Words(NamedTuple):
    """Words of joined texts: byte spans, hashes, and ``bounds``: the words of
    text k are those from bounds[k] to bounds[k + 1]."""

    joined: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def word(self, k: int) -> bytes:
        return self.joined[self.starts[k]:self.ends[k]].lower()


def grouped(batches: Iterable, *columns: str) -> Iterator[list[list]]:
    """Rows of Arrow batches as Python lists per column, in groups of about
    SEGMENT bytes of the last column (strings come as UTF-8 bytes, null as
    empty); a longer text makes a group of its own."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        sizes = pc.fill_null(pc.binary_length(cols[-1].cast(pa.binary())), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // SEGMENT
        for lo, hi in zip(*_runs(group)):
            part = [c.slice(lo, hi - lo) for c in cols]
            yield [*(c.to_pylist() for c in part[:-1]),
                   [t or b"" for t in part[-1].cast(pa.binary()).to_pylist()]]


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal values."""
    if not len(values):
        return [], []
    cuts = (np.flatnonzero(np.diff(values)) + 1).tolist()
    return [0, *cuts], [*cuts, len(values)]
