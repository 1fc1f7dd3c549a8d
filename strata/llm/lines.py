"""Lines that many documents share, dropped through a sharded minimal perfect hash.

``build_index`` writes the index of all lines that at least two documents
hold: the lines' 128-bit digests are dealt into shards, every shard gets a
minimal perfect hash (a cascade of bit levels: a digest that is alone on its
bit stays there, the others try the next level; the number of set bits before
a digest's own is its slot) and three arrays by slot: a 64-bit fingerprint, the
number of documents, the largest id of them. ``drop_repeated`` maps the files
into memory and probes the arrays while it reads the texts: documents and lines
are neither joined nor shuffled. A line that is not in the index meets some
slot or none; its fingerprint differs, but for a chance of 2**-64.

Every line of every document is counted. A task holds the arrays of one file
(its share of the digests, some 20 bytes each) while it builds and one group of
texts while it probes; the driver gets one row per file, and there are no more
files than shuffle partitions. The files live in the shared folder; where it cannot be mapped
into memory, a file is read when the first probe needs it.

Defined cases: lines end at ``\\n`` alone; a null or empty text is one empty
line; a line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at
its ends, A-Z lower-cased; documents are distinct ids, so that repeated rows
of one id count once and all of them keep the lines that the id keeps; null
ids are one document that comes before all others; a document that loses all
its lines has an empty text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, shuffle_partitions
from strata.llm.lm import read_arrays, write_arrays
from strata.llm.words import grouped, mix
from strata.session import materialize

MIN_CHARS = 40
MIN_DOCS = 5
#: Digests of a shard, about; and of a file at least, so that small inputs don't give many files.
SHARD_KEYS = 1 << 14
FILE_KEYS = 1 << 12
#: Bits of a level for each digest that reaches it.
GAMMA = 2
SPACE = b" \t\n\x0b\x0c\r"
_STEP = 0x9E3779B97F4A7C15


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line's key, or None if it has fewer than ``min_chars`` code points."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def line_counts(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n, last): the two halves of each key's digest, how many documents
    hold it, and the largest id of them."""
    def keys(batches):
        import pyarrow as pa

        for ids, texts in grouped(batches, "doc_id", "text"):
            docs, found = [], []
            for doc, text in zip(ids, texts):
                own = {digest(k) for line in text.split(b"\n") if (k := key_of(line, min_chars)) is not None}
                found += own
                docs += [doc] * len(own)
            pairs = _pairs(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["doc_id", "a", "b"])

    held = rows.mapInArrow(keys, "doc_id long, a long, b long").distinct()
    return held.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))


def file_name(number: int) -> str:
    return f"lines-{number:06d}.mph"


def _level_hash(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    return mix(mix(a + np.uint64(level * _STEP % (1 << 64))) ^ b)


def perfect_hash(a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(bits of each level, slot of each key) for distinct pairs of uint64."""
    levels, place, left, offset = [], np.zeros(len(a), dtype=np.int64), np.arange(len(a)), 0
    while len(left):
        if len(levels) == 256:
            raise ValueError("equal digests in one shard")
        size = max(64, GAMMA * len(left))
        at = (_level_hash(a[left], b[left], len(levels)) % np.uint64(size)).astype(np.int64)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        place[left[alone]] = offset + at[alone]
        left, offset = left[~alone], offset + size
        levels.append(bits)
    slot = np.empty(len(a), dtype=np.int64)
    slot[np.argsort(place)] = np.arange(len(a))
    return levels, slot


class IndexFile:
    """Shards are added in the order of their numbers; their arrays are put end
    to end when the file is closed, with where each shard and level begins."""

    def __init__(self, number: int):
        self.number, self.shards = number, []

    def add(self, shard: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, last: np.ndarray) -> None:
        levels, slot = perfect_hash(a, b)
        by = np.argsort(slot)
        self.shards.append((shard, levels, b[by], n[by], last[by]))

    def write(self, folder: str, shards_per_file: int) -> dict:
        depth = max(len(s[1]) for s in self.shards)
        size = np.zeros((shards_per_file, depth), dtype=np.uint32)
        start = np.zeros((shards_per_file, depth), dtype=np.int64)
        at, bits = 0, []
        for shard, levels, *_ in self.shards:
            for k, level in enumerate(levels):
                size[shard % shards_per_file, k], start[shard % shards_per_file, k] = len(level), at
                at += len(level)
                bits.append(level)
        packed = np.packbits(np.concatenate([*bits, np.zeros(-at % 512, dtype=bool)]))
        ones = np.bitwise_count(packed).reshape(-1, 64).sum(axis=1, dtype=np.int64)
        n = np.concatenate([s[3] for s in self.shards])
        arrays = {"size": size.ravel(), "start": start.ravel(), "bits": packed, "ranks": np.cumsum(ones) - ones,
                  "print": np.concatenate([s[2] for s in self.shards]),
                  "n": n.astype(np.min_scalar_type(int(n.max()))), "last": np.concatenate([s[4] for s in self.shards])}
        size = write_arrays(folder, file_name(self.number), arrays)
        return {"number": self.number, "bytes": size, "n_keys": len(n)}


def build_index(rows: DataFrame, folder: str, min_chars: int = MIN_CHARS) -> dict:
    """Write the index of ``rows`` (doc_id, text) below ``folder``; returns what
    a probe needs to know of it: folder, files and shards a file, and each file's bytes."""
    spark = rows.sparkSession
    held = materialize(line_counts(rows, min_chars).where("n > 1"), "lines")
    total = held.count()
    files = min(shuffle_partitions(spark), max(1, total // FILE_KEYS))
    per_file = max(1, total // files // SHARD_KEYS)

    def build(batches):
        import pyarrow as pa

        kind = pa.schema([("number", pa.int64()), ("bytes", pa.int64()), ("n_keys", pa.int64())])
        out = None
        for shard, a, b, n, last in _shards(batches):
            if out is None or out.number != shard // per_file:
                if out is not None:
                    yield pa.RecordBatch.from_pylist([out.write(folder, per_file)], schema=kind)
                out = IndexFile(shard // per_file)
            out.add(shard, a.view(np.uint64), b.view(np.uint64), n, last)
        if out is not None:
            yield pa.RecordBatch.from_pylist([out.write(folder, per_file)], schema=kind)

    shard = F.pmod(F.col("a"), F.lit(files * per_file))
    dealt = held.select("a", "b", "n", "last", shard.alias("shard"), F.floor(shard / per_file).alias("file")) \
        .repartition(files, "file").sortWithinPartitions("shard", "a", "b")
    manifest = materialize(dealt.drop("file").mapInArrow(build, "number long, bytes long, n_keys long"), "line-files")
    return {"folder": folder, "files": files, "per_file": per_file,
            "bytes": {r.number: r.bytes for r in manifest.collect()}}


def _shards(batches) -> Iterator[tuple]:
    """Whole shards of rows that come in the order of their shards."""
    now, parts = None, []
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                for c in ("shard", "a", "b", "n", "last")]
        cuts = np.flatnonzero(np.diff(cols[0])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(cols[0])]):
            if lo == hi:
                continue
            if cols[0][lo] != now and parts:
                yield now, *(np.concatenate(x) for x in zip(*parts))
                parts = []
            now = int(cols[0][lo])
            parts.append([c[lo:hi] for c in cols[1:]])
    if parts:
        yield now, *(np.concatenate(x) for x in zip(*parts))


class Probe:
    """Looks lines up in an index."""

    def __init__(self, index: dict):
        self.index = index
        self.load = lru_cache(None)(lambda k: read_arrays(index["folder"], file_name(k), index["bytes"][k]))

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, largest id) per digest; 0 documents where it is not held."""
        n, last = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
        per_file = self.index["per_file"]
        shard = pairs[:, 0] % np.int64(self.index["files"] * per_file)
        file = shard // per_file
        order = np.argsort(file, kind="stable")
        cuts = np.flatnonzero(np.diff(file[order], prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            k = int(file[order[lo]])
            if k in self.index["bytes"]:
                at = order[lo:hi]
                n[at], last[at] = self._in_file(self.load(k), shard[at] % per_file, pairs[at].view(np.uint64))
        return n, last

    def _in_file(self, f: dict, shard: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        depth = len(f["size"]) // self.index["per_file"]
        a, b = pairs[:, 0], pairs[:, 1]
        slot, left = np.full(len(a), -1), np.arange(len(a))
        for level in range(depth):
            cell = shard[left] * depth + level
            size = f["size"][cell].astype(np.uint64)
            left, cell, size = left[size > 0], cell[size > 0], size[size > 0]
            bit = f["start"][cell] + (_level_hash(a[left], b[left], level) % size).astype(np.int64)
            hit = (f["bits"][bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0
            slot[left[hit]] = _rank(f, bit[hit])
            left = left[~hit]
        sure = np.flatnonzero(slot >= 0)
        sure = sure[f["print"][slot[sure]] == b[sure]]
        n, last = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
        n[sure], last[sure] = f["n"][slot[sure]], f["last"][slot[sure]]
        return n, last


def _rank(f: dict, bit: np.ndarray) -> np.ndarray:
    """Set bits before each place: those of whole blocks of 64 bytes are stored."""
    block = bit >> 9
    words = f["bits"][(block[:, None] << 6) + np.arange(64)]
    byte = (bit >> 3) & 63
    words[np.arange(64) > byte[:, None]] = 0
    words[np.arange(len(bit)), byte] &= (0xFF00 >> (bit & 7)).astype(np.uint8)
    return f["ranks"][block] + np.bitwise_count(words).sum(axis=1, dtype=np.int64)


def drop_repeated(rows: DataFrame, index: dict, *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text without the lines that at least ``min_docs`` (two or more)
    documents hold, but in the one of the largest id, n_lines, n_dropped."""
    if min_docs < 2:
        raise ValueError("the index holds the lines of two documents and more")

    def probe(batches):
        import pyarrow as pa

        look = Probe(index)
        for ids, texts in grouped(batches, "doc_id", "text"):
            lines, places, found = [t.split(b"\n") for t in texts], [], []
            for d, own in enumerate(lines):
                for k, line in enumerate(own):
                    if (key := key_of(line, min_chars)) is not None:
                        places.append((d, k))
                        found.append(digest(key))
            n, last = look.find(_pairs(found))
            n_lines, dropped = [len(x) for x in lines], [0] * len(lines)
            for j in np.flatnonzero(n >= min_docs).tolist():
                d, k = places[j]
                if ids[d] != last[j]:
                    lines[d][k] = None
                    dropped[d] += 1
            text = [b"\n".join(x for x in own if x is not None) for own in lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(text, pa.binary()).cast(pa.string()),
                 pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["doc_id", "text", "n_lines", "n_dropped"])

    return rows.mapInArrow(probe, "doc_id long, text string, n_lines long, n_dropped long")


def dedup_lines(docs: DataFrame, folder: str, *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index the lines of ``docs`` below ``folder`` and drop the repeated ones."""
    rows = id_text(docs, id_col, text_col)
    return drop_repeated(rows, build_index(rows, folder, min_chars), min_docs=min_docs, min_chars=min_chars)


def digests(kept: DataFrame) -> DataFrame:
    """The contract's columns."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
