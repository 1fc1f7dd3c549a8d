"""Language-model scores from an Elias-Fano n-gram trie.

The trie has one level per order. Level 1 holds the training words' sorted
64-bit hashes, Elias-Fano coded, with their counts; a word's rank is its id.
Level n holds n-grams sorted by parent (the rank of their first n - 1 words in
level n - 1) and last word: pointers from parent to children and the word ids,
made monotone by adding the last value of the parents before, are Elias-Fano
sequences. A word is sought below its context: the context's pointers and base
are read, and the successor of base + word id is searched from there.

Every n-gram carries its discounted probability, every context the mass left
for shorter contexts, both as 8-bit codes of their logarithm. A level's codes
reach down to what an n-gram of the least count has after the level's commonest
context, so that nothing is clipped whatever the counts; each file holds its
codebook. The probability of a word is the discounted one of each order plus the mass left times that of
the order below; order 1 is the contract's additive base.

Levels are cut into shards by ranges of keys, written by Spark tasks to the
shared folder and memory-mapped by the scoring tasks (read into memory, shard
by shard, where the store can't be mapped). A task sorts its distinct queries,
so it goes through the shards in order and touches only pages it needs; no
part of the model is broadcast or passes through the driver but the list of
shards and the contexts at their ends.

Counts are over all training tokens, and every n-gram that occurs is stored.
With a higher ``min_count`` the rarer ones are left out (their mass stays with
the shorter context); a longer n-gram is then only counted where both shorter
ones it is made of are stored, which loses none that reaches the minimum.

A level's n-grams are sent once, packed by ranges of keys whose bounds come
from a sample, and each range is added up and written as a shard with the
masses its contexts leave. What a context that may go on in another shard
leaves is added up on the driver, two contexts a shard at most.

Defined cases: a null or empty text is its end token alone; a row without id
is training text; without training text every token is unknown. Each repeated
row is scored.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SharedFile, filesystem, id_text, read_range, shuffle_partitions
from strata.llm.elias import EliasFano
from strata.llm.words import NOT_SPACE, find_words, grouped, mix
from strata.session import materialize, scratch_path

ORDER = 3
MIN_COUNT = 1
DISCOUNT = 0.75
ADD = 0.1
#: Tokens gathered in a task before their n-grams are sent on.
FLUSH = 4 << 20
#: N-grams sent on in one batch, about.
SENT = 1 << 18
#: Bytes of text whose n-grams are looked up together: the more, the fewer
#: distinct queries per token and visits to each shard.
TOGETHER = 8 << 20
#: Tokens in a range of n-grams: at least as many, so that small inputs make few
#: files, and at most, so that a range fits a task; sampled ones per range.
LEAST, MOST, SAMPLE = 1 << 12, 1 << 21, 512
#: Bytes of a level whose shards are held open. Queries go through the shards in
#: order, so of a larger level a shard would be closed again before its next use.
HELD = 16 << 20
END = np.uint64(0x656E64206F662074)
_TAIL = struct.Struct("<Q")


def codebook(least: float) -> np.ndarray:
    """256 values from 1 down to ``least``, even steps of the logarithm apart."""
    return min(least, 0.1) ** (np.arange(256) / 255)


def quantise(p: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The codes of the values of a codebook next to p by the logarithm."""
    return np.clip(np.rint(np.log(np.maximum(p, book[-1])) / np.log(book[-1]) * 255), 0, 255).astype(np.uint8)


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> int:
    """Arrays end to end, then a list of them; returns the file's size."""
    out, parts = SharedFile(folder, name), []
    for k, a in arrays.items():
        a = np.ascontiguousarray(a)
        out.write(b"\0" * (-out.size % 8))
        parts.append((k, str(a.dtype), len(a), out.write(a.tobytes())))
    raw = json.dumps(parts).encode()
    out.write(raw)
    out.write(_TAIL.pack(len(raw)))
    out.close()
    return out.size


def read_arrays(folder: str, name: str, size: int) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped where it is a local or shared one."""
    from pyarrow import fs

    on, top = filesystem(folder)
    if isinstance(on, fs.LocalFileSystem):
        data = np.memmap(f"{top}/{name}", dtype=np.uint8, mode="r").view(np.ndarray)
    else:
        data = np.frombuffer(read_range(folder, name, 0, size), dtype=np.uint8)
    (n,) = _TAIL.unpack(data[size - 8:size].tobytes())
    parts = json.loads(data[size - 8 - n:size - 8].tobytes())
    return {k: data[at:at + c * np.dtype(t).itemsize].view(t) for k, t, c, at in parts}


class Shards:
    """One level's files: (first key, name, size, entries before, entries)."""

    def __init__(self, folder: str, files: list[tuple]):
        self.folder, self.files = folder, files
        self.load = lru_cache(64 if sum(f[2] for f in files) <= HELD else 2)(self._load)

    def _load(self, k: int) -> dict:
        _, name, size, before, _ = self.files[k]
        arrays = read_arrays(self.folder, name, size)
        out = {"before": before, **{a: arrays[a] for a in arrays if "." not in a}}
        for seq in {a.split(".")[0] for a in arrays if "." in a}:
            out[seq] = EliasFano.load(arrays, seq)
        return out

    def parts(self, shard_of: np.ndarray):
        """(shard, the queries that go to it) for sorted queries."""
        cuts = np.flatnonzero(np.diff(shard_of, prepend=-2))
        for lo, hi in zip(cuts, [*cuts[1:], len(shard_of)]):
            if shard_of[lo] >= 0:
                yield self.load(int(shard_of[lo])), slice(int(lo), int(hi))


class Words(Shards):
    """Level 1."""

    def find(self, keys: np.ndarray, value: str) -> tuple[np.ndarray, np.ndarray]:
        """(ranks or -1, the array ``value`` at them or 0) of sorted keys."""
        rank = np.full(len(keys), -1, dtype=np.int64)
        got = np.zeros(len(keys), dtype=np.int64)
        first = np.array([f[0] for f in self.files], dtype=np.uint64)
        for s, part in self.parts(np.searchsorted(first, keys, side="right") - 1):
            at, found = s["keys"].successor(keys[part])
            rank[part] = np.where(found, at + s["before"], -1)
            got[part][found] = s[value][at[found]]
        return rank, got

    def at(self, ranks: np.ndarray, value: str) -> np.ndarray:
        """The array ``value`` at sorted ranks."""
        got = np.zeros(len(ranks), dtype=np.int64)
        before = np.array([f[3] for f in self.files])
        for s, part in self.parts(np.searchsorted(before, ranks, side="right") - 1):
            got[part] = s[value][ranks[part] - s["before"]]
        return got


class Masses(Shards):
    """What a level's contexts leave: a code for each rank from a shard's first
    context to its last, 0 (all is left) where a rank isn't a context."""

    def codes(self, ranks: np.ndarray) -> np.ndarray:
        """Of sorted ranks."""
        got = np.zeros(len(ranks), dtype=np.uint8)
        first = np.array([f[0] for f in self.files], dtype=np.int64)
        for s, part in self.parts(np.searchsorted(first, ranks, side="right") - 1):
            at = ranks[part] - s["first"][0]
            got[part] = np.where(at < len(s["codes"]), s["codes"][np.minimum(at, len(s["codes"]) - 1)], 0)
        return got


class Grams(Words):
    """A level above 1. Its files' first keys are (parent, word) pairs."""

    def seek(self, parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ranks or -1, probabilities or 0) of (parent, word) queries sorted so."""
        rank, own = np.full(len(parent), -1, dtype=np.int64), np.zeros(len(parent))
        firsts = [f[0] for f in self.files]
        p0, w0 = (np.array([f[k] for f in firsts], dtype=np.int64) for k in (0, 1))
        shard = np.searchsorted(p0, parent, side="right") - 1
        while True:                       # a parent may begin several shards
            early = (shard >= 0) & (p0[shard] == parent) & (w0[shard] > word)
            if not early.any():
                break
            shard = shard - early
        for s, part in self.parts(shard):
            p = parent[part] - s["first"][0]
            new = np.append(True, p[1:] != p[:-1])         # the pointers are read once per parent
            p, of = p[new], np.cumsum(new) - 1
            inside = p < s["pointers"].n - 1
            lo, hi = np.zeros(len(p), dtype=np.int64), np.zeros(len(p), dtype=np.int64)
            lo[inside] = s["pointers"].access(p[inside])
            hi[inside] = s["pointers"].access(p[inside] + 1)
            base, some = np.zeros(len(p), dtype=np.uint64), (lo > 0) & (lo < hi)
            base[some] = s["words"].access(lo[some] - 1)
            known = np.flatnonzero((lo < hi)[of])
            of = of[known]
            at, found = s["words"].successor(base[of] + (word[part][known] + 1).astype(np.uint64))
            found &= (at >= lo[of]) & (at < hi[of])
            place = np.arange(part.start, part.stop)[known[found]]
            rank[place] = at[found] + s["before"]
            own[place] = s["book"][s["codes"][at[found]]]
        return rank, own


class Trie:
    """All levels, from the list of their files."""

    def __init__(self, folder: str, levels: list[list[tuple]], masses: list[tuple], total: int):
        self.words = Words(folder, levels[0])
        self.grams = [Grams(folder, f) for f in levels[1:]]
        self.masses = [(Masses(folder, f), np.array([e[0] for e in edges], dtype=np.int64),
                        np.array([e[1] for e in edges]), codebook(least)) for f, edges, least in masses]
        self.total = total
        self.distinct = sum(f[4] for f in levels[0])

    def ids(self, h: np.ndarray, counts: bool = False) -> tuple[np.ndarray, ...]:
        """Ids (or -1) of words by hash; if asked for, their counts and the
        masses they leave as contexts too."""
        keys, back = distinct(h)
        rank, count = self.words.find(keys, "counts")
        return (rank[back], count[back], self.mass(1, rank)[back]) if counts else (rank[back],)

    def seek(self, level: int, parent: np.ndarray, word: np.ndarray, ranks: bool = True,
             scores: bool = True) -> tuple[np.ndarray | None, np.ndarray | None, np.ndarray | None]:
        """(ranks or -1, discounted probabilities, masses left as contexts) in
        a level above 1. Ranks rise with the sorted queries, so the masses are
        sought by the same order. Without ``ranks`` only the probabilities are
        found, without ``scores`` only the ranks."""
        ask, back = (parent >= 0) & (word >= 0), None
        if self.grams[level - 2].files and ask.any():
            key, back = distinct(pair(parent[ask], word[ask], self.distinct))
            a = key // np.uint64(self.distinct)
            key -= a * np.uint64(self.distinct)
            r, own = self.grams[level - 2].seek(a.view(np.int64), key.view(np.int64))
            del a, key

        def at_all(kind: type, none: float, found) -> np.ndarray:
            out = np.full(len(parent), none, dtype=kind)
            if back is not None:
                out[ask] = found()[back]
            return out

        masses = level <= len(self.masses)
        return (at_all(np.int64, -1, lambda: r) if ranks else None, at_all(np.float64, 0, lambda: own) if scores else None,
                at_all(np.float64, 1, lambda: self.mass(level, r) if masses else np.ones(len(r)))
                if ranks and scores else None)

    def mass(self, level: int, context: np.ndarray) -> np.ndarray:
        """What contexts of ``level`` words, rising but for -1, leave to
        shorter ones; 1 if they have nothing stored."""
        out = np.ones(len(context))
        ask = np.flatnonzero(context >= 0)
        if len(ask) and level <= len(self.masses):
            inner, edges, left, book = self.masses[level - 1]
            out[ask] = book[inner.codes(context[ask])]
            if len(edges):
                at = np.minimum(np.searchsorted(edges, context[ask]), len(edges) - 1)
                out[ask] = np.where(edges[at] == context[ask], left[at], out[ask])
        return out

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADD) / (self.total + ADD * (self.distinct + 1))

    def score(self, ids: np.ndarray, base: np.ndarray, left: np.ndarray, start: np.ndarray) -> np.ndarray:
        """log10 probabilities of tokens in a row, from their ids, additive
        probabilities and masses; ``start``: a text begins."""
        p, rank = base, ids
        for level in range(2, len(self.grams) + 2):
            mass = behind(left, 1.0, start)
            mass *= p
            p, left = mass, None
            rank, own, left = self.seek(level, behind(rank, -1, start), ids, ranks=level <= len(self.grams))
            p += own
        return np.log10(p)


def behind(values: np.ndarray, none: float, start: np.ndarray) -> np.ndarray:
    """The value of the token before each token; ``none`` where a text begins."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[start] = none
    return out


def pair(parent: np.ndarray, word: np.ndarray, distinct: int) -> np.ndarray:
    key = parent.astype(np.uint64)
    key *= np.uint64(distinct)
    key += word.astype(np.uint64)
    return key


def first_of(ordered: np.ndarray) -> np.ndarray:
    """Whether each of some ordered values is the first of its kind."""
    out = np.ones(len(ordered), dtype=bool)
    out[1:] = ordered[1:] != ordered[:-1]
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct keys, sorted; the place of each key among them), with
    fewer and narrower arrays at a time than numpy's unique."""
    order = np.argsort(keys)
    keys = keys[order]
    new = first_of(keys)
    keys = keys[new]
    place = np.cumsum(new, dtype=np.int32 if len(new) < 1 << 31 else np.int64)
    place -= 1
    back = np.empty_like(place)
    back[order] = place
    return keys, back


def counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sorted; how often each occurs) of arrays, which go."""
    keys = np.concatenate(held)
    held.clear()
    keys.sort()
    first = np.flatnonzero(first_of(keys))
    return keys[first], np.diff(first, append=len(keys))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, an end after each text; bounds of the texts)."""
    words = find_words(texts, NOT_SPACE)
    return (np.insert(words.hashes, words.bounds[1:], END), words.bounds + np.arange(len(words.bounds)))


def together(groups):
    """Groups of columns (see words.grouped) joined up to about TOGETHER bytes,
    with their tokens in the place of the texts. The words of a group are
    found by themselves, so that only hashes gather; none is held on here."""
    cols, parts, size = None, [], 0

    def joined():
        h, sizes = (np.concatenate(x) for x in zip(*((h, np.diff(bounds)) for h, bounds in parts)))
        parts.clear()
        return h, np.append(0, np.cumsum(sizes))

    for *more, texts in groups:
        cols = more if cols is None else [a + b for a, b in zip(cols, more)]
        parts.append(tokens(texts))
        size += sum(map(len, texts))
        if size >= TOGETHER:
            del texts
            yield [*cols, *joined()]
            cols, size = None, 0
    if parts:
        yield [*cols, *joined()]


def _starts(bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(int(bounds[-1]), dtype=bool)
    out[bounds[:-1]] = True
    return out


def held_out(doc_id: Column | str) -> Column:
    """The contract's split: one document in ten by checksum of its id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 10 == 0, F.lit(False))


def _files(rows: list) -> list[tuple]:
    """Level files in key order with the entries before each; one row each."""
    out, before = [], 0
    for r in sorted(rows, key=lambda r: (r.first, r.second)):
        first = np.uint64(r.first) if r.second < 0 else (r.first, r.second)
        out.append((first, r.name, r.bytes, before, r.entries))
        before += r.entries
    return out


SHARD = "first decimal(20,0), second long, name string, bytes long, entries long"


def _shard_row(first: int, second: int, name: str, size: int, entries: int):
    import pyarrow as pa
    from decimal import Decimal

    return pa.RecordBatch.from_pylist(
        [{"first": Decimal(first), "second": second, "name": name, "bytes": size, "entries": entries}],
        schema=pa.schema([("first", pa.decimal128(20, 0)), ("second", pa.int64()), ("name", pa.string()),
                          ("bytes", pa.int64()), ("entries", pa.int64())]))


def _columns(batches) -> list[np.ndarray]:
    """A partition's columns as whole arrays."""
    held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*held)]


def _name(kind: str) -> str:
    from pyspark import TaskContext

    return f"{kind}-{TaskContext.get().partitionId():06d}.lvl"


def write_words(counts: DataFrame, folder: str) -> list[tuple]:
    """Shards of (key, value) rows in the order of the unsigned key."""
    def put(batches):
        cols = _columns(batches)
        if cols:
            keys = cols[0].astype(np.uint64) ^ np.uint64(1 << 63)
            seq = EliasFano.build(keys, 1 << 64)
            arrays = {f"keys.{k}": a for k, a in seq.arrays().items()} | {"counts": cols[1].astype(np.int64)}
            name = _name("words")
            yield _shard_row(int(keys[0]), -1, name, write_arrays(folder, name, arrays), len(keys))

    n = shuffle_partitions(counts.sparkSession)
    # the sign bit is turned, so that Spark's order of longs is that of the unsigned keys
    turned = counts.select(F.col("key").bitwiseXOR(F.lit(-1 << 63)).alias("key"), "value")
    return _files(turned.repartitionByRange(n, "key").sortWithinPartitions("key").mapInArrow(put, SHARD).collect())


def count_words(train: DataFrame) -> DataFrame:
    """(key, value): hash and count of every training token."""
    def count(batches):
        import pyarrow as pa

        held, size = [], 0
        def send():
            keys, n = counted(held)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "value"])
        for _, texts in grouped(batches, "doc_id", "text"):
            h, _ = tokens(texts)
            held.append(h)
            size += len(h)
            if size >= FLUSH:
                yield send()
                held, size = [], 0
        if held:
            yield send()

    return train.mapInArrow(count, "key long, value long").groupBy("key").agg(F.sum("value").alias("value"))


def planes(keys: np.ndarray) -> bytes:
    """Longs as their first bytes, then their second ones and so on: of sorted
    ones, the higher bytes repeat and are well compressed on the way."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def gram_keys(trie: Trie, level: int, h: np.ndarray, bounds: np.ndarray, min_count: int) -> np.ndarray:
    """Keys of the n-grams of ``level`` words in a row of tokens."""
    ids, = trie.ids(h)
    start = _starts(bounds)
    context = behind(ids, -1, start)
    for k in range(2, level):
        rank, _, _ = trie.seek(k, context, ids, scores=False)
        context = behind(rank, -1, start)
        if min_count > 1:
            ids = np.where(rank >= 0, ids, -1)           # the shorter n-gram with this last word isn't stored
    ask = (context >= 0) & (ids >= 0)
    return pair(context[ask], ids[ask], trie.distinct)


def gram_bounds(train: DataFrame, level: int, make_trie, total: int, min_count: int) -> np.ndarray:
    """Keys that cut the n-grams of ``level`` words into ranges of about equal
    size: quantiles of the distinct ones in a sample of documents."""
    ranges = max(min(shuffle_partitions(train.sparkSession), total // LEAST), total // MOST, 1)
    if ranges < 2:
        return np.zeros(0, dtype=np.uint64)
    share = min(1.0, SAMPLE * ranges / total)
    thin = max(1, min(8, int(1 / share)))                # more documents, fewer n-grams of each

    def pick(batches):
        import pyarrow as pa

        for _, h, text_bounds in together(grouped(batches, "doc_id", "text")):
            keys = np.unique(gram_keys(make_trie(), level, h, text_bounds, min_count))
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[mix(keys) % np.uint64(thin) == 0].tobytes()], pa.binary())], names=["keys"])

    rows = train if share * thin >= 1 else train.sample(share * thin, seed=level)
    found = [np.frombuffer(r.keys, dtype=np.uint64) for r in rows.mapInArrow(pick, "keys binary").collect()]
    keys = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *found]))
    return np.unique(keys[np.arange(1, ranges) * len(keys) // ranges]) if len(keys) else keys


def level_arrays(parent: np.ndarray, word: np.ndarray, n: np.ndarray, context: np.ndarray,
                 discount: float, book: np.ndarray) -> dict[str, np.ndarray]:
    """A shard's arrays from sorted n-grams, their counts and their contexts'."""
    at = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
    size = np.diff(np.append(at, len(parent)))
    last = word[at + size - 1] + 1
    ends = np.repeat(np.cumsum(last) - last, size) + word + 1
    first = int(parent[0])
    per = np.zeros(int(parent[-1]) - first + 1, dtype=np.int64)
    per[parent[at] - first] = size
    pointers = EliasFano.build(np.append(0, np.cumsum(per)), len(word) + 1)
    seq = EliasFano.build(ends, int(ends[-1]) + 1)
    arrays = {f"pointers.{k}": a for k, a in pointers.arrays().items()}
    arrays |= {f"words.{k}": a for k, a in seq.arrays().items()}
    return arrays | {"codes": quantise((n - discount) / context, book), "book": book, "first": np.array([first])}


def left_over(used: np.ndarray, context: np.ndarray) -> np.ndarray:
    """The share of contexts' counts that their stored n-grams don't use."""
    return (context - used) / context


WRITTEN = "kind string, first decimal(20,0), second long, name string, bytes long, entries long, used double, context long"


def write_level(train: DataFrame, folder: str, level: int, make_trie, total: int, min_count: int, discount: float,
                commonest: int, last: bool) -> tuple[list[tuple], tuple[list[tuple], list[tuple], float], int]:
    """(shards of a level above 1; what its contexts leave, as shards, as
    (context, mass) pairs and the least the codes reach; the count of its
    commonest n-gram). ``commonest``: that of the level before. Tasks count what they have read and send it in
    packed parts, one per range of keys; each range is added up by itself.
    The last level's counts aren't needed again and aren't stored."""
    bounds = gram_bounds(train, level, make_trie, total, min_count)
    least = min(min_count - discount, discount) / max(commonest, 1)
    book = codebook(least)

    def count(batches):
        import pyarrow as pa

        trie, held, size = make_trie(), [], 0

        def send():
            keys, n = counted(held)
            at = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
            n = n.astype(np.uint32)
            for used in np.array_split(np.flatnonzero(np.diff(at)), 1 + len(keys) // SENT):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array([planes(keys[at[b]:at[b + 1]]) for b in used], pa.binary()),
                     pa.array([n[at[b]:at[b + 1]].tobytes() for b in used], pa.binary())], names=["bucket", "keys", "n"])

        for _, h, text_bounds in together(grouped(batches, "doc_id", "text")):
            held.append(gram_keys(trie, level, h, text_bounds, min_count))
            size += len(h)
            del h
            if size >= FLUSH:
                yield from send()
                held, size = [], 0
        if held:
            yield from send()

    def add(batches):
        import pyarrow as pa
        from decimal import Decimal

        trie, bucket, keys, n = make_trie(), None, [], []
        above = trie.words if level == 2 else trie.grams[level - 3]

        def row(kind, first, second, name, size, entries, used=None, context=None):
            return {"kind": kind, "first": Decimal(int(first)), "second": second, "name": name, "bytes": size,
                    "entries": entries, "used": used, "context": context}

        def summed():
            k, c = np.concatenate(keys), np.concatenate(n)
            keys.clear(), n.clear()
            order = np.argsort(k)
            k, c = k[order], c[order]
            first = np.flatnonzero(first_of(k))
            return k[first], np.add.reduceat(c, first, dtype=np.int64)

        def put():
            k, c = summed()
            k, c = k[c >= min_count], c[c >= min_count]
            if not len(k):
                return
            d = np.uint64(trie.distinct)
            parent = (k // d).astype(np.int64)
            word = (k - parent.astype(np.uint64) * d).astype(np.int64)
            at = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            p, size = parent[at], np.diff(np.append(at, len(parent)))
            context = above.at(p, "counts")
            arrays = level_arrays(parent, word, c, np.repeat(context, size), discount, book)
            if not last:
                arrays["counts"] = c.astype(np.uint32 if c.max() < 1 << 32 else np.uint64)
            name = f"level{level}-{bucket:06d}.lvl"
            yield row("level", p[0], int(word[0]), name, write_arrays(folder, name, arrays), len(k), None, int(c.max()))
            used = np.add.reduceat(c, at) - discount * size
            for e in sorted({0, len(p) - 1}):
                yield row("edge", p[e], -1, None, 0, 1, float(used[e]), int(context[e]))
            inner = slice(1, len(p) - 1)
            if len(p) > 2:
                codes = np.zeros(int(p[-2] - p[1]) + 1, dtype=np.uint8)
                codes[p[inner] - p[1]] = quantise(left_over(used[inner], context[inner]), book)
                arrays = {"codes": codes, "first": p[1:2]}
                name = f"mass{level - 1}-{bucket:06d}.lvl"
                yield row("mass", p[1], -1, name, write_arrays(folder, name, arrays), len(p) - 2)

        def rows(found):
            return pa.RecordBatch.from_pylist(list(found), schema=pa.schema(
                [("kind", pa.string()), ("first", pa.decimal128(20, 0)), ("second", pa.int64()), ("name", pa.string()),
                 ("bytes", pa.int64()), ("entries", pa.int64()), ("used", pa.float64()), ("context", pa.int64())]))

        held = 0
        for b in batches:
            for _, to, raw_keys, raw_n in zip(*b.columns):
                if to.as_py() != bucket:
                    if keys:
                        yield rows(put())
                    bucket, keys, n, held = to.as_py(), [], [], 0
                keys.append(from_planes(raw_keys.as_buffer()))
                n.append(np.frombuffer(raw_n.as_buffer(), dtype=np.uint32).copy())
                held += len(keys[-1])
                if held > MOST + 2 * len(keys[0]):       # a common range: add up what it has so far
                    k, c = summed()
                    keys, n, held = [k], [c], len(k)
        if keys:
            yield rows(put())

    # one task for each range, however many there are
    sent = train.mapInArrow(count, "bucket long, keys binary, n binary").select(
        F.col("bucket").cast("int").alias("part"), "bucket", "keys", "n")
    found = sent.repartitionById(len(bounds) + 1, "part").mapInArrow(add, WRITTEN).collect()
    sums: dict[int, list] = {}
    for r in found:
        if r.kind == "edge":
            used, _ = sums.get(int(r.first), (0.0, 0))
            sums[int(r.first)] = (used + r.used, r.context)
    edges = sorted(sums)
    left = left_over(*(np.array([sums[p][k] for p in edges]) for k in (0, 1)))
    left = book[quantise(left, book)].tolist()
    of = lambda kind: _files([r for r in found if r.kind == kind])
    top = max((r.context for r in found if r.kind == "level"), default=0)
    return of("level"), (of("mass"), list(zip(edges, left)), least), top


class Model:
    """Where the trie's files are; small enough to go with every task."""

    def __init__(self, folder: str, levels: list, masses: list, total: int):
        self.parts = (folder, levels, masses, total)

    def __call__(self) -> Trie:
        return _open(self.parts[0], json.dumps(self.parts[1:], default=int), self)


_tries: dict[tuple, Trie] = {}


def _open(folder: str, key: str, model: Model) -> Trie:
    """One open trie per Python worker."""
    if (folder, key) not in _tries:
        _tries.clear()
        _tries[folder, key] = Trie(*model.parts)
    return _tries[folder, key]


def train(rows: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT, discount: float = DISCOUNT,
          folder: str | None = None) -> Model:
    """A model of all tokens of ``rows`` (doc_id, text)."""
    spark: SparkSession = rows.sparkSession
    folder = folder or scratch_path(spark, "trie")
    counts = materialize(count_words(rows), "words")
    total, top = (int(x or 0) for x in counts.agg(F.sum("value"), F.max("value")).first())
    model = Model(folder, [write_words(counts, folder)], [], total)
    for level in range(2, order + 1):
        files, mass, top = write_level(rows, folder, level, model, total, min_count, discount, top, level == order)
        _, levels, masses, _ = model.parts
        model = Model(folder, [*levels, files], [*masses, mass], total)
    return model


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def score(rows: DataFrame, model: Model) -> DataFrame:
    """The contract's columns for rows of (doc_id, held_out, text)."""
    def run(batches):
        import pyarrow as pa

        trie = model()
        for ids, out, h, bounds in together(grouped(batches, "doc_id", "held_out", "text")):
            word, count, left = trie.ids(h, counts=True)
            del h
            known = np.add.reduceat(count > 0, bounds[:-1], dtype=np.int64)
            p = trie.base(count)
            del count
            base = np.add.reduceat(np.log10(p), bounds[:-1])
            logs = np.add.reduceat(trie.score(word, p, left, _starts(bounds)), bounds[:-1])
            del word, p, left
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out, pa.bool_()), pa.array(np.diff(bounds)), pa.array(known),
                 pa.array(np.full(len(ids), trie.total)), pa.array(base), pa.array(logs)],
                names=[c.split()[0] for c in SCORES.split(", ")])

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, SCORES)


def score_documents(docs: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT,
                    discount: float = DISCOUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents that aren't held out; score all."""
    rows = id_text(docs, id_col, text_col).withColumn("held_out", held_out("doc_id"))
    model = train(rows.where("not held_out").select("doc_id", "text"), order=order, min_count=min_count,
                  discount=discount)
    return score(rows, model)
