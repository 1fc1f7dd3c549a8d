"""Benchmark decontamination by broadcast n-gram windows.

A window is ``n`` consecutive words of a benchmark item (a shorter item is one
window). The windows' hashes and words form the broadcast table; a task hashes
the windows of its documents by one running sum per window length, looks them
up, and compares the words themselves before it counts a hit.

Equal item texts are one text with several ids. The table is arrays: per
distinct window its hash, the place of its words in the items' joined texts,
and the texts that hold it; and each word's bounds. That is at most WORD_BYTES
for a word, besides the texts and ids themselves. It is only broadcast up to
``max_bytes`` by that bound; a larger benchmark is cut into slices below it,
each is a broadcast of its own, and no task opens more than one: the
documents are scanned once per slice and their hits merged.

Defined cases: a null or empty text has no words and no hits; an item without
words has no windows; items with equal ids count once; an item whose id is
null marks words but isn't listed; repeated documents each give a row.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, small_batches
from strata.llm.words import ALNUM, Words, find_words, grouped, mix, powers
from strata.session import materialize

WINDOW = 10
MAX_BYTES = 128 << 20
#: Bytes of the table for a word at most, and for a text or an id besides its own bytes.
WORD_BYTES, ID_BYTES = 72, 128
_STEP = 0xD1342543DE82EF95


class Lengths(NamedTuple):
    """The windows of one length: distinct hashes, sorted; a bit table of their
    top bits; the first word of one window of each; and the texts that hold it,
    those of hash k from bounds[k] to bounds[k + 1]."""

    hashes: np.ndarray
    top: np.ndarray
    place: np.ndarray
    bounds: np.ndarray
    texts: np.ndarray


class Windows(NamedTuple):
    """By window length; the items' words; the ids of each text; and, should two
    windows share a hash, the texts of those that ``place`` doesn't stand for."""

    sizes: dict[int, Lengths]
    words: Words
    ids: list[list[str]]
    other: dict[tuple[bytes, ...], list[int]]

    def items(self, size: int, k: int, words: tuple[bytes, ...]) -> list[str] | None:
        """Ids of the items that hold the words, whose hash is the k-th; None
        if no item does."""
        own = self.sizes[size]
        at = int(own.place[k])
        if all(self.words.word(at + j) == w for j, w in enumerate(words)):
            texts = own.texts[own.bounds[k]:own.bounds[k + 1]].tolist()
        else:
            texts = self.other.get(words)
        return None if texts is None else [i for t in texts for i in self.ids[t]]


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words."""
    if len(h) < size:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * powers(_STEP, len(h)), out=total[1:])
    back = powers(pow(_STEP, -1, 1 << 64), len(h))[:len(h) - size + 1]
    return mix((total[size:] - total[:-size]) * back)


def build_windows(rows: list[tuple], n: int) -> Windows:
    """The lookup table of (item ids, text) rows."""
    found = find_words([(text or "").encode() for _, text in rows], ALNUM)
    count = np.diff(found.bounds)
    text_of = np.repeat(np.arange(len(rows)), count)
    sizes, other = {}, defaultdict(list)
    for size in np.unique(np.minimum(count[count > 0], n)).tolist():
        h = window_hashes(found.hashes, size)
        at = np.arange(len(h))
        text = text_of[at]
        at = at[(np.minimum(count[text], n) == size) & (at + size <= found.bounds[text + 1])]
        at = at[np.lexsort((at, h[at]))]
        first = np.flatnonzero(np.append(True, h[at[1:]] != h[at[:-1]]))
        place = at[first]
        own = np.ones(len(at), dtype=bool)
        of = np.cumsum(np.isin(np.arange(len(at)), first)) - 1
        for j in np.setdiff1d(np.arange(len(at)), first).tolist():
            words = tuple(found.word(at[j] + x) for x in range(size))
            if any(found.word(place[of[j]] + x) != w for x, w in enumerate(words)):
                own[j] = False
                if int(text_of[at[j]]) not in other[words]:
                    other[words].append(int(text_of[at[j]]))
        pairs = np.unique(np.column_stack([of[own], text_of[at[own]]]), axis=0)
        bits = max(10, min(26, int(len(first)).bit_length() + 4))
        top = np.zeros(1 << bits, dtype=bool)
        top[(h[place] >> np.uint64(64 - bits)).astype(np.int64)] = True
        bounds = np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        sizes[size] = Lengths(h[place], top, place, bounds, pairs[:, 1].astype(np.int32))
    return Windows(sizes, found, [list(ids) for ids, _ in rows], dict(other))


def find_hits(found: Words, table: Windows) -> dict[int, list[tuple[int, int, list]]]:
    """By text: (first word, word after the last, item ids) of every window
    occurrence, words counted within the text."""
    hits: dict[int, list[tuple[int, int, list]]] = defaultdict(list)
    for size, own in table.sizes.items():
        h = window_hashes(found.hashes, size)
        shift = np.uint64(65 - len(own.top).bit_length())
        at = np.flatnonzero(own.top[(h >> shift).astype(np.int64)])
        known = np.minimum(np.searchsorted(own.hashes, h[at]), len(own.hashes) - 1)
        same = own.hashes[known] == h[at]
        at, known = at[same], known[same]
        text = np.searchsorted(found.bounds, at, side="right") - 1
        inside = at + size <= found.bounds[text + 1]
        for k, t, w in zip(at[inside].tolist(), text[inside].tolist(), known[inside].tolist()):
            items = table.items(size, w, tuple(found.word(j) for j in range(k, k + size)))
            if items is not None:
                lo = k - int(found.bounds[t])
                hits[t].append((lo, lo + size, items))
    return hits


def union(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted, disjoint intervals that cover the given ones."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def benchmark_tables(benchmark: DataFrame, n: int, max_bytes: int, item_col: str, text_col: str):
    """One broadcast table, or as many as keep each below ``max_bytes``, one
    after the other; the driver holds one slice at a time. A text with its ids
    is never cut: only a text that is too large by itself makes a larger one."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"),
                            F.col(text_col).cast("string").alias("text")).where("text is not null")
    texts = materialize(rows.groupBy("text").agg(F.collect_set("item").alias("items")), "benchmark")
    ids = F.aggregate("items", F.lit(0).cast("long"), lambda a, i: a + F.octet_length(i) + ID_BYTES)
    words = F.ceil(F.octet_length("text") / 2)               # a word and a gap are two bytes at least
    size = F.octet_length("text") + ID_BYTES + words * WORD_BYTES + ids
    total = texts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    slices = max(1, -(-int(total) // max_bytes))
    for k in range(slices):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == k) if slices > 1 else texts
        yield spark.sparkContext.broadcast(build_windows([(r["items"], r["text"]) for r in part.collect()], n))


def _scan(docs: DataFrame, table) -> DataFrame:
    def scan(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()),
                            ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
        for ids, keys, texts in grouped(batches, "doc_id", "key", "text"):
            found = find_words(texts, ALNUM)
            hits = find_hits(found, table.value)
            spans = [union([h[:2] for h in hits[k]]) if k in hits else [] for k in range(len(ids))]
            items = [sorted({i for h in hits[k] for i in h[2]}) if k in hits else []
                     for k in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in
                 zip((ids, keys, np.diff(found.bounds).tolist(), spans, items), schema)], schema=schema)

    return docs.mapInArrow(scan, "doc_id long, key long, n_words long, "
                                 "spans array<array<bigint>>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = WINDOW,
                  max_bytes: int = MAX_BYTES, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, spans (disjoint hit word intervals, end
    exclusive) and items (ids of items with an occurring window, sorted)."""
    rows = id_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    parts = [_scan(rows, t) for t in benchmark_tables(benchmark, n, max_bytes, item_col, item_text_col)]
    if len(parts) == 1:
        return parts[0].drop("key")
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    merged = merged.groupBy("doc_id", "key", "n_words").agg(
        (F.count("*") / len(parts)).cast("int").alias("copies"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

    def unite(batches):
        import pyarrow as pa

        for b in batches:
            at = b.schema.get_field_index("spans")
            spans = [union([tuple(s) for s in x]) for x in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(spans, type=b.schema.field(at).type))

    merged = merged.mapInArrow(unite, merged.schema)
    return merged.select("doc_id", "n_words", "spans", "items",
                         F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the rows of :func:`contamination`."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = WINDOW,
                         max_bytes: int = MAX_BYTES, drop_share: float = 0.5,
                         text_col: str = "text", length_col: str | None = "n_chars",
                         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without their hit words: each hit interval goes, from its
    first word's first byte to its last word's last, and a document goes whole
    when at least ``drop_share`` of its words are hit. Clean documents come
    through unchanged, with all their columns; ``length_col``, where present,
    follows a changed text."""
    small_batches(docs.sparkSession)
    first, *more = benchmark_tables(benchmark, n, max_bytes, item_col, item_text_col)
    schema = docs.schema
    if more:
        return _cut_in_slices(docs, [first, *more], drop_share, text_col, length_col)

    def clean(batches):
        for b in batches:
            cuts = []
            for (texts,) in grouped([b], text_col):
                hits = find_hits(find_words(texts, ALNUM), first.value)
                cuts += [union([h[:2] for h in hits[k]]) if k in hits else [] for k in range(len(texts))]
            yield _without(b, cuts, drop_share, text_col, length_col)

    return docs.mapInArrow(clean, schema)


def _cut_in_slices(docs: DataFrame, tables: list, drop_share: float, text_col: str,
                   length_col: str | None) -> DataFrame:
    """The hit spans of every slice, joined to the rows by a number of their
    place, then cut out."""
    schema, held = docs.schema, materialize(docs.select(F.struct("*").alias("row")).withColumn(
        "key", F.monotonically_increasing_id()), "decontamination")
    texts = held.select(F.col("key").alias("doc_id"), "key", F.coalesce(
        F.col(f"row.{text_col}").cast("string"), F.lit("")).alias("text"))
    found = None
    for t in tables:
        hits = _scan(texts, t).where(F.size("spans") > 0).select(F.col("key").alias("at"), F.explode("spans").alias("span"))
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy("at").agg(F.collect_set("span").alias("spans"))
    rows = held.join(found, F.col("key") == F.col("at"), "left").select(
        F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("_spans"), "row.*")

    def clean(batches):
        for b in batches:
            cuts = [union([tuple(s) for s in x]) for x in b.column(0).to_pylist()]
            yield _without(b.drop_columns(["_spans"]), cuts, drop_share, text_col, length_col)

    return rows.mapInArrow(clean, schema)


def _without(b, cuts: list[list], drop_share: float, text_col: str, length_col: str | None):
    """A batch without the words of ``cuts``, intervals per row."""
    import pyarrow as pa

    at = b.schema.get_field_index(text_col)
    lengths = b.schema.get_field_index(length_col) if length_col else -1
    keep, changed = [True] * b.num_rows, {}
    for row in (k for k, c in enumerate(cuts) if c):
        t = b.column(at)[row].as_py().encode()
        found = find_words([t], ALNUM)
        keep[row] = sum(e - s for s, e in cuts[row]) < drop_share * len(found.starts)
        left, last = [], 0
        for s, e in cuts[row]:
            left.append(t[last:found.starts[s]])
            last = int(found.ends[e - 1])
        changed[row] = b"".join([*left, t[last:]]).decode()
    if changed:
        texts = b.column(at).to_pylist()
        for row, t in changed.items():
            texts[row] = t
        b = b.set_column(at, b.schema.field(at), pa.array(texts, type=b.schema.field(at).type))
        if lengths >= 0:
            n_chars = b.column(lengths).to_pylist()
            for row, t in changed.items():
                n_chars[row] = len(t)
            f = b.schema.field(lengths)
            b = b.set_column(lengths, f, pa.array(n_chars, type=f.type))
    return b.filter(pa.array(keep, type=pa.bool_()))

