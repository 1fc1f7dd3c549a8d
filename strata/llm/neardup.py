"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct word shingles, as 64-bit hashes. Documents
with equal sets form a class, and only classes go on.

* Branching: in each of ``len(branches)`` levels of each tree, a class follows
  the smallest tokens of its set under a hash that depends on the path so far,
  so classes stay together with a chance that grows with their similarity.
  A class finds its paths by itself; Spark only counts who meets in a node.
* Nodes of at most ``leaf`` classes are compared exhaustively; larger ones
  branch on. What is still larger at the last level is cut into blocks, and
  the first block meets each of the others.
* Classes are compared by sketch (one byte for the least hash in each of 256
  ranges) and set size. The sketch only rules out pairs: its limit lies 4.5
  standard deviations below the threshold. From a node's remaining pairs the
  most alike that span it are confirmed on full sets and joined.
* Second round: what the first left apart in a node is compared in full, in
  large nodes by taking all classes outside the node's main component to each
  block. Classes tied by pairs that the sketch leaves open, in different
  components, form groups; equal groups from different nodes are one. A
  group's full sets meet in one task, which finds all their intersections by
  one matrix product and sends on the links that join components.

Independent trees are repeated to the wanted recall (``recall_at``): with the
default eight trees a pair at the threshold of 0.85 meets in a first-level
node with a chance of 1 - 3e-7 or more, and in a last-level one of 0.997 or
more even if each tree's two branches count as one draw. No node is dropped or
cut short, no group meets in one task beyond blocks of ``leaf``, and no step
lists all pairs of a group of copies: the rows grow with the number of
documents.

Confirming compares 48 bits of each shingle hash; set sizes use all 64.

Defined cases: a text without words, or null, has an empty set and stays
alone; fewer words than ``width`` make one shingle; repeated rows are copies
of each other; a row without an id can't name a component, so it is linked
with nothing and kept.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text
from strata.llm.graph import components, with_least
from strata.llm.words import NOT_SPACE, find_words, grouped, mix, powers
from strata.session import materialize

WIDTH = 5
PERCENT = 85
TREES = 8
BRANCHES = (2, 1, 1, 1)
LEAF = 256
SKETCH = 256
SIGMAS = 4.5

_STEP = 0xD1342543DE82EF95
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = find_words(texts, NOT_SPACE)
    h = words.hashes
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * powers(_STEP, max(len(h), 1))[:len(h)], out=total[1:])
    back = powers(pow(_STEP, -1, 1 << 64), max(len(h), 1))
    out = []
    for lo, hi in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if hi - lo >= width:
            runs = (total[lo + width:hi + 1] - total[lo:hi - width + 1]) * back[lo:hi - width + 1]
            out.append(np.unique(mix(runs)))
        elif hi > lo:
            out.append(mix((total[hi:hi + 1] - total[lo:lo + 1]) * back[lo:lo + 1] + np.uint64(hi - lo)))
        else:
            out.append(h[:0])
    return out


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(s: np.ndarray) -> bytes:
    """Per 256th of the hash range, one byte of the least hash in it, or 0."""
    part, first = np.unique((s >> np.uint64(56)).astype(np.int64), return_index=True)
    out = np.zeros(SKETCH, dtype=np.uint8)
    out[part] = (s[first] >> np.uint64(24)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def choose_paths(s: np.ndarray, trees: int, branches: tuple[int, ...], seed: int) -> np.ndarray:
    """Path hashes, one row per path to the last level, one column per level;
    0 where the set has no further token to follow."""
    path = mix((np.arange(trees, dtype=np.uint64) + np.uint64(seed * 1000 + 1)) * _ODD)
    levels = np.zeros((trees, 0), dtype=np.uint64)
    step = max(1, (1 << 22) // max(len(s), 1))
    for b in branches:
        picks = []
        for lo in range(0, len(path), step):
            by = s[None, :] * (mix(path[lo:lo + step])[:, None] | np.uint64(1))
            row, found = np.arange(len(by)), []
            for k in range(b):
                at = by.argmin(axis=1)
                token = s[at] if k < len(s) else np.zeros(len(by), dtype=np.uint64)
                found.append(token)
                by[row, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
            picks.append(np.stack(found, axis=1))
        tokens = np.concatenate(picks).ravel()
        old = np.repeat(path, b)
        path = np.where((tokens == 0) | (old == 0), np.uint64(0), mix(old * _ODD ^ tokens))
        levels = np.hstack([np.repeat(levels, b, axis=0), path[:, None]])
    return levels


def signatures(rows: DataFrame, width: int, trees: int, branches: tuple[int, ...], seed: int) -> DataFrame:
    """doc_id, n (set size), key (of the set; null if empty), paths (flat, by
    level within path) and sketch."""
    def run(batches):
        import pyarrow as pa

        for ids, texts in grouped(batches, "doc_id", "text"):
            sets = shingle_sets(texts, width)
            full = [len(s) > 0 for s in sets]
            paths = [choose_paths(s, trees, branches, seed).ravel().view(np.int64) if ok else None
                     for s, ok in zip(sets, full)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_key(s) if ok else None for s, ok in zip(sets, full)], pa.binary()),
                 pa.array(paths, pa.list_(pa.int64())),
                 pa.array([sketch(s) if ok else None for s, ok in zip(sets, full)], pa.binary())],
                names=["doc_id", "n", "key", "paths", "sketch"])

    return rows.mapInArrow(run, "doc_id long, n long, key binary, paths array<bigint>, sketch binary")


def meet(classes: DataFrame, depth: int, leaf: int) -> DataFrame:
    """(path, key, size) of every class in the nodes where it is compared: the
    first node on each path with at most ``leaf`` classes, or the last one."""
    n = F.floor(F.size("paths") / depth).cast("int")
    rows = classes.select("key", F.explode(F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.slice("paths", i * depth + 1, depth))).alias("rest"))
    out = None
    for level in range(depth):
        rows = rows.select(F.get("rest", 0).alias("path"), "key", F.slice("rest", 2, depth).alias("rest")).where(
            "path != 0")
        if level:
            rows = rows.distinct()
        sizes = rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        met = materialize(rows.join(sizes, "path"), f"nodes-{level}")
        last = level == depth - 1
        done = (met if last else met.where(F.col("size") <= leaf)).select("path", "key", "size")
        out = done if out is None else out.union(done)
        rows = met.where(F.col("size") > leaf).select("key", "rest")
    return out


def alike(n: np.ndarray, s: np.ndarray, k: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(members after k that may be similar enough to it, estimates)."""
    rest, mine = s[k + 1:], s[k]
    filled = (mine != 0) | (rest != 0)
    used = filled.sum(axis=1)
    same = ((rest == mine) & filled).sum(axis=1)
    t = percent / 100
    est = same / np.maximum(used, 1)
    low = t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(used, 1))
    a, b = np.minimum(n[k + 1:], n[k]), np.maximum(n[k + 1:], n[k])
    ok = np.flatnonzero((est >= low) & (100 * a >= percent * b))
    return ok + k + 1, est[ok]


class Forest:
    """Union-find over the members of a group."""

    def __init__(self, n: int):
        self.top = list(range(n))

    def root(self, x: int) -> int:
        while self.top[x] != x:
            self.top[x] = self.top[self.top[x]]
            x = self.top[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.top[a] = b
        return a != b


def open_pairs(n: np.ndarray, s: np.ndarray, labels: list | None, percent: int) -> list[tuple[float, int, int]]:
    """(minus the estimate, i, j) of a node's pairs that may be linked, and
    have different labels if there are any."""
    pairs = []
    for k in range(len(n) - 1):
        at, est = alike(n, s, k, percent)
        pairs += [(-e, k, j) for j, e in zip(at.tolist(), est.tolist()) if labels is None or labels[j] != labels[k]]
    return pairs


def streamed(batches, n_keys: int):
    """Groups of rows with equal first ``n_keys`` columns, from batches sorted
    by them: lists of the other columns' values, one group at a time."""
    now, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:n_keys] != now:
                if held:
                    yield held
                now, held = row[:n_keys], []
            held.append(row[n_keys:])
    if held:
        yield held


def _sketched(members: DataFrame, classes: DataFrame, *more: str) -> DataFrame:
    rows = members.join(classes.select("key", "n", "sketch"), "key").select(
        "path", "block", "key", "n", "sketch", *more)
    return rows.repartition("path", "block").sortWithinPartitions("path", "block", "key")


def _arrays(group: list) -> tuple[list, np.ndarray, np.ndarray]:
    """The rows of distinct keys, their set sizes and sketches."""
    group = [r for k, r in enumerate(group) if not k or r[0] != group[k - 1][0]]
    sketches = np.frombuffer(b"".join(r[2] for r in group), dtype=np.uint8).reshape(len(group), SKETCH)
    return group, np.array([r[1] for r in group]), sketches


def span(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of keys: per block, the most alike pairs that
    span everything in it that may be linked. At most one per member."""
    def run(batches):
        import pyarrow as pa

        for group in streamed(batches, 2):
            if len(group) < 2:
                continue
            group, n, s = _arrays(group)
            forest = Forest(len(group))
            kept = [(group[i][0], group[j][0]) for _, i, j in sorted(open_pairs(n, s, None, percent))
                    if forest.join(i, j)]
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([min(p) for p in kept], pa.binary()), pa.array([max(p) for p in kept], pa.binary())],
                    names=["a", "b"])

    return _sketched(members, classes).mapInArrow(run, "a binary, b binary").distinct()


def open_groups(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(group, key, label) of the members that open pairs tie together across
    labels; a group is named by its members, so equal ones are one."""
    def run(batches):
        import pyarrow as pa

        for rows in streamed(batches, 2):
            if len(rows) < 2:
                continue
            rows, n, s = _arrays(rows)
            labels = [r[3] for r in rows]
            forest, tied = Forest(len(rows)), set()
            for _, i, j in open_pairs(n, s, labels, percent):
                forest.join(i, j)
                tied |= {i, j}
            groups: dict[int, list[int]] = {}
            for k in sorted(tied):
                groups.setdefault(forest.root(k), []).append(k)
            out = [(hashlib.blake2b(b"".join(rows[k][0] for k in g), digest_size=16).digest(), rows[k][0], labels[k])
                   for g in groups.values() for k in g]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)],
                                                 names=["group", "key", "label"])

    return _sketched(members, classes, "label").mapInArrow(
        run, "group binary, key binary, label binary").distinct()


def unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def intersections(sets: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """Sizes of all pairwise intersections: the product of the sets' incidence
    matrix, over elements in two sets or more, with its transpose."""
    which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    use = np.flatnonzero(shared[place])
    row, col = which[use], column[place[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(sets), len(sets)))
    for lo in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(col, [lo, lo + columns])
        x = np.zeros((len(sets), columns), dtype=np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        out += x @ x.T
    return out


def group_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) on full sets that join different labels within a group; at
    most one per member."""
    rows = groups.join(sets, "key").select("group", "key", "label", "set")
    rows = rows.repartition("group").sortWithinPartitions("group", "key")

    def run(batches):
        import pyarrow as pa

        for group in streamed(batches, 1):
            arrays = [unpack(r[2]) for r in group]
            both, n = intersections(arrays), np.array([len(x) for x in arrays])
            alike = 100 * both >= percent * (n[:, None] + n[None, :] - both)
            names = {label: k for k, label in reversed(list(enumerate(r[1] for r in group)))}
            forest = Forest(len(group))
            for k, r in enumerate(group):
                forest.join(k, names[r[1]])
            kept = [(group[i][0], group[j][0]) for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(alike, 1))))
                    if forest.join(i, j)]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*kept)], names=["u", "v"])

    return rows.mapInArrow(run, "u binary, v binary")


def blocks(nodes: DataFrame, leaf: int) -> DataFrame:
    """(path, block, key): small nodes are one block; large ones are dealt into
    blocks, and the first block's classes also go to each of the others."""
    small = nodes.where(F.col("size") <= leaf).select("path", F.lit(0).cast("long").alias("block"), "key")
    n = F.ceil(F.col("size") / leaf)
    dealt = nodes.where(F.col("size") > leaf).select("path", "key", n.alias("n"), F.pmod(
        F.xxhash64("key", "path"), n).alias("own"))
    spread = F.when(F.col("own") == 0, F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.array("own"))
    return small.union(dealt.select("path", F.explode(spread).alias("block"), "key"))


def leftovers(nodes: DataFrame, labels: DataFrame, leaf: int) -> DataFrame:
    """(path, block, key, label) of the nodes whose classes still differ in
    component. In large nodes, the classes outside the most common component
    are taken to every block, in slices of ``leaf``."""
    rows = nodes.join(labels, nodes.key == labels.vertex, "left").select(
        "path", "size", "key", F.coalesce("component", "key").alias("label"))
    parts = rows.groupBy("path", "label").agg(F.count("*").alias("c"))
    main = parts.groupBy("path").agg(F.count("*").alias("parts"), F.max(F.struct("c", "label")).alias("top"))
    main = main.where("parts > 1").select("path", F.col("top.label").alias("main"),
                                          F.col("top.c").alias("most"))
    rows = materialize(rows.join(main, "path"), "leftovers")
    small = rows.where(F.col("size") <= leaf).select("path", F.lit(0).cast("long").alias("block"), "key", "label")
    big = rows.where(F.col("size") > leaf).withColumn("n", F.ceil(F.col("size") / leaf)).withColumn(
        "slices", F.ceil((F.col("size") - F.col("most")) / leaf))
    hashed = F.xxhash64("key", "path")
    in_block = big.select("path", "key", "label", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("slices") - 1),
        lambda i: i * F.col("n") + F.pmod(hashed, F.col("n")))).alias("block"))
    apart = big.where("label != main").select("path", "key", "label", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
        lambda i: F.pmod(hashed, F.col("slices")) * F.col("n") + i)).alias("block"))
    both = in_block.union(apart).select("path", "block", "key", "label").distinct()
    return small.union(both)


def full_sets(docs: DataFrame, keys: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(key, set) of classes: 48 bits of each sorted hash, recomputed from one
    whole text of each class."""
    wanted = keys.join(classes.select("key", "rep"), "key").select(F.col("rep").alias("doc_id"), "key")
    rows = docs.join(wanted, "doc_id")

    def run(batches):
        import pyarrow as pa

        for keys, texts in grouped(batches, "key", "text"):
            sets = shingle_sets(texts, width)
            same = [set_key(s) == k for s, k in zip(sets, keys)]
            raw = [np.ascontiguousarray((s >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                   for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, ok in zip(c, same) if ok], pa.binary()) for c in (keys, raw)],
                names=["key", "set"])

    found = rows.select("key", "text").mapInArrow(run, "key binary, set binary")
    return found.groupBy("key").agg(F.first("set").alias("set"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left, right = (sets.select(F.col("key").alias(k), F.col("set").alias(f"set_{k}")) for k in ("a", "b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = unpack(x.as_py()), unpack(y.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(
                pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "u binary, v binary")


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT, width: int = WIDTH, trees: int = TREES,
                    branches: tuple[int, ...] = BRANCHES, leaf: int = LEAF, seed: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id
    reachable over links of at least ``percent`` % similarity) and kept."""
    rows = id_text(docs, id_col, text_col)
    signed = materialize(signatures(rows, width, trees, branches, seed), "signatures")
    classes = materialize(
        signed.where("key is not null and doc_id is not null").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("paths").alias("paths"),
            F.first("sketch").alias("sketch")), "classes")
    nodes = materialize(meet(classes, len(branches), leaf), "nodes")
    first = materialize(span(blocks(nodes, leaf), classes, percent), "pairs")
    keys = first.select(F.col("a").alias("key")).union(first.select("b")).distinct()
    sets = materialize(full_sets(rows, keys, classes, width), "sets")
    links = materialize(confirm(first, sets, percent), "links")
    labels = components(links)
    groups = materialize(open_groups(leftovers(nodes, labels, leaf), classes, percent), "groups")
    new = materialize(groups.select("key").distinct().join(sets, "key", "left_anti"), "keys")
    if not new.isEmpty():                  # met for the first time, across blocks
        sets = sets.union(materialize(full_sets(rows, new, classes, width), "sets"))
    more = materialize(group_links(groups, sets, percent), "links")
    if not more.isEmpty():
        known = labels.select(F.col("vertex").alias("u"), F.col("component").alias("v"))
        labels = components(known.union(more))
    ids = classes.select("key", "rep").join(labels, F.col("key") == F.col("vertex"), "left").select(
        "key", "rep", F.coalesce("component", "key").alias("part"))
    named = with_least(ids, "part", "rep", "component_id").select("key", "component_id")
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), "key").join(named, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, as they were, without those linked to one of a smaller
    id; of rows with equal ids, all stay or go together."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("_gone"), "left_anti")


def recall_at(similarity: float, level: int, trees: int = TREES, branches: tuple[int, ...] = BRANCHES) -> float:
    """Chance that a pair meets in some node of a level; the two branches of a
    node count as one draw, so this is a lower bound."""
    return 1 - math.pow(1 - similarity ** level, trees)
