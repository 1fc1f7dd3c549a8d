"""A Merkle manifest of a dataset: a root digest, and a proof for every row.

Every row is a leaf: the SHA-256 of its fields, each as ``-`` if null, else its
length in UTF-8 bytes, ``:`` and its value. The leaves of a source, in the
order of their ids, are joined in runs of FAN, and so on up to the source's
root; the sources' roots, in the order of the sources, likewise give the root.

``build`` stores the tree as records ``digest -> digests of its children``, one
table for each height. ``proofs`` never walks a tree by its positions: the
requests of the leaves start at the root together, and at each height the
digests reached are looked up in the records; the digits of a leaf's rank say
which child is its own, the other children are put on the path. Requests that
share a prefix of digits are one row until they part, so a height costs as
many rows as it has nodes, and the paths of a run of leaves come to its leaves
in one row. At the leaves the path's segments are turned round, to go from
leaf to root.

All work is column expressions. Ranks come from a range-partitioned, sorted
table of the leaves and one row per (partition, source); equal rows are told
apart by a number of their place, so that neither a large source nor a row
repeated many times must be sorted by one task. A group never has more than
FAN rows. The driver gets the largest number of leaves of a source, the number
of sources, the row of the root, and Spark's samples for the bounds of the
ranges. The requests are never broadcast: Spark's estimate of their size leaves
out that a step down makes FAN rows of one, so it would send the paths of all
runs through the driver.

Defined cases: null sources and ids come first; rows with equal ids are ordered
by their leaves; equal rows have equal leaves, each with a proof of its own
place; a source of one row has its leaf as its root; an empty table has no root
and no proofs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import shuffle_partitions
from strata.session import materialize

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*(F.when(t.isNull(), "-").otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)))


class Tree(NamedTuple):
    """``runs``: source number, run, the run's leaves in order; ``sources``: source
    number, its root and number of leaves; ``records`` and ``tops``: the records by
    height, of the sources' trees and of the tree above them."""

    runs: DataFrame
    sources: DataFrame
    records: list[DataFrame]
    tops: list[DataFrame]
    #: One row (tree 0, digest, height), none for an empty table.
    root: DataFrame


def number_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` (doc_id, source, leaf and more) with ``tree`` (the source's
    number), ``rank`` (in its source, from 0) and ``n`` (leaves of the source)."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("salt")]
    placed = materialize(
        leaves.withColumn("salt", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(leaves.sparkSession), *order).sortWithinPartitions(*order)
        .drop("salt").withColumn("at", F.monotonically_increasing_id()), "leaves") \
        .withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("part", "source").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("lo"))
    of_source = Window.partitionBy("source")                 # at most one row per partition
    parts = parts.select("*", F.sum("here").over(of_source).alias("n"), F.coalesce(F.sum("here").over(
        of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    parts = materialize(parts.withColumn("first", (F.col("before") == 0).cast("long")), "leaf-parts")
    begun = parts.groupBy("part").agg(F.sum("first").alias("begun"))
    begun = begun.select("part", (F.sum("begun").over(Window.orderBy("part")) - F.col("begun")).alias("earlier"))
    number = F.col("earlier") + F.sum("first").over(Window.partitionBy("part").orderBy("lo")) - 1
    parts = parts.join(begun, "part", "left").withColumn("tree", F.when(F.col("first") == 1, number)) \
        .withColumn("tree", F.max("tree").over(of_source)) \
        .select(F.col("part").alias("p"), F.col("source").alias("s"), "tree", "n", (F.col("before") - F.col("lo")).alias("shift"))
    # every row has its match; a left join, so that Spark may broadcast the parts but not the leaves
    rows = placed.join(parts, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")), "left")
    return rows.withColumn("rank", F.col("at") + F.col("shift")).drop("part", "p", "s", "at", "shift")


def join_runs(nodes: DataFrame, *, fan: int = FAN, more: tuple[str, ...] = ()) -> DataFrame:
    """Runs of ``fan`` consecutive nodes (tree, rank, n: nodes of the tree at this
    height, digest) of each tree: their nodes in order, and their own digest. A
    tree of one node stays as it is: its run's digest is the node's."""
    kids = F.array_sort(F.collect_list(F.struct("rank", "digest", *more)))
    runs = nodes.groupBy("tree", F.floor(F.col("rank") / fan).alias("run")).agg(F.first("n").alias("n"), kids.alias("kids"))
    own = F.when(F.col("n") == 1, F.col("kids")[0]["digest"]).otherwise(
        digest(F.array_join(F.col("kids.digest"), "")))
    return runs.withColumn("digest", own)


def climb(runs: DataFrame, most: int, fan: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """From the lowest runs of trees, the largest with ``most`` nodes, up to
    their roots: the records of each height, and (tree, digest, height)."""
    records = [runs.where("n > 1").select("digest", F.col("kids.digest").alias("children"))]
    roots = runs.where(f"n <= {fan}").select("tree", "digest", F.when(F.col("n") == 1, 0).otherwise(1).alias("height"))
    level = runs.where(f"n > {fan}")
    while (most := -(-most // fan)) > 1:
        nodes = level.select("tree", F.col("run").alias("rank"), F.ceil(F.col("n") / fan).alias("n"), "digest")
        level = materialize(join_runs(nodes, fan=fan), name)
        records.append(level.select("digest", F.col("kids.digest").alias("children")))
        roots = roots.unionByName(level.where(f"n <= {fan}").select("tree", "digest", F.lit(len(records)).alias("height")))
        level = level.where(f"n > {fan}")
    return [r.dropDuplicates(["digest"]) for r in records], roots


def build(leaves: DataFrame, *, fan: int = FAN, more: tuple[str, ...] = ()) -> Tree:
    """The tree over ``leaves`` (doc_id, source, leaf and the columns ``more``)."""
    numbered = number_leaves(leaves).withColumnRenamed("leaf", "digest")
    runs = materialize(join_runs(numbered, fan=fan, more=("doc_id", *more)), "leaf-runs")
    most = runs.agg(F.max("n")).first()[0] or 0
    records, sources = climb(runs, most, fan, "nodes")
    sources = materialize(sources, "sources")
    n = sources.count()
    tops = join_runs(sources.select("tree", "digest").select(
        F.lit(0).alias("tree"), F.col("tree").alias("rank"), F.lit(n).alias("n"), "digest"), fan=fan)
    tops = materialize(tops, "tops")
    top_records, root = climb(tops, n, fan, "tops")
    return Tree(runs, sources, records, top_records, materialize(root, "root"))


def descend(at: DataFrame, records: DataFrame, fan: int) -> DataFrame:
    """One step down: each node reached (rank, digest, path and more) makes way
    for its children, whose paths have the other children as a further segment."""
    kids = records.select(F.col("digest").alias("of"), "children")
    down = at.join(kids.hint("merge"), F.col("digest") == F.col("of")).drop("of")
    down = down.select("*", F.posexplode("children").alias("digit", "child"))
    return down.select(
        *(c for c in at.columns if c not in ("rank", "digest", "path")), (F.col("rank") * fan + F.col("digit")).alias("rank"),
        F.col("child").alias("digest"), F.concat("path", F.array(segment(F.col("children"), F.col("digit")))).alias("path"))


def segment(children: Column, digit: Column) -> Column:
    """The children before and after the one that a request goes on to."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.size(children)), "").alias("right"))


def proofs(tree: Tree, *, fan: int = FAN) -> DataFrame:
    """One row per leaf: the columns kept in the runs, ``leaf``, ``subroot``,
    ``root`` and ``proof``, an array of (left, right) from the leaf to the root."""
    start = F.array().cast("array<struct<left:string,right:string>>")
    top = tree.root.first()
    at = tree.root.select(F.col("tree").cast("long").alias("rank"), "digest", F.col("digest").alias("root"), start.alias("path"))
    for k in range(top["height"] if top else 0, 0, -1):
        at = descend(at, tree.tops[k - 1], fan)
    at = at.join(tree.sources.select("tree", "height").hint("merge"), F.col("rank") == F.col("tree")).select(
        "tree", "height", "root", F.col("digest").alias("subroot"), F.lit(0).cast("long").alias("rank"), "digest", "path")
    at = materialize(at, "requests")
    down, waiting = at.where(f"height = {len(tree.records)}"), at
    for k in range(len(tree.records), 1, -1):
        down = descend(down, tree.records[k - 1], fan).unionByName(waiting.where(f"height = {k - 1}"))
    if tree.records:
        down = down.unionByName(waiting.where("height = 0"))
    # a request is at its leaves' run now, whose record holds the leaves themselves
    runs = tree.runs.select(F.col("tree").alias("t"), "run", "n", "kids", F.col("digest").alias("of"))
    down = down.join(runs.hint("merge"), (F.col("digest") == F.col("of")) & (F.col("tree") == F.col("t")) & (F.col("rank") == F.col("run")))
    down = down.select("subroot", "root", "path", "n", "kids", F.posexplode("kids").alias("digit", "kid"))
    own = segment(F.col("kids.digest"), F.col("digit"))
    up = F.concat(F.when(F.col("n") > 1, F.array(own)).otherwise(start), F.reverse("path"))
    return down.select("kid.*", "subroot", "root", up.alias("proof")) \
        .withColumnRenamed("digest", "leaf").drop("rank")


def fold(own: Column, proof: Column) -> Column:
    """The root that a leaf gives with the digests of its proof."""
    return F.aggregate(proof, own, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def tampered_leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The contract's tampering: the leaf of the row with A-Z of its text
    lower-cased, where 5 divides the CRC-32 of the id; else null."""
    hit = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0
    return F.when(hit, leaf(doc_id, source, lang, n_chars, F.translate(text.cast("string"), _UPPER, _LOWER)))


def verified(docs: DataFrame, *, fan: int = FAN) -> DataFrame:
    """The contract's columns: every row's leaf, roots and proof, and whether
    the leaf as it is after tampering still gives the root."""
    fields = [F.col(c) for c in FIELDS]
    leaves = docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf(*fields).alias("leaf"),
                         tampered_leaf(*fields).alias("tampered"))
    rows = proofs(build(leaves, fan=fan, more=("tampered",)), fan=fan)
    rows = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    others = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select("doc_id", "leaf", "subroot", "root", digest(others).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
