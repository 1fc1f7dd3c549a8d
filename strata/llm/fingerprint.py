"""Order MinHash fingerprints in DataFrame functions.

A text's elements are its runs of ``k`` words, each numbered by how often it
has come before in the text. Words end at any white space and every ``PIECE``
characters, so that a text without spaces has elements like any other; a
character of a script written without spaces is a word. Every entry has a hash of its own, the elements' hash
with the bits of the entry's number turned in it: of all elements, the
``picks`` smallest by it are put in the order of the text, and the tuple of
them is hashed to the entry. Two texts agree on an entry when the same
elements were picked and stand in the same order, so the share of equal entries
falls with the edits between the texts, moves included, and not only with the
elements they share.

An entry's smallest elements are those whose hash begins with its number, where
there are ``picks`` of them: they are found for all entries in one sorting. Only
the others, as most are in a short text, are sought among all elements.

Everything is column expressions over arrays; there is no shuffle for the
fingerprint itself.

Defined cases: a null text counts as empty; an empty text has no elements and
only empty entries; a text of fewer than ``k`` words is one element, and a
text of fewer than ``picks`` elements has all of them in every entry. Two texts
without elements have likeness 1, one with and one without 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import id_text, shuffle_partitions

K = 3
BINS = 32
PICKS = 2
#: Characters after which a word ends, if it hasn't before.
PIECE = 16
#: Scripts written without spaces between words, and white space.
UNSPACED = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uA000-\uA4CF\uF900-\uFAFF\uFF66-\uFF9F"
            r"\x{20000}-\x{3FFFF}")
SPACE = r"\s\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: A word, as Java's patterns have it.
WORD = rf"[{UNSPACED}&&[^{SPACE}]]|[^{SPACE}{UNSPACED}]{{1,{PIECE}}}"
#: Ranges of ids that are put in order side by side, per shuffle partition.
RANGES = 4


def _each(n: Column, f) -> Column:
    """[f(0), ..., f(n - 1)], also for n = 0."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.array().cast("array<bigint>"))


def _packed(rank: Column, at: Column) -> Column:
    """31 bits of a rank before 32 bits of a place, as a long that sorts so."""
    return F.shiftleft(F.shiftrightunsigned(rank, 33), 32).bitwiseOR(at.cast("long"))


def add_fingerprint(df: DataFrame, text: str, out: str, *, k: int = K, bins: int = BINS,
                    picks: int = PICKS) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as the array column ``out``
    (``bins`` longs, null for a text without elements). ``bins`` is a power of
    two.

    Ranks and places are packed into longs, which sort without objects; the
    numbering of equal elements is only worked out for texts that have some."""
    grams, marks, runs = f"{out}_grams", f"{out}_marks", f"{out}_runs"
    df = df.withColumn(grams, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    df = df.withColumn(grams, F.transform(grams, lambda w: F.xxhash64(w)))
    n = F.size(grams)
    gram = lambda i: F.xxhash64(*(F.get(F.col(grams), i + j) for j in range(k)))
    df = df.withColumn(grams, F.when(n >= k, _each(n - (k - 1), gram)).when(
        n > 0, F.array(F.xxhash64(F.array_join(F.transform(grams, lambda w: w.cast("string")), " "))))
        .otherwise(F.array().cast("array<bigint>")))
    # (gram, place), sorted: equal grams stand together, by place; and where each run begins
    df = df.withColumn(marks, F.when(F.size(F.array_distinct(grams)) < n, F.sort_array(
        F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    df = df.withColumn(runs, F.filter(F.transform(marks, lambda m, i: F.when(
        (i == 0) | (F.get(F.col(marks), i - 1)["h"] != m["h"]), i)), lambda i: i.isNotNull()))

    def numbered(lo, r):
        head, size = F.get(F.col(marks), lo), F.coalesce(F.get(F.col(runs), r + 1), F.size(marks)) - lo
        return F.when(size == 1, F.array(_packed(head["h"], head["at"]))).otherwise(F.transform(
            F.sequence(F.lit(0), size - 1), lambda j: _packed(
                F.when(j == 0, head["h"]).otherwise(F.xxhash64(head["h"], j)), F.get(F.col(marks), lo + j)["at"])))

    df = df.withColumn(marks, F.sort_array(F.coalesce(
        F.flatten(F.transform(runs, numbered)), F.transform(grams, lambda h, i: _packed(h, i)))))
    # a bin is the ranks' top bits, so each bin's smallest elements come first in its run
    shift = 63 - (bins.bit_length() - 1)
    df = df.withColumn(runs, F.filter(F.transform(marks, lambda m, i: F.when(
        (i == 0) | (F.shiftright(F.get(F.col(marks), i - 1), shift) != F.shiftright(m, shift)), i)),
        lambda i: i.isNotNull()))

    def entry(picked):
        ordered = F.sort_array(F.transform(picked, lambda m: F.struct(
            m.bitwiseAND(F.lit((1 << 32) - 1)).alias("at"), F.shiftright(m, 32).alias("rank"))))
        return F.aggregate(ordered, F.lit(42).cast("long"), lambda a, m: F.xxhash64(
            a, m["rank"], F.get(F.col(grams), m["at"].cast("int"))))

    def full(lo, r):
        size = F.coalesce(F.get(F.col(runs), r + 1), F.size(marks)) - lo
        picked = F.transform(F.sequence(F.lit(0), F.lit(picks - 1)), lambda j: F.get(F.col(marks), lo + j))
        return F.when(size >= picks, F.struct(F.shiftright(F.get(F.col(marks), lo), shift).alias("bin"),
                                              entry(picked).alias("hash")))

    def among_all(b):
        turn = lambda m: m.bitwiseXOR(F.lit(b << shift))
        near = F.slice(F.sort_array(F.transform(marks, turn)), 1, picks)
        return F.when(F.size(marks) > 0, entry(F.transform(near, turn)))

    df = df.withColumn(runs, F.map_from_entries(F.filter(F.transform(runs, full), lambda e: e.isNotNull())))
    # not a lambda over the bins: the optimiser would put the map into it, once per bin
    return df.withColumn(out, F.array(*(F.coalesce(F.try_element_at(runs, F.lit(b).cast("long")), among_all(b))
                                        for b in range(bins)))).drop(grams, marks, runs)


def likeness(a: str, b: str) -> Column:
    """Share of equal entries among those filled in either."""
    pairs = F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b"))
    used = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(used == 0, 1.0).otherwise(same / used)


def as_text(a: str) -> Column:
    """A fingerprint as hexadecimal entries, '-' for an empty one."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.hex(h))), " ", "-")


def _range_of(value: Column, bounds: list) -> Column:
    """How many of the bounds lie below the value."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.lit(bounds), lambda b: b < value))


def with_next(rows: DataFrame, derive, *columns: str) -> DataFrame:
    """``derive(rows)`` with, for each of ``columns``, ``next_<column>``: its
    value in the row with the next doc_id (equal ids by text; after the last,
    the first). ``rows`` holds doc_id and text; ``derive`` adds columns row by
    row. Rows are dealt into ranges of ids found by quantiles, so that the
    order is made side by side; the first rows of the ranges close the gaps."""
    n = shuffle_partitions(rows.sparkSession) * RANGES
    found = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    dealt = rows.withColumn("range", F.coalesce(
        F.when(F.col("doc_id").isNull(), -1), _range_of(F.col("doc_id"), sorted(set(found or [])))))
    order = [F.col("doc_id").asc_nulls_first(), "text"]
    ranged = derive(dealt)
    chained = ranged.withColumn("following", F.lead(F.struct(*columns)).over(
        Window.partitionBy("range").orderBy(*order)))
    firsts = dealt.groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("f")).select("range", "f.*")
    firsts = derive(firsts).select("range", F.struct(*columns).alias("first"))
    over = Window.orderBy("range")                          # one row per range
    gaps = firsts.select(F.col("range").alias("gap"), F.coalesce(
        F.lead("first").over(over), F.first("first").over(over)).alias("beyond"))
    return chained.join(gaps, F.col("range") == F.col("gap")).select(
        *(c for c in ranged.columns if c != "range"),
        *(F.when(F.col("following").isNull(), F.col(f"beyond.{c}")).otherwise(F.col(f"following.{c}"))
          .alias(f"next_{c}") for c in columns))


def fingerprints(docs: DataFrame, *, k: int = K, bins: int = BINS, picks: int = PICKS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and fingerprint (array of longs) per document."""
    return add_fingerprint(id_text(docs, id_col, text_col), "text", "fingerprint", k=k, bins=bins, picks=picks)


def edited_report(docs: DataFrame, *, k: int = K, bins: int = BINS, picks: int = PICKS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: every document's fingerprint, that of its
    edited text (its last quarter replaced by as much of the next document's
    beginning), and how like its own they and the next document's are."""
    rows = with_next(id_text(docs, id_col, text_col),
                     lambda df: add_fingerprint(df, "text", "fingerprint", k=k, bins=bins, picks=picks),
                     "text", "fingerprint").withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - quarter), F.left("next_text", quarter))
    rows = rows.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", edited.alias("edited"))
    rows = add_fingerprint(rows, "edited", "edited_entries", k=k, bins=bins, picks=picks)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text("fingerprint").alias("fingerprint"), as_text("edited_entries").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_entries").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"))
