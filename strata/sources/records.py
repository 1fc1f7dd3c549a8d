"""Records of CSV files whose quoted fields hold line breaks, read in splits.

Whether a line break ends a record depends on the quotes before it, up to the
file's beginning. Spark's ``multiLine`` therefore reads a file in one task. Here
a first scan counts the quotes of every split; a running sum over one row per
split tells which splits begin inside a quoted field. Every split is then cut
into records by itself. What a record has in several splits -- its end, and
its beginning, of which a split has one each at most -- is put together by
file. A doubled quote counts twice and so changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, BEGIN, MIDDLE, END = range(4)


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One row per record, as ``record``; blank ones and each file's header are
    left out. A record may hold any number of line breaks; a quote that is
    never closed runs on to the file's end."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1))
    inside = splits.select("file", "block", (before % 2 == 1).alias("odd")).where("odd")
    # One row per split that begins inside quotes; a broadcast join keeps the lines' order.
    marked = lines.join(F.broadcast(inside), ["file", "block"], "left").select(
        "file", "block", F.coalesce("odd", F.lit(False)).alias("odd"), "value")
    cut = marked.mapInArrow(_cut, "file string, block long, seq long, part int, record string")
    whole = cut.where(F.col("part") == WHOLE)
    if header:
        whole = whole.where((F.col("block") > 0) | (F.col("seq") > 0))
    in_file = Window.partitionBy("file").orderBy("block", "seq")     # two rows per split at most
    parts = cut.where(F.col("part") != WHOLE).withColumn(
        "number", F.sum((F.col("part") == BEGIN).cast("long")).over(in_file))
    joined = parts.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "record"))).alias("p")).select(
        F.array_join("p.record", "\n").alias("record"))
    return whole.select("record").unionByName(joined).select(
        F.regexp_replace("record", "\r$", "").alias("record")).where(F.trim("record") != "")


def _cut(batches):
    """Records, and parts of records, of each split's lines."""
    import pyarrow as pa

    now, seq, odd, held, state = None, 0, False, [], WHOLE

    def row(part):
        return (*now, seq, part, "\n".join(held))

    for batch in batches:
        out = []
        for file, block, inside, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != now:
                if held:
                    out.append(row(MIDDLE if state == END else BEGIN))
                now, seq, odd, held, state = (file, block), 0, inside, [], END if inside else WHOLE
            held.append(line)
            odd ^= line.count('"') % 2 == 1
            if not odd:
                out.append(row(state))
                seq, held, state = seq + 1, [], WHOLE
        yield _batch(pa, out)
    if held:
        yield _batch(pa, [row(MIDDLE if state == END else BEGIN)])


def _batch(pa, rows: list[tuple]):
    kinds = [("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("part", pa.int32()), ("record", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)],
                                      names=[n for n, _ in kinds])
