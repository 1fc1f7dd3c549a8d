"""Token ids in canonical, length-limited Huffman code.

``write`` encodes every text once into a table of ids, counts them, builds one code of at most ``max_bits`` bits per id
(package-merge, canonical order), and writes files of blocks in ascending
document order. Every block is decoded by itself; checkpoints in it hold the
bit offset of every ``CHECK``-th id, so a reader starts at any of them, and
all checkpoints of the blocks at hand are decoded side by side through one
table of 2**max_bits entries.

The counts, the code and the manifest are bounded by the vocabulary and the
number of files; ids and texts never reach the driver. Files appear under
their names only when whole, and a repeated task writes the same bytes.

File: magic; blocks; footer (an Arrow table of documents, one of blocks, the
code lengths); the sizes of the three; magic. A block is byte-aligned, most
significant bit first.

Defined cases: a null or empty text is its end id alone; rows with a null id
come first; rows of one id are ordered by a hash of their token ids, then by
those; an empty table gives no
files and no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.bpe import encoder
from strata.llm.common import SharedFile, id_text, read_range, shuffle_partitions
from strata.llm.words import grouped
from strata.session import materialize

END_ID = 2
MAX_BITS = 20
BLOCK = 1 << 16
CHECK = 256
MAGIC = b"STRIDHF1"
_TAIL = struct.Struct("<QQQ8s")


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for the ids that occur
    (0 for the others), by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids don't fit a code of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, masks = leaves, [np.ones(len(leaves), bool)]
    for _ in range(max_bits - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        masks.append(by < len(leaves))
    take = 2 * len(leaves) - 2
    for mask in reversed(masks):
        own = int(mask[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids in code order, the code of each): shorter first, then by id."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    codes, code, last = [], 0, 0
    for n in lengths[order].tolist():
        code <<= n - last
        codes.append(code)
        code, last = code + 1, n
    return order, np.array(codes, dtype=np.uint64)


class Codec:
    """Encoding and decoding by tables for one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint64)
        order, codes = canonical(lengths)
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[order] = codes
        self.bits = int(lengths.max(initial=1))
        entries = (np.uint32(1) << (self.bits - lengths[order].astype(np.uint32))).astype(np.int64)
        self.table = np.zeros(1 << self.bits, dtype=np.uint32)
        filled = np.repeat((order.astype(np.uint32) << 5) | lengths[order], entries)
        self.table[:len(filled)] = filled

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The block's bytes and the bit offsets of its checkpoints."""
        n = self.lengths[ids]
        end = np.cumsum(n)
        at = end - n
        word = (at >> np.uint64(5)).astype(np.int64)
        value = self.codes[ids] << (np.uint64(64) - (at & np.uint64(31)) - n)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(int(word[-1]) + 2, dtype=np.uint64)
        out[word[first]] = np.bitwise_or.reduceat(value >> np.uint64(32), first)
        out[word[first] + 1] |= np.bitwise_or.reduceat(value & np.uint64(0xFFFFFFFF), first)
        raw = out.astype(">u4").tobytes()
        return raw[:(int(end[-1]) + 7) // 8], at[::CHECK].astype(np.uint32)

    def decode(self, data: bytes, bit_at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of runs that begin at the given bits, put end to end; no run is
        longer than CHECK."""
        raw = np.frombuffer(data + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        at, left = bit_at[order].astype(np.int64), counts[order]
        out = np.zeros((int(counts.max(initial=0)), len(counts)), dtype=np.uint32)
        shift = np.uint32(32 - self.bits)
        for k in range(len(out)):
            live = int(np.searchsorted(-left, -k, side="left"))
            p = at[:live]
            hit = self.table[(window[p >> 3] << (p & 7).astype(np.uint32)) >> shift]
            out[k, :live] = hit >> 5
            p += hit & 31
        back = np.empty_like(out)
        back[:, order] = out
        return back.T[np.arange(len(out)) < counts[:, None]]


def _ipc(table) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


class Writer:
    """One file: ids are appended in order and leave in blocks."""

    def __init__(self, folder: str, name: str, lengths: np.ndarray, codec: Codec):
        self.lengths, self.codec, self.name = lengths, codec, name
        self.file = SharedFile(folder, name)
        self.file.write(MAGIC)
        self.docs, self.counts, self.blocks, self.rest = [], [], [], np.zeros(0, dtype="<u4")

    def add(self, docs: list, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs += docs
        self.counts += counts.tolist()
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // BLOCK * BLOCK
        for k in range(0, full, BLOCK):
            self._block(ids[k:k + BLOCK])
        self.rest = ids[full:]

    def _block(self, ids: np.ndarray) -> None:
        data, checks = self.codec.encode(ids)
        self.blocks.append((self.file.write(data), len(data), len(ids), checks))

    def close(self) -> dict:
        import pyarrow as pa

        if len(self.rest):
            self._block(self.rest)
        docs = pa.table({"doc_id": pa.array(self.docs, pa.int64()), "n_tokens": self.counts})
        blocks = pa.table({"at": [b[0] for b in self.blocks], "size": [b[1] for b in self.blocks],
                           "n_ids": [b[2] for b in self.blocks],
                           "checks": pa.array([b[3] for b in self.blocks], pa.list_(pa.uint32()))})
        parts = [_ipc(docs), _ipc(blocks), zlib.compress(self.lengths.tobytes())]
        for p in parts:
            self.file.write(p)
        self.file.write(_TAIL.pack(*map(len, parts), MAGIC))
        self.file.close()
        return {"file": self.name, "bytes": self.file.size, "docs": len(self.docs),
                "tokens": sum(self.counts), "first_id": next((d for d in self.docs if d is not None), None)}


MANIFEST = "file string, bytes long, docs long, tokens long, first_id long"


def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, ids) of all texts, each encoded once and written: little-endian
    ids of two bytes where the vocabulary allows it, else of four."""
    def encode(batches):
        import pyarrow as pa

        enc = encoder(tokenizer_path)
        for ids, texts in grouped(batches, "doc_id", "text"):
            tokens, bounds = enc.encode(texts, end=end_id)
            raw, at = memoryview(tokens.astype(width)).cast("B"), (bounds * width.itemsize).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([raw[lo:hi] for lo, hi in zip(at, at[1:])], pa.binary())],
                names=["doc_id", "ids"])

    width = id_type(max(encoder(tokenizer_path).tokenizer.get_vocab_size() - 1, end_id))
    return materialize(docs.mapInArrow(encode, "doc_id long, ids binary"), "token-ids")


def id_type(largest: int) -> np.dtype:
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def count_ids(rows: DataFrame, kind: np.dtype) -> DataFrame:
    """(id, n) over all rows; each task sends one row per id it has seen."""
    def count(batches):
        import pyarrow as pa

        total = np.zeros(0, dtype=np.int64)
        for _, raw in grouped(batches, "doc_id", "ids"):
            got = np.bincount(np.frombuffer(b"".join(raw), dtype=kind), minlength=len(total))
            got[:len(total)] += total
            total = got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return rows.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = END_ID,
          max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files below ``folder`` (shared by all executors); returns the
    manifest, one row per file, which is also kept as a table beside them."""
    spark = docs.sparkSession
    kind = id_type(max(encoder(tokenizer_path).tokenizer.get_vocab_size() - 1, end_id))
    rows = token_rows(id_text(docs, id_col, text_col), tokenizer_path, end_id)
    found = count_ids(rows, kind).collect()                 # at most one row per id of the vocabulary
    counts = np.zeros(max((r.id for r in found), default=0) + 1, dtype=np.int64)
    for r in found:
        counts[r.id] = r.n
    lengths = spark.sparkContext.broadcast(code_lengths(counts, max_bits))

    def put(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        codec, out = Codec(lengths.value), None
        for ids, raw in grouped(batches, "doc_id", "ids"):
            if out is None:
                name = f"ids-{TaskContext.get().partitionId():06d}.huf"
                out = Writer(folder, name, lengths.value, codec)
            out.add(ids, np.array([len(x) // kind.itemsize for x in raw]),
                    np.frombuffer(b"".join(raw), dtype=kind).astype("<u4"))
        if out is not None:
            yield pa.RecordBatch.from_pylist([out.close()], schema=pa.schema(
                [("file", pa.string()), *((c, pa.int64()) for c in ("bytes", "docs", "tokens", "first_id"))]))

    # equal rows are told apart by their place, so that no id, however often it stands there, is one task
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    ordered = rows.withColumn("place", F.monotonically_increasing_id()) \
        .repartitionByRange(shuffle_partitions(spark), *order, "place").sortWithinPartitions(*order, "ids")
    return materialize(ordered.select("doc_id", "ids").mapInArrow(put, MANIFEST), "manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents back from the files: doc_id, start (ids of all documents
    before it), n_tokens and ids_crc32. Blocks are read and decoded a few at a
    time; a document may span any number of them."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    n = max(1, manifest.count())

    def get(batches):
        import pyarrow as pa

        for b in batches:
            for row in b.to_pylist():
                ids, start, count, crc = [], [], [], []
                for doc, at, n_tokens, c in read_file(folder, row["file"], row["bytes"]):
                    ids.append(doc), start.append(row["base"] + at), count.append(n_tokens), crc.append(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (ids, start, count, crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("file", "bytes", "base").repartition(n).mapInArrow(
        get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def footer(folder: str, name: str, size: int):
    """(documents, blocks, code lengths) of a file of ``size`` bytes."""
    import pyarrow as pa

    *sizes, magic = _TAIL.unpack(read_range(folder, name, size - _TAIL.size, _TAIL.size))
    if magic != MAGIC:
        raise ValueError(f"{name} is not a token file")
    at = size - _TAIL.size - sum(sizes)
    raw = read_range(folder, name, at, sum(sizes))
    docs, blocks = raw[:sizes[0]], raw[sizes[0]:sizes[0] + sizes[1]]
    lengths = np.frombuffer(zlib.decompress(raw[sizes[0] + sizes[1]:]), dtype=np.uint8)
    return pa.ipc.open_stream(docs).read_all(), pa.ipc.open_stream(blocks).read_all(), lengths


def read_blocks(folder: str, name: str, blocks, codec: Codec, step: int = 16):
    """Ids of a file's blocks, ``step`` blocks at a time."""
    rows = blocks.to_pylist()
    for k in range(0, len(rows), step):
        some = rows[k:k + step]
        lo, hi = some[0]["at"], some[-1]["at"] + some[-1]["size"]
        data = read_range(folder, name, lo, hi - lo)
        at, counts = [], []
        for b in some:
            at.append(np.array(b["checks"], dtype=np.int64) + 8 * (b["at"] - lo))
            n = np.full(len(b["checks"]), CHECK)
            n[-1] = b["n_ids"] - CHECK * (len(n) - 1)
            counts.append(n)
        yield codec.decode(data, np.concatenate(at), np.concatenate(counts)).astype("<u4")


def read_file(folder: str, name: str, size: int):
    """(doc_id, ids before it in the file, n_tokens, CRC-32 of its ids)."""
    docs, blocks, lengths = footer(folder, name, size)
    chunks = read_blocks(folder, name, blocks, Codec(lengths))
    have, at, start = memoryview(b""), 0, 0
    for doc, n in zip(docs.column("doc_id").to_pylist(), docs.column("n_tokens").to_pylist()):
        left, crc = 4 * n, 0
        while left:
            if at == len(have):
                have, at = memoryview(next(chunks)).cast("B"), 0
            step = min(left, len(have) - at)
            crc = zlib.crc32(have[at:at + step], crc)
            at, left = at + step, left - step
        yield doc, start, n, crc
        start += n
