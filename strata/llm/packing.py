"""Sequence packing: first-fit decreasing in randomised groups.

Every document becomes its token ids and one end id. It is cut every ``size``
ids from its start on, so all pieces but the last fill a sequence by
themselves; nothing else is cut. Pieces are dealt at random into groups of
about ``group_pieces``; within a group they go, longest first, into the first
sequence with room, found in a tournament tree of the sequences' free places
(each node holds the larger of its children, so the leftmost leaf with enough
room is reached in log steps). Groups are independent tasks of bounded size.

Only piece lengths and checksums are dealt into groups, not ids or texts. With
``with_ids`` every piece carries its ids (little-endian, unsigned, two bytes each
where the vocabulary allows it, else four), which are written down once and
joined to the places found; a sequence is its pieces put end to end by offset.

Defined cases: a null or empty text is its end id alone; repeated documents
are packed one by one; an empty table gives no rows. Equal lengths are placed
in the order of doc_id (nulls first) and start.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import encoder
from strata.llm.common import id_text
from strata.llm.huffman import id_type
from strata.llm.words import grouped
from strata.session import materialize

SIZE = 4096
END_ID = 2
GROUP_PIECES = 16384

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECE + ", sequence_id long, offset long, sequence_length long"


def cut_documents(docs: DataFrame, tokenizer_path: str, *, size: int = SIZE, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids, each with the CRC-32 of its ids as
    little-endian unsigned 32-bit integers; if asked for, with those too."""
    def cut(batches):
        import pyarrow as pa

        enc = encoder(tokenizer_path)
        for doc_ids, texts in grouped(batches, "doc_id", "text"):
            ids, bounds = enc.encode(texts, end=end_id)
            raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
            counts = np.diff(bounds)
            pieces = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
            length = np.minimum(counts[doc] - start, size)
            at = (bounds[doc] + start).tolist()
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at, length.tolist())]
            out = [pa.array([doc_ids[k] for k in doc.tolist()], pa.int64()), pa.array(start),
                   pa.array(length), pa.array(crc, pa.int64()), pa.array(counts[doc])]
            if with_ids:
                kept, w = memoryview(ids.astype(width)).cast("B"), width.itemsize
                out.append(pa.array([kept[w * a:w * (a + n)] for a, n in zip(at, length.tolist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in kind.split(", ")])

    kind = PIECE + (", ids binary" if with_ids else "")
    width = id_type(max(encoder(tokenizer_path).tokenizer.get_vocab_size() - 1, end_id)) if with_ids else None
    return id_text(docs, id_col, text_col).mapInArrow(cut, kind)


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items must come longest first."""
    leaves = 1 << max(len(lengths) - 1, 0).bit_length()
    tree = [size] * (2 * leaves)
    bins, offsets = [], []
    for n in lengths.tolist():
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        room = tree[node]
        bins.append(node - leaves)
        offsets.append(size - room)
        tree[node] = room - n
        node //= 2
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return np.array(bins, dtype=np.int64), np.array(offsets, dtype=np.int64)


def padded(lengths: np.ndarray, size: int) -> np.ndarray:
    """Sequence lengths after padding: a power of two stays, others are filled."""
    return np.where((lengths & (lengths - 1)) == 0, lengths, size)


def pack(docs: DataFrame, tokenizer_path: str, *, size: int = SIZE, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES, seed: int = 11, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in it, checksum, and its
    sequence, offset there and the sequence's padded length; if asked for,
    its ids."""
    pieces = materialize(cut_documents(docs, tokenizer_path, size=size, end_id=end_id, id_col=id_col,
                                       text_col=text_col, with_ids=with_ids)
                         .withColumn("piece", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def place(key, table):
        import pyarrow as pa

        table = table.combine_chunks().sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        length = table.column("length").to_numpy()
        bins, offsets = first_fit_decreasing(length, size)
        total = padded(np.bincount(bins, weights=length).astype(np.int64), size)
        sequence = (key[0].as_py() << 32) + bins
        out = table.drop_columns(["group"])
        for name, values in (("sequence_id", sequence), ("offset", offsets),
                             ("sequence_length", total[bins])):
            out = out.append_column(name, pa.array(values))
        return out

    dealt = pieces.drop("ids").withColumn("group", F.floor(F.rand(seed) * groups).cast("long"))
    if not with_ids:
        return dealt.drop("piece").groupBy("group").applyInArrow(place, PACKED)
    kind = PIECE + ", piece long" + PACKED.removeprefix(PIECE)
    return dealt.groupBy("group").applyInArrow(place, kind).join(pieces.select("piece", "ids"), "piece").drop("piece")
