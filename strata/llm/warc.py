"""WARC archives with a two-level capture index.

``write`` puts one record per page into gzip-per-record WARC files (pages with
the same payload as a later page, by id, become revisits of it) and returns
one index line per record: key, file, offset, length. ``write_index`` sorts
the lines by key (reversed host, then path and query, then page id) into
compressed blocks, with a sparse directory of the blocks' first keys per file
and a top directory of the files' first keys. ``lookup`` finds a key by binary
search in the top directory, in that file's directory and in one decompressed
block, and then reads the record's bytes alone.

Every file appears under its name only when whole; a repeated task writes the
same bytes. Payloads cross the network once, to meet the choice of the
responses (adaptive execution splits the partitions of common payloads).

Defined cases: a null html is an empty payload; a null or odd URL is keyed by
its own text; rows with equal page ids and payloads are all responses, as are
rows whose page id is null (they have no id to be referred to).
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from functools import lru_cache
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SharedFile, filesystem, read_range, shuffle_partitions, small_batches
from strata.session import materialize

BLOCK_LINES = 512
LEVEL = 1
DATE = "2024-01-01T00:00:00Z"
WARC_VERSION = "WARC/1.1"


def url_key(url: str | None, page_id: int | None) -> str:
    """Sort key of a capture: reversed host, path and query, page id."""
    try:
        u = urlsplit(url or "")
        host, port = (u.hostname or "").removeprefix("www."), u.port
    except ValueError:
        u, host, port = None, "", None
    if not host:
        key = (url or "").lower()
    else:
        key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
        key += ")" + (u.path or "/") + (f"?{'&'.join(sorted(u.query.split('&')))}" if u.query else "")
    key = key.replace("\n", "%0A").replace(" ", "%20")
    return f"{key} {'-' if page_id is None else f'{page_id:+021d}'}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head of its response, and so
    the payload's size, without the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers, HTTP headers and payload of a record, digest checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    page = fields["WARC-Record-ID"][len("<urn:page:"):-1]
    refers = fields.get("WARC-Refers-To", "<urn:page:>")[len("<urn:page:"):-1]
    return {"page_id": int(page) if page else None, "url": fields["WARC-Target-URI"],
            "payload_bytes": int(http_fields["Content-Length"]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": int(refers) if refers else None,
            "payload": payload}


LINES = "key string, file string, at long, size long"


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", level: int = LEVEL, file_bytes: int = 1 << 28) -> DataFrame:
    """Write the archives; returns the index lines as a table beside them."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    groups = (rows.groupBy("sha").agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
              .where("copies > 1").select(F.col("sha").alias("copied"), "response"))
    chosen = rows.join(groups, rows.sha == groups.copied, "left").withColumn(
        "refers_to", F.when(F.col("response") > F.col("page_id"), F.col("response")))

    def put(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, number, out = TaskContext.get().partitionId(), 0, None
        for b in batches:
            keys, files, ats, sizes = [], [], [], []
            cols = [b.column(b.schema.get_field_index(c)) for c in ("page_id", "url", "html", "sha", "refers_to")]
            for page_id, url, html, sha, refers in zip(*cols):
                page_id, url, refers = page_id.as_py(), url.as_py(), refers.as_py()
                if out is not None and out.size >= file_bytes:
                    out.close()
                    out = None
                if out is None:
                    name = f"pages-{part:06d}-{number:04d}.warc.gz"
                    out, number = SharedFile(folder, name), number + 1
                digest = base64.b32encode(bytes.fromhex(sha.as_py())).decode()
                packer = zlib.compressobj(level, wbits=31)
                raw = record(page_id, url, html.as_buffer().to_pybytes(), digest, refers)
                raw = packer.compress(raw) + packer.flush()
                keys.append(url_key(url, page_id)), files.append(name)
                ats.append(out.write(raw)), sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(ats, pa.int64()),
                 pa.array(sizes, pa.int64())], names=["key", "file", "at", "size"])
        if out is not None:
            out.close()

    return materialize(chosen.select("page_id", "url", "html", "sha", "refers_to").mapInArrow(put, LINES), "captures")


def write_index(lines: DataFrame, folder: str, *, block_lines: int = BLOCK_LINES) -> list[str]:
    """Sorted blocks and a directory per range of keys; returns the names of
    the index files in key order (the top directory, one line per file, is
    written beside them as ``top.json``)."""
    spark = lines.sparkSession

    def put(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        out, held, directory = None, [], []

        def flush():
            raw = zlib.compress("\n".join(held).encode())
            directory.append((held[0].rsplit("\t", 3)[0], out.write(raw), len(raw)))
            held.clear()

        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(4)]
            for key, file, at, size in zip(*cols):
                if out is None:
                    name = f"index-{TaskContext.get().partitionId():06d}.cdx"
                    out = SharedFile(folder, name)
                held.append(f"{key}\t{file}\t{at}\t{size}")
                if len(held) == block_lines:
                    flush()
        if out is not None:
            if held:
                flush()
            raw = zlib.compress(json.dumps(directory).encode())
            at = out.write(raw)
            out.close()
            yield pa.RecordBatch.from_pylist([{"first": directory[0][0], "file": name, "at": at, "size": len(raw)}])

    ordered = lines.repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key", "file", "at")
    files = ordered.mapInArrow(put, "first string, file string, at long, size long")
    top = sorted(tuple(r) for r in files.collect())          # one row per index file
    out = SharedFile(folder, "top.json")
    out.write(json.dumps(top).encode())
    out.close()
    return [t[1] for t in top]


class Index:
    """Binary search over a written index; keeps the last blocks it read."""

    def __init__(self, folder: str):
        self.folder = folder
        on, path = filesystem(f"{folder}/top.json")
        self.top = json.loads(read_range(folder, "top.json", 0, on.get_file_info(path).size))
        self.first = [t[0] for t in self.top]
        self._directory = lru_cache(4)(self._read_directory)
        self._block = lru_cache(4)(self._read_block)

    def _read_directory(self, k: int):
        _, file, at, size = self.top[k]
        entries = json.loads(zlib.decompress(read_range(self.folder, file, at, size)))
        return [e[0] for e in entries], entries

    def _read_block(self, file: str, at: int, size: int):
        lines = zlib.decompress(read_range(self.folder, file, at, size)).decode().split("\n")
        parts = [x.rsplit("\t", 3) for x in lines]
        return [p[0] for p in parts], parts

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """(file, offset, length) of every capture with exactly this key."""
        out = []
        k = max(bisect.bisect_left(self.first, key) - 1, 0)
        while k < len(self.top) and self.first[k] <= key:
            firsts, entries = self._directory(k)
            j = max(bisect.bisect_left(firsts, key) - 1, 0)
            while j < len(entries) and firsts[j] <= key:
                keys, parts = self._block(self.top[k][1], entries[j][1], entries[j][2])
                i = bisect.bisect_left(keys, key)
                while i < len(keys) and keys[i] == key:
                    out.append((parts[i][1], int(parts[i][2]), int(parts[i][3])))
                    i += 1
                j += 1
            k += 1
        return out


CAPTURE = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long")


def lookup(queries: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
           payload: bool = False) -> DataFrame:
    """The captures of each distinct (page id, URL) of ``queries``, read back
    from the archives by index search and range reads. Queries are sorted by
    key, so a task goes through its part of the index once; an URL with many
    captures is spread over tasks by page id."""
    spark = queries.sparkSession
    small_batches(spark)
    wanted = queries.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))

    def keys(batches):
        import pyarrow as pa

        for b in batches:
            got = [url_key(u, p) for p, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string())], names=["key"])

    schema = CAPTURE + (", payload binary" if payload else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        import pyarrow as pa

        index = Index(folder)
        types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        for b in batches:
            rows = []
            for key in b.column(0).to_pylist():
                for file, at, size in index.find(key):
                    rows.append(parse(zlib.decompress(read_range(folder, file, at, size), wbits=31)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names=names)

    ordered = (wanted.mapInArrow(keys, "key string").distinct()
               .repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key"))
    return ordered.mapInArrow(read, schema)


def archive(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write archives and index, and read every page back through them."""
    lines = write(pages, folder, **options)
    write_index(lines, folder)
    names = {k: v for k, v in options.items() if k in ("id_col", "url_col")}
    return lookup(pages, folder, **names)


def read_back(spark: SparkSession, folder: str, keys: list[str]) -> list[dict]:
    """Records of a few keys, on the driver."""
    index = Index(folder)
    return [parse(zlib.decompress(read_range(folder, f, at, n), wbits=31))
            for k in keys for f, at, n in index.find(k)]
