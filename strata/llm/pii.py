"""Personal data: base patterns, and a semi-Markov CRF for what they miss.

The four base kinds follow their fixed patterns and checks. The model
(pii_model.py) scores whole segments and picks boundaries and kinds together;
its spans are added where they touch no base span. It is trained here, on a
bounded sample of stretches around base hits and keys (``train_zones`` of
them, the smallest by hash over all documents), a part of them rewritten into
forms that the base patterns miss (a phone number without its plus sign, a
card number in groups with other separators) under the same label.

Defined cases: a null or empty text has no spans; repeated documents each get
their row; without any stretch to train on the model adds nothing.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, small_batches
from strata.llm.pii_model import KINDS, decode, luhn, train, zone, zone_spans
from strata.llm.words import grouped
from strata.session import materialize

TRAIN_ZONES = 400
#: Longest stretch taken to train on, in code points.
PIECE = 400
BASE_KINDS = KINDS[:4]

_local = re.compile(r"[A-Za-z0-9._%+-]")
_host = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_card = re.compile(r"[0-9]([\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_some = re.compile(r"[0-9@]")
_secret = re.compile(r"\bAKIA[0-9A-Z]{16}\b|(?<=password=)[0-9a-f]{12,}\b|(?<=token = \")[0-9a-f]{16,}(?=\")")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the base pattern. Each match holds
    one at sign, so they are found from there: the longest run before it, back
    to the last match, and the host after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        m = _host.match(text, at)
        if m:
            lo = at
            while lo > end and _local.match(text, lo - 1):
                lo -= 1
            if lo < at:
                out.append((lo, m.end()))
                end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """All base spans by start, then kind."""
    out = [(s, e, "email") for s, e in emails(text)]
    if _some.search(text):
        out += [(*m.span(), "ip") for m in _ip.finditer(text)
                if all(len(p) < 4 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]
        for m in _card.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        if "+" in text:
            out += [(*m.span(), "phone") for m in _phone.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def model_spans(text: str, base: list[tuple[int, int, str]], weights: np.ndarray) -> list[tuple[int, int, str]]:
    """The model's spans that touch no base span."""
    out = []
    for lo, hi in zone_spans(text):
        out += decode(zone(text, lo, hi), weights)
    if base and out:
        cover, last = [], -1
        for s, e, _ in base:                      # by start; ends made monotone
            last = max(last, e)
            cover.append((s, last))
        starts = np.array([s for s, _ in cover])
        keep = []
        for s, e, c in out:
            k = int(np.searchsorted(starts, e)) - 1
            if k < 0 or cover[k][1] <= s:
                keep.append((s, e, c))
        return keep
    return out


def _variant(kind: str, s: str, rng: random.Random) -> str:
    """A form of the same thing that its base pattern misses, or as it is."""
    if kind == "phone" and rng.random() < 0.4:
        return s.lstrip("+") if rng.random() < 0.5 else s[s.find(" ") + 1:]
    if kind == "card" and rng.random() < 0.4 and s.isdigit():
        mark = rng.choice([".", "_", "/"])
        return mark.join(s[k:k + 4] for k in range(0, len(s), 4))
    return s


def training_text(text: str, spans: list[tuple[int, int, str]], seed: int):
    """The text with some of its spans rewritten, and where they are then."""
    rng, out, moved, last, size = random.Random(seed), [], [], 0, 0
    for s, e, kind in sorted(spans):
        if s < last:
            continue
        new = _variant(kind, text[s:e], rng)
        out += [text[last:s], new]
        size += s - last
        moved.append((size, size + len(new), kind))
        size, last = size + len(new), e
    return "".join([*out, text[last:]]), moved


def training_sample(rows: DataFrame, limit: int) -> list[str]:
    """Stretches with a base or key span, and as many without, ``limit`` at
    most of each (the smallest by hash over all documents)."""
    def find(batches):
        import pyarrow as pa

        for _, texts in grouped(batches, "doc_id", "text"):
            got = set()
            for raw in texts:
                text = raw.decode()
                if not _some.search(text):
                    continue
                seeds = [(s, e) for s, e, _ in base_spans(text)] + [m.span() for m in _secret.finditer(text)]
                for lo, hi in zone_spans(text):
                    if hi - lo <= PIECE:
                        got.add((any(lo <= s and e <= hi for s, e in seeds), text[lo:hi]))
            flags, pieces = zip(*sorted(got)) if got else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(flags, pa.bool_()), pa.array(pieces, pa.string())],
                                             names=["seeded", "piece"])

    pieces = materialize(rows.mapInArrow(find, "seeded boolean, piece string")
                         .withColumn("h", F.xxhash64("piece")).distinct(), "pii-zones")
    return [r.piece for seeded in (True, False)
            for r in pieces.where(F.col("seeded") == seeded).orderBy("h", "piece").limit(limit).collect()]


def fit(rows: DataFrame, *, train_zones: int = TRAIN_ZONES, seed: int = 7) -> np.ndarray:
    """Model weights from a bounded sample of the texts themselves."""
    examples = []
    for k, piece in enumerate(training_sample(rows, train_zones)):
        spans = base_spans(piece)
        for m in _secret.finditer(piece):
            if not any(s < m.end() and m.start() < e for s, e, _ in spans):
                spans.append((*m.span(), "secret"))
        examples.append(training_text(piece, spans, seed + k))
    return train(examples)


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{c}:{s}:{e}" for s, e, c in spans)


def find(docs: DataFrame, *, train_zones: int = TRAIN_ZONES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per document the contract's columns: base counts and digest, and all
    spans as kind:start:end (code points, end exclusive)."""
    rows = id_text(docs, id_col, text_col)
    weights = rows.sparkSession.sparkContext.broadcast(fit(rows, train_zones=train_zones))
    names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]

    def run(batches):
        import pyarrow as pa

        for ids, texts in grouped(batches, "doc_id", "text"):
            counts, shas, spans = [], [], []
            for raw in texts:
                text = raw.decode()
                base = base_spans(text) if _some.search(text) else []
                more = model_spans(text, base, weights.value) if _some.search(text) else []
                counts.append([sum(c == k for *_, c in base) for k in BASE_KINDS])
                shas.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))))
            by_kind = list(zip(*counts)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in by_kind),
                 pa.array(shas, pa.string()), pa.array(spans, pa.string())], names=names)

    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string")


def redact(docs: DataFrame, *, train_zones: int = TRAIN_ZONES, text_col: str = "text",
           length_col: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets
    (``<email>``); overlapping spans are replaced as one, under the kind of
    the first. Texts without spans, and all other columns, stay as they are;
    ``length_col``, where present, follows a changed text."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(fit(rows, train_zones=train_zones))

    def clean(text: str | None) -> str | None:
        if text is None or not _some.search(text):
            return text
        base = base_spans(text)
        out, last = [], 0
        for s, e, c in sorted(base + model_spans(text, base, weights.value), key=lambda x: (x[0], KINDS.index(x[2]))):
            if s >= last:
                out += [text[last:s], f"<{c}>"]
            last = max(last, e)
        return "".join([*out, text[last:]]) if out else text

    def run(batches):
        import pyarrow as pa

        for b in batches:
            at = b.schema.get_field_index(text_col)
            lengths = b.schema.get_field_index(length_col) if length_col else -1
            texts = b.column(at).to_pylist()
            new = [clean(t) for t in texts]
            b = b.set_column(at, b.schema.field(at), pa.array(new, type=b.schema.field(at).type))
            if lengths >= 0:
                n = [len(y) if x != y else c for x, y, c in zip(texts, new, b.column(lengths).to_pylist())]
                b = b.set_column(lengths, b.schema.field(lengths), pa.array(n, type=b.schema.field(lengths).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
