"""Licence scan: ordered signature rules behind a keyword prefilter.

The words of a batch are hashed together; a text without any keyword of the
rules is done after that. For the others the rules whose keywords occur are
tried on the normalised text (license_rules.py). A detection that lies within
another of the same or a higher priority is dropped. Base phrases are found
word by word and always stay.

Defined cases: a null or empty text has no words, empty labels, null first
and last word and the score 0; each repeated document gets its row.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from strata.llm.common import id_text
from strata.llm.license_rules import Rule, rules
from strata.llm.words import ALNUM, Words, find_words, grouped

#: Base phrases and their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, detections string")


class Matcher:
    """The rules and phrases with the hashes of their keywords."""

    def __init__(self, phrases: dict[str, str]):
        self.rules = rules()
        self.keywords = sorted({k for r in self.rules for k in r.keywords})
        self.hashes = find_words([" ".join(self.keywords).encode()], ALNUM).hashes
        self.order = np.argsort(self.hashes)
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        self.phrases = [(p.encode().split(), find_words([p.encode()], ALNUM).hashes, label)
                        for p, label in phrases.items()]

    def keywords_by_text(self, found: Words) -> dict[int, set[str]]:
        """The keywords that occur in each text; texts without any are left out."""
        at = np.flatnonzero(self.bits[(found.hashes >> np.uint64(48)).astype(np.int64)])
        known = self.hashes[self.order]
        place = np.minimum(np.searchsorted(known, found.hashes[at]), len(known) - 1)
        same = known[place] == found.hashes[at]
        text = np.searchsorted(found.bounds, at[same], side="right") - 1
        out: dict[int, set[str]] = {}
        for t, k in zip(text.tolist(), self.order[place[same]].tolist()):
            out.setdefault(t, set()).add(self.keywords[k])
        return out

    def phrases_by_text(self, found: Words) -> dict[int, list[tuple[int, int, str]]]:
        """(first word, word after the last, label) of each base phrase."""
        out: dict[int, list[tuple[int, int, str]]] = {}
        for words, hashes, label in self.phrases:
            n = len(words)
            at = np.flatnonzero(found.hashes[:max(len(found.hashes) - n + 1, 0)] == hashes[0])
            for j in range(1, n):
                at = at[found.hashes[at + j] == hashes[j]]
            text = np.searchsorted(found.bounds, at, side="right") - 1
            inside = at + n <= found.bounds[text + 1]
            for k, t in zip(at[inside].tolist(), text[inside].tolist()):
                if [found.word(k + j) for j in range(n)] == words:
                    lo = k - int(found.bounds[t])
                    out.setdefault(t, []).append((lo, lo + n, label))
        return out

    def detect(self, words: list[str], keys: set[str]) -> list[tuple[int, int, Rule]]:
        """Detections of the rules that the keywords let through, as word spans."""
        text = " ".join(words)
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        hits = []
        for r in self.rules:
            if r.keywords & keys:
                for m in r.pattern.finditer(text):
                    hits.append((bisect_right(starts, m.start()) - 1,
                                 bisect_right(starts, m.end() - 1), r))
        return hits


def resolve(hits: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Without the detections that lie within another of the same or a higher
    priority; of equal spans and priorities the first rule stays.

    Containment and priority are transitive, so it is enough to know, going by
    start, the farthest end so far of each priority."""
    kept, farthest = [], [-1] * 10
    for lo, hi, r in sorted(hits, key=lambda h: (h[0], -h[1], -h[2].priority)):
        if max(farthest[r.priority:]) < hi:
            kept.append((lo, hi, r))
            farthest[r.priority] = hi
    return kept


@cache
def matcher(phrases: tuple) -> Matcher:
    return Matcher(dict(phrases))


def scan(docs: DataFrame, *, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per document the contract's columns and ``detections``: label:start:end
    in words (end exclusive) of all that stay, by start, comma-joined. The
    score is one minus the product of (1 - weight) over the distinct labels;
    a base phrase alone weighs 0.5."""
    fixed = tuple(phrases.items())

    def run(batches):
        import pyarrow as pa

        m = matcher(fixed)
        types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.string()]
        names = [c.split()[0] for c in SCAN.split(", ")]
        for ids, texts in grouped(batches, "doc_id", "text"):
            found = find_words(texts, ALNUM)
            keys, base = m.keywords_by_text(found), m.phrases_by_text(found)
            rows = []
            for k, doc in enumerate(ids):
                lo, hi = int(found.bounds[k]), int(found.bounds[k + 1])
                spans = base.get(k, [])
                hits = []
                if k in keys:
                    words = [found.word(j).decode() for j in range(lo, hi)]
                    hits = resolve(m.detect(words, keys[k]))
                weights = {label: 0.5 for *_, label in spans}
                for *_, r in hits:
                    weights[r.label] = max(weights.get(r.label, 0.0), r.weight)
                places = sorted({(s, e, label) for s, e, label in spans} | {(s, e, r.label) for s, e, r in hits})
                starts = [s for s, *_ in spans]
                rows.append((doc, hi - lo, len(spans), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted({x[2] for x in spans})), ",".join(sorted(weights)),
                             float(1 - np.prod([1 - w for w in weights.values()])),
                             ",".join(f"{label}:{s}:{e}" for s, e, label in places)))
            cols = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return id_text(docs, id_col, text_col).mapInArrow(run, SCAN)
