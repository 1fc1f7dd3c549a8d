"""Whole-text token ids from a ``tokenizers`` file, with a bounded memo.

The vocabulary's normaliser turns every run of white space into one space,
its pre-tokeniser drops white space, and no other rule looks across white
space. The ids of a text are therefore the ids of its chunks between ASCII
white space put end to end, and a chunk's ids can be remembered. (The tests
compare this with encoding whole texts, on Unicode, special tokens and
punctuation.) Further exact shortcuts:

* A-Z is lower-cased first, as the normaliser does; texts holding ``<|`` are
  encoded whole, because special tokens are matched before normalising;
* a run of ASCII punctuation at the end of a chunk, after a letter or digit,
  is a pre-token of its own, so it is split off;
* a chunk of lower-case Latin letters is one pre-token that normalising leaves
  as it is, so it goes to the library's merge model directly.

Chunks are found and looked up for many texts at once (words.py). A slot of the
memo, found by hash, is only believed if it holds the very chunk: its length and
its first and last eight bytes, which are all of a chunk of up to sixteen bytes.
Longer chunks are remembered in a dictionary by their bytes.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

import numpy as np

from strata.llm.words import FIRST, NOT_SPACE, blocks, find_words, hash_spans

#: Slots of the memo (one chunk each; a newer chunk takes an older one's slot),
#: and the ids it holds before it starts afresh.
MEMO_BITS = 20
MEMO_IDS = 1 << 23
#: Longest chunk of the memo's slots; chunks in the dictionary.
SHORT = 16
MEMO_LONG = 1 << 16
MEMO_CHUNK = 256

_letters = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
_PUNCT = np.zeros(256, bool)
_PUNCT[[*b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class Encoder:
    """Token ids of whole texts, the same as the library gives for each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.head = np.zeros(1 << MEMO_BITS, dtype=np.uint64)
        self.tail = np.zeros(1 << MEMO_BITS, dtype=np.uint64)
        self.length = np.zeros(1 << MEMO_BITS, dtype=np.uint8)   # 0: the slot is free
        self.at = np.zeros(1 << MEMO_BITS, dtype=np.int64)
        self.size = np.zeros(1 << MEMO_BITS, dtype=np.int64)
        self.long: dict[bytes, tuple[int, int]] = {}
        self.ids, self.used = np.zeros(1 << 16, dtype="<u4"), 0

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunk(self, chunk: bytes) -> list[int]:
        text = chunk.decode()
        if not _letters(text):
            return self.whole(text)
        word = text if text.isascii() else text.translate(self.alphabet)
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _keep(self, ids: array) -> int:
        """Put ids behind those held; returns where they begin."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.ids):
            self.ids = np.concatenate([self.ids[:at], np.zeros(2 * self.used - at, dtype="<u4")])
        self.ids[at:self.used] = ids
        return at

    def _chunks(self, texts: list[bytes]):
        """Hash, start and end of every chunk, and the chunks before each text."""
        found = find_words(texts, NOT_SPACE)
        buf = np.frombuffer(found.joined, dtype=np.uint8)
        starts, ends = found.starts, found.ends
        tail = ends.copy()                     # where the punctuation at the end begins
        live = np.flatnonzero(_PUNCT[buf[ends - 1]]) if len(ends) else ends
        while len(live):
            tail[live] -= 1
            live = live[tail[live] > starts[live]]
            live = live[_PUNCT[buf[tail[live] - 1]]]
        cut = np.flatnonzero((tail < ends) & (tail > starts))
        cut = cut[_SOLID[buf[tail[cut] - 1]]]
        if not len(cut):
            return found.joined, found.hashes, starts, ends, found.bounds
        before = found.hashes.copy()
        before[cut] = hash_pieces(buf, starts[cut], tail[cut])
        after = hash_pieces(buf, tail[cut], ends[cut])
        s, e = np.insert(starts, cut + 1, tail[cut]), np.insert(ends, cut, tail[cut])
        return (found.joined, np.insert(before, cut + 1, after), s, e,
                found.bounds + np.searchsorted(cut, found.bounds))

    def _new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode chunks; returns where their ids begin, and how many there are."""
        flat, sizes = array("I"), []
        for c in chunks:
            ids = self._chunk(c)
            sizes.append(len(ids))
            flat.extend(ids)
        size = np.array(sizes, dtype=np.int64)
        return self._keep(flat) + np.cumsum(size) - size, size

    def _look_up(self, joined: bytes, h: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Where each chunk's ids begin, and how many there are."""
        length = ends - starts
        block = blocks(np.frombuffer(joined, dtype=np.uint8))
        brief = np.minimum(length, 8)
        head = block[starts] & FIRST[brief]
        tail = np.where(length > 8, block[ends - brief], head)
        slot = (h >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        at, size = self.at[slot], self.size[slot]
        same = (self.length[slot] == length) & (self.head[slot] == head) & (self.tail[slot] == tail)
        far = np.flatnonzero(length > SHORT)
        miss = np.flatnonzero(~same & (length <= SHORT))
        if len(miss):
            key = np.lexsort((length[miss], tail[miss], head[miss]))
            by = miss[key]
            new = np.append(True, (head[by[1:]] != head[by[:-1]]) | (tail[by[1:]] != tail[by[:-1]])
                            | (length[by[1:]] != length[by[:-1]]))
            first, of = by[new], np.cumsum(new) - 1
            new_at, new_size = self._new([joined[s:e].lower() for s, e in zip(starts[first].tolist(), ends[first].tolist())])
            at[by], size[by] = new_at[of], new_size[of]
            # of chunks that share a slot the last one stays: its slot's order decides for all arrays alike
            slot, last = np.unique(slot[first][::-1], return_index=True)
            last = len(first) - 1 - last
            self.head[slot], self.tail[slot], self.length[slot] = head[first[last]], tail[first[last]], length[first[last]]
            self.at[slot], self.size[slot] = new_at[last], new_size[last]
        for j in far.tolist():
            chunk = joined[starts[j]:ends[j]].lower()
            if (held := self.long.get(chunk)) is None:
                (a,), (n,) = self._new([chunk])
                held = int(a), int(n)
                if len(chunk) <= MEMO_CHUNK:
                    self.long[chunk] = held
            at[j], size[j] = held
        return at, size

    def encode(self, texts: list[bytes], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by the id ``end`` if given,
        and their bounds: text k has ids[bounds[k]:bounds[k + 1]]."""
        special = [k for k, t in enumerate(texts) if b"<|" in t]
        if special:
            texts = list(texts)
            apart = {k: self.whole(texts[k].decode()) for k in special}
            for k in special:
                texts[k] = b""
        if self.used > MEMO_IDS or len(self.long) > MEMO_LONG:
            self.length[:], self.used, self.long = 0, 0, {}
        joined, h, starts, ends, bounds = self._chunks(texts)
        at, size = self._look_up(joined, h, starts, ends)
        if special:
            row = [self._keep(array("I", apart[k])) for k in special]
            place = bounds[special]
            at, size = (np.insert(at, place, row),
                        np.insert(size, place, [len(apart[k]) for k in special]))
            bounds = bounds + np.searchsorted(special, np.arange(len(bounds)))
        if end is not None:
            stop = self._keep(array("I", [end]))
            at, size = np.insert(at, bounds[1:], stop), np.insert(size, bounds[1:], 1)
            bounds = bounds + np.arange(len(bounds))
        total = np.cumsum(np.append(0, size))
        ids = self.ids[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
        return ids, total[bounds]


def hash_pieces(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans inside chunks: the spans are put end to end first, so
    that the work follows their length and not the buffer's."""
    sizes = ends - starts
    total = np.cumsum(np.append(0, sizes))
    flat = buf[np.repeat(starts - total[:-1], sizes) + np.arange(total[-1])]
    return hash_spans(flat, total[:-1], total[1:])


@cache
def encoder(path: str) -> Encoder:
    """One encoder, and so one memo, per Python worker and vocabulary file."""
    return Encoder(path)
