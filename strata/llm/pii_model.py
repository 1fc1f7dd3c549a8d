"""A semi-Markov conditional random field over candidate segments.

A text's tokens are letter-digit runs and single marks. A segment is up to
MAX_TOKENS tokens in a row with a digit or an at sign, and gets one of KINDS
or stays outside. Features look at the whole segment (its shape, counts,
check digits and the words around it); the score of a labelling is the sum
over its segments, so the best one comes from dynamic programming over token
places with the segments' bounded length, and training from the same
recursion with sums of exponentials.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np

KINDS = ("email", "ip", "card", "phone", "secret")
MAX_TOKENS = 24
FEATURE_BITS = 12

_token = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
_anchor = re.compile(r"[0-9@]")
_hex = re.compile(r"[0-9a-f]+").fullmatch
_key = re.compile(r"[A-Z0-9]+").fullmatch


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


class Zone(NamedTuple):
    """A stretch of text around digits or at signs: token spans (places in
    the text), candidate segments as token indices, and their features."""

    tokens: list[tuple[int, int]]
    segments: list[tuple[int, int]]
    features: list[list[int]]


def zone_spans(text: str, reach: int = 48) -> list[tuple[int, int]]:
    """Stretches that hold every possible segment: ``reach`` characters around
    each digit or at sign, widened to white space, joined where they touch.
    A segment has no white space beside a word of letters only, so it can't
    reach past them but for longer unbroken runs, which are taken whole."""
    out: list[list[int]] = []
    for m in _anchor.finditer(text):
        at = m.start()
        if out and at + 1 <= out[-1][1] - reach:
            continue
        lo, hi = max(0, at - reach), min(len(text), at + 1 + reach)
        while lo > 0 and not text[lo - 1].isspace() and not (out and lo <= out[-1][1]):
            lo -= 1
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _bucket(n: int) -> str:
    return str(n) if n < 20 else "20" if n < 30 else "30" if n < 40 else "40" if n < 50 else "50"


def _features(text: str, lo: int, hi: int, before: str, glued_left: bool, glued_right: bool) -> list[int]:
    s = text[lo:hi]
    digits = "".join(c for c in s if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in s)
    at, dots, spaces = s.count("@"), s.count("."), s.count(" ")
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", s))
    names = [f"digits{_bucket(len(digits))}", f"letters{_bucket(letters)}", f"at{min(at, 2)}",
             f"dots{min(dots, 5)}", f"spaces{min(spaces, 6)}", f"first{s[0] if not s[0].isalnum() else 'x'}",
             f"last{s[-1] if not s[-1].isalnum() else 'x'}", f"glued{glued_left:d}{glued_right:d}",
             f"before{before.lower()[-12:]}", f"shape{shape[:24]}",
             f"only_digits{letters == 0:d}{len(digits) == len(s):d}"]
    if 12 <= len(digits) <= 19 and not letters:
        names.append(f"luhn{luhn(digits):d}")
        names.append("card_length")
    if dots == 3 and not letters:
        parts = s.split(".")
        names.append(f"ip{all(p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts):d}")
    if 9 <= len(digits) <= 15 and not letters:
        names.append(f"phone_length{s[0] == '+':d}")
    if at == 1 and spaces == 0:
        user, _, host = s.partition("@")
        names.append(f"mail{bool(user):d}{'.' in host.strip('.'):d}{host[-1:].isalnum():d}")
    if letters and len(digits) >= 3 and s.isalnum() and len(s) >= 12:
        names.append(f"key{bool(_hex(s)):d}{bool(_key(s)):d}{_bucket(len(s))}")
    return [zlib.crc32(n.encode()) & ((1 << FEATURE_BITS) - 1) for n in names]


def zone(text: str, lo: int, hi: int) -> Zone:
    """Tokens, candidate segments and features of text[lo:hi]."""
    tokens = [(m.start(), m.end()) for m in _token.finditer(text, lo, hi)]
    plain = [text[s:e].isalpha() or not text[s].isascii() for s, e in tokens]
    anchored = [bool(_anchor.search(text, s, e)) for s, e in tokens]
    segments, features = [], []
    for i, (s, _) in enumerate(tokens):
        if not (text[s].isalnum() or text[s] in "+(") or not text[s].isascii():
            continue
        seen = False
        for j in range(i, min(i + MAX_TOKENS, len(tokens))):
            if j > i:
                gap = tokens[j][0] - tokens[j - 1][1]
                if gap > 1 or gap and (plain[j] or plain[j - 1]) or not text[tokens[j][0]].isascii():
                    break
            seen = seen or anchored[j]
            e = tokens[j][1]
            if not seen or not text[e - 1].isalnum():
                continue
            if j + 1 < len(tokens) and tokens[j + 1][0] == e and text[e].isalnum():
                continue
            before = text[tokens[i - 2][0]:tokens[i - 1][1]] if i > 1 and not text[s - 1].isalnum() else ""
            segments.append((i, j + 1))
            features.append(_features(text, s, e, before, s > 0 and not text[s - 1].isspace(),
                                      e < len(text) and not text[e].isspace()))
    return Zone(tokens, segments, features)


def scores(z: Zone, weights: np.ndarray) -> np.ndarray:
    """Segments x kinds."""
    flat = [f for fs in z.features for f in fs]
    at = np.cumsum([0, *(len(fs) for fs in z.features[:-1])])
    return np.add.reduceat(weights[flat], at, axis=0) if flat else np.zeros((0, len(KINDS)))


def decode(z: Zone, weights: np.ndarray) -> list[tuple[int, int, str]]:
    """The best labelling: (start, end, kind) in places of the text."""
    if not z.segments:
        return []
    s = scores(z, weights)
    kind, value = s.argmax(axis=1).tolist(), s.max(axis=1).tolist()
    ending: dict[int, list[int]] = {}
    for k, (_, j) in enumerate(z.segments):
        if value[k] > 0:
            ending.setdefault(j, []).append(k)
    best, back = [0.0] * (len(z.tokens) + 1), [-1] * (len(z.tokens) + 1)
    for j in range(1, len(best)):
        best[j] = best[j - 1]
        for k in ending.get(j, ()):
            v = best[z.segments[k][0]] + value[k]
            if v > best[j]:
                best[j], back[j] = v, k
    out, j = [], len(best) - 1
    while j > 0:
        k = back[j]
        if k < 0:
            j -= 1
        else:
            i, e = z.segments[k]
            out.append((z.tokens[i][0], z.tokens[e - 1][1], KINDS[kind[k]]))
            j = i
    return out[::-1]


def gradient(z: Zone, gold: list[tuple[int, int]], weights: np.ndarray, out: np.ndarray) -> float:
    """Adds the gradient of log p(gold) to ``out``; returns log p(gold). Gold
    holds (segment index, kind index) pairs."""
    s = scores(z, weights)
    n = len(z.tokens)
    total = np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) + s.max(axis=1) if len(s) else []
    start: dict[int, list[int]] = {}
    end: dict[int, list[int]] = {}
    for k, (i, j) in enumerate(z.segments):
        start.setdefault(i, []).append(k)
        end.setdefault(j, []).append(k)
    fwd, bwd = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        fwd[j] = np.logaddexp.reduce([fwd[j - 1], *(fwd[z.segments[k][0]] + total[k] for k in end.get(j, ()))])
    for i in range(n - 1, -1, -1):
        bwd[i] = np.logaddexp.reduce([bwd[i + 1], *(bwd[z.segments[k][1]] + total[k] for k in start.get(i, ()))])
    prob = np.array([np.exp(fwd[i] + s[k] + bwd[j] - fwd[n]) for k, (i, j) in enumerate(z.segments)])
    want = np.zeros_like(s)
    for k, c in gold:
        want[k, c] = 1
    for k, fs in enumerate(z.features):
        np.add.at(out, fs, want[k] - prob[k])
    return float((s * want).sum() - fwd[n])


def train(examples: list[tuple[str, list[tuple[int, int, str]]]], *, epochs: int = 12, rate: float = 0.2,
          decay: float = 1e-3, seed: int = 5) -> np.ndarray:
    """Weights from (text, spans) examples by AdaGrad on the log-likelihood."""
    weights = np.zeros((1 << FEATURE_BITS, len(KINDS)))
    square = np.full_like(weights, 1e-6)
    zones = []
    for text, spans in examples:
        for lo, hi in zone_spans(text):
            z = zone(text, lo, hi)
            where = {(z.tokens[i][0], z.tokens[j - 1][1]): k for k, (i, j) in enumerate(z.segments)}
            gold = [(where[s, e], KINDS.index(c)) for s, e, c in spans if (s, e) in where]
            if z.segments:
                zones.append((z, gold))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(zones)):
            grad = np.zeros_like(weights)
            gradient(*zones[k], weights, grad)
            used = np.flatnonzero(grad.any(axis=1))
            g = grad[used] - decay * weights[used]
            square[used] += g * g
            weights[used] += rate * g / np.sqrt(square[used])
    return weights
