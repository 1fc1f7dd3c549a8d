"""Building blocks against plain Python."""

import random
import re

import numpy as np
import pytest

from strata.llm import decontam, huffman, licenses, packing, pii, pii_model, warc
from strata.llm.bpe import Encoder
from strata.llm.elias import EliasFano
from strata.llm.neardup import intersections, shingle_sets
from strata.llm.queries import tokenizer_path
from strata.llm.words import ALNUM, NOT_SPACE, SEGMENT, find_words

ODD = ["", " ", "\n\n", "a b Ⅷ ǅ  K Å", "x.", "It's Å ́x a ,, b,. c,\n İstanbul ΣΑΣ Σ don'T <|endoftext|>x <|ENDOFTEXT|>",
       "日本語テスト naïve ß ﬁ   \x1c y\x85z 12,5 3. \x01 a", "été, Çà É́ é, 'S 'Re we'LL x' 'x. 5. a-b- -- .", "a" * 5000]


def test_encoder_equals_the_library_on_whole_texts():
    enc = Encoder(tokenizer_path())
    for end in (None, 2):
        ids, bounds = enc.encode([t.encode() for t in ODD], end=end)
        for k, t in enumerate(ODD):
            want = enc.whole(t) + ([end] if end else [])
            assert ids[bounds[k]:bounds[k + 1]].tolist() == want


def test_words_equal_regular_expressions_across_segments():
    texts = [t.encode() for t in ODD] + [b"Word wOrd " * (SEGMENT // 8)]
    for inside, pattern in ((NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = find_words(texts, inside)
        for k, t in enumerate(texts):
            want = re.findall(pattern, t.lower())
            lo, hi = found.bounds[k], found.bounds[k + 1]
            assert hi - lo == len(want)
            assert [found.word(j) for j in range(lo, min(hi, lo + 50))] == want[:50]
        assert len(set(found.hashes[found.bounds[-2]:].tolist())) == 1


@pytest.mark.parametrize("n,values", [(1, 1), (5, 2), (3000, 3), (70000, 5000)])
def test_huffman_round_trip(n, values):
    ids = np.random.default_rng(n).zipf(1.4, n).clip(1, values).astype("<u4") - 1
    lengths = huffman.code_lengths(np.bincount(ids), 14)
    used = lengths[lengths > 0].astype(float)
    assert used.max() <= 14 and (2 ** -used).sum() <= 1
    codec = huffman.Codec(lengths)
    data, checks = codec.encode(ids)
    counts = np.full(len(checks), huffman.CHECK)
    counts[-1] = n - huffman.CHECK * (len(checks) - 1)
    assert (codec.decode(data, checks.astype(np.int64), counts) == ids).all()


def test_elias_fano_access_and_successor():
    rng = np.random.default_rng(0)
    for n, below in ((1, 1), (5, 100), (1000, 2 ** 63), (5000, 6000), (3000, 2 ** 40)):
        v = np.sort(rng.integers(0, below, n, dtype=np.uint64))
        e = EliasFano.build(v, below)
        assert (e.access(np.arange(n)) == v).all()
        q = np.concatenate([v, rng.integers(0, below, 300, dtype=np.uint64)])
        at, found = e.successor(q)
        assert (found == np.isin(q, v)).all() and (at[found] == np.searchsorted(v, q[found])).all()


def test_first_fit_decreasing_is_first_fit():
    lengths = np.sort(np.random.default_rng(3).integers(1, 100, 500))[::-1]
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    free = []
    for n, b, o in zip(lengths, bins, offsets):
        k = next((j for j, f in enumerate(free) if f >= n), len(free))
        if k == len(free):
            free.append(100)
        assert (b, o) == (k, 100 - free[k])
        free[k] -= n


def test_containment_suppression_equals_all_pairs():
    rules = licenses.rules()
    rng = random.Random(4)
    for _ in range(50):
        hits = [(s, s + rng.randint(1, 8), rng.choice(rules)) for s in (rng.randint(0, 15) for _ in range(25))]
        got = {(s, e, r.priority) for s, e, r in licenses.resolve(hits)}
        want = {(s, e, r.priority) for s, e, r in hits if not any(
            (a, b, q.priority) != (s, e, r.priority) and a <= s and e <= b and q.priority >= r.priority
            for a, b, q in hits)}
        assert got == want


BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice("a.@+1 45-(9)0\nz%é") for _ in range(rng.randint(0, 60)))
        text += rng.choice(["", " 4111 1111 1111 1111", " 1.2.3.4.5.6.7.8", " x@y@z.de", " +1 (759) 555-2511"])
        want = []
        for kind, p in BASE.items():
            for m in p.finditer(text):
                d = re.sub(r"[^0-9]", "", m[0])
                if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                        or kind == "card" and 12 <= len(d) <= 19 and pii_model.luhn(d)
                        or kind == "phone" and 9 <= len(d) <= 15):
                    want.append((*m.span(), kind))
        assert pii.base_spans(text) == sorted(want, key=lambda x: (x[0], pii_model.KINDS.index(x[2]))), text


def test_best_labelling_equals_all_labellings():
    rng = np.random.default_rng(2)
    weights = rng.normal(0, 1, (1 << pii_model.FEATURE_BITS, len(pii_model.KINDS)))
    z = pii_model.zone("a1 2b-3 c@d4", 0, 12)
    s = pii_model.scores(z, weights).max(axis=1)

    def best(at):
        out = 0.0 if at >= len(z.tokens) else best(at + 1)
        return max([out, *(s[k] + best(j) for k, (i, j) in enumerate(z.segments) if i == at)])

    where = {(z.tokens[i][0], z.tokens[j - 1][1]): k for k, (i, j) in enumerate(z.segments)}
    assert sum(s[where[a, b]] for a, b, _ in pii_model.decode(z, weights)) == pytest.approx(best(0))


def test_gradient_follows_the_likelihood():
    rng = np.random.default_rng(5)
    w = rng.normal(0, 0.3, (1 << pii_model.FEATURE_BITS, len(pii_model.KINDS)))
    z = pii_model.zone("call +1 555-2511 x", 0, 18)
    g = np.zeros_like(w)
    base = pii_model.gradient(z, [(0, 3)], w, g)
    f = z.features[0][0]
    moved = w.copy()
    moved[f, 3] += 1e-5
    assert (pii_model.gradient(z, [(0, 3)], moved, np.zeros_like(w)) - base) / 1e-5 == pytest.approx(g[f, 3], abs=1e-3)


def test_window_hits_equal_brute_force():
    rng = random.Random(7)
    words = ["a", "b", "c", "d"]
    items = [(k, " ".join(rng.choices(words, k=n))) for k, n in enumerate((3, 10, 12, 5, 0))]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 2, 40, 300, 12)] + [items[2][1].upper()]
    found = find_words([t.encode() for t in texts], ALNUM)
    hits = decontam.find_hits(found, decontam.build_windows([([str(i)], t) for i, t in items], 10))
    for k, t in enumerate(texts):
        w, want = t.lower().split(), set()
        for _, item in items:
            x = item.split()
            n = min(10, len(x))
            grams = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
            want |= {j for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in grams for j in range(i, i + n)}
        got = {j for s, e in decontam.union([h[:2] for h in hits.get(k, [])]) for j in range(s, e)}
        assert got == want


def test_intersections_and_records():
    sets = shingle_sets([b"a b c d e f g", b"a b c d e f h", b"", b"a b", b"z a b c d e f g"], 5)
    got = intersections(sets)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            if i != j:
                assert got[i, j] == len(set(x.tolist()) & set(y.tolist()))
    raw = warc.record(7, "http://a.b/\nc", "é".encode(), warc.payload_digest("é".encode()), None)
    back = warc.parse(raw)
    assert (back["page_id"], back["payload"], back["payload_bytes"], back["record_type"]) == (7, "é".encode(), 2, "response")
    assert warc.url_key("http://www.Ex.org/b?z=1&a=2", 3) == "org,ex)/b?a=2&z=1 +00000000000000000003"


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s


def test_words_that_polynomials_confuse_have_ids_of_their_own():
    from strata.llm.bpe import Encoder
    from strata.llm.queries import tokenizer_path

    enc = Encoder(tokenizer_path())
    for n in (8, 16, 64, 1024, 2048):
        a = thue_morse(n)
        b = a.translate(str.maketrans("ab", "ba"))
        found = find_words([f"{a} {b} {a[:-1]} {a}".encode()], NOT_SPACE)
        assert found.hashes[0] == found.hashes[3] and len(set(found.hashes.tolist())) == 3
        for _ in range(2):                                  # from the library, then from the memo
            ids, bounds = enc.encode([a.encode(), b.encode(), f"{b} {a}.".encode()])
            for k, t in enumerate((a, b, f"{b} {a}.")):
                assert ids[bounds[k]:bounds[k + 1]].tolist() == enc.whole(t)


def test_a_full_memo_gives_the_ids_of_whole_texts(monkeypatch):
    import random

    from strata.llm import bpe
    from strata.llm.queries import tokenizer_path

    monkeypatch.setattr(bpe, "MEMO_BITS", 4)
    monkeypatch.setattr(bpe, "MEMO_IDS", 200)
    monkeypatch.setattr(bpe, "MEMO_LONG", 3)
    enc, rng = bpe.Encoder(tokenizer_path()), random.Random(1)
    pool = ["".join(rng.choice("abcxyz") for _ in range(rng.choice([1, 3, 7, 8, 9, 15, 16, 17, 40, 300]))) for _ in range(60)]
    pool += [w.upper() + rng.choice(["", ".", "!?", "-x"]) for w in pool]
    for _ in range(20):
        texts = [" ".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(5)]
        ids, bounds = enc.encode([t.encode() for t in texts])
        for k, t in enumerate(texts):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == enc.whole(t)


def detected(text):
    """Labels of a text by all rules."""
    from strata.llm.licenses import PHRASES, matcher, resolve

    m = matcher(tuple(PHRASES.items()))
    found = find_words([text.encode()], ALNUM)
    keys = m.keywords_by_text(found)
    words = [found.word(j).decode() for j in range(len(found.starts))]
    return {r.label for *_, r in resolve(m.detect(words, keys[0]))} if 0 in keys else set()


@pytest.mark.parametrize("text, label", [
    ("Released under GPL-3.0", "gpl-3.0"), ("GPLv3 code", "gpl-3.0"), ("GPL v2 or later", "gpl-2.0-or-later"),
    ("Apache 2.0 license", "apache-2.0"), ("Apache-2.0", "apache-2.0"), ("BSD 3-Clause License", "bsd-3-clause"),
    ("MPL 2.0", "mpl-2.0"), ("this is MIT licensed", "mit"), ("LGPLv2.1+", "lgpl-2.1"),
    ("licensed under the Apache 2.0 license", "apache-2.0"), ("GPLv2 only", "gpl-2.0"), ("AGPLv3", "agpl-3.0"),
    ("General Public License v3", "gpl-3.0"), ("version 2 of the GNU General Public License", "gpl-2.0"),
    ("Apache License v2", "apache-2.0"), ("two-clause BSD license", "bsd-2-clause"), ("ASL 2.0", "apache-2.0"),
    ("LGPL version 3 or later", "lgpl-3.0"), ("distributed under the terms of the MIT", "mit"), ("EPL-2.0", "epl-2.0"),
    ("EUPL v1.2", "eupl-1.2"), ("MPLv2.0", "mpl-2.0"), ("ISC licensed", "isc"), ("SSPLv1", "sspl-1.0"), ("CDDL 1.0", "cddl-1.0")])
def test_everyday_forms_are_labelled(text, label):
    assert label in detected(text) and label in detected(f"x {text}. y " * 3)


@pytest.mark.parametrize("text", [
    "the public bought 3 general books", "apache 3 helicopters", "a license mit ohne", "version 2 of the plan",
    "bsd 3 things", "the mit campus", "gpl and more", "three clause sentences", "published under the tree"])
def test_clean_words_are_not_labelled(text):
    assert not detected(text) - {"licensed"}


def test_base_phrases_equal_a_plain_count(spark):
    import random
    import re

    from strata.llm import licenses

    rng = random.Random(3)
    pool = ["cc", "by", "CC", "BY", "general", "public", "License", "all", "rights", "reserved", "é", "x", "cc-by", "all,"]
    rows = [(k, rng.choice([" ", "  ", "-", "\n"]).join(rng.choices(pool, k=rng.randint(0, 60)))) for k in range(300)]
    rows += [(900, None), (901, ""), (902, "cc by " * 50_000)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        at = [(k, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
              for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x[1] for x in at})))
        assert (r.first_word, r.last_word) == (min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert {x[1] for x in at} <= set(r.labels.split(","))


def test_contamination_in_slices_equals_one_table(spark):
    import random

    from strata.llm import decontam

    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(40)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 9, 10, 14, 30])))) for k in range(60)]
    items += [(100 + k, items[3][1]) for k in range(200)] + [(None, "only words without an id"), (5, None), (6, ""), (7, "!!")]
    docs = [(k, " ".join([word() for _ in range(30)] + rng.choice(items[:60])[1].split() + [word() for _ in range(20)]), "x", 1)
            for k in range(80)] + [(7, None, "x", 1), (8, "", "x", 1), (None, items[5][1], "x", 1), (3, "only words without an id", "x", 9)]
    d = spark.createDataFrame(docs, "doc_id long, text string, key string, n_chars long")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda df: sorted(map(str, df.collect()))
    one, many = (decontam.digest(decontam.contamination(d, b, max_bytes=m)) for m in (1 << 30, 4000))
    assert rows(one) == rows(many)
    one, many = (decontam.remove_contamination(d, b, max_bytes=m, drop_share=0.9) for m in (1 << 30, 4000))
    assert rows(one) == rows(many) and many.columns == d.columns
    none = decontam.digest(decontam.contamination(d, b.limit(0)))
    assert none.count() == d.count() and not none.where("contaminated").count()
    assert decontam.contamination(d.limit(0), b).count() == 0 and decontam.remove_contamination(d.limit(0), b).count() == 0
    assert rows(decontam.remove_contamination(d, b.limit(0))) == rows(d)


def test_equal_hashes_of_windows_are_told_apart(monkeypatch):
    from strata.llm import decontam

    monkeypatch.setattr(decontam, "window_hashes", lambda h, size: np.full(max(0, len(h) - size + 1), 7, dtype=np.uint64))
    table = decontam.build_windows([(["a"], "one two"), (["b", "c"], "three four"), (["d"], "one two")], 10)
    hits = decontam.find_hits(find_words([b"x one two y", b"three four", b"four five"], ALNUM), table)
    assert {k: [(lo, hi, sorted(i)) for lo, hi, i in v] for k, v in hits.items()} == {
        0: [(1, 3, ["a", "d"])], 1: [(0, 2, ["b", "c"])]}
