"""Cases in which an operator did less than its whole job."""

import zlib
from collections import Counter

import numpy as np

from strata.llm import lm


def _plain_scores(rows, discount=lm.DISCOUNT, add=lm.ADD):
    """log10 of each text's trigram model in dictionaries, every n-gram counted."""
    texts = {i: (t or "").split() + [None] for i, t in rows}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    counts = Counter()
    for i, w in texts.items():
        if i not in held:
            counts.update(tuple(w[k:k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1))
    total = sum(c for g, c in counts.items() if len(g) == 1)
    distinct = sum(len(g) == 1 for g in counts)
    follow = Counter(g[:-1] for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + add) / (total + add * (distinct + 1))
        if not follow[gram[:-1]]:
            return p(gram[1:])
        c = counts[gram[:-1]]
        return max(counts[gram] - discount, 0) / c + discount * follow[gram[:-1]] / c * p(gram[1:])

    return {i: sum(np.log10(p(tuple(w[max(0, k - 2):k + 1]))) for k in range(len(w))) for i, w in texts.items()}


def test_ngrams_seen_once_are_in_the_trie(spark):
    import random

    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("xyz") for _ in range(rng.randint(0, 40))))
            for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = _plain_scores(rows)
    least = lm.LEAST
    try:
        for lm.LEAST in (least, 50):                     # one range of n-grams, and parents cut by ranges
            for r in lm.score_documents(frame).collect():
                assert abs(r.score - want[r.doc_id]) <= r.n_tokens / 32 + 1e-9
    finally:
        lm.LEAST = least


def test_codes_reach_the_rarest_words_of_the_commonest_contexts(tmp_path):
    context, rare = 1_600_000_000, 40_000
    n = np.append(np.ones(rare, dtype=np.int64), context - rare)
    own = (n - lm.DISCOUNT) / context
    book = lm.codebook((1 - lm.DISCOUNT) / context)
    arrays = lm.level_arrays(np.full(rare + 1, 7), np.arange(rare + 1), n, np.full(rare + 1, context), lm.DISCOUNT, book)
    size = lm.write_arrays(str(tmp_path), "level", arrays)
    grams = lm.Grams(str(tmp_path), [((7, 0), "level", size, 0, rare + 1)])
    rank, got = grams.seek(np.full(rare + 2, 7), np.arange(rare + 2))
    assert (rank[:-1] == np.arange(rare + 1)).all() and (rank[-1], got[-1]) == (-1, 0)
    assert np.abs(np.log10(got[:-1] / own)).max() < 0.5 * np.log10(1 / book[-1]) / 255 + 1e-12 < 0.02
    left = lm.left_over(np.array([context - 0.75, context - lm.DISCOUNT * rare]), np.array([context] * 2))
    assert np.abs(np.log10(book[lm.quantise(left, book)] * context / [0.75, lm.DISCOUNT * rare])).max() < 0.02


def test_texts_without_spaces_and_short_texts_have_order(spark):
    import random

    from pyspark.sql import functions as F

    from strata.llm import fingerprint

    rng = random.Random(2)
    kana = "".join(chr(rng.randrange(0x3042, 0x3090)) for _ in range(400))
    token = "".join(rng.choice("abcdefghijklmnop0123456789") for _ in range(400))
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    lines = "\n".join(word() for _ in range(400))
    edit = lambda t: t[:len(t) * 7 // 8] + "".join(rng.sample(t, len(t) // 8))
    few = [word() for _ in range(24)]
    pairs = [(t, edit(t)) for t in (kana, token)] + [(lines, "\t".join(lines.split("\n")[:350] + ["x"] * 50)),
                                                     (" ".join(few), " ".join(few[12:] + few[:12])), ("a b", "a b")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    df = fingerprint.add_fingerprint(fingerprint.add_fingerprint(df, "a", "fa"), "b", "fb")
    r = {x.i: x for x in df.withColumn("near", fingerprint.likeness("fa", "fb")).withColumn(
        "entries", F.size(F.array_distinct("fa"))).collect()}
    assert all(0.3 < r[k].near < 1 for k in (0, 1, 2)), r
    assert all(None not in r[k].fa for k in r) and r[4].near == 1.0
    # 20 of the 22 runs stay when the halves change places, but about half of the pairs change their order
    assert 0.15 < r[3].near < 0.75 and r[3].entries > 6


def _alternatives(tree):
    """Texts of a parsed pattern: every branch, and repeats at their least and one more."""
    import itertools

    out = [""]
    for op, av in tree:
        kind = str(op)
        if kind == "LITERAL":
            some = [chr(av)]
        elif kind == "IN":
            some = [chr(a) for k, a in av if str(k) == "LITERAL"] or ["2"]
        elif kind == "MAX_REPEAT":
            some = ["".join(p) for n in {av[0], min(int(av[1]), av[0] + 1)}
                    for p in itertools.product(_alternatives(av[2]), repeat=n)]
        elif kind == "SUBPATTERN":
            some = _alternatives(av[3])
        elif kind == "BRANCH":
            some = [x for b in av[1] for x in _alternatives(b)]
        else:
            assert kind in ("ASSERT", "ASSERT_NOT")
            some = [""]
        out = [a + b for a in out for b in some]
    return out


def test_each_alternative_of_a_licence_rule_holds_a_keyword(spark):
    import re._parser as parser

    from strata.llm import licenses
    from strata.llm.license_rules import rules

    for r in rules():
        for t in _alternatives(parser.parse(r.pattern.pattern)):
            if r.pattern.fullmatch(t):
                assert r.keywords & set(t.split()), (r.label, t)
    texts = {1: "Do What The Fuck You Want To Public License", 2: "the beer ware license", 3: "see http://unlicense.org",
             4: "see wtfpl.net"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert got == {1: "wtfpl", 2: "beerware", 3: "unlicense", 4: "wtfpl"}
