"""Operators on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import zlib

import numpy as np
import pytest

from strata.llm import decontam, fingerprint, huffman, licenses, lm, neardup, packing, pii, quality, warc
from strata.llm.queries import tokenizer_path

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(6000))
TEXTS = [(1, "The quick brown fox jumps over the lazy dog again and again today"),
         (2, "The quick brown fox jumps over the lazy dog again and again today"),
         (3, None), (4, ""), (5, LONG), (6, LONG + " one more"), (7, "licensed under cc by 4.0 all rights reserved"),
         (8, "mail a.b@c.org or +1 (759) 555-2511 or 10.0.0.1"), (8, "mail a.b@c.org or +1 (759) 555-2511 or 10.0.0.1"),
         (9, "a b"), (None, "no id here at all")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, -1.0, "x") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, labels string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    got = huffman.read(spark, str(tmp_path), huffman.write(docs, str(tmp_path), tokenizer_path())).collect()
    from tokenizers import Tokenizer
    tok, start = Tokenizer.from_file(tokenizer_path()), 0
    want = []
    for i, t in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: (r[1],)
    assert sorted((tuple(r) for r in got), key=key) == want
    other = str(tmp_path / "none")
    assert huffman.read(spark, other, huffman.write(empty, other, tokenizer_path())).count() == 0


def test_packing_covers_every_id_once(docs, empty):
    rows = packing.pack(docs, tokenizer_path(), size=64, group_pieces=20).toPandas()
    for _, s in rows.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == (s.length.cumsum() - s.length).tolist() and s.length.sum() <= 64
    assert rows.length.sum() == rows[rows.start == 0].doc_tokens.sum()
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_scores_follow_the_base(docs, empty):
    got = lm.score_documents(docs).toPandas()
    assert len(got) == len(TEXTS) and (got.score <= 0).all()
    assert got.set_index("doc_id").loc[4].n_tokens == 1
    words = [t for i, t in TEXTS if i is None or zlib.crc32(str(i).encode()) % 10]
    assert set(got.train_tokens) == {sum(len((t or "").split()) + 1 for t in words)}
    assert lm.score_documents(empty).count() == 0


def test_license_rows(docs, empty):
    r = {x.doc_id: x for x in licenses.scan(docs).collect()}
    assert (r[7].n_words, r[7].n_base, r[7].first_word, r[7].last_word) == (9, 2, 2, 6)
    assert r[7].base_labels == "cc-by,reserved" and {"cc-by", "reserved"} <= set(r[7].labels.split(","))
    assert (r[3].n_words, r[3].labels, r[3].score, r[3].first_word) == (0, "", 0.0, None)
    assert licenses.scan(empty).count() == 0


def test_pii_rows_and_redaction(docs, empty):
    r = {x.doc_id: x for x in pii.find(docs).collect()}
    spans = "email:5:14,phone:18:35,ip:39:47"
    assert r[8].base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and set(spans.split(",")) <= set(r[8].spans.split(","))
    assert r[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    new = pii.redact(docs)
    assert new.columns == docs.columns
    assert {x.text for x in new.where("doc_id = 8").collect()} == {"mail <email> or <phone> or <ip>"}
    assert new.where("doc_id = 3").first().text is None and pii.redact(empty).count() == 0


def test_archive_round_trip(spark, tmp_path):
    html = {1: "<p>é</p>", 2: "<p>é</p>", 3: None, 4: "", 5: "x" * 100_000, 6: "<p>é</p>"}
    pages = spark.createDataFrame([(k, f"http://a{k % 2}.org/p", v, "clash") for k, v in html.items()],
                                  "page_id long, url string, html string, sha string")
    got = {r.page_id: r for r in warc.archive(pages, str(tmp_path)).collect()}
    for k, v in html.items():
        raw = (v or "").encode()
        last = max(j for j, x in html.items() if (x or "").encode() == raw)
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), warc.payload_digest(raw))
        assert (got[k].record_type, got[k].refers_to) == (("response", None) if k == last else ("revisit", last))
    assert warc.read_back(spark, str(tmp_path), [warc.url_key("http://a1.org/p", 5)])[0]["payload"] == b"x" * 100_000
    none = str(tmp_path / "none")
    assert warc.archive(pages.limit(0), none).count() == 0


def test_components_equal_brute_force(spark, docs, empty):
    import random

    rng = random.Random(3)
    base = [f"t{i}" for i in range(60)]
    rows = list(TEXTS[:7])
    for i in range(100, 190):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            for i, w in ((i, (t or "").lower().split()) for i, t in rows)}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for leaf in (256, 16):
        got = neardup.near_duplicates(frame, leaf=leaf).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), root(i)) for i, s in sets.items()}


def test_contaminated_spans_go(spark, docs):
    bench = spark.createDataFrame([(1, "jumps over the lazy dog"), (1, "JUMPS over the lazy dog"), (2, None)],
                                  "item_id long, text string")
    r = {x.doc_id: x for x in decontam.digest(decontam.contamination(docs, bench)).collect()}
    assert (r[1].n_words, r[1].n_hit, r[1].n_items, r[1].contaminated) == (13, 5, 1, True)
    assert (r[3].n_words, r[3].items_sha256) == (0, hashlib.sha256(b"").hexdigest())
    sliced = {tuple(x) for x in decontam.digest(decontam.contamination(docs, bench, max_bytes=90)).collect()}
    assert sliced == {tuple(x) for x in decontam.digest(decontam.contamination(docs, bench)).collect()}
    new = decontam.remove_contamination(docs, bench)
    assert new.columns == docs.columns and new.count() == len(TEXTS)
    assert new.where("doc_id = 1").first().text == "The quick brown fox  again and again today"


def test_quality_keeps_good(spark):
    good, junk = "the river runs past the old mill and on", "$$$ ### *** &&& %%% !!! $$$"
    rows = [(i, (good if i % 3 else junk) + f" n{i}", f"s{i % 2}", "en" if i % 5 else None) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    r = quality.score(docs, labels).collect()
    assert len(r) == 120 and all(x.kept == (x.doc_id % 3 > 0) for x in r)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 80


def test_fingerprints(docs, empty):
    r = fingerprint.edited_report(docs).toPandas()
    assert len(r) == len(TEXTS)
    by = r.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    order = sorted((x for x in TEXTS), key=lambda x: (x[0] is not None, x[0] or 0))
    want = []
    for (i, t), (_, n) in zip(order, [*order[1:], order[0]]):
        t, n = t or "", n or ""
        q = len(t) // 4
        want.append((i or -1, hashlib.sha256((t[:len(t) - q] + n[:q]).encode()).hexdigest()))
    assert sorted(zip(r.doc_id.fillna(-1).astype(int), r.edited_sha256)) == sorted(want)
    assert by.loc[1].fingerprint == by.loc[2].fingerprint and by.loc[1].near_next == 1.0
    assert by.loc[5].near_next > 0.9 and by.loc[6].near_next == 0.0
    assert fingerprint.edited_report(empty).count() == 0
