"""The quality stage against a plain empirical Bayes, without labels, and the pipeline."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import packing, quality
from strata.llm.queries import tokenizer_path

GOOD, JUNK = "the river runs past the old mill and on", "$$$ ### *** &&& %%% !!! $$$"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, (GOOD if i % 3 else JUNK) + f" n{i}", f"s{i % 7}" if i % 11 else None, "en" if i % 5 else None, "clash", 0.5)
            for i in range(240)]
    rows += [(500, None, "lone", "en", "x", 1.0), (501, "", "s1", "de", "x", 1.0), (7, GOOD + " n7", "s0", "en", "x", 1.0),
             (None, GOOD, "s1", "en", "x", 1.0), (502, GOOD * 3000, "s1", "en", "x", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, host string, p double")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def plain_strength(groups, mean):
    some = [(n, s) for n, s in groups if n > 1]
    if len(some) < 2:
        return 1e6
    within = mean * (1 - mean)
    spread = sum(n * (s / n - mean) ** 2 for n, s in some) / len(some)
    between = (spread - within) / (sum(n for n, _ in some) / len(some))
    return min(1e6, max(1.0, within / between - 1)) if between > 0 else 1e6


def test_rates_and_posteriors_equal_a_plain_empirical_bayes(spark, docs):
    labels = labels_of(spark, [(i, int(i % 3 > 0), int(i % 9 == 0)) for i in range(100)] + [(3, None, None), (9999, 1, 1), (3, 0, 0)])
    rows = quality.score(docs, labels).collect()
    assert len(rows) == docs.count()
    path, host = defaultdict(list), defaultdict(list)
    for r in rows:
        path[r.host, r.path].append(r.p_quality)
        host[r.host].append(r.p_quality)
    mean = np.mean([r.p_quality for r in rows])
    mh = plain_strength([(len(v), sum(v)) for v in host.values()], mean)
    mp = plain_strength([(len(v), sum(v)) for v in path.values()], mean)
    logit = lambda p: math.log(p / (1 - p))
    clip = lambda p: min(max(p, 1e-4), 1 - 1e-4)
    for r in rows:
        a, b = host[r.host], path[r.host, r.path]
        at_host = (sum(a) - r.p_quality + mean * mh) / (len(a) - 1 + mh)
        at_path = (sum(b) - r.p_quality + at_host * mp) / (len(b) - 1 + mp)
        assert r.host_rate == pytest.approx(clip(at_host), abs=1e-9)
        shift = min(max(logit(clip(at_path)) - logit(mean), -quality.MAX_SHIFT), quality.MAX_SHIFT)
        assert r.path_rate == pytest.approx(clip(at_path), abs=1e-9)
        assert r.posterior == pytest.approx(1 / (1 + math.exp(-(logit(r.p_quality) + shift))), abs=1e-6)
        assert r.kept == (r.posterior >= 0.5 and r.p_toxic < 0.5)


@pytest.mark.parametrize("rows", [[], [(i, None, None) for i in range(50)], [(i, 1, None) for i in range(50)],
                                  [(i, 0, 1) for i in range(50)]])
def test_a_model_without_both_classes_decides_nothing(spark, docs, rows):
    kept = quality.keep_good(docs, labels_of(spark, rows))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_one_side_alone_decides(spark, docs):
    only = quality.score(docs, labels_of(spark, [(i, int(i % 3 > 0), None) for i in range(100)])).collect()
    assert all(r.kept == (r.posterior >= 0.5) for r in only) and len({r.kept for r in only}) == 2
    assert quality.score(docs.limit(0), labels_of(spark, [(1, 1, 0), (2, 0, 1)])).count() == 0


def test_large_tables_of_sites_are_joined_by_shuffle(spark, docs, monkeypatch):
    labels = labels_of(spark, [(i, int(i % 3 > 0), 0) for i in range(100)])
    order = lambda df: sorted(map(str, df.collect()))
    want = order(quality.score(docs, labels))
    monkeypatch.setattr(quality, "BROADCAST_BYTES", 10)
    assert order(quality.score(docs, labels)) == want


def run_pipeline(spark, folder, docs, labels, bench):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_pipeline_writes_the_ids_of_what_it_keeps(spark, tmp_path):
    rows = [(i, f"{GOOD} number {i} " + " ".join(f"w{i}x{k}" for k in range(30)), "en", "s", 9) for i in range(20)]
    rows += [(100, rows[3][1], "en", "s", 9), (101, None, "en", None, None), (102, "", None, "s", 0),
             (103, "mail a.b@c.org to me and to nobody else in the world", "en", "s", 1),
             (104, "one two three four five six seven eight nine ten " + GOOD + " and then on to the sea", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    out = run_pipeline(spark, tmp_path / "a", docs, labels_of(spark, []), bench).collect()
    ids = {r.doc_id for r in out}
    assert ids == ({r[0] for r in rows} - {100})              # the copy goes; nothing else does, without labels
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    by = defaultdict(list)
    for r in out:
        raw = np.frombuffer(r.ids, dtype="<u2").astype("<u4")
        assert len(raw) == r.length and zlib.crc32(raw.tobytes()) == r.ids_crc32
        by[r.doc_id] += [(r.start, raw.tolist())]
    text = lambda i: tok.encode(rows[i][1], add_special_tokens=False).ids + [2]
    assert sum((p for _, p in sorted(by[5])), []) == text(5)
    whole = sum((p for _, p in sorted(by[103])), [])
    assert whole == tok.encode("mail <email> to me and to nobody else in the world", add_special_tokens=False).ids + [2]
    left = tok.decode(sum((p for _, p in sorted(by[104])), []))
    assert "seven" not in left and "river" in left
    empty = run_pipeline(spark, tmp_path / "b", docs.limit(0), labels_of(spark, []), bench.limit(0))
    assert empty.count() == 0


def test_pieces_of_a_packing_equal_whole_texts(spark, docs):
    rows = packing.pack(docs, tokenizer_path(), size=64, group_pieces=50, with_ids=True).collect()
    plain = packing.pack(docs, tokenizer_path(), size=64, group_pieces=50)
    assert "ids" not in plain.columns and plain.count() == len(rows)
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    want = {(r.doc_id, r.text): tok.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    crc = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.ids_crc32, r.doc_tokens) for r in rows)
    assert crc == sorted((i is not None, i or 0, k, zlib.crc32(np.array(ids[k:k + 64], dtype="<u4").tobytes()), len(ids))
                         for (i, t), n in [((r.doc_id, r.text), 1) for r in docs.collect()]
                         for ids in [want[i, t]] for k in range(0, len(ids), 64))
    assert all(zlib.crc32(np.frombuffer(r.ids, dtype="<u2").astype("<u4").tobytes()) == r.ids_crc32 for r in rows)
