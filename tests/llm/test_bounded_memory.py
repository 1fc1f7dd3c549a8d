"""What the driver and a task hold at a time: the quality model and the trie's queries."""

import tracemalloc

import numpy as np
import pyarrow as pa

from strata.llm import lm, quality
from strata.llm.words import NOT_SPACE, find_words


def peak_mb(job) -> float:
    tracemalloc.start()
    try:
        job()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_the_regression_makes_no_wide_copy_of_its_rows():
    rng = np.random.default_rng(1)
    x = (rng.random((6000, 300)) < 0.1).astype(np.float32)
    y = (x[:, :40].sum(axis=1) + rng.normal(size=len(x)) > 4).astype(float)
    found = []
    assert peak_mb(lambda: found.append(quality.logistic(x, y))) < x.size * 8 / 1e6
    wide = np.hstack([x, np.ones((len(x), 1))])
    p = 1 / (1 + np.exp(-wide @ found[0]))
    assert np.abs(wide.T @ (p - y) + np.append(found[0][:-1], 1e-6 * found[0][-1])).max() < 1e-4
    apart = quality.logistic(x[:, :200].astype(np.uint8), y, x[:, 200:].astype(float))
    assert np.allclose(apart, found[0], atol=1e-9)


def test_the_driver_gets_a_bit_for_each_word_of_the_vocabulary(spark):
    texts = ["one two three", "", "three three four", None, "five"]
    hashes = lambda t: find_words([t.encode()], NOT_SPACE).hashes
    rows = [(k, 1, None, [float(k)], np.unique(hashes(t or "")).view(np.int64).tolist()) for k, t in enumerate(texts)]
    sample = spark.createDataFrame(rows, "doc_id long, good int, bad int, figures array<double>, words array<bigint>")
    vocabulary = np.sort(hashes("one two three six seven eight nine ten eleven"))
    got = quality.marked(sample, vocabulary).orderBy("doc_id").collect()
    want = quality.presence(find_words([(t or "").encode() for t in texts], NOT_SPACE), vocabulary)
    assert [(r.doc_id, r.good, r.bad, r.figures) for r in got] == [(k, 1, None, [float(k)]) for k in range(5)]
    bits = np.array([np.unpackbits(np.frombuffer(r.held, np.uint8), count=9) for r in got])
    assert np.array_equal(bits, want)
    assert [bytes(r.held) for r in quality.marked(sample, vocabulary[:0]).collect()] == [b""] * 5


class Caught:
    """Stands for the rows, to run a task's function here."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        self.run = run
        return self


def test_a_task_scores_its_texts_in_bounded_memory(spark):
    rng = np.random.default_rng(2)
    words = np.array([f"w{k:05d}" for k in range(20000)])
    texts = [" ".join(words[rng.zipf(1.3, 4000) % len(words)]) for _ in range(320)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:40])], "doc_id long, text string")
    run = lm.score(Caught(), lm.train(rows)).run
    batch = pa.record_batch({"doc_id": range(len(texts)), "held_out": [False] * len(texts), "text": texts})
    assert sum(map(len, texts)) > lm.TOGETHER
    run(iter([batch.slice(0, 10)])).__next__()           # tables that are kept are made
    scored = []
    assert peak_mb(lambda: scored.extend(run(iter([batch])))) < 190
    parts = pa.Table.from_batches(scored)
    alone = pa.Table.from_batches([b for k in (0, 7, 319) for b in run(iter([batch.slice(k, 1)]))])
    assert parts.num_rows == len(texts) and parts.take([0, 7, 319]).equals(alone)


def test_counted_and_distinct_equal_numpys():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        keys = rng.integers(0, 300, n).astype(np.uint64)
        want, back, count = np.unique(keys, return_inverse=True, return_counts=True)
        got = lm.distinct(keys)
        assert np.array_equal(got[0], want) and np.array_equal(got[1], back)
        held = [keys[: n // 2], keys[n // 2:]]
        got = lm.counted(held)
        assert not held and np.array_equal(got[0], want) and np.array_equal(got[1], count)
