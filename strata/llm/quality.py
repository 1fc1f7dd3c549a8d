"""Document quality by classifier and hierarchical empirical Bayes.

Two logistic regressions (quality, toxicity) are fitted on a bounded sample of
labelled documents: the ``train_docs`` labels that are smallest by hash. Their
features are the presence of words picked by likelihood ratio in that sample,
known by exact 64-bit hash, and figures of the text's form. Every document's
evidence is its quality logit.

Evidence is then combined with where the document comes from. Grouped
aggregation gives each host, and each path on it, the sum of its documents'
probabilities. A host's rate is shrunk to the global one, a path's to its
host's, each by a strength found from the data (method of moments on the
group rates), so a sparse site follows its parent and a large one speaks for
itself. A document's own probability is taken out of its groups' sums first.
Its posterior log odds are its evidence, less the global prior's log odds,
plus its path's, held to ``max_shift``.

Defined cases: a null or empty text has form figures of zero and no words; a
null host or path is a group of its own; labels for absent documents and null
labels are ignored; several labels of one document count as their largest;
with labels of one class only, or none, that model answers the class's share (one
half without any) and decides nothing: a document is then kept or not by the
other model alone, and without either all documents are kept; repeated rows of a
document are scored alike and count each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches
from strata.llm.words import NOT_SPACE, find_words, grouped, powers

TRAIN_DOCS = 8192
VOCABULARY = 1024
MIN_DOCS = 8
MAX_SHIFT = 2.0
#: Rows of the training sample that the driver has as doubles at a time.
TOGETHER = 512
#: Most bytes of (host, path) groups that are broadcast, counting 64 for each
#: group's figures; more are joined by shuffle, where Spark splits hot groups.
BROADCAST_BYTES = 8 << 20

_CLASSES = np.zeros((256, 7))
_CLASSES[[*range(0x41, 0x5B)], 0] = 1
_CLASSES[[*range(0x30, 0x3A)], 1] = 1
_CLASSES[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)], 2] = 1
_CLASSES[[*b"!?"], 3] = 1
_CLASSES[[*b"*#$%&|"], 4] = 1
_CLASSES[0x0A, 5] = 1
_CLASSES[0x80:, 6] = 1


def form(texts: list[bytes], words) -> np.ndarray:
    """Figures of each text's form: shares of byte classes, mean word length,
    distinct words and repeated runs of three words, and log length."""
    out = np.zeros((len(texts), 12))
    sizes = np.diff(words.bounds)
    lengths = words.ends - words.starts
    for k, t in enumerate(texts):
        if not t:
            continue
        lo, hi = words.bounds[k], words.bounds[k + 1]
        out[k, :7] = np.bincount(np.frombuffer(t, np.uint8), minlength=256) @ _CLASSES / len(t)
        n = hi - lo
        if n:
            h = words.hashes[lo:hi]
            out[k, 7] = lengths[lo:hi].mean() / 10
            out[k, 8] = len(np.unique(h)) / n
            p = powers(0xD1342543DE82EF95, 3)
            runs = h[:-2] * p[0] + h[1:-1] * p[1] + h[2:] * p[2] if n > 2 else h
            out[k, 9] = len(np.unique(runs)) / len(runs)
            out[k, 10] = lengths[lo:hi].max() > 40
    out[:, 11] = np.log1p(sizes) / 10
    return out


def presence(words, vocabulary: np.ndarray) -> np.ndarray:
    """Texts x vocabulary: 1 where the word occurs. ``vocabulary`` is sorted."""
    out = np.zeros((len(words.bounds) - 1, len(vocabulary)), dtype=np.float32)
    if len(vocabulary) and len(words.hashes):
        at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
        hit = np.flatnonzero(vocabulary[at] == words.hashes)
        out[np.searchsorted(words.bounds, hit, side="right") - 1, at[hit]] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, figures: np.ndarray | None = None, *, decay: float = 1.0,
             steps: int = 40) -> np.ndarray:
    """Weights (the last for the constant) by Newton steps with ridge decay, of
    the columns of ``x``, of any type of number, and then of ``figures``. A
    step adds up its sums over TOGETHER rows at a time, so that no rows but
    those stand side by side as doubles."""
    figures = np.zeros((len(x), 0)) if figures is None else figures
    w = np.zeros(x.shape[1] + figures.shape[1] + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if not 0 < y.sum() < len(y):
        return w
    ridge = np.full(len(w), decay)
    ridge[-1] = 1e-6
    for _ in range(steps):
        g, h = ridge * w, np.diag(ridge)
        for lo in range(0, len(x), TOGETHER):
            some = slice(lo, lo + TOGETHER)
            rows = np.hstack([x[some], figures[some], np.ones((len(x[some]), 1))])
            p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
            g += rows.T @ (p - y[some])
            h += (rows * (p * (1 - p) + 1e-6)[:, None]).T @ rows
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """The two regressions and how to apply them to texts."""

    def __init__(self, vocabulary: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.vocabulary, self.mean, self.scale = vocabulary, mean, scale
        self.weights: dict[str, np.ndarray] = {}
        #: Models that have seen both classes; others decide nothing.
        self.decides: dict[str, bool] = {}

    def matrix(self, figures: np.ndarray, words) -> np.ndarray:
        return np.hstack([presence(words, self.vocabulary), (figures - self.mean) / self.scale])

    def logits(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        words = find_words(texts, NOT_SPACE)
        x = self.matrix(form(texts, words), words)
        return {k: np.clip(x @ w[:-1] + w[-1], -30, 30) for k, w in self.weights.items()}


def _sample(docs: DataFrame, labels: DataFrame, train_docs: int, id_col: str, text_col: str,
            label_cols: tuple[str, str]) -> list:
    """At most ``train_docs`` labelled texts. The chosen labels are broadcast:
    their number is the bound."""
    good, bad = label_cols
    some = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(good).cast("int").alias("good"),
                          F.col(bad).cast("int").alias("bad")).where("doc_id is not null")
            .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("bad").alias("bad"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.join(F.broadcast(some), "doc_id")

    def read(batches):
        import pyarrow as pa

        for ids, goods, bads, texts in grouped(batches, "doc_id", "good", "bad", "text"):
            words = find_words(texts, NOT_SPACE)
            figures = form(texts, words)
            seen = [np.unique(words.hashes[lo:hi]).view(np.int64)
                    for lo, hi in zip(words.bounds[:-1], words.bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(goods, pa.int32()), pa.array(bads, pa.int32()),
                 pa.array(list(figures), pa.list_(pa.float64())), pa.array(seen, pa.list_(pa.int64()))],
                names=["doc_id", "good", "bad", "figures", "words"])

    return found.mapInArrow(read, "doc_id long, good int, bad int, figures array<double>, words array<bigint>")


def marked(sample: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, good, bad, figures and ``held``: a bit for each word of the
    sorted vocabulary, set where the document holds it."""
    def mark(batches):
        import pyarrow as pa

        for b in batches:
            words = b.column(4)
            found = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            row = np.repeat(np.arange(len(b)), words.value_lengths().to_numpy(zero_copy_only=False))
            held = np.zeros((len(b), len(vocabulary)), dtype=bool)
            if len(vocabulary) and len(found):
                at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
                hit = vocabulary[at] == found
                held[row[hit], at[hit]] = True
            bits = pa.array([x.tobytes() for x in np.packbits(held, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], bits], names=[*b.schema.names[:4], "held"])

    return sample.select("doc_id", "good", "bad", "figures", "words").mapInArrow(
        mark, "doc_id long, good int, bad int, figures array<double>, held binary")


def fit(docs: DataFrame, labels: DataFrame, *, train_docs: int = TRAIN_DOCS, vocabulary: int = VOCABULARY,
        id_col: str = "doc_id", text_col: str = "text",
        label_cols: tuple[str, str] = ("quality", "toxic")) -> Model:
    """Both models from the bounded sample. Word statistics are aggregated by
    Spark; the driver gets the chosen words and, per sampled document, its
    figures and a bit for each of those words."""
    from strata.session import materialize

    sample = materialize(_sample(docs, labels, train_docs, id_col, text_col, label_cols), "quality-sample")
    one = [(F.col(c) == v).cast("long") for c in ("good", "bad") for v in (0, 1)]
    totals = [float(v or 0) for v in sample.agg(*(F.sum(c) for c in one)).first()]
    counts = sample.select("good", "bad", F.explode("words").alias("word")).groupBy("word").agg(
        *(F.sum(c).alias(f"n{k}") for k, c in enumerate(one))).where(
        f"n0 + n1 >= {MIN_DOCS} or n2 + n3 >= {MIN_DOCS}")
    def gain(a: str, b: str, ta: float, tb: float) -> Column:
        """Likelihood ratio of presence against class, by counts a and b."""
        n, t = F.col(a) + F.col(b), ta + tb
        part = [F.when(x > 0, x * F.log(x * F.lit(t) / (m * F.lit(k)))).otherwise(0.0) if k else F.lit(0.0)
                for x, m, k in ((F.col(a), n, ta), (F.col(b), n, tb),
                                (F.lit(ta) - F.col(a), F.lit(t) - n, ta), (F.lit(tb) - F.col(b), F.lit(t) - n, tb))]
        return sum(part[1:], part[0])
    ranked = counts.select("word", gain("n0", "n1", *totals[:2]).alias("good"), gain("n2", "n3", *totals[2:]).alias("bad"))
    chosen = {r.word for by in ("good", "bad") for r in
              ranked.orderBy(F.desc(by), "word").limit(vocabulary // 2).collect()}
    words = np.sort(np.array(sorted(chosen), dtype=np.int64).view(np.uint64))
    rows = marked(sample, words).orderBy("doc_id").collect()
    figures = np.array([r.figures for r in rows]).reshape(len(rows), -1) if rows else np.zeros((1, 12))
    model = Model(words, figures.mean(axis=0), figures.std(axis=0) + 1e-3)
    bits = np.frombuffer(b"".join(r.held for r in rows), dtype=np.uint8).reshape(len(rows), -(-len(words) // 8))
    x, figures = np.unpackbits(bits, axis=1, count=len(words)), (figures[:len(rows)] - model.mean) / model.scale
    for name, y in (("good", [r.good for r in rows]), ("bad", [r.bad for r in rows])):
        known = np.array([v is not None for v in y], dtype=bool)
        own = np.array([v > 0 for v in y if v is not None], dtype=float)
        model.weights[name] = logistic(x[known], own, figures[known])
        model.decides[name] = bool(0 < own.sum() < len(own))
    return model


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, n: str, s: str, mean: float) -> float:
    """Pseudo-documents of a group's parent, from how far group rates spread
    beyond what their sizes explain; at least 1, at most a million."""
    row = groups.where(F.col(n) > 1).agg(
        F.sum(n).alias("n"), F.count("*").alias("g"),
        F.sum(F.col(n) * (F.col(s) / F.col(n) - mean) ** 2).alias("spread")).first()
    if not row.g or row.g < 2 or not 0 < mean < 1:
        return 1e6
    within = mean * (1 - mean)
    between = (row.spread / row.g - within) / (row.n / row.g)
    return float(min(1e6, max(1.0, within / between - 1))) if between > 0 else 1e6


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, dict]:
    """(host, path) rows with their sums and strengths from rows of host, path
    and p; and the global rate with both strengths."""
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n_path"), F.sum("p").alias("s_path"))
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"))
    total = hosts.agg(F.sum("n_host").alias("n"), F.sum("s_host").alias("s")).first()
    mean = min(max((total.s or 0.0) / total.n, 1e-4), 1 - 1e-4) if total.n else 0.5
    known = {"mean": mean, "host": strength(hosts, "n_host", "s_host", mean),
             "path": strength(paths, "n_path", "s_path", mean)}
    return paths.join(hosts, F.equal_null(paths.host, hosts.host)).select(paths["*"], "n_host", "s_host"), known


def score(docs: DataFrame, labels: DataFrame, *, train_docs: int = TRAIN_DOCS, vocabulary: int = VOCABULARY,
          id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source", path: Column | str = "lang",
          label_cols: tuple[str, str] = ("quality", "toxic"), max_shift: float = MAX_SHIFT,
          min_quality: float = 0.5, max_toxic: float = 0.5, keep_columns: bool = False) -> DataFrame:
    """Per document doc_id, host, path, p_quality (classifier alone),
    host_rate, path_rate, posterior, p_toxic and kept; with ``keep_columns``
    the input's row as the struct column ``row`` besides."""
    from strata.session import materialize

    spark = docs.sparkSession
    small_batches(spark)
    fitted = fit(docs, labels, train_docs=train_docs, vocabulary=vocabulary, id_col=id_col, text_col=text_col,
                 label_cols=label_cols)
    model = spark.sparkContext.broadcast(fitted)
    columns = [F.col(id_col).cast("long").alias("doc_id"), (F.col(host) if isinstance(host, str) else host).alias("host"),
               (F.col(path) if isinstance(path, str) else path).alias("path")]
    rows = docs.select(*columns, *([F.struct("*").alias("row")] if keep_columns else []),
                       F.col(text_col).cast("string").alias("text"))

    def evaluate(batches):
        import pyarrow as pa

        for b in batches:
            good, bad = [], []
            for (texts,) in grouped([b], "text"):
                logits = model.value.logits(texts)
                good.append(logits["good"]), bad.append(logits["bad"])
            cols = [c for c in b.schema.names if c != "text"]
            out = [b.column(b.schema.get_field_index(c)) for c in cols]
            new = [np.concatenate(x) if x else np.zeros(0) for x in (good, bad)]
            yield pa.RecordBatch.from_arrays([*out, *map(pa.array, new)], names=[*cols, "z", "t"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([f for f in rows.schema.fields if f.name != "text"]
                        + [StructField("z", DoubleType()), StructField("t", DoubleType())])
    scored = materialize(rows.mapInArrow(evaluate, schema).withColumn("p", 1 / (1 + F.exp(-F.col("z")))), "quality")
    sites, known = site_posteriors(scored.select("host", "path", "p"))
    sites = sites.withColumnsRenamed({"host": "site_host", "path": "site_path"})
    name = lambda c: F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    size = sites.agg(F.sum(name("site_host") + name("site_path") + 64)).first()[0]
    if (size or 0) <= BROADCAST_BYTES:
        sites = F.broadcast(sites)
    joined = scored.join(sites, F.equal_null("host", "site_host") & F.equal_null("path", "site_path"))
    mean, mh, mp = F.lit(known["mean"]), known["host"], known["path"]
    host_rate = (F.col("s_host") - F.col("p") + mean * mh) / (F.col("n_host") - 1 + mh)
    path_rate = (F.col("s_path") - F.col("p") + F.col("host_rate") * mp) / (F.col("n_path") - 1 + mp)
    bounded = lambda c: F.least(F.greatest(c, F.lit(1e-4)), F.lit(1 - 1e-4))
    shift = F.least(F.greatest(_logit(F.col("path_rate")) - _logit(mean), F.lit(-max_shift)), F.lit(max_shift))
    return (joined.withColumn("host_rate", bounded(host_rate)).withColumn("path_rate", bounded(path_rate))
            .withColumn("posterior", 1 / (1 + F.exp(-(F.col("z") + shift))))
            .withColumn("p_toxic", 1 / (1 + F.exp(-F.col("t"))))
            .withColumn("kept", ((F.col("posterior") >= min_quality) | F.lit(not fitted.decides["good"]))
                        & ((F.col("p_toxic") < max_toxic) | F.lit(not fitted.decides["bad"])))
            .select("doc_id", "host", "path", F.col("p").alias("p_quality"), "host_rate", "path_rate", "posterior",
                    "p_toxic", "kept", *(["row"] if keep_columns else [])))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that :func:`score` keeps, as they were."""
    return score(docs, labels, keep_columns=True, **options).where("kept").select("row.*")
