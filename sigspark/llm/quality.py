"""Quality classification by hierarchical empirical Bayes.

A logistic model (word, stem and shape features, fitted to a bounded sample of
labelled rows) gives each document's own evidence for two heads, quality and
toxic. Grouped aggregation over all documents turns that evidence into host
and path posteriors: a host is pulled towards the global rate with a strength
estimated from the spread between hosts (method of moments), and a path
towards its host. A document's final log odds are its own plus the deviation
of its path's posterior from the global rate.

Cases: a null or blank text has no words and gets the evidence of its empty
shape; null hosts or paths form no group and get the global rate; labels that
repeat for a doc_id are averaged and rounded; rows are kept one by one;
without labels of both kinds a head's evidence is the observed rate (a half
without labels); empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, table, tidy
from .contamination import words_of
from .shingles import prefix_hashes, word_hashes

#: Rows of the labelled sample, words chosen for each head, least documents of a chosen word.
SAMPLE_ROWS = 12_000
WORDS_PER_HEAD = 256
LEAST_DOCS = 3
RIDGE = 1.0
#: Bytes of the beginnings of words that are features beside the words.
STEMS = (5, 6, 7, 8)
HEADS = ("quality", "toxic")
#: Bounds of the prior strengths in rows, and the strength of a host for its paths.
STRENGTH = (1.0, 10_000.0)
PATH_STRENGTH = 20.0
KEEP_QUALITY, KEEP_TOXIC = 0.5, 0.5
N_SHAPES = 9


def shape_of(text: bytes) -> list[float]:
    """Shares of kinds of characters, repetition of lines and words, and lengths."""
    a = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(1, int(a.sum()) - int(a[32]))
    upper, lower, digit = a[65:91].sum(), a[97:123].sum(), a[48:58].sum()
    punct = a[33:127].sum() - upper - lower - digit
    lines = [x for x in text.split(b"\n") if x.strip()]
    words = text.split()
    return [
        upper / n,
        digit / n,
        punct / n,
        a[128:].sum() / n,
        len(set(lines)) / max(1, len(lines)),
        len(set(words)) / max(1, len(words)) ** 0.8,
        np.log1p(len(words)),
        np.log1p(n / max(1, len(words))),
        np.log1p(len(lines)),
    ]


def _distinct_words(text: bytes) -> np.ndarray:
    """Hashes of the different words of a text and of their beginnings, which stand for stems."""
    data = b" ".join(words_of(text))
    if not data:
        return np.zeros(0, np.int64)
    return np.unique(np.concatenate((word_hashes(data)[1], prefix_hashes(data, STEMS))).view(np.int64))


@tidy
def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = [batch.column(c).to_numpy() for c in HEADS]
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            words = _distinct_words(text or b"")
            yield pa.RecordBatch.from_arrays([pa.array(words), *(pa.array(np.full(len(words), y[i], np.int64)) for y in labels)], names=["word", *HEADS])


class Model:
    """Words, scaling and weights of both heads."""

    def __init__(self, words: np.ndarray, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.words, self.mean, self.scale, self.weights = words, mean, scale, weights

    @staticmethod
    def features(texts: list[bytes | None], words: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), N_SHAPES + len(words)), np.float32)
        for i, t in enumerate(texts):
            out[i, :N_SHAPES] = shape_of(t or b"")
            if len(words):
                found = _distinct_words(t or b"")
                at = np.minimum(np.searchsorted(words, found), len(words) - 1)
                out[i, N_SHAPES + at[words[at] == found]] = 1
        return out

    def evidence(self, texts: list[bytes | None]) -> np.ndarray:
        """Log odds of each head, bounded to +-8."""
        x = (self.features(texts, self.words) - self.mean) / self.scale
        return np.clip(x @ self.weights[1:] + self.weights[0], -8, 8)


def _newton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression; the intercept first."""
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return np.concatenate(([np.log(rate / (1 - rate))], np.zeros(x.shape[1])))
    x = np.hstack((np.ones((len(x), 1)), x)).astype(np.float64)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    penalty[0] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit to about SAMPLE_ROWS labelled rows drawn by a hash of their id; the driver gets that sample's features only."""
    bounded_batches(docs.sparkSession)
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(*(F.round(F.avg(h)).cast("long").alias(h) for h in HEADS))
    share = max(1, -(-one.count() // SAMPLE_ROWS))
    sample = F.broadcast(one.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(share)) == 0))  # about SAMPLE_ROWS rows of three numbers
    rows = materialize(docs.select("doc_id", "text").join(sample, "doc_id").select("text", *HEADS), "labelled")
    counted = rows.mapInArrow(_word_rows, "word long, quality long, toxic long").groupBy("word").agg(F.count("*").alias("n"), *(F.sum(h).alias(h) for h in HEADS)).where(f"n >= {LEAST_DOCS}")
    counted = materialize(counted, "words")
    totals = rows.agg(F.count("*"), *(F.coalesce(F.sum(h), F.lit(0)) for h in HEADS)).first()
    words: set[int] = set()
    for k, head in enumerate(HEADS):
        n, positive = float(totals[0] or 1), float(totals[k + 1])
        a, b = F.col(head), F.col("n") - F.col(head)
        c, d = positive - a, F.lit(n - positive) - b
        chi = n * (a * d - b * c) * (a * d - b * c) / (F.col("n") * (n - F.col("n") + 1e-9) * (positive * (n - positive) + 1e-9))
        words |= {r[0] for r in counted.select("word", chi.alias("chi")).orderBy(F.desc("chi"), "word").limit(WORDS_PER_HEAD).collect()}
    chosen = np.array(sorted(words), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = Model.features(batch.column("text").cast(pa.binary()).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), *(batch.column(h) for h in HEADS)], names=["x", *HEADS])

    got = rows.mapInArrow(spread, "x binary, quality long, toxic long").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(got.num_rows, N_SHAPES + len(chosen))
    order = np.lexsort(x.T[: N_SHAPES + 1]) if len(x) else np.zeros(0, np.int64)
    x = x[order]
    mean = x.mean(0) if len(x) else np.zeros(x.shape[1], np.float32)
    scale = x.std(0) + np.float32(1e-3) if len(x) else np.ones(x.shape[1], np.float32)
    scaled = (x - mean) / scale
    weights = [_newton(scaled, got.column(h).to_numpy()[order].astype(float)) for h in HEADS]
    return Model(chosen, mean, scale, np.stack(weights, 1))


@tidy
def _evidence(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = Model(*shared.value)
    for batch in batches:
        log_odds = model.evidence(batch.column("text").cast(pa.binary()).to_pylist())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(log_odds[:, 0]), pa.array(log_odds[:, 1])], names=[*names, *(f"{h}_own" for h in HEADS)])


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _chance(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def posteriors(evidence: DataFrame) -> DataFrame:
    """evidence(doc_id, host, path, quality_own, toxic_own) with ``quality_posterior`` and ``toxic_posterior``."""
    chances = [_chance(F.col(f"{h}_own")).alias(h) for h in HEADS]
    paths = evidence.where("host IS NOT NULL").select("host", "path", *chances).groupBy("host", "path").agg(F.count("*").alias("n"), *(F.sum(h).alias(h) for h in HEADS))
    paths = materialize(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *(F.sum(h).alias(f"h_{h}") for h in HEADS))
    total = evidence.agg(F.count("*"), *(F.avg(c) for c in chances)).first()
    for k, h in enumerate(HEADS):
        mean = min(max(total[k + 1] if total[0] else 0.5, 1e-6), 1 - 1e-6)
        rate = F.col(f"h_{h}") / F.col("hn")
        # the spread between hosts, less what hosts of their size would show by chance
        spread = hosts.where("hn > 1").agg(F.avg((rate - mean) * (rate - mean) - mean * (1 - mean) / F.col("hn"))).first()[0]
        strength = STRENGTH[1] if not spread or spread <= 0 else min(max(mean * (1 - mean) / spread - 1, STRENGTH[0]), STRENGTH[1])
        hosts = hosts.withColumn(f"rate_{h}", (F.col(f"h_{h}") + strength * mean) / (F.col("hn") + strength)).withColumn(f"mean_{h}", F.lit(mean))
    sites = paths.join(hosts, "host")
    shift = [(_odds((F.col(h) + PATH_STRENGTH * F.col(f"rate_{h}")) / (F.col("n") + PATH_STRENGTH)) - _odds(F.col(f"mean_{h}"))).alias(f"shift_{h}") for h in HEADS]
    sites = sites.select(F.col("host").alias("site_host"), F.col("path").alias("site_path"), *shift)
    joined = evidence.join(sites, (F.col("host") == F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")), "left")
    return joined.select(*evidence.columns, *(_chance(F.col(f"{h}_own") + F.coalesce(f"shift_{h}", F.lit(0.0))).alias(f"{h}_posterior") for h in HEADS))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, model: Model | None = None) -> DataFrame:
    """(doc_id, host, path, own evidence, posteriors, keep) for each row of docs(doc_id, text, ...).

    Texts are scored once and not shuffled; the scores are written, then
    aggregated and joined, which moves a few numbers a row.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = model or fit(docs, labels)
    shared = spark.sparkContext.broadcast((model.words, model.mean, model.scale, model.weights))
    rows = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    scored = rows.mapInArrow(lambda b: _evidence(b, shared), "doc_id long, host string, path string, quality_own double, toxic_own double")
    out = posteriors(materialize(scored, "evidence"))
    return out.withColumn("keep", (F.col("quality_posterior") >= KEEP_QUALITY) & (F.col("toxic_posterior") < KEEP_TOXIC))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no address: their host is ``source``, their path ``source/lang``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = classify(docs, table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))
    return found.select("doc_id", *(F.round(f"{h}_{k}", 6).alias(f"{h}_{k}") for h in HEADS for k in ("own", "posterior")), "keep")
