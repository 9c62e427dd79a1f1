"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the text's character
trigrams, the declared language (a document's ``lang`` or a page's markup), the
address suffix, and a prior for the host. The host priors are smoothed twice,
hosts towards their parent (the registered domain) and parents towards the
whole corpus; they and the reliability of declarations and suffixes come from
grouped aggregations over all rows, with the text-only decision as the label.
Rows fall into two folds by a hash of their text, so copies share one; the
text of a row is scored by the model fitted to the other fold, so a
declaration is not judged by a model that was fitted to it.

The languages are counted over all rows: each with ``LEAST_ROWS`` rows of text
or more has a class. The model's table has ``MODEL_CELLS`` cells however many
there are: beyond 64 languages the trigrams share buckets. The text model is
fitted to a bounded sample (``SAMPLE_ROWS``, in equal parts by language) of rows
with a declared language; everything else covers all rows.

Cases: a language with fewer than ``LEAST_ROWS`` sampled rows in one fold is
fitted to both for the other; a text without a letter has no text evidence; a row without any text
evidence gets ``und`` and is rejected; null or unknown declarations, suffixes
and hosts say nothing; a declaration of fewer than ``LEAST_ROWS`` rows is
unknown; a declared column of more than ``MOST_LANGUAGES`` values of ``LEAST_ROWS``
rows does not hold languages: rows that declare one beyond the commonest are
``und`` and rejected; very long texts are scored in blocks; rows are kept one by one; with no
language of ``LEAST_ROWS`` rows every text is ``und``; an empty table gives no rows; extra columns are kept, those
named like the results are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import bounded_batches, in_worker, materialize, small_enough, table, tidy, without

#: Rows of the sample that the text model is fitted to, and least rows of a language in the whole table.
SAMPLE_ROWS = 8000
LEAST_ROWS = 5
#: Bits of a trigram's bucket, and buckets times languages, of which there are at most the next (many times those there are).
BUCKET_BITS = 16
MODEL_CELLS = 1 << 22
MOST_LANGUAGES = 1 << 12
#: Overlapping trigrams are not independent: their log likelihood counts for a third.
TEMPER = 1 / 3
#: Pseudo-counts of a parent for its hosts, of the corpus for parents, and of a declaration.
HOST_WEIGHT, PARENT_WEIGHT, CUE_WEIGHT = 20.0, 50.0, 10.0
#: Least posterior to keep a row.
LEAST_POSTERIOR = 0.5
#: Hosts, declarations or suffixes up to which their table is broadcast.
BROADCAST_ROWS = 200_000
#: Bytes that count as text: letters of ASCII and all of other scripts; case is dropped, the rest is a space.
_LETTERS = bytes(c | 32 if 65 <= c <= 90 or 97 <= c <= 122 else c if c >= 128 else 32 for c in range(256))
#: A character that ``_LETTERS`` keeps.
_LETTER = r"[A-Za-z]|[^\x00-\x7F]"
_BLOCK = 1 << 20
#: Trigrams whose weights are added one by one.
_FEW = 1 << 13
#: Columns that the operator makes, the last for its own use.
OWN = ("lang_id", "lang_posterior", "lang_text", "lang_keep", "_declared", "_suffix", "_host", "_parent", "_ll", "_log", "_prior", "_say_declared", "_say_suffix", "_no_class", "_fold")


def bits_for(languages: int) -> int:
    """Bits of a trigram's bucket that keep a table of so many languages within MODEL_CELLS."""
    return min(BUCKET_BITS, (MODEL_CELLS // max(1, languages)).bit_length() - 1)


def trigram_buckets(data: bytes, bits: int = BUCKET_BITS) -> np.ndarray:
    """Hash bucket of each byte trigram of the letters in data that is not all spaces."""
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.int64)
    code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - bits))[code != 0x202020].astype(np.int64)


def fold_of(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(5), text), F.lit(2)).cast("int")


@tidy
def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, int], np.ndarray] = {}
    rows: dict[tuple[str, int], int] = {}
    for batch in batches:
        for text, *key in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data = b" " + (text or b"").translate(_LETTERS) + b" "
            held = counts.setdefault(tuple(key), np.zeros(1 << bits, np.int64))
            for at in range(0, len(data), _BLOCK):
                held += np.bincount(trigram_buckets(data[at : at + _BLOCK + 2], bits), minlength=len(held))
            rows[tuple(key)] = rows.get(tuple(key), 0) + 1
    for (lang, fold), held in counts.items():
        at = np.flatnonzero(held)
        n = len(at) + 1
        yield pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array(np.full(n, fold, np.int32)), pa.array(np.append(at, -1)), pa.array(np.append(held[at], rows[lang, fold]))], names=["lang", "fold", "bucket", "n"])


class TextModel:
    """Log likelihood of each trigram bucket under each language, for the texts of each fold."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    @staticmethod
    def fit(docs: DataFrame, text: str, declared: str, seed: int = 17) -> TextModel:
        """Naive Bayes over at most about SAMPLE_ROWS whole texts with a declared language, drawn by a hash of the row, in equal parts by language."""
        says = F.col(declared).isNotNull() & (F.length(declared) > 0) & F.col(text).cast("string").rlike(_LETTER)
        labelled = docs.where(says).select(text, declared, F.xxhash64(F.lit(seed), *docs.columns).alias("_draw"))
        counted = labelled.groupBy(declared).agg(F.count("*").alias("n"), F.min("_draw").alias("least"))
        common = {r[0]: (r[1], r[2]) for r in counted.where(f"n >= {LEAST_ROWS}").orderBy(F.desc("n"), declared).limit(MOST_LANGUAGES).collect()}
        if not common:
            return TextModel([], np.zeros((2, 1 << BUCKET_BITS, 0), np.float32))
        part, bits = max(1, SAMPLE_ROWS // len(common)), bits_for(len(common))
        # the row of the least draw as well, so that no language is left without one
        known = docs.sparkSession.createDataFrame([(lang, n, least) for lang, (n, least) in common.items()], "_lang string, _n long, _least long")
        drawn = labelled.join(F.broadcast(known), F.col(declared) == F.col("_lang")).where((F.pmod("_draw", "_n") < part) | (F.col("_draw") == F.col("_least")))
        sample = drawn.select(text, declared, fold_of(F.col(text)).alias("fold"))
        counted = sample.mapInArrow(lambda b: _count(b, bits), "lang string, fold int, bucket long, n long")
        rows = counted.groupBy("lang", "fold", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most 2 * (MODEL_CELLS + languages)
        languages = sorted(common)
        place = {x: i for i, x in enumerate(languages)}
        counts = np.zeros((2, (1 << bits) + 1, len(languages)))  # the last row holds the numbers of texts
        lang = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
        counts[rows.column("fold").to_numpy(), rows.column("bucket").to_numpy(), lang] = rows.column("n").to_numpy()
        other = np.where(counts[::-1, -1:] >= LEAST_ROWS, counts[::-1], counts.sum(0))[:, :-1]
        p = (other + 0.1) / (other.sum(1, keepdims=True) + 0.1 * other.shape[1])
        return TextModel(languages, (TEMPER * np.log(p)).astype(np.float32))

    def score(self, texts: list[bytes | None], folds: list[int]) -> list[list[float] | None]:
        out = []
        bits = self.weights.shape[1].bit_length() - 1
        for t, fold in zip(texts, folds, strict=True):
            data = b" " + (t or b"").translate(_LETTERS) + b" "
            total, any_ = np.zeros(len(self.languages)), False
            if not data.isspace() and self.languages:
                for at in range(0, len(data), _BLOCK):
                    hits = trigram_buckets(data[at : at + _BLOCK + 2], bits)
                    any_ = any_ or bool(len(hits))
                    if len(hits) <= _FEW:
                        total += self.weights[fold][hits].sum(0, dtype=np.float64)
                    else:  # no more rows than buckets
                        hits, n = np.unique(hits, return_counts=True)
                        total += n @ self.weights[fold][hits].astype(np.float64)
            out.append((total - total.max()).tolist() if any_ else None)
        return out


class _Shared:
    """The model as a broadcast of bounded size, kept by each worker."""

    def __init__(self, spark: SparkSession, model: TextModel):
        self.broadcast, self.ident = spark.sparkContext.broadcast((model.languages, model.weights)), uuid.uuid4().hex

    def get(self) -> TextModel:
        return in_worker(self.ident, lambda: TextModel(*self.broadcast.value))


@tidy
def _score(batches: Iterator[pa.RecordBatch], shared: _Shared, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = shared.get().score(batch.column(text).cast(pa.binary()).to_pylist(), batch.column("_fold").to_pylist())
        kept = [n for n in batch.schema.names if n != "_fold"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(scores, pa.list_(pa.float64()))], names=[*kept, "_ll"])


def text_scores(docs: DataFrame, shared: _Shared, text: str) -> DataFrame:
    """docs with ``_ll``: log likelihood by language relative to the best, null without evidence."""
    schema = StructType([*docs.schema.fields, StructField("_ll", ArrayType(DoubleType()))])
    return docs.select("*", fold_of(F.col(text)).alias("_fold")).mapInArrow(lambda b: _score(b, shared, text), schema)


def _best(scores: Column) -> Column:
    return F.array_position(scores, F.array_max(scores)).cast("int")


def _by_language(counted: DataFrame, key: str, k: int) -> DataFrame:
    """(key, ns): for each value of key its rows by language, as an array."""
    pairs = counted.where(F.col(key).isNotNull()).groupBy(key, "_best").agg(F.sum("n").alias("n"))
    held = pairs.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_best", "n"))).alias("m"))
    return held.select(key, F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("ns"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def _pulled(weight: float, base: Column) -> Column:
    """Language shares of ``ns``, pulled towards base with so many pseudo-rows."""
    return F.transform(F.arrays_zip(F.col("ns").alias("n"), base.alias("b")), lambda z: (z["n"] + weight * z["b"]) / (F.col("total") + weight))


def _shares(counted: DataFrame, key: str, k: int, weight: float, base: Column) -> DataFrame:
    """(key, n, p): for each value of key its rows and the language shares, pulled towards ``base`` with ``weight`` pseudo-rows."""
    sums = _by_language(counted, key, k).withColumn("total", _sum(F.col("ns")))
    return sums.select(key, F.col("total").alias("n"), _pulled(weight, base).alias("p"))


def identify(docs: DataFrame, text: str = "text", declared: Column | None = None, suffix: Column | None = None, host: Column | None = None, parent: Column | None = None, model: TextModel | None = None) -> DataFrame:
    """docs with ``lang_id``, ``lang_posterior``, ``lang_text`` (the text-only decision) and ``lang_keep``.

    Scores are made twice, once for the aggregations and once for the result:
    texts are neither shuffled nor written. The priors' tables have a row for
    each host, declaration or suffix; hosts are broadcast only if counted and
    few, else joined by a shuffle that Spark can split.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = without(docs, OWN)
    none = F.lit(None).cast("string")
    cues = {"_declared": declared if declared is not None else none, "_suffix": suffix if suffix is not None else none, "_host": host if host is not None else none, "_parent": parent if parent is not None else none}
    rows = docs.select("*", *(c.cast("string").alias(n) for n, c in cues.items()))
    model = model or TextModel.fit(rows, text, "_declared")
    k, shared = len(model.languages), _Shared(spark, model)
    if not k:
        return docs.select("*", F.lit("und").alias("lang_id"), F.lit(0.0).alias("lang_posterior"), F.lit("und").alias("lang_text"), F.lit(False).alias("lang_keep"))
    counted = text_scores(rows.select(text, *cues), shared, text).where("_ll IS NOT NULL").withColumn("_best", _best(F.col("_ll")))
    counted = materialize(counted.groupBy("_host", "_parent", "_declared", "_suffix", "_best").agg(F.count("*").cast("double").alias("n")), "languages")

    whole = {r[0]: r[1] for r in counted.groupBy("_best").agg(F.sum("n")).collect()}  # a row for each language
    corpus = np.array([whole.get(i + 1, 0.0) + 1.0 for i in range(k)])
    corpus /= corpus.sum()
    base = F.array(*map(F.lit, corpus.tolist()))
    parents = _shares(counted, "_parent", k, PARENT_WEIGHT, base).select("_parent", F.col("p").alias("pp"))
    pairs = counted.join(parents, "_parent", "left").withColumn("pp", F.coalesce("pp", base)) if parent is not None else counted.withColumn("pp", base)
    # a host has one parent, or else the first
    parent_of = pairs.where(F.col("_host").isNotNull()).groupBy("_host").agg(F.min_by("pp", F.coalesce("_parent", F.lit(""))).alias("pp"))
    host_rows = _by_language(counted, "_host", k).join(parent_of, "_host").withColumn("total", _sum(F.col("ns")))
    hosts = host_rows.select("_host", F.transform(_pulled(HOST_WEIGHT, F.col("pp")), lambda p: F.log(p)).alias("_prior"))

    def say(column: str, *more: Column) -> DataFrame:
        """What each value of a cue says of each language: log likelihood ratios."""
        ratios = F.transform(F.arrays_zip(F.col("p"), base.alias("b")), lambda z: F.log(z["p"] / z["b"]))
        return _shares(counted, column, k, CUE_WEIGHT, base).select(column, ratios.alias(f"_say{column}"), *more)

    no_class = ((F.col("n") >= LEAST_ROWS) & (F.length("_declared") > 0) & ~F.col("_declared").isin(model.languages)).alias("_no_class")

    zero = F.array(*[F.lit(0.0)] * k)
    scored = text_scores(rows, shared, text)
    for column, known in (("_host", hosts), ("_declared", say("_declared", no_class)), ("_suffix", say("_suffix"))):
        known = materialize(known, "cues")
        scored = scored.join(F.broadcast(known) if small_enough(known, BROADCAST_ROWS) else known, column, "left")
    prior = F.coalesce("_prior", F.array(*map(F.lit, np.log(corpus).tolist())))
    zipped = F.arrays_zip(F.col("_ll").alias("a"), prior.alias("b"), F.coalesce("_say_declared", zero).alias("c"), F.coalesce("_say_suffix", zero).alias("d"))
    logs = F.transform(zipped, lambda z: z["a"] + z["b"] + z["c"] + z["d"])
    out = scored.withColumn("_log", F.when(F.col("_ll").isNotNull() & ~F.coalesce("_no_class", F.lit(False)), logs))
    top = F.array_max("_log")
    posterior = 1 / F.aggregate("_log", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    names = F.array(*map(F.lit, model.languages))
    out = out.select(
        *docs.columns,
        F.coalesce(F.get(names, _best(F.col("_log")) - 1), F.lit("und")).alias("lang_id"),
        F.coalesce(posterior, F.lit(0.0)).alias("lang_posterior"),
        F.coalesce(F.get(names, _best(F.col("_ll")) - 1), F.lit("und")).alias("lang_text"),
    )
    return out.withColumn("lang_keep", (F.col("lang_id") != "und") & (F.col("lang_posterior") >= LEAST_POSTERIOR))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def markup_language(html: Column) -> Column:
    head = F.regexp_extract(html, r"(?i)<html[^>]*+", 0)  # ends with the first tag or the text: no way back
    return F.nullif(F.lower(F.regexp_extract(head, r"(?i)\slang=[\"']?([A-Za-z]+)", 1)), F.lit(""))


def visible_text(html: Column) -> Column:
    """Text outside scripts, styles, comments and tags; one that is not closed goes on to the end. Takes time in proportion to the length."""
    html = F.regexp_replace(html, r"(?is)<(script|style)\b(?:.*?</\1\s*+>|.*+)", " ")
    return F.regexp_replace(html, r"(?s)<!--(?:.*?-->|.*+)|<[^>]*+>?", " ")


def identify_pages(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) with their language: markup, address suffix, host and domain as evidence."""
    host = host_of(F.col("url"))
    suffix = F.nullif(F.concat_ws("/", F.element_at(F.split(host, r"\."), -1), F.nullif(F.regexp_extract("url", r"://[^/]+/([a-z]{2})(/|$)", 1), F.lit(""))), F.lit(""))
    rows = pages.withColumn("page_text", visible_text(F.coalesce("html", F.lit(""))))
    return identify(rows, "page_text", markup_language(F.col("html")), suffix, F.nullif(host, F.lit("")), F.nullif(F.substring_index(host, ".", -2), F.lit(""))).drop("page_text")


def identify_documents(docs: DataFrame) -> DataFrame:
    """documents with their language: ``lang`` is the declaration, ``source`` the host, addresses in the source give suffix and domain."""
    source = F.col("source")
    suffix = F.when(source.contains("."), F.element_at(F.split(F.coalesce(F.nullif(host_of(source), F.lit("")), source), r"\."), -1))
    parent = F.when(source.contains("."), F.substring_index(F.coalesce(F.nullif(host_of(source), F.lit("")), source), ".", -2))
    return identify(docs, "text", F.col("lang"), suffix, source, parent)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", "lang", "lang_id", F.round("lang_posterior", 6).alias("lang_posterior"), "lang_text", F.col("lang_keep").alias("keep"))


def op7_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", markup_language(F.col("html")).alias("lang"), "lang_id", F.round("lang_posterior", 6).alias("lang_posterior"), "lang_text", F.col("lang_keep").alias("keep"))
