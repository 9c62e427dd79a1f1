"""Benchmark decontamination with one Aho-Corasick automaton.

Words are maximal runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
characters. A benchmark window is 13 consecutive words of an item, or all of a
shorter item. All windows go into one automaton over text normalised to words
between single spaces, so a document is scanned once; match ends are mapped to
word numbers and, in ``scan``'s general form, to offsets of the original text.

The benchmark is a fixed question set, not a table that grows with the corpus:
its text is measured first, and beyond ``block_bytes`` it is taken in blocks,
one pass over the documents each, so that the broadcast stays bounded.

Cases: null text has no words; a null item_id adds hits but is no listed item;
repeated rows and ties are kept one by one on the document side and count once
on the item side; empty tables give no rows or no hits; extra columns are
kept, but in ``scan`` those named like its results are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_worker, materialize, set_aside, table, tidy, without

WINDOW = 13
#: Bytes to the normal form: A-Z lower-cased, ASCII that is no letter or digit to a space.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
#: 20 * n_hit >= n_words: a twentieth of the words.
SHARE = 20

#: Columns that the operator adds.
OWN = {"n_words": "bigint", "runs": "array<struct<first:int,end:int>>", "items": "array<bigint>", "spans": "array<struct<start:int,end:int>>", "n_hit": "bigint", "n_items": "bigint", "contaminated": "boolean"}

def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


def windows_of(words: list[bytes]) -> list[bytes]:
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(max(1, len(words) - WINDOW + 1))]


def _build(windows: list[tuple[bytes, list[int]]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for k, (pattern, items) in enumerate(windows):
        a.add_word(pattern.decode(), (k, pattern.count(b" ") - 1, items))
    if len(a):
        a.make_automaton()
    return a


def _runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_windows(text: bytes | None, automaton: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, runs of hit words as (first, end), and items met."""
    words = words_of(text)
    spans: list[tuple[int, int]] = []
    items: set[int] = set()
    if words and len(automaton):
        line = " " + b" ".join(words).decode() + " "
        ends = None
        for at, (_, n, ids) in automaton.iter(line):
            if ends is None:
                ends = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
            last = int(np.searchsorted(ends, at))
            spans.append((last - n, last))
            items.update(ids)
    return len(words), _runs(spans), items


@tidy
def _scan(batches: Iterator[pa.RecordBatch], shared, offsets: bool) -> Iterator[pa.RecordBatch]:
    automaton = in_worker(shared.id, lambda: _build(shared.value))
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        before = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist(), strict=True)
        n_words, runs, items, spans = [], [], [], []
        for text, (old_runs, old_items) in zip(texts, before, strict=True):
            n, new, met = find_windows(text, automaton)
            new = _runs(new + [(r["first"], r["end"]) for r in old_runs or ()])
            n_words.append(n)
            runs.append([{"first": a, "end": b} for a, b in new])
            items.append(sorted(met.union(old_items or ())))
            if offsets:
                at = [m.span() for m in WORD.finditer(text.decode())] if new else []
                spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in new])
        own = {"n_words": pa.array(n_words, pa.int64()), "runs": pa.array(runs, batch.schema.field("runs").type), "items": pa.array(items, batch.schema.field("items").type), "spans": pa.array(spans if offsets else [None] * len(texts), batch.schema.field("spans").type)}
        yield pa.RecordBatch.from_arrays([own.get(name, batch.column(i)) for i, name in enumerate(batch.schema.names)], names=batch.schema.names)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[bytes, list[int]]]]:
    """Windows with their items, in blocks of bounded bytes; the driver holds one block at a time."""
    found: dict[bytes, set[int]] = {}
    held = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        for w in windows_of(words_of((row["text"] or "").encode())):
            held += len(w) if w not in found else 8
            found.setdefault(w, set()).update([] if row["item_id"] is None else [row["item_id"]])
        if held > block_bytes:
            yield [(w, sorted(s)) for w, s in sorted(found.items())]
            found, held = {}, 0
    yield [(w, sorted(s)) for w, s in sorted(found.items())]


def scan(docs: DataFrame, benchmark: DataFrame, offsets: bool = False, keep_text: bool = True, block_bytes: int = 8 << 20) -> DataFrame:
    """docs plus n_words, runs (hit words), items and, on demand, spans (code points of the original)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    extra = {k: OWN[k] for k in ("n_words", "runs", "items", "spans")}
    out = without(docs, extra).select("*", *(F.lit(None).cast(t).alias(c) for c, t in extra.items()))
    blocks = _blocks(benchmark, block_bytes)
    block = next(blocks)
    for more in itertools.chain(blocks, [None]):
        shared = _Shared(spark.sparkContext.broadcast(block), uuid.uuid4().hex)
        out = out.mapInArrow(lambda b, s=shared: _scan(b, s, offsets), out.schema)
        if more is not None:
            out, block = materialize(out, "decontaminate"), more
    return out if keep_text else out.drop("text")


class _Shared:
    """A broadcast with an identity that workers can remember it by."""

    def __init__(self, broadcast, ident: str):
        self.broadcast, self.id = broadcast, ident

    @property
    def value(self):
        return self.broadcast.value


def with_verdict(scanned: DataFrame) -> DataFrame:
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["first"])
    out = scanned.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(SHARE) * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without its contaminated rows, columns as they were."""
    renamed, back = set_aside(docs, OWN)
    return back(with_verdict(scan(renamed, benchmark)).where("NOT contaminated").drop(*OWN))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_verdict(scan(docs, table(spark, sf_dir, "benchmark"), offsets=True, keep_text=False))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(listed, 256).alias("items_sha256"), "contaminated", spans.alias("spans"))


OP4_SQL = """
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, CAST(least(13, len(w)) AS BIGINT) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0
), d AS (
  SELECT doc_id, r, x, regexp_extract_all(x, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents) t
), dw AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM d, (SELECT DISTINCT k FROM bw) q, unnest(range(1, len(w) - k + 2)) t(i)
), m AS (SELECT dw.r, dw.k, dw.i, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
hp AS (SELECT DISTINCT r, p FROM (SELECT DISTINCT r, k, i FROM m) x, unnest(range(i, i + k)) t(p)),
h AS (SELECT r, count(*) AS n_hit FROM hp GROUP BY r),
u AS (SELECT r, p - place AS island, min(p) AS first, max(p) AS last FROM (SELECT r, p, row_number() OVER (PARTITION BY r ORDER BY p) AS place FROM hp) x GROUP BY r, p - place),
tk AS (SELECT r, t, n, sum(length(t)) OVER (PARTITION BY r ORDER BY n) AS upto, sum(CASE WHEN regexp_matches(t, '^[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]') THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY n) AS word
  FROM (SELECT r, unnest(l) AS t, unnest(range(len(l))) AS n FROM (SELECT r, regexp_extract_all(x, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+|[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS l FROM d WHERE r IN (SELECT r FROM h)) y) z),
wp AS (SELECT r, word, upto - length(t) AS start, upto AS stop FROM tk WHERE regexp_matches(t, '^[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]')),
sp AS (SELECT u.r, string_agg(CAST(a.start AS BIGINT) || ':' || CAST(b.stop AS BIGINT), ',' ORDER BY a.start) AS spans FROM u JOIN wp a ON a.r = u.r AND a.word = u.first JOIN wp b ON b.r = u.r AND b.word = u.last GROUP BY u.r),
j AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN h USING (r) LEFT JOIN j USING (r) LEFT JOIN sp USING (r)
"""


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
