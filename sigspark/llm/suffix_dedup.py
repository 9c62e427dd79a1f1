"""Repeated 100-byte strings by sparse distributed prefix doubling.

A byte is removed if a string of LENGTH bytes that covers it also starts
earlier: in a smaller doc_id, or earlier in the same document. Ranking every
position of the corpus at each doubled offset would move many times its size,
so positions are ranked in rounds of growing length and leave as soon as their
rank is unique:

* round 1, 32 bytes. Ranks of 1, 2, 4, ... 32 bytes are doubled inside each
  text (rank pairs at growing offsets). Each window of 100 bytes is stood for
  by the least 32-byte rank inside it, which equal windows have at equal
  places; consecutive windows with one such anchor form a run. Runs are dealt
  out and sorted by the anchor's rank; unique ones leave.
* runs whose whole content (all their windows) is equal need no further look:
  every one but the earliest is a repeat.
* round 2, 92 bytes. What is left is cut at fixed places relative to the
  anchor into runs of at most 9 windows, ranked by the 92 bytes they share.
* round 3, 100 bytes: single windows, ranked by all their bytes.

Each task combines equal runs before it sends them. Every round looks at all
that is left; nothing is capped or sampled.

Cases: null or short texts lose nothing; rows that share a doc_id are one
document at one place in the order: a string of one of them that starts earlier
in another is removed, and of equal starts none is earlier, so repeated rows
are alike and a row loses only what its own text repeats; a row
with null doc_id has no place in the order, loses nothing and removes nothing;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_WORDS, bounded_batches, materialize, mix64, parts_for, table, text_bytes, tidy
from .shingles import Sums

LENGTH = 100
GRAM = 32
GRAMS = LENGTH - GRAM + 1
#: Windows of a run in round 2, and the bytes that all of them share.
BIN = 9
CORE = LENGTH - BIN + 1
#: Bytes of a block: places inside it fit the low bits of a rank.
BLOCK = 1 << 16
PLACE = np.uint64((1 << 17) - 1)
FLUSH = 500_000

_MULTIPLIERS = mix64(np.arange(11, 17, dtype=np.uint64)) | np.uint64(1)

def gram_ranks(a: np.ndarray) -> np.ndarray:
    """Ranks of the 32-byte strings of a: pairs of ranks at offsets 1, 2, 4, 8 and 16."""
    r, step = BYTE_WORDS[a], 1
    for m in _MULTIPLIERS[:5]:
        r = r[:-step] * m + r[step:]
        step *= 2
    return mix64(r)


def least_of_windows(ranks: np.ndarray) -> np.ndarray:
    """For each window start, the place of the leftmost least rank among its grams."""
    v = (ranks & ~PLACE) | np.arange(len(ranks), dtype=np.uint64)
    width = 1
    while 2 * width <= GRAMS:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    if width < GRAMS:
        v = np.minimum(v[: len(v) - (GRAMS - width)], v[GRAMS - width :])
    return (v & PLACE).astype(np.int64)


def anchor_runs(data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first and last start, anchor place, anchor rank, hash of the run's bytes.

    bounds: ends of the texts that data joins; no window crosses one.
    """
    a = np.frombuffer(data, np.uint8)
    if len(a) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    ranks = gram_ranks(a)
    place = least_of_windows(ranks)
    valid = np.ones(len(place), bool)
    for e in bounds[:-1]:
        valid[max(0, e - LENGTH + 1) : e] = False
    change = np.concatenate(([True], (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])))
    first = np.flatnonzero(change)
    last = np.concatenate((first[1:] - 1, [len(place) - 1]))
    keep = valid[first]
    first, last = first[keep], last[keep]
    return first, last, place[first], ranks[place[first]], Sums(a, 0)(first, last + LENGTH)


def _pieces(docs: list[int | None], tags: list[int], texts: list[bytes | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Joined texts of about a block, with ends, doc_ids, tags and the offset of each piece in its text; long texts in overlapping blocks."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def joined():
        ends = np.cumsum([len(x) for *_, x in held])
        return b"".join(x for *_, x in held), ends, *(np.array([h[i] for h in held], np.int64) for i in range(3))

    for d, g, t in zip(docs, tags, texts, strict=True):
        if d is None or t is None or len(t) < LENGTH:
            continue
        for at in range(0, len(t) - LENGTH + 1, BLOCK):
            held.append((d, g, at, t[at : at + BLOCK + LENGTH - 1]))
            size += len(held[-1][-1])
            if size >= BLOCK - LENGTH:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def merge_spans(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted union of the spans of each text (doc, tag); hi is exclusive."""
    if not len(doc):
        return doc, tag, lo, hi
    order = np.lexsort((lo, tag, doc))
    doc, tag, lo, hi = doc[order], tag[order], lo[order], hi[order]
    new_doc = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
    group = np.cumsum(new_doc) - 1
    big = np.int64(1) << 40
    reach = np.maximum.accumulate(hi + group * big) - group * big
    fresh = new_doc.copy()
    fresh[1:] |= lo[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    return doc[at], tag[at], lo[at], np.maximum.reduceat(hi, at)


def _earliest(keys: tuple[np.ndarray, ...], doc: np.ndarray, tag: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys, place and tag; which rows start with the first of their keys, one a tag; which start later."""
    order = np.lexsort((tag, lo, doc, *reversed(keys)))
    new, fresh = np.ones(len(order), bool), np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
        fresh[1:] = new[1:] | (tag[order][1:] != tag[order][:-1])
    best = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (doc[order] != doc[best]) | (lo[order] != lo[best])
    return order, fresh & ~later, later


RUNS_DDL = "part long, kind long, rank binary, content binary, shape binary, doc binary, tag binary, lo binary"


@tidy
def _send_runs(batches: Iterator[pa.RecordBatch], n_parts: int) -> Iterator[pa.RecordBatch]:
    """Round 1, sending side: runs packed by part; equal runs of one task are sent once, the others as spans."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*held, strict=True)]
        rank, content, shape, doc, tag, lo = cols
        order, first, later = _earliest((rank, content, shape), doc, tag, lo)
        rank, content, shape, doc, tag, lo = (x[order] for x in cols)
        gone = merge_spans(doc[later], tag[later], lo[later], lo[later] + (shape[later] & 127) + LENGTH)
        rank, content, shape, doc, tag, lo = (x[first] for x in (rank, content, shape, doc, tag, lo))
        # anchors have the least ranks of their windows, so the high bits would deal to few parts
        part = (rank & np.uint64(0xFFFFFFFF)) * np.uint64(n_parts) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part, rank, content, shape, doc, tag, lo = (x[order] for x in (part, rank, content, shape.astype(np.uint16), doc, tag.astype(np.int64), lo.astype(np.uint32)))
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        rows = [(int(part[a]), 1, *(x[a:b].tobytes() for x in (rank, content, shape, doc, tag, lo))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if len(gone[0]):
            rows.append((int(content[0] % np.uint64(n_parts)), 0, gone[3].tobytes(), None, None, gone[0].tobytes(), gone[1].astype(np.int64).tobytes(), gone[2].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), *[pa.binary()] * 6], strict=True)], names=["part", "kind", "rank", "content", "shape", "doc", "tag", "lo"])

    size = 0
    for batch in batches:
        for data, ends, docs, tags, offsets in _pieces(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            lo, hi, place, rank, content = anchor_runs(data, ends)
            owner = np.searchsorted(ends, lo, "right")
            start = np.concatenate((np.zeros(1, np.int64), ends[:-1]))[owner]
            held.append((rank, content, ((place - lo) << 7) | (hi - lo), docs[owner], tags[owner], lo - start + offsets[owner]))
            size += len(lo)
        if size >= FLUSH:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


LEFT_DDL = "kind long, doc_id long, tag long, place long, lo long, hi long"


def _left(kind: int, doc, tag, place, lo, hi) -> dict[str, np.ndarray]:
    return {"kind": np.full(len(doc), kind, np.int64), "doc_id": doc, "tag": tag.astype(np.int64), "place": place, "lo": lo, "hi": hi}


def _rank_runs(tab: pa.Table) -> pa.Table:
    """Round 1, receiving side: kind 0 are removed spans [lo, hi), kind 1 runs that need another round."""
    kinds = tab.column("kind").to_numpy()

    def joined(name: str, kind: int, dtype) -> np.ndarray:
        packed = tab.column(name).filter(pa.array(kinds == kind))
        return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x.as_buffer(), dtype) for x in packed)])

    spans = [(joined("doc", 0, np.int64), joined("tag", 0, np.int64), joined("lo", 0, np.int64), joined("rank", 0, np.int64))]
    rank, content, shape = joined("rank", 1, np.uint64), joined("content", 1, np.uint64), joined("shape", 1, np.uint16).astype(np.int64)
    doc, tag, lo = joined("doc", 1, np.int64), joined("tag", 1, np.int64), joined("lo", 1, np.uint32).astype(np.int64)
    order, first, later = _earliest((rank, content, shape), doc, tag, lo)
    rank, shape, doc, tag, lo = (x[order] for x in (rank, shape, doc, tag, lo))
    spans.append((doc[later], tag[later], lo[later], lo[later] + (shape[later] & 127) + LENGTH))
    rank, shape, doc, tag, lo = (x[first] for x in (rank, shape, doc, tag, lo))
    same = rank[1:] == rank[:-1]
    open_ = np.zeros(len(rank), bool)
    open_[1:] |= same
    open_[:-1] |= same
    gone = merge_spans(*(np.concatenate(c) for c in zip(*spans, strict=True)))
    out = [_left(0, gone[0], gone[1], gone[2], gone[2], gone[3]), _left(1, doc[open_], tag[open_], lo[open_] + (shape[open_] >> 7), lo[open_], lo[open_] + (shape[open_] & 127))]
    return pa.table({c: pa.array(np.concatenate([x[c] for x in out])) for c in out[0]})


BINS_DDL = "core long, number long, near long, doc_id long, tag long, lo long, content binary"


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


@tidy
def _send_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 2, sending side: bins of at most BIN windows, at fixed distances before the anchor."""
    for batch in batches:
        rows = []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for doc, tag, text, runs in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), texts, batch.column("runs").to_pylist(), strict=True):
            for r in runs:
                p, lo, hi = r["place"], r["lo"], r["hi"]
                for k in range((p - hi) // BIN, (p - lo) // BIN + 1):
                    far, near = min(BIN * k + BIN - 1, p - lo), max(BIN * k, p - hi)
                    core = text[p - BIN * k : p - BIN * k + CORE]
                    rows.append((_digest(core), k, near, doc, tag, p - far, text[p - far : p - near + LENGTH]))
            if len(rows) >= 20_000:
                yield _bins(rows)
                rows = []
        if rows:
            yield _bins(rows)


def _bins(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [*[pa.int64()] * 6, pa.binary()], strict=True)], names=["core", "number", "near", "doc_id", "tag", "lo", "content"])


WINDOWS_DDL = "kind long, doc_id long, tag long, lo long, hi long, window binary"
_WINDOWS = pa.schema([("kind", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("window", pa.binary())])


@tidy
def _rank_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 2, receiving side: kind 0 are removed spans, kind 1 single windows with their digest.

    Rows come sorted by core, number, near, content and place. Equal contents
    stand together, the earliest first; a core with one content needs no
    windows. Only the rows of that one content are held.
    """
    last: dict | None = None  # the row before, with the place that its content starts with
    waiting: list[tuple] = []  # earliest rows of the only content of the core so far
    open_ = False
    windows: list[tuple] = []

    def emit(doc: int, tag: int, lo: int, content: bytes) -> None:
        for i in range(len(content) - LENGTH + 1):
            windows.append((1, doc, tag, lo + i, lo + i + LENGTH, hashlib.blake2b(content[i : i + LENGTH], digest_size=16).digest()))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        core, number, near, doc, tag, lo = (batch.column(c).to_numpy() for c in ("core", "number", "near", "doc_id", "tag", "lo"))
        content = batch.column("content")
        fresh_core, fresh, other_tag = np.ones(n, bool), np.ones(n, bool), np.ones(n, bool)
        fresh_core[1:] = (core[1:] != core[:-1]) | (number[1:] != number[:-1])
        fresh[1:] = fresh_core[1:] | (near[1:] != near[:-1]) | pc.not_equal(content.slice(1), content.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        other_tag[1:] = tag[1:] != tag[:-1]
        if last is not None:
            fresh_core[0] = (core[0], number[0]) != last["core"]
            fresh[0] = fresh_core[0] or near[0] != last["near"] or content[0].as_py() != last["content"]
            other_tag[0] = tag[0] != last["tag"]
        at = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        best_doc, best_lo = (np.where(at >= 0, x[at], last[k] if last else 0) for x, k in ((doc, "doc"), (lo, "lo")))
        later = (doc != best_doc) | (lo != best_lo)
        for i in np.flatnonzero(~later & (fresh | other_tag)).tolist():
            row = (int(doc[i]), int(tag[i]), int(lo[i]), content[i].as_py())
            if fresh_core[i]:
                waiting, open_ = [], False
            elif fresh[i] and not open_:
                open_ = True
                for w in waiting:
                    emit(*w)
            if open_:
                emit(*row)
            else:
                waiting.append(row)
        last = {"core": (core[-1], number[-1]), "near": near[-1], "content": content[n - 1].as_py(), "tag": tag[-1], "doc": best_doc[-1], "lo": best_lo[-1]}
        if later.any():
            size = pc.binary_length(content).to_numpy()[later]
            gone = merge_spans(doc[later], tag[later], lo[later], lo[later] + size)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(gone[0]), np.int64)), *(pa.array(x) for x in gone), pa.nulls(len(gone[0]), pa.binary())], schema=_WINDOWS)
        if len(windows) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*windows, strict=True), _WINDOWS, strict=True)], schema=_WINDOWS)
            windows.clear()
    if windows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*windows, strict=True), _WINDOWS, strict=True)], schema=_WINDOWS)


@tidy
def _cut_out(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
            text = text or b""
            one = np.zeros(len(spans or ()), np.int64)
            *_, lo, hi = merge_spans(one, one, *(np.array([s[k] for s in spans or ()], np.int64) for k in ("lo", "hi")))
            kept = [text[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(text)], strict=True)]
            left = b"".join(kept)
            out.append((doc, len(text), len(text) - len(left), len(lo), hashlib.sha256(left).hexdigest(), left if with_text else None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [*[pa.int64()] * 4, pa.string(), pa.binary()], strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _tagged(docs: DataFrame) -> DataFrame:
    """docs with a 64-bit hash of the text and its length, which tells rows of one doc_id apart."""
    return docs.select("doc_id", F.xxhash64("text", F.octet_length("text")).alias("tag"), "text")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, lo, hi): bytes [lo, hi) of a text that a repeated string covers; spans may overlap."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = _tagged(docs)
    # runs and bins both take about as many bytes as the texts
    n = parts_for(spark, text_bytes(docs))
    sent = docs.mapInArrow(lambda b: _send_runs(b, 4 * n), RUNS_DDL)
    one = materialize(sent.repartition(n, "part").groupBy("part").applyInArrow(_rank_runs, LEFT_DDL), "runs")
    runs = one.where("kind = 1").groupBy("doc_id", "tag").agg(F.collect_list(F.struct("place", "lo", "hi")).alias("runs"))
    bins = docs.join(runs, ["doc_id", "tag"]).mapInArrow(_send_bins, BINS_DDL)
    bins = bins.repartition(n, "core", "number").sortWithinPartitions("core", "number", "near", "content", "doc_id", "lo", "tag")
    two = materialize(bins.mapInArrow(_rank_bins, WINDOWS_DDL), "bins")
    windows = two.where("kind = 1").select("window", "doc_id", "tag", "lo", "hi")
    least = windows.groupBy("window").agg(F.min(F.struct("doc_id", "lo")).alias("least"), F.count("*").alias("n")).where("n > 1")
    three = windows.join(least, "window").where(F.struct("doc_id", "lo") > F.col("least"))
    return reduce(DataFrame.unionByName, (x.select("doc_id", "tag", "lo", "hi") for x in (one.where("kind = 0"), two.where("kind = 0"), three)))


@tidy
def _union_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of one task merged by text."""
    names = ["doc_id", "tag", "lo", "hi"]
    held = [tuple(batch.column(c).to_numpy() for c in names) for batch in batches]
    if held:
        merged = merge_spans(*(np.concatenate(c) for c in zip(*held, strict=True)))
        for at in range(0, len(merged[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 50_000]) for x in merged], names=names)


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of each row of docs(doc_id, text)."""
    spans = repeated_spans(docs).mapInArrow(_union_spans, "doc_id long, tag long, lo long, hi long")
    spans = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return _tagged(docs).join(spans, ["doc_id", "tag"], "left").mapInArrow(lambda b: _cut_out(b, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, CAST(2 * s + 1 AS INTEGER), 200)) AS k FROM d, unnest(range(0, greatest(n - 99, 0))) t(s)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS place FROM w) x WHERE place > 1),
g AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 1 ELSE 0 END AS fresh FROM r) x),
i AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM i),
k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, CAST(2 * before + 1 AS INTEGER), CAST(2 * (a - before) AS INTEGER)), '' ORDER BY a) AS head, max(b) AS last FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS INTEGER)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")
