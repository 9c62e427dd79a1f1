import hashlib
import re
import zlib

import numpy as np

from sigspark.llm import contamination, media, warc

LONG = "é<p>\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 4000
PAGES = [(1, "http://a b/\r\nx", LONG, 0), (2, None, LONG, 0), (3, "u", "small", 0), (4, "u", "small", 0), (5, "u", None, 0), (6, "u", "", 0), (7, "v", "y" * 1000, 0), (7, "v", "y" * 1000, 0), (6, "v", "y" * 1000, 0), (8, "v", "y" * 999, 0), (9, "v", "y" * 999, 0), (None, "n", "q" * 2000, 0), (None, "n", "y" * 1000, 0)]
PAGE_DDL = "page_id long, url string, html string, payload_bytes int"


def brute_pages(rows):
    out = []
    for p, _, h, _ in rows:
        b = (h or "").encode()
        same = [q for q, _, g, _ in rows if (g or "") == (h or "") and q is not None]
        r = max(same) if same and len(b) >= 1000 else None
        revisit = r is not None and (p is None or p < r)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", r if revisit else None))
    return sorted(out, key=str)


def test_warc_query(spark, tmp_path):
    spark.createDataFrame(PAGES, PAGE_DDL).write.parquet(str(tmp_path / "pages.parquet"))
    got = warc.op1_warc(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute_pages(PAGES)


def test_segments_are_reassembled(spark, tmp_path):
    df = spark.createDataFrame(PAGES[:3], PAGE_DDL)
    warc.write_archives(warc.assign_revisits(df), str(tmp_path / "w"), segment_bytes=777, chunk_bytes=50, records_per_archive=10)
    rows = warc.read_archives(spark, str(tmp_path / "w"), with_block=True).collect()
    assert {r.page_id: warc.payload_of(bytes(r.block)).decode() for r in rows if r.record_type == "response"} == {2: LONG, 3: "small"}
    assert max(r.segment or 0 for r in rows) > 100


def test_warc_empty(spark, tmp_path):
    spark.createDataFrame([], PAGE_DDL).write.parquet(str(tmp_path / "pages.parquet"))
    assert warc.op1_warc(spark, str(tmp_path)).count() == 0


def test_media(spark):
    texts = [None, "", "a" * 64, "é" * 33, "x" * 5000, "word and word " * 30_000, "x" * 5000]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    rows = {r.doc_id: r for r in media.fingerprint(media.encode_wav(df)).collect()}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        p = b + bytes(-len(b) % 64 or (0 if b else 64))
        w = media.to_wav(p)
        assert media.from_wav(w) == p
        assert rows[i][1:7] == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(w), hashlib.sha256(w).hexdigest())
    assert rows[4].pair_codes == rows[6].pair_codes
    assert media.fingerprint(media.encode_wav(df.limit(0))).count() == 0


def test_peaks_find_a_tone():
    t = np.arange(8192)
    tone = (128 + 100 * np.sin(2 * np.pi * 64 * t / media.FRAME)).astype(np.uint8)
    peaks = media.frame_peaks(tone)
    assert (peaks[:-1, 0] == 64).all()
    times, codes = media.peak_pairs(peaks)
    assert (64 << 16 | 64 << 4 | 1) in set(codes.tolist()) and (np.diff(times) >= 0).all()


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).update([] if i is None else [i])
    out = []
    for d, t in docs:
        w, hit, met = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    met |= ids
        out.append((d, len(w), len(hit), len(met), contamination.items_digest(list(met)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "Short item"), (10, "short, ITEM!"), (3, None), (None, "null id words"), (4, "..."), (5, "a a a"), (1, long)]
    docs = [(0, None), (1, ""), (2, "say Short-item here"), (3, "x " * 500 + long.upper() + " y" * 90000), (4, "a a a a a b"), (5, "shorty item short"), (6, "null ID words"), (7, " ".join(f"w{i}" for i in range(5, 18))), (7, "short item"), (8, "Ünï short item")]
    spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, runs string").write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    q = contamination.op4_decontamination(spark, str(tmp_path))
    want = brute(docs, items)
    got = q.collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    for r in got:
        # the column of spans: code points of the original, each a run of hit words, none of them apart
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        texts = [t or "" for d, t in docs if d == r.doc_id]
        assert any(sum(len(words(t[a:b])) for a, b in spans) == r.n_hit for t in texts)
        assert spans == sorted(spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    blocks = contamination.with_verdict(contamination.scan(df.drop("runs"), bench, offsets=True, block_bytes=40)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, contamination.items_digest(r["items"]), r.contaminated) for r in blocks), key=str) == want
    for r in blocks:
        for run, span in zip(r.runs, r.spans, strict=True):
            assert words(r.text[span.start : span.end]) == words(r.text)[run.first : run.end]
    kept = contamination.decontaminate(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(not w[-1] for w in want)
    none = contamination.with_verdict(contamination.scan(df.drop("runs"), bench.limit(0)))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(docs)
