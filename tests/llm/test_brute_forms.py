"""Operators without SQL against plain versions, and archives that are broken."""

import gzip
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.llm import media, quality, warc


def naive_pairs(payload):
    """Times and codes of spectral-peak pairs by a plain discrete Fourier transform."""
    x = np.frombuffer(payload, np.uint8).astype(float) - 128
    n, size = media.FRAME, 1
    while (size - 1) * media.HOP + n < len(x):
        size += 1
    x = np.concatenate((x, np.zeros((size - 1) * media.HOP + n - len(x))))
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n - 1))
    turn = np.exp(-2j * np.pi * np.outer(np.arange(n // 2 + 1), np.arange(n)) / n)
    peaks = []
    for f in range(size):
        mag = np.abs(turn @ (x[f * media.HOP : f * media.HOP + n] * window))
        tops = [k for k in range(1, n // 2) if mag[k] > mag[k - 1] and mag[k] >= mag[k + 1]]
        peaks.append(sorted(tops, key=lambda k: -mag[k])[: media.PEAKS])
    out = []
    for t in range(size):
        for dt in range(1, media.AHEAD + 1):
            if t + dt < size:
                out += [(t, (a << 16) | (b << 4) | dt) for a in peaks[t] for b in peaks[t + dt]]
    return size, sorted(out)


def test_fingerprint_equals_a_plain_transform(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ABC.é") for _ in range(k)) for k in (0, 10, 1024, 1025, 1600, 5000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in media.fingerprint(media.encode_wav(df)).collect():
        frames, pairs = naive_pairs(media.pad(texts[r.doc_id].encode()))
        assert r.n_frames == frames
        assert list(zip(r.pair_times, r.pair_codes, strict=True)) == pairs


def naive_posteriors(rows):
    """(id, host, path, quality log odds, toxic log odds) -> id -> both posteriors."""
    chance = lambda x: 1 / (1 + math.exp(-x))
    odds = lambda p: math.log(p / (1 - p))
    out = {r[0]: [] for r in rows}
    for k in (3, 4):
        mean = sum(chance(r[k]) for r in rows) / len(rows)
        hosts, paths = {}, {}
        for _, host, path, *own in rows:
            if host is not None:
                hosts.setdefault(host, []).append(chance(own[k - 3]))
                paths.setdefault((host, path), []).append(chance(own[k - 3]))
        spreads = [(sum(v) / len(v) - mean) ** 2 - mean * (1 - mean) / len(v) for v in hosts.values() if len(v) > 1]
        spread = sum(spreads) / len(spreads) if spreads else 0
        low, high = quality.STRENGTH
        strength = high if spread <= 0 else min(max(mean * (1 - mean) / spread - 1, low), high)
        rate = {h: (sum(v) + strength * mean) / (len(v) + strength) for h, v in hosts.items()}
        for i, host, path, *own in rows:
            shift = 0.0
            if host is not None:
                v = paths[host, path]
                shift = odds((sum(v) + quality.PATH_STRENGTH * rate[host]) / (len(v) + quality.PATH_STRENGTH)) - odds(mean)
            out[i].append(chance(own[k - 3] + shift))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_posteriors_equal_a_plain_version(spark, seed):
    rng = random.Random(seed)
    level = {f"h{i}": rng.gauss(0, 1.5 if seed < 3 else 0) for i in range(9)}
    rows = []
    for i in range(400):
        host = rng.choice([*level, "h0", "h0", "h0", None])
        own = level.get(host, 0.0)
        rows.append((i, host, rng.choice([f"{host}/a", f"{host}/b", None]), rng.gauss(own, 1), rng.gauss(-own, 1)))
    rows.append((400, "alone", None, 8.0, -8.0))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, host string, path string, quality_own double, toxic_own double, n string")
    want = naive_posteriors(rows)
    got = quality.posteriors(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.quality_posterior, r.toxic_posterior) == pytest.approx(tuple(want[r.doc_id]), abs=1e-9)


def test_quality_with_clashing_columns_and_ties(spark):
    names = ["host", "path", "n", "hn", "quality", "toxic", "rate_quality", "site_host", "shift_toxic", "keep"]
    docs = spark.createDataFrame([(i % 6, f"text {i % 3}", "s") for i in range(12)], "doc_id long, text string, source string").select("*", *(F.lit("x").alias(c) for c in names))
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, 0, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels, F.col("source"), F.concat("source", F.lit("/p"))).collect()
    assert len(got) == 12
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc_id % 3, set()).add((r.quality_posterior, r.toxic_posterior, r.keep))
    assert all(len(v) == 1 for v in by_text.values())


PAGES = "page_id long, url string, html string"


def archives(spark, folder):
    """Records of a page in five segments and of one in one piece, as (headers and block) bytes."""
    df = spark.createDataFrame([(1, "http://a/", "long " * 900), (2, "http://b/", "short")], PAGES)
    warc.write_archives(warc.assign_revisits(df.coalesce(1)), folder, segment_bytes=1000, chunk_bytes=300)
    data = b"".join(gzip.decompress(open(f, "rb").read()) for f in sorted(__import__("glob").glob(f"{folder}/*.gz")))
    return [b"WARC/1.1\r\n" + r for r in data.split(b"WARC/1.1\r\n")[1:]]


BROKEN = {
    "a segment is missing": (lambda rs: [r for r in rs if b"Segment-Number: 3" not in r], "segments"),
    "the first segment is missing": (lambda rs: [r for r in rs if b"Segment-Number: 1\r" not in r], "segments"),
    "the total length is wrong": (lambda rs: [r.replace(b"Total-Length: ", b"Total-Length: 9") for r in rs], "total length"),
    "the last segment is missing": (lambda rs: [r for r in rs if b"Total-Length" not in r], "total length|segments|None"),
    "a digest is wrong": (lambda rs: [r.replace(b"Payload-Digest: sha1:", b"Payload-Digest: sha1:0") for r in rs], "digest"),
    "a chunk is short": (lambda rs: [r.replace(b"\r\n5\r\nshort", b"\r\n4\r\nshort") for r in rs], "chunk|length|invalid"),
    "a record is cut off": (lambda rs: [*rs[:-1], rs[-1][:-9]], "length|not found"),
    "no record": (lambda rs: [*rs, b"garbage\r\n\r\n"], "WARC|codec|header|length|KeyError|content"),
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_archives_are_errors(spark, tmp_path, name):
    records = archives(spark, str(tmp_path / "good"))
    assert len(records) >= 6 and warc.read_archives(spark, str(tmp_path / "good")).count() == 2
    change, said = BROKEN[name]
    (tmp_path / "bad").mkdir()
    changed = change(records)
    assert changed != records
    (tmp_path / "bad" / "a.warc").write_bytes(b"".join(changed))
    with pytest.raises(Exception, match=said):
        warc.read_archives(spark, str(tmp_path / "bad")).collect()


def test_a_very_long_page(spark, tmp_path):
    html = "é<p>0123456789" * 400_000
    spark.createDataFrame([(1, "u", html), (2, "u", html), (3, "u", "x" * 999)], PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in warc.op1_warc(spark, str(tmp_path)).collect()}
    assert got[1].refers_to == 2 and got[1].payload_bytes == got[2].payload_bytes == 6_000_000 and got[3].record_type == "response"
