import hashlib
import random

import pytest

from sigspark.llm import suffix_dedup as sd


def brute(rows):
    first, out = {}, []
    texts = sorted({(d, (t or "").encode()) for d, t, *_ in rows if d is not None})
    for d, b in texts:
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            first[w] = min(first.get(w, (d, s)), (d, s))
    gone = {}
    for d, b in texts:
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (d, s):
                gone.setdefault((d, b), set()).update(range(s, s + 100))
    for d, t, *_ in rows:
        b = (t or "").encode()
        g = gone.get((d, b), set())
        runs = sum(1 for i in g if i - 1 not in g)
        out.append((d, len(b), len(g), runs, hashlib.sha256(bytes(c for i, c in enumerate(b) if i not in g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(12, 60)) for _ in range(6)]
    rows = [(1000 + i, t, "x") for i, t in enumerate([None, "", "a" * 99, "a" * 100, "a" * 101, "a" * 700, "ab" * 300, passages[0][:101], passages[0][1:101] + "!"])]
    for i in range(60):
        text = prose(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            text += rng.choice(["", "z", prose(5)]) + p[a : a + rng.randint(60, 400)]
        rows.append((rng.choice([i, 5000 - i]), text, "y"))
        if rng.random() < 0.3:
            t = list(text)
            for _ in range(rng.randint(0, 2)):
                if t:
                    t[rng.randrange(len(t))] = "#"
            rows.append((9000 + i, "".join(t), "z"))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 16), (2, 700), (3, 333)])
def test_exact(spark, seed, block, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", block)
    rows = corpus(seed)
    rows += [rows[20], (None, rows[21][1], "n")]
    rows += [(rows[30][0], rows[31][1], "other"), (rows[30][0], rows[40][1] + "!", "other"), (rows[12][0], "é" + rows[13][1], "x"), (rows[33][0], None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sd.remove_repeats(df).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def test_long_text(spark):
    rng = random.Random(9)
    half = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    got = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame([(1, half + "|" + half), (2, "é" + half)], "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[1].n_spans) == (200_000, 1) and (got[2].n_removed, got[2].n_spans) == (200_000, 1)


def test_empty(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_that_share_a_doc_id(spark):
    """A text loses what it repeats itself, not what another row of its doc_id repeats."""
    rng = random.Random(3)
    a, u, v = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3))
    rows = [(1, a), (5, a), (5, u), (7, v), (7, v + "tail"), (8, "x" + u + "y"), (8, "zz" + u), (8, "x" + u + "w")]
    got = sorted(tuple(r)[:5] for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)
    assert [(r[0], r[2]) for r in got] == [(1, 0), (5, 0), (5, 300), (7, 0), (7, 0), (8, 300), (8, 300), (8, 300)]
    last = [(2, u + "q"), (2, u + "r")]
    got = sorted(tuple(r)[:5] for r in sd.remove_repeats(spark.createDataFrame(rows + last, "doc_id long, text string")).collect())
    assert got == brute(rows + last)
