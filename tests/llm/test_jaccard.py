import random
import re

import numpy as np
import pytest

from sigspark.llm import components, jaccard, shingles


def brute(rows):
    sets = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, r in zip(group, rows, strict=True):
        least[g] = min(least.get(g, r[0]), r[0])
    return sorted((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group, strict=True))


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "ß"]
    rows, doc = [], 100
    passage = [rng.choice(vocab) for _ in range(70)]
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 30)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            if rng.random() < 0.3:
                text = text + passage
            if rng.random() < 0.2:
                text = passage + text[: rng.randint(1, 15)]
            rows.append((doc, rng.choice([" ", "\n"]).join(text), "x"))
            doc -= 1 if rng.random() < 0.5 else -201
    return rows


EDGE = [(1, None, "x"), (2, "", None), (3, " \n", "x"), (4, "one two", "x"), (5, "ONE  two", "x"), (6, "one two three", "x"), (7, "a b c d e", "x"), (8, "A b\tc d\x0be", "x"), (9, "é É a b c d", "x"), (10, "w " * 200_000, "x"), (11, "w w w w w", "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_exact(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "CANDIDATES", 5)
    rows = corpus(seed) + EDGE
    rows += rows[5:7]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string, rep string")).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_null_id_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str) == sorted([(None, 2, 3), (3, 2, 3), (None, 0, None)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_divide_skip():
    rng = np.random.default_rng(5)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 30, rng.integers(0, 25))) for _ in range(rng.integers(1, 20))]
        least = int(rng.integers(1, 12))
        ids, counts = np.unique(np.concatenate(lists), return_counts=True)
        assert jaccard.divide_skip(lists, least) == {int(i): int(c) for i, c in zip(ids, counts, strict=True) if c >= least}


def test_word_hashes_by_block(monkeypatch):
    data = b" ".join(b"word%d" % (i * i) for i in range(3000))
    one = shingles.word_hashes(data)
    monkeypatch.setattr(shingles, "BLOCK", 500)
    many = shingles.word_hashes(data)
    assert (one[0] == many[0]).all() and (one[1] == many[1]).all() and len(set(one[1].tolist())) == 3000


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(50, 60), (60, 50), (70, 70), (5, 25)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 5 for i in [5, *range(10, 41)]}, 50: 50, 60: 50}


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_structured_words_do_not_collide(spark):
    """Words that collide under any polynomial hash modulo a power of two are different words."""
    w = thue_morse(1024)
    other = w.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{w} x y z u v"), (2, f"{other} x y z u v"), (3, w), (4, other), (5, other)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    for kind in (0, 1):
        assert len(set(shingles.word_hashes(f"{w} {other} {w}".encode(), (kind,))[1].tolist())) == 2


def test_words_of_any_length_hash_alike_wherever_they_stand():
    long = b"x" * (shingles.LONG_WORD + 5)
    edge = b"y" * shingles.LONG_WORD
    data = b" ".join([b"a" * 300_000, long, b"b", edge, b"c" * 200_000, long, edge, b"b", b"a" * 300_000])
    starts, one, two = shingles.word_hashes(data, (0, 1))
    for h in (one, two):
        assert len(h) == 9 and len(set(h.tolist())) == 5
        assert h[0] == h[8] and h[1] == h[5] and h[2] == h[7] and h[3] == h[6]
        assert shingles.word_hashes(edge, (0,) if h is one else (1,))[1][0] == h[3]
    assert starts[1] == 300_001 and len(shingles.prefix_hashes(data, (5, 6))) == 14


SHARED = [
    [(10, "x x x x x x"), (11, "x x x x x x"), (11, "y y y y y z"), (12, "y y y y y z")],
    [(20, "a b c d e f g h i j k l m n o p"), (20, "q r s t u"), (19, "Q r s t u"), (25, "a b c d e f g h i j k l m n o z p"), (7, "v"), (25, "v"), (None, "v")],
]


@pytest.mark.parametrize("rows", SHARED)
def test_rows_that_share_a_doc_id_are_one_document(spark, rows):
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    named = [(d, t) for d, t in rows if d is not None]
    want, least = brute(named), {}
    group = {d: d for d, _ in named}
    for _ in range(len(rows)):
        for d, _, c in want:
            group[d] = group[c] = min(group[d], group[c])
    least = {(d, group[d]) for d in group}
    assert {g for g in got if g[0] is not None} == least


@pytest.mark.parametrize("seed", [4])
def test_all_links_are_found(spark, seed):
    rows = [r for r in corpus(seed) if r[0] is not None] + EDGE
    rows = list({r[0]: r for r in rows}.values())
    links, members = jaccard.jaccard_links(spark.createDataFrame(rows, "doc_id long, text string, rep string"))
    sets = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    rep = {}
    for d in sorted(sets):
        rep.setdefault(sets[d], d)
    reps = [d for s, d in rep.items() if s]
    want = set()
    for i, u in enumerate(reps):
        for v in reps[:i]:
            both = len(sets[u] & sets[v])
            if 100 * both >= 80 * (len(sets[u]) + len(sets[v]) - both):
                want.add((min(u, v), max(u, v)))
    assert {tuple(r) for r in links.collect()} == want and len(want) > 20
    for r in members.collect():
        assert r.rep == (rep[sets[r.doc_id]] if sets[r.doc_id] else None)
        assert r.n_links == sum(r.rep in p for p in want if r.rep is not None)
