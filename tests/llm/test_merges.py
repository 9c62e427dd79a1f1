"""BPE by the tokenization automaton, against the library and against merging by rank."""

import hashlib
import itertools
import random
import sys

import pytest

from sigspark.llm import merges


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(merges.model_path())


@pytest.fixture(scope="module")
def own():
    return merges.Tokenizer(*merges.Tokenizer.load(merges.model_path()))


def by_rank(symbols, pairs):
    """Merges by rank, leftmost first."""
    while True:
        ranks = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
        if not ranks:
            return symbols
        _, i = min(ranks)
        symbols = [*symbols[:i], pairs[symbols[i], symbols[i + 1]][1], *symbols[i + 2 :]]


@pytest.mark.parametrize("seed", range(30))
def test_small_merge_lists(seed):
    rng = random.Random(seed)
    labels, made = ["a", "b", "c"], []
    while len(made) < 12:
        u, v = rng.randrange(len(labels)), rng.randrange(len(labels))
        if labels[u] + labels[v] not in labels:
            made.append((u, v, len(labels)))
            labels.append(labels[u] + labels[v])
    automaton = merges.Automaton.compile(labels, [0, 1, 2], made)
    pairs = {(u, v): (k, uv) for k, (u, v, uv) in enumerate(made)}
    for n in range(1, 8):
        for word in itertools.product(range(3), repeat=n):
            want = by_rank(list(word), pairs)
            assert list(automaton.encode(list(word))) == want
            assert all(automaton.allows(a, b) for a, b in zip(want, want[1:]))
    # a sequence of two tokens is accepted just if it is what its text gives
    spelled = lambda t: (t,) if t < 3 else spelled(made[t - 3][0]) + spelled(made[t - 3][1])
    live = [t for t in range(len(labels)) if by_rank(list(spelled(t)), pairs) == [t]]
    for a, b in itertools.product(live, live):
        assert automaton.allows(a, b) == (by_rank([*spelled(a), *spelled(b)], pairs) == [a, b])


def test_random_texts(own, library):
    rng = random.Random(7)
    for _ in range(3000):
        letters = rng.choice(["abcdefghijklmnopqrstuvwxyz", "ao", "etaoinshr", " ab's", "é1äß日本語ΣİǅﬁΑΣ ", "!?.-=*#", "éà ", "  ​x\t\n", "😀👍🏽a "])
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 13, 60]))) + rng.choice(["", "<|endoftext|>", "<|startoftext|><|endoftext|>x"])
        want = library.encode(text, add_special_tokens=False)
        ids = own.encode(text)
        assert list(ids) == want.ids
        assert own.automaton.decode(ids.tolist()) == library.decode(want.ids, skip_special_tokens=False)


def test_own_splitting_below_its_bound(own, library):
    for code in range(merges.OWN_SPLIT):
        for text in (f"x{chr(code)}1!", f"{chr(code)}'s", f"é{chr(code)}{chr(code)} "):
            assert not own.beyond.search(text)
            assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert own.beyond.search(chr(merges.OWN_SPLIT)) and own.beyond.search(chr(sys.maxunicode))


def test_long_words(own, library):
    for text in ("ab" * 40_000, "a" * 30_001, "=" * 30_001, "the" * 30_000):
        assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_remembered_words_do_not_matter(own, library, monkeypatch):
    monkeypatch.setattr(merges, "REMEMBERED", 2)
    own.words.clear()
    own.words.old = {}
    text = "one two three four one two three"
    assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_frames(spark, library):
    texts = ["Hello, WORLD's 12", None, "", "  \n ", "x<|endoftext|>y", "word " * 20_000, "word " * 20_000]
    docs = spark.createDataFrame([(i, t, "k", "d") for i, t in enumerate(texts)] + [(0, "again", "k", None)], "doc_id long, text string, token_ids string, extra string")
    got = merges.encode(docs, decode=True)
    assert got.columns == ["doc_id", "text", "extra", "token_ids", "decoded"]
    rows = got.collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    again = merges.decode(got.select("token_ids", "decoded", "doc_id").union(spark.sql("SELECT CAST(null AS array<int>), '', 9L")))
    assert sorted(r["decoded"] for r in again.collect()) == sorted([r["decoded"] for r in rows] + [""])
    assert merges.encode(docs.where("false")).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = merges.op11_bpe(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_other_files_are_refused(tmp_path):
    with open("/opt/tokenizers/byte_bpe_50k.json") as f:
        (tmp_path / "t.json").write_text(f.read())
    with pytest.raises(ValueError, match="another kind"):
        merges.Tokenizer.load(str(tmp_path / "t.json"))
