"""BPE encoding and decoding by a tokenization automaton.

``Automaton.compile`` turns an ordered list of merges into a deterministic
automaton over tokens that accepts just the token sequences that the merges
produce (merge gadgets, applied one by one). It starts as one state with a
loop for each symbol. The merge (u, v) looks at the state that u leads to: if
v leaves it, a copy of that state without v takes its place behind u, and
every state that has an arc u gets an arc uv to where v led. All arcs of a
token lead to one state, so a state is known by the token before it, and a
copy differs from its original by one token: that token and what later merges
put behind it. In an order of tokens that lists each before those that begin
with it, latest first, these are one interval; a state is a few intervals of
tokens that do not leave it.

A word is read from left to right. Each prefix has just one sequence that the
automaton accepts, so any way to the end is the right one: at each place the
tokens that start there, taken from a trie, are tried from the longest on, and
a place from which none goes on is left for good. The time is in proportion to
the word's length.
Decoding emits the labels of the ids' arcs, joined as the library joins them.

Workers get the compiled tables (of the vocabulary's size) as a broadcast, and
remember the ids of at most ``REMEMBERED`` words; results do not depend on it.

Cases: null and empty texts have no tokens; the vocabulary's special tokens
inside a text are those tokens; very long texts and words take time in
proportion to their length; rows are kept one by one; an empty table gives no
rows; extra columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_worker, table, tidy, without

#: Words that a worker remembers, from task to task, in each of two generations.
REMEMBERED = 150_000
#: Text whose code points are below this is split by the pattern here; other text by the library's own splitter, whose
#: version of Unicode may be another (tests compare all code points).
OWN_SPLIT = 0x0558
#: Fixed value: the code points that stand for the 256 bytes in byte-level vocabularies.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = [""] * 256
for _k, _b in enumerate([*PRINTABLE, *(b for b in range(256) if b not in set(PRINTABLE))]):
    BYTE_CHARS[_b] = chr(_b) if _k < len(PRINTABLE) else chr(256 + _k - len(PRINTABLE))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _States:
    """States while merges are added: those behind a token are the versions of its list of removals."""

    def __init__(self, n_tokens: int):
        self.pair: list[tuple[int, int] | None] = [None] * n_tokens  # a merged token's parts
        self.made = [-1] * n_tokens  # number of the merge that made it
        self.removed: list[dict[int, int]] = [{} for _ in range(n_tokens)]  # token -> number of the merge that removed it
        self.base: list[tuple[int, int] | None] = [None] * n_tokens  # the state it began as: another token's, before that merge

    def lacks(self, state: int, before: int, token: int) -> bool:
        """Whether the state behind token ``state``, as it was at merge ``before``, has no arc ``token``."""
        heads, at, born = [], token, 1 << 60
        while True:
            heads.append((at, born))
            if self.pair[at] is None:
                break
            at, born = self.pair[at][0], self.made[at]
        here: tuple[int, int] | None = (state, before)
        while here is not None:
            own, limit = self.removed[here[0]], here[1]
            if own:
                for at, born in heads:
                    when = own.get(at, limit)
                    if when < limit and when <= born:  # at once for what (u, u) itself makes
                        return True
            here = self.base[here[0]] and (self.base[here[0]][0], min(limit, self.base[here[0]][1]))
        return False

    def merge(self, number: int, u: int, v: int, uv: int) -> bool:
        if self.lacks(u, number, v):
            return False  # the pair never stands in a text: earlier merges take one of its parts
        self.pair[uv], self.made[uv], self.base[uv] = (u, v), number, (v, number)
        self.removed[u][v] = number
        return True


class Automaton:
    """Arcs by trie, states by intervals, labels.

    step: trie node << 16 | symbol -> node; ends: the token that ends at a node;
    place: a token's place in the order; state: a token's state, whose tokens'
    places are outside ``edges[start[s] : start[s + 1]]`` taken as [from, until) pairs.
    """

    def __init__(self, step: dict[int, int], ends: list[int], place: list[int], state: list[int], start: list[int], edges: array, labels: list[str]):
        self.step, self.ends, self.place, self.state, self.start, self.edges, self.labels = step, ends, place, state, start, edges, labels
        self.symbols = {label: i for i, label in enumerate(labels)}

    @staticmethod
    def compile(labels: list[str], symbols: list[int], merges: list[tuple[int, int, int]]) -> Automaton:
        """labels of all ids, the ids of symbols, and (u, v, uv) ids in order of rank, each making another token."""
        if len({*symbols, *(uv for _, _, uv in merges)}) < len(symbols) + len(merges):
            raise ValueError("a token is made twice")
        states, arcs = _States(len(labels)), set(symbols)
        for number, (u, v, uv) in enumerate(merges):
            if u in arcs and v in arcs and states.merge(number, u, v, uv):
                arcs.add(uv)
        live = [*symbols, *(uv for _, _, uv in merges if uv in arcs)]
        # the order: a token, then those that begin with it, latest first; `until` ends its part
        after: dict[int, list[int]] = {}
        for t in live[len(symbols) :]:
            after.setdefault(states.pair[t][0], []).append(t)
        place, until, stack, n = [-1] * len(labels), [0] * len(labels), list(symbols), 0
        while stack:
            t = stack.pop()
            if t < 0:
                until[~t] = n
                continue
            place[t], n = n, n + 1
            stack.append(~t)
            stack.extend(after.get(t, ()))  # the latest is on top
        born = {t: [states.made[c] for c in own] for t, own in after.items()}
        edges, start, numbers, state = array("i"), [0], {}, [0] * len(labels)
        for t in live:
            here, before = t, 1 << 60
            while (own := states.base[here]) and not any(m < before for m in states.removed[here].values()):
                here, before = own[0], min(before, own[1])
            key = (here, sum(m < before for m in states.removed[here].values()))
            if key not in numbers:
                numbers[key] = len(numbers)
                spans, at = [], (here, before)
                while at is not None:
                    for gone, m in states.removed[at[0]].items():
                        if m < at[1]:
                            k = bisect_left(born.get(gone, ()), m)  # those made before stay
                            spans.append((place[gone], place[after[gone][k - 1]] if k else until[gone]))
                    at = states.base[at[0]] and (states.base[at[0]][0], min(at[1], states.base[at[0]][1]))
                for a, b in sorted(spans):
                    if len(edges) > start[-1] and a <= edges[-1]:
                        edges[-1] = max(edges[-1], b)
                    else:
                        edges.extend((a, b))
                start.append(len(edges))
            state[t] = numbers[key]
        step, ends = {}, [-1]
        parts = {s: (s,) for s in symbols}
        for t in live:
            if t not in parts:
                u, v = states.pair[t]
                parts[t] = parts[u] + parts[v]
            node = 0
            for s in parts[t]:
                node = step.setdefault(node << 16 | s, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = t
        return Automaton(step, ends, place, state, start, edges, labels)

    def allows(self, token: int, following: int) -> bool:
        s = self.state[token]
        a = self.start[s]
        return not (bisect_right(self.edges, self.place[following], a, self.start[s + 1]) - a) & 1

    def encode(self, symbols: list[int]) -> list[int]:
        """The one sequence of tokens that spells ``symbols``: the longest first, and back where no token goes on.

        The tokens before a place are the same whatever way it is reached, so a place that leads nowhere is left for good.
        """
        n, step, ends, edges, place, state, start = len(symbols), self.step.get, self.ends, self.edges, self.place, self.state, self.start
        out: list[int] = []
        open_: list[tuple[int, list[tuple[int, int]]]] = []  # places on the way, with the tokens not yet tried
        dead: set[int] = set()
        at, a, b = 0, 0, 0
        while at < n:
            node, i, found = step(symbols[at]), at, []
            while node is not None:
                i += 1
                if ends[node] >= 0:
                    found.append((ends[node], i))
                if i == n:
                    break
                node = step(node << 16 | symbols[i])
            while True:
                while found:
                    t, end = found.pop()
                    if end not in dead and not (bisect_right(edges, place[t], a, b) - a) & 1:
                        break
                else:
                    dead.add(at)
                    at, found = open_.pop()
                    out.pop()
                    s = state[out[-1]] if out else -1
                    a, b = (start[s], start[s + 1]) if out else (0, 0)
                    continue
                break
            open_.append((at, found))
            out.append(t)
            at, s = end, state[t]
            a, b = start[s], start[s + 1]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.labels.__getitem__, ids))


class Tokenizer:
    """A vocabulary file: special tokens, normal form, splitter and automaton."""

    def __init__(self, source: str, automaton: Automaton, suffix: str, special: dict[str, int], pattern: str):
        self.automaton, self.suffix, self.special = automaton, suffix, special
        self.plain = [automaton.symbols[c] for c in BYTE_CHARS]
        self.final = [automaton.symbols[c + suffix] for c in BYTE_CHARS]
        self.byte_of = {c: b for b, c in enumerate(BYTE_CHARS)}
        self.pattern = regex.compile(pattern)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.beyond = regex.compile(f"[^\\x00-\\u{OWN_SPLIT - 1:04x}]")
        self.source, self.library = source, None
        self.words = _Words(self)

    @staticmethod
    def load(path: str) -> tuple:
        """What a Tokenizer is made of; only files of byte-level BPE with ends of words and this normal form are taken."""
        with open(path, encoding="utf-8") as f:
            source = f.read()
        file = json.loads(source)
        model = file["model"]
        steps = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", ())]
        splits = (file["pre_tokenizer"] or {}).get("pretokenizers", ())
        kinds = [(s["type"], s.get("behavior"), s.get("invert"), s.get("add_prefix_space"), s.get("use_regex")) for s in splits]
        if steps != ["NFC", "Replace", "Lowercase"] or kinds != [("Split", "Removed", True, None, None), ("ByteLevel", None, None, False, False)] or file["decoder"]:
            raise ValueError(f"{path}: another kind of tokenizer")
        vocab, special = model["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
        labels = [""] * (1 + max([*vocab.values(), *special.values()]))
        for label, i in [*vocab.items(), *special.items()]:
            labels[i] = label
        suffix = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        automaton = Automaton.compile(labels, [vocab[c + s] for s in ("", suffix) for c in BYTE_CHARS], made)
        return source, automaton, suffix, special, splits[0]["pattern"]["Regex"]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-split word."""
        raw = word.encode()
        return self.automaton.encode([*map(self.plain.__getitem__, raw[:-1]), self.final[raw[-1]]])

    def _split(self, text: str) -> list[str]:
        if not self.beyond.search(text):
            normal = unicodedata.normalize("NFC", text)
            return self.pattern.findall(normal.replace("Σ", "σ").lower())  # each code point by itself: no final sigma
        if self.library is None:
            from tokenizers import Tokenizer as Library

            self.library = Library.from_str(self.source)
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in words]

    def _encode_part(self, text: str) -> bytes:
        words = self.words
        return b"".join([words[w] for w in self._split(text)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if self.specials is None or not self.specials.search(text):
            return np.frombuffer(self._encode_part(text), np.int32)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._encode_part(text[at : m.start()]), array("i", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._encode_part(text[at:])]), np.int32)


class _Words(dict):
    """Ids of words as bytes; of the words before the last ``REMEMBERED`` new ones those met since are kept."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer, self.old = tokenizer, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("i", self.tokenizer.encode_word(word)).tobytes()
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class _Shared:
    """The compiled tables as one broadcast, unpacked once in each worker."""

    def __init__(self, spark: SparkSession, path: str):
        self.broadcast, self.ident = spark.sparkContext.broadcast(Tokenizer.load(path)), uuid.uuid4().hex

    def get(self) -> Tokenizer:
        return in_worker(self.ident, lambda: Tokenizer(*self.broadcast.value))


@tidy
def _encode(batches: Iterator[pa.RecordBatch], shared: _Shared, text: str, decode: bool) -> Iterator[pa.RecordBatch]:
    tokenizer = shared.get()
    for batch in batches:
        ids = [tokenizer.encode(t or "") for t in batch.column(text).to_pylist()]
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32))
        made = {"token_ids": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))}
        if decode:
            made["decoded"] = pa.array([tokenizer.automaton.decode(x.tolist()) for x in ids], pa.string())
        yield pa.RecordBatch.from_arrays([made.get(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", decode: bool = False) -> DataFrame:
    """docs with ``token_ids`` and, if asked for, ``decoded``, made from the ids in the same pass."""
    own = {"token_ids": "array<int>"} | ({"decoded": "string"} if decode else {})
    docs = without(docs, own)
    bounded_batches(docs.sparkSession)
    shared = _Shared(docs.sparkSession, path or model_path())
    slots = docs.select("*", *(F.lit(None).cast(t).alias(c) for c, t in own.items()))
    return slots.mapInArrow(lambda b: _encode(b, shared, text, decode), slots.schema)


@tidy
def _decode(batches: Iterator[pa.RecordBatch], shared: _Shared) -> Iterator[pa.RecordBatch]:
    automaton = shared.get().automaton
    for batch in batches:
        made = [automaton.decode(ids or ()) for ids in batch.column("token_ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.string())], names=batch.schema.names)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """tokens(token_ids, ...) with ``decoded``; null ids are none."""
    bounded_batches(tokens.sparkSession)
    shared = _Shared(tokens.sparkSession, path or model_path())
    out = without(tokens, {"decoded"}).select("*", F.lit(None).cast("string").alias("decoded"))
    return out.mapInArrow(lambda b: _decode(b, shared), out.schema)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decode=True)
    ids = F.array_join(F.transform("token_ids", lambda i: i.cast("string")), " ")
    return found.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
