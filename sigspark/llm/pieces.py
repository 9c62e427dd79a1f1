"""SentencePiece encoding and decoding by a relational lattice.

A text is normalised as the model asks (spaces become U+2581, one is put in
front) and falls into words: a run of U+2581 and what follows up to the next.
No piece of the vocabulary crosses a word. For the words of the corpus, Spark
explodes the substrings of bounded length, equi-joins them with the piece
table (a fixed vocabulary, broadcast), groups the edges by word without
another shuffle and folds each word's lattice with ``aggregate``.

The vocabulary at hand is a merge (BPE) model: its scores are an order of
merges, not log probabilities, so the path of largest summed score would not
give the library's ids. The fold therefore keeps the method's shape and takes
the model's rule: its state is the set of open boundaries, and each step closes
the boundary inside the best-ranked edge that spans just two symbols.

The commonest ``TABLE_WORDS`` words are encoded that way and sent to the
workers as a table of bounded size; each worker folds the remaining words it
meets by the same rule in memory (see the README for why those are not joined
back by a shuffle), as it does words beyond ``MASK_BITS`` characters.

Cases: null and empty texts have no tokens; characters that no piece has
become byte tokens; U+2581 itself is read as a space, as by the library; rows
are kept one by one; an empty table gives no rows; extra columns are kept,
those named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_worker, materialize, table, tidy, without

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Words that are sent to the workers, and characters that a word of the lattice has at most (bits of its state).
TABLE_WORDS = 300_000
MASK_BITS = 60
#: Above all merge ranks.
NEVER = 1 << 30
#: Distinct words that a task counts before it hands them on.
FLUSH_WORDS = 300_000


class Vocabulary:
    """Pieces with their ids and merge ranks: equal scores share a rank, the leftmost merges first."""

    def __init__(self, ids: dict[str, int], ranks: dict[str, int], names: list[bytes], byte_ids: list[int], unknown: int):
        self.ids, self.ranks, self.names, self.byte_ids, self.unknown = ids, ranks, names, byte_ids, unknown
        self.longest = max(map(len, ids), default=1)

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids: dict[str, int] = {}
        byte_ids, names = [-1] * 256, []
        for i in range(m.vocab_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                names.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i):
                names.append(b"")
            else:
                ids[piece] = i
                names.append(piece.replace(SPACE, " ").encode())
        order = {s: k for k, s in enumerate(sorted({m.get_score(i) for i in ids.values()}, reverse=True))}
        return Vocabulary(ids, {p: order[m.get_score(i)] for p, i in ids.items()}, names, byte_ids, m.unk_id())

    def fold(self, word: str) -> list[str]:
        """Symbols of a word: as ``encode_words``, but only edges that span two symbols are looked up, those beside the last merge anew."""
        if len(word) > MASK_BITS:
            return self._fold_long(word)
        symbols, rank = list(word), self.ranks.get
        ranks = list(map(rank, map(add, word, word[1:]), repeat(NEVER)))
        while ranks and (best := min(ranks)) != NEVER:
            at = ranks.index(best)
            symbols[at] = joined = symbols[at] + symbols.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(joined + symbols[at + 1], NEVER)
            if at:
                ranks[at - 1] = rank(symbols[at - 1] + joined, NEVER)
        return symbols

    def _fold_long(self, word: str) -> list[str]:
        """The same with a heap over linked symbols."""
        text: list[str | None] = list(word)
        left, right = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and (r := self.ranks.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (r, i, len(text[i]), len(text[j])))

        for i in range(len(text) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if text[i] is None or len(text[i]) != a or j < 0 or len(text[j]) != b:
                continue
            text[i] += text[j]
            text[j], right[i] = None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [t for t in text if t is not None]

    def encode_word(self, word: str) -> list[int]:
        out: list[int] = []
        for s in self.fold(word):
            i = self.ids.get(s)
            out.extend([i] if i is not None else [self.byte_ids[b] for b in s.encode()])
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes of ids, with the space that the normal form puts in front."""
        return b"".join(map(self.names.__getitem__, ids))

    def shared(self) -> tuple:
        return self.ids, self.ranks, self.names, self.byte_ids, self.unknown


def keys_of(text: str) -> list[str]:
    """Words of a text that is not empty, each without the first of its leading U+2581."""
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in WORD.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


@tidy
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        items = list(counts.items())
        for at in range(0, len(items), 50_000):
            words, n = zip(*items[at : at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([SPACE + w for w in words], pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(keys_of(text))
        if len(counts) > FLUSH_WORDS:
            yield from out()
            counts.clear()
    yield from out()


def _bits(at: Column, n: Column) -> Column:
    """n ones from bit at on."""
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", F.call_function("shiftleft", one, n) - 1, at)


def encode_words(words: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(word, n, ids) of words(word, n), grouped by word, of at most MASK_BITS characters."""
    spark = words.sparkSession
    pieces = spark.createDataFrame(pa.table({"piece": list(vocab.ids), "id": pa.array(vocab.ids.values(), pa.int32()), "rank": pa.array([vocab.ranks[p] for p in vocab.ids], pa.int32())}))
    size = F.length("word")
    starts = words.select("word", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"))
    parts = starts.select("word", "n", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(vocab.longest), size - F.col("at")))).alias("len"))
    parts = parts.withColumn("piece", F.substring("word", F.col("at") + 1, F.col("len")))
    edge = F.struct("rank", "at", "len", "id", _bits(F.col("at") + 1, F.col("len") - 1).alias("inner"), (_bits(F.col("at"), F.lit(1)) + _bits(F.col("at") + F.col("len"), F.lit(1))).alias("ends"))
    edges = parts.join(F.broadcast(pieces), "piece", "left").groupBy("word", "n").agg(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), edge))).alias("edges"))

    def step(mask: Column, _: Column) -> Column:
        fits = F.filter("edges", lambda e: (mask.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(mask.bitwiseAND(e["inner"])) == 1))
        return mask.bitwiseAND(F.bitwise_not(F.coalesce(F.get(fits, F.lit(0))["inner"], F.lit(0).cast("long"))))

    merges = F.when(size > 1, F.sequence(F.lit(2), size)).otherwise(F.array().cast("array<int>"))
    folded = edges.withColumn("mask", F.aggregate(merges, _bits(F.lit(0), size + 1), step))
    byte_ids = F.array(*map(F.lit, vocab.byte_ids))

    def symbol(at: Column) -> Column:
        own = F.get(F.filter("edges", lambda e: (e["at"] == at) & (F.col("mask").bitwiseAND(e["ends"]) == e["ends"]) & (F.col("mask").bitwiseAND(e["inner"]) == 0)), F.lit(0))["id"]
        code = F.hex(F.encode(F.substr("word", at + 1, F.lit(1)), "UTF-8"))
        raw = F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda k: F.get(byte_ids, F.conv(F.substr(code, (2 * k + 1).cast("int"), F.lit(2)), 16, 10).cast("int")))
        return F.when(own.isNotNull(), F.array(own)).otherwise(raw)

    open_ = F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.col("mask").bitwiseAND(_bits(i, F.lit(1))) != 0)
    return folded.select("word", "n", F.flatten(F.transform(open_, symbol)).alias("ids"))


def word_table(docs: DataFrame, vocab: Vocabulary, text: str = "text") -> DataFrame:
    """(word, n, ids) of the TABLE_WORDS commonest words of all documents."""
    spark = docs.sparkSession
    bounded_batches(spark)
    counted = docs.select(text).mapInArrow(_count_words, "word string, n long").where(F.length("word") <= MASK_BITS)
    counted = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # the least count that leaves at most TABLE_WORDS words, by powers of two: a few rows
    least, held = 0, 0
    for row in counted.groupBy(F.floor(F.log2("n")).alias("k")).count().orderBy(F.desc("k")).collect():
        held += row["count"]
        if held > TABLE_WORDS:
            least = 2 ** (row["k"] + 1)
            break
    common = counted.where(F.col("n") >= least)
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "50000")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(encode_words(common.repartition(n, "word"), vocab), "encoded")


class _Shared:
    """Vocabulary and word table as one broadcast of bounded size, unpacked once in each worker: words by their keys."""

    def __init__(self, vocab: Vocabulary, words: DataFrame):
        got = words.select("word", "ids").toArrow()
        ids = got.column("ids").combine_chunks()
        names = got.column("word").combine_chunks().cast(pa.binary())
        flat = lambda x, kind: x.flatten().to_numpy().astype(kind)
        packed = (b"".join(names.to_pylist()), np.array([len(w) for w in names.to_pylist()], np.int32), ids.value_lengths().to_numpy().astype(np.int32), flat(ids, np.int32)) if got.num_rows else None
        self.broadcast, self.ident = words.sparkSession.sparkContext.broadcast((vocab.shared(), packed)), uuid.uuid4().hex

    def _unpack(self) -> tuple[Vocabulary, dict[str, bytes]]:
        vocab, packed = self.broadcast.value
        if packed is None:
            return Vocabulary(*vocab), {}
        names, name_sizes, sizes, ids = packed
        ends, cuts = np.cumsum(name_sizes).tolist(), np.concatenate(([0], np.cumsum(sizes))).tolist()
        own = (names[a:b].decode()[1:] for a, b in zip([0, *ends], ends))
        return Vocabulary(*vocab), {w: ids[a:b].tobytes() for w, a, b in zip(own, cuts[:-1], cuts[1:], strict=True)}

    def get(self) -> _Words:
        return in_worker(self.ident, lambda: _Words(*self._unpack()))


#: Words beside the table's that a worker remembers, from task to task, in each of two generations.
REMEMBERED = 100_000


class _Words(dict):
    """Ids of words by key: the shared table's, and those folded here, of which the ones met lately are kept."""

    def __init__(self, vocab: Vocabulary, known: dict[str, bytes]):
        super().__init__()
        self.vocab, self.known, self.old = vocab, known, {}

    def __missing__(self, key: str) -> bytes:
        got = self.known.get(key)
        if got is not None:
            return got
        got = self.old.get(key)
        if got is None:
            got = array("i", self.vocab.encode_word(SPACE + key)).tobytes()
        if len(key) <= MASK_BITS:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


@tidy
def _encode(batches: Iterator[pa.RecordBatch], shared: _Shared, text: str, decode: bool, digest: bool) -> Iterator[pa.RecordBatch]:
    words = shared.get()
    vocab = words.vocab
    first = min(vocab.byte_ids)
    for batch in batches:
        ids, same = [], []
        for t in batch.column(text).to_pylist():
            keys = keys_of(t) if t else []
            ids.append(np.frombuffer(b"".join([words[k] for k in keys]), np.int32))
            same.append(vocab.decode(ids[-1].tolist())[1:] == (t or "").encode() if decode else None)
        made = {"round_trip": pa.array(same, pa.bool_())}
        if digest:
            made["n_tokens"] = pa.array(map(len, ids), pa.int64())
            made["n_byte_tokens"] = pa.array([int(((x >= first) & (x < first + 256)).sum()) for x in ids], pa.int64())
            made["ids_sha256"] = pa.array([hashlib.sha256(x.astype("<i4", copy=False).tobytes()).hexdigest() for x in ids], pa.string())
        else:
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32))
            made["token_ids"] = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        yield pa.RecordBatch.from_arrays([made.get(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", decode: bool = True, digest: bool = False) -> DataFrame:
    """docs with ``token_ids`` and, if asked for, ``round_trip``: whether decoding them gives the text back.

    With ``digest`` the ids stay in the worker and their number, the number of
    byte tokens and a SHA-256 of the ids as little-endian 32-bit words come instead.
    """
    own = {"n_tokens": "bigint", "n_byte_tokens": "bigint", "ids_sha256": "string"} if digest else {"token_ids": "array<int>"}
    own["round_trip"] = "boolean"
    docs = without(docs, own)
    bounded_batches(docs.sparkSession)
    vocab = Vocabulary.load(model)
    shared = _Shared(vocab, word_table(docs, vocab, text))
    slots = docs.select("*", *(F.lit(None).cast(t).alias(c) for c, t in own.items()))
    return slots.mapInArrow(lambda b: _encode(b, shared, text, decode, digest), slots.schema)


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """tokens(token_ids, ...) with ``decoded``."""
    names = Vocabulary.load(model).names
    shared = tokens.sparkSession.sparkContext.broadcast(names)
    out = without(tokens, {"decoded"}).select("*", F.lit(None).cast("string").alias("decoded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [b"".join(shared.value[i] for i in ids or ())[1:].decode("utf-8", "replace") for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.string())], names=batch.schema.names)

    return out.mapInArrow(run, out.schema)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return found.select("doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip")
