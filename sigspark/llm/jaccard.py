"""N-gram Jaccard join: T-occurrence search with DivideSkip.

Documents are sets of 5-word shingles; equal sets are one class, represented
by its smallest doc_id. To link (100 * intersection >= 80 * union), two sets
share at least T = ceil(0.8 n) shingles, so in any common order of shingles
they share one among the first n - T + 1 of each. The order puts shingles that
many documents have last: their counts come from all documents, and choosing
another order would change the work but not the result.

The first shingles are the short inverted lists. Within a list, members are
compared with a leader first, the one with the fewest shingles of its own;
when the components of those links are known, only pairs of different
components remain, so copies of one text cost links in proportion to their
number. Pairs whose own shingles alone make them differ too much are left out:
that bound is exact. Each query then gets its candidates' full sets:
short lists are merged by a heap, long ones probed by binary search
(DivideSkip), and a last count decides exactly.

Shingles are 64-bit hashes of words that are hashed modulo primes. There are
two independent kinds: the first finds candidates, sets are one class only if
both agree, and the last count is by the second.

Cases: null, empty and blank texts have the empty set and are linked with
nothing; fewer than five words are one shingle; repeated rows are kept, rows
that share a doc_id count as one document when links are followed, whatever
their texts; a row with null doc_id gets the component of an equal set, else null; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, in_worker, join_checked, materialize, parts_for, table, text_bytes, tidy
from .components import components
from .shingles import groups_of, rank_in_doc, set_key, shingle_sets

#: Similarity as a ratio of integers, 100 * intersection >= 80 * union.
PERCENT = 80
#: A shingle that so many documents have comes late in the order.
FREQUENT = 24
#: Entries of the table of frequent shingles that is sent to the workers; it holds 2 ** FREQUENT_BITS bits.
MOST_FREQUENT = 500_000
FREQUENT_BITS = 24
#: Shingles that a task counts before it sends the counts.
COUNTED = 500_000
#: Candidates of a query that are searched at a time and sent to one task.
CANDIDATES = 64
#: Rows up to which the list of candidates is broadcast.
BROADCAST_ROWS = 500_000


def needed(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of n with any set it links with."""
    return -(-PERCENT * n // 100)


# -- frequent shingles ----------------------------------------------------------------


@tidy
def _count_shingles(batches: Iterator[pa.RecordBatch], n_ranges: int) -> Iterator[pa.RecordBatch]:
    """For each range of shingle hashes, the low words met and their counts, as packed arrays."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        part = mix_range(values, n_ranges)
        order = np.argsort(part, kind="stable")
        values, counts, part = values[order], counts[order], part[order]
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            many = counts[a:b] > 1
            rows.append((int(part[a]), values[a:b][~many].tobytes(), values[a:b][many].tobytes(), counts[a:b][many].astype(np.uint32).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["part", "once", "many", "counts"])

    held, size = [], 0
    for batch in batches:
        for _, group in groups_of(batch.column(0).cast(pa.binary()).to_pylist()):
            _, h, _ = shingle_sets(group)
            held.append((h & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            size += len(h)
            if size >= COUNTED:
                yield packed(held)
                held, size = [], 0
    if size:
        yield packed(held)


def mix_range(low: np.ndarray, n_ranges: int) -> np.ndarray:
    return (low.astype(np.uint64) * np.uint64(n_ranges)) >> np.uint64(32)


def _sum_counts(tab: pa.Table) -> pa.Table:
    once = [np.frombuffer(x.as_py(), np.uint32) for x in tab.column("once")]
    many = [np.frombuffer(x.as_py(), np.uint32) for x in tab.column("many")]
    counts = np.concatenate([np.ones(sum(map(len, once)), np.uint32), *(np.frombuffer(x.as_py(), np.uint32) for x in tab.column("counts"))])
    values = np.concatenate([*once, *many])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    total = np.add.reduceat(counts.astype(np.int64), at)
    full = total >= FREQUENT
    return pa.table({"low": pa.array(values[at][full].astype(np.int64)), "n": pa.array(total[full])})


def frequent_bits(docs: DataFrame) -> np.ndarray:
    """Bit table of the low hash words of the most frequent shingles, counted over all documents."""
    spark = docs.sparkSession
    # about a shingle a word, four bytes each
    n_ranges = parts_for(spark, text_bytes(docs))
    counts = docs.select("text").mapInArrow(lambda b: _count_shingles(b, n_ranges), "part long, once binary, many binary, counts binary")
    found = materialize(counts.repartition(n_ranges, "part").groupBy("part").applyInArrow(_sum_counts, "low long, n long"), "frequent", narrow=True)
    by_size = found.groupBy(F.floor(F.log2("n")).alias("k")).count().orderBy(F.desc("k")).collect()  # a row for each power of two
    least, held = 0, 0
    for row in by_size:
        held += row["count"]
        if held > MOST_FREQUENT:
            least = 2 ** (row["k"] + 1)
            break
    bits = np.zeros(1 << FREQUENT_BITS, bool)
    chosen = found.where(F.col("n") >= least).select("low").toArrow().column("low").to_numpy()
    bits[chosen & ((1 << FREQUENT_BITS) - 1)] = True
    return np.packbits(bits)


# -- sets and their first shingles ------------------------------------------------------


class _Bits:
    """A broadcast bit table, unpacked once in each worker."""

    def __init__(self, spark: SparkSession, bits: np.ndarray):
        self.broadcast, self.ident = spark.sparkContext.broadcast(bits), uuid.uuid4().hex

    def get(self) -> np.ndarray:
        return in_worker(self.ident, lambda: np.unpackbits(self.broadcast.value).astype(bool))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


#: light: infrequent shingles of the set if the prefix holds them all, else -1.
SETS_DDL = "doc_id long, n long, key1 long, key2 long, light long, prefix array<long>"


@tidy
def _prefixes(batches: Iterator[pa.RecordBatch], shared: _Bits) -> Iterator[pa.RecordBatch]:
    bits, mask = shared.get(), np.uint64((1 << FREQUENT_BITS) - 1)
    for batch in batches:
        for at, group in groups_of(batch.column(1).cast(pa.binary()).to_pylist()):
            doc, h, n, g = shingle_sets(group, (0, 1))
            key1, key2 = set_key(doc, h, len(group)), set_key(doc, g, len(group))
            late = bits[h & mask]
            order = np.lexsort((h, late, doc))
            doc, h = doc[order], h[order]
            size = n - needed(n) + 1
            early = rank_in_doc(doc) < size[doc]
            light = np.bincount(doc[~late[order]], minlength=len(group))
            light[light > size] = -1
            prefix = _lists(h[early].view(np.int64), np.bincount(doc[early], minlength=len(group)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), pa.array(n), pa.array(key1.view(np.int64)), pa.array(key2.view(np.int64)), pa.array(light), prefix], names=["doc_id", "n", "key1", "key2", "light", "prefix"])


@tidy
def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, group in groups_of(batch.column(1).cast(pa.binary()).to_pylist()):
            doc, h, n = shingle_sets(group, (1,))
            cuts = np.concatenate(([0], np.cumsum(n)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), pa.array([h[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], names=["rep", "hashes"])


# -- candidates -----------------------------------------------------------------------


def _partition(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    batches = list(batches)
    return pa.Table.from_batches(batches) if batches else None


@tidy
def _shared_lists(batches: Iterator[pa.RecordBatch], shared: _Bits) -> Iterator[pa.RecordBatch]:
    """The rows of shingles that two documents or more have, and whether these are infrequent ones."""
    tab = _partition(batches)
    if tab is None:
        return
    token = tab.column("token").to_numpy()
    order = np.argsort(token, kind="stable")
    t = token[order]
    same = t[1:] == t[:-1]
    keep = np.zeros(len(t), bool)
    keep[1:] |= same
    keep[:-1] |= same
    tab = tab.take(pa.array(np.sort(order[keep])))
    late = shared.get()[tab.column("token").to_numpy() & ((1 << FREQUENT_BITS) - 1)]
    yield from tab.append_column("is_light", pa.array((~late).astype(np.int64))).to_batches(max_chunksize=50_000)


def _sorted_groups(tab: pa.Table, *by: str) -> tuple[dict[str, np.ndarray], np.ndarray]:
    cols = {c: tab.column(c).to_numpy() for c in tab.column_names}
    order = np.lexsort((*(cols[c] for c in reversed(by)), cols["token"]))
    cols = {c: v[order] for c, v in cols.items()}
    cuts = np.flatnonzero(np.concatenate(([True], cols["token"][1:] != cols["token"][:-1], [True])))
    return cols, cuts


def _pair_batches(a: list[np.ndarray], b: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if a:
        pairs = np.unique(np.stack((np.concatenate(a), np.concatenate(b)), 1), axis=0)
        for at in range(0, len(pairs), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[at : at + 50_000, 0]), pa.array(pairs[at : at + 50_000, 1])], names=["a", "b"])


def _may_link(na, nb, alone_a, alone_b):
    """Sizes fit, and the infrequent shingles that only one of both has are no more than their difference may be.

    Those of a document are known to be its alone if its prefix and the other's
    hold all their infrequent shingles (alone >= 0 for both).
    """
    known = (alone_a >= 0) & (alone_b >= 0)
    return (PERCENT * np.maximum(na, nb) <= 100 * np.minimum(na, nb)) & ~(known & ((100 + PERCENT) * (alone_a + alone_b) > (100 - PERCENT) * (na + nb)))


@tidy
def _leader_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each list, the pair of each member with the first leader that it may link with.

    Members come by the share of shingles that they alone have: an original
    has none, so it leads before the copies that were changed.
    """
    tab = _partition(batches)
    if tab is None:
        return
    alone = tab.column("alone").to_numpy()
    tab = tab.append_column("share", pa.array(np.where(alone < 0, 2.0, alone / tab.column("n").to_numpy())))
    cols, cuts = _sorted_groups(tab, "share", "rep")
    n, rep, alone, left, right = cols["n"], cols["rep"], cols["alone"], [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        open_ = np.arange(a, b)
        while len(open_) > 1:
            i, rest = open_[0], open_[1:]
            fit = _may_link(n[i], n[rest], alone[i], alone[rest])
            if fit.any():
                right.append(rep[rest[fit]])
                left.append(np.full(int(fit.sum()), rep[i]))
            open_ = rest[~fit]
    yield from _pair_batches(left, right)


@tidy
def _other_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each list, the pairs of different components whose sizes, places and own shingles allow a link."""
    tab = _partition(batches)
    if tab is None:
        return
    cols, cuts = _sorted_groups(tab, "n", "rep")
    n, rep, pos, comp, alone = (cols[c] for c in ("n", "rep", "pos", "comp", "alone"))
    left, right, held = [], [], 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if (comp[a:b] == comp[a]).all():
            continue
        for i in range(a, b - 1):
            end = a + int(np.searchsorted(n[a:b], n[i] * 100 // PERCENT, "right"))
            if end <= i + 1:
                continue
            j = slice(i + 1, end)
            most = np.minimum(n[i] - pos[i], n[j] - pos[j])
            fit = (comp[j] != comp[i]) & (100 * most >= PERCENT * (n[i] + n[j] - most)) & _may_link(n[i], n[j], alone[i], alone[j])
            if fit.any():
                right.append(rep[j][fit])
                left.append(np.full(int(fit.sum()), rep[i]))
                held += len(right[-1])
        if held > 500_000:
            yield from _pair_batches(left, right)
            left, right, held = [], [], 0
    yield from _pair_batches(left, right)


@tidy
def _plausible(batches: Iterator[pa.RecordBatch], shared: _Bits) -> Iterator[pa.RecordBatch]:
    """Pairs that differ little enough in the part of the order that both prefixes cover.

    Sets that link differ in at most a ninth of their summed sizes, so a larger
    difference in that part alone rules the pair out.
    """
    bits, mask = shared.get(), np.uint64((1 << FREQUENT_BITS) - 1)

    def side(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
        col = batch.column(name)
        h = col.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        return (bits[h & mask].astype(np.uint64) << np.uint64(63)) | (h >> np.uint64(1)), np.concatenate(([0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))))

    for batch in batches:
        (left, lcut), (right, rcut) = side(batch, "left"), side(batch, "right")
        n = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
        keep = np.zeros(len(n), bool)
        for i in range(len(n)):
            x, y = left[lcut[i] : lcut[i + 1]], right[rcut[i] : rcut[i + 1]]
            end = min(x[-1], y[-1])
            x, y = x[: np.searchsorted(x, end, "right")], y[: np.searchsorted(y, end, "right")]
            merged = np.concatenate((x, y))
            merged.sort()
            both = int((merged[1:] == merged[:-1]).sum())
            keep[i] = (100 + PERCENT) * (len(merged) - 2 * both) <= (100 - PERCENT) * n[i]
        yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[keep]) for c in ("a", "b")], names=["a", "b"])


# -- T-occurrence search ----------------------------------------------------------------


def divide_skip(lists: list[np.ndarray], least: int) -> dict[int, int]:
    """Records that occur in at least ``least`` of the sorted lists, with their counts.

    The longest lists are set aside; the others are merged by a heap, and what
    reaches the rest of the threshold is looked up in the long ones.
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    if not lists or least > len(lists):
        return {}
    n_long = min(max(0, least - 1), int(least / (0.01 * np.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    found: dict[int, int] = {}
    last, count = None, 0
    merged = heapq.merge(*(x.tolist() for x in short))
    for record in merged:
        if record == last:
            count += 1
            continue
        if last is not None and count >= least - n_long:
            found[last] = count
        last, count = record, 1
    if last is not None and count >= least - n_long:
        found[last] = count
    if not found:
        return {}
    records = np.fromiter(found, np.int64, len(found))
    counts = np.fromiter(found.values(), np.int64, len(found))
    for x in long:
        at = np.searchsorted(x, records)
        counts += (at < len(x)) & (x[np.minimum(at, len(x) - 1)] == records)
    return {int(r): int(c) for r, c in zip(records, counts, strict=True) if c >= least}


def linked(query: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Numbers of the sets that link with the query set."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(query, tokens), len(query) - 1)
    shared = query[at] == tokens
    at, owner = at[shared], owner[shared]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    cuts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1], [True]))) if len(at) else np.zeros(1, np.int64)
    lists = [owner[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    hits = divide_skip(lists, int(needed(np.int64(len(query)))))
    return [k for k, both in hits.items() if 100 * both >= PERCENT * (len(query) + len(sets[k]) - both)]


@tidy
def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by a and cut: its own set first (b null; several where rows share its doc_id), then the sets of its candidates."""
    query, queries, ids, sets = (None, None), [], [], []

    def flush() -> pa.RecordBatch:
        good = sorted({ids[k] for q in queries for k in linked(q, sets)}) if sets else []
        return pa.RecordBatch.from_arrays([pa.array([query[0]] * len(good), pa.int64()), pa.array(good, pa.int64())], names=["u", "v"])

    for batch in batches:
        for a, cut, b, hashes in zip(*(batch.column(c).to_pylist() for c in ("a", "cut", "b", "hashes")), strict=True):
            if (a, cut) != query or len(sets) == CANDIDATES:
                yield flush()
                ids, sets = [], []
            if (a, cut) != query:
                query, queries = (a, cut), []
            if b is None:
                queries.append(np.frombuffer(hashes, np.uint64))
            else:
                ids.append(b)
                sets.append(np.frombuffer(hashes, np.uint64))
    yield flush()


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of the pairs(a, b) that link; sets(rep, hashes) holds both sides.

    A query with many candidates is dealt out in cuts, its own set sent to each.
    """
    cuts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CANDIDATES).cast("long").alias("cuts"))
    cut = F.pmod(F.xxhash64("b"), F.col("cuts")).alias("cut")
    candidates = pairs.join(cuts, "a").select("a", "b", cut).join(sets, F.col("b") == F.col("rep")).select("a", "cut", "b", "hashes")
    queries = sets.join(cuts, F.col("rep") == F.col("a")).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"), F.lit(None).cast("long").alias("b"), "hashes")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = candidates.unionByName(queries).repartition(n, "a", "cut").sortWithinPartitions("a", "cut", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(_verify, "u long, v long")


# -- the join ---------------------------------------------------------------------------

#: Bytes of a row of the lists of documents by shingle.
LIST_BYTES = 48


class _Search:
    """Classes of equal sets, their lists, and the search for links between classes."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.docs = docs.select("doc_id", "text")
        bounded_batches(spark)
        self.bits = bits = _Bits(spark, frequent_bits(self.docs))
        self.sets = materialize(self.docs.mapInArrow(lambda b: _prefixes(b, bits), SETS_DDL), "prefixes")
        classes = self.sets.where("n > 0").groupBy("key1", "key2", "n").agg(F.min("doc_id").alias("rep"), F.any_value("light").alias("light"), F.any_value("prefix").alias("prefix"))
        self.classes = materialize(classes, "classes")
        listed = self.classes.agg(F.sum(F.size("prefix"))).first()[0] or 0
        self.n_parts = n_parts = parts_for(spark, listed * LIST_BYTES)
        tokens = self.classes.where("rep IS NOT NULL").select("rep", "n", "light", F.posexplode("prefix").alias("pos", "token"))
        lists = tokens.select("token", "rep", "n", "light", F.col("pos").cast("long").alias("pos")).repartition(n_parts, "token")
        lists = materialize(lists.mapInArrow(lambda b: _shared_lists(b, bits), "token long, rep long, n long, light long, pos long, is_light long"), "lists")
        alone = F.when(F.col("light") < 0, -1).otherwise(F.col("light") - F.sum("is_light"))
        known = materialize(lists.groupBy("rep", "n", "light").agg(alone.alias("alone")), "alone")
        self.lists = join_checked(lists.drop("is_light"), known, ["rep", "n", "light"], "inner", BROADCAST_ROWS).select("token", "rep", "n", "pos", "alone")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link: first what the prefixes allow, then by full sets, made for what is left."""
        bits = self.bits
        met = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        prefixes = join_checked(self.classes.select("rep", "n", "prefix"), met, "rep", "left_semi", BROADCAST_ROWS)
        sided = pairs.join(prefixes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("left")), "a")
        sided = sided.join(prefixes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("right")), "b")
        likely = materialize(sided.select("a", "b", "na", "nb", "left", "right").mapInArrow(lambda b: _plausible(b, bits), "a long, b long").distinct(), "likely")
        ends = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        full = join_checked(self.docs, ends, "doc_id", "left_semi", BROADCAST_ROWS)
        full = materialize(full.mapInArrow(_full_sets, "rep long, hashes binary").where("length(hashes) > 0"), "sets")
        return materialize(verify(likely, full), "links", narrow=True)

    def shared_ids(self) -> DataFrame:
        """(u, v): each doc_id that rows of different sets share, with the representatives of their classes."""
        own = self.sets.where("n > 0 AND doc_id IS NOT NULL")
        several = own.groupBy("doc_id").agg(F.min("key1").alias("least"), F.max("key1").alias("most")).where("least <> most").select("doc_id")
        several = materialize(several, "shared-ids")
        rows = join_checked(own.select("doc_id", "key1", "key2", "n"), several, "doc_id", "left_semi", BROADCAST_ROWS).distinct()
        return rows.join(self.classes.select("key1", "key2", "n", "rep"), ["key1", "key2", "n"]).select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).where("u <> v").distinct()

    def with_leaders(self) -> tuple[DataFrame, DataFrame]:
        """Pairs of members of a list with its leaders, and those of them that link."""
        pairs = self.lists.repartition(self.n_parts, "token").mapInArrow(_leader_pairs, "a long, b long").distinct().where("a <> b")
        pairs = materialize(pairs, "pairs")
        return pairs, self.confirmed(pairs)

    def others(self, done: DataFrame, group: DataFrame | None) -> DataFrame:
        """Further links: pairs of a list that are not done, of different groups(rep, comp) if given."""
        lists = self.lists.withColumn("comp", F.col("rep"))
        if group is not None:
            lists = join_checked(self.lists, group, "rep", "left", BROADCAST_ROWS).withColumn("comp", F.coalesce("comp", "rep"))
        rest = lists.select("token", "rep", "n", "pos", "alone", "comp").repartition(self.n_parts, "token").mapInArrow(_other_pairs, "a long, b long").distinct().where("a <> b")
        return self.confirmed(materialize(rest.join(done, ["a", "b"], "left_anti"), "pairs"))

    def rows(self, of_class: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, and the other columns of of_class(rep, ...)) for each row; null without shingles."""
        named = self.classes.select("key1", "key2", "n", "rep").join(of_class, "rep", "left")
        out = self.sets.select("doc_id", "key1", "key2", "n").join(named, ["key1", "key2", "n"], "left")
        return out.drop("key1", "key2").withColumnRenamed("n", "n_shingles")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs(doc_id, text)."""
    search = _Search(docs)
    same = materialize(search.shared_ids(), "links")
    pairs, links = search.with_leaders()
    links = links.unionByName(same)
    group = components(links).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    links = links.unionByName(search.others(pairs, group))
    group = materialize(components(links).select(F.col("node").alias("rep"), F.col("component").alias("comp")), "components")
    out = search.rows(group)
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("comp", "rep")).otherwise(F.col("doc_id")).alias("component_id"))


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, (u, v) with u < v by class representative, and (doc_id, n_shingles, rep, n_links) for each row.

    n_links counts the classes that the row's class links with; rows of one
    class are equal and not listed as pairs. Near copies of one text are
    compared pair by pair here, as each pair may be a link to report.
    """
    search = _Search(docs)
    pairs, links = search.with_leaders()
    links = links.unionByName(search.others(pairs, None))
    links = materialize(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "links")
    counts = links.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    return links, search.rows(counts).select("doc_id", "n_shingles", "rep", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


OP9_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, r, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0
), n AS (SELECT doc_id, r, count(*) AS n FROM s GROUP BY doc_id, r),
l AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r
  GROUP BY a.doc_id, b.doc_id, a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), c(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT l.v, c.root FROM c JOIN l ON l.u = c.doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON n.r = d.r JOIN (SELECT doc_id, min(root) AS component_id FROM c GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
