"""Operator 4: near duplicates by ProbMinHash.

A document is the multiset of its 5-word shingles (words in ASCII lower case;
fewer than five words make one shingle). Its sketch estimates the probability
Jaccard similarity J_P of such multisets: every shingle d of weight w_d runs a
Poisson process of rate w_d / sum(w); an arrival falls on one of the
registers, and a register keeps the shingle that arrives first. A document
stops following a shingle once its next arrival lies behind the latest first
arrival of all registers (early termination); arrivals are drawn from hashes
of the shingle, so equal shingles arrive alike everywhere. Two registers agree
with probability J_P.

1. One pass gives every document a digest of its words and ``bands`` keys of
   ``rows`` registers each; a text that repeats a shingle has as many again from
   the process with all weights 1, whose registers agree with the probability
   of the plain Jaccard similarity (without repeats the two are equal). Equal digests are one node from here on (the least
   row number); within a batch only the first of them is sketched.
2. Documents that share a band key are candidates. A key of up to ``small``
   documents gives all its pairs, a larger one connects its members to two
   hubs (the least id and one drawn per key). Keys are counted with map-side
   sums; members meet their key's counts in a join whose hot keys Spark splits.
3. Pairs are verified on whole texts: linked if J_P or the plain Jaccard
   similarity of the shingle sets reaches ``threshold``. First the pairs that
   share most keys, ``per_round`` per document; what holds is linked, all pairs
   that are now within one class need no look, and all others are verified.
4. Members of a large key that are not all one class by now (a family with a
   common template, say) are split by their shingles. A shingle of up to
   ``small`` of these documents is rare. Shingles are ordered rare first; two
   documents that reach the threshold share a shingle ahead of the last
   ``threshold`` of either (by number, or by weight, as J_P is at most the sum
   of the lesser weights). If one is rare, they meet in its group, which gives
   all its pairs. If not, they share no rare shingle at all, and the common
   ones alone reach the threshold. Then each is also like the document with
   the same common shingles and the fewest (or least weight of) rare ones: all
   members are compared with that head and with those other heads of their keys,
   of other classes, that their numbers of common and rare shingles and bit masks
   of the common ones let them reach; these meet by size. Likewise two documents with a rare shingle in
   common are compared only if what lies behind it in both is enough.
5. Classes are connected components of the links, by least-label steps with
   pointer jumping. Links, labels and pairs are kept as Parquet tables, so
   Spark knows their sizes and shuffles small ones in no join.

Nothing of this is collected: the driver sees only whether tables are empty. The
first pass writes the rows with their numbers, digests and keys as a table; texts
are found there by row number, so copies of a text meet nowhere, and the numbers
are broadcast only if Spark measures them as small.

Nulls and edge cases: a null text counts as empty, and all texts without
words are one class, led by the null id if one of them has it; any other class
is named by its least doc_id that is not null (null only if it has no other);
rows are judged by their texts, so unlike rows that share a doc_id, or have
none, go to classes of their own and each class keeps one row; equal texts
share a class whatever their ids; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import (
    U64,
    HashedWords,
    Tables,
    binary_values,
    checkpointed,
    components,
    mix,
    read_table,
    signed,
    split_docs,
    text_slices,
)


@dataclass(frozen=True)
class Params:
    words: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 5
    small: int = 16
    per_round: int = 4


PRODUCTION = Params()
BLOCK_BYTES = 1 << 20
# Pairs whose texts a task takes out of a batch at once.
PAIRS_AT_ONCE = 128
# Rows in an Arrow batch: texts are long, and a batch is held several times.
BATCH_ROWS = 1024
# Steps of size by which documents meet heads.
SIZE_STEP = 1.05
# 64-bit words that mark a document's common shingles.
MASKS = 8


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int):
    """(hash, document) of every shingle occurrence."""
    doc = np.repeat(np.arange(len(counts)), counts)
    if len(hashes) >= k:
        h = np.full(len(hashes) - k + 1, U64(k))
        for j in range(k):
            h = mix(h, hashes[j : j + len(h)])
        inside = doc[: len(h)] == doc[k - 1 :]
        h, d = h[inside], doc[: len(h)][inside]
    else:
        h, d = np.zeros(0, U64), np.zeros(0, np.int64)
    # documents of fewer words: all of them are one shingle
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        start = np.cumsum(counts) - counts
        own = np.full(len(short), U64(1))
        for j in range(k - 1):
            more = counts[short] > j
            at = np.minimum(start[short] + j, len(hashes) - 1)
            own = np.where(more, mix(own, hashes[at]), own)
        h, d = np.append(h, own), np.append(d, short)
    return h, d


def weighted(h: np.ndarray, d: np.ndarray):
    """Distinct (hash, document) with their number of occurrences."""
    if not len(h):
        return h, d, np.zeros(0)
    key = mix(h, d.astype(U64))
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return h[first], d[first], n.astype(np.float64)


def sketch(h: np.ndarray, d: np.ndarray, w: np.ndarray, docs: int, k: int) -> np.ndarray:
    """(docs, k) registers: the hash of the shingle that arrives first."""
    total = np.bincount(d, weights=w, minlength=docs)
    best = np.full(docs * k, np.inf)
    winner = np.zeros(docs * k, U64)
    gap = total[d] / w  # mean time between a shingle's arrivals
    time = np.zeros(len(h))
    live = np.arange(len(h))
    step = 0
    while len(live):
        step += 1
        z = mix(h[live], U64(0x51ED270B0B1F39A7 + 2 * step))
        u = ((z >> U64(24)).astype(np.float64) + 0.5) * 2.0**-40
        time[live] -= np.log(u) * gap[live]
        slot = d[live] * k + (z & U64(0xFFFFFF)).astype(np.int64) % k
        t = time[live]
        np.minimum.at(best, slot, t)
        first = best[slot] == t
        winner[slot[first]] = h[live[first]]
        latest = best.reshape(docs, k).max(axis=1)
        live = live[t <= latest[d[live]]]
    return winner.reshape(docs, k)


def band_keys(registers: np.ndarray, params: Params) -> np.ndarray:
    """(docs, bands) keys of ``rows`` registers each."""
    out = np.empty((len(registers), params.bands), U64)
    for b in range(params.bands):
        key = np.full(len(registers), U64(b + 1))
        for r in range(params.rows):
            key = mix(key, np.ascontiguousarray(registers[:, b * params.rows + r]))
        out[:, b] = key
    return out


def digest_of(words: list[bytes]) -> tuple[int, int]:
    """128 bits of a text's words."""
    digest = xxhash.xxh3_128_intdigest(b" ".join(words))
    return (digest >> 64) - (1 << 63), (digest & (2**64 - 1)) - (1 << 63)


def _sketch_rows(params: Params, text: str):
    """Task function: rows with d1, d2 and keys of their ``text`` behind; ``keys``
    is null for texts without words and for repeats of a digest in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashedWords()
        for batch in batches:
            met: set[int] = set()
            for rows in text_slices(batch, text, BLOCK_BYTES):
                words, counts = split_docs(t.lower() for t in binary_values(rows.column(text)))
                ends = np.cumsum(counts)
                d1, d2, fresh = [], [], []
                for a, z in zip((ends - counts).tolist(), ends.tolist()):
                    digest = digest_of(words[a:z])
                    d1.append(digest[0])
                    d2.append(digest[1])
                    fresh.append(z > a and digest not in met)
                    met.add(digest)
                fresh = np.array(fresh, bool)
                keys: list = [None] * len(fresh)
                if fresh.any():
                    hashes = table.hash_words(words)
                    own = hashes[np.repeat(fresh, counts)]
                    n = int(fresh.sum())
                    h, d, w = weighted(*shingles(own, counts[fresh], params.words))
                    found = signed(band_keys(sketch(h, d, w, n, params.bands * params.rows), params))
                    at = np.flatnonzero(fresh)
                    for i, row in zip(at, found):
                        keys[i] = row
                    # with all weights 1 only texts that repeat a shingle differ
                    again = np.unique(d[w > 1])
                    if len(again):
                        some = np.isin(d, again)
                        h, d = h[some], np.searchsorted(again, d[some])
                        plain = sketch(h, d, np.ones(len(h)), len(again), params.bands * params.rows)
                        for i, row in zip(at[again], signed(band_keys(plain, params))):
                            keys[i] = np.union1d(keys[i], row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns,
                        pa.array(d1, pa.int64()),
                        pa.array(d2, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=[*rows.schema.names, "d1", "d2", "keys"],
                )

    return run


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(J_P, plain Jaccard) of two arrays of shingle hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b)), float(len(a) == len(b))
    ua, na = np.unique(a, return_counts=True)
    ub, nb = np.unique(b, return_counts=True)
    every = np.union1d(ua, ub)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, ua)] = na / len(a)
    y[np.searchsorted(every, ub)] = nb / len(b)
    common = (x > 0) & (y > 0)
    plain = common.sum() / len(every)
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio, common = x[order], y[order], ratio[order], common[order]
    # sum of max(x', y' / ratio) over all shingles, for each common shingle
    below = np.cumsum(x)
    above = y.sum() - np.cumsum(y)
    parts = x[common] / (below[common] + above[common] / ratio[common])
    return float(parts.sum()), float(plain)


def _verify(params: Params):
    """Task function: (a, b, text_a, text_b) to (a, b, linked)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashedWords()
        for batch in batches:
            linked = []
            last, sa = None, None
            for at in range(0, batch.num_rows, PAIRS_AT_ONCE):
                rows = batch.slice(at, PAIRS_AT_ONCE)
                for ta, tb in zip(binary_values(rows.column("text_a")), binary_values(rows.column("text_b"))):
                    # neighbours often share a hub
                    if sa is None or tb != last:
                        last, sa = tb, _one(table, tb, params.words)
                    linked.append(max(similarity(_one(table, ta, params.words), sa)) >= params.threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                names=["a", "b", "linked"],
            )

    return run


def _one(table: HashedWords, text: bytes, k: int) -> np.ndarray:
    words = text.lower().split()
    return shingles(table.hash_words(words), np.array([len(words)]), k)[0]


def candidates(nodes: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """(a, b, n): candidate pairs a > b and the number of keys they share; and
    (key, node) of the keys with more than ``small`` documents."""
    rows = nodes.select("node", F.explode("keys").alias("key"))
    groups = (
        rows.groupBy("key")
        .agg(
            F.count("*").alias("size"),
            F.min("node").alias("hub1"),
            F.min_by("node", F.xxhash64("node", "key")).alias("hub2"),
        )
        .where("size > 1")
    )
    met = checkpointed(nodes.sparkSession, rows.join(groups, "key"))
    small = met.where(F.col("size") <= params.small).select("key", "node")
    large = met.where(F.col("size") > params.small)
    pairs = _in_group(small, small, "node > b")
    for hub in ("hub1", "hub2"):
        pairs = pairs.unionByName(
            large.where(f"node <> {hub}").select(
                F.greatest("node", hub).alias("a"), F.least("node", hub).alias("b")
            )
        )
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n")), large.select("key", "node")


def _in_group(left: DataFrame, right: DataFrame, condition: str, on: tuple[str, ...] = ("key",)) -> DataFrame:
    """(a, b), a > b, of the pairs of two tables (key, node, ...) that share a
    key; ``condition`` knows the right table's columns as b, b_class, ..."""
    names = {c: "b" if c == "node" else f"b_{c}" for c in right.columns if c not in on}
    other = right.select(*on, *[F.col(c).alias(n) for c, n in names.items()])
    return left.join(other, list(on)).where(condition).select(
        F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")
    )


def _step_of(size: Column) -> Column:
    """Sizes in geometric steps."""
    return F.floor(F.log(size) / float(np.log(SIZE_STEP))).cast("int")


def _with_heads(members: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    """(a, b): members and heads of one key, of unlike classes and common
    shingles, that can reach ``threshold`` without a rare shingle in common.

    With c common and r rare shingles, two documents share at most the lesser c
    of at least r + r' + the greater c. So the head's size lies between
    ``threshold`` times the member's and c / threshold - r, and texts without
    repeats, whose J_P is the plain similarity, meet by steps of size. Every bit
    in which their masks of common shingles differ is a shingle of one only. Of
    others J_P is at most C / (1 + R' C / C'), for shares C and R of the weight.
    """
    unlike = "class <> b_class and (g1 <> b_g1 or g2 <> b_g2)"
    differ = " + ".join(f"bit_count(m{i} ^ b_m{i})" for i in range(MASKS))
    most = (1 - threshold) / (1 + threshold)
    plain = (
        f"(least(c, b_c) >= {threshold!r} * (r + b_r + greatest(c, b_c))"
        f" and r + b_r + {differ} <= {most!r} * (size + b_size))"
    )
    by_weight = (
        f"c_share * b_c_share >= {threshold!r} * (b_c_share + (1 - b_c_share) * c_share)"
        f" and c_share * b_c_share >= {threshold!r} * (c_share + (1 - c_share) * b_c_share)"
    )
    # a pair is taken at the least key that both have
    once = "key = array_min(array_intersect(keys, b_keys))"
    low, high = threshold * F.col("size"), F.col("c") / threshold - F.col("r")
    steps = F.sequence(_step_of(low), _step_of(F.greatest(low, high)))
    pairs = _in_group(
        members.where("flat").withColumn("step", F.explode(steps)),
        heads.where("flat").withColumn("step", _step_of(F.col("size"))),
        f"{unlike} and {plain} and {once}",
        ("key", "step"),
    )
    either = f"{unlike} and ({plain} or ({by_weight})) and {once}"
    pairs = pairs.unionByName(_in_group(members.where("not flat"), heads, either))
    return pairs.unionByName(_in_group(members.where("flat"), heads.where("not flat"), either))


def _shingle_rows(params: Params):
    """Task function: (node, class, text) to (node, class, h, n): distinct
    shingles and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashedWords()
        for batch in batches:
            for rows in text_slices(batch, "text", BLOCK_BYTES):
                words, counts = split_docs(t.lower() for t in binary_values(rows.column("text")))
                h, d, n = weighted(*shingles(table.hash_words(words), counts, params.words))
                at = pa.array(d, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("node").take(at),
                        rows.column("class").take(at),
                        pa.array(signed(h), pa.int64()),
                        pa.array(n.astype(np.int64), pa.int64()),
                    ],
                    names=["node", "class", "h", "n"],
                )

    return run


def open_pairs(tables: Tables, rows: DataFrame, texts: DataFrame, params: Params) -> DataFrame:
    """(a, b): the pairs of different classes that are left to verify in large
    groups, see step 4. ``rows``: (key, node, class), ``texts``: (node, text)."""
    members = rows.select("node", "class").distinct()
    found = texts.join(members, "node").select("node", "class", "text").mapInArrow(
        _shingle_rows(params), "node long, class long, h long, n long"
    )
    rare = found.groupBy("h").agg(F.count("*").alias("df")).where(F.col("df") <= params.small)
    marked = found.join(rare, "h", "left")
    # rare shingles first; a pair at the threshold meets in its prefixes
    whole = Window.partitionBy("node")
    ahead = whole.orderBy(F.col("df").asc_nulls_last(), "h").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    at_least = params.threshold - 1e-9
    marked = marked.select(
        "node", "class", "h", "n", "df",
        F.count("*").over(whole).alias("all"),
        F.sum("n").over(whole).alias("all_n"),
        (F.count("*").over(ahead) - 1).alias("before"),
        (F.sum("n").over(ahead) - F.col("n")).alias("before_n"),
    )
    marked = marked.where(
        (F.col("all") - F.col("before") >= at_least * F.col("all"))
        | (F.col("all_n") - F.col("before_n") >= at_least * F.col("all_n"))
        | F.col("df").isNull()
    )
    marked = tables.store(marked.where("df is null or df > 1").select(
        F.col("h").alias("key"), "node", "class", "n", "df", "all", "all_n", "before"
    ))
    prefix = marked.where("df is not null").select(
        "key", "node", "class", F.col("all").alias("size"), (F.col("all") - F.col("before")).alias("left"),
        (F.col("all") == F.col("all_n")).alias("flat"),
    )
    # what lies behind the first shingle that both have bounds what they share
    share = at_least / (1 + at_least)
    reach = f"(not flat or not b_flat or least(left, b_left) >= {share!r} * (size + b_size))"
    pairs = _in_group(prefix, prefix, f"node > b and class <> b_class and {reach}")
    # no rare shingle in common: the common ones alone reach the threshold
    masks = [f"m{i}" for i in range(MASKS)]
    mask = F.pmod(F.shiftright("key", 6), F.lit(MASKS))
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    common = (
        marked.where("df is null")
        .groupBy("node", "class", "all", "all_n")
        .agg(
            F.count("*").alias("c"),
            F.sum("n").alias("c_n"),
            F.bit_xor(F.xxhash64("key", "n")).alias("g1"),
            F.bit_xor(F.xxhash64("n", "key")).alias("g2"),
            *[F.bit_or(F.when(mask == i, bit).otherwise(0)).alias(m) for i, m in enumerate(masks)],
        )
        .where((F.col("c") >= at_least * F.col("all")) | (F.col("c_n") >= at_least * F.col("all_n")))
        .select(
            "node", "class", "g1", "g2", "c", (F.col("all") - F.col("c")).alias("r"),
            (F.col("all_n") - F.col("c_n")).alias("r_n"), (F.col("c_n") / F.col("all_n")).alias("c_share"),
            F.col("all").alias("size"), (F.col("all") == F.col("all_n")).alias("flat"), *masks,
        )
    )
    common = tables.store(common)
    heads = common.groupBy("g1", "g2").agg(
        F.min(F.struct("r", "node", "class")).alias("by_set"),
        F.min(F.struct("r_n", "node", "class")).alias("by_count"),
    )
    led = common.join(heads, ["g1", "g2"])
    for by in ("by_set", "by_count"):
        pairs = pairs.unionByName(
            led.where(F.col("class") != F.col(f"{by}.class")).select(
                F.greatest("node", f"{by}.node").alias("a"), F.least("node", f"{by}.node").alias("b")
            )
        )
    head = heads.select(F.explode(F.array("by_set.node", "by_count.node")).alias("node")).distinct()
    top = rows.groupBy("key", "class").count().groupBy("key").agg(F.max_by("class", "count").alias("top"))
    of = common.select("node", "g1", "g2", "c", "r", "c_share", "size", "flat", *masks)
    # as many keys as a document has at most
    keys = rows.groupBy("node").agg(F.collect_set("key").alias("keys"))
    grouped = rows.join(top, "key").join(of, "node").join(keys, "node")
    grouped = tables.store(grouped.join(head.withColumn("head", F.lit(True)), "node", "left"))
    # of two classes one at least is not the largest of its group
    pairs = pairs.unionByName(_with_heads(grouped.where("class <> top"), grouped.where("head"), at_least))
    # the conditions hold both ways, so the heads can be the members here
    largest = grouped.where("class = top")
    pairs = pairs.unionByName(_with_heads(grouped.where("head and class <> top"), largest, at_least))
    found = tables.store(pairs.distinct())
    tables.drop(marked, common, grouped)
    return found


def _texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) for each of ``nodes`` (node); a node is a row's number."""
    return rows.select(F.col("row").alias("node"), "text").join(nodes, "node")


def _open_rows(large: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(key, node, class) of the large groups that hold more than one class."""
    if labels is None:
        rows = large.withColumn("class", F.col("node"))
    else:
        rows = large.join(labels, "node", "left").select(
            "key", "node", F.coalesce("class", "node").alias("class")
        )
    several = rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    rows = rows.join(several.where("low <> high").select("key"), "key")
    return checkpointed(large.sparkSession, rows)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_ROWS rows at most for the jobs run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _judged(tables: Tables, docs: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """The rows as a table with their number, ``row``, their columns renamed
    c0, c1, ...; and per row: row, k (its doc_id), d1 and d2 (its digest),
    class_id and stays. ``docs`` has text as a string."""
    spark = tables.spark
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, doc_id = (f"c{docs.columns.index(c)}" for c in ("text", "doc_id"))
    renamed = docs.toDF(*names)
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    added = [T.StructField(n, T.LongType()) for n in ("d1", "d2")]
    added.append(T.StructField("keys", T.ArrayType(T.LongType())))
    known = renamed.mapInArrow(_sketch_rows(params, text), T.StructType(fields + added))
    # the row numbers are stored with the rows, so they stay the same
    table = tables.store(known.withColumn("row", F.monotonically_increasing_id()))
    sketched = table.select(
        "row", F.col(doc_id).cast("long").alias("k"), F.col(text).alias("text"), "d1", "d2", "keys"
    )
    firsts = sketched.groupBy("d1", "d2").agg(
        F.min("row").alias("node"),
        F.min("k").alias("least"),
        F.max(F.col("k").isNull()).alias("nulls"),
    )
    firsts = checkpointed(spark, firsts)
    nodes = (
        sketched.where("keys is not null")
        .groupBy("d1", "d2")
        .agg(F.min_by("keys", "row").alias("keys"))
        .join(firsts, ["d1", "d2"])
        .select("node", "keys")
    )
    pairs, large = candidates(nodes, params)
    pairs = tables.store(pairs)
    links = spark.createDataFrame([], "a long, b long")
    labels = None
    for step in ("best", "others", "open"):
        if step == "open":
            rows = _open_rows(large, labels)
            if rows.isEmpty():
                break
            members = tables.store(rows.select("node").distinct())
            pairs = open_pairs(tables, rows, _texts_of(sketched, members), params)
        if pairs.isEmpty():
            continue
        chosen = pairs.select("a", "b")
        if step == "best":
            order = Window.partitionBy("a").orderBy(F.desc("n"), "b")
            ranked = pairs.withColumn("rank", F.row_number().over(order))
            best = ranked.where(F.col("rank") <= params.per_round)
            chosen = tables.store(best.select("a", "b"))
        ids = chosen.select(F.col("a").alias("node")).unionByName(
            chosen.select(F.col("b").alias("node"))
        ).distinct()
        texts = _texts_of(sketched, tables.store(ids))
        first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        judged = chosen.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
        verdict = judged.mapInArrow(_verify(params), "a long, b long, linked boolean")
        found = tables.store(verdict.where("linked").select("a", "b").distinct())
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(tables, links)
        if step != "best":
            continue
        pairs = pairs.join(chosen, ["a", "b"], "left_anti")
        if labels is not None:
            of_a = labels.select(F.col("node").alias("a"), F.col("class").alias("class_a"))
            of_b = labels.select(F.col("node").alias("b"), F.col("class").alias("class_b"))
            pairs = (
                pairs.join(of_a, "a", "left")
                .join(of_b, "b", "left")
                .where(~F.coalesce(F.col("class_a") == F.col("class_b"), F.lit(False)))
                .select("a", "b", "n")
            )
        pairs = tables.store(pairs)
    if labels is not None:
        classes = firsts.join(labels, "node", "left").withColumn("class", F.coalesce("class", "node"))
    else:
        classes = firsts.withColumn("class", F.col("node"))
    # the row that stays: least doc_id, null only if there is no other or no word
    d1, d2 = digest_of([])
    wordless = (F.col("d1") == d1) & (F.col("d2") == d2)
    classes = classes.withColumn("least", F.when(~(wordless & F.col("nulls")), F.col("least")))
    chosen = classes.groupBy("class").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("best")
    )
    led = classes.join(chosen, "class").select(
        "d1",
        "d2",
        F.col("best.least").alias("class_id"),
        (F.col("node") == F.col("best.node")).alias("leads"),
    )
    judged = sketched.select("row", "k", "d1", "d2").join(led, ["d1", "d2"])
    stays = F.col("leads") & F.col("k").eqNullSafe(F.col("class_id"))
    return table, judged.select("row", "k", "d1", "d2", "class_id", stays.alias("stays"))


def near_duplicates(spark: SparkSession, docs: DataFrame, params: Params = PRODUCTION) -> DataFrame:
    """Per row: doc_id, class_id (the class's least doc_id) and whether the
    row's document is the one of its class that stays."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    with _small_batches(spark):
        _, judged = _judged(Tables(spark, "op4"), narrow, params)
    return judged.select(F.col("k").alias("doc_id"), "class_id", "stays")


def keep_one(spark: SparkSession, docs: DataFrame, params: Params = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one per class."""
    with _small_batches(spark):
        table, judged = _judged(Tables(spark, "op4"), docs, params)
    # a class's row that stays has a digest of its own
    rows = judged.where("stays").groupBy("d1", "d2").agg(F.min("row").alias("row")).select("row")
    kept = table.join(rows, "row", "left_semi")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op4_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read_table(spark, sf_dir, "documents"))
