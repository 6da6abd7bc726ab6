"""Operator 11: importance resampling towards a target distribution.

Documents are drawn so that their words look like a target text set's.

1. Features are runs of 1 to ``max_n`` consecutive words (ASCII lower case;
   digits, letters and everything outside ASCII are word characters), each in
   the bucket crc32 modulo ``buckets``. Every task adds up its texts' features
   in one array of ``buckets`` counts; the arrays are summed per bucket.
2. A bucket's gain is the scaled log ratio of its smoothed shares in target
   and corpus. The gains are one array of ``buckets`` numbers, so its size
   doesn't grow with the data; a second pass over the texts looks every
   feature up in it and adds the gains: the document's weight.
3. The score is the weight plus Gumbel noise from a hash of the doc_id, so the
   highest scores are a weighted sample without replacement.
4. The k-th best composite key (score, doc_id) is found by quickselect on the
   stored scores: random pivot keys, exact counts of the rows before, at and
   behind each, and only the part that holds the k-th key goes on.
5. Winners alone are sorted and ranked: a range sort, the row counts of its
   partitions (one number each), and a running count within each partition.

Nothing else is collected: pivots, counts of pivots, bucket counts.

Nulls and edge cases: a null or empty text has no words, so weight 0, and is
never drawn; a null doc_id is hashed as empty text and comes after all others
in ties; rows that share a doc_id are documents of their own and share the
noise; ties in score and doc_id go to fewer features, and rows equal in all of
these are alike, so that some of them may be drawn and others not; a very long
text is read in pieces; an empty corpus gives an empty result, an empty target
makes rare buckets gain most; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import WORD_TABLE_LIMIT, binary_values, checkpointed, read_table


@dataclass(frozen=True)
class Params:
    max_n: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024
    # pivot keys per quickselect round
    pivots: int = 16


PRODUCTION = Params()
# Bytes of a text that are split into words at a time.
PIECE = 1 << 20
# Copies of one key that are listed at a time.
COPIES = 1 << 16

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes that end between words."""
    start = 0
    while start + size < len(text):
        gap = _GAP.search(text, start + size)
        stop = gap.start() if gap else len(text)
        yield text[start:stop]
        start = stop
    yield text[start:]


class Buckets(dict):
    """Feature (bytes) -> bucket."""

    def __init__(self, params: Params):
        self.params = params

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= WORD_TABLE_LIMIT:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.params.buckets
        return bucket

    def of_text(self, text: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """Per piece of a text: its words, and the buckets of its features."""
        tail: list[bytes] = []
        for piece in pieces(text.lower()):
            words = _WORD.findall(piece)
            found = list(map(self.__getitem__, words))
            run = tail + words
            for n in range(2, self.params.max_n + 1):
                # runs that end in this piece
                first = max(0, len(tail) - n + 1)
                found += [self[b" ".join(run[i : i + n])] for i in range(first, len(run) - n + 1)]
            tail = run[max(0, len(run) - self.params.max_n + 1) :] if self.params.max_n > 1 else []
            yield len(words), np.array(found, np.int64)


def _count(params: Params):
    """Task function: (text) to the task's (bucket, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Buckets(params)
        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for text in binary_values(batch.column("text")):
                for _, found in table.of_text(text):
                    # short texts are added one by one, long ones by counting
                    if len(found) > params.buckets:
                        total += np.bincount(found, minlength=params.buckets)
                    else:
                        np.add.at(total, found, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, params: Params) -> np.ndarray:
    """Features per bucket over all of ``texts`` (text)."""
    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _count(params), "bucket long, n long"
    )
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most ``buckets``
    out = np.zeros(params.buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of every bucket's smoothed share in target and corpus."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    m = float(len(s))
    ratio = ((t + 1) * (s.sum() + m)) / ((s + 1) * (t.sum() + m))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _score(params: Params, gain: np.ndarray):
    """Task function: (doc_id, text) to (doc_id, n_words, n_features, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Buckets(params)
        for batch in batches:
            rows = []
            for text in binary_values(batch.column("text")):
                n_words = n_features = weight = 0
                for words, found in table.of_text(text):
                    n_words += words
                    n_features += len(found)
                    weight += int(gain[found].sum())
                rows.append((n_words, n_features, weight))
            cells = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(cells[:, i]) for i in range(3))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def _noise(seed: int) -> Column:
    """Gumbel noise times 1000, rounded down, from a hash of the doc_id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    u = (h + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def scored_documents(
    docs: DataFrame, target: DataFrame, params: Params = PRODUCTION
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight, score."""
    gain = gains(bucket_counts(docs, params), bucket_counts(target, params))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_score(params, gain), "doc_id long, n_words long, n_features long, weight long")
    return found.withColumn("score", F.col("weight") + _noise(params.seed))


def kth_key(rows: DataFrame, key: list[str], k: int, pivots: int, seed: int = 0) -> tuple | None:
    """The ``k``-th least (from 1) of the composite keys (long columns, no
    nulls) of stored ``rows``; None if there are fewer rows."""

    def literal(values: tuple) -> Column:
        return F.struct(*[F.lit(int(v)).cast("long").alias(c) for c, v in zip(key, values)])

    whole = F.struct(*[F.col(c) for c in key])
    low: tuple | None = None
    high: tuple | None = None
    before, turn = 0, 0
    while True:
        live = rows.select(*key)
        if low is not None:
            live = live.where(whole > literal(low))
        if high is not None:
            live = live.where(whole < literal(high))
        turn += 1
        drawn = live.orderBy(F.rand(seed + turn)).limit(pivots).collect()
        picks = sorted({tuple(r) for r in drawn})
        if not picks:
            return None
        sums = []
        for i, p in enumerate(picks):
            sums.append(F.count_if(whole < literal(p)).alias(f"lt{i}"))
            sums.append(F.count_if(whole == literal(p)).alias(f"eq{i}"))
        counts = live.agg(*sums).first()
        passed = 0
        for i, p in enumerate(picks):
            less, equal = counts[f"lt{i}"], counts[f"eq{i}"]
            if k <= before + less:
                high = p
                break
            if k <= before + less + equal:
                return p
            low, passed = p, less + equal
        before += passed


def _running(offsets: dict[int, int]):
    """Task function: (part, ..., copies) in order to the rank before each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, None
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            parts = batch.column("part").to_numpy()
            before = np.empty(len(copies), np.int64)
            for p in dict.fromkeys(parts.tolist()):
                if p != part:
                    at, part = offsets[p], p
                mine = parts == p
                ends = at + np.cumsum(copies[mine])
                before[mine] = ends - copies[mine]
                at = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"]
            )

    return run


def ranked(spark: SparkSession, rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with their rank (1, 2, ...) in the order of ``key``, which must
    tell apart all unequal rows."""
    grouped = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    ordered = grouped.orderBy(*key).withColumn("part", F.spark_partition_id())
    ordered = checkpointed(spark, ordered)
    sizes = ordered.groupBy("part").agg(F.sum("copies").alias("n")).orderBy("part").collect()
    offsets, at = {}, 0
    for r in sizes:
        offsets[r.part] = at
        at += r.n
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields)
    placed = ordered.mapInArrow(_running(offsets), f"{schema}, before long")
    # copies of one key in two steps, so that no list grows with them
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    last = F.least(F.col("__at") + COPIES - 1, F.col("copies") - 1)
    return (
        placed.withColumn("__at", block)
        .withColumn("__copy", F.explode(F.sequence(F.col("__at"), last)))
        .select(*rows.columns, (F.col("before") + F.col("__copy") + 1).alias("rank"))
    )


def resample(
    spark: SparkSession, docs: DataFrame, target: DataFrame, params: Params = PRODUCTION
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (null: not
    drawn) and n_words."""
    scored = checkpointed(spark, scored_documents(docs, target, params))
    long = lambda c: c.cast("long")
    keyed = scored.select(
        "*",
        (-F.col("score")).alias("k1"),
        long(F.col("doc_id").isNull()).alias("k2"),
        F.coalesce("doc_id", long(F.lit(0))).alias("k3"),
        F.col("n_features").alias("k4"),
        F.col("n_words").alias("k5"),
    )
    key = ["k1", "k2", "k3", "k4", "k5"]
    able = F.col("n_words") >= params.min_words
    k = params.percent * scored.where(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return scored.withColumn("rank", undrawn).select(*columns)
    last = kth_key(keyed.where(able), key, k, params.pivots, params.seed)
    bound = F.struct(*[long(F.lit(int(v))).alias(c) for c, v in zip(key, last)])
    won = able & (F.struct(*[F.col(c) for c in key]) <= bound)
    winners = ranked(spark, keyed.where(won), key)
    # rows equal to the last winner in the whole key
    winners = winners.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    losers = keyed.where(~won).withColumn("rank", undrawn)
    return winners.select(*columns).unionByName(losers.select(*columns))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(
        spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    ).drop("n_words")


# crc32 by its bitwise rule, over the bytes of distinct words.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
dw AS (SELECT uid, unnest(w) AS word FROM d),
words AS (SELECT word FROM dw UNION SELECT word FROM b),
bytes AS (
  SELECT word, list_transform(range(0, length(hex(encode(word))) // 2),
    lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT) AS v FROM words),
bucket AS (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], v),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::BIGINT) % 10000 AS k
  FROM bytes),
s AS (SELECT k, count(*) AS n FROM dw JOIN bucket USING (word) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM b JOIN bucket USING (word) GROUP BY k),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t_all),
gain AS (
  SELECT s.k, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (s_all + 10000)
    / ((s.n::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (k) CROSS JOIN totals),
per AS (
  SELECT uid, sum(g)::BIGINT AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (k) GROUP BY uid),
scored AS (
  SELECT d.uid, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN per USING (uid)),
placed AS (
  SELECT uid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r,
    count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN r <= 10 * n // 100 THEN r END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (uid)
"""
