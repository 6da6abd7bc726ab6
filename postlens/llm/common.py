"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import delete_path, new_scratch_dir, scratch_root

U64 = np.uint64
# Entries kept by a word table before it starts anew (bounds a task's memory).
WORD_TABLE_LIMIT = 400_000
# A join key with more than this share of all rows is a heavy one.
HEAVY = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared checkpoint folder."""
    scratch_root(spark)
    return df.checkpoint(eager=True)


class Tables:
    """Intermediate tables of one run, as Parquet under the shared folder.

    Unlike a checkpoint a table has its true size, so Spark chooses joins by
    it, and iterations don't pile up estimates.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = label
        self.paths: dict[int, str] = {}

    def store(self, df: DataFrame, **options: str | int) -> DataFrame:
        """``df`` computed once, written (with the writer's ``options``) and read back."""
        path = new_scratch_dir(self.spark, self.label)
        df.write.options(**options).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, *stored: DataFrame | None) -> None:
        """Deletes tables that nothing reads any more."""
        for df in stored:
            path = self.paths.pop(id(df), None)
            if path:
                delete_path(self.spark, path)


def components(tables: Tables, links: DataFrame) -> DataFrame:
    """(node, class) of all nodes of ``links`` (a, b): the least node reached.

    Each step takes the least label around a node, then the label's label.
    """
    both = tables.store(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("class"))
    labels = tables.store(first.withColumn("moved", F.lit(True)))
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("class").alias("near"))
        around = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        stepped = labels.join(around, "node").select("node", "class", F.least("class", "near").alias("new"))
        far = labels.select(F.col("node").alias("new"), F.col("class").alias("far"))
        jumped = stepped.join(far, "new").select(
            "node", F.least("new", "far").alias("class"), (F.least("new", "far") != F.col("class")).alias("moved")
        )
        jumped = tables.store(jumped)
        tables.drop(labels)
        labels = jumped
        if labels.where("moved").isEmpty():
            tables.drop(both)
            return labels.select("node", "class")


def spread_join(rows: DataFrame, keys: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Inner join with one row of ``keys`` per key; ``size`` is the number of
    rows with it, ``total`` that of all rows. Keys that hold over a HEAVY-th of
    the rows, so fewer than HEAVY, are joined by broadcast: no task gets a hot
    key."""
    heavy = keys.where(F.col(size) * HEAVY > total)
    names = [r[0] for r in heavy.select(on[0]).distinct().collect()]
    if not names:
        return rows.join(keys, on)
    # by the first column; other keys that share its value go along
    hot = F.col(on[0]).isin(names)
    near = F.broadcast(keys.where(hot))
    return rows.where(hot).join(near, on).unionByName(rows.where(~hot).join(keys.where(~hot), on))


def binary_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, nulls as empty."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.fill_null("").cast(pa.large_binary() if large else pa.binary()).to_pylist()


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in row slices of at most ``max_bytes`` of text (one row at least)."""
    sizes = np.array(
        [len(v) for v in binary_values(batch.column(column))], dtype=np.int64
    )
    start = 0
    ends = np.cumsum(sizes)
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, base + max_bytes, "right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


class WordTable(dict):
    """Word (bytes) -> dense id, given out in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        self[word] = n
        return n

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class HashedWords:
    """Word ids with a 64-bit hash per id; emptied when it gets too large."""

    def __init__(self, limit: int = WORD_TABLE_LIMIT):
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.table = WordTable()
        self.hashes = np.zeros(1024, U64)
        self.known = 0

    def hash_words(self, words: list[bytes]) -> np.ndarray:
        """The 64-bit hash of every word."""
        if len(self.table) > self.limit:
            self._reset()
        ids = self.table.ids(words)
        total = len(self.table)
        if total > self.known:
            if total > len(self.hashes):
                grown = np.zeros(max(total, 2 * len(self.hashes)), U64)
                grown[: self.known] = self.hashes[: self.known]
                self.hashes = grown
            fresh = list(self.table)[self.known :] if self.known == 0 else _tail(
                self.table, total - self.known
            )
            self.hashes[self.known : total] = np.fromiter(
                map(xxhash.xxh3_64_intdigest, fresh), U64, total - self.known
            )
            self.known = total
        return self.hashes[ids]


def _tail(table: dict, n: int) -> list:
    """The last ``n`` keys in insertion order."""
    it = reversed(table)
    out = [next(it) for _ in range(n)]
    out.reverse()
    return out


_C1 = U64(0x9E3779B97F4A7C15)
_C2 = U64(0xC2B2AE3D27D4EB4F)
_C3 = U64(0xD6E8FEB86659FD93)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """64-bit mix of two columns of 64-bit values; not symmetric."""
    if not isinstance(b, np.ndarray):
        b = np.array([b], U64)
    x = a * _C1
    x ^= x >> U64(31)
    x += b * _C2
    x ^= x >> U64(32)
    x *= _C3
    x ^= x >> U64(29)
    return x


def split_docs(texts: Iterable[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words of all texts, and the word count of each text.

    ``bytes.split()`` splits at exactly the characters 0x20 and 0x09-0x0D.
    """
    words: list[bytes] = []
    counts = []
    for t in texts:
        w = t.split()
        words.extend(w)
        counts.append(len(w))
    return words, np.array(counts, dtype=np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
