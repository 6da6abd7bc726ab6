"""Operator 2: language identification by prediction by partial matching.

Per language, a variable-order byte context tree: contexts of up to
``order`` bytes with the counts of the bytes that follow them. A byte's
probability follows PPM with escape method C: in a context seen n times with
q different successors, a successor seen c times has c / (n + q), and the
escape to the next shorter context q / (n + q); contexts never seen pass on
without cost; below the empty context all byte classes are equally likely. The
counts are frozen after training, so a text's code length in bits is an exact
sum over its bytes, and the language with the shortest code wins.

Every language of the corpus is learned, each from a bounded sample:
``sample_docs`` whole texts, those with the least hash of the id. Above
``lang_block`` languages the price tables are made and read in blocks.
Counting runs in Spark (summed in the tasks first); the tree of an alphabet
of byte classes is small and goes to every task as sorted tables.

Scoring looks at every byte of every text once, for all languages together.
A distinct gram (context and byte) is priced once per task, by binary search
from the longest context down, and looked up from then on.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with
score 0; a null lang is not learned from; if nothing can be learned all
texts are ``und``; a null doc_id is neither learned from nor held out; rows
are scored one by one, so repeated rows give equal rows; equal code lengths
are decided for the language that sorts first; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import binary_values, fold_of, read_table, text_slices


@dataclass(frozen=True)
class Params:
    order: int = 3
    sample_docs: int = 150
    # languages that share one price table
    lang_block: int = 64


PRODUCTION = Params()
BLOCK_BYTES = 2 << 20
# Sampled ids up to which their table is broadcast.
BROADCAST_IDS = 20_000
UNDETERMINED = "und"

# Byte classes: letters without case, one digit, one space, one sign; bytes of
# multi-byte characters stay as they are.
_CLASS = np.full(256, ord("."), np.uint8)
for _b in range(256):
    if _b >= 0x80 or 97 <= _b <= 122:
        _CLASS[_b] = _b
    elif 65 <= _b <= 90:
        _CLASS[_b] = _b + 32
    elif 48 <= _b <= 57:
        _CLASS[_b] = ord("0")
    elif _b in (9, 10, 11, 12, 13, 32):
        _CLASS[_b] = ord(" ")
ALPHABET = len(set(_CLASS.tolist()))
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_LETTER = re.compile(r"[^\W\d_]")


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The (order + 1)-gram that ends at every byte of every text, as a number
    (contexts start as spaces), and the texts' first and end index."""
    pad = b" " * order
    data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    b = _CLASS[data].astype(np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + order)
    key = b.copy()
    for k in range(1, order + 1):
        key[k:] |= b[:-k] << np.uint32(8 * k)
    return key, ends - sizes, ends


def count_grams(order: int):
    """Task function: (lang, text) rows to (lang, gram, n), summed per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, "text", BLOCK_BYTES):
                langs = np.array(rows.column("lang").to_pylist(), object)
                texts = binary_values(rows.column("text"))
                for lang in sorted(set(langs)):
                    own = [t for t, x in zip(texts, langs) if x == lang]
                    key, first, end = grams(own, order)
                    keep = np.concatenate([np.arange(a, z) for a, z in zip(first, end)])
                    k, n = np.unique(key[keep], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(k), pa.string()),
                            pa.array(k.astype(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        names=["lang", "gram", "n"],
                    )

    return run


class ContextTrees:
    """Code lengths of all languages.

    Level k (k = 0 .. order) holds, for the contexts of k bytes, ``keys``: the
    (k + 1)-grams seen in any language, ``bits``: their code lengths per
    language, and ``contexts`` / ``escape``: the cost of leaving a context.
    """

    def __init__(self, langs: list[str], order: int, lang_of, gram, n):
        self.langs, self.order = langs, order
        self.levels = []
        size = len(langs)
        lower = None
        for k in range(order + 1):
            mask = np.uint32((1 << (8 * (k + 1))) - 1)
            key = gram & mask
            keys, at = np.unique(key, return_inverse=True)
            counts = np.zeros((len(keys), size))
            np.add.at(counts, (at, lang_of), n)
            contexts, ctx = np.unique(keys >> np.uint32(8), return_inverse=True) if k else (
                np.zeros(1, np.uint32),
                np.zeros(len(keys), np.int64),
            )
            if k:
                # the gram's context is all but its last byte
                total = np.zeros((len(contexts), size))
                distinct = np.zeros((len(contexts), size))
            else:
                total = np.zeros((1, size))
                distinct = np.zeros((1, size))
            np.add.at(total, ctx, counts)
            np.add.at(distinct, ctx, (counts > 0).astype(float))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                own = -np.log2(counts / (total + distinct)[ctx])
            if lower is None:
                below = np.full((len(keys), size), np.log2(ALPHABET))
            else:
                short = keys & (mask >> np.uint32(8))
                below = lower[1][np.searchsorted(lower[0], short)]
            bits = np.where(counts > 0, own, escape[ctx] + below)
            lower = (keys, bits)
            self.levels.append((keys, bits, contexts, escape))

    def bits(self, key: np.ndarray) -> np.ndarray:
        """Code length of every gram's last byte, per language (rows)."""
        out = np.zeros((len(self.langs), len(key)))
        rest = np.arange(len(key))
        for k in range(self.order, -1, -1):
            keys, bits, contexts, escape = self.levels[k]
            part = key[rest] & np.uint32((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            hit = keys[at] == part
            if hit.all():
                for i in range(len(out)):
                    out[i, rest] += bits[at, i]
                return out
            for i in range(len(out)):
                out[i, rest[hit]] += bits[at[hit], i]
            part, rest = part[~hit], rest[~hit]
            ctx = part >> np.uint32(8)
            c = np.minimum(np.searchsorted(contexts, ctx), len(contexts) - 1)
            seen = contexts[c] == ctx
            for i in range(len(out)):
                out[i, rest[seen]] += escape[c[seen], i]
        out[:, rest] += np.log2(ALPHABET)
        return out


class TreeBlocks:
    """Context trees of many languages, in blocks that are priced one by one."""

    def __init__(self, parts: list[ContextTrees]):
        self.parts = parts
        self.langs = [x for part in parts for x in part.langs]


def pricer_of(trees: ContextTrees | TreeBlocks):
    """Bits of texts in every language; several blocks keep no price rows."""
    if isinstance(trees, ContextTrees):
        return Pricer(trees)
    parts = [Pricer(part, max_cells=0) for part in trees.parts]
    return lambda texts: np.hstack([price(texts) for price in parts])


class Pricer:
    """Code lengths of texts; a distinct gram is priced once per task.

    Bytes become dense ids of the classes seen in training (0: any other), so
    a gram is an index into one table of price rows, filled as grams come up.
    With too many classes for such a table, grams are priced block by block.
    """

    def __init__(self, trees: ContextTrees, max_cells: int = 1 << 24):
        self.trees = trees
        seen = trees.levels[0][0].astype(np.int64)
        unseen = next(x for x in range(256) if x not in set(seen.tolist()) and _CLASS[x] != x)
        self.symbols = np.append(unseen, seen).astype(np.uint32)
        dense = np.zeros(256, np.int64)
        dense[seen] = np.arange(1, len(seen) + 1)
        self.dense = dense[_CLASS]
        self.base = len(self.symbols)
        cells = self.base ** (trees.order + 1)
        self.rows = np.full(cells, -1, np.int32) if cells <= max_cells else None
        self.prices = np.zeros((len(trees.langs), 0))

    def _gram(self, ids: np.ndarray) -> np.ndarray:
        """Dense gram ids as grams of bytes."""
        out = np.zeros(len(ids), np.uint32)
        for k in range(self.trees.order + 1):
            out |= self.symbols[ids % self.base] << np.uint32(8 * k)
            ids = ids // self.base
        return out

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """Bits of every text in every language: (texts, languages)."""
        order = self.trees.order
        pad = b" " * order
        data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        end = np.cumsum(sizes + order)
        first = end - sizes
        b = self.dense[data]
        ids = b.copy()
        scale = 1
        for k in range(1, order + 1):
            scale *= self.base
            ids[k:] += b[:-k] * scale
        if self.rows is None:
            distinct, at = np.unique(ids, return_inverse=True)
            prices = self.trees.bits(self._gram(distinct))
        else:
            at = self.rows[ids]
            new = np.unique(ids[at < 0])
            if len(new):
                have = self.prices.shape[1]
                self.prices = np.hstack([self.prices, self.trees.bits(self._gram(new))])
                self.rows[new] = np.arange(have, have + len(new))
                at = self.rows[ids]
            prices = self.prices
        out = np.empty((len(texts), len(self.trees.langs)))
        for i, price in enumerate(prices):
            run = np.append(0.0, np.cumsum(price[at]))
            out[:, i] = run[end] - run[first]
        return out


def _has_letter(text: bytes) -> bool:
    if _ASCII_LETTER[np.frombuffer(text[:256], np.uint8)].any():
        return True
    # number signs are word characters too, but no letters
    return any(m[0].isalpha() for m in _LETTER.finditer(text.decode("utf-8", "replace")))


def predict(trees: ContextTrees | TreeBlocks | None):
    """Task function: (doc_id, held_out, text) rows to predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        price = pricer_of(trees) if trees is not None else None
        for batch in batches:
            for rows in text_slices(batch, "text", BLOCK_BYTES):
                texts = binary_values(rows.column("text"))
                known = np.array([trees is not None and _has_letter(t) for t in texts], bool)
                pred = np.full(len(texts), UNDETERMINED, object)
                score = np.zeros(len(texts))
                if known.any():
                    bits = price([t for t, x in zip(texts, known) if x])
                    best = bits.argmin(axis=1)
                    gap = np.minimum(bits - bits.min(axis=1)[:, None], 1000)
                    score[known] = 1 / np.exp2(-gap).sum(axis=1)
                    pred[known] = np.array(trees.langs, object)[best]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("held_out"),
                        pa.array(pred, pa.string()),
                        pa.array(score),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def train(
    spark: SparkSession, docs: DataFrame, learn: Column, params: Params = PRODUCTION
) -> ContextTrees | TreeBlocks | None:
    """Context trees of every language, each from a bounded sample of its rows
    where ``learn`` holds."""
    base = docs.where(learn & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    # ids only: the window keeps at most sample_docs rows per task and language
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        base.select("doc_id", "lang")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= params.sample_docs)
        .select(F.col("doc_id").alias("id"), F.col("lang").alias("id_lang"))
    )
    if params.sample_docs * base.select("lang").distinct().count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    sample = base.join(
        ids, (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("id_lang")), "left_semi"
    ).select("lang", "text")
    counts = (
        sample.mapInArrow(count_grams(params.order), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    if not len(counts):
        return None
    langs = sorted(counts["lang"].unique())
    parts = []
    for start in range(0, len(langs), params.lang_block):
        block = langs[start : start + params.lang_block]
        index = {x: i for i, x in enumerate(block)}
        own = counts[counts["lang"].isin(block)]
        parts.append(
            ContextTrees(
                block,
                params.order,
                own["lang"].map(index).to_numpy(np.int64),
                own["gram"].to_numpy(np.int64).astype(np.uint32),
                own["n"].to_numpy(np.float64),
            )
        )
    return parts[0] if len(parts) == 1 else TreeBlocks(parts)


def identify(docs: DataFrame, trees: ContextTrees | TreeBlocks | None, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(
        predict(trees), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def op2_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = fold_of("doc_id", 5)
    return identify(docs, train(spark, docs, fold != 0), fold == 0)
