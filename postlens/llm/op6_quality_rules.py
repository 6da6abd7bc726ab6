"""Operator 6: quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements
and one failure bit per rule. Policies are sets of rules with a version;
``apply_policy`` keeps a document when none of the policy's bits is set, and
``ablations`` answers "what would each rule's removal keep?" by bitwise
aggregation over the stored bits, without looking at a text again.

The measurements are sums over bytes, words and lines of one document, so the
scan is one pass in blocks of whole documents and there is no exchange; the
ablation aggregates to one row per rule.

Nulls and edge cases: a null text has no words (fails ``few_words``); rows
are judged one by one, so repeated rows give equal rows; a null doc_id is
kept as null; other columns are ignored; an empty table gives an empty
ledger, and ablation counts of 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import (
    U64,
    HashedWords,
    binary_values,
    mix,
    read_table,
    split_docs,
    text_slices,
)

BLOCK_BYTES = 2 << 20
# Fixed value: the symbols that count as such.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
]

# Rule -> condition of failure over the measurements, in integers. The order
# gives the bits and must only be extended at the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeat_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "dup_lines": "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines",
    "upper_case": "100 * n_upper > 50 * n_letters",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BASE_RULES = ("few_words", "repeat_words")


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICIES = {
    "base": Policy("base", BASE_RULES),
    "v1": Policy("v1", tuple(RULES)),
}
PRODUCTION = "v1"


def _table(values: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[np.frombuffer(values, np.uint8)] = 1
    return t


_UPPER = bytes(range(65, 91))
_IS_SYMBOL = _table(SYMBOLS).astype(bool)
_IS_UPPER = _table(_UPPER).astype(bool)
_IS_LETTER = _table(_UPPER + bytes(range(97, 123))).astype(bool)
# first bytes of code points that aren't white space
_IS_CHAR = ~(_table(bytes(range(0x80, 0xC0))) + _table(SPACES)).astype(bool)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeat_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document, words in 3-word windows that occur twice or more in it."""
    doc = np.repeat(np.arange(len(counts)), counts)
    covered = np.zeros(len(hashes), bool)
    if len(hashes) >= 4:
        key = mix(mix(mix(hashes[:-2], hashes[1:-1]), hashes[2:]), doc[:-2].astype(U64))
        at = np.flatnonzero(doc[:-2] == doc[2:])
        key = key[at]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = at[twice]
        for step in range(3):
            covered[at + step] = True
    return np.bincount(doc[covered], minlength=len(counts))


def _lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = HashedWords()
    for batch in batches:
        for rows in text_slices(batch, "text", BLOCK_BYTES):
            texts = binary_values(rows.column("text"))
            b = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.append(0, np.cumsum([len(t) for t in texts]))
            words, counts = split_docs(texts)
            lines = np.array([_lines(t) for t in texts], np.int64)
            cols = [
                counts,
                _sums(_IS_CHAR[b], offsets),
                _sums(_IS_SYMBOL[b], offsets),
                lines[:, 1],
                repeat_words(table.hash_words(words), counts),
                lines[:, 0],
                _sums(_IS_UPPER[b], offsets),
                _sums(_IS_LETTER[b], offsets),
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in cols)],
                names=["doc_id", *MEASURES],
            )


def failures() -> Column:
    bits = [
        F.when(F.expr(rule), F.lit(1 << i)).otherwise(0).cast("long")
        for i, rule in enumerate(RULES.values())
    ]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def ledger(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the measurements and ``failed``, one bit per rule."""
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_measure, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    return measured.withColumn("failed", failures())


def passes(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    return book.withColumn("kept", passes(policy)).withColumn(
        "policy", F.lit(policy.version)
    )


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of the policy: documents that fail it, and documents
    that the policy would keep without it."""
    aggs = []
    for rule in policy.rules:
        bit = 1 << list(RULES).index(rule)
        rest = F.lit(policy.mask & ~bit).cast("long")
        fails = F.col("failed").bitwiseAND(F.lit(bit).cast("long")) != 0
        aggs.append(
            F.struct(
                F.lit(rule).alias("rule"),
                F.count_if(fails).alias("n_failed"),
                F.count_if(fails & (F.col("failed").bitwiseAND(rest) == 0)).alias("n_only"),
            )
        )
    return book.agg(F.array(*aggs).alias("rows")).select(F.inline("rows"))


def keep_clean(docs: DataFrame, policy: Policy = POLICIES[PRODUCTION]) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns."""
    verdict = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    verdict = verdict.withColumn("text", F.col("row.text").cast("string"))
    # the whole row goes through the scan, so no join by doc_id is needed
    kind = verdict.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(
                [pa.array(range(batch.num_rows), pa.int64()), batch.column("text")],
                names=["doc_id", "text"],
            )
            found = pa.Table.from_batches(list(_measure(iter([plain]))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    *(found.column(m).combine_chunks() for m in MEASURES),
                ],
                names=["row", *MEASURES],
            )

    schema = f"row {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = verdict.mapInArrow(run, schema).withColumn("failed", failures())
    return measured.where(passes(policy)).select("row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = apply_policy(ledger(read_table(spark, sf_dir, "documents")), POLICIES[PRODUCTION])
    base = F.col("failed").bitwiseAND(F.lit(POLICIES["base"].mask).cast("long")) != 0
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & F.col("kept")).alias("kept"),
        "failed",
    )


_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))

ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         text
  FROM d
), t AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i+1], ws[i+2]) AS n FROM t
), c AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n >= 2) GROUP BY doc_id
), m AS (
  SELECT w.doc_id,
    CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT) AS n_upper,
    CAST(len(regexp_extract_all(text, '[A-Za-z]')) AS BIGINT) AS n_letters
  FROM w LEFT JOIN c USING (doc_id)
), b AS (
  SELECT *, CAST({_BITS} AS BIGINT) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed
FROM b
"""
