"""Operator 9: benchmark decontamination on canonical templates.

Words become template tokens: numbers, names (capitalised words inside a
sentence, but not words all in capitals) and units (after a number) are replaced by typed placeholders, all
other words are lower-cased and lose punctuation at their ends. Windows of
``window`` tokens are hashed on both sides and joined by hash, so a question
with other numbers or names still meets its item. Windows with fewer than
half plain words are no evidence there and are left out. Beside its template
every window is hashed as it stands (lower case, no placeholders, whatever its
words), so a word-for-word copy always meets its item, also where numbers and
names dominate or capitals are lost; these windows are judged by themselves.

Joined windows of a document and an item on one diagonal (document position
minus item position) are put together. Slot consistency: along a diagonal,
equal slot values of the item must stand against equal values of the document
and, for names, different ones against different ones; windows that break the
mapping of the windows before them are dropped. A document is contaminated by
an item if the consistent windows hold a run of ``min_run`` tokens (or the
whole item, if that is shorter), or cover ``min_cover`` of the item's windows.

Scale: one pass over the texts; windows of all lengths are put together from
runs hashed by doubling, and only windows that occur in the benchmark leave the
task. For that the set of the benchmark's window hashes is given to the tasks if
its windows are at most ``set_limit`` rows (counted); a larger benchmark is
joined by a shuffle of all windows instead. Groups with too few windows for any
verdict are dropped before they are judged. A passage in a third of all
documents gives one group per document and item, bounded by the item's length.

Nulls and edge cases: null or empty texts and items match nothing; items
shorter than ``min_item`` tokens are not used; items with fewer tokens than a
window use one window of their own length; exactly repeated rows are one
document (one result row), and rows that share a doc_id, or have none, but not
the text are judged and dropped each by itself; the same holds for items; ties
between diagonals go to the later first token; very long texts are one row of
windows that match, not of all; other columns are ignored; an empty table on
either side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import (
    U64,
    WordTable,
    binary_values,
    checkpointed,
    read_table,
    signed,
    split_docs,
    text_slices,
)


@dataclass(frozen=True)
class Rules:
    window: int = 8
    min_item: int = 5
    min_run: int = 13
    min_cover: float = 0.5
    set_limit: int = 2_000_000


PRODUCTION = Rules()
BLOCK_BYTES = 4 << 20
# Contaminated ids (8 bytes each) up to which their table is broadcast.
BROADCAST_IDS = 500_000

# Units that are taken as such after a number.
UNITS = (
    "mm cm m km in inch inches ft feet yd yard yards mi mile miles "
    "mg g kg t oz lb lbs pound pounds ton tons ml l liter liters litre litres gal gallon gallons "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years usd eur gbp dollar dollars euro euros cent cents percent degrees degree "
    "hz khz mhz ghz w kw mw v kv a kb mb gb tb mph kmh kph"
).split()

_NUMBER = re.compile(r"[+\-$€£#]?\d[\d.,:/\-]*[%°]?$")
_EDGE = re.compile(r"^\W+|\W+$")
LITERAL, NUMBER, UNIT, CAPITAL = range(4)
_UNITS = frozenset(UNITS)
_STOP = (".", "!", "?", ":", ";")
# Placeholder tokens; the numbers are arbitrary marks.
_MARKS = np.array([0, 0x6E756D, 0x756E6974, 0x6E616D65], U64) * U64(0x9E3779B97F4A7C15)
_STEP = U64(0x9FB21C651E98DF25)
_TURN = U64(0xD6E8FEB86659FD93)


def classify(word: bytes) -> tuple[int, int, int, bool]:
    """(hash of the plain form, of the literal form, kind, whether a sentence
    ends here)."""
    text = word.decode("utf-8", "replace")
    core = _EDGE.sub("", text)
    ends = text.rstrip("\"')]»”’").endswith(_STOP)
    bare = text.strip("()[]\"'.,;:!?")
    if _NUMBER.match(bare):
        return 0, xxhash.xxh3_64_intdigest(bare.lower().encode()), NUMBER, ends
    plain = core.lower()
    h = xxhash.xxh3_64_intdigest(plain.encode())
    # signs alone stand for themselves
    own = h if plain else xxhash.xxh3_64_intdigest(text.encode())
    if plain in _UNITS:
        return h, own, UNIT, ends
    # all capitals is a way of writing, not a name
    named = core[:1].isupper() and core != core.upper()
    return h, own, CAPITAL if named else LITERAL, ends


class Tokens:
    """Template tokens of words, with what is known of each distinct word."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.table = WordTable()
        self.known: list[tuple[int, int, int, bool]] = []
        self.arrays = None

    def template(self, words: list[bytes], counts: np.ndarray):
        """(token hash, literal hash, kind) of every word; kind 3 is a name here."""
        if len(self.table) > self.limit:
            self._reset()
        ids = self.table.ids(words)
        if len(self.table) > len(self.known):
            fresh = list(self.table)[len(self.known) :]
            self.known.extend(map(classify, fresh))
            h, own, kind, ends = zip(*self.known)
            self.arrays = np.array(h, U64), np.array(own, U64), np.array(kind, np.int8), np.array(ends, bool)
        if not len(ids):
            return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int8)
        h, own, kind, ends = (a[ids] for a in self.arrays)
        begins = np.append(True, ends[:-1])
        first = np.cumsum(counts) - counts
        begins[first[counts > 0]] = True
        after_number = np.append(False, kind[:-1] == NUMBER) & ~_at(first[counts > 0], len(ids))
        kind = np.where((kind == CAPITAL) & begins, LITERAL, kind)
        kind = np.where((kind == UNIT) & ~after_number, LITERAL, kind)
        return np.where(kind == LITERAL, h, _MARKS[kind]), own, kind


def _at(index: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[index] = True
    return out


class Windows:
    """Hashes of the ``k`` tokens from each position on, for any ``k``: runs of
    1, 2, 4, ... tokens are hashed once, by doubling, and two of them make a
    window."""

    def __init__(self, tokens: np.ndarray):
        self.runs = {1: tokens}

    def _run(self, n: int) -> np.ndarray:
        if n not in self.runs:
            half = self._run(n // 2)
            self.runs[n] = _pair(half[: len(half) - n // 2], half[n // 2 :])
        return self.runs[n]

    def hashes(self, k: int) -> np.ndarray:
        if len(self.runs[1]) < k:
            return np.zeros(0, U64)
        n = 1 << (k.bit_length() - 1)
        run, rest = self._run(n), k - n
        return _pair(run[: len(run) - rest], run[rest:], k) if rest else run


def _pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    h = a * _STEP + b + U64(salt)
    h ^= h >> U64(29)
    h *= _TURN
    h ^= h >> U64(32)
    return h


class Wanted:
    """A sorted set of hashes, with a table of bits in front that turns away
    nearly all others."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.mask = U64((1 << max(16, (16 * len(hashes)).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[hashes & self.mask] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Positions of ``h`` that are in the set."""
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.bits[(h & self.mask).view(np.int64)])
        here = h[at]
        near = np.minimum(np.searchsorted(self.hashes, here), len(self.hashes) - 1)
        return at[self.hashes[near] == here]


def _slots(words: list[bytes], kind: np.ndarray, at: int, k: int) -> list[str]:
    """Slot values of a window: offset, type letter and value."""
    out = []
    for j in range(k):
        if kind[at + j] != LITERAL:
            value = _EDGE.sub("", words[at + j].decode("utf-8", "replace")).lower()
            out.append(f"{j}{' nun'[kind[at + j]] if kind[at + j] != CAPITAL else 'N'}{value}")
    return out


_ROWS = (
    "key long, digest long, pos int, h long, k int, slots array<string>, n_tokens int, literal boolean"
)
# Keeps the hashes of literal windows apart from those of templates.
_LITERAL_SEED = U64(0x6C69746572616C)


def _windows(rules: Rules, lengths: list[int], wanted) -> callable:
    """Task function: (key, text) rows to template and literal windows.

    ``lengths``: window lengths; an empty list means one per text, the
    benchmark's own (``window`` or the text's length if that is shorter).
    ``wanted``: broadcast sorted hashes to keep, or None for all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        keep = None if wanted is None else Wanted(wanted.value)
        for batch in batches:
            met: set[tuple] = set()
            for rows in text_slices(batch, "text", BLOCK_BYTES):
                keys = list(zip(rows.column("key").to_pylist(), rows.column("digest").to_pylist()))
                # a repeated row of the batch says nothing new
                fresh = [key not in met and not met.add(key) for key in keys]
                keys = [key for key, new in zip(keys, fresh) if new]
                rows = rows.filter(pa.array(fresh, pa.bool_()))
                words, counts = split_docs(binary_values(rows.column("text")))
                t, own, kind = tokens.template(words, counts)
                ends = np.cumsum(counts)
                start = ends - counts
                plain = np.append(0, np.cumsum(kind == LITERAL))
                forms = Windows(t), Windows(own)
                out = []
                for k in lengths or sorted({min(rules.window, int(c)) for c in counts}):
                    if k < rules.min_item:
                        continue
                    for literal in (False, True):
                        h = forms[literal].hashes(k)
                        if literal:
                            h = h ^ _LITERAL_SEED
                        pos = np.arange(len(h)) if keep is None else keep.find(h)
                        if not literal:
                            pos = pos[2 * (plain[pos + k] - plain[pos]) >= k]
                        row = np.searchsorted(ends, pos, "right")
                        inside = pos + k <= ends[row]
                        if not lengths:
                            inside &= np.minimum(rules.window, counts[row]) == k
                        pos, row = pos[inside], row[inside]
                        for p, r in zip(pos.tolist(), row.tolist()):
                            out.append(
                                (
                                    *keys[r],
                                    p - int(start[r]),
                                    int(signed(h[p : p + 1])[0]),
                                    k,
                                    [] if literal else _slots(words, kind, p, k),
                                    int(counts[r]),
                                    literal,
                                )
                            )
                cells = list(zip(*out)) if out else [()] * 8
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, x) for c, x in zip(cells, types)],
                    names=["key", "digest", "pos", "h", "k", "slots", "n_tokens", "literal"],
                )

    return run


def _slot(slot: str) -> tuple[str, str, str]:
    """(offset, type letter, value) of a slot."""
    at = 0
    while slot[at].isdigit():
        at += 1
    return slot[:at], slot[at], slot[at + 1 :]


def _pairs(doc: list[str], item: list[str]) -> list[tuple[str, str, str]] | None:
    """(type, item value, document value) of a window's slots."""
    out = []
    for d, i in zip(map(_slot, doc), map(_slot, item)):
        if d[:2] != i[:2]:
            return None
        out.append((d[1], i[2], d[2]))
    return out


def _judge_diagonal(rules: Rules, windows: list[tuple], k: int, total: int, item_windows: int) -> tuple | None:
    """Verdict on one diagonal and form; ``windows``: (item position, slots,
    item slots) in order, each position once."""
    there: dict = {}
    back: dict = {}
    good, new_values, slots = [], False, set()
    for at, doc, item in windows:
        pairs = _pairs(doc, item)
        if pairs is None:
            continue
        if not all(
            there.get((t, i), d) == d and (t != "N" or back.get(d, i) == i) for t, i, d in pairs
        ):
            continue
        for t, i, d in pairs:
            there[(t, i)] = d
            if t == "N":
                back[d] = i
            new_values |= i != d
            slots.add((t, i))
        good.append(at)
    if not good:
        return None
    run = longest = 1
    for a, b in zip(good, good[1:]):
        run = run + 1 if b == a + 1 else 1
        longest = max(longest, run)
    run_tokens = longest - 1 + k
    cover = len(good) / item_windows
    if run_tokens < min(rules.min_run, total) and cover < rules.min_cover:
        return None
    return good[0], len(good), run_tokens, cover, len(slots), new_values


def judge(rules: Rules):
    """Group function: the windows of one document and item to the verdicts of
    their diagonals and forms."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key = tuple(rows[c].iloc[0] for c in ("doc_id", "digest", "item_id"))
        diagonals: dict[tuple, dict[int, tuple]] = {}
        known: dict[tuple, tuple] = {}
        columns = ("diagonal", "literal", "item_pos", "slots", "item_slots", "k", "item_tokens", "item_windows")
        for d, form, at, doc, item, k, total, n in zip(*(rows[c].tolist() for c in columns)):
            diagonals.setdefault((d, form), {}).setdefault(at, (at, doc, item))
            known[d, form] = k, total, n
        out = []
        for (d, form), windows in diagonals.items():
            found = _judge_diagonal(rules, [windows[at] for at in sorted(windows)], *known[d, form])
            if found:
                first, *rest = found
                out.append((*key, int(d + first), *rest))
        return pd.DataFrame(out, columns=_VERDICT_COLS)

    return run


_VERDICT = (
    "doc_id long, digest long, item_id long, first_token long, n_windows long, run_tokens long, "
    "cover double, n_slots long, reparameterised boolean"
)
_VERDICT_COLS = [x.split()[0] for x in _VERDICT.split(", ")]


def _texts(df: DataFrame, key: str) -> DataFrame:
    """(key, digest, text): unlike texts under one key are told apart."""
    text = F.col("text").cast("string")
    return df.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("digest"), text.alias("text"))


def _leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, rules: Rules) -> DataFrame:
    """One row per contaminated text of a doc_id, and item: the best diagonal."""
    found = _texts(benchmark, "item_id").mapInArrow(_windows(rules, [], None), _ROWS)
    found = found.select(
        F.col("key").alias("item_id"),
        F.col("digest").alias("item_digest"),
        F.col("pos").alias("item_pos"),
        "h",
        "k",
        F.col("slots").alias("item_slots"),
        F.col("n_tokens").alias("item_tokens"),
        "literal",
    ).dropDuplicates(["item_id", "item_digest", "item_pos", "h"])
    # per item and form: its usable windows
    sizes = found.groupBy(
        F.col("item_id").alias("same_id"), F.col("item_digest").alias("same_digest"), F.col("literal").alias("same_form")
    ).agg(F.count("*").alias("item_windows"))
    same = (
        F.col("item_id").eqNullSafe(F.col("same_id"))
        & (F.col("item_digest") == F.col("same_digest"))
        & (F.col("literal") == F.col("same_form"))
    )
    items = checkpointed(spark, found.join(sizes, same).drop("same_id", "same_digest", "same_form"))
    lengths = sorted(r.k for r in items.select("k").distinct().collect())  # at most ``window``
    # rows, not hashes alone, as they are what is broadcast
    small = items.count() <= rules.set_limit
    wanted = None
    if small:
        hashes = items.select("h").distinct().toPandas()["h"].to_numpy(np.int64).view(U64)
        wanted = spark.sparkContext.broadcast(np.sort(hashes))
    hits = _texts(docs, "doc_id").mapInArrow(_windows(rules, lengths or [rules.window], wanted), _ROWS)
    hits = hits.select(F.col("key").alias("doc_id"), "digest", "pos", "h", "slots")
    joined = hits.join(F.broadcast(items) if small else items, "h")
    joined = joined.withColumn("diagonal", F.col("pos") - F.col("item_pos")).drop("h")
    group = ["doc_id", "digest", "item_id", "item_digest", "diagonal", "literal"]
    # windows a group has at least if it holds the run, or the cover, asked for
    run = F.least(F.lit(rules.min_run), F.col("item_tokens")) - F.col("k") + 1
    least = F.least(run, F.ceil(rules.min_cover * F.col("item_windows") - 1e-9))
    enough = joined.withColumn("there", F.count("*").over(Window.partitionBy(*group))).where(F.col("there") >= least)
    needed = enough.select(*group, "item_pos", "slots", "item_slots", "k", "item_tokens", "item_windows")
    # one group per document and item, which Python is called for once
    verdicts = needed.groupBy(*group[:4]).applyInPandas(judge(rules), _VERDICT)
    best = verdicts.groupBy("doc_id", "digest", "item_id").agg(
        F.max(F.struct("run_tokens", "n_windows", "cover", "n_slots", "reparameterised", "first_token")).alias("b")
    )
    return best.select(
        "doc_id", "digest", "item_id", "b.first_token", "b.n_windows", "b.run_tokens", "b.cover",
        "b.n_slots", "b.reparameterised",
    )


def find_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, rules: Rules = PRODUCTION
) -> DataFrame:
    """One row per contaminated document and item: the best diagonal."""
    return _leaks(spark, docs, benchmark, rules).drop("digest")


def drop_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, rules: Rules = PRODUCTION
) -> DataFrame:
    """The rows of ``docs`` without contaminated ones, told by doc_id and text."""
    bad = _leaks(spark, docs, benchmark, rules).select(
        F.col("doc_id").alias("__leaked_doc_id"), F.col("digest").alias("__leaked_digest")
    )
    bad = checkpointed(spark, bad.distinct())
    if bad.count() <= BROADCAST_IDS:
        bad = F.broadcast(bad)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__leaked_doc_id")) & (
        F.xxhash64(docs["text"].cast("string")) == F.col("__leaked_digest")
    )
    return docs.join(bad, same, "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(
        spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
