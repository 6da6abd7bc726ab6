"""Operator 12: near duplicates by SimHash and the generalised pigeonhole.

A document's fingerprint has a bit set if more than half of its shingles'
hashes have it set (shingles of ``words`` words, ASCII lower case, repeats
included, hashed with XXH64, seed 42). Fingerprints that differ in at most
``distance`` bits are linked; a document's class is its connected component.

1. Equal fingerprints are one node.
2. Correlated bits are grouped: from the exact 64 x 64 table of bits set
   together, each part takes the bits that go with those it has, so that the
   parts themselves tell documents apart.
3. Generalised pigeonhole: if parts 1..m get thresholds t_i that add up to
   ``distance`` - m + 1, two linked fingerprints differ in at most t_i bits of
   some part (-1: the part isn't searched). From exact histograms of all
   parts' values the candidates of every (part, threshold) are estimated, and
   dynamic programming finds the cheapest thresholds, over several m.
4. Probe: a node has a key for every way to leave t_i bits of part i out; two
   nodes that differ in at most t_i bits of it share one. A group is done if
   it is one class. If at most ``small`` members are outside its largest
   class, all members are compared with these. If not, all are compared with
   two hubs, one of them of the largest class.
5. Members of the groups left are split: they agree on the group's bits, so
   what is left of 64 is cut into ``distance`` + 1 runs, and two linked members
   agree on one of these. Groups get smaller or closer with each step; when at
   most ``distance`` bits are left, the hubs reach everyone. No pair is given
   up, and no large group emits all its pairs.

Every candidate is verified on the whole fingerprints (a bit count). Keys that
hold over a 1024th of the rows, at most 1024, are joined by broadcast, so no
task gets a hot key. The driver gets the bit table, the histograms
(2^width values a part) and counts; links, labels and groups stay in the
shared checkpoint folder.

Nulls and edge cases: texts without words, null ones too, have the fingerprint
zero and are linked like any other; a text with fewer words than a shingle is
one shingle; a class is named by its least doc_id that is not null, and null
if it has none; rows that share a doc_id are rows of their own; a very long
text is read in pieces; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import U64, Tables, binary_values, components, mix, read_table, signed, spread_join

BITS = 64
SEED = 42
# Bytes of a text that are split into words at a time; shingles summed at a time.
PIECE = 1 << 20
BLOCK = 1 << 16


@dataclass(frozen=True)
class Params:
    words: int = 4
    distance: int = 4
    # numbers of parts that are tried
    parts: tuple[int, ...] = (4, 5)
    # members outside a group's largest class, up to which all are compared
    small: int = 128
    # cost of a key, in comparisons
    key_cost: float = 8.0


PRODUCTION = Params()
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_runs(text: bytes, k: int) -> Iterator[list[bytes]]:
    """Words of a text piece by piece; a run begins with the last k-1 words of
    the one before."""
    tail: list[bytes] = []
    yielded, start = False, 0
    while start < len(text):
        gap = _GAP.search(text, start + PIECE) if start + PIECE < len(text) else None
        stop = gap.start() if gap else len(text)
        words = text[start:stop].split()
        start = max(stop, start + 1)
        if not words:
            continue
        run = tail + words
        if len(run) >= k:
            yield run
            yielded = True
        tail = run[max(0, len(run) - k + 1) :] if k > 1 else []
    if tail and not yielded:
        yield tail


def shingle_hashes(words: list[bytes], k: int) -> list[int]:
    """XXH64 of every run of ``k`` words (of all words, if they are fewer)."""
    joined = b" ".join(words)
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    first = (ends - sizes)[: len(words) - k + 1].tolist()
    last = (ends - 1)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:z], SEED) for a, z in zip(first, last)]


def bits_of(values: np.ndarray) -> np.ndarray:
    """(n, 64) bits of unsigned 64-bit values, least bit first."""
    raw = np.ascontiguousarray(values).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def fingerprints(texts: list[bytes], k: int) -> np.ndarray:
    """Unsigned fingerprint of every text."""
    sums = np.zeros((len(texts), BITS), np.int64)
    total = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []

    def add() -> None:
        if not hashes:
            return
        doc, n = np.array(owners).T
        part = np.add.reduceat(bits_of(np.array(hashes, U64)), np.cumsum(n) - n, axis=0, dtype=np.int64)
        np.add.at(sums, doc, part)
        np.add.at(total, doc, n)
        hashes.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for run in word_runs(text.lower(), k):
            found = shingle_hashes(run, k)
            hashes.extend(found)
            owners.append((i, len(found)))
            if len(hashes) >= BLOCK:
                add()
    add()
    set_bits = 2 * sums > total[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(U64)


def _fingerprint_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints(binary_values(batch.column("text")), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed(found), pa.int64())], names=["doc_id", "fp"]
            )

    return run


def fingerprinted(docs: DataFrame, words: int = PRODUCTION.words) -> DataFrame:
    """Per row of ``docs``: doc_id and fp, the fingerprint as a signed long."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_fingerprint_rows(words), "doc_id long, fp long")


def _unsigned(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(U64)


def _bit_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (fp) to (i, j, n): nodes with bits i and j set."""
    table = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        bits = bits_of(_unsigned(batch)).astype(np.float32)
        table += (bits.T @ bits).astype(np.int64)
    i, j = np.nonzero(table)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i), pa.array(j), pa.array(table[i, j])], names=["i", "j", "n"]
    )


def bit_table(nodes: DataFrame) -> np.ndarray:
    """(64, 64) numbers of nodes that have both bits set."""
    rows = nodes.select("fp").mapInArrow(_bit_table, "i long, j long, n long")
    out = np.zeros((BITS, BITS), np.int64)
    for r in rows.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # at most 64 * 64
        out[r.i, r.j] = r.n
    return out


def grouped_bits(table: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, correlated bits together."""
    p = np.diag(table) / max(n, 1)
    cov = table / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    link = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(link, 0)
    left = set(range(BITS))
    out = []
    for part in range(parts):
        size = len(left) // (parts - part)
        free = sorted(left)
        # the bit with the strongest tie begins
        group = [max(free, key=lambda b: (link[b, free].max(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: link[b, group].mean())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def _packed(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The values of some bits, moved together."""
    out = np.zeros(len(values), np.int64)
    for at, b in enumerate(bits):
        out |= (((values >> U64(b)) & U64(1)) << U64(at)).astype(np.int64)
    return out


def _histogram(parts: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(bits), np.int64) for bits in parts]
        for batch in batches:
            values = _unsigned(batch)
            for c, bits in zip(counts, parts):
                c += np.bincount(_packed(values, bits), minlength=len(c))
        for i, c in enumerate(counts):
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i)), pa.array(at), pa.array(c[at])], names=["part", "value", "n"]
            )

    return run


def histograms(nodes: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """Nodes per value of every part: 2^width numbers each, however many nodes."""
    rows = nodes.select("fp").mapInArrow(_histogram(parts), "part long, value long, n long")
    found = rows.groupBy("part", "value").agg(F.sum("n").alias("n")).toPandas()
    out = [np.zeros(1 << len(bits), np.int64) for bits in parts]
    for i, rows_of in found.groupby("part"):
        out[int(i)][rows_of["value"].to_numpy()] = rows_of["n"].to_numpy()
    return out


def estimate(histogram: np.ndarray, t: int, params: Params) -> float:
    """Comparisons and key costs of one part at threshold ``t``."""
    if t < 0:
        return 0.0
    width = len(histogram).bit_length() - 1
    value = np.arange(len(histogram))
    cost = 0.0
    for out in combinations(range(width), t):
        n = histogram
        keep = np.ones(len(histogram), bool)
        for b in out:
            n = n + n[value ^ (1 << b)]
            keep &= (value >> b) & 1 == 0
        n = n[keep].astype(np.float64)
        # a group costs all its pairs, or a few comparisons per member
        cost += float((n * np.minimum(n - 1, params.small)).clip(0).sum() / 2)
        cost += params.key_cost * float(n.sum())
    return cost


def allocate(counts: list[np.ndarray], params: Params) -> tuple[float, list[int]]:
    """The cheapest thresholds that add up to distance - parts + 1."""
    budget = params.distance - len(counts) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    # thresholds of 3 and more have more keys than any saving
    choices = range(-1, min(2, params.distance) + 1)
    for histogram in counts:
        costs = {t: estimate(histogram, t, params) for t in choices}
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in choices:
                total = cost + costs[t]
                if used + t not in step or total < step[used + t][0]:
                    step[used + t] = (total, [*chosen, t])
        best = step
    return best[budget]


def probe_masks(nodes: DataFrame, params: Params) -> list[int]:
    """Masks of the bits a probe compares: two nodes at the distance or nearer
    agree on one of them."""
    n = nodes.count()
    table = bit_table(nodes)
    tried = [grouped_bits(table, n, m) for m in params.parts]
    counts = histograms(nodes, [bits for parts in tried for bits in parts])
    plans, at = [], 0
    for parts in tried:
        cost, thresholds = allocate(counts[at : at + len(parts)], params)
        at += len(parts)
        plans.append((cost, parts, thresholds))
    _, parts, thresholds = min(plans, key=lambda plan: plan[0])
    masks = []
    for bits, t in zip(parts, thresholds):
        if t >= 0:
            whole = sum(1 << b for b in bits)
            masks += [whole - sum(1 << b for b in out) for out in combinations(bits, t)]
    return masks


def _as_long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _first_keys(masks: list[int]):
    """Task function: (fp) to (g, mask, fp), one row per mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _unsigned(batch)
            for mask in masks:
                keys = mix(values & U64(mask), np.full(len(values), U64(mask)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(keys)),
                        pa.array(np.full(len(values), _as_long(mask))),
                        batch.column("fp"),
                    ],
                    names=["g", "mask", "fp"],
                )

    return run


def _finer_keys(runs: int):
    """Task function: (g, mask, fp, class) to rows that agree on one more run
    of the bits outside ``mask``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _unsigned(batch)
            groups = batch.column("g").to_numpy().astype(np.int64).view(U64)
            masks = batch.column("mask").to_numpy().astype(np.int64).view(U64)
            classes = batch.column("class").to_numpy()
            for mask in np.unique(masks).tolist():
                at = np.flatnonzero(masks == U64(mask))
                rest = [b for b in range(BITS) if not mask >> b & 1]
                for bits in np.array_split(rest, min(runs, len(rest))):
                    sub = sum(1 << int(b) for b in bits)
                    key = mix(groups[at], mix(values[at] & U64(sub), np.full(len(at), U64(sub))))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signed(key)),
                            pa.array(np.full(len(at), _as_long(mask | sub))),
                            pa.array(signed(values[at])),
                            pa.array(classes[at]),
                        ],
                        names=["g", "mask", "fp", "class"],
                    )

    return run


_ROWS = "g long, mask long, fp long, class long"


def _relabelled(rows: DataFrame, labels: DataFrame | None, column: str) -> DataFrame:
    """``rows`` with the class that ``labels`` give the node in ``column``."""
    if labels is None:
        return rows.withColumn("class", F.col(column))
    named = labels.select(F.col("node").alias(column), F.col("class").alias("__class"))
    found = rows.join(named, column, "left")
    return found.withColumn("class", F.coalesce("__class", column)).drop("__class")


def _merged(tables: Tables, labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, class) after ``links`` (a, b) between classes."""
    fresh = components(tables, links)
    if labels is None:
        return fresh
    new = fresh.select(F.col("node").alias("class"), F.col("class").alias("new"))
    moved = labels.join(new, "class", "left").select("node", F.coalesce("new", "class").alias("class"))
    return tables.store(moved.unionByName(fresh.join(labels.select("node"), "node", "left_anti")))


def link_classes(
    spark: SparkSession, nodes: DataFrame, params: Params = PRODUCTION, tables: Tables | None = None
) -> DataFrame | None:
    """(node, class) of the linked fingerprints of ``nodes`` (fp), each once;
    None if there is no link."""
    tables = tables or Tables(spark, "simhash")
    masks = probe_masks(nodes, params)
    first = nodes.select("fp").mapInArrow(_first_keys(masks), "g long, mask long, fp long")
    rows = tables.store(first.withColumn("class", F.col("fp")))
    labels: DataFrame | None = None
    total = rows.count()
    while total:
        # a member of the largest class and one of another class
        of_class = rows.groupBy("g", "class").agg(
            F.count("*").alias("n"), F.min_by("fp", F.xxhash64("fp", "g")).alias("hub")
        )
        hub = F.struct("class", "hub", "n")
        groups = of_class.groupBy("g").agg(
            F.count("*").alias("classes"),
            F.sum("n").alias("size"),
            F.max_by(hub, F.struct("n", "class")).alias("top"),
            F.min_by(hub, F.struct("n", F.xxhash64("class", "g"))).alias("other"),
        )
        groups = groups.where("classes > 1").withColumn("minor", F.expr("size - top.n"))
        groups = tables.store(groups.drop("classes"))
        met = tables.store(spread_join(rows, groups, ["g"], "size", total))
        few = met.where(F.col("minor") <= params.small)
        minors = few.where("class <> top.class").groupBy("g", "size").agg(
            F.collect_list(F.struct("fp", "class")).alias("members")
        )
        minors = tables.store(minors)
        near = f"bit_count(fp ^ {{0}}.{{1}}) <= {params.distance} and class <> {{0}}.class"
        # compared where they are: only links become rows
        linked = F.expr(f"transform(filter(members, m -> {near.format('m', 'fp')}), m -> m.class)")
        links = (
            spread_join(few.select("g", "fp", "class"), minors, ["g"], "size", total)
            .select(F.col("class").alias("a"), F.explode(F.array_distinct(linked)).alias("b"))
        )
        many = met.where(F.col("minor") > params.small)
        for end in ("top", "other"):
            links = links.unionByName(
                many.where(near.format(end, "hub")).select(
                    F.col("class").alias("a"), F.col(f"{end}.class").alias("b")
                )
            )
        links = tables.store(links.distinct())
        if not links.isEmpty():
            labels = _merged(tables, labels, links)
        left = _relabelled(many.select("g", "mask", "fp", "class"), labels, "class")
        finer = tables.store(left.mapInArrow(_finer_keys(params.distance + 1), _ROWS))
        tables.drop(rows, groups, met, minors, links)
        rows = finer
        total = rows.count()
    tables.drop(rows)
    return labels


def near_duplicates(spark: SparkSession, docs: DataFrame, params: Params = PRODUCTION) -> DataFrame:
    """Per row of ``docs``: doc_id, fp, component_id (least doc_id reached)."""
    tables = Tables(spark, "simhash")
    found = tables.store(fingerprinted(docs, params.words))
    nodes = tables.store(
        found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    )
    total = found.count()
    labels = link_classes(spark, nodes, params, tables) if total else None
    classed = _relabelled(nodes, labels, "fp")
    names = classed.groupBy("class").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    named = spread_join(classed, names, ["class"], "size", total)
    return spread_join(found, named.select("fp", "copies", "component_id"), ["fp"], "copies", total).select(
        "doc_id", "fp", "component_id"
    )


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
