"""Operator 7: repeated passages by bucket-pointer refinement.

Every byte covered by an ``n_match``-byte string that also starts earlier
(smaller doc_id, or the same document and an earlier start) is removed.

Bucket pointers. Every text position starts in the bucket of its 8-byte
gram. A bucket is refined by the bucket pointers of *later offsets*, and the
refined pointers are used again in the next round: depth 8 -> 16 (pointer at
i and at i+8) -> 32 -> 64 -> ``n_match``. A full table of ranks would need all
positions in one place, so a pointer here is a 64-bit value derived from the
pair it refines; equal pointers mean equal strings, which is all that removal
needs, and tasks agree on them without talking. Sorting by pointers then
brings equal strings together.

Only few positions are sorted across tasks:

1. Each ``n_match``-byte window names its least depth-32 pointer as anchor
   (leftmost on ties). Equal windows name the same anchor at the same offset.
   Windows in a row with one anchor form a segment; its pointer (depth =
   the segment's bytes) is refined from its first and last window.
2. Segments are sorted by (anchor bucket h, segment pointer s, doc, start).
   A bucket with one segment pointer needs no further depth: all but its
   first segment are repeats. In a bucket with several, the first of each
   pointer is open: some windows may be repeats and others not.
3. Open segments are split into groups of ``GROUP`` windows, aligned to the
   anchor. All windows of a group share a core of n_match - GROUP + 1 bytes,
   whose pointer is the group's bucket; step 2 is used again on (core, group
   pointer). Groups whose core occurs once hold no repeat.
4. The single windows of groups that are still open are sorted by (128-bit
   window pointer, doc, start); all but the first are repeats.

Each task sorts its own batch first and sends on one row per bucket (and
window pointer), so a passage that a third of all rows share sends as many
rows as there are batches. Texts are dealt out by doc_id once (one exchange,
used by steps 3 and 4 and by the removal).

Nulls and edge cases: a null or empty text has no bytes and its row stays; a
null doc_id sorts before all others; exactly repeated rows are one document and
give equal result rows; rows that share a doc_id, or have none, but not the
text are documents of their own, in the order of a hash of their texts (where
there are such rows, all documents are numbered in order by a sort, and the
numbers take the place of the ids); other columns are ignored; an empty table
gives an empty result. Very long texts are worked on in blocks of ``BLOCK``
window starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import U64, mix, read_table, signed
from postlens.llm.op11_importance import ranked

MATCH_BYTES = 100
ANCHOR_DEPTH = 32
# Windows in a group of step 3.
GROUP = 8
# Window starts worked on at a time (arrays stay in cache).
BLOCK = 1 << 18
NULL_KEY = -(1 << 63)

# Row kinds, in the low two bits of ``pk`` (start << 33 | length << 2 | kind).
REP, REPEAT, OPEN, REP_OPEN = 0, 1, 2, 3


def _pack(start, n, kind):
    return signed(
        (start.astype(U64) << U64(33)) | (n.astype(U64) << U64(2)) | U64(kind)
    )


def pointers(b: np.ndarray, n_match: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket pointers of depth 8, 32 and ``n_match`` for the bytes ``b``."""
    x = b.astype(U64)
    x = x[:-1] | (x[1:] << U64(8))
    x = x[:-2] | (x[2:] << U64(16))
    p8 = x[:-4] | (x[4:] << U64(32))
    p = mix(p8[:-8], p8[8:])
    p32 = mix(p[:-16], p[16:])
    p, depth = p32, 32
    while 2 * depth <= n_match:
        p = mix(p[:-depth], p[depth:])
        depth *= 2
    rest = n_match - depth
    full = mix(p[: len(p) - rest], p[rest:]) if rest else p
    return p8, p32, full


def _least_in_window(v: np.ndarray, width: int) -> np.ndarray:
    m, w = v, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    rest = width - w
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets (nulls as empty)."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[offsets[0] : offsets[-1]], offsets - offsets[0]


def segments(b: np.ndarray, offsets: np.ndarray, n_match: int):
    """(h, s, row, start in row, windows) of every segment, as arrays."""
    out = []
    lengths = np.diff(offsets)
    long_rows = np.flatnonzero(lengths >= n_match)
    if not len(long_rows):
        return tuple(np.zeros(0, t) for t in (U64, U64, np.int64, np.int64, np.int64))
    ends = offsets[1:]
    begin, stop = int(offsets[long_rows[0]]), int(ends[long_rows[-1]]) - n_match + 1
    span = n_match - ANCHOR_DEPTH + 1
    while begin < stop:
        last = min(begin + BLOCK, stop)
        piece = b[begin : last + n_match - 1]
        _, p32, full = pointers(piece, n_match)
        n = last - begin
        p32 = p32[: n + span - 1]
        ranked = (p32 & U64(0xFFFFFFFF00000000)) | np.arange(len(p32), dtype=U64)
        anchor = (_least_in_window(ranked, span) & U64(0xFFFFFFFF)).astype(np.int64)[:n]
        valid = np.ones(n, bool)
        first = int(np.searchsorted(ends, begin, "right"))
        past = int(np.searchsorted(ends, last + n_match - 1, "left"))
        for e in ends[first : past + 1]:
            valid[max(0, e - n_match + 1 - begin) : max(0, e - begin)] = False
        change = np.empty(n, bool)
        change[0] = True
        change[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
        starts = np.flatnonzero(change)
        stops = np.append(starts[1:], n)
        if last < stop and len(starts) > 1:
            # The last run may go on in the next block: take it up there.
            last = begin + int(starts[-1])
            starts, stops = starts[:-1], stops[:-1]
        keep = valid[starts]
        starts, stops = starts[keep], stops[keep]
        if len(starts):
            s = mix(mix(full[starts], full[stops - 1]), (stops - starts).astype(U64))
            at = starts + begin
            row = np.searchsorted(ends, at, "right")
            out.append((p32[anchor[starts]], s, row, at - offsets[row], stops - starts))
        begin = last
    return tuple(np.concatenate(x) for x in zip(*out))


def _merge(key: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Adjoining ranges of one key as one range."""
    if not len(key):
        return key, start, n
    o = np.lexsort((start, key))
    key, start, n = key[o], start[o], n[o]
    new = np.empty(len(key), bool)
    new[0] = True
    new[1:] = (key[1:] != key[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key)) - 1
    return key[first], start[first], start[last] + n[last] - start[first]


def _emit(h, s, doc, pk) -> pa.RecordBatch:
    # document first: neighbours share it, which the shuffle's compression uses
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc),
            pa.array(pk),
            pa.array(signed(np.ascontiguousarray(h))),
            pa.array(signed(np.ascontiguousarray(s))),
        ],
        names=["k", "pk", "h", "s"],
    )


def _spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(doc.view(U64), start.astype(U64))


def _repeat_rows(doc, start, n) -> pa.RecordBatch:
    doc, start, n = _merge(doc, start, n)
    return _emit(_spread(doc, start), np.zeros(len(doc), U64), doc, _pack(start, n, REPEAT))


def _sorted_out(h, s, doc, start, n) -> Iterator[pa.RecordBatch]:
    """One batch's strings sorted by (h, s, doc, start), ready to be sent on."""
    o = np.argsort(h, kind="stable")
    hs = h[o]
    same = np.empty(len(o), bool)
    same[0] = False
    same[1:] = hs[1:] == hs[:-1]
    multi = same.copy()
    multi[:-1] |= same[1:]
    alone = np.sort(o[~multi])  # in text order
    yield _emit(h[alone], s[alone], doc[alone], _pack(start[alone], n[alone], REP))
    m = o[multi]
    if not len(m):
        return
    m = m[np.lexsort((start[m], doc[m], s[m], h[m]))]
    hm, sm, dm, tm, nm = h[m], s[m], doc[m], start[m], n[m]
    new_h = np.append(True, hm[1:] != hm[:-1])
    new_s = new_h | np.append(True, sm[1:] != sm[:-1])
    lead = np.flatnonzero(new_s)[np.cumsum(new_s) - 1]
    again = ~new_s & ~((dm == dm[lead]) & (tm == tm[lead]))
    yield _repeat_rows(dm[again], tm[again], nm[again])
    # one row per bucket goes on; a bucket of several pointers is open
    group = np.cumsum(new_h) - 1
    is_open = np.bincount(group, weights=new_s)[group] > 1
    for pick, kind in ((new_h & ~is_open, REP), (new_h & is_open, REP_OPEN)):
        yield _emit(hm[pick], sm[pick], dm[pick], _pack(tm[pick], nm[pick], kind))
    rest = new_s & ~new_h & is_open
    yield _emit(
        _spread(dm[rest], tm[rest]),
        np.zeros(int(rest.sum()), U64),
        dm[rest],
        _pack(tm[rest], nm[rest], OPEN),
    )


def segment_rows(n_match: int):
    """Task function: segments sorted within the batch, see step 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("k").to_numpy(zero_copy_only=False), np.int64)
            h, s, row, start, n = segments(*_buffers(batch.column("text")), n_match)
            if len(h):
                yield from _sorted_out(h, s, keys[row], start, n)

    return run


def _open_ranges(batch: pa.RecordBatch, n_match: int):
    """(keys, bytes, row offsets, row, first byte, windows) of the open ranges
    of one batch, in text order."""
    keys = np.asarray(batch.column("k").to_numpy(zero_copy_only=False), np.int64)
    b, offsets = _buffers(batch.column("text"))
    ranges = batch.column("ranges")
    parts = ranges.offsets.to_numpy()
    flat = ranges.values.to_numpy(zero_copy_only=False).view(U64)[parts[0] : parts[-1]]
    row = np.repeat(np.arange(len(parts) - 1), np.diff(parts))
    start = (flat >> U64(33)).astype(np.int64)
    n = ((flat >> U64(2)) & U64(0x7FFFFFFF)).astype(np.int64)
    fits = start + n + n_match - 1 <= np.diff(offsets)[row]
    row, start, n = row[fits], start[fits], n[fits]
    o = np.lexsort((start, row))
    row, start, n = row[o], start[o], n[o]
    return keys, b, offsets, row, start + offsets[row], n


def _pieces(at: np.ndarray, n: np.ndarray, n_match: int):
    """(from, to, first byte, end byte): ranges whose bytes lie in one block."""
    i = 0
    while i < len(at):
        j = int(np.searchsorted(at, at[i] + BLOCK, "left"))
        yield i, j, int(at[i]), int((at[i:j] + n[i:j]).max()) + n_match - 1
        i = j


def block_rows(n_match: int):
    """Task function: open segments in aligned groups of windows, see step 3."""
    span = n_match - ANCHOR_DEPTH + 1
    core = n_match - GROUP + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, b, offsets, row, at, n = _open_ranges(batch, n_match)
            found = []
            for i, j, lo, hi in _pieces(at, n, n_match):
                _, p32, full = pointers(b[lo:hi], n_match)
                first, last = at[i:j] - lo, at[i:j] - lo + n[i:j] - 1
                near = p32[first[:, None] + np.arange(span)] >> U64(32)
                anchor = first + near.argmin(axis=1)
                # group g holds the windows that start g*GROUP .. bytes before
                # the anchor, up to GROUP of them
                g_lo, g_hi = (anchor - last) // GROUP, (anchor - first) // GROUP
                count = g_hi - g_lo + 1
                which = np.repeat(np.arange(j - i), count)
                g = np.arange(len(which)) - np.repeat(np.cumsum(count) - count - g_lo, count)
                base = anchor[which] - g * GROUP
                w_lo = np.maximum(base - GROUP + 1, first[which])
                w_hi = np.minimum(base, last[which])
                steps = [*range(0, core - ANCHOR_DEPTH, ANCHOR_DEPTH), core - ANCHOR_DEPTH]
                h = p32[base]
                for x in steps[1:]:
                    h = mix(h, p32[base + x])
                s = mix(mix(full[w_lo], full[w_hi]), (w_hi - w_lo).astype(U64))
                r = row[i:j][which]
                found.append((h, s, keys[r], w_lo + lo - offsets[r], w_hi - w_lo + 1))
            if found:
                yield from _sorted_out(*(np.concatenate(x) for x in zip(*found)))

    return run


def window_rows(n_match: int):
    """Task function: full-depth pointers of single windows, see step 4."""
    steps = [*range(0, n_match - 8, 8), n_match - 8]
    odd = [U64((0x9E3779B97F4A7C15 * (2 * j + 1)) & (2**64 - 1)) for j in range(len(steps))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, b, offsets, row, at, n = _open_ranges(batch, n_match)
            found = []
            for i, j, lo, hi in _pieces(at, n, n_match):
                p8, _, full = pointers(b[lo:hi], n_match)
                total = n[i:j]
                base = np.cumsum(total) - total
                idx = np.arange(int(total.sum())) - np.repeat(base - (at[i:j] - lo), total)
                second = np.zeros(len(idx), U64)
                for step, c in zip(steps, odd):
                    second += (p8[idx + step] ^ (p8[idx + step] >> U64(29))) * c
                r = np.repeat(row[i:j], total)
                found.append((full[idx], second, keys[r], idx + lo - offsets[r]))
            if not found:
                continue
            w1, w2, doc, pos = (np.concatenate(x) for x in zip(*found))
            o = np.lexsort((pos, doc, w2, w1))
            w1, w2, doc, pos = w1[o], w2[o], doc[o], pos[o]
            new = np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            again = ~new & ~((doc == doc[lead]) & (pos == pos[lead]))
            one = np.ones(len(pos), np.int64)
            yield _emit(w1[new], w2[new], doc[new], _pack(pos[new], one[new], REP))
            if again.any():
                yield _repeat_rows(doc[again], pos[again], one[again])

    return run


def _removal(n_match: int):
    """Task function: sizes, removed runs and the hash of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = _buffers(batch.column("text"))
            marks = batch.column("marks").to_pylist()
            out = []
            view = memoryview(np.ascontiguousarray(b))
            for i, ranges in enumerate(marks):
                a, z = int(offsets[i]), int(offsets[i + 1])
                size = z - a
                digest = hashlib.sha256()
                kept_from, removed, spans = 0, 0, 0
                if ranges:
                    p = np.sort(np.array(ranges, np.int64).view(U64))
                    lo = (p >> U64(33)).astype(np.int64)
                    hi = lo + ((p >> U64(2)) & U64(0x7FFFFFFF)).astype(np.int64)
                    hi = np.minimum(hi + n_match - 1, size)
                    top = np.maximum.accumulate(hi)
                    new = np.append(True, lo[1:] > top[:-1])
                    first = np.flatnonzero(new)
                    for x, y in zip(lo[first], top[np.append(first[1:], len(lo)) - 1]):
                        if x >= y:
                            continue
                        digest.update(view[a + kept_from : a + int(x)])
                        kept_from = int(y)
                        removed += int(y - x)
                        spans += 1
                digest.update(view[a + kept_from : z])
                out.append((size, removed, spans, digest.hexdigest()))
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in cols[:3]),
                    pa.array(cols[3], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def verdicts(rows: DataFrame) -> DataFrame:
    """(k, pk, verdict): 1 repeats, 2 open, 0 neither."""
    kind = F.col("pk").bitwiseAND(3)
    rep = kind.isin(REP, REP_OPEN)
    bucket = Window.partitionBy("h").orderBy("s", "k", "pk")
    whole = bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    start_of = lambda c: F.shiftrightunsigned(c, 33)
    pointer = F.when(rep, F.col("s"))
    return rows.select(
        "k",
        "pk",
        kind.alias("kind"),
        (
            F.coalesce(F.lag("s").over(bucket) == F.col("s"), F.lit(False))
            & ~(
                (F.lag("k").over(bucket) == F.col("k"))
                & (start_of(F.lag("pk").over(bucket)) == start_of(F.col("pk")))
            )
        ).alias("again"),
        (
            F.coalesce(F.min(pointer).over(whole) != F.max(pointer).over(whole), F.lit(False))
            | (F.max(F.when(kind == REP_OPEN, 1).otherwise(0)).over(whole) == 1)
        ).alias("several"),
    ).select(
        "k",
        "pk",
        # computed from the window results, so both uses keep one exchange
        F.when(F.col("kind") == REPEAT, 1)
        .when(F.col("kind") == OPEN, 2)
        .when(F.col("again"), 1)
        .when(F.col("several"), 2)
        .otherwise(0)
        .alias("verdict"),
    )


def keyed_documents(docs: DataFrame) -> DataFrame:
    """(k, doc_id, text): ``k`` tells documents apart, in the order of doc_id."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    digest = (F.xxhash64("text"), F.xxhash64("text", F.lit(1)))
    hashed = rows.select("doc_id", digest[0].alias("d1"), digest[1].alias("d2"))
    unlike = hashed.groupBy("doc_id").agg(F.min("d1").alias("low"), F.max("d1").alias("high"))
    if unlike.where("low <> high").isEmpty():
        return rows.select(F.coalesce("doc_id", F.lit(NULL_KEY)).alias("k"), "doc_id", "text")
    order = ranked(docs.sparkSession, hashed.distinct(), ["doc_id", "d1", "d2"])
    order = order.select(F.col("doc_id").alias("__id"), "d1", "d2", F.col("rank").alias("k"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (digest[0] == F.col("d1")) & (digest[1] == F.col("d2"))
    return rows.join(order, same).select("k", "doc_id", "text")


def repeat_marks(docs: DataFrame, n_match: int = MATCH_BYTES) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, marks): marks are rows (k, pk) of repeated windows."""
    if n_match < 2 * ANCHOR_DEPTH:
        raise ValueError(f"n_match must be at least {2 * ANCHOR_DEPTH}")
    keyed = keyed_documents(docs)
    schema = "k long, pk long, h long, s long"

    def opened(marked: DataFrame) -> DataFrame:
        """Documents with their open ranges; the exchange of texts is shared."""
        ranges = marked.where("verdict = 2").groupBy("k").agg(F.collect_list("pk").alias("ranges"))
        return keyed.join(ranges, "k").select("k", "doc_id", "text", "ranges")

    by_segment = verdicts(keyed.select("k", "text").mapInArrow(segment_rows(n_match), schema))
    by_group = verdicts(opened(by_segment).mapInArrow(block_rows(n_match), schema))
    windows = opened(by_group).mapInArrow(window_rows(n_match), schema)
    same = Window.partitionBy("h", "s").orderBy("k", "pk")
    again = windows.select(
        "k",
        "pk",
        F.col("pk").bitwiseAND(3).alias("kind"),
        F.lag("k").over(same).alias("pk_doc"),
        F.lag("pk").over(same).alias("pk_prev"),
    ).where(
        (F.col("kind") == REPEAT)
        | (
            F.col("pk_doc").isNotNull()
            & ~((F.col("pk_doc") == F.col("k")) & (F.col("pk_prev") == F.col("pk")))
        )
    )
    marks = again.select("k", "pk")
    for marked in (by_segment, by_group):
        marks = marks.unionByName(marked.where("verdict = 1").select("k", "pk"))
    return keyed, marks


def remove_repeats(docs: DataFrame, n_match: int = MATCH_BYTES) -> DataFrame:
    """Per document: sizes, removed runs and the hash of the bytes left."""
    keyed, marks = repeat_marks(docs, n_match)
    per_doc = marks.groupBy("k").agg(F.collect_list("pk").alias("marks"))
    joined = keyed.join(per_doc, "k", "left").select("k", "doc_id", "text", "marks")
    return joined.mapInArrow(
        _removal(n_match),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
