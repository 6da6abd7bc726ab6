"""Operator 13: prefix trie of conversations, built with z-fast tries.

Conversations that begin alike share the nodes of their common turns. A node
is a distinct sequence of first turns; its key is its depth and a 128-bit
hash, the exclusive or of its turns' hashes salted with their depths, so any
task can name any prefix.

1. Turns become hashes and lengths (texts are read once and never shuffled)
   and are gathered in blocks of ``BLOCK`` turn numbers, so a very long
   conversation is many rows. ``shared`` first turns can be taken from another
   conversation (see ``rebuilt``).
2. Every task inserts its batches of block paths into a z-fast trie: compacted
   nodes (edges of many turns) are hashed at the two-fattest depth of their
   edge, a fat binary search over these handles finds the node where a path
   leaves the trie, and the edge is split or extended there. Members are
   counted where paths end and handed up once per batch of at most ``LIMIT``
   turns; then edges are expanded to one row per depth, with partial counts.
   So a first turn that a third of all conversations share is one row per
   batch, not one per conversation.
3. Rows of one node from different tasks are added up.
4. Sums over subtrees need no walk: the smallest member of a node owns it, so
   a conversation owns the last part of its path. The texts saved below a node
   are the members' texts from there on, less every distinct node's text once;
   the latter are the owned parts of its members. A second insertion hands up
   owned lengths and leaves, of owners only.
5. A node's ending conversations are sorted by id and hashed as they stream by.

Nothing is collected. Joins on parents broadcast the parents with over a
1024th of all nodes as children (fewer than 1024).

Nulls and edge cases: null roles and texts are empty; a null turn comes before
all others, turns with one number are ordered by a hash of their role and
text; rows without conv_id belong to no conversation and are left out;
a conversation without turns is a member of the root alone; repeated rows are
turns of their own; a very long text is one hash; an empty table has no root
and gives an empty result; other columns are ignored. A block holds the turns
of ``BLOCK`` numbers, so it is bounded unless numbers repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import U64, Tables, mix, read_table, signed, spread_join

# Turn numbers in a block of a conversation.
BLOCK = 4096
# Turns a task's trie holds before it is handed on.
LIMIT = 1 << 18

# The production rule: conversations of one hundred share the first turns of
# the one whose id is a multiple of GROUP; how many is told by crc32.
GROUP = 100
MOST_SHARED = 5


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % GROUP


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted tries of hashed paths, one per start depth (that of a block);
    the trie of a start depth may have several roots.

    A path is (start depth, h1, h2, ...): arrays of prefix hashes whose first
    entry is the root's. Sums are kept where paths end.
    """

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.handles: dict[tuple, int] = {}  # two-fattest prefix of an edge -> node
        self.first: dict[tuple, int] = {}  # first prefix of an edge -> node
        self.low: list[int] = []
        self.high: list[int] = []
        self.parent: list[int] = []
        self.path: list[tuple] = []
        self.sums: list[list[int]] = []
        self.least: list[tuple | None] = []
        self.size = 0

    def _at(self, path: tuple, depth: int) -> tuple:
        i = depth - path[0]
        return path[0], depth, path[1][i], path[2][i]

    def _add(self, low: int, high: int, parent: int, path: tuple) -> int:
        self.low.append(low)
        self.high.append(high)
        self.parent.append(parent)
        self.path.append(path)
        self.sums.append([0] * self.width)
        self.least.append(None)
        return len(self.low) - 1

    def _hash_edge(self, node: int) -> None:
        path = self.path[node]
        self.first[self._at(path, self.low[node] + 1)] = node
        self.handles[self._at(path, two_fattest(self.low[node], self.high[node]))] = node

    def exit_of(self, path: tuple, root: int) -> int:
        """The deepest node whose whole edge is on the path, by fat binary
        search over the handles."""
        node, low, high = root, path[0], path[0] + len(path[1]) - 1
        end = high
        while low < high:
            f = two_fattest(low, high)
            found = self.handles.get(self._at(path, f))
            if found is None:
                high = f - 1
            else:
                extent = self.high[found]
                if extent > end or self._at(self.path[found], extent) != self._at(path, extent):
                    high = f - 1  # the path leaves this edge behind its handle
                else:
                    node, low = found, extent
        return node

    def _split(self, node: int, path: tuple, end: int) -> int:
        """The node at the depth where ``path`` leaves ``node``'s edge."""
        low, high = self.low[node] + 1, min(self.high[node], end)
        own = self.path[node]
        while low < high:  # deepest common prefix
            middle = (low + high + 1) // 2
            if self._at(own, middle) == self._at(path, middle):
                low = middle
            else:
                high = middle - 1
        if low == self.high[node]:
            return node
        del self.handles[self._at(own, two_fattest(self.low[node], self.high[node]))]
        upper = self._add(self.low[node], low, self.parent[node], own)
        self.low[node], self.parent[node] = low, upper
        self._hash_edge(upper)
        self._hash_edge(node)
        return upper

    def insert(self, path: tuple, sums: tuple, least: tuple) -> None:
        start, end = path[0], path[0] + len(path[1]) - 1
        root = self.first.get(("root", *self._at(path, start)))
        if root is None:
            root = self._add(start, start, -1, path)
            self.first[("root", *self._at(path, start))] = root
            self.size += 1
        node = self.exit_of(path, root)
        while self.high[node] < end:
            child = self.first.get(self._at(path, self.high[node] + 1))
            if child is None:
                node = self._add(self.high[node], end, node, path)
                self._hash_edge(node)
                self.size += len(path[1])
            else:
                node = self._split(child, path, end)
        own = self.sums[node]
        for i, v in enumerate(sums):
            own[i] += v
        if self.least[node] is None or least < self.least[node]:
            self.least[node] = least

    def expand(self) -> dict[str, np.ndarray]:
        """One row per depth of every edge, with the sums of all paths that
        end there or below; the root of depth 0 too."""
        for node in sorted(range(len(self.low)), key=self.high.__getitem__, reverse=True):
            up = self.parent[node]
            if up >= 0:
                for i, v in enumerate(self.sums[node]):
                    self.sums[up][i] += v
                if self.least[up] is None or self.least[node] < self.least[up]:
                    self.least[up] = self.least[node]
        rows, counts, nodes = [], [], []
        for node, (low, high) in enumerate(zip(self.low, self.high)):
            start, *columns = self.path[node]
            if low == high:  # a root; deeper ones end another block
                if low:
                    continue
                rows.append([np.zeros(1, np.int64), *(c[:1] for c in columns), *(c[:1] * U64(0) for c in columns[:2])])
            else:
                span = slice(low + 1 - start, high + 1 - start)
                above = slice(low - start, high - start)
                depth = np.arange(low + 1, high + 1)
                rows.append([depth, *(c[span] for c in columns), *(c[above] for c in columns[:2])])
            counts.append(len(rows[-1][0]))
            nodes.append(node)
        if not rows:
            return {}
        out = dict(zip(("depth", "h1", "h2", "cp", "cum", "p1", "p2"), map(np.concatenate, zip(*rows))))
        of = np.repeat(np.array(nodes), counts)
        sums = np.array(self.sums, np.int64)
        least = np.array(self.least, np.int64)
        for i in range(self.width):
            out[f"sum{i}"] = sums[of, i]
        for i in range(least.shape[1]):
            out[f"least{i}"] = least[of, i]
        return out


def _paths(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int]]:
    """Per row of a batch: its path (start, h1, h2, cp, cum) and its end depth."""
    lists = batch.column("turns")
    offsets = lists.offsets.to_numpy()
    cells = lists.values
    x1, x2, cp = (cells.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("x1", "x2", "cp"))
    start, pre1, pre2, precum = (
        batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "pre1", "pre2", "precum")
    )
    for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        s = int(start[i])
        depth = np.arange(s + 1, s + 1 + z - a).astype(U64)
        h1 = np.append(pre1[i : i + 1].view(U64), mix(x1[a:z].view(U64), depth))
        h2 = np.append(pre2[i : i + 1].view(U64), mix(x2[a:z].view(U64), ~depth))
        lengths = np.append(0, cp[a:z])
        path = (
            s,
            np.bitwise_xor.accumulate(h1),
            np.bitwise_xor.accumulate(h2),
            lengths,
            precum[i] + np.cumsum(lengths),
        )
        yield path, s + z - a


def _trie_rows(sums: list[str], least: list[str]):
    """Task function: blocks to partial node rows; ``sums`` are added up over a
    node's members, and ``least`` is that of the least member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie(len(sums))

        def rows() -> Iterator[pa.RecordBatch]:
            out = trie.expand()
            trie.clear()
            if out:
                arrays = [pa.array(signed(v) if v.dtype == U64 else v) for v in out.values()]
                yield pa.RecordBatch.from_arrays(arrays, names=list(out))

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in {*sums, *least}}
            for i, (path, _) in enumerate(_paths(batch)):
                trie.insert(
                    path, tuple(columns[c][i] for c in sums), tuple(columns[c][i] for c in least)
                )
                if trie.size > LIMIT:
                    yield from rows()
        yield from rows()

    names = ["depth", "h1", "h2", "cp", "cum", "p1", "p2"]
    names += [f"sum{i}" for i in range(len(sums))] + [f"least{i}" for i in range(len(least))]
    return run, ", ".join(f"{n} long" for n in names)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: blocks to (c, off, x1, x2, cum) over the block alone."""
    for batch in batches:
        found = [(p[1][-1], p[2][-1], p[4][-1]) for p, _ in _paths(batch)]
        x1, x2, cum = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("c"),
                batch.column("off"),
                pa.array(signed(np.array(x1, U64))),
                pa.array(signed(np.array(x2, U64))),
                pa.array(np.array(cum, np.int64)),
            ],
            names=["c", "off", "b1", "b2", "bcum"],
        )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: last blocks to the key of the conversation's end."""
    for batch in batches:
        found = [(end, p[1][-1], p[2][-1]) for p, end in _paths(batch)]
        depth, h1, h2 = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(depth, pa.int64()),
                pa.array(signed(np.array(h1, U64))),
                pa.array(signed(np.array(h2, U64))),
                batch.column("c"),
            ],
            names=["depth", "h1", "h2", "c"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (depth, h1, h2, c) in order to one digest per node."""
    node, digest = None, None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("depth", "h1", "h2")], axis=1)
        convs = batch.column("c").to_pylist()
        cuts = np.flatnonzero(np.any(np.diff(keys, axis=0) != 0, axis=1)) + 1
        done = []
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(convs)]):
            if a == z:
                continue
            text = ",".join(map(str, convs[a:z])).encode()
            key = tuple(keys[a].tolist())
            if key != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(text)
            else:
                digest.update(b"," + text)
        yield _digest_batch(done)
    if node is not None:
        yield _digest_batch([(*node, digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    cells = list(zip(*rows)) if rows else [(), (), (), ()]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cells, types)], names=["depth", "h1", "h2", "ends_sha256"]
    )


def turn_blocks(tables: Tables, conversations: DataFrame) -> DataFrame:
    """(c, off, n, turns): turns of ``BLOCK`` turn numbers in order, the turns
    before them, and all turns of the conversation."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.col("turn").cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"),
        F.coalesce(F.floor(turn / BLOCK), F.lit(-(1 << 62))).cast("long").alias("block"),
        F.struct(
            turn.isNotNull().alias("known"),
            turn.alias("turn"),
            F.xxhash64(role, text).alias("x1"),
            F.xxhash64(text, role, F.lit(1)).alias("x2"),
            F.length(text).cast("long").alias("cp"),
        ).alias("t"),
    )
    turns = F.transform(
        F.array_sort(F.collect_list("t")), lambda t: F.struct(t["x1"], t["x2"], t["cp"])
    )
    blocks = tables.store(rows.groupBy("c", "block").agg(turns.alias("turns")))
    # conversations of several blocks
    sizes = blocks.groupBy("c").agg(F.count("*").alias("blocks"))
    several = blocks.select("c", "block", F.size("turns").cast("long").alias("own")).join(
        sizes.where("blocks > 1").select("c"), "c", "left_semi"
    )
    whole = Window.partitionBy("c")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    several = tables.store(
        several.select(
            "c",
            "block",
            F.coalesce(F.sum("own").over(before), F.lit(0)).alias("off"),
            F.sum("own").over(whole).alias("n"),
        )
    )
    if several.isEmpty():
        return blocks.select("c", F.lit(0).cast("long").alias("off"), F.size("turns").cast("long").alias("n"), "turns")
    return blocks.join(several, ["c", "block"], "left").select(
        "c", F.coalesce("off", F.lit(0)).alias("off"), F.coalesce("n", F.size("turns")).cast("long").alias("n"), "turns"
    )


def rebuilt(tables: Tables, blocks: DataFrame, shared: Column, base: Column, most: int) -> DataFrame:
    """Paths: the first ``shared`` (at most ``most``) turns of conversation
    ``base``, then a conversation's own turns after its first ``shared``.

    (c, off, start, turns, last): blocks with the depth before them; ``last``
    marks the one where the conversation ends.
    """
    first = blocks.where((F.col("off") < most) & (base == F.col("c"))).select(
        "c", "off", F.posexplode(F.slice("turns", 1, most)).alias("at", "turn")
    )
    heads = (
        first.where(F.col("off") + F.col("at") < most)
        .groupBy("c")
        .agg(F.array_sort(F.collect_list(F.struct((F.col("off") + F.col("at")).alias("at"), "turn"))).alias("h"))
        .select(F.col("c").alias("b"), F.transform("h", lambda x: x["turn"]).alias("head"))
    )
    none = F.expr("array() :: array<struct<x1: bigint, x2: bigint, cp: bigint>>")
    joined = blocks.withColumn("h", shared.cast("int")).withColumn("b", base).join(heads, "b", "left")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    own = F.slice("turns", (F.greatest(F.col("h") - F.col("off"), F.lit(0)) + 1).cast("int"), F.size("turns"))
    taken = F.size(head)
    start = F.when(F.col("off") == 0, 0).otherwise(F.greatest("off", "h") - F.col("h") + taken).cast("long")
    end = taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    paths = joined.select(
        "c",
        "off",
        start.alias("start"),
        F.when(F.col("off") == 0, F.concat(head, own)).otherwise(own).alias("turns"),
        end.alias("end"),
    ).where((F.size("turns") > 0) | ((F.col("off") == 0) & (F.col("end") == 0)))
    paths = paths.withColumn("last", F.col("start") + F.size("turns") == F.col("end")).drop("end")
    # prefix hashes and lengths before a block, and the whole length
    zero = F.lit(0).cast("long")
    blank = paths.select("*", zero.alias("pre1"), zero.alias("pre2"), zero.alias("precum"))
    blank = tables.store(blank)
    length = F.aggregate("turns", zero, lambda s, t: s + t["cp"])
    later = blank.where("off > 0").select("c").distinct()
    if later.isEmpty():
        return blank.withColumn("total", length)
    sums = blank.join(later, "c", "left_semi").mapInArrow(
        _block_sums, "c long, off long, b1 long, b2 long, bcum long"
    )
    whole = Window.partitionBy("c")
    before = whole.orderBy("off").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.select(
        "c",
        "off",
        F.bit_xor("b1").over(before).alias("pre1"),
        F.bit_xor("b2").over(before).alias("pre2"),
        F.sum("bcum").over(before).alias("precum"),
        F.sum("bcum").over(whole).alias("total"),
    )
    names = ("pre1", "pre2", "precum")
    return tables.store(
        blank.drop(*names)
        .join(known, ["c", "off"], "left")
        .withColumns({n: F.coalesce(n, zero) for n in names} | {"total": F.coalesce("total", length)})
    )


def prefix_trie(
    spark: SparkSession,
    conversations: DataFrame,
    shared: Column | None = None,
    base: Column | None = None,
    most: int = MOST_SHARED,
) -> DataFrame:
    """One row per trie node, see the module; by default conversations are
    taken as they are. ``shared`` and ``base`` are columns of ``c``."""
    tables = Tables(spark, "prefix-trie")
    blocks = turn_blocks(tables, conversations)
    if shared is None or base is None:
        shared, base, most = F.lit(0), F.col("c"), 0
    paths = rebuilt(tables, blocks, shared, base, most).withColumn("one", F.lit(1).cast("long"))
    key = ["h1", "h2", "depth"]

    run, schema = _trie_rows(["one", "total"], ["c"])
    partial = paths.mapInArrow(run, schema)
    nodes = tables.store(
        partial.groupBy(*key).agg(
            F.sum("sum0").alias("n_convs"),
            F.sum("sum1").alias("texts"),
            F.min("least0").alias("conv_id"),
            *[F.first(c).alias(c) for c in ("cp", "cum", "p1", "p2")],
        )
    )
    total = nodes.count()
    children = (
        nodes.where("depth > 0")
        .groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = tables.store(
        nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    )
    # what a conversation owns: the last part of its path
    owners = nodes.groupBy(F.col("conv_id").alias("c")).agg(
        (F.max("cum") - F.min(F.col("cum") - F.col("cp"))).alias("own"),
        F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaf"),
    )
    run, schema = _trie_rows(["own", "leaf"], ["c", "own", "total"])
    owned = (
        paths.join(owners, "c")
        .mapInArrow(run, schema)
        .groupBy(*key)
        .agg(
            F.sum("sum0").alias("owned"),
            F.sum("sum1").alias("n_leaves"),
            F.min(F.struct("least0", "least1", "least2")).alias("by"),
        )
    )
    ended = (
        paths.where("last")
        .mapInArrow(_ends, "depth long, h1 long, h2 long, c long")
        .repartition("h1", "h2")
        .sortWithinPartitions("h1", "h2", "depth", "c")
        .mapInArrow(_digests, "depth long, h1 long, h2 long, ends_sha256 string")
    )
    parents = nodes.where("n_children > 0").select(
        F.col("h1").alias("p1"),
        F.col("h2").alias("p2"),
        (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("children"),
    )
    above = F.col("cum") - F.col("cp")
    rest = F.col("owned") - F.col("by.least1") + F.col("by.least2") - above
    joined = nodes.join(owned, key).join(ended, key, "left")
    below = spread_join(joined.where("depth > 0"), parents, ["p1", "p2", "depth"], "children", total)
    root = joined.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.drop("children").unionByName(root).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("texts") - F.col("n_convs") * above - rest).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("c")
    return prefix_trie(
        spark, read_table(spark, sf_dir, "conversations"), shared_turns(conv), base_of(conv)
    )


# Nodes are the distinct texts of all prefixes; subtrees by joins on prefixes.
ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c::VARCHAR AS name FROM t),
conv AS (
  SELECT c, c - c % 100 AS b, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, length(name) + 1), lambda i: ord(substr(name, i, 1))::BIGINT)),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::BIGINT) % 6 AS h
  FROM ids),
parts AS (
  SELECT conv.c, t.pos, t.role, t.text FROM conv JOIN t ON t.c = conv.b AND t.pos <= conv.h
  UNION ALL
  SELECT conv.c, t.pos + 1000000, t.role, t.text FROM conv JOIN t ON t.c = conv.c AND t.pos > conv.h),
made AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, length(text) AS cp,
    sha256(role || chr(31) || text) AS x FROM parts),
prefix AS (
  SELECT c, d, cp, string_agg(x, '') OVER (PARTITION BY c ORDER BY d) AS p FROM made
  UNION ALL SELECT c, 0, 0, '' FROM ids),
hashed AS (SELECT c, d, cp, sha256(p) AS k, sha256(left(p, greatest(0, (d - 1) * 64))) AS up FROM prefix),
node AS (
  SELECT d, k, any_value(up) AS up, any_value(cp) AS cp, min(c) AS conv_id, count(*) AS n_convs
  FROM hashed GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY d, up),
under AS (
  SELECT a.d, a.k, b.d AS d2, b.k AS k2 FROM hashed a JOIN hashed b ON a.c = b.c AND a.d <= b.d
  GROUP BY ALL),
sums AS (
  SELECT u.d, u.k, sum((v.n_convs - 1) * v.cp) AS saved,
    count(*) FILTER (WHERE w.n IS NULL) AS leaves
  FROM under u JOIN node v ON v.d = u.d2 AND v.k = u.k2
  LEFT JOIN kids w ON w.d = v.d AND w.k = v.k GROUP BY u.d, u.k),
last AS (SELECT c, max(d) AS d FROM hashed GROUP BY c),
ends AS (
  SELECT d, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS names
  FROM hashed JOIN last USING (c, d) GROUP BY d, k)
SELECT node.conv_id, node.d AS depth, par.conv_id AS parent_conv_id, node.n_convs,
  coalesce(kids.n, 0) AS n_children, sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens,
  sha256(coalesce(names, '')) AS ends_sha256
FROM node JOIN sums ON sums.d = node.d AND sums.k = node.k
LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k
LEFT JOIN node par ON par.d = node.d - 1 AND par.k = node.up
LEFT JOIN ends ON ends.d = node.d AND ends.k = node.k
"""
