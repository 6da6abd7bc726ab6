"""Conversation trie against a plain one, whole and cut into small blocks."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postlens.llm import op13_prefix_trie as op13

SCHEMA = "conv_id long, turn long, role string, text string, c string, depth long, h1 long, n int, last int"


def rebuilt(rows, shared=True):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    if not shared:
        return own
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + t[h:]
    return out


def plain(rows, shared=True):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt(rows, shared).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    return sorted(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            len(kids[node]),
            sum(not kids[x] for x in below[node]),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below[node] if x),
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def run(spark, rows, shared=True, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(parts)
    rule = (op13.shared_turns(F.col("c")), op13.base_of(F.col("c"))) if shared else ()
    return sorted(map(tuple, op13.prefix_trie(spark, df, *rule).collect()), key=lambda r: (r[0], r[1]))


def talks(rng, n, most, ids):
    rows = []
    for c in rng.sample(ids, n):
        for turn in range(rng.randint(1, most)):
            rows.append((c, 3 * turn - 2, rng.choice(["user", None]), rng.choice(["a", "bb", "ç𝒳", None, "a"])))
    return rows


@pytest.mark.parametrize("block, limit", [(4096, 1 << 18), (5, 20)])
def test_against_plain(spark, monkeypatch, block, limit):
    """Small alphabets make many branches; blocks of a few turns, tries that
    are handed on after a few paths."""
    monkeypatch.setattr(op13, "BLOCK", block)
    monkeypatch.setattr(op13, "LIMIT", limit)
    rng = random.Random(block)
    rows = talks(rng, 60, 9, list(range(0, 320)))
    rows += [(100, None, "user", "first"), (None, 1, "user", "nobody's"), (707, 1, "user", "bb")]
    rows += [(500 + i, t, "user", "same") for i in range(8) for t in range(12)]  # one very common path
    rows += [(611, t, "user", f"t{t % 3}") for t in range(60)]  # one long conversation
    rows += [(800, 0, "r", "z" * 100_000), (801, 0, "r", "z" * 100_000), (801, 0, "r", "z" * 100_000)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, shared=False) == plain(rows, shared=False)


def test_turnless_and_empty(spark):
    # conversations whose own turns are all cut and whose base is absent
    short = [c for c in range(1, 90) if zlib.crc32(str(c).encode()) % 6 >= 2][:3]
    rows = [(c, 0, "user", "cut") for c in short]
    got = run(spark, rows)
    assert got == plain(rows) and len(got) == 1 and got[0][5] == 1
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "x")]) == []


def test_trie_exit_nodes_and_edges():
    """Compacted nodes: handles lie on their edges, exits are the deepest."""
    rng = random.Random(4)
    import numpy as np

    trie, paths, seen = op13.ZFastTrie(1), [], defaultdict(int)
    for _ in range(300):
        x = np.array([rng.randint(1, 2) for _ in range(rng.randint(0, 9))], np.uint64)
        depth = np.arange(1, len(x) + 1).astype(np.uint64)
        h1 = np.bitwise_xor.accumulate(np.append(np.uint64(0), op13.mix(x, depth)))
        h2 = np.bitwise_xor.accumulate(np.append(np.uint64(0), op13.mix(x, ~depth)))
        path = (0, h1, h2, np.append(0, x).astype(np.int64), np.append(0, x).astype(np.int64))
        trie.insert(path, (1,), (len(paths),))
        paths.append(path)
        for d in range(len(x) + 1):
            seen[(d, int(h1[d]), int(h2[d]))] += 1
    for (_, f, *_), node in trie.handles.items():
        assert trie.low[node] < f <= trie.high[node]
        assert f == op13.two_fattest(trie.low[node], trie.high[node])
    for path in paths:
        end = len(path[1]) - 1
        node = trie.exit_of(path, 0)
        while (child := trie.first.get(trie._at(path, trie.high[node] + 1)) if trie.high[node] < end else None):
            node = child
        assert trie.high[node] == end
    out = trie.expand()
    got = {(d, int(a), int(b)): n for d, a, b, n in zip(out["depth"], out["h1"], out["h2"], out["sum0"])}
    assert got == dict(seen)
    # a second use after clear() starts anew
    trie.clear()
    assert trie.expand() == {}


def test_two_fattest():
    for low in range(0, 40):
        for high in range(low + 1, 41):
            best = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert op13.two_fattest(low, high) == best
