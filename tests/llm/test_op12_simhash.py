"""SimHash classes against all pairs; probes and their allocation."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from postlens.llm import op12_simhash as op12
from postlens.llm.common import read_table

SCHEMA = "doc_id long, text string, fp string, g long, mask long, size long"
SF = "/root/testdata/sf0.001"


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps: list[int], distance: int = 4) -> dict[int, int]:
    """Fingerprint -> least fingerprint (signed) of its component, all pairs."""
    every = sorted(set(fps), key=lambda x: x - (1 << 64) if x >> 63 else x)
    root = {x: x for x in every}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(every, np.uint64)
    for i, x in enumerate(every):
        near = np.bitwise_count(values ^ np.uint64(x)) <= distance
        for j in np.flatnonzero(near):
            a, b = sorted((find(x), find(every[j])), key=every.index)
            root[b] = a
    return {x: find(x) for x in every}


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    cls = classes(fps)
    least: dict = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[cls[f]] = min(i, least.get(cls[f], i))
    return sorted(((i, f"{f:016x}", least.get(cls[f])) for (i, _), f in zip(rows, fps)), key=repr)


def run(spark, rows, params=op12.PRODUCTION):
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA).repartition(3)
    got = op12.near_duplicates(spark, df, params).collect()
    return sorted(((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got), key=repr)


def test_documents_against_all_pairs(spark):
    docs = read_table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, op12.op12_simhash(spark, SF).collect()), key=repr)
    assert got == expected(rows)
    assert len({c for _, _, c in got}) < len(got)  # there are near copies


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(op12, "PIECE", 64)
    monkeypatch.setattr(op12, "BLOCK", 100)
    words = [f"word{i}" for i in range(300)]
    long = " ".join(words * 40)
    rows = [
        (None, None), (3, ""), (4, " \n\t "), (5, "one"), (6, "One"), (None, "two words"),
        (7, "a b c d"), (8, "A B  C\nD"), (8, long), (9, long + " end"), (9, long), (None, long),
        (10, "naïve Straße 日本語 x y"), (11, "x" * 1000), (12, " ".join(words)), (12, " ".join(words)),
    ]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []


def balls(rng, centres, per, radius):
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(per):
            x = c
            for b in rng.sample(range(64), rng.randint(0, radius)):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize(
    "params",
    [op12.PRODUCTION, op12.Params(small=3, parts=(4,))],
)
def test_large_groups_and_chains(spark, params):
    """Dense balls of fingerprints, far beyond ``small``, wider than a hub
    reaches; chains; and a third of all nodes alike in most bits."""
    rng = random.Random(9)
    fps = balls(rng, 3, 100, 9) + balls(rng, 30, 6, 3) + [rng.getrandbits(64) for _ in range(100)]
    low = rng.getrandbits(64) & ~0xFFFFF
    fps += [low | rng.getrandbits(20) for _ in range(200)]
    chain = rng.getrandbits(64)
    for i in range(8):
        chain ^= 0xF << (4 * i)
        fps.append(chain)
    fps = sorted(set(fps))
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    nodes = spark.createDataFrame(rows, "fp long").repartition(4)
    found = op12.link_classes(spark, nodes, params)
    got = {r.node % (1 << 64): r["class"] % (1 << 64) for r in found.collect()}
    assert {x: got.get(x, x) for x in fps} == classes(fps, params.distance)


def test_thresholds_keep_the_pigeonhole(spark):
    """Any two values at the distance agree on one of the masks, skewed or not."""
    rng = random.Random(3)
    # bits 0-9 are always alike, 10-15 nearly constant
    fps = {(rng.getrandbits(48) << 16) | (0x3FF if rng.random() < 0.5 else 0) for _ in range(500)}
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    masks = op12.probe_masks(spark.createDataFrame(rows, "fp long"), op12.PRODUCTION)
    for _ in range(20_000):
        x = 0
        for b in rng.sample(range(64), 4):
            x |= 1 << b
        assert any(x & m == 0 for m in masks)
    table = op12.bit_table(spark.createDataFrame(rows, "fp long"))
    parts = op12.grouped_bits(table, len(fps), 4)
    assert any(set(range(10)) <= set(p) for p in parts)
    assert sorted(b for p in parts for b in p) == list(range(64))


def test_dense_part_gets_the_low_threshold():
    """Dynamic programming spends the budget where candidates are few."""
    dense = np.zeros(1 << 8, np.int64)
    dense[0] = 10_000
    even = np.full(1 << 8, 40, np.int64)
    _, chosen = op12.allocate([dense, even, even], op12.Params(distance=1, small=10_000, key_cost=0))
    assert sum(chosen) == -1 and chosen[0] == -1
