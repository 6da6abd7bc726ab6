"""Importance resampling against a plain version, on the whole small table and
on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from postlens.llm import op11_importance as op11
from postlens.llm.common import checkpointed

SCHEMA = "doc_id long, text string, words string, k1 long, rank long, copies long, part long"
TARGET = "item_id long, text string, bucket long"


def features(text, n=1):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(docs, target, p=op11.PRODUCTION):
    s, t = [0] * 10_000, [0] * 10_000
    for _, text in docs:
        for b in features(text, p.max_n)[1]:
            s[b] += 1
    for text in target:
        for b in features(text, p.max_n)[1]:
            t[b] += 1
    gain = [
        math.floor(1000 * math.log((y + 1) * (sum(s) + 10_000) / ((x + 1) * (sum(t) + 10_000))))
        if x
        else 0
        for x, y in zip(s, t)
    ]
    rows = []
    for doc_id, text in docs:
        n, found = features(text, p.max_n)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        weight = sum(gain[b] for b in found)
        rows.append([doc_id, len(found), weight, weight + noise, None, n])
    able = sorted(
        (r for r in rows if r[5] >= p.min_words),
        key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]),
    )
    for i, r in enumerate(able[: p.percent * len(able) // 100]):
        r[4] = i + 1
    return rows


def order(rows):
    return sorted(map(tuple, rows), key=str)


WORDS = [f"w{i}" for i in range(60)] + ["Straße", "naïve", "日本語", "x-y", "A1"]


def some_docs(n=60):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices(WORDS, k=rng.randint(10, 60)))) for i in range(n)]
    docs += [(None, None), (None, docs[3][1]), (7, ""), (8, "short one"), (9, "\x00\x7f!")]
    docs += [docs[5]] * 4 + [(5, docs[6][1])]
    docs.append((1000, " ".join(rng.choices(WORDS, k=60_000))))
    return docs


def frame(spark, docs, parts=3):
    rows = [(i, t, "x", 1, 2, 3, 4) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("p", [op11.PRODUCTION, op11.Params(max_n=3, percent=50, pivots=2)])
def test_against_plain(spark, monkeypatch, p):
    monkeypatch.setattr(op11, "PIECE", 1 << 12)
    docs, target = some_docs(), ["w1 w2 w3 w1", None, "Straße w9", ""]
    items = spark.createDataFrame([(i, t, 5) for i, t in enumerate(target)], TARGET)
    got = op11.resample(spark, frame(spark, docs), items, p)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    assert order(got.collect()) == order(plain(docs, target, p))


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], TARGET)
    assert op11.resample(spark, none, items).collect() == []
    docs = some_docs(30)
    assert order(op11.resample(spark, frame(spark, docs), items).collect()) == order(plain(docs, []))


def test_copies_of_the_last_winner(spark, monkeypatch):
    """Alike rows about the bound: as many are drawn as there is room for."""
    monkeypatch.setattr(op11, "COPIES", 8)
    text = " ".join(WORDS)
    docs = [(1, text)] * 50 + [(2, text + " w1")] * 50
    items = spark.createDataFrame([(1, "w1", 0)], TARGET)
    got = op11.resample(spark, frame(spark, docs), items, op11.Params(percent=30)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 31))
    assert order(got) == order(plain(docs, ["w1"], op11.Params(percent=30)))


def test_quickselect_every_k(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 5), rng.choice([1, 1, 1, rng.randint(0, 9)])) for _ in range(60)]
    stored = checkpointed(spark, spark.createDataFrame(rows, "a long, b long"))
    for k in (1, 2, 17, 30, 59, 60):
        assert op11.kth_key(stored, ["a", "b"], k, 3, seed=k) == sorted(rows)[k - 1]
    assert op11.kth_key(stored, ["a", "b"], 61, 3) is None


def test_winners_are_like_the_target(spark):
    """Documents of the target's words are drawn ahead of others."""
    docs = [(i, " ".join(WORDS[:30]) if i % 4 else " ".join(WORDS[30:60])) for i in range(80)]
    items = spark.createDataFrame([(i, " ".join(WORDS[30:60]), 0) for i in range(20)], TARGET)
    got = op11.resample(spark, frame(spark, docs), items, op11.Params(percent=20))
    drawn = got.where(F.col("rank").isNotNull()).collect()
    assert len(drawn) == 16 and all(r.doc_id % 4 == 0 for r in drawn)
