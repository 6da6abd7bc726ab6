"""Unlike texts under one id, or under none, lose nothing to each other."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import op1_lm_scoring as op1
from postlens.llm import op2_language_ppm as op2
from postlens.llm import op7_suffix_dedup as op7
from postlens.llm import op9_decontaminate as op9

SCHEMA = "doc_id long, text string, k long, digest long, rank long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], SCHEMA)


def text_of(seed, n):
    rng = np.random.default_rng(seed)
    return "".join(map(chr, rng.integers(97, 123, n)))


@pytest.mark.parametrize("ids", [(7, 7), (None, None)])
def test_op7_unique_bytes_stay(spark, ids):
    passage, own, other = text_of(1, 300), text_of(2, 600), text_of(3, 40)
    rows = [(1, passage), (ids[0], passage + other), (ids[1], own), (9, passage), (9, passage)]
    got = op7.remove_repeats(frame(spark, rows)).collect()
    left = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (ids[1], 600, 0, sha(own)) in left
    # a null id comes before all others, so its copy is the first
    first = ids[0] is None
    assert (ids[0], 340, 0 if first else 300, sha(passage + other if first else other)) in left
    assert (1, 300, 300 if first else 0, sha("" if first else passage)) in left
    assert [x for x in left if x[0] == 9] == [(9, 300, 300, sha(""))] * 2


ITEM = "What is the capital of the old kingdom that lay between the two great rivers of the north"


def test_op9_clean_rows_stay(spark):
    clean, clean2 = "some quiet words about gardens and rain", "another text about hills"
    rows = [(4, f"Before. {ITEM} after"), (4, clean), (None, f"x {ITEM}"), (None, clean2), (5, clean)]
    items = spark.createDataFrame([(1, ITEM, 0), (1, "an unlike item under the same id " * 3, 0)], "item_id long, text string, h long")
    kept = op9.drop_leaks(spark, frame(spark, rows), items)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(4, clean), (0, clean2), (5, clean)])
    assert kept.columns == ["doc_id", "text", "k", "digest", "rank"]
    found = op9.find_leaks(spark, frame(spark, rows * 3), items)
    assert sorted((r.doc_id or 0, r.item_id) for r in found.collect()) == [(0, 1), (4, 1)]


def test_op9_large_benchmark_path(spark):
    """Windows joined by a shuffle give the same rows."""
    rows = [(i, f"{text_of(i, 30)} {ITEM if i % 2 else 'nothing here'} {text_of(i, 9)}") for i in range(12)]
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string")
    small = op9.find_leaks(spark, frame(spark, rows), items)
    large = op9.find_leaks(spark, frame(spark, rows), items, op9.Rules(set_limit=0))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert small.count() == 6


def test_op9_windows_by_doubling():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 3, 400).astype(np.uint64)
    windows = op9.Windows(tokens)
    for k in (1, 2, 5, 6, 7, 8, 13):
        h = windows.hashes(k)
        assert len(h) == 400 - k + 1
        met: dict = {}
        for i, x in enumerate(h.tolist()):
            assert met.setdefault(x, tuple(tokens[i : i + k])) == tuple(tokens[i : i + k])
        assert len(met) == len({tuple(tokens[i : i + k]) for i in range(400 - k + 1)})
    assert len(op9.Windows(tokens[:3]).hashes(5)) == 0
    wanted = op9.Wanted(np.sort(h[::7]))
    assert set(h[wanted.find(h)].tolist()) == set(h[::7].tolist())


def test_op2_number_signs_are_no_letters():
    assert not any(op2._has_letter(t.encode()) for t in ("½", "²", "5 ½", "", "٣", "_", "🙂"))
    assert all(op2._has_letter(t.encode()) for t in ("½ a", "é", "日", "ß½"))


def test_op1_repeated_rows_of_one_id(spark):
    docs = frame(spark, [(1, f"word{i % 50} and more words here") for i in range(3000)])
    params = op1.Params(sample_docs=5, windows_per_doc=2, symbols=32, classes=4, frequent=20, steps=2)
    fold = F.lit(True)
    scored = op1.score_documents(spark, docs.limit(20), fold, ~fold, params)
    assert scored.count() == 20
