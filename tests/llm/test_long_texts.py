"""Secrets in very long texts; the texts a mix takes."""

from __future__ import annotations

import base64
import random
import time

from postlens.llm import op3_mixing as op3
from postlens.llm import op5_secrets as op5


def _spans(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.time()
    (row,) = op5.find_secrets(docs).collect()
    return row, time.time() - begin


def test_op5_one_long_string(spark):
    text = base64.b64encode(random.Random(5).randbytes(750_000)).decode()
    row, seconds = _spans(spark, f"a {text}")
    (span,) = row["spans"]
    assert (span["kind"], span["start"] <= 12, span["end"] >= len(text) - 10) == (3, True, True)
    assert seconds < 60


def test_op5_many_matches(spark):
    rng = random.Random(6)
    one = [f"token={rng.getrandbits(64):016x}" for _ in range(50_000)]
    one += [base64.b64encode(rng.randbytes(18)).decode() + "xY9+" for _ in range(5000)]
    rng.shuffle(one)
    row, seconds = _spans(spark, " ".join(one))
    starts, at = [], 0
    for word in one:
        if word.startswith("token="):
            starts.append((at, at + len(word)))
        at += len(word) + 1
    assert [(s["start"], s["end"]) for s in row["base"] if s["kind"] == 0] == starts
    # base spans stay, in order, and entropy adds those outside
    assert [s for s in row["spans"] if s["kind"] < 3] == row["base"]
    extra = [s for s in row["spans"] if s["kind"] == 3]
    assert len(extra) > 4000 and [s["start"] for s in row["spans"]] == sorted(
        s["start"] for s in row["spans"]
    )
    assert seconds < 60


def test_op3_takes_texts(spark):
    rng = random.Random(7)
    docs = [
        (i, "".join(rng.choice(["w%d" % i, "é", "\n", "  ", "\t", " x "]) for _ in range(40)), "en", "s")
        for i in range(30)
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    texts = {d[0]: d[1] for d in docs}
    for percent in (45, 100, 145):
        mix = op3.Mix(percent=percent, range_docs=4)
        rows = op3.mix_documents(spark, frame, mix).collect()
        plain = op3.mix_documents(spark, frame, mix, with_text=False)
        assert {tuple(r)[:8] for r in rows} == {tuple(r) for r in plain.collect()}
        total = sum(len(t.encode().split()) for t in texts.values())
        assert sum(r["taken_tokens"] for r in rows) == total * percent // 100
        cut = 0
        for r in rows:
            text = texts[r["doc_id"]]
            assert r["text"] == (text if r["epochs"] else None)
            assert text.startswith(r["last_text"])
            assert len(r["last_text"].encode().split()) == r["last_tokens"]
            cut += 0 < r["last_tokens"] < r["n_tokens"]
        assert cut <= 1
