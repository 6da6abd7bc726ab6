"""op1's attention weights come from every window of every training document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlens.llm import op1_lm_scoring as op1
from postlens.llm.common import checkpointed

PARAMS = op1.Params(
    symbols=32, classes=6, width=4, stride=4, frequent=20, sample_docs=2, windows_per_doc=1, steps=3
)
VOCABULARY = op1.read_vocabulary(PARAMS.vocabulary)


def texts_of(n):
    rng = np.random.default_rng(3)
    return [" ".join(f"w{x}" for x in rng.integers(0, 30, 40)) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def counts_of(spark, docs):
    counted = docs.select("text").mapInArrow(op1.count_corpus(VOCABULARY), "kind int, key long, n long")
    return checkpointed(spark, counted.groupBy("kind", "key").agg(F.sum("n").alias("n")).where("n > 0"))


def weights(spark, texts, counts):
    return op1.build_model(spark, frame(spark, texts), counts, VOCABULARY, PARAMS).weights


def test_no_document_or_window_is_left_out(spark):
    """With the counts held, another end of any one document changes the weights."""
    texts = texts_of(6)
    counts = counts_of(spark, frame(spark, texts))
    whole = weights(spark, texts, counts)
    again = weights(spark, texts, counts)
    assert all((whole[k] == again[k]).all() for k in whole)
    for i in range(len(texts)):
        other = [t[:-20] + "w1 w1 w1 w1 w1 w1 w1" if j == i else t for j, t in enumerate(texts)]
        changed = weights(spark, other, counts)
        assert any((whole[k] != changed[k]).any() for k in whole), i


def test_mean_over_tasks_by_windows(spark):
    texts = texts_of(9)
    parts = [texts[:4], texts[4:]]
    counts = counts_of(spark, frame(spark, texts))
    model = op1.build_model(spark, frame(spark, texts), counts, VOCABULARY, PARAMS)
    model.weights = op1.first_weights(model.weights["emb"], PARAMS)
    rows = spark.sparkContext.parallelize(list(enumerate(texts)), 2)
    both = op1._fitted(spark, spark.createDataFrame(rows, "doc_id long, text string"), model)
    alone = [op1._fitted(spark, frame(spark, p), model) for p in parts]
    known = op1.Words(VOCABULARY)
    n = []
    for p in parts:
        _, sym, _, size = op1._symbols(model, known, *op1._split(pa.array(p)))
        x, y = op1._windows(model, sym, size)
        assert (y >= 0).sum() == len(sym) == size.sum()
        n.append(len(x))
    for k in both:
        mean = (n[0] * alone[0][k] + n[1] * alone[1][k]) / sum(n)
        assert both[k] == pytest.approx(mean, abs=1e-5)
    empty = op1._fitted(spark, frame(spark, texts).limit(0), model)
    assert all((empty[k] == model.weights[k]).all() for k in empty)


def test_gradients_against_differences():
    rng = np.random.default_rng(4)
    p = op1.Params(symbols=9, classes=5, width=3, stride=2)
    log_class = np.log(rng.dirichlet(np.ones(5), 10))
    sizes = {"q": (3, 3), "k": (3, 3), "v": (3, 3), "out": (3, 5), "last": (3, 5), "bias": (5,), "pos": (4,)}
    w = {"emb": rng.normal(size=(10, 3))} | {k: rng.normal(size=s) for k, s in sizes.items()}
    model = op1.Model(p, b"", np.zeros(1), np.zeros(1), np.zeros(9), log_class, log_class, w)
    x, y = rng.integers(0, 10, (3, 4)), rng.integers(-1, 5, (3, 4))

    def loss(w):
        e = w["emb"][x]
        total = 0.0
        for b in range(3):
            for i in range(4):
                a = [e[b, i] @ w["q"] @ (e[b, j] @ w["k"]) / np.sqrt(3) + w["pos"][i - j] for j in range(i + 1)]
                a = np.exp(a) / np.exp(a).sum()
                o = sum(s * (e[b, j] @ w["v"]) for j, s in enumerate(a))
                z = o @ w["out"] + e[b, i] @ w["last"] + w["bias"] + log_class[x[b, i]]
                if y[b, i] >= 0:
                    total += np.log(np.exp(z).sum()) - z[y[b, i]]
        return total / (y >= 0).sum()

    got = op1.Fit(model).gradients(x, y)
    for k, v in w.items():
        want = np.zeros(v.shape)
        for at in np.ndindex(v.shape):
            up, down = ({**w, k: v.copy()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            want[at] = (loss(up) - loss(down)) / 2e-5
        assert got[k] == pytest.approx(want, abs=2e-4), k


def test_words_encoded_together_as_alone():
    odd = ["a\xa0", "\xa0b", "it's", "'s", "x" * 300, "\x85\xfc", "123456", "\x1c", "!!??"]
    words = [w.encode() for w in odd] + [b"\xff", b"q\xc3"] + [f"w{i}".encode() for i in range(3000)]
    known = op1.Words(VOCABULARY)
    alone = op1.encoder(VOCABULARY).encode_ordinary
    for i, w in zip(known.ids(words).tolist(), words):
        got = known.tokens[known.start[i] : known.start[i] + known.size[i]].tolist()
        assert got == alone(" " + w.decode("utf-8", "replace"))


def test_split_like_bytes():
    texts = [" \x0b a\x0cB\x1cc \xa0 \xc4x\n", None, "", "  ", "a b a"]
    words, place, counts = op1._split(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert [words[i] for i in place] == [w for x in want for w in x]
    assert counts.tolist() == [len(x) for x in want]


def test_texts_are_split_and_encoded_once(spark):
    """Counting, fitting and scoring read coded texts, not the texts once more each."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = frame(spark, texts_of(20)).mapInArrow(seen, "doc_id long, text string")
    fold = F.col("doc_id") % 5
    scored = op1.score_documents(spark, docs, fold != 1, fold == 1, PARAMS)
    assert scored.count() == 20
    assert read.value == 20


def test_coded_texts_hold_all_words_and_tokens():
    texts = ["a bc\xa0d  it's", None, "", "x" * 300 + " a", "123456 a\tB", "w " * 70_000]
    learn = [True, False, True, True, False, True]
    ids = [7, None, 9, 9, 1, 2]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(learn), pa.array(ids)], names=["text", "learn", "doc_id"]
    )
    alone = op1.encoder(VOCABULARY).encode_ordinary
    rows = list(op1.code_texts(VOCABULARY)(iter([batch])))
    assert [r.column("learn")[0].as_py() for r in rows] == [True, False]
    for row, flag in zip(rows, (True, False)):
        (block,) = op1._blocks(iter([row]))
        own = [(t or "").lower() for t, x in zip(texts, learn) if x == flag]
        words = [t.encode().split() for t in own]
        assert block.words.tolist() == [len(w) for w in words]
        assert block.values("doc_id").to_pylist() == [i for i, x in zip(ids, learn) if x == flag]
        tokens, n = op1._tokens(block, block.place, block.words)
        want = [[z for x in w for z in alone(" " + x.decode())] + [op1.END] for w in words]
        assert tokens.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]
        hashes = [op1.xxhash.xxh3_64_intdigest(x) for w in words for x in w]
        assert block.hash[block.place].tolist() == hashes


def test_exps_within_bounds():
    rng = np.random.default_rng(6)
    for scale in (1, 40, 400):
        z = rng.normal(size=(3, 4, 4)) * scale
        plus = rng.normal(size=(4, 4))
        for past in (None, np.tril(np.ones((4, 4), bool))):
            got, total = op1._exps(lambda: z.astype(np.float32), plus.astype(np.float32), past)
            want = np.exp(np.clip(z + plus, -60, 60)) * (1 if past is None else past)
            whole = want.sum(axis=-1, keepdims=True)
            assert got / total == pytest.approx(want / whole, rel=1e-3, abs=1e-9)
            assert total == pytest.approx(whole, rel=1e-3)
