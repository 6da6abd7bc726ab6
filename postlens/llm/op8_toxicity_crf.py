"""Operator 8: toxic spans by a linear-chain conditional random field.

Labels mark whole documents, the field tags tokens. Training, all on a
bounded sample of labelled rows:

1. Evidence units. A unit is a word or a prefix of 4 to 6 letters (toxic
   stems take many endings). Spark counts, per unit, the toxic and the clean
   documents that hold it; units with enough toxic documents and a log odds
   ratio above ``min_odds`` form the lexicon (at most ``lexicon``).
2. Token labels. A token of a toxic document whose evidence reaches
   ``label_odds`` is labelled toxic, all others (and all tokens of clean
   documents) are labelled clean. Tokens are seen as two binned values: the
   evidence of the word and of its best prefix.
3. The field has two tags; its potentials depend on a token's own bins, on
   those of its neighbours, and on the tag before. It is trained by gradient
   steps on the log likelihood of labelled stretches around evidence and of
   random stretches.
4. A document's score: a logistic function of the expected number of toxic
   tokens and the largest marginal, fitted on the sample's document labels.

Evidence is cross-fitted: while the field and the logistic function are
trained, a document of one half of the sample is seen with the evidence of
the other half, so that units found by chance earn no weight. Scoring uses the
evidence of the whole sample.

Scoring runs forward and backward over all tokens of every whole text, in
exact arithmetic on odds, for all documents of a batch at once. It gives the
marginals, from them the document score, and the offsets of tokens that are
toxic with at least even odds.

Nulls and edge cases: a null or empty text has no tokens; its score is the
logistic function's value for none. A null doc_id is neither learned from nor
held out. Null labels are not learned from. Several label rows of one
document: toxic if any says so. Repeated rows are scored one by one. Without
a toxic (or a clean) labelled document nothing is learned and all scores are
0. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import (
    U64,
    WordTable,
    binary_values,
    fold_of,
    read_table,
    split_docs,
    text_slices,
)


@dataclass(frozen=True)
class Params:
    sample_docs: int = 8000
    prefixes: tuple[int, ...] = (4, 5, 6)
    min_docs: int = 3
    min_odds: float = 1.5
    label_odds: float = 3.0
    lexicon: int = 50_000
    stretch: int = 24
    max_stretches: int = 4000
    steps: int = 200
    threshold: float = 0.7


PRODUCTION = Params()
BLOCK_BYTES = 4 << 20
# log odds at which the bins of evidence begin
BINS = np.array([0.5, 2.0, 3.0, 4.0])
N_BINS = len(BINS) + 1
N_OBS = N_BINS * N_BINS
_EDGE = re.compile(r"^\W+|\W+$")


def units(word: bytes, prefixes: tuple[int, ...]) -> list[int]:
    """Hashes of a word and of its prefixes (0 where the word is too short)."""
    core = _EDGE.sub("", word.decode("utf-8", "replace")).lower()
    if not core:
        return [0] * (1 + len(prefixes))
    out = [xxhash.xxh3_64_intdigest(b"w" + core.encode())]
    for n in prefixes:
        # a prefix stands for longer words only
        long = len(core) > n
        out.append(xxhash.xxh3_64_intdigest(b"%d" % n + core[:n].encode()) if long else 0)
    return out


class WordUnits:
    """Dense word ids with the unit hashes of each (rows of ``table``)."""

    def __init__(self, prefixes: tuple[int, ...], limit: int = 300_000):
        self.prefixes, self.limit = prefixes, limit
        self._reset()

    def _reset(self) -> None:
        self.words = WordTable()
        self.table = np.zeros((0, 1 + len(self.prefixes)), U64)

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.words) > self.limit:
            self._reset()
        ids = self.words.ids(words)
        new = len(self.words) - len(self.table)
        if new:
            it = reversed(self.words)
            fresh = [next(it) for _ in range(new)][::-1]
            rows = np.array([units(w, self.prefixes) for w in fresh], U64)
            self.table = np.vstack([self.table, rows])
        return ids


def count_units(prefixes: tuple[int, ...]):
    """Task function: (half, toxic, text) to (unit, half, toxic and clean docs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordUnits(prefixes)
        for batch in batches:
            for rows in text_slices(batch, "text", BLOCK_BYTES):
                toxic = np.array(rows.column("toxic").to_pylist(), np.int64)
                half = np.array(rows.column("half").to_pylist(), np.int64)
                words, counts = split_docs(binary_values(rows.column("text")))
                ids = known.ids(words)
                doc = np.repeat(np.arange(len(counts)), counts)
                pairs = np.unique(doc * len(known.table) + ids) if len(ids) else ids
                doc, ids = pairs // max(1, len(known.table)), pairs % max(1, len(known.table))
                found = []
                for j in range(known.table.shape[1]):
                    unit = known.table[ids, j]
                    uniq, at = np.unique(unit, return_inverse=True)
                    once = np.unique(doc * max(1, len(uniq)) + at)
                    d, u = once // max(1, len(uniq)), once % max(1, len(uniq))
                    real = uniq != 0
                    cells = [uniq[real].view(np.int64)]
                    for side in (0, 1):
                        for tag_of in (1, 0):
                            w = (half[d] == side) & (toxic[d] == tag_of)
                            n = np.bincount(u, weights=w, minlength=len(uniq))
                            cells.append(n[real].astype(np.int64))
                    found.append(cells)
                cells = [pa.array(np.concatenate(x)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(cells, names=["unit", "a0", "b0", "a1", "b1"])

    return run


class Evidence:
    """Observation symbols of words under a lexicon (sorted hashes, odds)."""

    def __init__(self, hashes: np.ndarray, odds: np.ndarray, prefixes: tuple[int, ...]):
        order = np.argsort(hashes)
        self.hashes, self.odds = hashes[order], odds[order]
        self.known = WordUnits(prefixes)
        self.done = 0
        self.symbol = np.zeros(0, np.int8)
        self.best = np.zeros(0)

    def _odds(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(h.shape)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.odds[at], 0.0)

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, best log odds) of every word."""
        ids = self.known.ids(words)
        if len(self.known.table) < self.done:
            self.done, self.symbol, self.best = 0, self.symbol[:0], self.best[:0]
        if len(self.known.table) > self.done:
            odds = self._odds(self.known.table[self.done :])
            own, prefix = odds[:, 0], odds[:, 1:].max(axis=1)
            s = np.searchsorted(BINS, own, "right") * N_BINS + np.searchsorted(BINS, prefix, "right")
            self.symbol = np.append(self.symbol, s.astype(np.int8))
            self.best = np.append(self.best, np.maximum(own, prefix))
            self.done = len(self.known.table)
        return self.symbol[ids], self.best[ids]


class Field:
    """Two-tag linear-chain field over observation symbols."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        # rows: own, left and right neighbour; last column: no neighbour
        self.weights = weights
        self.trans = trans  # log potentials, tag before x tag

    def potentials(self, obs: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log odds of each token's own potential (tag 1 against tag 0)."""
        if not len(obs):
            return np.zeros(0)
        left = np.append(N_OBS, obs[:-1])
        right = np.append(obs[1:], N_OBS)
        some = end > first
        left[first[some]] = N_OBS
        right[end[some] - 1] = N_OBS
        return self.weights[0][obs] + self.weights[1][left] + self.weights[2][right]

    def marginals(self, obs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of tag 1 for every token of every document."""
        end = np.cumsum(counts)
        first = end - counts
        own = np.exp(np.clip(self.potentials(obs, first, end), -60, 60))
        m = np.exp(self.trans)
        order = np.argsort(-counts, kind="stable")
        n, start, stop = counts[order], first[order], end[order]
        forward = np.empty(len(obs))
        backward = np.empty(len(obs))
        live = np.searchsorted(-n, 0, "left")
        ratio = np.ones(live)
        for t in range(int(n[0]) if len(n) else 0):
            live = np.searchsorted(-n, -t, "left")
            r = ratio[:live]
            at = start[:live] + t
            if t:
                r = (m[0, 1] + m[1, 1] * r) / (m[0, 0] + m[1, 0] * r)
            ratio = r * own[at]
            forward[at] = ratio
        ratio = np.ones(len(n))
        for t in range(int(n[0]) if len(n) else 0):
            live = np.searchsorted(-n, -t, "left")
            at = stop[:live] - 1 - t
            if t:
                s = ratio[:live] * own[at + 1]
                ratio = (m[1, 0] + m[1, 1] * s) / (m[0, 0] + m[0, 1] * s)
            backward[at] = ratio[:live]
        odds = forward * backward
        return odds / (1 + odds)


def train_field(obs: np.ndarray, labels: np.ndarray, mask: np.ndarray, steps: int) -> Field:
    """Gradient ascent (Adam) on the mean log likelihood of the stretches.

    ``obs``, ``labels``, ``mask``: (stretches, length); a stretch is a prefix
    of its row.
    """
    n, length = obs.shape
    left = np.hstack([np.full((n, 1), N_OBS), obs[:, :-1]])
    right = np.hstack([np.where(mask[:, 1:], obs[:, 1:], N_OBS), np.full((n, 1), N_OBS)])
    seen = (obs, left, right)
    w = np.zeros((3, N_OBS + 1))
    trans = np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)]
    both = mask[:, 1:]
    pair = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pair[i, j] = (both & (labels[:, :-1] == i) & (labels[:, 1:] == j)).sum()
    total = mask.sum()
    for step in range(1, steps + 1):
        own = np.exp(sum(w[k][seen[k]] for k in range(3)))
        m = np.exp(trans)
        # odds of tag 1 from the left (with the own potential) and the right
        fore, back = own.copy(), np.ones(own.shape)
        for t in range(1, length):
            r = fore[:, t - 1]
            fore[:, t] *= (m[0, 1] + m[1, 1] * r) / (m[0, 0] + m[1, 0] * r)
        for t in range(length - 2, -1, -1):
            s = back[:, t + 1] * own[:, t + 1]
            nxt = (m[1, 0] + m[1, 1] * s) / (m[0, 0] + m[0, 1] * s)
            back[:, t] = np.where(mask[:, t + 1], nxt, 1.0)
        odds = fore * back
        p = odds / (1 + odds) * mask
        right_odds = own[:, 1:] * back[:, 1:]
        joint = np.empty((2, 2, *both.shape))
        for i in (0, 1):
            for j in (0, 1):
                joint[i, j] = m[i, j] * (fore[:, :-1] if i else 1.0) * (right_odds if j else 1.0)
        joint *= both / joint.sum(axis=(0, 1))
        g_trans = pair - joint.sum(axis=(2, 3))
        miss = (labels - p) * mask
        g_w = np.stack(
            [np.bincount(s[mask], weights=miss[mask], minlength=N_OBS + 1) for s in seen]
        )
        for value, grad, a, b in (
            (w, g_w / total - 1e-5 * w, moments[0], moments[1]),
            (trans, g_trans / total - 1e-3 * trans, moments[2], moments[3]),
        ):
            a += 0.1 * (grad - a)
            b += 0.01 * (grad**2 - b)
            value += 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    return Field(w, trans)


def _by_half(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    for side in (0, 1):
        part = batch.filter(pc.equal(batch.column("half"), side))
        if part.num_rows:
            yield side, part


def stretches(hashes: np.ndarray, odds: np.ndarray, params: Params):
    """Task function: (half, toxic, text) to labelled stretches.

    ``odds``: one row per half; a document's evidence is the other half's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [Evidence(hashes, odds[1 - side], params.prefixes) for side in (0, 1)]
        rng = np.random.default_rng(7)
        for side, part in (x for batch in batches for x in _by_half(batch)):
            evidence = both[side]
            for rows in text_slices(part, "text", BLOCK_BYTES):
                toxic = np.array(rows.column("toxic").to_pylist(), np.int64)
                texts = binary_values(rows.column("text"))
                words, counts = split_docs(texts)
                obs, best = evidence.symbols(words)
                end = np.cumsum(counts)
                first = end - counts
                label = (best >= params.label_odds) & (np.repeat(toxic, counts) == 1)
                out = []
                for i in range(len(counts)):
                    a, z = int(first[i]), int(end[i])
                    if a == z:
                        continue
                    hits = np.flatnonzero(obs[a:z])
                    at = int(hits[rng.integers(len(hits))]) if len(hits) and rng.random() < 0.8 else int(rng.integers(z - a))
                    lo = a + max(0, at - int(rng.integers(params.stretch)))
                    hi = min(z, lo + params.stretch)
                    key = xxhash.xxh3_64_intdigest(texts[i]) >> 1
                    out.append((key, obs[lo:hi].tolist(), label[lo:hi].astype(int).tolist()))
                cells = list(zip(*out)) if out else [()] * 3
                kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cells, kinds)], names=["key", "obs", "label"]
                )

    return run


@dataclass
class Model:
    hashes: np.ndarray
    odds: np.ndarray
    half_odds: np.ndarray
    field: Field
    calibration: np.ndarray
    params: Params


def features(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(documents, 3): 1, log of the expected toxic tokens, largest marginal."""
    n = len(counts)
    doc = np.repeat(np.arange(n), counts)
    expected = np.bincount(doc, weights=p, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, doc, p)
    return np.stack([np.ones(n), np.log(expected + 1e-3), top], axis=1)


def _marginals(model: Model, evidence: Evidence, batch: pa.RecordBatch):
    obs, counts = [np.zeros(0, np.int8)], [np.zeros(0, np.int64)]
    for rows in text_slices(batch, "text", BLOCK_BYTES):
        words, n = split_docs(binary_values(rows.column("text")))
        obs.append(evidence.symbols(words)[0])
        counts.append(n)
    counts = np.concatenate(counts)
    return model.field.marginals(np.concatenate(obs), counts), counts


def sample_features(model: Model):
    """Task function: (half, toxic, text) to features for the calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.params.prefixes
        both = [Evidence(model.hashes, model.half_odds[1 - side], p) for side in (0, 1)]
        for side, part in (x for batch in batches for x in _by_half(batch)):
            x = features(*_marginals(model, both[side], part))
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), pa.array(x[:, 1]), pa.array(x[:, 2])],
                names=["toxic", "expected", "top"],
            )

    return run


def tag(model: Model):
    """Task function: (doc_id, held_out, text) to scores and offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(model.hashes, model.odds, model.params.prefixes)
        for batch in batches:
            p, counts = _marginals(model, evidence, batch)
            x = features(p, counts)
            score = 1 / (1 + np.exp(-np.clip(x @ model.calibration, -500, 500)))
            spans = _offsets(batch.column("text"), p, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= model.params.threshold).astype(np.int32)),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                ],
                names=["doc_id", "held_out", "score", "predicted", "spans"],
            )

    return run


def _offsets(texts: pa.Array, p: np.ndarray, counts: np.ndarray) -> list[list[list[int]]]:
    """Per document, [start, end) in code points of its toxic tokens."""
    end = np.cumsum(counts)
    out: list[list[list[int]]] = [[] for _ in counts]
    hits = np.flatnonzero(p >= 0.5)
    doc = np.searchsorted(end, hits, "right")
    for d in np.unique(doc):
        wanted = set((hits[doc == d] - (end[d] - counts[d])).tolist())
        found = re.finditer(r"[^\x20\x09-\x0D]+", texts[int(d)].as_py())
        out[d] = [[m.start(), m.end()] for i, m in enumerate(found) if i in wanted]
    return out


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a little shrinkage."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.05 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    params: Params = PRODUCTION,
) -> Model | None:
    """The model from a bounded sample of labelled rows where ``learn`` holds."""
    marks = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(learn)
        .orderBy(F.xxhash64("id"), "id")
        .limit(params.sample_docs)
    )
    # at most sample_docs rows: one per id, however often it is repeated
    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(marks), F.col("doc_id") == F.col("id"))
        .groupBy("id", "toxic")
        .agg(F.min("text").alias("text"))
        .select((F.xxhash64("id") % 2 == 0).cast("int").alias("half"), "toxic", "text")
    )
    totals = marks.groupBy("toxic").count().collect()
    size = {r["toxic"]: r["count"] for r in totals}
    if not size.get(1) or not size.get(0):
        return None


    def odds(a: Column, b: Column, times: int) -> Column:
        """Log odds ratio with pseudo-counts; a half's documents count twice."""
        return F.log(((a * times + 0.5) / (size[1] + 1)) / ((b * times + 2.0) / (size[0] + 4)))

    lexicon = (
        sample.mapInArrow(
            count_units(params.prefixes), "unit long, a0 long, b0 long, a1 long, b1 long"
        )
        .groupBy("unit")
        .agg(*[F.sum(c).alias(c) for c in ("a0", "b0", "a1", "b1")])
        .where(F.col("a0") + F.col("a1") >= min(params.min_docs, size[1]))
        .select(
            "unit",
            odds(F.col("a0") + F.col("a1"), F.col("b0") + F.col("b1"), 1).alias("odds"),
            odds(F.col("a0"), F.col("b0"), 2).alias("odds0"),
            odds(F.col("a1"), F.col("b1"), 2).alias("odds1"),
        )
        .where(F.greatest("odds", "odds0", "odds1") >= params.min_odds)
        .orderBy(F.desc("odds"), "unit")
        .limit(params.lexicon)
        .toPandas()
    )
    hashes = lexicon["unit"].to_numpy(np.int64).view(U64)
    value = lexicon["odds"].to_numpy(np.float64)
    halves = lexicon[["odds0", "odds1"]].to_numpy(np.float64).T
    rows = (
        sample.mapInArrow(
            stretches(hashes, halves, params), "key long, obs array<int>, label array<int>"
        )
        .orderBy("key")
        .limit(params.max_stretches)
        .collect()
    )
    obs = np.zeros((max(1, len(rows)), params.stretch), np.int64)
    label, mask = np.zeros_like(obs), np.zeros(obs.shape, bool)
    for i, r in enumerate(rows):
        obs[i, : len(r.obs)], label[i, : len(r.obs)], mask[i, : len(r.obs)] = r.obs, r.label, True
    field = train_field(obs, label, mask, params.steps)
    model = Model(hashes, value, halves, field, np.zeros(3), params)
    seen = sample.mapInArrow(
        sample_features(model), "toxic int, expected double, top double"
    ).toPandas()
    x = np.stack([np.ones(len(seen)), seen["expected"], seen["top"]], axis=1)
    model.calibration = _calibrate(x, seen["toxic"].to_numpy(np.float64))
    return model


_RESULT = "doc_id long, held_out boolean, score double, predicted int, spans array<array<int>>"


def score(docs: DataFrame, model: Model | None, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted and the toxic tokens' offsets."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    if model is None:
        return rows.select(
            "doc_id",
            "held_out",
            F.lit(0.0).alias("score"),
            F.lit(0).alias("predicted"),
            F.array().cast("array<array<int>>").alias("spans"),
        )
    return rows.mapInArrow(tag(model), _RESULT)


def op8_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    model = train(spark, docs, labels, fold_of("id", 3) != 1)
    found = score(docs, model, fold_of("doc_id", 3) == 1)
    return found.withColumn("n_toxic_tokens", F.size("spans")).drop("spans")
