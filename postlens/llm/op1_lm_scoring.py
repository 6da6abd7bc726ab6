"""Operator 1: language-model scoring.

The model reads subword ids of a public byte-pair vocabulary. A word's
subwords do not depend on its neighbours (each word is encoded with a space
before it), and a text ends with an end mark. The ``symbols - 2`` most frequent
ids are symbols of their own, all others one rest symbol. With x the symbols
before a token,

    p(token | x) = p(class | x) * p(symbol | class, last symbol) * p(id | symbol)

* p(class | x): one layer of causal self-attention over the symbols before,
  trained in numpy by gradient steps on all training documents; its output is added to the log
  probability of the class after the last symbol in the corpus's counts.
* p(symbol | class, last symbol): corpus counts of symbol pairs, smoothed by
  the symbol's share in its class; p(id | rest): smoothed counts.

All texts are split and encoded once, in blocks that are stored as Parquet under
the shared folder (``code_texts``); counting, fitting and scoring read these.

The counts (words, subword pairs) come from all training documents, by one
Spark aggregation that sums in the tasks first. So do the attention weights:
each task takes gradient steps over all windows of its training documents, from
the same first weights on, and the mean of the tasks' weights, by windows, is
the model. Nothing is sampled. (The shares of documents in tasks are those of
Spark's input splits, so the weights depend on these as on the order of rows.)

Scoring: a text is cut into blocks of ``stride`` tokens; a context window is a
block and the block before it. The windows overlap, each token is scored once,
in its own block, with between ``stride`` and 2 * ``stride`` - 1 symbols of
context, many windows in one masked matrix product. As there is one layer,
queries, keys and values are tables by symbol.

The base score needs the count of every word. The most frequent words (at
most ``frequent``) go to all tasks, as hashes and counts; the tokens of other
words are summed per document and meet their counts in a join. Words are
matched by 64-bit hashes.

Nulls and edge cases: a null or empty text is an end token alone; a null
doc_id is not learned from and not held out; rows are scored one by one, so
repeated rows give equal rows; without any training document the counts are
zero, and so are N and V; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import (
    U64,
    Tables,
    WordTable,
    checkpointed,
    fold_of,
    read_table,
    text_slices,
)


@dataclass(frozen=True)
class Params:
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    symbols: int = 1024
    classes: int = 64
    width: int = 16
    stride: int = 16
    # bounds of the sample of earlier versions: without effect, as all training
    # documents are read, once
    sample_docs: int = 1000
    windows_per_doc: int = 16
    steps: int = 400
    # 16 bytes each, on the driver and in every task
    frequent: int = 1 << 19
    seed: int = 5


PRODUCTION = Params()
BLOCK_BYTES = 1 << 20
# Windows in one gradient step, and the unit in which weights are summed.
STEP_WINDOWS = 64
# Words encoded at once.
JOINED = 1024
FIXED = 1 << 20
# Blocks in one matrix product.
BATCH = 96
WORDS_KEPT = 300_000
# Rows of counts that a task keeps before it sums them up.
ROWS_KEPT = 1 << 20
# Rows of CODED in a row group, about a megabyte each.
GROUP_ROWS = 4
# Tokens in one product of a gradient step's long sums.
SUM_ROWS = 256
# Marks beyond all vocabulary ids, and the word that stands for a text's end
# (no word holds a line end).
END, START = 1 << 18, (1 << 18) + 1
END_WORD = b"\nend"
WORD, PAIR = 0, 1
# Fixed value: the public splitting pattern of this vocabulary.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=1)
def _ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}


@lru_cache(maxsize=1)
def encoder(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = _ranks(vocabulary)
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Subwords:
    """Words by dense id: 64-bit hash, number and start of the subword ids."""

    hash: np.ndarray
    size: np.ndarray
    start: np.ndarray
    tokens: np.ndarray

    def sequence(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``tokens`` for the words in order, and their sizes."""
        size = self.size[ids]
        begin = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(self.start[ids] - begin, size), size


class Words(Subwords):
    """Dense ids of words with their subword ids and 64-bit hashes."""

    def __init__(self, vocabulary: bytes):
        encoding = encoder(vocabulary)
        self.encode = encoding.encode_ordinary
        sizes = _ranks(vocabulary)
        self.length = np.zeros(max(sizes.values()) + 1, np.int64)
        self.length[list(sizes.values())] = [len(x) for x in sizes]
        self.reset()

    def reset(self) -> None:
        self.table = WordTable()
        self.hash = np.zeros(0, U64)
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int64)

    def ids(self, words: list[bytes]) -> np.ndarray:
        ids = self.table.ids(words)
        new = len(self.table) - len(self.hash)
        if new:
            it = reversed(self.table)
            fresh = [next(it) for _ in range(new)][::-1]
            parts = [self._encoded(fresh[i : i + JOINED]) for i in range(0, new, JOINED)]
            size = np.concatenate([n for _, n in parts])
            self.start = np.append(self.start, len(self.tokens) + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.tokens = np.concatenate([self.tokens, *(x for x, _ in parts)])
            digests = np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), U64, new)
            self.hash = np.append(self.hash, digests)
        return ids

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Subwords of all words, and how many each has. Words are encoded as one
        text if none holds a space of any kind: the pattern breaks at each space."""
        texts = [w.decode("utf-8", "replace") for w in words]
        if "".join(texts).split() == ["".join(texts)]:
            joined = " " + " ".join(texts)
            tokens = np.array(self.encode(joined), np.int64)
            size = self.length[tokens]
            spaces = np.flatnonzero(np.frombuffer(joined.encode(), np.uint8) == ord(" "))
            first = np.searchsorted(np.cumsum(size) - size, spaces)
            return tokens, np.diff(first, append=len(tokens))
        if len(words) > 1:
            half = len(words) // 2
            return tuple(map(np.concatenate, zip(self._encoded(words[:half]), self._encoded(words[half:]))))
        tokens = np.array(self.encode(" " + texts[0]), np.int64)
        return tokens, np.array([len(tokens)])


def _split(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts in ASCII lower case, the place among
    these of every word in order, and the number of words of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = parts.flatten()
    some = pc.not_equal(pc.binary_length(words), 0)
    size = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)[some.to_numpy(zero_copy_only=False)]
    coded = words.filter(some).dictionary_encode()
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return (
        coded.dictionary.cast(kind).to_numpy(zero_copy_only=False).tolist(),
        coded.indices.to_numpy(zero_copy_only=False),
        np.bincount(text, minlength=len(size)),
    )


# Coded texts, one row per block of texts that are all learned from or all not:
# per text uid, doc_id, held_out and its number of words; the place of every
# word among the block's distinct words; hash, number of subwords and subwords
# of these. Binary columns hold whole numbers, as narrow as a block allows.
CODED = (
    "learn boolean, uid array<long>, doc_id array<long>, held_out array<boolean>, "
    "texts int, distinct int, words binary, place binary, hash binary, size binary, tokens binary"
)
WIDTHS = (np.uint8, np.uint16, np.uint32, U64)


def _packed(numbers: np.ndarray) -> bytes:
    most = int(numbers.max(initial=0))
    return numbers.astype(next(x for x in WIDTHS if most <= np.iinfo(x).max)).tobytes()


def _unpacked(row: pa.RecordBatch, name: str, number: int) -> np.ndarray:
    data = row.column(name)[0].as_py()
    width = next(x for x in WIDTHS if number * np.dtype(x).itemsize == len(data))
    return np.frombuffer(data, width)


class Block(Subwords):
    """A row of CODED, or of some of its columns."""

    def __init__(self, row: pa.RecordBatch):
        self.row = row
        texts, words = (row.column(name)[0].as_py() for name in ("texts", "distinct"))
        self.words = _unpacked(row, "words", texts).astype(np.int64)
        self.place = _unpacked(row, "place", int(self.words.sum())).astype(np.int64)
        self.size = _unpacked(row, "size", words).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.tokens = _unpacked(row, "tokens", int(self.size.sum())).astype(np.int64)
        if "hash" in row.schema.names:
            self.hash = np.frombuffer(row.column("hash")[0].as_py(), U64)

    def values(self, name: str) -> pa.Array:
        """A column of the texts."""
        return self.row.column(name).flatten()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1))


def code_texts(vocabulary: bytes):
    """Task function: texts, with uid, doc_id, held_out and learn if these are
    there, to rows of CODED. Without ``learn`` all are learned from."""

    def listed(part: pa.RecordBatch, name: str, kind: pa.DataType) -> pa.Array:
        values = part.column(name) if name in part.schema.names else pa.nulls(part.num_rows, kind)
        return pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(vocabulary)
        for batch in batches:
            halves = [(True, batch)]
            if "learn" in batch.schema.names:
                learn = batch.column("learn")
                halves = [(True, batch.filter(learn)), (False, batch.filter(pc.invert(learn)))]
            for learn, half in halves:
                for part in text_slices(half, "text", BLOCK_BYTES):
                    if len(known.table) > WORDS_KEPT:
                        known.reset()
                    words, place, counts = _split(part.column("text"))
                    ids = known.ids(words)
                    at, size = known.sequence(ids)
                    numbers = (counts, place, size, known.tokens[at])
                    packed = [_packed(x) for x in numbers]
                    packed.insert(2, known.hash[ids].tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([learn]),
                            listed(part, "uid", pa.int64()),
                            listed(part, "doc_id", pa.int64()),
                            listed(part, "held_out", pa.bool_()),
                            pa.array([len(counts)], pa.int32()),
                            pa.array([len(words)], pa.int32()),
                            *(pa.array([x], pa.binary()) for x in packed),
                        ],
                        names=[x.split()[0] for x in CODED.split(", ")],
                    )

    return run


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their sums."""
    rows = pa.table({"key": np.concatenate(keys).view(np.int64), "n": np.concatenate(n)})
    total = rows.group_by("key", use_threads=False).aggregate([("n", "sum")])
    return total.column("key").to_numpy(), total.column("n_sum").to_numpy()


def count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: coded texts to (kind, key, n): words, and subword pairs."""
    keys: dict[int, list[np.ndarray]] = {WORD: [], PAIR: []}
    sums: dict[int, list[np.ndarray]] = {WORD: [], PAIR: []}
    docs = 0

    def add(kind: int, key: np.ndarray, n: np.ndarray) -> None:
        keys[kind].append(key.view(np.int64))
        sums[kind].append(n)

    def flush(most: int) -> Iterator[pa.RecordBatch]:
        """Sums up what is kept; yields it where it is still over ``most`` rows."""
        for kind in keys:
            if sum(map(len, keys[kind])) <= most:
                continue
            key, n = _summed(keys[kind], sums[kind])
            keys[kind], sums[kind] = [key], [n]
            if 2 * len(key) > most:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n)],
                    names=["kind", "key", "n"],
                )
                keys[kind], sums[kind] = [], []

    for block in _blocks(batches):
        counts, ids, tokens = block.words, block.place, block.tokens
        docs += len(counts)
        often = np.bincount(ids, minlength=len(block.hash))
        add(WORD, block.hash, often)
        # pairs inside of words: as often as the word
        word = np.repeat(np.arange(len(block.size)), block.size)
        same = np.flatnonzero(word[:-1] == word[1:])
        add(PAIR, tokens[same] << 20 | tokens[same + 1], often[word[same]])
        # pairs between words, with the text's ends
        first = np.full(len(ids) + len(counts), END)
        last = np.full(len(ids) + len(counts), START)
        at = np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)
        if len(ids):
            first[at] = tokens[block.start][ids]
            last[at + 1] = tokens[block.start + block.size - 1][ids]
        begin = np.cumsum(counts + 1) - counts - 1
        last[begin] = START
        add(PAIR, last << 20 | first, np.ones(len(first), np.int64))
        yield from flush(ROWS_KEPT)
    end = np.array([xxhash.xxh3_64_intdigest(END_WORD)], U64)
    add(WORD, end, np.array([docs]))
    yield from flush(0)


def count_corpus(vocabulary: bytes):
    """Task function: texts to (kind, key, n): words, and subword pairs."""
    code = code_texts(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from count_blocks(code(batches))

    return run


@dataclass
class Model:
    """Tables by symbol; ``symbols`` is END's number + 1 = REST's + 2."""

    params: Params
    vocabulary: bytes
    symbol_of: np.ndarray  # vocabulary id -> symbol
    log_id: np.ndarray  # vocabulary id -> log p(id | symbol)
    class_of: np.ndarray  # symbol -> class
    log_in_class: np.ndarray  # (last symbol, symbol)
    log_class: np.ndarray  # (last symbol, class)
    weights: dict[str, np.ndarray]

    def tables(self) -> tuple[np.ndarray, ...]:
        w = self.weights
        e = w["emb"]
        return (
            (e @ w["q"] / np.sqrt(e.shape[1])).astype(np.float32),
            (e @ w["k"]).astype(np.float32),
            (e @ w["v"]).astype(np.float32),
            (e @ w["last"] + w["bias"] + self.log_class).astype(np.float32),
        )


def _position_bias(pos: np.ndarray, stride: int) -> np.ndarray:
    """(stride, 2 * stride): bias by distance, minus infinity for the future."""
    ahead = np.arange(stride)[:, None] + stride - np.arange(2 * stride)[None, :]
    return np.where(ahead >= 0, pos[np.maximum(ahead, 0)], -1e9).astype(np.float32)


def first_weights(emb: np.ndarray, params: Params) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(params.seed)
    d, c = params.width, params.classes
    return {
        "emb": emb,
        "q": rng.normal(0, 0.3, (d, d)),
        "k": rng.normal(0, 0.3, (d, d)),
        "v": rng.normal(0, 0.3, (d, d)),
        "out": np.zeros((d, c)),
        "last": np.zeros((d, c)),
        "bias": np.zeros(c),
        "pos": -0.02 * np.arange(2 * params.stride),
    }


class Fit:
    """Gradient steps (Adam) on the class log loss of windows, from the model's
    weights on."""

    def __init__(self, model: Model):
        # all weights in one vector, and all gradients, with views by name
        self.all = np.concatenate([v.reshape(-1) for v in model.weights.values()]).astype(np.float32)
        self.m, self.s, self.g, self.room = (np.zeros_like(self.all) for _ in range(4))
        ends = np.cumsum([v.size for v in model.weights.values()])[:-1]
        self.w, self.grad = (
            {k: x.reshape(v.shape) for (k, v), x in zip(model.weights.items(), np.split(t, ends))}
            for t in (self.all, self.g)
        )
        self.log_class = model.log_class.astype(np.float32)
        self.steps = self.windows = 0
        length = 2 * model.params.stride
        ahead = np.arange(length)[:, None] - np.arange(length)[None, :]
        self.past, self.near = ahead >= 0, np.maximum(ahead, 0)
        self.last = np.empty_like(self.log_class)
        self.cells = np.arange(self.w["emb"].size).reshape(self.w["emb"].shape)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: (windows, length) last symbols, ``y``: the classes that follow;
        -1 in ``y`` is no target."""
        w, d = self.w, self.w["emb"].shape[1]
        sym, target = x.reshape(-1), y.reshape(-1)
        e = w["emb"].take(sym, axis=0)
        to_qkv = np.concatenate([w["q"] / np.float32(np.sqrt(d)), w["k"], w["v"]], axis=1)
        qkv = (e @ to_qkv).reshape(*x.shape, 3 * d)
        q, k, v = (qkv[..., i * d : (i + 1) * d] for i in range(3))
        k_first = np.ascontiguousarray(k.transpose(0, 2, 1))
        a, total = _exps(lambda: q @ k_first, w["pos"][self.near], self.past)
        a /= total
        seen = np.empty((len(sym), 2 * d), np.float32)
        seen[:, d:] = e
        o = seen.reshape(*x.shape, 2 * d)[..., :d]
        np.matmul(a, v, out=o)
        last = np.matmul(w["emb"], w["last"], out=self.last)
        last += w["bias"]
        last += self.log_class
        p, total = _exps(lambda: seen[:, :d] @ w["out"], last.take(sym, axis=0))
        some = target >= 0
        share = some * np.float32(1 / max(1, some.sum()))
        p *= share[:, None] / total
        p.reshape(-1)[np.arange(len(p)) * p.shape[1] + np.maximum(target, 0)] -= share
        g_class = _sum_of_products(seen, p)
        g_seen = p @ np.concatenate([w["out"], w["last"]]).T
        go = g_seen.reshape(*x.shape, 2 * d)[..., :d]
        ga = go @ np.ascontiguousarray(v.transpose(0, 2, 1))
        ga -= np.einsum("bij,bij->bi", go, o)[..., None]
        ga *= a
        g_qkv = np.empty_like(qkv)
        np.matmul(ga, k, out=g_qkv[..., :d])
        np.matmul(ga.transpose(0, 2, 1), q, out=g_qkv[..., d : 2 * d])
        np.matmul(a.transpose(0, 2, 1), go, out=g_qkv[..., 2 * d :])
        g_qkv = g_qkv.reshape(len(sym), 3 * d)
        ge = g_qkv @ to_qkv.T
        ge += g_seen[:, d:]
        gq, gk, gv = np.split(_sum_of_products(e, g_qkv), 3, axis=1)
        cell = self.cells.take(sym, axis=0).reshape(-1)
        g = self.grad
        g["emb"].reshape(-1)[:] = np.bincount(cell, weights=ge.reshape(-1), minlength=g["emb"].size)
        np.divide(gq, np.float32(np.sqrt(d)), out=g["q"])
        g["k"][:], g["v"][:], g["out"][:], g["last"][:] = gk, gv, g_class[:d], g_class[d:]
        np.matmul(np.ones(len(p), np.float32), p, out=g["bias"])
        g["pos"][:] = np.bincount(self.near.reshape(-1), weights=ga.sum(axis=0).reshape(-1))
        return g

    def step(self, x: np.ndarray, y: np.ndarray) -> None:
        self.steps += 1
        self.windows += len(x)
        rate = 0.02 / np.sqrt(1 + self.steps / 100)
        long, short = np.sqrt(1 - 0.99**self.steps), 1 - 0.9**self.steps
        self.gradients(x, y)
        g, m, s, t = self.g, self.m, self.s, self.room
        np.subtract(g, m, out=t)
        t *= np.float32(0.1)
        m += t
        g *= g
        g -= s
        g *= np.float32(0.01)
        s += g
        # rate * (m / short) / (sqrt(s) / long + 1e-8)
        np.sqrt(s, out=t)
        t += np.float32(1e-8 * long)
        np.divide(m, t, out=t)
        t *= np.float32(rate * long / short)
        self.all -= t

    def flat(self) -> np.ndarray:
        return self.all.astype(np.float64)


def _exps(
    scores, plus: np.ndarray, where: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """exp of ``scores()`` + ``plus`` within -60 to 60, 0 but ``where``, and the sums
    along the last axis. The bounds are applied only if they can matter: other sums
    lie so that no score was above them, and those below add nothing in float32."""
    if where is not None:
        plus = np.where(where, plus, np.float32(-1e9))
    ones = np.ones((plus.shape[-1], 1), np.float32)
    for bounded in (False, True):
        z = scores()
        z += plus
        if bounded:
            np.clip(z, -60, 60, out=z)
        with np.errstate(over="ignore"):
            np.exp(z, out=z)
        if bounded and where is not None:
            z *= where
        total = (z.reshape(-1, z.shape[-1]) @ ones).reshape(*z.shape[:-1], 1)
        if bounded or (len(total) and 1e-15 < total.min() and total.max() < 1e25):
            break
    return z, total


def _sum_of_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of long, narrow matrices, SUM_ROWS rows at a time."""
    whole = len(a) // SUM_ROWS * SUM_ROWS
    total = a[whole:].T @ b[whole:]
    if whole:
        left, right = (t[:whole].reshape(-1, SUM_ROWS, t.shape[1]) for t in (a, b))
        total += (left.transpose(0, 2, 1) @ right).sum(axis=0)
    return total


def _group(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means: symbols of like neighbours share a class."""
    rng = np.random.default_rng(seed)
    centres = points[np.argsort(-weight)[:k]].copy()
    if len(centres) < k:
        centres = np.vstack([centres, rng.normal(0, 1, (k - len(centres), points.shape[1]))])
    label = np.zeros(len(points), np.int64)
    for _ in range(15):
        far = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None])
        label = far.argmin(axis=1)
        for j in range(k):
            own = label == j
            if weight[own].sum() > 0:
                centres[j] = np.average(points[own], axis=0, weights=weight[own])
    return label


def build_model(
    spark: SparkSession, docs: DataFrame, counts: DataFrame, vocabulary: bytes, params: Params
) -> Model:
    """The model from the corpus counts and all of ``docs``, texts or coded texts."""
    pairs = counts.where(F.col("kind") == PAIR).select(
        F.shiftright("key", 20).cast("int").alias("a"),
        F.col("key").bitwiseAND((1 << 20) - 1).cast("int").alias("b"),
        "n",
    )
    # as many rows as the vocabulary has ids at most
    single = pairs.groupBy("b").agg(F.sum("n").alias("n")).toPandas()
    size = len(vocabulary.splitlines())
    n_id = np.zeros(START + 1)
    n_id[single["b"].to_numpy(np.int64)] = single["n"]
    own = params.symbols - 2
    top = np.argsort(-n_id[:size], kind="stable")[:own]
    top = top[n_id[top] > 0]
    rest, end, start = params.symbols - 2, params.symbols - 1, params.symbols
    symbol_of = np.full(START + 1, rest, np.int64)
    symbol_of[top] = np.arange(len(top))
    symbol_of[END], symbol_of[START] = end, start
    is_rest = symbol_of == rest
    is_rest[size:] = False
    smooth = np.where(is_rest, n_id + 0.5, 0)
    log_id = np.zeros(START + 1)
    log_id[is_rest] = np.log(smooth[is_rest] / smooth.sum())
    # pairs of symbols: at most (symbols + 1) squared rows
    names = spark.createDataFrame([(int(t), i) for i, t in enumerate(top)] or [(-1, 0)], "id int, sym int")
    names = names.unionByName(
        spark.createDataFrame([(END, end), (START, start)], "id int, sym int")
    )
    left = F.broadcast(names.select(F.col("id").alias("a"), F.col("sym").alias("sa")))
    right = F.broadcast(names.select(F.col("id").alias("b"), F.col("sym").alias("sb")))
    table = (
        pairs.join(left, "a", "left")
        .join(right, "b", "left")
        .groupBy(F.coalesce("sa", F.lit(rest)).alias("sa"), F.coalesce("sb", F.lit(rest)).alias("sb"))
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    n = np.zeros((params.symbols + 1, params.symbols))
    n[table["sa"].to_numpy(np.int64), table["sb"].to_numpy(np.int64)] = table["n"]
    total = n.sum(axis=0) + 0.5
    share = total / total.sum()
    root = np.sqrt(n / np.maximum(1, n.sum(axis=1, keepdims=True)))
    rng = np.random.default_rng(params.seed)
    # leading directions of the pair table, by subspace steps
    basis = rng.normal(size=(params.symbols, params.width))
    for _ in range(8):
        basis, _ = np.linalg.qr(root.T @ (root @ basis))
    before = root @ basis
    after = root.T @ before
    after /= np.linalg.norm(after, axis=1, keepdims=True) + 1e-9
    class_of = _group(after, total, params.classes - 2, params.seed)
    class_of[end], class_of[rest] = params.classes - 1, params.classes - 2
    in_class = np.zeros((params.classes, params.symbols))
    in_class[class_of, np.arange(params.symbols)] = 1
    class_share = in_class @ share + 1e-12
    n_class = n @ in_class.T
    prior = 5.0
    log_class = np.log((n_class + prior * class_share) / (n.sum(axis=1, keepdims=True) + prior))
    inside = share / class_share[class_of]
    log_in_class = np.log((n + prior * inside) / (n_class[:, class_of] + prior))
    emb = before / (before.std() + 1e-9) * 0.5
    model = Model(
        params, vocabulary, symbol_of, log_id, class_of, log_in_class, log_class, {}
    )
    model.weights = first_weights(emb, params)
    model.weights = _fitted(spark, docs, model)
    return model


def _symbols(model: Model, known: Words, words: list[bytes], place: np.ndarray, counts: np.ndarray):
    """Word ids, symbols and log p(id | symbol) of all texts' tokens with their
    end marks, and the number of tokens of each text; for the result of _split."""
    ids = known.ids(words)[place]
    out, n = _tokens(known, ids, counts)
    return ids, model.symbol_of[out], model.log_id[out], n


def _tokens(known: Subwords, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all texts with their end marks, and how many each text has."""
    # the end mark as a word of its own
    ended = Subwords()
    ended.size, ended.start = np.append(known.size, 1), np.append(known.start, len(known.tokens))
    words = np.full(len(ids) + len(counts), len(known.size))
    words[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    at, size = ended.sequence(words)
    upto = np.cumsum(size)[np.cumsum(counts + 1) - 1]
    return np.append(known.tokens, END)[at], np.diff(upto, prepend=0)


def _windows(model: Model, sym: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all tokens, each text's from its start on: last symbols, and
    the classes that follow (-1 behind a text's end)."""
    length = 2 * model.params.stride
    number = -(-n // length)
    first = np.cumsum(n) - n
    at = np.arange(len(sym)) + np.repeat((np.cumsum(number) - number) * length - first, n)
    x = np.full(int(number.sum()) * length, model.params.symbols)
    y = np.full(len(x), -1)
    y[at] = model.class_of[sym]
    before = np.empty(len(sym), np.int64)
    before[1:] = sym[:-1]
    before[first] = model.params.symbols
    x[at] = before
    return x.reshape(-1, length), y.reshape(-1, length)


def fit_rows(model):
    """Task function: coded texts to (at, value, n): the weights after steps over
    all windows of all its texts, in units of 1 / FIXED, times their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        fit = Fit(m)
        rng = np.random.default_rng(m.params.seed)
        for block in _blocks(batches):
            tokens, n = _tokens(block, block.place, block.words)
            x, y = _windows(m, m.symbol_of[tokens], n)
            order = rng.permutation(len(x))
            for lo in range(0, len(x), STEP_WINDOWS):
                rows = order[lo : lo + STEP_WINDOWS]
                fit.step(x[rows], y[rows])
        if fit.windows:
            value = np.rint(fit.flat() * FIXED).astype(np.int64) * fit.windows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(value), dtype=np.int32)),
                    pa.array(value),
                    pa.array(np.full(len(value), fit.windows)),
                ],
                names=["at", "value", "n"],
            )

    return run


def _fitted(spark: SparkSession, docs: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """The weights fitted on all of ``docs``, texts or coded texts: each task takes
    its steps over its own windows, and the mean over the tasks, by windows, is the
    result."""
    if "text" in docs.columns:
        docs = docs.select("text").mapInArrow(code_texts(model.vocabulary), CODED)
    task = fit_rows(spark.sparkContext.broadcast(model))
    # whole numbers: the mean doesn't depend on the order of the sums
    whole = "decimal(38,0)"
    mean = (
        docs.select("texts", "distinct", "words", "place", "size", "tokens")
        .mapInArrow(task, "at int, value long, n long")
        .groupBy("at")
        .agg(F.sum(F.col("value").cast(whole)).alias("value"), F.sum("n").alias("n"))
        .select("at", (F.col("value").cast("double") / F.col("n") / FIXED).alias("value"))
        .toPandas()
    )
    if mean.empty:
        return model.weights
    flat = np.zeros(len(mean))
    flat[mean["at"].to_numpy()] = mean["value"]
    sizes = [x.size for x in model.weights.values()]
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    return {k: p.reshape(x.shape) for (k, x), p in zip(model.weights.items(), parts)}


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.q, self.k, self.v, self.last = model.tables()
        self.out = model.weights["out"].astype(np.float32)
        self.bias = _position_bias(model.weights["pos"], model.params.stride)
        # bounds that keep exp within float32
        bound = np.linalg.norm(self.q, axis=1).max() * np.linalg.norm(self.k, axis=1).max()
        bound += max(0.0, float(self.bias.max()))
        if bound > 60:
            self.q *= 60 / bound
        self.in_class = model.log_in_class.astype(np.float32)

    def __call__(self, sym: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log p(symbol | before) of every token; ``n`` tokens per text."""
        t = self.model.params.stride
        before = np.empty(len(sym), np.int64)
        before[1:] = sym[:-1]
        first = np.cumsum(n) - n
        before[first] = self.model.params.symbols
        # every text starts a block; the rest of its last block is empty
        blocks = -(-n // t)
        begin = (np.cumsum(blocks) - blocks) * t
        at = np.arange(len(sym)) + np.repeat(begin - first, n)
        x = np.zeros(int(blocks.sum()) * t, np.int64)
        x[at] = before
        target = np.zeros(len(x), np.int64)
        target[at] = self.model.class_of[sym]
        opens = np.zeros(len(x) // t, bool)
        opens[begin // t] = True
        out = np.empty(len(x), np.float32)
        x = x.reshape(-1, t)
        ones_a = np.ones((2 * t, 1), np.float32)
        ones_z = np.ones((self.out.shape[1], 1), np.float32)
        for lo in range(0, len(x), BATCH):
            hi = min(lo + BATCH, len(x))
            own = x[lo:hi]
            # the blocks before and the own ones: the same but for one
            both = np.concatenate([x[max(lo, 1) - 1 : max(lo, 1)], own])
            k = np.ascontiguousarray(self.k.take(both, axis=0).transpose(0, 2, 1))
            v = self.v.take(both, axis=0)
            q = self.q.take(own, axis=0)
            # scores are small by construction: no shift before exp
            a = np.empty((hi - lo, t, 2 * t), np.float32)
            np.matmul(q, k[:-1], out=a[..., :t])
            np.matmul(q, k[1:], out=a[..., t:])
            a += self.bias
            np.exp(a, out=a)
            a[opens[lo:hi], :, :t] = 0
            o = a[..., :t] @ v[:-1]
            o += a[..., t:] @ v[1:]
            o = o.reshape(-1, o.shape[2])
            o /= a.reshape(len(o), -1) @ ones_a
            z = o @ self.out
            z += self.last.take(own.reshape(-1), axis=0)
            hit = z[np.arange(len(z)), target[lo * t : hi * t]]
            np.exp(z, out=z)
            out[lo * t : hi * t] = hit - np.log((z @ ones_z)[:, 0])
        return out[at].astype(np.float64) + self.in_class[before, sym]


_SCORED = (
    "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
    "score double, h long, tf long"
)


def score_rows(model, frequent, end_count: int):
    """Task function: coded texts to one row per text and one per text and word
    that isn't among the frequent ones.

    ``base`` sums log10(c + 0.5) of the frequent words and the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        scorer = Scorer(m)
        hashes, counts_of = frequent.value
        for block in _blocks(batches):
            counts, ids = block.words, block.place
            tokens, n = _tokens(block, ids, counts)
            at = np.minimum(np.searchsorted(hashes, block.hash), len(hashes) - 1)
            c = np.where(hashes[at] == block.hash, counts_of[at], -1)
            text = np.repeat(np.arange(len(counts)), counts)
            token = np.repeat(np.arange(len(n)), n)
            log_p = scorer(m.symbol_of[tokens], n) + m.log_id[tokens]
            log_p = np.bincount(token, weights=log_p, minlength=len(n))
            often = c[ids] >= 0
            log_c = np.log10(np.maximum(c, 0) + 0.5)
            base = np.bincount(text[often], weights=log_c[ids[often]], minlength=len(n))
            known_n = np.bincount(text[often], minlength=len(n))
            pair, tf = np.unique(text[~often] * len(c) + ids[~often], return_counts=True)
            r, w = pair // max(1, len(c)), pair % max(1, len(c))
            uid = block.values("uid")
            empty = lambda kind: pa.nulls(len(r), kind)
            names = [x.split()[0] for x in _SCORED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [
                    uid,
                    block.values("doc_id"),
                    block.values("held_out"),
                    pa.array(counts + 1),
                    pa.array(known_n.astype(np.int64) + (end_count > 0)),
                    pa.array(base + np.log10(end_count + 0.5)),
                    pa.array(log_p / np.log(10)),
                    # rows of texts meet no word: spread over the tasks
                    uid,
                    pa.array(np.zeros(len(n), np.int64)),
                ],
                names=names,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    uid.take(pa.array(r)),
                    *(empty(k) for k in (pa.int64(), pa.bool_(), pa.int64(), pa.int64())),
                    *(empty(pa.float64()) for _ in range(2)),
                    pa.array(block.hash[w].view(np.int64)),
                    pa.array(tf.astype(np.int64)),
                ],
                names=names,
            )

    return run


def score_documents(
    spark: SparkSession,
    docs: DataFrame,
    learn: Column,
    held_out: Column,
    params: Params = PRODUCTION,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    and score."""
    vocabulary = read_vocabulary(params.vocabulary)
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # split and encoded once; the three passes below read this
    coded = Tables(spark, "op1").store(
        base.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.coalesce(held_out, F.lit(False)).alias("held_out"),
            F.coalesce(learn, F.lit(False)).alias("learn"),
            "text",
        ).mapInArrow(code_texts(vocabulary), CODED),
        **{"parquet.block.row.count.limit": GROUP_ROWS},
    )
    train = coded.where("learn")
    counts = checkpointed(
        spark,
        train.select("texts", "distinct", "words", "place", "hash", "size", "tokens")
        .mapInArrow(count_blocks, "kind int, key long, n long")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"))
        .where("n > 0"),
    )
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    stats = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # the least count at which the words still number at most ``frequent``
    by_count = sorted(
        words.groupBy(F.least("n", F.lit(1 << 16)).alias("c")).count().collect(), reverse=True
    )
    least, so_far = (1 << 16) + 1, 0
    for c, number in by_count:
        so_far += number
        if so_far > params.frequent:
            break
        least = c
    often = words.where(F.col("n") >= least).toArrow()
    h, c_often = (often.column(x).to_numpy().astype(np.int64) for x in ("key", "n"))
    del often
    h = h.view(U64)
    order = np.argsort(h)
    end_hash = xxhash.xxh3_64_intdigest(END_WORD)
    end_row = words.where(F.col("key") == int(np.uint64(end_hash).view(np.int64))).first()
    model = build_model(spark, train, counts, vocabulary, params)
    table = (h[order], c_often[order]) if len(h) else (
        np.zeros(1, U64),
        np.full(1, -1, np.int64),
    )
    task = score_rows(
        spark.sparkContext.broadcast(model),
        spark.sparkContext.broadcast(table),
        int(end_row["n"]) if end_row else 0,
    )
    scored = coded.drop("learn").mapInArrow(task, _SCORED)
    rare = words.where(F.col("n") < least).select(F.col("key").alias("h"), F.col("n").alias("c"))
    seen = F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    bottom = float(np.log10(stats["n"] + 0.5 * (stats["v"] + 1)))
    return (
        scored.join(rare, "h", "left")
        .groupBy("uid")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            (F.max("known") + F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0))).alias("n_known"),
            F.lit(int(stats["n"])).cast("long").alias("train_tokens"),
            (F.max("base") + F.sum(seen)).alias("sum_base"),
            F.max("score").alias("score"),
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            "train_tokens",
            (F.col("sum_base") - F.col("n_tokens") * F.lit(bottom)).alias("base_score"),
            "score",
        )
    )


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_of("doc_id", 5)
    return score_documents(spark, read_table(spark, sf_dir, "documents"), fold != 1, fold == 1)
