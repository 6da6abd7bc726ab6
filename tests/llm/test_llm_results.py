"""Results against brute force, SQL and held-out labels."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import op1_lm_scoring as op1
from postlens.llm import op2_language_ppm as op2
from postlens.llm import op3_mixing as op3
from postlens.llm import op4_probminhash as op4
from postlens.llm import op5_secrets as op5
from postlens.llm import op7_suffix_dedup as op7
from postlens.llm import op8_toxicity_crf as op8
from postlens.llm import op9_decontaminate as op9
from postlens.llm import op10_warc as op10
from postlens.llm.catalog import ORACLE_SQL, QUERIES
from postlens.llm.common import HashedWords, fold_of

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF2}/{t}.parquet')")
    return c


def texts(spark, d):
    found = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], (r["text"] or "").encode()) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF2)
    cur = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(cur.fetchall(), key=repr)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=repr) == want


def test_op1_base_and_model(spark):
    params = op1.Params(sample_docs=100, steps=60, frequent=500)
    fold = fold_of("doc_id", 5)
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    got = {r["doc_id"]: r for r in op1.score_documents(spark, docs, fold != 1, fold == 1, params).collect()}
    split = [(i, t.lower().split()) for i, t in texts(spark, SF2)]
    held = {i for i, _ in split if zlib.crc32(str(i).encode()) % 5 == 1}
    count = collections.Counter()
    for i, w in split:
        if i not in held:
            count.update([*w, None])
    n, v = sum(count.values()), len(count)
    for i, w in split:
        r = got[i]
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None])
        assert r["held_out"] == (i in held) and r["train_tokens"] == n
        assert r["n_tokens"] == len(w) + 1
        assert r["n_known"] == sum(count[x] > 0 for x in [*w, None])
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
        assert r["score"] < 0


def test_op1_windows_score_each_token_once():
    """The batched windows against one token at a time."""
    rng = np.random.default_rng(2)
    p = op1.Params(symbols=12, classes=5, width=4, stride=3)
    m = op1.Model(
        p, b"", np.zeros(1), np.zeros(1), rng.integers(0, 5, 12), np.log(rng.random((13, 12))),
        np.log(rng.random((13, 5))),
        {
            "emb": rng.normal(size=(13, 4)), "q": rng.normal(size=(4, 4)), "k": rng.normal(size=(4, 4)),
            "v": rng.normal(size=(4, 4)), "out": rng.normal(size=(4, 5)), "last": rng.normal(size=(4, 5)),
            "bias": rng.normal(size=5), "pos": rng.normal(size=6),
        },
    )
    n = np.array([1, 7, 12, 3, 4])
    sym = rng.integers(0, 12, n.sum())
    got = op1.Scorer(m)(sym, n)
    q, k, v, last = m.tables()
    at = 0
    for size in n:
        x = [12, *sym[at : at + size - 1]]
        for j in range(size):
            block = j // 3 * 3
            seen = range(max(0, block - 3), j + 1)
            a = np.array([q[x[j]] @ k[x[u]] + m.weights["pos"][j - u] for u in seen])
            a = np.exp(a) / np.exp(a).sum()
            z = sum(w * v[x[u]] for w, u in zip(a, seen)) @ m.weights["out"] + last[x[j]]
            y = sym[at + j]
            want = z[m.class_of[y]] - np.log(np.exp(z).sum()) + m.log_in_class[x[j], y]
            assert got[at + j] == pytest.approx(want, abs=1e-4)
        at += size


def test_op2_code_lengths_and_accuracy(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    fold = fold_of("doc_id", 5)
    params = op2.Params(sample_docs=10)
    trees = op2.train(spark, docs, fold != 0, params)
    order = op2.Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = docs.where(fold != 0).withColumn("r", F.row_number().over(order)).where("r <= 10")
    seen = {x: [collections.defaultdict(collections.Counter) for _ in range(4)] for x in trees.langs}
    classes = lambda t: [32] * 3 + [int(op2._CLASS[b]) for b in t]
    for r in sample.collect():
        c = classes(r["text"].encode())
        for i, k in itertools.product(range(3, len(c)), range(4)):
            seen[r["lang"]][k][tuple(c[i - k : i])][c[i]] += 1

    def bits(lang, text):
        c, total = classes(text), 0.0
        for i in range(3, len(c)):
            for k in (3, 2, 1, 0):
                after = seen[lang][k].get(tuple(c[i - k : i]))
                if not after:
                    continue
                n, q = sum(after.values()), len(after)
                if c[i] in after:
                    total -= math.log2(after[c[i]] / (n + q))
                    break
                total -= math.log2(q / (n + q))
            else:
                total += math.log2(op2.ALPHABET)
        return total

    probe = ["hello wörld ÿ𝒳 q zz 42".encode(), "日本".encode(), b"the and of", b""]
    want = [[bits(x, t) for x in trees.langs] for t in probe]
    assert np.allclose(op2.Pricer(trees)(probe), want)
    assert np.allclose(op2.Pricer(trees, max_cells=0)(probe), want)
    got = op2.identify(docs, trees, fold == 0).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_op3_shortage_goes_to_siblings_first(spark):
    rows = [(1, "a", "x", "en"), (2, "b", "x", "en"), (3, "c", "x", "de"), (4, "d", "y", "en")]
    sizes = {1: 10, 2: 90, 3: 100, 4: 1000}
    docs = spark.createDataFrame(
        [(i, "w " * sizes[i], s, dom, lang) for i, s, dom, lang in rows],
        "doc_id long, text string, source string, dom string, lang string",
    )
    counts = op3.token_counts(docs, F.col("dom"))
    mix = op3.Mix(percent=25, max_epochs=1)  # 300 of 1200 tokens
    got = {r["source"]: r["granted"] for r in op3.budgets(counts, mix).collect()}
    # x and y get 150 each; in x, en and de 75 each; in en, a is full at 10
    assert got == {"a": 10, "b": 65, "c": 75, "d": 150}
    mix = op3.Mix(percent=50, max_epochs=1)  # 600: x is full at 200, y takes 400
    got = {r["source"]: r["granted"] for r in op3.budgets(counts, mix).collect()}
    assert got == {"a": 10, "b": 90, "c": 100, "d": 400}


def test_op2_more_languages_than_a_block(spark):
    rng = np.random.default_rng(5)
    rows = []
    for lang in range(70):  # words of three letters each language has for itself
        own = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3, replace=False)
        for n in range(4):
            text = " ".join("".join(rng.choice(own, 5)) + f"q{chr(97 + lang % 26)}{chr(97 + lang // 26)}z" for _ in range(40))
            rows.append((lang * 4 + n, f"l{lang:02d}", text))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trees = op2.train(spark, docs, F.lit(True))
    assert trees.langs == [f"l{x:02d}" for x in range(70)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in op2.identify(docs, trees, F.lit(False)).collect()}
    assert {i: x for i, (x, _) in got.items()} == {i: lang for i, lang, _ in rows}
    whole = op2.train(spark, docs, F.lit(True), op2.Params(lang_block=100))
    for r in op2.identify(docs, whole, F.lit(False)).collect():
        assert got[r["doc_id"]] == (r["lang_pred"], pytest.approx(r["score"]))


def exact_classes(found, threshold=0.8):
    sets = {}
    for i, t in found:
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    by = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    shared = collections.Counter(p for x in by.values() for p in itertools.combinations(sorted(x), 2))
    links = [(a, b) for (a, b), n in shared.items() if n >= threshold * (len(sets[a]) + len(sets[b]) - n)]
    none = [i for i, s in sets.items() if not s]
    links += list(zip(none, none[1:]))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in sets}


def test_op4_classes(spark):
    want = exact_classes(texts(spark, SF2))
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in op4.near_duplicates(spark, docs).collect()}
    assert got == want


def test_op4_large_group_and_chain(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):  # near copies of one text, more than a small key's group
        w = list(base)
        for j in rng.choice(400, 3, replace=False):
            w[j] = f"v{i}x{j}"
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(300)]
    for i in range(12):  # each like the next, the ends unlike
        rows.append((1000 + i, " ".join(chain)))
        for j in range(i * 20, i * 20 + 4):
            chain[j] = f"n{j}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in op4.near_duplicates(spark, docs).collect()}
    assert got == exact_classes([(i, t.encode()) for i, t in rows])
    assert {got[i] for i in range(120)} == {0} and {got[1000 + i] for i in range(12)} == {1000}


def template_family(rng, pages, pairs):
    """Pages that share 600 of 700 shingles, and pairs of them at 0.8 to 0.85."""
    frame = [f"t{i}" for i in range(604)]
    own = [[f"p{i}x{j}" for j in range(100)] for i in range(pages)]
    for i in range(0, 2 * pairs, 2):
        same = int(rng.integers(30, 50))
        own[i + 1][:same] = own[i][:same]
    return [(i, " ".join(frame + x)) for i, x in enumerate(own)]


def test_op4_template_family(spark):
    rows = template_family(np.random.default_rng(7), 400, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in op4.near_duplicates(spark, docs).collect()}
    want = exact_classes([(i, t.encode()) for i, t in rows])
    assert len(set(want.values())) < 300
    assert got == want


def test_op4_common_shingles_only(spark):
    """Pages like only through what all pages share, some with another frame."""
    frame = [f"t{i}" for i in range(304)]
    rows = []
    for i in range(120):
        w = frame[: 304 - 20 * (i % 3)] + [f"p{i}x{j}" for j in range(10 + 90 * (i % 2))]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in op4.near_duplicates(spark, docs).collect()}
    assert got == exact_classes([(i, t.encode()) for i, t in rows])


def test_op4_copies_around_one_text(spark, monkeypatch):
    """Copies of one text on both sides of the threshold, each with words of its
    own: nearly all are classes of one, and few pairs are left to look at."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 500):
        w = list(base)
        for j in rng.choice(150, int(rng.integers(2, 9)), replace=False):
            w[j] = f"v{i}x{j}"
        rows.append((i, " ".join(w)))
    seen = []
    plain = op4.open_pairs

    def counted(*args):
        found = plain(*args)
        seen.append(found.count())
        return found

    monkeypatch.setattr(op4, "open_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in op4.near_duplicates(spark, docs).collect()}
    want = exact_classes([(i, t.encode()) for i, t in rows])
    assert got == want and len(set(want.values())) > 200
    assert sum(seen) < 4 * len(rows)


def test_op4_repeated_blocks(spark):
    """Equal sets of shingles, a block of 20 once or 20 to 40 times."""
    rows = []
    for i in range(40):
        w, block = [f"d{i}x{j}" for j in range(204)], [f"b{i}x{j}" for j in range(20)]
        rows.append((2 * i, " ".join(w + block)))
        rows.append((2 * i + 1, " ".join(w + block * (20 + i // 2))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in op4.near_duplicates(spark, docs).collect()}
    want = exact_classes([(i, t.encode()) for i, t in rows])
    assert got == want and len(set(want.values())) == 40


def test_op4_collects_no_ids(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i // 2}x{j}" for j in range(40 + i % 2))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def refuse(*args):
        raise AssertionError("rows collected")

    with monkeypatch.context() as m:
        m.setattr(type(docs), "toPandas", refuse)
        m.setattr(type(docs), "collect", refuse)
        found = op4.near_duplicates(spark, docs)
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == {i: i // 2 * 2 for i in range(20)}


def test_op4_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    a = [b"w%d" % x for x in rng.integers(0, 60, 400)]
    b = [b"z%d" % i if i % 9 == 0 else x for i, x in enumerate(a)]
    h, d = op4.shingles(HashedWords().hash_words(a + b), np.array([400, 400]), 1)
    s = op4.sketch(*op4.weighted(h, d), 2, 4096)
    exact, _ = op4.similarity(h[d == 0], h[d == 1])
    assert abs((s[0] == s[1]).mean() - exact) < 0.04
    # J_P from its definition
    x, y = collections.Counter(h[d == 0].tolist()), collections.Counter(h[d == 1].tolist())
    every = set(x) | set(y)
    want = sum(1 / sum(max(x[e] / x[c], y[e] / y[c]) for e in every) for c in set(x) & set(y))
    assert exact == pytest.approx(want)


def brute_removal(found, n):
    seen, out = set(), {}
    for i, t in found:
        gone = bytearray(len(t))
        for p in range(len(t) - n + 1):
            if t[p : p + n] in seen:
                gone[p : p + n] = b"\1" * n
            else:
                seen.add(t[p : p + n])
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out[i] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("n", [64, 100, 150])
def test_op7_removal(spark, n):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in op7.remove_repeats(docs, n).collect()}
    assert got == brute_removal(texts(spark, SF), n)


def test_op7_batches_blocks_and_ties(spark, monkeypatch):
    rng = np.random.default_rng(1)
    parts = [bytes(rng.integers(97, 100, 180)).decode() for _ in range(6)]
    rows = [
        (i, "".join(parts[j][rng.integers(0, 30) :] for j in rng.integers(0, 6, 5)) + "ab" * 40)
        for i in range(60)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r["doc_id"]: tuple(r)[1:] for r in op7.remove_repeats(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_removal([(i, t.encode()) for i, t in rows], 100)
    # small blocks cut long texts, the segments stay the same
    b = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    whole = op7.segments(b, np.array([0, len(b)]), 100)
    monkeypatch.setattr(op7, "BLOCK", 257)
    cut = op7.segments(b, np.array([0, len(b)]), 100)
    assert all((x == y).all() for x, y in zip(whole, cut))


def test_op8_marginals():
    rng = np.random.default_rng(1)
    f = op8.Field(rng.normal(size=(3, op8.N_OBS + 1)), rng.normal(size=(2, 2)))
    counts = np.array([5, 0, 7, 1])
    obs = rng.integers(0, op8.N_OBS, 13)
    end = np.cumsum(counts)
    own = f.potentials(obs, end - counts, end)
    want = []
    for a, z in zip(end - counts, end):
        total, ones = 0.0, np.zeros(z - a)
        for y in itertools.product((0, 1), repeat=int(z - a)):
            s = sum(own[a + i] * t for i, t in enumerate(y)) + sum(f.trans[p] for p in zip(y, y[1:]))
            total += np.exp(s)
            ones += np.exp(s) * np.array(y)
        want.extend(ones / total if z > a else [])
    assert np.allclose(f.marginals(obs, counts), want)


def test_op8_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = QUERIES["op8_toxicity_crf"](spark, d).join(labels, "doc_id").where("held_out")
    clean, toxic = got.where("toxic = 0"), got.where("toxic = 1")
    assert clean.where("predicted = 1").count() <= 0.02 * clean.count()
    assert toxic.where("predicted = 1").count() >= 0.7 * toxic.count()


def test_op9_verbatim_copies_of_placeholders_and_names(spark):
    items = [
        (1, "12 35 47 18 22 40 91 17 74 3 15 45 6 7 42"),
        (2, "list: Anna Berta Carla Dora Emma Frida Gerda Hanna Irma Jana Karla Lena Marta Nora Olga"),
        (3, "the day Anna met Berta in Rome with Carla of Paris near Dora from Berlin and Emma by Frida"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    around = "some words before it {} and some words after it"
    rows = [(10 + i, around.format(t)) for i, t in items] + [(20 + i, around.format(t.lower())) for i, t in items]
    rows.append((30, around.format("13 36 49 17 23 40 92 16 76 4 15 60 6 8 48")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op9.find_leaks(spark, docs, bench).collect()}
    assert got >= {(10 + i, i) for i, _ in items} | {(20 + i, i) for i, _ in items}
    assert {d for d, _ in got} == set(range(11, 14)) | set(range(21, 24))


def test_op9_leaks(spark):
    """Copies of items against plain 8-word matching, without case and signs."""
    import re

    clean = lambda t: [re.sub(r"^\W+|\W+$", "", w).lower() for w in t.decode().split()]
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    bench = spark.read.parquet(f"{SF2}/benchmark.parquet")
    grams = collections.defaultdict(set)
    size = {}
    for r in bench.collect():
        w = clean(r["text"].encode())
        size[r["item_id"]] = max(1, len(w) - 7)
        for j in range(len(w) - 7):
            grams[tuple(w[j : j + 8])].add(r["item_id"])
    want = collections.Counter()
    for i, t in texts(spark, SF2):
        w = clean(t)
        for j, item in {(tuple(w[j : j + 8]), x) for j in range(len(w) - 7) for x in grams.get(tuple(w[j : j + 8]), ())}:
            want[i, item] += 1
    want = {p for p, n in want.items() if n >= 0.5 * size[p[1]] or n >= 6}
    got = {(r["doc_id"], r["item_id"]) for r in op9.find_leaks(spark, docs, bench).collect()}
    assert got == want


def test_op9_parameters_and_consistency(spark):
    item = (
        "The train from Oslo to Lima leaves at 7 and Ann rides for 8 hours with 2 bags "
        "while Ann eats 8 apples today."
    )
    rows = [
        (1, "So it goes. The train from Paris to Rome leaves at 10 and Bob rides for 5 hours with 3 "
            "bags while Bob eats 5 apples today. The end came soon."),
        (2, "Nothing of the kind was ever written in this text about trains or bags or apples."),
        (3, "Eats 9 apples. And Bob rides for 5 hours."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    for limit in (op9.PRODUCTION.set_limit, 0):
        rules = op9.Rules(set_limit=limit)
        (r,) = op9.find_leaks(spark, docs, bench, rules).collect()
        assert (r["doc_id"], r["item_id"], r["reparameterised"]) == (1, 7, True)
        assert r["cover"] == 1.0
    # one name for two people does not fit the item
    bad = spark.createDataFrame([(1, item.replace("while Ann", "while Tom"))], "doc_id long, text string")
    (r,) = op9.find_leaks(spark, bad, bench).collect()
    assert r["cover"] < 1.0


def test_op10_split_files_and_chain(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = op10.round_trip(spark, pages).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {r["page_id"]: hashlib.sha1((r["html"] or "").encode()).hexdigest() for r in pages.collect()}
    assert {r["page_id"]: r["payload_digest"] for r in got} == want
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        offsets = np.unique(np.append(0, rng.integers(0, 200, n)))
        successors = np.where(rng.random(len(offsets)) < 0.8, rng.choice(offsets, len(offsets)), 500)
        successors = np.where(successors > offsets, successors, rng.integers(201, 230))
        good, at = set(), 0
        step = dict(zip(offsets.tolist(), successors.tolist()))
        while at in step:
            good.add(at)
            at = step[at]
        reached = op10.chain(offsets, successors, 220)
        assert {int(o) for o, r in zip(offsets, reached) if r} == {o for o in good if step[o] <= 220}


def test_op5_entropy_adds_spans(spark, con):
    key = "q7Zp0LkX3vB9nM2cR5tY8wA1"
    rows = [
        (1, f"see {key} there"),
        (2, "some-long-file-name-of-2024-x and 550e8400-e29b-41d4-a716-446655440000"),
        (3, f"token={key} and 0123456789ABCDEF01234567"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [s["name"] for s in r["spans"]] for r in op5.find_secrets(docs).collect()}
    assert got == {1: ["entropy"], 2: [], 3: ["assign", "entropy"]}
