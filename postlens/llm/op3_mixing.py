"""Operator 3: mixing sources to target weights by hierarchical budgeting.

The tree is domain -> language -> source; a leaf is one source in one
language of one domain. A node's capacity is its documents' words times
``max_epochs``. The token budget goes down the tree: at every node the
children's shares follow their weights, and what a child cannot take (its
capacity is short) goes to its siblings by their weights. As a child's
capacity is that of its whole subtree, a shortage reaches an ancestor's
siblings only after the nearer siblings are full. All sums are integers, so
the result does not depend on the order of additions.

Shares at one node have a closed form: with the children in order of
capacity / weight, a prefix of them is full, and the others share the rest
by weight. That is one window over the children; the tree is as large as the
number of sources, whatever the number of documents.

A leaf that gets ``a`` tokens of its ``t`` takes ``a div t`` whole epochs and
a prefix of ``a mod t`` tokens of the next one. Epoch ``e`` has its documents
in the order of md5(seed|e|doc_id); the document at the end of the prefix is
taken up to the token where the budget ends. The end is found without
sorting a leaf: documents fall into ranges of the md5 value, as many as the
leaf's size asks for (about ``range_docs`` documents each), the sums of the
ranges give the range in which the prefix ends, and only the documents of
that one range are put in order. A source with a third of all rows therefore
never is in one task.

Nulls and edge cases: null language or source is the node ``''``; a null or
empty text has no tokens and is not taken; a null doc_id is ordered as the
text ``null``; very long texts are cut by one pass over their tokens, and only
where the budget ends in them; repeated rows are each a document; other columns are ignored;
a node without tokens gets nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import Tables, binary_values, checkpointed, read_table

TREE = ("domain", "lang", "source")
LEAF_KEYS = list(TREE)
# Leaves up to which their table is broadcast (about 100 bytes each); beyond
# it, documents are joined to it by a shuffle that splits hot keys.
BROADCAST_LEAVES = 50_000


@dataclass(frozen=True)
class Mix:
    """Target weights (positive integers; names not listed: ``default``)."""

    domains: Mapping[str, int] = field(default_factory=dict)
    langs: Mapping[str, int] = field(default_factory=dict)
    sources: Mapping[str, int] = field(default_factory=dict)
    default: int = 1
    # budget in percent of the corpus's tokens
    percent: int = 60
    max_epochs: int = 2
    seed: int = 17
    range_docs: int = 4096


PRODUCTION = Mix(
    domains={"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    langs={"en": 4, "de": 3, "fr": 2, "es": 1},
)


def default_domain() -> Column:
    """Documents name no domain: sources are dealt to four by crc32."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return F.concat(F.lit("domain"), (F.crc32(source.cast("binary")) % 4).cast("string"))


def _weight(name: str, table: Mapping[str, int], default: int) -> Column:
    out = F.lit(default).cast("long")
    for key, w in table.items():
        out = F.when(F.col(name) == key, F.lit(w).cast("long")).otherwise(out)
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(t.split()) for t in binary_values(batch.column("text"))]
        cols = [batch.column(c) for c in ("doc_id", *TREE)]
        yield pa.RecordBatch.from_arrays(
            [*cols, pa.array(n, pa.int64())], names=["doc_id", *TREE, "n_tokens"]
        )


def _count_beside_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (counts,) = _count_words(iter([batch]))
        yield counts.append_column("text", batch.column("text"))


def token_counts(
    docs: DataFrame, domain: Column | None = None, with_text: bool = False
) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens): one narrow row per document,
    with its text behind if asked for."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (default_domain() if domain is None else domain).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id long, domain string, lang string, source string, n_tokens long"
    if with_text:
        return narrow.mapInArrow(_count_beside_text, f"{schema}, text string")
    return narrow.mapInArrow(_count_words, schema)


def _share(nodes: DataFrame, parent: list[str], name: str, budget: str) -> DataFrame:
    """``granted`` of each child: columns cap, w and the parent's budget."""
    order = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = order.orderBy(F.col("cap") / F.col("w"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = nodes.select(
        "*",
        (F.col(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("w").over(after).alias("w_left"),
    ).withColumn("full", F.col("cap") * F.col("w_left") <= F.col("w") * F.col("left"))
    # the first child that isn't full fixes what the others share
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    open_left = F.max(F.when(~F.col("full"), F.col("left"))).over(group)
    open_w = F.max(F.when(~F.col("full"), F.col("w_left"))).over(group)
    granted = F.when(F.col("full"), F.col("cap")).otherwise(
        F.expr("w * open_left div open_w")
    )
    return (
        ranked.withColumn("open_left", open_left)
        .withColumn("open_w", open_w)
        .withColumn("granted", granted)
        .drop("left", "w_left", "full", "open_left", "open_w", "cap", "w", budget)
    )


def budgets(counts: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: tokens, documents, tokens granted, whole epochs and rest."""
    leaves = counts.groupBy(*LEAF_KEYS).agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")
    )
    leaves = checkpointed(counts.sparkSession, leaves.where("tokens > 0"))
    weights = dict(zip(TREE, (mix.domains, mix.langs, mix.sources)))
    total = leaves.agg(F.expr(f"sum(tokens) * {mix.percent} div 100").alias("b0"))
    granted = None
    for depth, name in enumerate(TREE, 1):
        parent, keys = LEAF_KEYS[: depth - 1], LEAF_KEYS[:depth]
        nodes = leaves.groupBy(*keys).agg(
            (F.sum("tokens") * mix.max_epochs).alias("cap")
        )
        nodes = nodes.withColumn("w", _weight(name, weights[name], mix.default))
        if granted is None:
            # one row: the budget of the root
            nodes = nodes.join(F.broadcast(total), F.lit(True))
        else:
            nodes = nodes.join(granted.withColumnRenamed("granted", f"b{depth - 1}"), parent)
        granted = _share(nodes, parent, name, f"b{depth - 1}")
    return leaves.join(granted, LEAF_KEYS).select(
        *LEAF_KEYS,
        "tokens",
        "docs",
        "granted",
        F.expr("granted div tokens").alias("epochs"),
        F.expr("granted % tokens").alias("rest"),
    )


def select_prefixes(counts: DataFrame, leaves: DataFrame, mix: Mix) -> DataFrame:
    """Per document: whole epochs and tokens of the last, begun epoch. A column
    ``text`` of ``counts`` stays with its row."""
    spark = counts.sparkSession
    leaves = checkpointed(spark, leaves)
    small = leaves.count() <= BROADCAST_LEAVES
    hint = F.broadcast if small else (lambda df: df)
    bits = F.greatest(
        F.lit(0), F.least(F.lit(30), F.ceil(F.log2(F.col("docs") / mix.range_docs)))
    ).cast("int")
    sized = leaves.select(*LEAF_KEYS, "epochs", "rest", F.pow(F.lit(2), 32 - bits).cast("long").alias("width"))
    key = F.md5(
        F.concat_ws(
            "|",
            F.lit(str(mix.seed)),
            F.col("epochs").cast("string"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        ).cast("binary")
    )
    dealt = (
        counts.join(hint(sized), LEAF_KEYS)
        .withColumn("key", key)
        .withColumn("range", F.expr("cast(conv(substr(key, 1, 8), 16, 10) as bigint) div width"))
    )
    # one row per range of a leaf: map-side sums carry a hot leaf
    sums = dealt.groupBy(*LEAF_KEYS, "range", "rest").agg(F.sum("n_tokens").alias("n"))
    run = Window.partitionBy(*LEAF_KEYS).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ends = (
        sums.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
        .where("before < rest and rest <= before + n")
        .select(*LEAF_KEYS, F.col("range").alias("end_range"), "before")
    )
    ends = checkpointed(spark, ends)
    placed = dealt.join(hint(ends), LEAF_KEYS, "left")
    outside = placed.where("end_range is null or range <> end_range").withColumn(
        "last_tokens", F.expr("if(range < end_range, n_tokens, 0)")
    )
    inside = placed.where("range = end_range")
    order = Window.partitionBy(*LEAF_KEYS).orderBy("key", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = inside.withColumn(
        "at", F.col("before") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0))
    ).withColumn("last_tokens", F.expr("greatest(0, least(n_tokens, rest - at))"))
    cols = ["doc_id", *LEAF_KEYS, "n_tokens", "epochs", "last_tokens"]
    cols = cols[:-1] + [c for c in ("text",) if c in counts.columns]
    both = outside.select(
        *cols, F.coalesce("last_tokens", F.lit(0)).cast("long").alias("last_tokens")
    ).unionByName(inside.select(*cols, F.col("last_tokens").cast("long")))
    return both.where("n_tokens > 0").withColumn(
        "taken_tokens", F.col("epochs") * F.col("n_tokens") + F.col("last_tokens")
    )


def _prefix(text: str, n: str) -> str:
    """SQL of the first ``n`` tokens of ``text``, with the space between them."""
    tokens = f"regexp_extract_all({text}, '[\\\\x20\\\\x09-\\\\x0D]*[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    return f"array_join(slice({tokens}, 1, cast({n} AS int)), '')"


def mix_documents(
    spark: SparkSession,
    docs: DataFrame,
    mix: Mix = PRODUCTION,
    domain: Column | None = None,
    with_text: bool = True,
) -> DataFrame:
    """Documents that are taken, with whole epochs, tokens of the last epoch
    and all tokens taken; ``with_text`` adds what is taken: ``text``, to be
    read ``epochs`` times (null if none), and ``last_text``, the first
    ``last_tokens`` tokens with the space between them (empty if none)."""
    counts = token_counts(docs, domain, with_text)
    if not with_text:
        counts = checkpointed(spark, counts)
        return select_prefixes(counts, budgets(counts, mix), mix).where("taken_tokens > 0")
    # a table: the passes that need no text don't read it
    counts = Tables(spark, "mixing").store(counts)
    taken = select_prefixes(counts, budgets(counts, mix), mix).where("taken_tokens > 0")
    last = f"""CASE WHEN last_tokens = 0 THEN '' WHEN last_tokens = n_tokens THEN text
      ELSE {_prefix('text', 'last_tokens')} END"""
    return taken.select(
        *[c for c in taken.columns if c != "text"],
        F.expr("CASE WHEN epochs > 0 THEN text END").alias("text"),
        F.expr(last).alias("last_text"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(spark, read_table(spark, sf_dir, "documents"), with_text=False)


def _case(name: str, table: Mapping[str, int], default: int) -> str:
    return (
        f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in table.items())
        + f" ELSE {default} END" if table else str(default)
    )


def _sql_level(name: str, parent: list[str], weight: str, mix: Mix, depth: int) -> str:
    keys = ", ".join([*parent, name])
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    join = f"JOIN g{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN g0"
    return f"""
n{depth} AS (
  SELECT {keys}, CAST(sum(tokens) * {mix.max_epochs} AS BIGINT) AS cap,
         CAST({weight} AS BIGINT) AS w FROM leaves GROUP BY {keys}
), r{depth} AS (
  SELECT n.*, budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
  FROM (SELECT * FROM n{depth} {join}) n WINDOW o AS ({part} ORDER BY CAST(cap AS DOUBLE) / w, {name})
), g{depth} AS (
  SELECT {keys}, CAST(CASE WHEN cap * wl <= w * rem THEN cap ELSE
      (w * max(CASE WHEN cap * wl > w * rem THEN rem END) OVER ({part}))
      // max(CASE WHEN cap * wl > w * rem THEN wl END) OVER ({part}) END AS BIGINT) AS budget
  FROM r{depth}
)"""


def oracle_sql(mix: Mix = PRODUCTION) -> str:
    """The same selection with one plain running sum per leaf; domains by a
    table of the crc32 values that SQL can't compute."""
    from zlib import crc32

    domains = {f"src{i}": f"domain{crc32(f'src{i}'.encode()) % 4}" for i in range(20)}
    domain = "CASE source " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in domains.items()) + " END"
    levels = ",".join(
        _sql_level(name, LEAF_KEYS[:d], _case(name, w, mix.default), mix, d + 1)
        for d, (name, w) in enumerate(zip(TREE, (mix.domains, mix.langs, mix.sources)))
    )
    return rf"""
WITH c AS (
  SELECT doc_id, {domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens FROM c GROUP BY ALL HAVING sum(n_tokens) > 0
), g0 AS (SELECT CAST(sum(tokens) * {mix.percent} // 100 AS BIGINT) AS budget FROM leaves
),{levels}, e AS (
  SELECT c.*, CAST(budget // tokens AS BIGINT) AS epochs, budget % tokens AS rest
  FROM c JOIN leaves USING (domain, lang, source) JOIN g3 USING (domain, lang, source)
), s AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
      ORDER BY md5('{mix.seed}|' || epochs || '|' || doc_id), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM e
), t AS (
  SELECT *, CAST(greatest(0, least(n_tokens, rest - pos)) AS BIGINT) AS last_tokens FROM s
)
SELECT doc_id, domain, lang, source, n_tokens, epochs, last_tokens,
       CAST(epochs * n_tokens + last_tokens AS BIGINT) AS taken_tokens
FROM t WHERE n_tokens > 0 AND epochs * n_tokens + last_tokens > 0
"""


ORACLE_SQL = oracle_sql()
