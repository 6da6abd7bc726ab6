"""Operator 5: secret scans, with DataFrame functions only.

Patterned secrets: assignments to password-like names, access keys, and long
hexadecimal strings. High-entropy secrets: runs of key characters are
candidate strings; an allow list suppresses ordinary ones (words, numbers,
dates, paths of such, UUIDs); over the others slides a window of ``WINDOW``
characters. The window keeps one count per symbol of the string's character
class (hexadecimal, or the base-64 alphabets), and the sum of c * log2(c) over
the counts: one step takes the character that leaves off its count, adds the
one that enters, and corrects the sum by the two counts' terms. Shannon
entropy is log2(WINDOW) - sum / WINDOW, so a threshold in bits is a limit of
that sum; terms are integers (millionths), so no rounding builds up. The span
goes from the first to the last window of enough entropy; spans inside a
patterned one are not reported again.

Positions come from the pieces between the matches: a match starts after all
pieces and matches before it. A text without a match of a kind costs one
pattern pass, and nothing leaves its row: there is no exchange.

Nulls and edge cases: a null text is empty and has no spans; a null doc_id is
kept; very long texts are scanned whole, in time that grows with their length
and number of matches; rows are scanned one by one, so repeated rows give equal rows; spans
are in code points, end exclusive; equal starts are ordered by kind; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import read_table


def _any_case(pattern: str) -> str:
    """Letters of ``pattern`` in either case, ASCII only."""
    return re.sub(r"[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", pattern)


# The patterned kinds. Runs that are too short fail as a whole,
# so a minimum length can stand in the pattern of access and hex; a failing
# assignment still uses up its text, so its length is checked afterwards.
NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = f"({NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

# Elements of an array that is built step by step before it is put aside.
BLOCK = 128

WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}" % WINDOW
NEEDS = {
    "assign": "(instr(?, ':') > 0 OR instr(?, '=') > 0)",
    "access": "instr(?, 'AKIA') > 0",
}
BEFORE = {"hex": "(?<![0-9a-f])", "entropy": "(?<![A-Za-z0-9+/_=-])"}
HEX_ONLY = "^([0-9a-f]+|[0-9A-F]+)$"
# Ordinary strings: words and numbers, joined by signs; UUIDs.
ALLOWED = (
    "^[-+/_=]*([A-Za-z]+|[0-9]+)([-+/_=]+([A-Za-z]+|[0-9]+))*[-+/_=]*$"
    "|^[-+/_=]+$"
    "|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
)
HEX_SYMBOLS = "0123456789abcdefABCDEF"
KEY_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
HEX_BITS, KEY_BITS = 3.0, 3.8

# Character of a count of 0.
ZERO = 48
TERMS = [round(c * math.log2(c) * 1_000_000) if c else 0 for c in range(WINDOW + 1)]


def _limit(bits: float) -> int:
    """The largest sum of terms of a window with at least ``bits`` entropy."""
    return round(WINDOW * (math.log2(WINDOW) - bits) * 1_000_000)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPAN = "struct<start:int,kind:int,end:int,name:string"


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _matches(text: str, pattern: str, kind: int, name: str) -> Column:
    """All matches as structs (start, kind, end, name, value).

    ``NEEDS`` names what a text must hold for any match; ``BEFORE`` keeps the
    search from starting inside of a run, where no match can start.
    """
    needs = NEEDS.get(name, "true").replace("?", text)
    pattern = BEFORE.get(name, "") + pattern
    found = f"regexp_extract_all({text}, {_sql(pattern)}, 0)"
    gaps = f"slice(split({text}, {_sql(pattern)}, -1), 1, size({found}))"
    none = f"cast(array() AS array<{_SPAN},value:string>>)"
    span = (
        f"named_struct('start', s.at + length(x.`1`), 'kind', {kind}, "
        f"'end', s.at + length(x.`1`) + length(x.`0`), 'name', '{name}', 'value', x.`0`)"
    )
    found_all = _running(
        f"arrays_zip({found}, {gaps})",
        none,
        "s.at + length(x.`1`) + length(x.`0`)",
        f"array({span})",
    )
    return F.expr(
        f"CASE WHEN NOT ({needs}) OR size({found}) = 0 THEN {none} ELSE {found_all} END"
    )


def _running(items: str, none: str, at: str, piece: str) -> str:
    """The pieces (arrays) that a pass over ``items`` yields, joined; ``at`` is
    the pass's running number, 0 at first. Both are written in terms of ``s.at``
    and the item ``x``.

    An array grows by copying, so items are taken in blocks of ``BLOCK``: an
    element is copied at most ``BLOCK`` times in its block, and the blocks'
    arrays once per block behind them.
    """
    block = _let(
        f"aggregate(k, named_struct('at', t.at, 'out', {none}), (s, x) -> "
        f"named_struct('at', {at}, 'out', concat(s.out, {piece})))",
        "r",
        "named_struct('at', r.at, 'out', concat(t.out, array(r.out)))",
    )
    blocks = (
        f"transform(sequence(0, (size(z) - 1) div {BLOCK}), "
        f"b -> slice(z, cast(b * {BLOCK} + 1 AS int), {BLOCK}))"
    )
    # zero: an array of no arrays
    zero = f"named_struct('at', 0, 'out', slice(array({none}), 1, 0))"
    run = f"aggregate({blocks}, {zero}, (t, k) -> {block}, t -> flatten(t.out))"
    return _let(items, "z", f"IF(size(z) = 0, {none}, {run})")


def _dense_windows() -> str:
    """(a, b): first and last window of enough entropy in ``x.value``, -1 if
    none; windows are counted from 0. State: ``c`` counts by symbol, one
    character each, ``s`` the sum of their terms. ``v`` holds the string's symbols by number, so a step
    costs the same wherever it is."""
    terms = "array(" + ", ".join(f"{t}L" for t in TERMS) + ")"
    first = f"substr(x.value, 1, {WINDOW})"
    counts = (
        f"transform(sequence(1, length(x.symbols)), j -> "
        f"length({first}) - length(replace({first}, substr(x.symbols, j, 1), '')))"
    )
    begin = _let(
        counts,
        "c",
        _let(
            f"aggregate(c, 0L, (t, n) -> t + {terms}[n])",
            "s",
            f"named_struct('c', array_join(transform(c, n -> chr({ZERO} + n)), ''), 's', s, "
            "'a', IF(s <= x.limit, 0, -1), 'b', IF(s <= x.limit, 0, -1))",
        ),
    )
    count = f"ascii(substr(p.c, {{}}, 1)) - {ZERO}"
    moved = f"p.s - {terms}[co] + {terms}[co - 1] - {terms}[cn] + {terms}[cn + 1]"
    moved = _let(count.format("o"), "co", _let(count.format("n"), "cn", f"""named_struct(
        'c', overlay(overlay(p.c, chr({ZERO} + co - 1), o, 1), chr({ZERO} + cn + 1), n, 1),
        's', {moved})"""))
    moved = f"IF(o = n, named_struct('c', p.c, 's', p.s), {moved})"
    state = """named_struct('c', m.c, 's', m.s,
        'a', IF(m.s <= x.limit AND p.a < 0, i, p.a),
        'b', IF(m.s <= x.limit, i, p.b))"""
    step = _let("v[i - 1]", "o", _let(f"v[i - 1 + {WINDOW}]", "n", _let(moved, "m", state)))
    steps = (
        f"IF(length(x.value) > {WINDOW}, sequence(1, length(x.value) - {WINDOW}), "
        "cast(array() AS array<int>))"
    )
    windows = f"aggregate({steps}, {begin}, (p, i) -> {step}, p -> named_struct('a', p.a, 'b', p.b))"
    return _let("transform(split(x.value, ''), q -> instr(x.symbols, q))", "v", windows)


def with_spans(rows: DataFrame, text: str, base: str, spans: str) -> DataFrame:
    """``rows`` with the columns ``base`` and ``spans``: arrays of (start, kind,
    end, name) in order. ``text`` must not be null."""
    kinds = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    raw = {name: f"__{base}_{name}" for name in kinds}
    found = rows.select(
        "*",
        *[_matches(text, p, i, name).alias(raw[name]) for i, (name, p) in enumerate(kinds.items())],
    )
    plain = "x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end, 'name', x.name)"
    value = f"regexp_extract(x.value, {_sql(ASSIGN)}, 2)"
    is_hex = f"x.value RLIKE {_sql(HEX_ONLY)}"
    strings = f"__{base}_strings"
    found = found.select(
        *rows.columns,
        F.expr(
            f"""array_sort(concat(
              transform(filter({raw['assign']}, x -> length({value}) >= {ASSIGN_LEAST}), {plain}),
              transform({raw['access']}, {plain}), transform({raw['hex']}, {plain})))"""
        ).alias(base),
        F.expr(
            f"""transform(
              filter({raw['entropy']}, x -> NOT x.value RLIKE {_sql(ALLOWED)}),
              x -> named_struct('start', x.start, 'value', x.value,
                'symbols', IF({is_hex}, '{HEX_SYMBOLS}', '{KEY_SYMBOLS}'),
                'limit', IF({is_hex}, {_limit(HEX_BITS)}L, {_limit(KEY_BITS)}L)))"""
        ).alias(strings),
    )
    none = f"cast(array() AS array<{_SPAN}>>)"
    dense = f"""coalesce(transform(
        filter(
          transform({strings}, x -> named_struct('start', x.start, 'w', {_dense_windows()})),
          x -> x.w.a >= 0),
        x -> named_struct('start', x.start + x.w.a, 'kind', 3,
          'end', x.start + x.w.b + {WINDOW}, 'name', 'entropy')), {none})"""
    # in order of starts, patterned ones first: a span is inside a patterned one
    # if the furthest end of those so far is not before its own
    outer = _running(
        f"array_sort(concat({base}, {dense}))",
        none,
        "IF(x.kind < 3, greatest(s.at, x.end), s.at)",
        f"IF(x.kind = 3 AND x.end <= s.at, {none}, array(x))",
    )
    return found.select(
        *rows.columns,
        base,
        F.expr(f"IF(size({strings}) = 0, {base}, {outer})").alias(spans),
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``spans``."""
    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return with_spans(text, "text", "base", "spans").drop("text")


def joined(column: str) -> Column:
    return F.expr(
        f"array_join(transform({column}, x -> concat(x.name, ':', x.start, ':', x.end)), ',')"
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by its kind
    in brackets. Overlapping spans are one gap, named after the first. Texts
    without secrets stay as they are; ``n_chars``, if there, follows the text."""
    own = docs.columns
    rows = docs.select("*", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__secret_text"))
    found = with_spans(rows, "__secret_text", "__secret_base", "__secret_spans")
    clean = F.expr(
        """aggregate(__secret_spans, named_struct('at', 0, 'out', ''),
          (s, x) -> IF(x.end <= s.at, s, named_struct('at', x.end,
            'out', IF(x.start < s.at, s.out, concat(s.out,
              substr(__secret_text, s.at + 1, x.start - s.at), '[', x.name, ']')))),
          s -> concat(s.out, substr(__secret_text, s.at + 1)))"""
    )
    hit = F.size("__secret_spans") > 0
    out = found.withColumn("text", F.when(hit, clean).otherwise(F.col("text")))
    if "n_chars" in own:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return out.select(*[F.col(f"`{c}`") for c in own])


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.expr(f"cast(size(filter(base, x -> x.kind = {k})) AS bigint)")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle_sql() -> str:
    kinds = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    found = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS kind, '{name}' AS name, regexp_extract_all(t, {_quoted(p)}) AS ms, "
        f"regexp_split_to_array(t, {_quoted(p)}) AS gs FROM d"
        for i, (name, p) in enumerate(kinds.items())
    )
    terms = "[" + ", ".join(map(str, TERMS)) + "]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
u AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m WHERE len(ms) > 0),
s AS (
  SELECT doc_id, kind, name, ms[i] AS value,
    CAST(list_sum(list_transform(gs[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS st
  FROM u
),
base AS (
  SELECT doc_id, kind, name, st, st + length(value) AS en FROM s
  WHERE kind IN (1, 2)
     OR (kind = 0 AND length(regexp_extract(value, {_quoted(ASSIGN)}, 2)) >= {ASSIGN_LEAST})
),
c AS (
  SELECT doc_id, st, value,
    CASE WHEN regexp_matches(value, {_quoted(HEX_ONLY)}) THEN {_limit(HEX_BITS)} ELSE {_limit(KEY_BITS)} END AS lim
  FROM s WHERE kind = 3 AND NOT regexp_matches(value, {_quoted(ALLOWED)})
),
w AS (
  SELECT doc_id, st, lim, i, substr(value, i + 1, {WINDOW}) AS v
  FROM (SELECT *, unnest(range(0, length(value) - {WINDOW} + 1)) AS i FROM c)
),
g AS (
  SELECT doc_id, st, i FROM w
  WHERE list_sum(list_transform(list_distinct(string_split(v, '')),
          lambda x: {terms}[{WINDOW} - length(replace(v, x, '')) + 1])) <= lim
),
e AS (
  SELECT doc_id, 3 AS kind, 'entropy' AS name, st + min(i) AS st, st + max(i) + {WINDOW} AS en
  FROM g GROUP BY doc_id, g.st
),
extra AS (
  SELECT * FROM e WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.st <= e.st AND e.en <= b.en)
),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    string_agg(CASE WHEN kind < 3 THEN name || ':' || st || ':' || en END, ',' ORDER BY st, kind) AS b,
    string_agg(name || ':' || st || ':' || en, ',' ORDER BY st, kind) AS spans
  FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign,
  CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE_SQL = _oracle_sql()
