"""Operator 10: WARC archives, read back by boundary-chain verification.

Writing. One record per page: header lines, an empty line, the payload, and
two line ends. Spark's text writer puts the magic line in front as part of
the row and the two line ends behind it as its line separator, so every
written file is a plain WARC file and no page passes through the driver. Of
records with equal payloads of at least ``revisit_bytes`` bytes the one with
the largest page_id is the ``response``; the others are ``revisit`` records
without payload that name it.

Reading. The files are read with the magic line as line separator, so they
split like any text file, whatever the size. Each piece that follows a magic
line is a candidate record; its byte offset is a running sum of piece
lengths, its successor's offset follows from its header's Content-Length.
The same magic inside a payload gives false candidates, so boundaries are
verified as a chain: offset 0 is a record, and pointer jumping (each round
replaces every candidate's pointer by its pointer's pointer, and marks the
targets of marked candidates) finds all candidates on the chain in
log2(candidates) rounds. Only these are records. A record whose payload holds
the magic is put together from its pieces.

What moves: offsets, header fields and digests. The payload digest of a
candidate that fits its piece is computed where the piece is read; text goes
through the exchange only for pieces that don't fit (magic in a payload). One
archive file's candidates are one group; ``records_per_file`` bounds it.

Nulls and edge cases: a null html is an empty payload; a null url is written
as an empty URI; a null page_id is written as an empty id and comes back as
null, and never is what others refer to; repeated rows (same page_id and
payload) are each written and each is a response; other columns are ignored; an empty table writes an
archive without records and gives an empty result. A cut-off last record (its
successor lies behind the end of the file) is not returned. If a record's
payload runs over the edge of a file split and holds a complete record behind
that edge, its declared digest is returned as it stands.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import binary_values, checkpointed, read_table
from postlens.session import new_scratch_dir

# Fixed values of the WARC format.
MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 20_000
# Rows (about 50 bytes each) of repeated payloads up to which their table is
# broadcast; beyond it, pages are joined to it by a shuffle.
BROADCAST_ROWS = 100_000


def with_roles(spark: SparkSession, pages: DataFrame, revisit_bytes: int) -> DataFrame:
    """Pages with digest, record type and the page they refer to."""
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1(F.col("payload").cast("binary")).alias("digest"),
    )
    # Only digests that occur again are kept: the exchange holds partial sums.
    again = (
        base.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select(F.col("digest").alias("again_digest"), "first_id")
    )
    again = checkpointed(spark, again)
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    role = base.join(again, F.col("digest") == F.col("again_digest"), "left")
    # a short payload may not revisit, even if its digest were in the table
    late = F.col("first_id").isNotNull() & (F.col("payload_bytes") >= revisit_bytes)
    return role.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "digest",
        F.when(late & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
        .alias("refers_to"),
    )


def _text(c: str) -> Column:
    """One header value: line ends would break the header."""
    return F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\r\n]+", " ")


def write_archives(
    pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Pages with roles as WARC files under ``path``."""
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(""))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    record = F.concat(
        F.lit(MAGIC),
        line(
            "WARC-Type",
            F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        ),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _text("page_id"), F.lit(">"))),
        line("WARC-Target-URI", _text("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            F.col("refers_to").isNotNull(),
            F.concat(
                line("WARC-Profile", F.lit(IDENTICAL_PAYLOAD)),
                line(
                    "WARC-Refers-To",
                    F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
                ),
            ),
        ).otherwise(F.lit("")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    (
        pages.select(record.alias("value"))
        .write.mode("error")
        .option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


_FIELD = re.compile(rb"(?:^|\r\n)([A-Za-z-]+): *([^\r\n]*)")
_PIECE = (
    "file string, block long, seq long, size long, head long, content long, type string, "
    "id string, refers_to string, declared string, full long, digest string, raw binary"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate rows of one task's pieces, which come in file order.

    The text of a piece is kept (``raw``) only where a record that isn't
    complete in its own piece may reach: up to ``reach`` in this split.
    """
    at, reach, split = 0, 0, None
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("file", "block", "seq")]
        out = []
        for value, file, block, seq in zip(binary_values(batch.column("value")), *cols):
            if split != (file, block):
                at, reach, split = 0, 0, (file, block)
            head = value.find(b"\r\n\r\n") + 4
            content = digest = None
            fields: dict[bytes, str] = {}
            if head >= 4:
                found = _FIELD.findall(value, 0, head - 2)
                fields = {k: v.decode("utf-8", "replace") for k, v in reversed(found)}
                length = fields.get(b"Content-Length", "")
                content = int(length) if re.fullmatch("[0-9]{1,18}", length) else None
            inside = at < reach
            if content is not None:
                if len(value) == head + content + len(RECORD_END):
                    digest = hashlib.sha1(memoryview(value)[head : head + content]).hexdigest()
                else:
                    reach = max(reach, at + head + content)
            full = fields.get(b"X-Payload-Length", "")
            out.append(
                (
                    file,
                    block,
                    seq,
                    len(value),
                    head if content is not None else None,
                    content,
                    fields.get(b"WARC-Type"),
                    fields.get(b"WARC-Record-ID"),
                    fields.get(b"WARC-Refers-To"),
                    fields.get(b"WARC-Payload-Digest", "").removeprefix("sha1:") or None,
                    int(full) if re.fullmatch("[0-9]{1,18}", full) else None,
                    digest,
                    value if inside or digest is None else None,
                )
            )
            at += len(value) + len(MAGIC)
        types = [pa.string(), *[pa.int64()] * 5, *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
        cells = list(zip(*out)) if out else [()] * len(types)
        names = [x.split()[0] for x in _PIECE.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cells, types)], names=names
        )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece between magic lines, in narrow form.

    ``content`` is the declared length, ``head`` the header's bytes (null
    without a header), ``digest`` the SHA-1 of the payload if the piece holds
    all of it.
    """
    pieces = (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    return pieces.mapInArrow(_scan, _PIECE)


def chain(offsets: np.ndarray, successors: np.ndarray, end: int) -> np.ndarray:
    """Which candidates the chain from offset 0 reaches, by pointer jumping.

    ``offsets`` ascend; ``successors`` are byte offsets (-1: none). A pointer
    that hits no candidate ends its chain. A record must end within the file.
    """
    n = len(offsets)
    reached = np.zeros(n + 1, bool)
    if not n or offsets[0] != 0:
        return reached[:n]
    at = np.minimum(np.searchsorted(offsets, successors), n - 1)
    jump = np.append(np.where(offsets[at] == successors, at, n), n)
    reached[0] = True
    while True:
        targets = jump[:-1][reached[:-1]]
        before = int(reached[:-1].sum())
        reached[targets] = True
        reached[n] = False
        if int(reached[:-1].sum()) == before and (targets == n).all():
            break
        jump = jump[jump]
    return reached[:n] & (successors > 0) & (successors <= end)


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def _payload(raw: list, sizes: np.ndarray, first: int, head: int, content: int) -> bytes | None:
    """A payload that goes over several pieces; None if one was not kept."""
    parts, got, j = [], 0, first
    while got < head + content:
        if j >= len(raw) or raw[j] is None:
            return None
        if j > first:
            parts.append(MAGIC.encode())
            got += len(MAGIC)
        parts.append(raw[j])
        got += int(sizes[j])
        j += 1
    return b"".join(parts)[head : head + content]


def _records(table: pa.Table) -> pa.Table:
    """The verified records of one archive file."""
    table = table.sort_by([("block", "ascending"), ("seq", "ascending")])
    col = {c: table.column(c).to_pylist() for c in table.column_names}
    size = np.array(col["size"], np.int64)
    m = len(MAGIC)
    end = int(size.sum()) + m * (len(size) - 1)
    # the first piece lies before the first magic line; a record starts at 0 if it is empty
    offsets = np.cumsum(np.append(size[0], size[1:-1] + m))[: len(size) - 1]
    head = np.array([-1 if x is None else x for x in col["head"]], np.int64)[1:]
    content = np.array([-1 if x is None else x for x in col["content"]], np.int64)[1:]
    successors = np.where(head >= 0, offsets + m + head + content + len(RECORD_END), -1)
    out = []
    for i in np.flatnonzero(chain(offsets, successors, end)):
        k = int(i) + 1
        n, digest, declared = col["content"][k], col["digest"][k], col["declared"][k]
        if digest is None:
            payload = _payload(col["raw"], size, k, col["head"][k], n)
            digest = declared if payload is None else hashlib.sha1(payload).hexdigest()
        kind = col["type"][k] or ""
        if kind == "revisit":
            n, digest = col["full"][k] or 0, declared
        elif declared is not None and declared != digest:
            raise ValueError(f"the payload of the record at {int(offsets[i])} does not fit its digest")
        out.append((_page(col["id"][k]), n, digest, kind, _page(col["refers_to"][k]), int(offsets[i])))
    cells = list(zip(*out)) if out else [()] * 6
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "offset"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Verified records of all archives under ``path``."""
    pieces = candidates(spark, path)
    return pieces.groupBy("file").applyInArrow(
        _records,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, offset long",
    )


def round_trip(
    spark: SparkSession,
    pages: DataFrame,
    revisit_bytes: int = REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back."""
    path = new_scratch_dir(spark, "warc")
    write_archives(with_roles(spark, pages, revisit_bytes), path, records_per_file)
    return read_archives(spark, path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(spark, read_table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS n
  FROM pages
), r AS (
  SELECT d AS rd, max(page_id) AS first_id FROM p WHERE n >= 1000 GROUP BY d HAVING count(*) > 1
)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND first_id <> page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN r ON d = rd AND n >= 1000
"""
