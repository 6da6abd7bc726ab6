"""CSV records with line breaks in quoted fields, read by many tasks a file.

A line of the file starts a record if the quotes before it, from the file's
start, are even in number. That needs only one bit a split:

1. one scan counts quotes per split (map-side sums; one row a split goes to
   the driver, which holds the list of splits anyway), and a running parity
   over a file's splits says which of them start inside a quoted field;
2. one scan streams each split's lines, in file order and without a shuffle,
   through a running parity kept across Arrow batches, and emits the records
   that lie within the split;
3. only where a record crosses splits are its pieces read once more (only the
   splits concerned pass the filter), grouped by the split it starts in, and
   joined. A record may cover any number of splits.

Files must quote as RFC 4180 says: fields that hold quotes, separators or line
breaks are quoted and inner quotes doubled. A quote inside an unquoted field
counts like any other, so what follows shows up as broken records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORDS = "path string, block long, opens int, text string"


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their file, split and number of quotes. Only ``\\n`` ends a
    line here, so a ``\\r`` within a field stays."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def split_parities(lines: DataFrame) -> pd.DataFrame:
    """One row a split: ``path``, ``block`` and whether its first and its last
    line break lie inside a quoted field (``starts_in``, ``ends_in``)."""
    odd = (F.sum("quotes") % 2).cast("int").alias("odd")
    splits = lines.groupBy("path", "block").agg(odd).toPandas()
    splits = splits.sort_values(["path", "block"], ignore_index=True)
    ends = splits.groupby("path")["odd"].cumsum() % 2
    splits["ends_in"] = ends == 1
    splits["starts_in"] = (ends + splits["odd"]) % 2 == 1
    return splits.drop(columns="odd")


def _cutter(starts: dict[str, np.ndarray], odd: dict[str, set[int]], whole: bool):
    """The function that turns a partition's lines into records: those within
    a split (``whole``) or the pieces at its edges. ``opens`` is 1 where a
    piece starts a record, 0 where it goes on with an earlier split's.

    ``starts`` names every split seen by the first scan: a split planned since
    then would have no known parity, which is an error, not a guess.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, inside, parity, held, header = None, False, 0, [], False

        def rows(texts, opens):
            return pd.DataFrame(
                {"path": place[0], "block": place[1], "opens": opens, "text": texts}
            )

        def edge():  # what a split still holds at its end
            if not whole and held:
                yield rows(["\n".join(held)], 0 if inside else 1)

        for batch in batches:
            new = (batch["path"] != batch["path"].shift()) | (
                batch["block"] != batch["block"].shift()
            )
            for _, part in batch.groupby(new.cumsum(), sort=False):
                here = (part["path"].iloc[0], int(part["block"].iloc[0]))
                if here != place:
                    if place:
                        yield from edge()
                    known = starts.get(here[0], ())
                    at = int(np.searchsorted(known, here[1]))
                    if at == len(known) or known[at] != here[1]:
                        raise RuntimeError(
                            f"split {here} was not in the first scan: the files or the "
                            "settings that split them changed during the read"
                        )
                    place, held, header = here, [], here[1] == 0
                    inside = here[1] in odd.get(here[0], ())
                    parity = int(inside)
                texts = held + part["text"].tolist()
                after = (parity + part["quotes"].to_numpy().cumsum()) % 2
                parity = int(after[-1])
                ends = np.flatnonzero(after == 0) + len(held) + 1
                if not len(ends):
                    held = texts
                    continue
                first, out = 0, []
                if inside:  # ends the record of an earlier split
                    first = int(ends[0])
                    if not whole:
                        yield rows(["\n".join(texts[:first])], 0)
                    inside, ends = False, ends[1:]
                for end in ends.tolist():
                    out.append(texts[first] if end == first + 1 else "\n".join(texts[first:end]))
                    first = end
                held = texts[first:]
                if header and out:
                    out, header = out[1:], False
                if whole and out:
                    yield rows(out, 1)
        if place:
            yield from edge()

    return cut


def quoted_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, text) of every record of the files but their headers; blank lines
    are left out."""
    lines = read_lines(spark, paths)
    splits = split_parities(lines)
    starts = {p: g["block"].to_numpy() for p, g in splits.groupby("path")}
    odd = {p: set(g["block"].tolist()) for p, g in splits[splits["starts_in"]].groupby("path")}
    records = lines.mapInPandas(_cutter(starts, odd, True), RECORDS).select("path", "text")
    cut = splits[splits["starts_in"] | splits["ends_in"]]
    if len(cut):
        place = F.concat_ws(":", "path", "block")
        names = (cut["path"] + ":" + cut["block"].astype(str)).tolist()
        touched = lines.where(F.col("path").isin(sorted(set(cut["path"]))) & place.isin(names))
        pieces = touched.mapInPandas(_cutter(starts, odd, False), RECORDS)
        # a piece belongs to the last record opened before it; at most two
        # pieces a split, so the window holds few rows a file
        order = Window.partitionBy("path").orderBy("block", "opens")
        owner = F.sum("opens").over(order)
        joined = (
            pieces.withColumn("owner", owner)
            .groupBy("path", "owner")
            .agg(F.sort_array(F.collect_list(F.struct("block", "opens", "text"))).alias("all"))
            .select("path", F.array_join(F.col("all")["text"], "\n").alias("text"))
        )
        records = records.unionByName(joined)
    # where lines end in \r\n, so do those within fields: both are read as \n
    text = F.col("text")
    crlf = F.regexp_replace(F.rtrim("text", F.lit("\r")), "\r\n", "\n")
    records = records.withColumn("text", F.when(text.endswith("\r"), crlf).otherwise(text))
    return records.where(F.trim(F.translate("text", "\n\t", "  ")) != "")
