"""Month-folder CSV sources.

Layout: ``<root>/<year>/<month>/posts.csv`` and ``.../users.csv`` with a
header row. All months are read by one glob, so every month is in one
DataFrame and the month becomes a group key instead of a driver-side loop.
The folder's year and month come from each row's file path.
"""

from __future__ import annotations

import csv
import io
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from postlens.functions.columns import folder_key
from postlens.schemas import POSTS_SCHEMA, USERS_SCHEMA
from postlens.session import glob_paths, input_files, read_head
from postlens.sources.csv_records import quoted_records


CORRUPT = "_corrupt_record"
MALFORMED = ("fail", "null", "keep")


def read_month_csv(
    spark: SparkSession,
    path_glob: str,
    schema: T.StructType,
    *,
    multiline: bool | str = False,
    malformed: str = "fail",
    by_name: bool = False,
    leaf: str | None = None,
) -> DataFrame:
    """Read every file matching ``path_glob`` with a fixed schema.

    Files are split by ``maxPartitionBytes``, so one large file is read by
    many tasks. ``multiline="split"`` also accepts quoted fields with line
    breaks (doubled quotes are read either way) and still splits files; it
    scans the text once more to count quotes (``csv_records``).
    ``multiline=True`` leaves this to Spark, which reads such a file by one task.

    ``malformed`` says what a row with too few or too many fields, or with a
    value that does not parse, does: ``"fail"`` ends the read with an error,
    ``"keep"`` keeps the row with its text in the column ``_corrupt_record``
    (null for good rows), ``"null"`` makes the values null. Values of columns
    that nothing reads are looked at with ``multiline="split"`` only.

    ``by_name=True`` takes columns by the names in each file's header, in any
    order and with further columns between them (which are left out); a header
    that lacks a name of the schema, or has one twice, is an error. Without it
    a header whose names are not the schema's, in order, is an error. Either
    holds in every ``malformed`` mode.

    ``leaf`` is the entry name inside each month folder (``posts.csv``); it
    may then be a single file or a folder of part files.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}, got {malformed!r}")
    if multiline not in (False, True, "split"):
        raise ValueError(f"multiline must be False, True or 'split', got {multiline!r}")
    options = {
        "escape": '"',
        "mode": "FAILFAST" if malformed == "fail" else "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }
    names = schema.fieldNames() + [CORRUPT] * (malformed == "keep")
    if by_name or multiline == "split":
        files = input_files(spark, _found(lambda: spark.read.text(path_glob), path_glob))
        parts = [
            _read_group(spark, group, shape, options, multiline, malformed).select(
                *names, _FILE
            )
            for shape, group in _by_header(spark, files, schema, by_name)
        ]
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part)
        keys = [folder_key(i, _FILE, leaf=leaf) for i in (1, 2)]
    else:
        reader = (
            spark.read.schema(_with_corrupt(schema, malformed))
            .options(**options)
            .option("header", True)
            .option("enforceSchema", False)
            .option("multiLine", multiline)
            # all fields are parsed, else a broken row can look whole
            .option("columnPruning", False)
        )
        df = _found(lambda: reader.csv(path_glob), path_glob)
        keys = [folder_key(i, leaf=leaf) for i in (1, 2)]
    df = df.withColumn("src_year", keys[0]).withColumn("src_month", keys[1])
    return df.drop(_FILE)


_FILE = "_file_of_row"


def _found(read, path_glob: str):
    try:
        return read()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"No data found at {path_glob}") from exc
        raise


def _with_corrupt(schema: T.StructType, malformed: str) -> T.StructType:
    extra = [T.StructField(CORRUPT, T.StringType())] if malformed == "keep" else []
    return T.StructType([*schema.fields, *extra])


def _by_header(
    spark: SparkSession, files: list[str], schema: T.StructType, by_name: bool
) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by their header, each group with the schema of its
    columns in file order. The driver, which lists the files, reads the first
    bytes of each; no row passes through it."""
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        heads = pool.map(lambda f: read_head(spark, f), files)
        for file, head in zip(files, heads):
            text = head.decode("utf-8-sig", errors="replace")
            header = next(csv.reader(io.StringIO(text, newline="")), [])
            groups.setdefault(tuple(h.strip().lower() for h in header), []).append(file)
    wanted = {f.name.lower(): f for f in schema.fields}
    out = []
    for header, group in sorted(groups.items()):
        if not header:  # an empty file has no rows
            header = tuple(wanted)
        twice = [h for h in wanted if header.count(h) > 1]
        lacks = [h for h in wanted if h not in header]
        if twice or lacks or not (by_name or header == tuple(wanted)):
            raise ValueError(
                f"header of {group[0]} does not fit the schema: {list(header)}; "
                f"missing {lacks}, repeated {twice}, expected {list(wanted)}"
            )
        fields = [
            wanted.get(h) or T.StructField(f"_other_{i}", T.StringType())
            for i, h in enumerate(header)
        ]
        out.append((T.StructType(fields), group))
    return out


def _read_group(
    spark: SparkSession,
    files: list[str],
    shape: T.StructType,
    options: dict,
    multiline: bool | str,
    malformed: str,
) -> DataFrame:
    """Rows of files with one header, with the file they are from."""
    shape = _with_corrupt(shape, malformed)
    # paths are taken as globs
    paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", f) for f in files]
    if multiline == "split":
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.fields)
        row = F.from_csv("text", ddl, options)
        return quoted_records(spark, paths).select(
            row.alias("row"), F.col("path").alias(_FILE)
        ).select("row.*", _FILE)
    reader = (
        spark.read.schema(shape)
        .options(**options)
        .option("header", True)
        .option("multiLine", multiline)
        .option("columnPruning", False)
    )
    return reader.csv(paths).withColumn(_FILE, F.col("_metadata.file_path"))


def missing_entries(
    spark: SparkSession, inputs: str, entries: tuple[str, ...] = ("posts.csv", "users.csv")
) -> list[str]:
    """Expected files that a month folder under ``inputs`` lacks."""
    root = inputs.rstrip("/")
    folders = [f for f in glob_paths(spark, f"{root}/*/*") if _is_month(f)]
    found = {e: set(glob_paths(spark, f"{root}/*/*/{e}")) for e in entries}
    return [f"{f}/{e}" for f in sorted(folders) for e in entries if f"{f}/{e}" not in found[e]]


def _is_month(folder: str) -> bool:
    year, month = folder.rstrip("/").split("/")[-2:]
    return year.isdigit() and month.isdigit()


def read_posts(
    spark: SparkSession,
    inputs: str,
    *,
    multiline: bool | str = False,
    malformed: str = "fail",
    by_name: bool = False,
) -> DataFrame:
    return read_month_csv(
        spark,
        f"{inputs.rstrip('/')}/*/*/posts.csv",
        POSTS_SCHEMA,
        multiline=multiline,
        malformed=malformed,
        by_name=by_name,
        leaf="posts.csv",
    )


def read_users(
    spark: SparkSession,
    inputs: str,
    *,
    multiline: bool | str = False,
    malformed: str = "fail",
    by_name: bool = False,
) -> DataFrame:
    return read_month_csv(
        spark,
        f"{inputs.rstrip('/')}/*/*/users.csv",
        USERS_SCHEMA,
        multiline=multiline,
        malformed=malformed,
        by_name=by_name,
        leaf="users.csv",
    )


def write_month_csv(df: DataFrame, root: str, *, files_per_month: int = 4) -> None:
    """Write rows with ``src_year``/``src_month`` as month folders of CSV.

    One write job for all months (partitioned output, one folder per month),
    readable again by ``read_month_csv(spark, f"{root}/*/*/*.csv", schema)``.
    Rows are clustered by month and a hash bucket, so a month is written by up
    to ``files_per_month`` tasks; the explicit partition count keeps AQE from
    folding small inputs into a single writing task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*[df[c] for c in df.columns]), F.lit(files_per_month))
    (
        df.repartition(max(n, files_per_month), "src_year", "src_month", bucket)
        .write.mode("overwrite")
        .partitionBy("src_year", "src_month")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .csv(root)
    )
