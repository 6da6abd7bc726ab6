"""Process month folders as their files arrive (Structured Streaming).

The batch job computes every month in one plan. When months land one at a
time (a new ``<year>/<month>/posts.csv`` and ``users.csv`` each month), this
module runs it incrementally: a file-source stream over the month folders
reports which folders received new files, and each micro-batch re-runs the
batch job for exactly those months, replacing only their folders in the
results. A month whose second file has not arrived yet is processed without it
(the batch job's check for missing files is off by default here).

* The stream reads file *names* only: it uses the ``binaryFile`` source and
  selects the ``path`` column, so file contents are never loaded by the
  stream; the batch job parses each month once.
* The stream's checkpoint records which files were handled, so a restarted
  query resumes where it stopped. Re-running a micro-batch rewrites the same
  month partitions with the same content, so a retry after a failure is
  harmless.
* The distinct months of one micro-batch are collected to the driver to name
  the partitions to rebuild; that list is bounded by the number of month
  folders in the batch, not by data size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postlens.functions.columns import folder_key
from postlens.plans.monthly import run_monthly_job

# Fixed value: the schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def month_arrivals(
    spark: SparkSession,
    inputs: str,
    *,
    entries: tuple[str, ...] = ("posts.csv", "users.csv"),
    watch_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of (src_year, src_month, path) per new input file.

    Watches ``<inputs>/<year>/<month>/<entry>`` for the named entries; an
    entry may be a file or a folder of part files (a new part file names the
    month folder it sits in). ``watch_glob`` replaces that layout by any
    glob whose files sit directly in their month folder (e.g. Spark-written
    ``.../src_year=2016/src_month=1/part-*.csv``).
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if watch_glob:
        files, leaf = reader.load(watch_glob), None
    else:
        names = ",".join(entries)
        files, leaf = reader.load(f"{inputs.rstrip('/')}/*/*/{{{names}}}"), entries
    return files.select(
        folder_key(1, "path", leaf=leaf).alias("src_year"),
        folder_key(2, "path", leaf=leaf).alias("src_month"),
        "path",
    )


def _months_of(batch: DataFrame) -> list[tuple[int, int]]:
    rows = (
        batch.where(F.col("src_year").isNotNull() & F.col("src_month").isNotNull())
        .select("src_year", "src_month")
        .distinct()
        .collect()
    )
    return sorted((r["src_year"], r["src_month"]) for r in rows)


def monthly_batch_handler(
    spark: SparkSession, inputs: str, outputs: str, **job_options
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: re-run the batch job for the batch's months."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        months = _months_of(batch)
        if months:
            options = {"strict": False, **job_options}
            run_monthly_job(spark, inputs, outputs, months=months, **options)

    return handle


def start_month_stream(
    spark: SparkSession,
    inputs: str,
    outputs: str,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
    watch_glob: str | None = None,
    **job_options,
) -> StreamingQuery:
    """Start the incremental job; returns the running query.

    ``available_now=True`` handles every file present and stops (for a
    scheduled run); otherwise the query polls every ``processing_time``.
    ``checkpoint`` defaults to ``<outputs>/_checkpoint`` (same shared
    storage as the outputs; names starting with ``_`` are ignored by
    readers of the result folders). ``job_options`` go to
    ``run_monthly_job`` (``how``, ``join_on_month``, ``snapshot_months``,
    ``multiline``, ``stage_inputs``, ``posts_glob``, ``users_glob``);
    ``watch_glob`` goes to ``month_arrivals``.
    """
    ckpt = checkpoint or f"{outputs.rstrip('/')}/_checkpoint"
    writer = (
        month_arrivals(
            spark,
            inputs,
            watch_glob=watch_glob,
            max_files_per_trigger=max_files_per_trigger,
        )
        .writeStream.foreachBatch(
            monthly_batch_handler(spark, inputs, outputs, **job_options)
        )
        .option("checkpointLocation", ckpt)
        .queryName("postlens_month_arrivals")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
