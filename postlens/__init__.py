"""postlens: monthly post and tag analytics on Spark DataFrames.

Two results per source month, both computed for all months in one plan:

* a summary row (post, user and active-tag counts, averages and a
  posts-per-day histogram), written as JSON, and
* a tag analysis table (posts, average reputation, average score and top
  contributor per tag), written as Parquet.

Every function takes and returns DataFrames; the SparkSession is always a
parameter and is never created at import time.
"""

from postlens.operators.summary import compute_summary
from postlens.operators.tags import compute_tag_analysis
from postlens.plans.monthly import run_monthly_job, run_on_frames

__all__ = ["compute_summary", "compute_tag_analysis", "run_monthly_job", "run_on_frames"]
