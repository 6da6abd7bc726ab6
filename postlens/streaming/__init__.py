"""Incremental runs of the monthly job as month folders arrive.

The job being replaced has no streaming operators (no watermark, window or
state); this package only re-aims its folder loop as a file-source stream.
"""

from postlens.streaming.month_arrivals import (
    month_arrivals,
    monthly_batch_handler,
    start_month_stream,
)

__all__ = ["month_arrivals", "monthly_batch_handler", "start_month_stream"]
